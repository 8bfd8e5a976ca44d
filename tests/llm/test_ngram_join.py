import random

from palmyra.llm import ngram_join

from .helpers import clusters, shingles


def check(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "g") for r in rows],
                                 "doc_id long, text string, row long, grp string")
    got = ngram_join.jaccard_join(docs).collect()
    sets = [shingles(t) for _, t in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    by_place = clusters([sets[i] for i in order])
    want = sorted(((str(rows[i][0]), str(rows[order[root]][0]), links)
                   for i, (root, links) in zip(order, by_place)))
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in got) == want
    return got


def test_bands_reach_the_target_recall():
    for threshold, recall in ((0.8, 0.999), (0.5, 0.95), (0.95, 0.9999)):
        bands, rows = ngram_join.choose_bands(threshold, recall)
        assert 1 - (1 - threshold ** rows) ** bands >= recall
        assert bands * rows <= ngram_join.MAX_HASHES


def test_against_brute_force(spark):
    rng = random.Random(3)
    base = [[f"w{rng.randrange(400)}" for _ in range(rng.choice((3, 5, 8, 40, 200)))] for _ in range(40)]
    rows = []
    for i in range(250):
        words = list(rng.choice(base))
        for _ in range(rng.choice((0, 0, 1, 2, 5))):
            words[rng.randrange(len(words))] = f"x{rng.randrange(30)}"
        rows.append((1000 - i, " ".join(words).title() if i % 3 else ", ".join(words)))
    rows += [(1, None), (2, ""), (3, "!!"), (4, "one"), (5, "ONE."), (6, "t " * 30_000),
             (7, "t " * 29_000), (None, "one"), (None, None), (8, "uno"), (8, "dos"), (8, "dos")]
    check(spark, rows)


def test_extreme_and_null_ids_are_told_apart(spark):
    top = 2**63 - 1
    check(spark, [(top, "one two"), (None, "one two"), (None, "other"), (-2**63, "x y"), (top, None)])
    got = {r.doc_id for r in ngram_join.jaccard_join(spark.createDataFrame(
        [(top, "solo"), (None, "none")], "doc_id long, text string")).collect()}
    assert got == {top, None}


def test_rows_without_words_all_stay(spark):
    rows = [(4, "!!"), (4, "!!"), (None, ""), (None, ""), (None, None), (5, "word"), (5, "word"), (6, "WORD!")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, row long")
    got = sorted(str((r.doc_id, r.text)) for r in ngram_join.keep_one(docs).collect())
    assert got == sorted(str(r) for r in [*rows[:5], (5, "word")])


def test_most_classes_are_similar_to_nothing(spark):
    """They have no cluster, and must not meet in one task for want of a label."""
    from pyspark.sql import functions as F
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat_ws(
            " ", *(F.sha2(F.concat_ws(" ", "id", F.lit(i)), 256) for i in range(6))).alias("text"))
        got = ngram_join.jaccard_join(docs).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()
        assert sum(r.n for r in got) == 3000 and max(r.n for r in got) <= 2 * 3000 / len(got)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_large_group_of_near_copies_in_blocks(spark, monkeypatch):
    """More classes than a block: every link between different texts counts."""
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 90)
    text = " ".join(f"w{i}" for i in range(120))
    rows = [(i, f"{text} n{i}") for i in range(700)] + [(i, text) for i in range(700, 900)]
    got = check(spark, rows)
    assert {r.n_links for r in got} == {899}


def test_two_sides_of_the_threshold(spark):
    words = [f"w{i}" for i in range(40)]            # 36 shingles
    near = words + [f"n{i}" for i in range(9)]      # 36 of 45: exactly 0.8
    far = words + [f"f{i}" for i in range(10)]
    got = check(spark, [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(far))])
    assert {r.doc_id: r.n_links for r in got} == {1: 1, 2: 1, 3: 0}


def test_empty_table_and_one_of_each_group(spark):
    schema = "doc_id long, text string, id string"
    assert ngram_join.jaccard_join(spark.createDataFrame([], schema)).count() == 0
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(5, a, "p"), (3, a + " tail", "q"), (3, b, "r"), (9, b, "s"), (3, b, "r"), (1, None, "t"),
            (2, "", "u"), (None, "alone", None)]
    kept = ngram_join.keep_one(spark.createDataFrame(rows, schema)).collect()
    assert sorted((str(r.doc_id), r.id) for r in kept) == [
        ("1", "t"), ("2", "u"), ("3", "q"), ("3", "r"), ("None", None)]
    assert ngram_join.keep_one(spark.createDataFrame([], schema)).columns == ["doc_id", "text", "id"]
