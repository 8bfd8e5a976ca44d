"""The stages one after the other, each against a brute-force version."""

import pytest

import corpus_pipeline
from palmyra.llm import toxicity
from palmyra.sources.writers import cut_lineage

from .helpers import clusters, contaminated_words, shingles


@pytest.fixture(scope="module")
def stages(spark, sf0001):
    docs = spark.read.parquet(f"{sf0001}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = cut_lineage(stage(spark, docs, sf0001), f"test-{name}")
        out.append(docs)
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns_and_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_copies", "decontamination",
                                                      "mixing", "tokens"]
    for df in stages[1:5]:
        assert df.columns == stages[0].columns
    for a, b in zip(stages[:4], stages[1:5]):
        before, after = rows(a), rows(b)
        assert all(before[i] == r for i, r in after.items())


def test_toxicity_goes_by_the_score(spark, sf0001, stages):
    labels = spark.read.parquet(f"{sf0001}/labels.parquet")
    scored = toxicity.score(stages[0], labels).where("score < 0.5")
    assert {r.doc_id for r in scored.collect()} == set(rows(stages[1]))


def test_one_of_each_group_stays(stages):
    before = sorted(rows(stages[1]).values(), key=lambda r: r.doc_id)
    found = clusters([shingles(r.text) for r in before])
    assert set(rows(stages[2])) == {before[root].doc_id for root, _ in found}


def test_contaminated_documents_go(spark, sf0001, stages):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf0001}/benchmark.parquet").collect()}
    want = {i for i, r in rows(stages[2]).items() if not contaminated_words(r.text, items)[0]}
    assert set(rows(stages[3])) == want


def test_mix_keeps_to_its_budget(stages):
    count = lambda df: sum(len(r.text.split()) for r in df.collect())
    assert 0 < count(stages[4]) <= corpus_pipeline.MIX_SHARE * count(stages[3])


def test_tokens_of_every_document(stages):
    got = stages[5].orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted(rows(stages[4]))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens


def test_odd_rows_pass_the_stages(spark, sf0001):
    schema = "doc_id long, text string, lang string, source string, n_chars long, doc string, row long"
    data = [(None, None, None, None, None, "a", 1), (7, "", "en", "src0", 0, "b", 2),
            (7, "kept words " * 9000, "en", "src0", 1, "c", 3), (7, "kept words " * 9000, "en", "src0", 1, "c", 3)]
    for given in (data, []):
        docs = spark.createDataFrame(given, schema)
        for _, stage in corpus_pipeline.STAGES[:4]:
            docs = cut_lineage(stage(spark, docs, sf0001), "test-odd")
            assert docs.columns == [c.split()[0] for c in schema.split(", ")]
        assert corpus_pipeline.store_tokens(spark, docs, sf0001).count() == docs.count()
