import random
import re

import pytest

from palmyra.llm import secret_scan

WORDS = "the request handler returns configuration from another environment variable when missing".split()


def make(n, seed):
    """(doc_id, text, path, {start: is_secret}) with random tokens, long words and
    paths."""
    rng = random.Random(seed)
    rows, truth = [], {}
    for i in range(n):
        parts, at = [], 0
        for _ in range(rng.randrange(2, 7)):
            kind = rng.choice(["prose", "prose", "secret", "assigned", "compound", "path", "number"])
            before = rng.choice(["é ", "see ", ""])
            if kind == "assigned":
                before, value = "api_key = \"", "".join(rng.choices("0123456789abcdef", k=40))
            elif kind == "secret":
                value = "".join(rng.choices("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghjkmnpqrstuvwxyz23456789", k=32))
            elif kind == "compound":
                value = "".join(rng.sample(WORDS, 3))
            elif kind == "path":
                value = "/".join(["usr", *rng.sample(WORDS, 3)])
            elif kind == "number":
                value = str(rng.randrange(10 ** 17, 10 ** 18))
            else:
                value = " ".join(rng.sample(WORDS, 4))
            if kind != "prose" and len(value) >= 16:
                truth[i, at + len(before)] = kind in ("secret", "assigned")
            parts.append(before + value)
            at += len(before) + len(value) + 3
        rows.append((i, " ; ".join(parts), f"src/{i}.py", "x"))
    return rows, truth


SCHEMA = "doc_id long, text string, path string, row string"


def test_trained_from_labelled_findings(spark):
    rows, truth = make(500, 1)
    labelled = [(i, at, int(v)) for (i, at), v in truth.items() if i % 2]
    findings = spark.createDataFrame(labelled, "doc_id long, start int, is_secret int")
    got = secret_scan.find(spark.createDataFrame(rows, SCHEMA), findings, path_col="path", least_docs=5)
    held = {(r.doc_id, r.start): r.is_secret for r in got.collect() if r.doc_id % 2 == 0}
    known = {k: v for k, v in truth.items() if k[0] % 2 == 0}
    assert set(known) <= set(held)          # the generators miss none
    right = sum(held[k] == v for k, v in known.items())
    assert right / len(known) >= 0.95


def test_values_lie_where_they_are_said_to(spark):
    rows, _ = make(40, 2)
    texts = {i: t for i, t, *_ in rows}
    for r in secret_scan.find(spark.createDataFrame(rows, SCHEMA), least_docs=2).collect():
        assert texts[r.doc_id][r.start:r.end] == r.value


def test_rules_as_labels(spark):
    rows, truth = make(400, 3)
    got = {(r.doc_id, r.start): r.is_secret for r in
           secret_scan.find(spark.createDataFrame(rows, SCHEMA), path_col="path", least_docs=5).collect()}
    assigned = {(i, t.index('"') + 1) for i, t, *_ in rows if '"' in t}
    assert all(got[k] for k in assigned)
    assert sum(got[k] == v for k, v in truth.items()) / len(truth) >= 0.8


def test_edge_rows(spark):
    rows = [(1, None, None, "a"), (2, "", None, "b"), (3, "a" * 60_000, "p/q", "c"), (None, "password: hunter2xyz", None, "d"),
            (4, 'token = "0123456789abcdef0123456789abcdef01234567"', None, "e"),
            (4, 'token = "0123456789abcdef0123456789abcdef01234567"', None, "e")]
    got = secret_scan.find(spark.createDataFrame(rows, SCHEMA), path_col="path").collect()
    assert sorted((str(r.doc_id), r.start, r.end) for r in got) == [
        ("3", 0, 60_000), ("4", 9, 49), ("4", 9, 49), ("None", 10, 20)]
    assert all(r.is_secret for r in got if r.doc_id == 4)


@pytest.mark.parametrize("rows", [[], [(1, "nothing here", None, "a")]])
def test_without_candidates(spark, rows):
    assert secret_scan.find(spark.createDataFrame(rows, SCHEMA)).count() == 0


def test_no_python_in_the_plan(spark, sf0001):
    from palmyra.llm.queries import QUERIES
    plan = QUERIES["op2_secret_scan"](spark, sf0001)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("text,value", [
    ('{"password": "hunter22!x"}', "hunter22!x"), ("db_password: hunter22!x", "hunter22!x"),
    ("client_secret: Ab3$9kLq", "Ab3$9kLq"), ("see postgres://u:hunter22@host/db", "hunter22"),
    ("redis://:p@ss22@host", "p@ss22"), ("dbPassword  =  'hunter22!x'", "hunter22!x"),
    ("AWS_SECRET_ACCESS_KEY=wJalrXUt!nFEMI", "wJalrXUt!nFEMI"), ("SECRET_KEY = \"a$b^c&d*e\"", "a$b^c&d*e")])
def test_usual_forms_of_named_values(spark, text, value):
    got = secret_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [(r.value, r.assigned) for r in got] == [(value, True)]
    assert text[got[0].start:got[0].end] == value


@pytest.mark.parametrize("text,value", [
    ('password      =      "hunter22!x"', "hunter22!x"), ("token\n\t\n      :\n\n\"Ab3$9kLq\"", "Ab3$9kLq"),
    ("ftp://" + "u" * 300 + ":hunter22@host", "hunter22"), ("auth" + " " * 5000 + "= s3cr3t!x", "s3cr3t!x"),
    ("password=token=abc!def", "abc!def"), ("secret: " + "k!" * 9000, "k!" * 9000)])
def test_names_may_lie_far_from_their_values(spark, text, value):
    got = [r for r in secret_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
           if r.assigned]
    assert [(r.value, text[r.start:r.end]) for r in got] == [(value, value)]


def by_hand(text):
    """Candidates of a text, walking it from the left: (start, end, assigned)."""
    name = re.compile(r"(?:password|passwd|pwd|secret(?:[_-]?key)?|token|api[_-]?key|access[_-]?key|auth"
                      r"|credential|bearer)[\"']?\s*(?::=|=>|[=:])\s*[\"']?", re.I)
    found, at = [], 0
    while at < len(text):
        m = name.search(text, at)
        if not m:
            break
        value = re.match(r"[^\s\"',;]+", text[m.end():])
        inner = name.search(text, m.end())
        # A sign of two characters may also be read as one of them; such values don't count.
        if not value or len(value.group()) < 6 or text[m.end()] in "=>":
            at = m.start() + 1
            continue
        end = min(m.end() + len(value.group()), inner.start() if inner and inner.end() > inner.start()
                  and valid(text, inner) else len(text))
        if end - m.end() >= 6:
            found.append((m.end(), end, True))
        at = m.end()
    for m in re.finditer(r"(?<![A-Za-z0-9_+/=.-])[A-Za-z0-9_+/=.-]{16,}", text):
        if not any(a < m.end() and m.start() < b for a, b, _ in found):
            found.append((m.start(), m.end(), False))
    return sorted(found)


def valid(text, m):
    value = re.match(r"[^\s\"',;]+", text[m.end():])
    return bool(value) and len(value.group()) >= 6 and text[m.end()] not in "=>"


def test_candidates_against_plain_python(spark):
    rng = random.Random(12)
    pieces = ["password", "api_key", "=", ": ", " ", "  ", "\n", "\"", "hunter22!x", "abc", ",", ";", "x" * 20,
              "a/b-c.d_e+f=g1234", "é", "Token", "plain words here", "0123456789abcdef"]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(1, 25))) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {i: [] for i in range(len(texts))}
    for r in secret_scan.scan(docs).collect():
        got[r.id].append((r.start, r.end, r.assigned))
    for i, text in enumerate(texts):
        assert sorted(got[i]) == by_hand(text), repr(text)


def test_coverage_and_features_against_plain_python(spark):
    rng = random.Random(13)
    rows = [(i, " ".join(rng.sample(WORDS, 4)) + " " + "".join(rng.choices("abXY01_-/.", k=24)) + "handler9returns x")
            for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = {w for w in WORDS if sum(w in re.split("[^a-z]+", t.lower()) for _, t in rows) >= 10}
    assert {r.word for r in secret_scan.dictionary(docs).collect()} >= known
    words = {r.word for r in secret_scan.dictionary(docs).collect()}
    spans = secret_scan.features(secret_scan.coverage(secret_scan.scan(docs), secret_scan.dictionary(docs))).collect()
    assert spans
    for r in spans:
        v = r.value
        parts = re.findall("[a-z]{3,20}", v.lower())
        letters = sum(c.isascii() and c.isalpha() for c in v)
        classes = "".join("a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else c for c in v)
        want = {"length": len(v), "digits": sum(c.isdigit() for c in v) / len(v), "distinct": len(set(v)),
                "switches": sum(a != b for a, b in zip(classes, classes[1:])),
                "coverage": sum(len(w) for w in parts if w in words) / max(letters, 1),
                "longest_word": max((len(w) for w in parts if w in words), default=0), "slashes": v.count("/"),
                "dots": v.count("."), "longest_digits": max(map(len, re.split("[^0-9]+", v)))}
        for k, x in want.items():
            assert r[f"f_{k}"] == pytest.approx(x), (k, v)


def text_with(rng, value, how):
    a, b = (" ".join(rng.sample(WORDS, 4)) for _ in range(2))
    return f"{a} {how.format(value)} {b}"


def random_value(rng, kind):
    hexed = lambda n: "".join(rng.choices("0123456789abcdef", k=n))
    if kind == "secret":
        return "".join(rng.choices("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghjkmnpqrstuvwxyz23456789", k=rng.randrange(24, 41)))
    if kind == "uuid":
        return "-".join(hexed(n) for n in (8, 4, 4, 4, 12))
    if kind == "slug":      # a name with a date: the rules take it for random where it is assigned
        return "-".join([*rng.sample(WORDS[1:6], 2), str(rng.randrange(2015, 2025)), f"{rng.randrange(1, 13):02}"])
    return hexed(40 if kind == "commit" else 64)


def test_labels_from_other_places(spark):
    rows = [(1, 'x api_key: "Zq8Lw2Xv7Rt5Yb3N" y'), (2, "sign in by Zq8Lw2Xv7Rt5Yb3N today"),
            (3, "sign in by Zq8Lw2Xv7Rt5Yb3N today"), (4, 'token = "Kk0Kk0Kk0Kk0Kk0K1" alone'),
            (5, "once there was 77aa88bb99cc00dd here"), (6, 'token: "changeme12345678" a'),
            (7, 'token: "changeme12345678" b')]
    rows += [(10 + i, f"see {i} for 0a1b2c3d4e5f6a7b8c9d then {i}") for i in range(5)]
    rows += [(20, "secret: 0a1b2c3d4e5f6a7b8c9d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = secret_scan.features(secret_scan.coverage(secret_scan.scan(docs), secret_scan.dictionary(docs))).cache()
    got = sorted((r.id, r.is_secret) for r in
                 secret_scan.known_findings(table).join(table, ["row", "start"]).collect())
    # Copies (2, 3) are one place; 1 is named nowhere else, and too short for a rule; the
    # dummy of 6 and 7 is no evidence; 10 to 14 are one public value, named once in 20.
    assert [x for x in got if x[0] not in (2, 3)][1:] == [(20, 0)]
    assert [x[1] for x in got if x[0] in (2, 3)] == [1]
    assert [x[1] for x in got if 10 <= x[0] < 15] == [0]


def test_forest_and_rules_on_look_alikes(spark):
    rng = random.Random(31)
    texts, held = [], {}
    for _ in range(80):
        value = random_value(rng, "secret")
        texts += [text_with(rng, value, rng.choice(['api_key: "{}"', "db_password={}", "auth := '{}'"])),
                  text_with(rng, value, rng.choice(["use {} there", "with {} now", "key is {} for it"]))]
    for kind, how in (("uuid", "request {}"), ("commit", "commit {}"), ("commit", "fixed by {}"),
                      ("digest", "sha256 {}"), ("slug", "release {}")):
        for _ in range(30):
            value = random_value(rng, kind)
            texts += [text_with(rng, value, rng.choice([how, "see {}", "from {}"])) for _ in range(6)]
            if kind == "slug":
                texts.append(text_with(rng, value, 'token = "{}"'))
    for kind, how in (("secret", "log in by {} or"), ("secret", 'secret = "{}"'), ("uuid", "trace {}"),
                      ("commit", "reverted in {}"), ("digest", "sum of it {}"), ("slug", 'secret = "{}"')):
        for _ in range(60):
            value = random_value(rng, kind)
            if any(value in t for t in texts):
                continue        # a slug that the fit has seen
            held[value] = (kind, kind == "secret")
            texts.append(text_with(rng, value, how))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table = secret_scan.features(secret_scan.coverage(secret_scan.scan(docs), secret_scan.dictionary(docs)))
    rules = {r.value: r.rule in ("format", "assigned") for r in secret_scan.sure(table).collect() if r.value in held}
    forest = {r.value: r.is_secret for r in secret_scan.find(docs).collect() if r.value in held}
    assert set(rules) == set(forest) == set(held)

    def figures(said):
        hits = sum(said[v] and true for v, (_, true) in held.items())
        return hits / sum(true for _, true in held.values()), hits / max(sum(said.values()), 1)

    recall, precision = figures(forest)
    rule_recall, rule_precision = figures(rules)
    wrong = sorted(kind for v, (kind, true) in held.items() if forest[v] != true)
    print("forest", recall, precision, "rules", rule_recall, rule_precision, "wrong", wrong)
    assert recall >= 0.9 and precision >= 0.95
    assert recall > rule_recall and precision > rule_precision
