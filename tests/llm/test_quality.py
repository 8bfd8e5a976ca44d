import math
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from palmyra.llm import quality
from tests.llm.helpers import words as terms_of

COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
           "base_failed", "kept"]
SCHEMA = "doc_id long, text string, lang string, n_words string, classes int, grp long"


def base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(w, w[1:], w[2:]))
    again = set()
    for i, x in enumerate(zip(w, w[1:], w[2:])):
        if windows[x] > 1:
            again.update((i, i + 1, i + 2))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(again))


def histogram(text):
    out = [0] * quality.N_CLASSES
    for c in text or "":
        lead = c.encode()[0]
        out[next((i for i, m in enumerate(quality.CLASSES.values()) if lead in m), -1)] += 1
    return out


def js(p, q):
    def gain(x, y):
        return x * math.log2(2 * x / (x + y)) if x else 0.0
    return math.sqrt(min(max(sum(gain(x, y) + gain(y, x) for x, y in zip(p, q)) / 2, 0), 1))


def by_hand(rows, words=quality.COMMON_WORDS, least_docs=quality.LEAST_DOCS):
    """Verdicts of (doc_id, text, lang) rows, in plain Python."""
    unit = quality.SHARE
    by_lang = defaultdict(list)
    for r in rows:
        by_lang[r[2]].append(r)
    out = []
    for own in by_lang.values():
        share = Counter()
        for _, text, _ in own:
            t = terms_of(text)
            for x, n in Counter(t).items():
                share[x] += n * (unit // len(t))
        n_texts = max(sum(bool(t) for _, t, _ in own), 1)
        top = [(x, v / (n_texts * unit)) for x, v in
               sorted(share.items(), key=lambda kv: (-kv[1], kv[0].encode()))[:words]]
        rest = max(1 - sum(v for _, v in top), 0)
        facts = []
        for _, text, _ in own:
            b, h = base(text), histogram(text)
            failed = b[0] < 50 or 100 * b[4] > 50 * b[0]
            facts.append((b, failed, [x / max(sum(h), 1) for x in h], sum(h)))

        def mean(shares):
            return [sum(math.floor(s[i] * unit) for s in shares) / (len(shares) * unit)
                    for i in range(quality.N_CLASSES)] if shares else None
        sound = [f[2] for f in facts if not f[1]]
        reference = mean(sound)
        if reference:
            steps = sorted(math.floor(js(s, reference) * quality.STEPS) for s in sound)
            median = steps[(len(steps) + 1) // 2 - 1]
            near = [s for s in sound if math.floor(js(s, reference) * quality.STEPS) <= median]
            reference = mean(near) if len(near) >= least_docs else None
        for (i, text, _), (b, failed, shares, n) in zip(own, facts):
            far = False
            if reference:
                bins = sum(x >= 0.001 for x in reference)
                far = js(shares, reference) > quality.CLASS_MARGIN + math.sqrt(bins / (8 * math.log(2) * max(n, 1)))
                t = terms_of(text)
                if len(t) >= 100:
                    c = Counter(t)
                    p = [c[x] / len(t) for x, _ in top]
                    q = [v for _, v in top] + [rest]
                    p.append(1 - sum(p))
                    far |= js(p, q) > quality.WORD_MARGIN + math.sqrt(sum(v > 0 for v in q) / (8 * math.log(2) * len(t)))
            out.append((i, *b, failed, not failed and not far))
    return out


def key(r):
    return tuple((v is None, str(v)) for v in r)


def judged(spark, rows, **options):
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    return quality.judge(docs, **options).select(*COLUMNS)


def sentences(seed, n, vocabulary):
    rng = random.Random(seed)
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    return " ".join(rng.choices(vocabulary, weights, k=n))


def corpus():
    rng = random.Random(1)
    en = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 7))) for _ in range(400)]
    de = ["".join(rng.choices("äöüßklmrstun", k=rng.randint(2, 7))) for _ in range(400)]
    rows = [(i, sentences(i, 60 + 7 * i, en) + ".\nEnd", "en") for i in range(60)]
    rows += [(100 + i, sentences(i, 150, de), "de") for i in range(40)]
    rows += [(200, sentences(7, 300, en).upper() + "!!", "en"),         # shouting
             (201, " ".join(x + "***" for x in sentences(8, 200, en).split()), "en"),
             (202, " | ".join("".join(rng.choices("abcdefghijklmnop", k=9)) for _ in range(300)), "en"),
             (203, "spam spam eggs " * 100, "en"),
             (204, sentences(9, 200, de), "en"),                         # wrong language
             (205, " ".join(str(rng.random()) for _ in range(200)), "de")]
    rows += [(300, None, "en"), (301, "", "en"), (302, "   \n \t\r", "en"), (None, "no id here", None),
             (303, "line one\nline two\nline one\n\n \nline one", None), (303, "line one", None),
             (304, sentences(3, 30_000, en), "en"), (305, "x\x0by\x0cz w v \U0001F600 é", "zz"),
             (306, sentences(5, 80, en), "zz")]
    return rows + rows[3:5]


def test_against_brute_force(spark):
    rows = corpus()
    got = sorted(map(tuple, judged(spark, rows).collect()), key=key)
    assert got == sorted(by_hand(rows), key=key)
    kept = {r[0]: r[-1] for r in got}
    assert all(kept[i] for i in [*range(60), *range(100, 140), 304, 306])
    assert not any(kept[i] for i in (200, 201, 202, 203, 204, 205, 300, 301, 302, 303))


def test_rounds_of_languages_change_nothing(spark):
    rows = corpus()
    assert sorted(map(tuple, judged(spark, rows, max_langs=1).collect()), key=key) \
        == sorted(by_hand(rows), key=key)


def test_few_documents_have_no_reference(spark):
    rows = [(i, "word " + " ".join(f"w{i}x{j}" for j in range(60)), "en") for i in range(3)]
    assert all(r.kept for r in judged(spark, rows).collect())


def test_labelled_documents(spark, sf0001):
    docs = spark.read.parquet(f"{sf0001.replace('sf0.001', 'sf0.01')}/documents.parquet")
    labels = spark.read.parquet(f"{sf0001.replace('sf0.001', 'sf0.01')}/labels.parquet")
    rows = quality.judge(docs).join(labels, "doc_id").where("NOT base_failed").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_empty_table(spark):
    assert judged(spark, []).collect() == []


@pytest.mark.parametrize("text", ["a b c a b c", "a a a a", "a b", "x y z q x y z", "1 2 3 4 2 3 4 1 2 3"])
def test_repeated_windows_and_lines(text):
    measures, classes = (x[0] for x in zip(*quality.base_measures(pa.array([text, "tail a b c"]))))
    assert tuple(measures[0]) == base(text) and list(classes[0]) == histogram(text)
