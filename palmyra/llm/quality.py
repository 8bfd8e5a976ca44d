"""Quality rules with a divergence test against language references.

Words are ``[^\\x20\\x09-\\x0D]+``. The base rules fail a text of fewer than
``LEAST_WORDS`` words, or one where more than half of the words lie in three-word
windows that the text holds twice or more. A text that passes them is compared with
the references of its language, by the Jensen-Shannon distance (base 2, 0 to 1), in two
histograms: character classes, and the language's common words (words
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lowered; all others are one bin).

References come from the corpus itself:

* Common words: per language the ``COMMON_WORDS`` words with the largest mean share of a
  document's words, over all documents, so one long or repetitive text weighs no more
  than any other.
* Character classes: the mean histogram of the documents that pass the base rules,
  taken again over the half of them that is nearest to it, so that junk does not pull
  the reference to itself.

Shares are summed as integers, so the references don't depend on the order of rows.

Minimum-length guards: a sample of n from a histogram of b bins lies about
``sqrt(b / (8 ln 2 n))`` from it by chance alone, so a text may be that much farther away
than the margin; common words are compared from ``LEAST_WORDS_COMMON`` words on only,
and a language with fewer than ``LEAST_DOCS`` reference documents has no reference: its
texts go by the base rules.

Cases: a null or empty text has no words and fails the base rules; a null language is a
language of its own; null ids and rows that repeat an id are judged row by row; an empty
table gives no rows; only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palmyra.llm.common import all_bytes_but, give_back, gram_hashes, iter_words, mix64
from palmyra.sources.writers import cut_lineage

LEAST_WORDS = 50
MOST_REPEATED = 0.5
COMMON_WORDS = 100
LEAST_WORDS_COMMON = 100
LEAST_DOCS = 20
#: Distances beyond what chance explains.
CLASS_MARGIN = 0.12
WORD_MARGIN = 0.15
#: Languages whose common words are sent to the workers at once (about 4 MB); with more
#: of them the documents are measured in rounds, each language's in one.
MAX_LANGS = 2_000
#: Shares are summed in these units.
SHARE = 1 << 30
#: Steps of the distance when its median is counted out.
STEPS = 2_000

BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = b"#*$%&|<>"
#: Character classes by (lead) byte; what no entry names is "other". Fixed values.
CLASSES = {
    "lower": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789", "blank": b" \t", "line": b"\n\r\x0b\x0c", "stop": b".,;:",
    "call": b"!?", "bracket": b"'\"()[]{}-/", "symbol": SYMBOLS, "sign": b"+=@_^~`\\",
    "latin": bytes(range(0xC2, 0xCA)), "two": bytes(range(0xCA, 0xE0)),
    "three": bytes(range(0xE0, 0xF0)), "four": bytes(range(0xF0, 0xF8)),
}
N_CLASSES = len(CLASSES) + 1
_CLASS = np.full(256, N_CLASSES - 1, dtype=np.int64)
for _i, _members in enumerate(CLASSES.values()):
    _CLASS[list(_members)] = _i
_IS_SYMBOL = np.zeros(256, dtype=bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_CODE_POINT = np.ones(256, dtype=bool)
_CODE_POINT[0x80:0xC0] = False

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURED = (f"id long, grp string, {', '.join(f'{m} long' for m in MEASURES)}, "
            "classes array<long>, word_distance double, word_bins int, n_terms long")


def _per_row(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``marks`` between each two neighbouring bounds."""
    total = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _apart(hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Hashes that are equal only within a row."""
    return mix64(hashes + mix64(row.astype(np.uint64) + np.uint64(1)))


def repeated_words(hashes: np.ndarray, first: np.ndarray, window: int = 3) -> np.ndarray:
    """Per row, the words in windows that the row holds twice or more."""
    n, row = len(hashes), np.repeat(np.arange(len(first) - 1), np.diff(first))
    covered = np.zeros(n + 1, dtype=np.int64)
    if n >= window:
        at = np.flatnonzero(row[:n - window + 1] == row[window - 1:])
        _, back, counts = np.unique(_apart(gram_hashes(hashes, window)[at], row[at]),
                                    return_inverse=True, return_counts=True)
        twice = at[counts[back] > 1]
        np.add.at(covered, twice, 1)
        np.add.at(covered, twice + window, -1)
    return _per_row(np.cumsum(covered[:-1]) > 0, first)


def base_measures(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(measures, character classes) of runs of texts, a row a text."""
    lines = iter_words(texts, all_bytes_but(b"\n"), lower=False)
    for w, ln in zip(iter_words(texts, all_bytes_but(BLANKS), lower=False), lines):
        n = w.hi - w.lo
        points = _CODE_POINT[w.data]
        upto = np.concatenate([[0], np.cumsum(points, dtype=np.int64)])
        has_word = np.searchsorted(w.starts, ln.ends) > np.searchsorted(w.starts, ln.starts)
        row = np.repeat(np.arange(n), np.diff(ln.first))[has_word]
        distinct = np.unique(_apart(ln.hashes[has_word], row), return_index=True)[1]
        n_lines = np.bincount(row, minlength=n) - np.bincount(row[distinct], minlength=n)
        measures = np.stack([np.diff(w.first), _per_row(upto[w.ends] - upto[w.starts], w.first),
                             _per_row(_IS_SYMBOL[w.data], w.rows), n_lines,
                             repeated_words(w.hashes, w.first)], axis=1)
        of = np.repeat(np.arange(n) * N_CLASSES, np.diff(w.rows))[points] + _CLASS[w.data[points]]
        yield measures, np.bincount(of, minlength=n * N_CLASSES).reshape(n, N_CLASSES)


def group_of(lang_col: str) -> Column:
    """Key of a language that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(lang_col)), F.lit(""))


def common_words(docs: DataFrame, lang_col: str = "lang", text_col: str = "text",
                 words: int = COMMON_WORDS) -> DataFrame:
    """(grp, word, share): the words of each language with the largest mean share."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("grp").to_pylist()
            for w in iter_words(batch.column("text")):
                sizes = np.diff(w.first)
                codes = {g: i for i, g in enumerate(dict.fromkeys(names[w.lo:w.hi]))}
                code = np.array([codes[g] for g in names[w.lo:w.hi]], dtype=np.uint64)
                word, at, back = np.unique(w.hashes, return_index=True, return_inverse=True)
                key = np.repeat(code, sizes) * np.uint64(len(word)) + back.astype(np.uint64)
                share = np.repeat(SHARE // np.maximum(sizes, 1), sizes)
                found, back = np.unique(key, return_inverse=True)
                total = np.zeros(len(found), dtype=np.int64)
                np.add.at(total, back, share)
                which = (found % np.uint64(max(len(word), 1))).astype(np.int64)
                spelled = [w.data[a:b].tobytes().decode("utf-8", "replace")
                           for a, b in zip(w.starts[at], w.ends[at])]
                of = list(codes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([of[int(k)] for k in found // np.uint64(max(len(word), 1))], pa.string()),
                     pa.array([spelled[i] for i in which], pa.string()), pa.array(total)],
                    names=["grp", "word", "share"])
        give_back()

    rows = docs.select(group_of(lang_col).alias("grp"), F.col(text_col).alias("text"))
    counted = (rows.mapInArrow(run, "grp string, word string, share long")
               .groupBy("grp", "word").agg(F.sum("share").alias("share")))
    rank = F.row_number().over(Window.partitionBy("grp").orderBy(F.desc("share"), "word"))
    top = counted.withColumn("rank", rank).where(F.col("rank") <= words).select("grp", "word", "share")
    sizes = rows.groupBy("grp").agg(F.sum((F.length(F.coalesce("text", F.lit(""))) > 0).cast("long")).alias("n"))
    return top.join(sizes, "grp").select(
        "grp", "word", (F.col("share") / (F.greatest("n", F.lit(1)) * SHARE)).alias("share"))


@dataclass
class WordReference:
    """Common words of some languages, as the workers use them."""

    keys: np.ndarray        # sorted hashes of (language, word)
    bins: np.ndarray        # bin of each key
    shares: np.ndarray      # a row a language, the last bin for all other words
    lang: dict[str, int]

    @staticmethod
    def of(rows: list, bins: int) -> WordReference:
        lang = {g: i for i, g in enumerate(sorted({r.grp for r in rows}))}
        shares = np.zeros((len(lang) + 1, bins + 1))
        used = np.zeros(len(lang), dtype=np.int64)
        at, bin_of = [], []
        for r in rows:
            i = lang[r.grp]
            shares[i, used[i]] = r.share
            at.append(i)
            bin_of.append(used[i])
            used[i] += 1
        shares[:, -1] = np.maximum(1 - shares[:, :-1].sum(axis=1), 0)
        spelled = pa.array([r.word for r in rows], pa.string())
        hashes = np.concatenate([w.hashes for w in iter_words(spelled)] or [np.empty(0, np.uint64)])
        keys = _apart(hashes, np.array(at, dtype=np.int64))
        order = np.argsort(keys)
        return WordReference(keys[order], np.array(bin_of, dtype=np.int64)[order], shares, lang)

    def distances(self, texts: pa.Array, names: list[str]) -> Iterator[tuple[np.ndarray, ...]]:
        """(distance, bins, words) of runs of texts; no distance without a reference."""
        width = self.shares.shape[1]
        for w in iter_words(texts):
            lang = np.array([self.lang.get(g, -1) for g in names[w.lo:w.hi]], dtype=np.int64)
            sizes = np.diff(w.first)
            bins = np.full(len(w.hashes), width - 1)
            if len(self.keys):
                keys = _apart(w.hashes, np.repeat(lang, sizes))
                at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
                bins = np.where(self.keys[at] == keys, self.bins[at], width - 1)
            row = np.repeat(np.arange(len(sizes)) * width, sizes)
            counts = np.bincount(row + bins, minlength=len(sizes) * width).reshape(len(sizes), width)
            found = js_distance(counts / np.maximum(sizes, 1)[:, None], self.shares[lang])
            yield (np.where((sizes > 0) & (lang >= 0), found, np.nan),
                   (self.shares[lang] > 0).sum(axis=1), sizes)


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each two rows, base 2."""
    middle = (p + q) / 2

    def gain(x):
        return np.where(x > 0, x * np.log2(np.where(x > 0, x, 1) / np.where(x > 0, middle, 1)), 0).sum(axis=1)
    return np.sqrt(np.clip((gain(p) + gain(q)) / 2, 0, 1))


def measure(docs: DataFrame, reference: list, bins: int, id_col: str, lang_col: str, text_col: str
            ) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(WordReference.of(reference, bins))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, names = batch.column("text"), batch.column("grp").to_pylist()
            parts = list(base_measures(texts))
            if not parts:
                continue
            words = [np.concatenate(x) for x in zip(*shared.value.distances(texts, names))]
            measures, classes = (np.concatenate(x) for x in zip(*parts))
            offsets = pa.array(np.arange(0, classes.size + 1, N_CLASSES, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("grp"), *(pa.array(m) for m in measures.T.copy()),
                 pa.ListArray.from_arrays(offsets, pa.array(classes.ravel())),
                 pa.array(words[0], pa.float64(), from_pandas=True), pa.array(words[1].astype(np.int32)),
                 pa.array(words[2])],
                names=["id", "grp", *MEASURES, "classes", "word_distance", "word_bins", "n_terms"])
        give_back()

    return docs.select(F.col(id_col).cast("long").alias("id"), group_of(lang_col).alias("grp"),
                       F.col(text_col).alias("text")).mapInArrow(run, MEASURED)


def _distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares, as a SQL expression."""
    def gain(x, other):
        return F.when(x > 0, x * F.log2(2 * x / (x + other))).otherwise(0.0)
    each = F.zip_with(p, q, lambda x, y: gain(x, y) + gain(y, x))
    total = F.aggregate(each, F.lit(0.0), lambda a, x: a + x) / 2
    return F.sqrt(F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0)))


def _shares() -> Column:
    total = F.greatest(F.aggregate("classes", F.lit(0).cast("long"), lambda a, x: a + x), F.lit(1))
    return F.transform("classes", lambda x: x / total)


def _mean(rows: DataFrame) -> DataFrame:
    """(grp, reference, n): mean character classes of a language."""
    units = [F.sum(F.floor(F.col("shares")[i] * SHARE)).alias(f"s{i}") for i in range(N_CLASSES)]
    return rows.groupBy("grp").agg(F.count("*").alias("n"), *units).select(
        "grp", "n", F.array(*(F.col(f"s{i}") / (F.col("n") * SHARE) for i in range(N_CLASSES)))
        .alias("reference"))


def class_reference(measured: DataFrame) -> DataFrame:
    """(grp, reference, n) over the half of a language's sound documents that is nearest
    to the mean of all of them."""
    sound = measured.where(~F.col("base_failed")).select("grp", _shares().alias("shares"))
    first = cut_lineage(_mean(sound), "quality-mean")
    near = sound.join(first, "grp").select(
        "grp", "shares", F.floor(_distance(F.col("shares"), F.col("reference")) * STEPS).alias("step"))
    # At most STEPS + 1 rows a language, however many documents it has.
    upto = Window.partitionBy("grp").orderBy("step")
    median = cut_lineage(near.groupBy("grp", "step").agg(F.count("*").alias("m"))
              .withColumn("upto", F.sum("m").over(upto))
              .withColumn("all", F.sum("m").over(Window.partitionBy("grp")))
              .where(F.col("upto") * 2 >= F.col("all")).groupBy("grp").agg(F.min("step").alias("median")),
              "quality-median")
    return _mean(near.join(median, "grp").where("step <= median"))


def allowance(bins: Column, n: Column) -> Column:
    """How far a sample of n from a histogram of that many bins lies by chance."""
    return F.sqrt(bins / (8 * math.log(2) * F.greatest(n, F.lit(1))))


def judge(docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text",
          class_margin: float = CLASS_MARGIN, word_margin: float = WORD_MARGIN,
          least_words: int = LEAST_WORDS, least_docs: int = LEAST_DOCS, words: int = COMMON_WORDS,
          max_langs: int = MAX_LANGS) -> DataFrame:
    """One row per document: id, the measures, base_failed, kept, and the distances with
    their limits (null where a guard leaves them out)."""
    common = cut_lineage(common_words(docs, lang_col, text_col, words), "quality-words")
    rounds = max(1, -(-common.select("grp").distinct().count() // max_langs))
    part = lambda g: F.pmod(F.xxhash64(g), F.lit(rounds))
    measured = reduce(DataFrame.unionByName, [
        measure(docs.where(part(group_of(lang_col)) == r) if rounds > 1 else docs,
                common.where(part("grp") == r).orderBy("grp", F.desc("share"), "word").collect(),
                words, id_col, lang_col, text_col) for r in range(rounds)])
    failed = (F.col("n_words") < least_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * int(100 * MOST_REPEATED))
    measured = cut_lineage(measured.withColumn("base_failed", failed), "quality-measures")
    reference = cut_lineage(class_reference(measured).where(F.col("n") >= least_docs), "quality-classes")
    bins = F.size(F.filter("reference", lambda x: x >= 0.001))
    n_chars = F.aggregate("classes", F.lit(0).cast("long"), lambda a, x: a + x)
    rows = measured.join(reference, "grp", "left").select(
        F.col("id").alias(id_col), *MEASURES, "base_failed",
        F.when(F.col("reference").isNotNull(), _distance(_shares(), F.col("reference"))).alias("class_distance"),
        (class_margin + allowance(bins, n_chars)).alias("class_limit"),
        F.when(F.col("reference").isNotNull() & (F.col("n_terms") >= LEAST_WORDS_COMMON),
               F.col("word_distance")).alias("word_distance"),
        (word_margin + allowance(F.col("word_bins"), F.col("n_terms"))).alias("word_limit"))
    far = (F.coalesce(F.col("class_distance") > F.col("class_limit"), F.lit(False))
           | F.coalesce(F.col("word_distance") > F.col("word_limit"), F.lit(False)))
    return rows.withColumn("kept", ~F.col("base_failed") & ~far)
