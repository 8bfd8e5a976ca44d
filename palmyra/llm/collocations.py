"""Phrase collocations by vertical partitioning of the word suffix tree.

A-Z is lower-cased, a text is split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and these into
words ``[^\\x20\\x09]+``. Every word position starts a suffix of its piece, cut off after
three words. The tree of all suffixes of a language has a phrase at each node, and a
phrase's count is the total of the leaves below it. The tree is built in parts, as ERA
does it:

1. Words are counted per language. One that occurs fewer than ``least`` times ends a
   suffix, as no candidate holds it.
2. Vertical partitioning: a word whose suffixes exceed the memory budget is extended to
   prefixes of two words, one of these to three. Prefixes are grouped, along the order of
   their hashes, into groups within the budget (a histogram of fixed size over the hash
   range says where to cut).
3. A task that scans texts sorts the suffixes of about a million positions and sends each
   group its part of them, with counts: a suffix that repeats is sent once.
4. Each group is built by itself: its parts are merged, and the totals over leaves that
   share one, two and three words are the counts. A node hands its ancestors' totals
   along, so the counts of a phrase's first parts need no lookup.

Rests of phrases (their last word or two) are looked up by joins whose hot keys are
spread. Scores are exact: the products are decimals. Candidates that lie inside a
candidate of three words with enough of their occurrences go. Of each language the first
``top`` remain; each task passes on no more than that.

Words go by 64-bit hashes of language and word. Should two words of the corpus share one,
which the run looks for, all words are hashed anew by another function.

Cases: null and empty texts have no words; a null language counts as ``und``; rows that
repeat count each; ties in the order go by phrase, which is unique in a language; an
empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palmyra.llm.common import (Words, all_bytes_but, bloom_has, bloom_of, give_back, iter_words,
                                mix64)
from palmyra.operators.skew import spread_join
from palmyra.sources.writers import cut_lineage

U64 = np.uint64
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = b"\x20\x09"
LEAST = 10
TOP = 2_000
#: Per cent of a phrase's occurrences that a longer one must hold to replace it.
INSIDE = 50
#: Suffixes of a group, while that needs no more than MAX_GROUPS groups.
BUDGET = 1_000_000
MAX_GROUPS = 1 << 18
#: Positions that are sorted together before they are sent.
SLICE = 1 << 20      # their words are numbered in 21 bits
BLOOM_BITS = 1 << 26
#: Longer words are always hashed by the second function.
LONG_WORD = 256

_IN_WORD = all_bytes_but(BREAKS + BLANKS)
_BREAK = np.zeros(256, dtype=bool)
_BREAK[list(BREAKS)] = True
NODES = "h1 long, h2 long, h3 long, a long, l1 long, l2 long"


def _strong(word: bytes, salt: int) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8, salt=salt.to_bytes(8, "little")).digest(),
                          "little")


def hashes_of(w: Words, langs: list[str], attempt: int) -> np.ndarray:
    """Hash of each word and its language; never 0, which stands for a suffix's end."""
    sizes = np.diff(w.first)
    code = {g: _strong(g.encode(), attempt) for g in set(langs[w.lo:w.hi])}
    lang = np.repeat(np.array([code[g] for g in langs[w.lo:w.hi]], dtype=U64), sizes)
    base = w.hashes
    again = np.arange(len(base)) if attempt else np.flatnonzero(w.ends - w.starts > LONG_WORD)
    if len(again):
        base, seen = base.copy(), {}
        for i, a, b in zip(again.tolist(), w.starts[again].tolist(), w.ends[again].tolist()):
            word = w.data[a:b].tobytes()
            if word not in seen:
                seen[word] = _strong(word, attempt)
            base[i] = seen[word]
    out = mix64(base + mix64(lang))
    out[out == 0] = 1
    return out


def _goes_on(w: Words) -> np.ndarray:
    """Whether the next word is in the same piece."""
    n = len(w.starts)
    row = np.repeat(np.arange(w.hi - w.lo), np.diff(w.first))
    piece = np.cumsum(_BREAK[w.data], dtype=np.int64)[w.starts] if n else np.empty(0, np.int64)
    out = np.zeros(n, dtype=bool)
    out[:-1] = (row[1:] == row[:-1]) & (piece[1:] == piece[:-1])
    return out


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[Words, list[str]]]:
    langs = batch.column("grp").to_pylist()
    for w in iter_words(batch.column("text"), _IN_WORD):
        yield w, langs


def _rows(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("grp"),
                       F.col(text_col).alias("text"))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).astype(U64).view(np.int64))


def count_words(rows: DataFrame, attempt: int) -> DataFrame:
    """(grp, word, h, n) of every word of every language. A task hands on each word once
    a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, counts, places, texts = [], [], [], []
            for w, langs in _runs(batch):
                word, at, n = np.unique(hashes_of(w, langs, attempt), return_index=True,
                                        return_counts=True)
                row = np.searchsorted(w.first, at, side="right") - 1 + w.lo
                hashes.append(word)
                counts.append(n)
                places.append(np.stack([np.full(len(at), len(texts)), w.starts[at], w.ends[at], row], axis=1))
                texts.append(w.data)
            if not hashes:
                continue
            word, at, back = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
            n = np.bincount(back, np.concatenate(counts), minlength=len(word)).astype(np.int64)
            place = np.concatenate(places)[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array([langs[i] for i in place[:, 3].tolist()], pa.string()),
                 pa.array([texts[t][a:b].tobytes().decode("utf-8", "replace")
                           for t, a, b, _ in place.tolist()], pa.string()),
                 _signed(word), pa.array(n)], names=["grp", "word", "h", "n"])
        give_back()

    return (rows.mapInArrow(run, "grp string, word string, h long, n long")
            .groupBy("grp", "word", "h").agg(F.sum("n").alias("n")))


def _pair(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    return mix64(h1 * U64(0x9E3779B97F4A7C15) + h2)


def _among(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), dtype=bool)
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return sorted_values[at] == x


@dataclass
class Plan:
    """What a scanning or building task knows: prefixes beyond the budget with their
    counts, and the group of each part of the hash range. Of bounded size."""

    attempt: int
    frequent: bytes             # Bloom filter of the words that occur often enough
    heavy: np.ndarray           # sorted hashes of words beyond the budget
    heavy_n: np.ndarray
    heavy_pairs: np.ndarray     # sorted keys of two-word prefixes beyond it
    heavy_pairs_n: np.ndarray
    group: np.ndarray           # group of each bucket of prefix keys

    def group_of(self, h1: np.ndarray, h2: np.ndarray, h3: np.ndarray) -> np.ndarray:
        one, two = _among(self.heavy, h1), _pair(h1, h2)
        three = one & _among(self.heavy_pairs, two)
        key = np.where(three, _pair(two, h3), np.where(one, two, h1))
        bits = max(int(len(self.group)).bit_length() - 1, 0)
        return self.group[(key >> U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(key), np.int64)]

    def leaves(self, h: np.ndarray, on: np.ndarray, only_heavy: bool = False) -> tuple[np.ndarray, ...]:
        """(h1, h2, h3, n): suffixes of the positions, each once with its count, but for
        the last two, which are there for those before them. Words that occur too rarely
        end a suffix (0), and none begins with them. ``only_heavy``: just two words, of
        prefixes beyond the budget."""
        word, code = np.unique(h, return_inverse=True)
        often = bloom_has(np.frombuffer(self.frequent, dtype=U64), word)
        word = np.concatenate([np.zeros(1, U64), word[often]])
        code = np.where(often, np.cumsum(often), 0)[code]       # below 2 ** 21: see SLICE
        after = np.zeros_like(code)
        after[:-1] = np.where(on[:-1], code[1:], 0)
        third = np.zeros_like(code)
        third[:-1] = np.where(after[:-1] > 0, after[1:], 0)
        c1, c2, c3 = code[:-2], after[:-2], third[:-2]
        heavy = _among(self.heavy, word)[c1]
        if only_heavy:
            keep, c3 = heavy & (c2 > 0), np.zeros_like(c3)
        else:
            # A prefix beyond the budget has its total already: its ends count for nothing.
            keep = (c1 > 0) & ~(heavy & (c2 == 0))
            ends = np.flatnonzero(heavy & (c2 > 0) & (c3 == 0))
            keep[ends[_among(self.heavy_pairs, _pair(word[c1[ends]], word[c2[ends]]))]] = False
        packed, n = np.unique((c1[keep] << 42) | (c2[keep] << 21) | c3[keep], return_counts=True)
        low = (1 << 21) - 1
        return word[packed >> 42], word[(packed >> 21) & low], word[packed & low], n.astype(np.int64)


def _slices(batches: Iterator[pa.RecordBatch], attempt: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes, whether the next word is in the same piece) of about SLICE positions, and
    two more: those that follow, or nothing."""
    hashes, goes_on, held = [], [], 0

    def cut():
        h = np.concatenate([*hashes, np.zeros(2, U64)])
        on = np.concatenate([*goes_on, np.zeros(2, dtype=bool)])
        for lo in range(0, len(h) - 2, SLICE):
            yield h[lo:lo + SLICE + 2], on[lo:lo + SLICE + 2]

    for batch in batches:
        for w, langs in _runs(batch):
            hashes.append(hashes_of(w, langs, attempt))
            goes_on.append(_goes_on(w))
            held += len(hashes[-1])
            if held >= SLICE:
                yield from cut()
                hashes, goes_on, held = [], [], 0
    if held:
        yield from cut()


def pair_counts(rows: DataFrame, plan: Broadcast) -> DataFrame:
    """(h1, h2, key, n) of the two-word prefixes that begin with a word beyond the budget."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p: Plan = plan.value
        for h, on in _slices(batches, p.attempt):
            h1, h2, _, n = p.leaves(h, on, only_heavy=True)
            yield pa.RecordBatch.from_arrays(
                [_signed(h1), _signed(h2), _signed(_pair(h1, h2)), pa.array(n)],
                names=["h1", "h2", "key", "n"])
        give_back()

    return (rows.mapInArrow(run, "h1 long, h2 long, key long, n long")
            .groupBy("h1", "h2", "key").agg(F.sum("n").alias("n")))


def merged(h1: np.ndarray, h2: np.ndarray, h3: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Leaves of a subtree, in the order of their words, each once with its total."""
    order = np.lexsort((h3, h2, h1))
    h1, h2, h3, n = h1[order], h2[order], h3[order], n[order]
    new = np.ones(len(h1), dtype=bool)
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]) | (h3[1:] != h3[:-1])
    at = np.flatnonzero(new)
    return h1[at], h2[at], h3[at], np.add.reduceat(n, at) if len(at) else n


def _part_rows(plan: Plan, leaves: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    """One row a group: its leaves of a slice, as four columns of 64-bit numbers."""
    group = plan.group_of(*leaves[:3])
    order = np.argsort(group, kind="stable")
    group = group[order]
    at = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.empty(0, np.int64)
    offsets = pa.py_buffer((np.r_[at, len(group)] * 8).astype(np.int32).tobytes())
    columns = [pa.Array.from_buffers(pa.binary(), len(at), [None, offsets, pa.py_buffer(
        np.ascontiguousarray(x[order]).tobytes())]) for x in leaves]
    return pa.RecordBatch.from_arrays([pa.array(group[at].astype(np.int32)), *columns],
                                      names=["part", "b1", "b2", "b3", "n"])


def scan_suffixes(rows: DataFrame, plan: Broadcast) -> DataFrame:
    """(part, b1, b2, b3, n): sorted, counted suffixes of the scanned positions by group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p: Plan = plan.value
        for h, on in _slices(batches, p.attempt):
            yield _part_rows(p, p.leaves(h, on))
        give_back()

    return rows.mapInArrow(run, "part int, b1 binary, b2 binary, b3 binary, n binary")


def _spread(totals: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Total of the run that each entry is in."""
    at = np.flatnonzero(new)
    return np.repeat(np.add.reduceat(totals, at), np.diff(np.r_[at, len(totals)]))


def nodes_of(plan: Plan, leaves: tuple[np.ndarray, ...], least: int) -> list[np.ndarray]:
    """Nodes of two and three words with at least that total, with their ancestors' ones."""
    h1, h2, h3, n = leaves
    if not len(h1):
        return [np.empty(0, np.int64)] * 6
    new1 = np.r_[True, h1[1:] != h1[:-1]]
    new2 = new1 | np.r_[True, h2[1:] != h2[:-1]]
    one, two = _spread(n, new1), _spread(n, new2)
    big = _among(plan.heavy, h1)
    if big.any():
        one = np.where(big, plan.heavy_n[np.searchsorted(plan.heavy, np.where(big, h1, plan.heavy[0]))], one)
    pair = _pair(h1, h2)
    big = big & _among(plan.heavy_pairs, pair)
    if big.any():
        at = np.searchsorted(plan.heavy_pairs, np.where(big, pair, plan.heavy_pairs[0]))
        two = np.where(big, plan.heavy_pairs_n[at], two)
    # Pairs beyond the budget lie in several groups; their nodes come from their counts.
    at2 = np.flatnonzero(new2 & (h2 != 0) & (two >= least) & ~big)
    at3 = np.flatnonzero((h3 != 0) & (n >= least))
    return [np.concatenate([x[at2], y[at3]]) for x, y in (
        (h1, h1), (h2, h2), (np.zeros_like(h3), h3), (two, n), (one, one), (two, two))]


def n_tasks(groups: int, total: int, least: int) -> int:
    """Two tasks a group, so that few of them get several; of groups far below BUDGET, which
    a task builds one after the other, as many share one as make up such a group."""
    return min(2 * groups, max(least, 4 * -(-total // BUDGET) + 2))


def build_groups(parts: DataFrame, plan: Broadcast, least: int, budget: int, total: int) -> DataFrame:
    """Build each group's subtree and return its nodes (NODES)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p: Plan = plan.value
        held: list[tuple[np.ndarray, ...]] = []
        group, size = None, 0

        def leaves():
            return merged(*(np.concatenate(x) for x in zip(*held)))

        def out():
            h1, h2, h3, a, l1, l2 = nodes_of(p, leaves(), least)
            return pa.RecordBatch.from_arrays(
                [_signed(h1), _signed(h2), _signed(h3), *(pa.array(x.astype(np.int64)) for x in (a, l1, l2))],
                names=["h1", "h2", "h3", "a", "l1", "l2"])

        for batch in batches:
            for part, *columns in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if part != group:
                    if held:
                        yield out()
                    group, held, size = part, [], 0
                held.append(tuple(np.frombuffer(c, dtype=t) for c, t in zip(columns, (U64, U64, U64, np.int64))))
                size += len(held[-1][0])
                if size > 2 * budget:       # memory goes by distinct suffixes
                    held = [leaves()]
                    size = len(held[0][0])
        if held:
            yield out()
        held.clear()
        give_back()

    tasks = n_tasks(int(plan.value.group[-1]) + 1, total,
                    int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return parts.repartition(tasks, "part").sortWithinPartitions("part").mapInArrow(run, NODES)


def _heavy(found: DataFrame, key: str) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts in the order of the (unsigned) keys."""
    got = found.select(key, "n").toArrow()
    keys = got[key].to_numpy().astype(np.int64).view(U64)
    order = np.argsort(keys)
    return keys[order], got["n"].to_numpy().astype(np.int64)[order]


def partition(spark: SparkSession, rows: DataFrame, frequent: DataFrame, attempt: int, total: int,
              budget: int) -> tuple[Broadcast, DataFrame]:
    """The plan, and the counted two-word prefixes that begin with a word beyond the budget."""
    heavy = _heavy(frequent.where(F.col("n") > budget), "h")
    none = np.empty(0, U64), np.empty(0, np.int64)
    plan = Plan(attempt, bloom_of(frequent.select("h"), BLOOM_BITS), *heavy, *none, np.zeros(1, np.int32))
    pairs = spark.createDataFrame([], "h1 long, h2 long, key long, n long")
    if len(heavy[0]):
        pairs = cut_lineage(pair_counts(rows, spark.sparkContext.broadcast(plan)), "phrase-pairs")
        plan.heavy_pairs, plan.heavy_pairs_n = _heavy(pairs.where(F.col("n") > budget), "key")
    bits = min(max((8 * total // budget).bit_length(), 8), 20)
    bucket = lambda key: F.shiftrightunsigned(key, 64 - bits)
    weights = (frequent.where(F.col("n") <= budget).select(bucket("h").alias("bucket"), "n")
               .unionByName(pairs.where(F.col("n") <= budget).select(bucket("key").alias("bucket"), "n"))
               .groupBy("bucket").agg(F.sum("n").alias("n"))).toArrow()     # at most 2 ** 20 rows
    weight = np.zeros(1 << bits, dtype=np.int64)
    weight[weights["bucket"].to_numpy()] = weights["n"].to_numpy()
    # Prefixes of three words are leaves; those of heavy pairs spread over the whole range.
    weight += -(-int(plan.heavy_pairs_n.sum()) >> bits)
    plan.group = pack(weight, budget)
    return spark.sparkContext.broadcast(plan), pairs


def pack(weight: np.ndarray, budget: int) -> np.ndarray:
    """Group of each bucket: neighbours share a group while they fit the budget."""
    group, held, out = 0, 0, np.empty(len(weight), dtype=np.int32)
    for i, w in enumerate(weight.tolist()):
        if held and held + w > budget:
            group, held = group + 1, 0
        held += w
        out[i] = group
    return out


def phrase_nodes(docs: DataFrame, lang_col: str, text_col: str, least: int, budget: int
                 ) -> tuple[DataFrame, DataFrame]:
    """(words, nodes): every word with its count, and every phrase of two or three words
    that occurs at least so often, with the counts of its first words."""
    spark, rows = docs.sparkSession, _rows(docs, lang_col, text_col)
    for attempt in range(8):
        words = cut_lineage(count_words(rows, attempt), "phrase-words")
        if not words.groupBy("h").agg(F.count("*").alias("m")).where("m > 1").limit(1).count():
            break
    else:
        raise RuntimeError("words share hashes under every function tried")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    budget = max(budget, -(-total // MAX_GROUPS))
    frequent = words.where(F.col("n") >= least).select("h", "n")
    plan, pairs = partition(spark, rows, frequent, attempt, total, budget)
    nodes = build_groups(scan_suffixes(rows, plan), plan, least, budget, total)
    whole = (pairs.where(F.col("n") > budget).join(frequent.select(F.col("h").alias("h1"), F.col("n").alias("l1")), "h1")
             .select("h1", "h2", F.lit(0).cast("long").alias("h3"), F.col("n").alias("a"), "l1",
                     F.col("n").alias("l2")))
    return words, cut_lineage(nodes.unionByName(whole.where(F.col("a") >= least)), "phrase-nodes")


def _score(l: str, r: str) -> Column:  # noqa: E741
    """floor(1000000 * a * a / (l * r)), exact for counts below 10 ** 13."""
    d = lambda c: f"CAST({c} AS DECIMAL(13, 0))"
    return F.expr(f"({d('a')} * {d('a')} * CAST(1000000 AS DECIMAL(7, 0))) div ({d(l)} * {d(r)})")


def mine(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST,
         top: int = TOP, inside: int = INSIDE, budget: int = BUDGET) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language
    by score and count (both descending), then phrase."""
    words, nodes = phrase_nodes(docs, lang_col, text_col, least, budget)
    counts = words.where(F.col("n") >= least)
    pairs, triples = nodes.where("h3 = 0"), nodes.where("h3 <> 0")
    # A pair that lies in a triple with enough of its occurrences goes.
    covers = (triples.select(F.explode(F.array(F.struct("h1", "h2"), F.struct(F.col("h2").alias("h1"),
                                                                          F.col("h3").alias("h2")))).alias("p"), "a")
              .groupBy("p.h1", "p.h2").agg(F.max("a").alias("most")))
    pairs_left = (pairs.join(covers, ["h1", "h2"], "left")
                  .where(F.col("most").isNull() | (F.col("most") * 100 < F.col("a") * inside)).drop("most"))
    rest = pairs.select(F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("a").alias("r1"))
    # A spread join reads its left side twice, to count keys and to join: each is written.
    found = cut_lineage(
        pairs_left.withColumn("r1", F.lit(None).cast("long"))
        .unionByName(spread_join(triples, rest, ["h2", "h3"], "inner"))
        .withColumn("h", F.when(F.col("h3") == 0, F.col("h2")).otherwise(F.col("h3"))), "phrase-rests")
    found = cut_lineage(spread_join(found, counts.select("h", F.col("n").alias("r2")), ["h"], "inner")
                        .drop("h"), "phrase-found")
    early = F.when(F.col("h3") != 0, _score("l1", "r1"))
    late = F.when(F.col("h3") == 0, _score("l1", "r2")).otherwise(_score("l2", "r2"))
    first_cut = F.coalesce(F.col("s1") <= F.col("s2"), F.lit(False))
    scored = found.withColumn("s1", early).withColumn("s2", late).select(
        "h1", "h2", "h3", "a", F.when(first_cut | (F.col("h3") == 0), F.col("l1")).otherwise(F.col("l2")).alias("l"),
        F.when(first_cut, F.col("r1")).otherwise(F.col("r2")).alias("r"),
        F.when(first_cut, F.col("s1")).otherwise(F.col("s2")).alias("score"))

    def spelled(rows: DataFrame, i: int) -> DataFrame:
        names = counts.select(F.col("h").alias(f"h{i}"), F.col("word").alias(f"w{i}"),
                              *([F.col("grp")] if i == 1 else []))
        return spread_join(rows, names, [f"h{i}"], "inner" if i < 3 else "left")

    scored = cut_lineage(spelled(scored, 1), "phrase-scores")
    # Scores that can be among the first, from at most 1,000,001 counts a language.
    upto = Window.partitionBy("grp").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    least_score = cut_lineage(
        scored.groupBy("grp", "score").agg(F.count("*").alias("m"))
        .withColumn("before", F.coalesce(F.sum("m").over(upto), F.lit(0))).where(F.col("before") < top)
        .groupBy("grp").agg(F.min("score").alias("least")), "phrase-limits")
    near = cut_lineage(scored.join(least_score, "grp").where(F.col("score") >= F.col("least")).drop("least"),
                       "phrase-near")
    named = spelled(cut_lineage(spelled(near, 2), "phrase-named"), 3).withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3"))
    order = Window.partitionBy("grp").orderBy(F.desc("score"), F.desc("a"), "phrase")
    sizes = words.groupBy("grp").agg(F.sum("n").alias("n"))
    return (named.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
            .join(sizes, "grp")
            .select(F.col("grp").alias("lang"), "rank", "phrase", "a", "l", "r", "n", "score"))
