"""Toxicity: gradient-boosted trees over dense text features, with isotonic calibration.

Features of a text: densities of a fixed lexicon and of one learnt from the
labelled training rows (words and word beginnings much more frequent in toxic
ones), lexicon words near a second person, capitals, punctuation, and
obfuscation (letters replaced by look-alike signs). Labels, ids, language and
source are never features.

Training uses a bounded sample of the labelled rows (``train_rows``), never a
held-out one: those whose crc32 of the id as text is divisible by five. Of the
rest, remainders 1 to 3 fit lexicon and trees and remainder 4 the calibration.
Every document is then scored whole, in one pass over the table.

Cases: an empty or null text has all features 0 and a score like any other; a
null id counts as the text '' for the split; documents without a label are
scored, labels without a document or with a null mark are left out; an id with
several labels takes part with each; without both labels among the training rows
the score is that of the fixed lexicon alone (1 - exp(-20 x density)); an empty
table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palmyra.llm.common import give_back
from palmyra.sources.writers import cut_lineage

#: At most so many labelled rows are fitted, and so many entries learnt.
TRAIN_ROWS = 20_000
LEXICON_SIZE = 20_000
SEED = 11
#: An entry comes in at least so many toxic training rows (and this share of
#: them), and is so much likelier in them (natural logarithm).
LEAST_ROWS = 4
LEAST_SHARE = 0.004
LEAST_LOG_ODDS = 3.5
STEMS = (4, 5, 6, 7)

# Fixed values.
INSULTS = frozenset("""
    arse arsehole ass asshole bastard bitch bullshit clown crap cretin cunt damn degenerate
    dick disgusting douche dumb dumbass dunce fag filth filthy fool freak fuck fucker fucking
    garbage hate idiot idiotic idiots ignorant imbecile jerk kill liar loser losers lunatic moron
    moronic morons motherfucker nasty nutcase pathetic pig prick psycho puke rat retard
    scum scumbag shit shitty shut sick sicko slut stupid suck sucks swine trash twat ugly
    useless vermin vile whore wimp worthless
    abschaum arschloch blöd dumm dummkopf hurensohn scheisse scheiße schlampe schwein trottel
    versager wichser wertlos ekelhaft
    connard connasse crétin dégoûtant imbécile merde minable ordure pute salaud salope stupide
    basura cabrón estúpido gilipollas idiota imbécil inútil mierda patético puta asqueroso
""".split())
SECOND_PERSON = frozenset("""
    you your yours yourself u ur du dich dir dein deine deiner ihr euch euer sie
    tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros
""".split())
LOOK_ALIKE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a",
                            "$": "s", "!": "i", "|": "i", "€": "e"})

WORD = re.compile(r"[^\W_]+")
#: A letter, then a sign among letters: f*ck, id10t, $tupid.
DISGUISED = re.compile(r"(?<![\w@$*!|])(?=[^\s]{0,30}[^\W\d_])[\w@$]*[0-57@$*!|€][\w@$*!|€]*[^\W\d_]")
NEAR = 5
FEATURES = ("length", "fixed_hits", "fixed_density", "learnt_hits", "learnt_density",
            "learnt_weight", "learnt_max", "distinct_hits", "second_person", "near_second_person",
            "capitals", "capital_words", "marks", "exclaims", "questions", "disguised",
            "disguised_hits", "repeats")


@dataclass
class Lexicon:
    """Learnt entries with their log odds: whole words and beginnings."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)

    def weight(self, word: str) -> float:
        found = self.words.get(word, 0.0)
        if found:
            return found
        for k in STEMS:
            if len(word) > k and (found := self.stems.get(word[:k], 0.0)):
                return found
        return 0.0


class _Marks(dict):
    """word -> (fixed, weight, second person), found once a word."""

    def __init__(self, lexicon: Lexicon, most: int = 100_000):
        super().__init__()
        self.lexicon, self.most = lexicon, most

    def __missing__(self, word: str) -> tuple[bool, float, bool] | None:
        mark = (word in INSULTS, self.lexicon.weight(word), word in SECOND_PERSON)
        mark = mark if any(mark) else None
        if len(self) < self.most:
            self[word] = mark
        return mark


def entries(text: str) -> set[str]:
    """Words ('=word') and beginnings of a text, each once."""
    out = set()
    for w in set(WORD.findall(text.lower())):
        out.add("=" + w)
        out.update(w[:k] for k in STEMS if len(w) > k)
    return out


def features(text: str, marks: _Marks) -> list[float]:
    words = WORD.findall(text.lower())
    n, size = len(words), len(text)
    if not size:
        return [0.0] * len(FEATURES)
    found = [(i, m) for i, m in enumerate(map(marks.__getitem__, words)) if m]
    fixed = sum(m[0] for _, m in found)
    weights = [m[1] for _, m in found if m[1]]
    hits = [i for i, m in found if m[0] or m[1]]
    persons = [i for i, m in found if m[2]]
    near = 0
    if hits and persons:
        at = np.searchsorted(persons, hits)
        where = np.array([-10 ** 9, *persons, 10 ** 9])
        near = int((np.minimum(hits - where[at], where[at + 1] - hits) <= NEAR).sum())
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    upper = int(((raw >= 65) & (raw <= 90)).sum())
    letters = upper + int(((raw >= 97) & (raw <= 122)).sum() + (raw >= 192).sum())
    marks_n = int(((raw > 32) & (raw < 48)).sum() + ((raw > 57) & (raw < 65)).sum())
    repeats = int(((raw[2:] == raw[1:-1]) & (raw[1:-1] == raw[:-2]) & (raw[2:] > 32)).sum())
    disguised = DISGUISED.findall(text) if marks_n or letters != size else []
    clean = [d.lower().translate(LOOK_ALIKE) for d in disguised]
    hidden = sum(bool((m := marks[c]) and (m[0] or m[1])) for c in clean)
    caps = len(re.findall(r"\b[A-Z]{3,}\b", text)) if upper > 2 else 0
    return [math.log1p(n), fixed, fixed / max(n, 1), len(weights), len(weights) / max(n, 1),
            sum(weights) / max(n, 1), max(weights, default=0.0), len({words[i] for i in hits}),
            len(persons) / max(n, 1), near / max(n, 1), upper / max(letters, 1), caps / max(n, 1),
            marks_n / size, text.count("!") / size, text.count("?") / size,
            len(disguised) / max(n, 1), hidden, repeats / size]


def with_features(rows: DataFrame, lexicon: Lexicon, text_col: str = "text") -> DataFrame:
    """(row, _f): the rows as a struct, and their features as an array."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)  # bounded by LEXICON_SIZE

    @F.pandas_udf("array<double>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        marks = _Marks(shared.value)
        for part in parts:
            yield pd.Series([features(t or "", marks) for t in part], dtype=object)
        marks.clear()
        give_back()

    return rows.select(F.struct("*").alias("row"), run(F.col(text_col).cast("string")).alias("_f"))


def fold(key: Column) -> Column:
    """crc32 of the id as text, modulo 5; 0 is held out."""
    return F.crc32(F.encode(F.coalesce(key.cast("string"), F.lit("")), "utf-8")) % 5


def _counted(counts: Counter, step: int = 20_000) -> Iterator[pd.DataFrame]:
    rows = list(counts.items())
    for i in range(0, len(rows), step):
        yield pd.DataFrame(rows[i:i + step], columns=["e", "n"])


def learn_lexicon(sample: DataFrame, size: int = LEXICON_SIZE) -> Lexicon:
    """From (toxic, text): first what is frequent in toxic rows, then how often that
    comes in the others. Tasks count by themselves before the counts meet."""
    def counter(only: set[str] | None):
        def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            counts: Counter = Counter()
            for part in parts:
                for text in part["text"]:
                    found = entries(text or "")
                    counts.update(found if only is None else found & only)
                if len(counts) > 2_000_000:
                    yield from _counted(counts)
                    counts.clear()
            yield from _counted(counts)
        return lambda df: (df.select("text").mapInPandas(run, "e string, n long")
                           .groupBy("e").agg(F.sum("n").alias("n")))

    rows = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    least = max(LEAST_ROWS, math.ceil(LEAST_SHARE * rows.get(1, 0)))
    top = (counter(None)(sample.where("toxic = 1")).where(F.col("n") >= least)
           .orderBy(F.desc("n"), "e").limit(size).collect())
    if not top:
        return Lexicon()
    other = {r.e: r.n for r in counter({r.e for r in top})(sample.where("toxic = 0")).collect()}
    lexicon = Lexicon()
    for r in top:
        odds = (math.log((r.n + 0.5) / (rows[1] + 1))
                - math.log((other.get(r.e, 0) + 0.5) / (rows.get(0, 0) + 1)))
        if odds >= LEAST_LOG_ODDS:
            if r.e[0] == "=":
                lexicon.words[r.e[1:]] = odds
            else:
                lexicon.stems[r.e] = odds
    return lexicon


@dataclass
class Model:
    lexicon: Lexicon
    trees: GBTClassificationModel | None = None
    steps: IsotonicRegressionModel | None = None

    def score(self, rows: DataFrame, text_col: str = "text") -> DataFrame:
        """(row, score): the rows as a struct and a score from 0 to 1. One pass over
        the table, without a shuffle."""
        table = with_features(rows, self.lexicon, text_col)
        if self.trees is None:
            density = F.col("_f")[FEATURES.index("fixed_density")]
            return table.select("row", (1 - F.exp(-20 * density)).alias("score"))
        raw = _probability(self.trees, table, "row")
        if self.steps is None:
            return raw.select("row", F.col("_raw").alias("score"))
        done = self.steps.setFeaturesCol("_raw").setPredictionCol("_step").transform(raw)
        # Steps are flat: a thousandth of the raw score keeps their order inside.
        score = 0.999 * F.least(F.lit(1.0), F.greatest(F.lit(0.0), "_step")) + 0.001 * F.col("_raw")
        return done.select("row", score.alias("score"))


def _probability(trees: GBTClassificationModel, table: DataFrame, *keep: str) -> DataFrame:
    out = trees.transform(table.withColumn("_v", array_to_vector("_f")))
    return out.select(*keep, vector_to_array("probability")[1].alias("_raw"))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", train_rows: int = TRAIN_ROWS,
          lexicon_size: int = LEXICON_SIZE) -> Model:
    """Fit on at most ``train_rows`` labelled rows of ``docs`` (rows that repeat an id count
    each), with a lexicon of at most ``lexicon_size`` learnt entries, the most frequent."""
    marked = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
              .where(F.col("toxic").isin(0, 1) & (fold(F.col("id")) != 0))
              .orderBy(F.xxhash64("id"), "toxic").limit(train_rows))
    # At most ``train_rows`` ids of 8 bytes: a proven bound for the broadcast.
    labelled = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
                .join(F.broadcast(marked), "id").withColumn("fold", fold(F.col("id"))))
    # Ids may repeat, in either table. Only then are rows chosen once more, which brings
    # those chosen (at most train_rows) together in one task.
    if labelled.select("id").count() > train_rows:
        labelled = labelled.orderBy(F.xxhash64("id"), "toxic", F.xxhash64("text"), "id").limit(train_rows)
    sample = cut_lineage(labelled, "toxic-sample")
    fit = sample.where("fold <> 4")
    both = fit.agg(F.countDistinct("toxic")).first()[0]
    if both < 2:
        return Model(Lexicon())
    lexicon = learn_lexicon(fit, lexicon_size)
    table = cut_lineage(with_features(sample, lexicon).select("row.toxic", "row.fold", "_f"),
                        "toxic-features")
    rows = table.where("fold <> 4").select("toxic", array_to_vector("_f").alias("_v"))
    trees = GBTClassifier(featuresCol="_v", labelCol="toxic", maxIter=20, maxDepth=3, maxBins=64,
                          stepSize=0.3, seed=SEED, minInstancesPerNode=5).fit(rows.coalesce(4))
    held = _probability(trees, table.where("fold = 4"), "toxic").withColumn(
        "toxic", F.col("toxic").cast("double"))
    if held.agg(F.countDistinct("toxic")).first()[0] < 2:
        return Model(lexicon, trees)
    steps = IsotonicRegression(featuresCol="_raw", labelCol="toxic").fit(held)
    return Model(lexicon, trees, steps)


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(id, held_out, score, predicted) of every document."""
    model = train(docs, labels, id_col, text_col, label_col, train_rows)
    rows = model.score(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    key = F.col("row.id")
    return rows.select(key.alias(id_col), (fold(key) == 0).alias("held_out"), "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows that score below 0.5, with all their columns."""
    return model.score(docs, text_col).where(F.col("score") < 0.5).select("row.*")
