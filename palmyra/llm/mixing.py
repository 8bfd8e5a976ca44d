"""Mixing sources to target weights by a hierarchical token budget.

Sources form a tree: domain, language, source. A token budget goes down from the
root: each node divides its budget among its children by their weights, a
child that cannot use its share (its subtree has fewer tokens than that, over
all epochs and without nodes of weight zero) gets what it has, and the rest goes to its siblings by their
weights. As a node never gets more than its subtree holds, a shortage is first
made good by siblings and reaches the parent's siblings only when the whole
parent is short.

A leaf's documents are put in a seeded order, anew for each epoch; the leaf
gives the longest prefix of that sequence within its budget. A document is
taken whole or not at all.

The shares of siblings have a closed form (fill those of the smallest capacity per
weight first), so each level is one window over nodes. The prefix needs no
sorted leaf: documents fall into buckets by their place in the order, buckets
are summed, all buckets before the one that the budget ends in are taken, and only
that one bucket is ordered.

Cases: null domain, language or source are nodes of their own ('' as name); an
empty or null text has no tokens and is taken while the prefix has room left
(also at the very end); rows that repeat an id share their place and are taken
together or not at all; a weight of zero gives nothing; missing weights count as
1; an empty table gives no rows.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from decimal import Decimal
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palmyra.sources.writers import cut_lineage

LEVELS = ("domain", "lang", "source")
SEED = 17
#: Hex digits of the order that make a bucket: 16 ** 3 buckets a leaf and epoch.
BUCKET_DIGITS = 3


def n_tokens(text_col: str) -> Column:
    """The budget's unit: words between white space."""
    words = F.filter(F.split(F.col(text_col), "[ \\t\\n\\r]+"), lambda x: x != "")
    return F.coalesce(F.size(words), F.lit(0)).cast("long")


def _weight(level: str, weights: Mapping[str, Mapping[str, float]]) -> Column:
    """Whole weights keep the shares exact: floats are scaled by 1000, or by the power
    of ten that makes all of them whole, as far as the largest stays below 10 ** 12.
    A weight above zero never becomes zero."""
    given, digits = weights.get(level, {}), 3
    most = max([1, *given.values()])
    while (most * 10 ** (digits + 1) <= 10 ** 12
           and any(Decimal(str(float(w))) * 10 ** digits % 1 for w in given.values())):
        digits += 1
    scale = 10 ** digits
    whole = {name: max(1, round(scale * w)) if w > 0 else 0 for name, w in given.items()}
    known = F.from_json(F.lit(json.dumps(whole)), "map<string,bigint>")
    return F.coalesce(known[F.col(level)], F.lit(scale)).cast("long")


def divide(nodes: DataFrame, parent: list[str], level: str) -> DataFrame:
    """Share each parent's ``budget`` among its children (columns level, weight,
    capacity): the column ``share``, whole tokens, rounded down."""
    used = F.when(F.col("weight") > 0, F.col("capacity")).otherwise(0)
    order = [(F.col("capacity") / F.nullif(F.col("weight"), F.lit(0))).asc_nulls_last(), F.col(level)]
    inside = Window.partitionBy(*parent)
    smaller = inside.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rest = inside.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    # What a unit of weight gets if all children before this one are full. It rises
    # along the children that are, and falls after the first that is not.
    left = F.col("budget") - F.coalesce(F.sum(used).over(smaller), F.lit(0))
    unit = left / F.nullif(F.sum("weight").over(rest), F.lit(0))
    share = F.least(used, F.floor(F.col("weight") * F.greatest(F.max("unit").over(inside),
                                                               F.lit(0.0))))
    return (nodes.withColumn("unit", unit)
            .withColumn("share", F.coalesce(share, F.lit(0)).cast("long")).drop("unit"))


def leaf_budgets(leaves: DataFrame, budget: Column, weights: Mapping[str, Mapping[str, float]],
                 epochs: int) -> DataFrame:
    """(domain, lang, source, budget) from (domain, lang, source, tokens)."""
    whole = leaves.withColumn("capacity", F.col("tokens") * epochs)
    given, parent = None, []
    for i, level in enumerate(LEVELS):
        path = list(LEVELS[:i + 1])
        # What lies below a weight of zero can't be spent, so it is no capacity.
        usable = reduce(and_, (_weight(x, weights) > 0 for x in LEVELS[i + 1:]), F.lit(True))
        held = F.when(usable, F.col("capacity")).otherwise(0)
        nodes = (whole.groupBy(*path).agg(F.sum(held).alias("capacity"),
                                          F.sum("tokens").alias("tokens"))
                 .withColumn("weight", _weight(level, weights)))
        if given is None:
            everything = F.sum("tokens").over(Window.partitionBy(F.lit(0)))
            nodes = (nodes.withColumn("all_tokens", everything)
                     .withColumn("budget", F.floor(budget).cast("long")))
        else:
            nodes = nodes.join(given, parent)
        given = (divide(nodes, parent or [F.lit(0)], level)
                 .select(*path, F.col("share").alias("budget")))
        parent = path
    return given


def mix(docs: DataFrame, budget: Column, weights: Mapping[str, Mapping[str, float]] | None = None,
        domain: Column | None = None, epochs: int = 1, seed: int = SEED, id_col: str = "doc_id",
        text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(doc, domain, lang, source, epoch, tokens) of the chosen rows; ``doc`` has all
    columns of ``docs``.

    ``budget``: tokens in all, over the column ``all_tokens`` (those of one
    epoch), e.g. ``lit(10**9)`` or ``col("all_tokens") * 0.8``. ``weights``: per
    level the weight of each name. ``domain``: an expression over the documents'
    columns, one domain for all by default.

    Limits are a row a leaf; they are written before they are joined, so the planner
    knows their size: a small tree is broadcast, a large one is joined by
    shuffle with skewed leaves split.
    """
    def name(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit(""))

    rows = docs.select(F.struct("*").alias("doc"),
                       name(domain if domain is not None else F.lit("all")).alias("domain"),
                       name(F.col(lang_col)).alias("lang"), name(F.col(source_col)).alias("source"),
                       name(F.col(id_col)).alias("key"), n_tokens(text_col).alias("tokens"))
    place = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"), "key"))
    placed = (rows.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
              .withColumn("place", place)
              .withColumn("bucket", F.substring("place", 1, BUCKET_DIGITS)))
    leaf = list(LEVELS)
    buckets = cut_lineage(placed.groupBy(*leaf, "epoch", "bucket")
                          .agg(F.sum("tokens").alias("tokens")), "mix-buckets")
    leaves = buckets.where("epoch = 0").groupBy(*leaf).agg(F.sum("tokens").alias("tokens"))
    # Tokens up to and with each bucket of a leaf: at most 4096 rows an epoch.
    upto = Window.partitionBy(*leaf).orderBy("epoch", "bucket")
    budgets = leaf_budgets(leaves, budget, weights or {}, epochs)
    end = F.when(F.col("upto") > F.col("budget"),
                 F.struct("epoch", "bucket", (F.col("budget") - F.col("upto") + F.col("tokens"))
                          .alias("room")))
    limits = cut_lineage(buckets.withColumn("upto", F.sum("tokens").over(upto))
                         .join(budgets, leaf).where("budget > 0")
                         .groupBy(*leaf).agg(F.min(end).alias("end")), "mix-limits")
    seen = placed.join(limits, leaf)
    last = (F.col("epoch") == F.col("end.epoch")) & (F.col("bucket") == F.col("end.bucket"))
    # Places of the last bucket that still fit; rows of one place go together.
    until = cut_lineage(
        seen.where(last).groupBy(*leaf, "place", F.col("end.room").alias("room"))
        .agg(F.sum("tokens").alias("t"))
        .withColumn("upto", F.sum("t").over(Window.partitionBy(*leaf).orderBy("place")))
        .where("upto <= room").groupBy(*leaf).agg(F.max("place").alias("until")), "mix-until")
    before = F.col("end").isNull() | (F.struct("epoch", "bucket")
                                      < F.struct("end.epoch", "end.bucket"))
    keep = before | (last & F.coalesce(F.col("place") <= F.col("until"), F.lit(False)))
    return (seen.join(until, leaf, "left").where(keep)
            .select("doc", *leaf, "epoch", "tokens"))
