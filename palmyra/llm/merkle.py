"""Merkle manifest of a dataset, with an inclusion proof for every row.

A row's leaf is the SHA-256 of its fields. Per group (language) the leaves ascend by
id; while more than one node remains, every eight consecutive ones (the last run may
have fewer, even one) become the digest of their concatenation. What remains is the
group's subroot, and the subroots, by group name, give the root in the same way.
Digests are lower-case hex text throughout.

Cogrouped subtree exchange:

1. Leaves are sorted into ranges, and a row's place in its group is the count of the
   group's rows in earlier ranges plus its place in its own: no task holds a group.
2. A superblock is ``8 ** levels`` consecutive nodes. Upwards, each superblock is
   reduced to its top node, and these nodes are cut into superblocks again, until
   one node a group is left; then the same over the groups.
3. Downwards, the nodes of a superblock are cogrouped with the outer nodes that their
   proofs need (at most seven a level above it), and each hands its own children
   their outer nodes. At the leaves one ``applyInPandas`` finishes it: it reduces the
   superblock locally, joins the inner siblings to the outer ones and folds every
   leaf up to the root.

A task holds one superblock, whatever the size of its group. The driver sees the root.

Cases: a null field is ``-``, so it differs from an empty one; a null group is a group
of its own and comes first; null ids come first in their group; rows that repeat an id
go by their leaf, equal rows in any order (their leaves are equal); a group of one row
has its leaf as subroot; an empty table has no root and gives no rows. Only the named
columns are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palmyra.sources.writers import cut_lineage

ARITY = 8
#: Levels inside a superblock: 8 ** 4 = 4,096 nodes a task.
LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NODE = "grp string, pos long, n long, digest string"
#: One row a level of the way from a block's top node to the root.
OUTER = "grp string, block long, level int, at int, siblings array<string>, above boolean"
#: Levels over the groups are numbered from here.
ABOVE = 1000
RESULT = ("doc_id string, leaf string, subroot string, proof_sha256 string, "
          "folded_root string")


def digest(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(c: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*fields: Column) -> Column:
    return F.sha2(F.concat(*(encoded(c) for c in fields)), 256)


def depth_of(n: int, levels: int) -> int:
    """Levels that a superblock of a row of ``n`` nodes is reduced by."""
    d = 0
    while n > 1 and d < levels:
        n, d = -(-n // ARITY), d + 1
    return d


def local_tree(nodes: list[str], depth: int) -> list[list[str]]:
    """Levels of a superblock, from its nodes to its top node."""
    out = [nodes]
    for _ in range(depth):
        low = out[-1]
        out.append([digest(low[i:i + ARITY]) for i in range(0, len(low), ARITY)])
    return out


def local_path(tree: list[list[str]], i: int) -> list[tuple[int, list[str]]]:
    """(place in its run, siblings) of node i at each level of a superblock."""
    out = []
    for level in tree[:-1]:
        lo = i - i % ARITY
        out.append((i - lo, level[lo:i] + level[i + 1:lo + ARITY]))
        i //= ARITY
    return out


def fold(node: str, path: Sequence[tuple[int, Sequence[str]]]) -> str:
    for at, siblings in path:
        node = digest([*siblings[:at], node, *siblings[at:]])
    return node


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos``, the place in its group by ``order``, and ``n``, the size of
    the group. The ranges are written once, so both passes see the same ones."""
    placed = cut_lineage(
        rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_range", F.shiftright("_id", 33)), "merkle-order")
    # A group's rows lie side by side in a range: one row here per range and group in it.
    runs = placed.groupBy(group, "_range").agg(F.min("_id").alias("_lo"),
                                               F.count("*").alias("_m"))
    whole = Window.partitionBy(group)
    earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    runs = cut_lineage(runs.select(
        group, "_range", "_lo", F.coalesce(F.sum("_m").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_m").over(whole).alias("n")), "merkle-ranges")
    return (placed.join(runs, [group, "_range"])
            .select(*rows.columns, (F.col("_before") + F.col("_id") - F.col("_lo")).alias("pos"), "n"))


@dataclass
class Tree:
    """Nodes of every tier, lowest first: (grp, pos, n, digest, ...); the last one has
    one node a group."""

    tiers: list[DataFrame]
    levels: int

    @property
    def block(self) -> int:
        return ARITY ** self.levels

    def blocks(self, tier: int) -> DataFrame:
        return self.tiers[tier].withColumn("block", F.floor(F.col("pos") / self.block))


def build(nodes: DataFrame, levels: int = LEVELS) -> Tree:
    """Reduce (grp, pos, n, digest) superblock by superblock up to one node a group."""
    tree = Tree([nodes], levels)

    def top(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        n = int(rows["n"].iloc[0])
        top_node = local_tree(list(rows["digest"]), depth_of(n, levels))[-1][0]
        return pd.DataFrame({"grp": rows["grp"].iloc[:1], "pos": rows["block"].iloc[:1],
                             "n": [-(-n // ARITY ** levels)], "digest": [top_node]})

    while tree.tiers[-1].where("n > 1").limit(1).count():
        blocks = tree.blocks(-1).select("grp", "block", "pos", "n", "digest")
        tree.tiers.append(cut_lineage(blocks.groupBy("grp", "block").applyInPandas(top, NODE),
                                      "merkle-nodes"))
    return tree


def _outer_path(outer: pd.DataFrame) -> list[tuple]:
    rows = outer.sort_values("level")
    return [(int(level), int(at), list(siblings), bool(above)) for level, at, siblings, above
            in zip(rows["level"], rows["at"], rows["siblings"], rows["above"])]


def hand_down(tree: Tree, tier: int, outer: DataFrame, base: int, above: bool) -> DataFrame:
    """Outer nodes of the children of each node of a tier: its own way inside its
    superblock, then that of the superblock."""
    levels = tree.levels

    def give(nodes: pd.DataFrame, upper: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("pos")
        way, out = _outer_path(upper), []
        if len(nodes):
            inner = local_tree(list(nodes["digest"]), depth_of(int(nodes["n"].iloc[0]), levels))
            for i, (grp, pos) in enumerate(zip(nodes["grp"], nodes["pos"])):
                own = [(base + d, at, siblings, above)
                       for d, (at, siblings) in enumerate(local_path(inner, i))]
                out += [(grp, pos, *step) for step in own + way]
        return pd.DataFrame(out, columns=["grp", "block", "level", "at", "siblings", "above"])

    left = tree.blocks(tier).select("grp", "block", "pos", "n", "digest").groupBy("grp", "block")
    return left.cogroup(outer.groupBy("grp", "block")).applyInPandas(give, OUTER)


@dataclass
class Manifest:
    leaves: Tree
    groups: Tree
    root: str | None


def manifest(leaves: DataFrame, levels: int = LEVELS) -> Manifest:
    """Trees of all groups and over them. ``leaves``: (grp, pos, n, digest, ...), as
    :func:`placed_leaves` gives them."""
    low = build(leaves, levels)
    tops = low.tiers[-1].select(F.col("grp").alias("name"), "digest",
                                F.lit("all").alias("grp"))
    high = build(cut_lineage(numbered(tops, "grp", ["name"]), "merkle-groups"), levels)
    last = high.tiers[-1].select("digest").first()
    return Manifest(low, high, last.digest if last else None)


def outer_nodes(m: Manifest) -> DataFrame:
    """The outer nodes that the leaves' superblocks need."""
    spark = m.leaves.tiers[0].sparkSession
    outer = spark.createDataFrame([], OUTER)
    for tier in range(len(m.groups.tiers) - 1, -1, -1):
        outer = cut_lineage(hand_down(m.groups, tier, outer, ABOVE + tier * m.groups.levels, True),
                            "merkle-outer")
    names = m.groups.tiers[0].select(F.col("pos").alias("block"), "name")
    outer = outer.join(names, "block").select(F.col("name").alias("grp"), F.lit(0).cast("long").alias("block"),
                                              "level", "at", "siblings", "above")
    for tier in range(len(m.leaves.tiers) - 1, 0, -1):
        outer = cut_lineage(hand_down(m.leaves, tier, outer, tier * m.leaves.levels, False),
                            "merkle-outer")
    return outer


def placed_leaves(docs: DataFrame, id_col: str, group_col: str, fields: Sequence[str],
                  text_col: str, tampered: Column) -> DataFrame:
    """(grp, pos, n, digest, claimed, id): ``claimed`` is the leaf of the row as someone
    else holds it, here with lower-cased text where ``tampered``. Only digests are
    sorted, never texts."""
    as_held = F.when(tampered, F.translate(F.col(text_col), UPPER, LOWER)).otherwise(F.col(text_col))
    claimed = leaf_of(*(as_held if f == text_col else F.col(f) for f in fields))
    group = F.coalesce(F.concat(F.lit("="), F.col(group_col)), F.lit(""))   # null comes first
    rows = cut_lineage(docs.select(
        group.alias("grp"), F.col(id_col).cast("long").alias("id"),
        leaf_of(*(F.col(f) for f in fields)).alias("digest"), claimed.alias("claimed"),
        F.monotonically_increasing_id().alias("row")), "merkle-leaves")
    # Equal rows may be a third of all: their row number spreads them over ranges.
    return cut_lineage(numbered(rows, "grp", ["id", "digest", "row"]).drop("row"), "merkle-placed")


def verify(m: Manifest) -> DataFrame:
    """Per leaf (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)."""
    levels = m.leaves.levels

    def finish(leaves: pd.DataFrame, upper: pd.DataFrame) -> pd.DataFrame:
        leaves = leaves.sort_values("pos")
        way, out = _outer_path(upper), []
        outer = [(at, siblings) for _, at, siblings, _ in way]
        outside = "".join("".join(siblings) for _, siblings in outer)
        if len(leaves):
            tree = local_tree(list(leaves["digest"]), depth_of(int(leaves["n"].iloc[0]), levels))
            subroot = fold(tree[-1][0], [(at, s) for _, at, s, above in way if not above])
            for i, (doc, leaf, claimed) in enumerate(zip(leaves["id"], leaves["digest"],
                                                         leaves["claimed"])):
                inner = local_path(tree, i)
                proof = digest([*("".join(s) for _, s in inner), outside])
                out.append((doc, leaf, subroot, proof, fold(claimed, inner + outer)))
        return pd.DataFrame(out, columns=["doc_id", "leaf", "subroot", "proof_sha256", "folded_root"])

    # Ids go as text: a null would make pandas turn them into floats.
    left = m.leaves.blocks(0).select("grp", "block", "pos", "n", F.col("id").cast("string").alias("id"),
                                     "digest", "claimed").groupBy("grp", "block")
    done = left.cogroup(outer_nodes(m).groupBy("grp", "block")).applyInPandas(finish, RESULT)
    root = F.lit(m.root).cast("string")
    return done.select(F.col("doc_id").cast("long").alias("doc_id"), "leaf", "subroot",
                       root.alias("root"), "proof_sha256", "folded_root",
                       (F.col("folded_root") == root).alias("verified"))


def audit(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang",
          fields: Sequence[str] = FIELDS, text_col: str = "text", tampered: Column | None = None,
          levels: int = LEVELS) -> DataFrame:
    """Build the manifest of ``docs`` and check every row, as it is held elsewhere,
    against it. ``tampered`` (default: where 3 divides the CRC-32 of the decimal id)
    marks the rows that are held with A-Z of their text lower-cased."""
    if tampered is None:
        crc = F.crc32(F.col(id_col).cast("long").cast("string").cast("binary"))
        tampered = F.coalesce(crc % 3 == 0, F.lit(False))
    leaves = placed_leaves(docs, id_col, group_col, fields, text_col, tampered)
    found = verify(manifest(leaves, levels))
    return found if id_col == "doc_id" else found.withColumnRenamed("doc_id", id_col)
