"""Capped running water balance (a sequential recurrence per key).

For the rows of one key in period order::

    balance[i] = inflow[i] + prev - outflow[i]
    close[i]   = clamp(balance[i], 0, capacity)
    reserve[i] = close[i-1]
    deficit[i] = max(-balance[i], 0)

``prev`` is ``close[i-1]`` in ``mode="intended"``. In ``mode="reference"`` it
is ``reserve[i-1]``, i.e. the close two rows back, which is what the stored
history was computed with. Both modes only need the previous output row, so
the state is (reserve, close) of that row; a key with no earlier row opens at
(0, 0).

Rows flagged ``fixed`` (carried-in seed rows) keep their stored reserve,
balance and close and set the state; rows flagged ``opening`` are treated the
same way only when they are the first row of their key (the epoch row).

No window function expresses a clamp inside a running sum, so the fold runs
as a higher-order ``aggregate`` over the key's rows sorted by period, on the
JVM, after one shuffle on the key. The input is one row per key and period
(already aggregated), so a key holds at most one row per calendar month,
whatever the volume of raw readings behind it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palmyra.functions.scalar import CAPACITY, clamp, deficit

MODES = ("reference", "intended")


def capped_balance(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    inflow: str,
    outflow: str,
    *,
    mode: str = "reference",
    capacity: float = CAPACITY,
    fixed: str | None = None,
    opening: str | None = None,
    reserve_col: str = "WaterReserve",
    balance_col: str = "WaterBalance",
    close_col: str = "WaterReserveAfterEvapor",
    deficit_col: str = "WaterDeficit",
    chunk: str | None = None,
    doubled: str | None = None,
) -> DataFrame:
    """``doubled`` names a further column: the rows of the key (and chunk) that share their
    order with another one, found in the pass over them."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    keys, order = list(keys), list(order)
    outputs = [reserve_col, balance_col, close_col, deficit_col]
    flags = [c for c in (fixed, opening) if c]
    payload = [c for c in df.columns
               if c not in keys and c not in order and c not in outputs and c not in flags]
    schema = {f.name: f.dataType for f in df.schema.fields}

    def stored(c):
        return F.col(c).cast("double") if c in schema else F.lit(None).cast("double")

    # Sort key first, so sort_array orders the rows by period.
    row = F.struct(
        *[F.col(c) for c in order],
        *[F.col(c) for c in payload],
        F.col(inflow).cast("double").alias("_in"),
        F.col(outflow).cast("double").alias("_out"),
        (F.col(fixed) if fixed else F.lit(False)).alias("_fixed"),
        (F.col(opening) if opening else F.lit(False)).alias("_opening"),
        stored(reserve_col).alias("_r0"),
        stored(balance_col).alias("_b0"),
        stored(close_col).alias("_c0"),
    )
    state_cols = (reserve_col, balance_col, close_col)
    sorted_rows = F.sort_array(F.collect_list(row)).alias("_rows")
    if chunk is None:
        grouped = df.groupBy(*keys).agg(sorted_rows)
        states = _fold_states("_rows", F.lit(0.0), F.lit(0.0), mode, capacity, state_cols)
    else:
        grouped = df.groupBy(*keys, chunk).agg(sorted_rows)
        openings = _chunk_openings(grouped, keys, chunk, mode, capacity)
        grouped = _join_null_safe(grouped, openings, keys + [chunk])
        states = _fold_states("_rows", F.col("_r_in"), F.col("_c_in"), mode, capacity, state_cols,
                              F.col("_is_first"))
    twice = [_repeats(order).alias(doubled)] if doubled else []
    folded = (
        grouped.select(*keys, *twice, F.inline(F.arrays_zip(F.col("_rows"), states.alias("_state"))))
        .select(*keys, *[F.col("_rows")[c].alias(c) for c in order + payload],
                *[F.col("_state")[c].alias(c) for c in state_cols], *([doubled] if doubled else []))
    )
    return folded.withColumn(deficit_col, deficit(balance_col))


def _repeats(order: Sequence[str]) -> Column:
    # The rows are sorted by these columns, so equal ones are neighbours: one pass, where
    # array_distinct compares each struct with all others.
    places = F.transform("_rows", lambda x: F.struct(*(x[c].alias(c) for c in order)))
    equal = F.zip_with(places, F.slice(places, 2, F.size("_rows")), lambda a, b: a.eqNullSafe(b))
    return F.size(F.filter(equal, lambda x: x))


def _fold_states(rows: str, r0, c0, mode: str, capacity: float, state_cols,
                 opens: Column | None = None) -> Column:
    """Sequential fold over sorted rows from state (r0, c0). It carries only
    three doubles per row; the payload is zipped back by the caller. ``opens``: whether a
    first row may be an opening one (default: yes)."""
    reserve_col, balance_col, close_col = state_cols
    state_type = T.ArrayType(T.StructType(
        [T.StructField(c, T.DoubleType()) for c in state_cols]))

    def step(acc, x):
        keep = x["_fixed"] | (x["_opening"] & (F.size(acc["out"]) == 0)
                              & (F.lit(True) if opens is None else opens))
        prev = acc["r"] if mode == "reference" else acc["c"]
        computed = (x["_in"] + prev) - x["_out"]
        bal = F.when(keep, x["_b0"]).otherwise(computed)
        close = F.when(keep, x["_c0"]).otherwise(clamp(computed, 0.0, capacity))
        reserve = F.when(keep, x["_r0"]).otherwise(acc["c"])
        return F.struct(
            reserve.alias("r"), close.alias("c"),
            F.array_append(acc["out"], F.struct(reserve.alias(reserve_col),
                                                bal.alias(balance_col),
                                                close.alias(close_col))).alias("out"))

    init = F.struct(r0.cast("double").alias("r"), c0.cast("double").alias("c"),
                    F.array().cast(state_type).alias("out"))
    return F.aggregate(rows, init, step, lambda acc: acc["out"])


def carried_balance(df: DataFrame, keys: Sequence[str], period: str, seed: str, inflow: str,
                    outflow: str, *, mode: str = "reference", capacity: float = CAPACITY,
                    fixed: str, keep: str, doubled: str | None = None, reserve_col: str = "WaterReserve",
                    balance_col: str = "WaterBalance", close_col: str = "WaterReserveAfterEvapor",
                    deficit_col: str = "WaterDeficit") -> DataFrame:
    """Capped balance where each row names the period that it carries on from.

    ``period`` counts months (year * 12 + month - 1), ``seed`` is the period whose row of
    the key gives the state: the one before or the last December. A key without a row
    there opens at (0, 0). Rows flagged ``fixed`` keep their stored values and set the
    state; ``keep`` is handed through. The fold holds two states a key."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    keys, outputs = list(keys), [reserve_col, balance_col, close_col, deficit_col]
    payload = [c for c in df.columns if c not in (*keys, *outputs, period, seed)]
    names = (reserve_col, balance_col, close_col)
    row = F.struct(
        F.col(period), *[F.col(c) for c in payload], F.col(inflow).cast("double").alias("_in"),
        F.col(outflow).cast("double").alias("_out"), F.col(fixed).alias("_fixed"),
        F.col(seed).alias("_from"), F.col(reserve_col).cast("double").alias("_r0"),
        F.col(balance_col).cast("double").alias("_b0"), F.col(close_col).cast("double").alias("_c0"))
    state = T.StructType([T.StructField("p", T.IntegerType()), T.StructField("r", T.DoubleType()),
                          T.StructField("c", T.DoubleType())])
    out_type = T.ArrayType(T.StructType([T.StructField(c, T.DoubleType()) for c in names]))

    def step(acc, x):
        def before(part):
            return (F.when(acc["last"]["p"] == x["_from"], acc["last"][part])
                    .when(acc["december"]["p"] == x["_from"], acc["december"][part]).otherwise(F.lit(0.0)))
        computed = (x["_in"] + before("r" if mode == "reference" else "c")) - x["_out"]
        reserve = F.when(x["_fixed"], x["_r0"]).otherwise(before("c"))
        close = F.when(x["_fixed"], x["_c0"]).otherwise(clamp(computed, 0.0, capacity))
        balance = F.when(x["_fixed"], x["_b0"]).otherwise(computed)
        here = F.struct(x[period].cast("int").alias("p"), reserve.alias("r"), close.alias("c")).cast(state)
        return F.struct(
            here.alias("last"),
            F.when(x[period] % 12 == 11, here).otherwise(acc["december"]).alias("december"),
            F.array_append(acc["out"], F.struct(reserve.alias(names[0]), balance.alias(names[1]),
                                                close.alias(names[2]))).alias("out"))

    nowhere = F.lit(None).cast(state)
    init = F.struct(nowhere.alias("last"), nowhere.alias("december"),
                    F.array().cast(out_type).alias("out"))
    states = F.aggregate("_rows", init, step, lambda acc: acc["out"])
    grouped = df.groupBy(*keys).agg(F.sort_array(F.collect_list(row)).alias("_rows"))
    twice = [_repeats([period]).alias(doubled)] if doubled else []
    folded = (grouped.select(*keys, *twice, F.inline(F.arrays_zip(F.col("_rows"), states.alias("_state"))))
              .select(*keys, *[F.col("_rows")[c].alias(c) for c in [period, *payload]],
                      *[F.col("_state")[c].alias(c) for c in names], *([doubled] if doubled else [])))
    return folded.withColumn(deficit_col, deficit(balance_col))


# Two-level scan. Each close is a clamp-add map x -> min(max(x + a, lo), hi) of an
# earlier one: the last (mode "intended") or the one before it ("reference"). Such maps
# compose in closed form: (a2, lo2, hi2) after (a1, lo1, hi1) = (a1 + a2, clamp(lo1 + a2,
# lo2, hi2), clamp(hi1 + a2, lo2, hi2)). A map whose a is NULL is the constant lo, whatever
# the close before was, known or not; an unknown flow gives the constant NULL. A chunk is two maps: its last close (a, lo, hi) and the one before it (pa, plo,
# phi), which is the reserve; what they are maps of follows from the number of rows.

_INF = float("inf")
_CHUNK = ("a", "lo", "hi", "pa", "plo", "phi")


def _nullable(v: float) -> Column:
    """A literal whose type allows NULL. The start value fixes the type of a
    fold's state, and Spark would drop the NULL tests on a state without NULLs."""
    return F.try_divide(F.lit(v), F.lit(1.0))


def _maps(*values) -> Column:
    return F.struct(*(v.alias(name) for name, v in zip(_CHUNK, values)))


def _chunk_maps(rows, start: Column, mode: str, capacity: float) -> Column:
    """Maps of the rows' last two closes, after those of ``start``."""
    def step(acc, x):
        flow, kept = x["_in"] - x["_out"], F.coalesce(x["_fixed"], F.lit(False))
        a, lo, hi = (acc[c] for c in (_CHUNK[3:] if mode == "reference" else _CHUNK[:3]))
        bound = lambda v: F.when(v.isNotNull(), clamp(v, 0.0, capacity))
        return _maps(F.when(~kept, a + flow),
                     F.when(kept, x["_c0"]).otherwise(bound(lo + flow)),
                     F.when(kept, x["_c0"]).otherwise(bound(hi + flow)),
                     F.when(~kept, acc["a"]),
                     F.when(kept, x["_r0"]).otherwise(acc["lo"]),
                     F.when(kept, x["_r0"]).otherwise(acc["hi"]))
    return F.aggregate(rows, start, step)


def _apply(a, lo, hi, x) -> Column:
    """A map that is not constant gives NULL for NULL (least and greatest skip it)."""
    return F.when(a.isNull(), lo).when(x.isNotNull(), F.least(F.greatest(x + a, lo), hi))


def _chunk_openings(grouped: DataFrame, keys, chunk: str, mode: str,
                    capacity: float) -> DataFrame:
    """(keys, chunk, _r_in, _c_in, _is_first): the state each chunk starts from.

    Only maps leave the chunks, six numbers each. Those of a key (one a chunk, e.g. a
    year) are gathered in order up to the chunk before and applied from (0, 0)."""
    ident = _nullable(0.0), _nullable(-_INF), _nullable(_INF)
    first = F.col("_rows")[0]
    none = F.lit(None).cast("double")
    opened = _maps(none, first["_c0"], first["_c0"], none, first["_r0"], first["_r0"])
    rest = F.slice("_rows", 2, F.size("_rows"))
    # As the first chunk of its key, one that begins with an opening row starts from it.
    as_first = F.when(F.coalesce(first["_opening"], F.lit(False)), _chunk_maps(rest, opened, mode, capacity))
    later = _chunk_maps("_rows", _maps(*ident, *ident), mode, capacity)

    def step(acc, t):
        turned = t["odd"] & F.lit(mode == "reference")
        last = F.when(turned, acc["r"]).otherwise(acc["c"])
        before = acc["c"] if mode != "reference" else F.when(turned, acc["c"]).otherwise(acc["r"])
        return F.struct(_apply(t["m"]["pa"], t["m"]["plo"], t["m"]["phi"], before).alias("r"),
                        _apply(t["m"]["a"], t["m"]["lo"], t["m"]["hi"], last).alias("c"))

    in_order = Window.partitionBy(*keys).orderBy(chunk)
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    start = F.struct(_nullable(0.0).alias("r"), _nullable(0.0).alias("c"))
    maps = grouped.select(*keys, chunk, as_first.alias("_t1"), later.alias("_t2"),
                          (F.size("_rows") % 2 == 1).alias("_odd"))
    return (maps.withColumn("_is_first", F.row_number().over(in_order) == 1)
            .withColumn("_t", F.struct(F.when(F.col("_is_first"), F.coalesce("_t1", "_t2"))
                                       .otherwise(F.col("_t2")).alias("m"), F.col("_odd").alias("odd")))
            .withColumn("_state", F.aggregate(F.collect_list("_t").over(earlier), start, step))
            .select(*keys, chunk, "_is_first", F.col("_state.r").alias("_r_in"),
                    F.col("_state.c").alias("_c_in")))


def _join_null_safe(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Equi-join on ``on`` where NULL matches NULL; keeps the left key columns."""
    lt, rt = left.alias("_l"), right.alias("_r")
    cond = F.lit(True)
    for k in on:
        cond = cond & F.col(f"_l.{k}").eqNullSafe(F.col(f"_r.{k}"))
    rest = [c for c in right.columns if c not in on]
    return lt.join(rt, cond).select("_l.*", *[F.col(f"_r.{c}") for c in rest])
