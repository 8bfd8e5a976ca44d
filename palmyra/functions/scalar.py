"""Column expressions shared by the pipelines.

Every helper returns a plain ``Column`` built from ``pyspark.sql.functions``,
so it stays inside whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that the results depend on (they must equal the source jobs).
# Water balance: reservoir capacity in mm, the epoch month (year, month) whose
# first balance opens with a full reserve and that opening reserve in mm,
# evapotranspiration per month in mm for a dry month (at most 10 readings) and
# for a wet month, the reading-count threshold between them, and the default
# bunch weight (kg) used when no earlier non-zero weight exists. Division codes
# excluded from bunch-weight output, and the required block-code length.
CAPACITY = 200.0
EPOCH = (2022, 11)
OPENING_RESERVE = 200.0
ET_DRY = 150
ET_WET = 120
ET_DRY_MAX_COUNT = 10
DEFAULT_BJR = 4.99
EXCLUDED_DIVISIONS = ("DUMMY", "AFDTR", "PABRIK")
BLOCK_CODE_LENGTH = 4


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clamp(x: str | Column, lo: float = 0.0, hi: float = CAPACITY) -> Column:
    """Three-way clamp: ``<= lo`` -> lo, ``>= hi`` -> hi, else x.

    NULL stays NULL, unlike ``least``/``greatest`` which skip NULL.
    """
    x = col_(x)
    return (
        F.when(x <= F.lit(lo), F.lit(float(lo)))
        .when(x >= F.lit(hi), F.lit(float(hi)))
        .otherwise(x.cast("double"))
    )


def deficit(balance: str | Column) -> Column:
    """Water deficit: ``-balance`` when negative, 0 otherwise, NULL kept."""
    b = col_(balance)
    return F.when(b < 0, -b).when(b >= 0, F.lit(0.0))


def evapotranspiration(n_readings: str | Column,
                       dry: int = ET_DRY, wet: int = ET_WET,
                       dry_max: int = ET_DRY_MAX_COUNT) -> Column:
    """Monthly evapotranspiration class from a reading (or day) count."""
    return F.when(col_(n_readings) <= dry_max, F.lit(dry)).otherwise(F.lit(wet))


def guarded_divide(num: str | Column, den: str | Column) -> Column:
    """Division with the float semantics of a NaN-filling frame library.

    NULL operand -> NULL; 0/0 -> 0 (NaN filled with 0); x/0 -> +-inf;
    otherwise the quotient. Never raises under ANSI mode.
    """
    n, d = col_(num).cast("double"), col_(den).cast("double")
    inf = F.lit(float("inf"))
    return (
        F.when(n.isNull() | d.isNull(), F.lit(None).cast("double"))
        .when((d == 0) & (n == 0), F.lit(0.0))
        .when((d == 0) & (n > 0), inf)
        .when(d == 0, -inf)
        .otherwise(n / d)
    )


def zero_as_null(x: str | Column) -> Column:
    """``mask(x == 0)``: zero becomes missing."""
    return F.nullif(col_(x), F.lit(0))


def not_in_values(x: str | Column, values: Iterable) -> Column:
    """Keep-predicate for an exclusion list; NULL values are kept."""
    return F.coalesce(~col_(x).isin(list(values)), F.lit(True))


def has_length(x: str | Column, n: int = BLOCK_CODE_LENGTH) -> Column:
    """Keep-predicate ``length(x) == n``; NULL values are kept."""
    return F.coalesce(F.length(col_(x)) == n, F.lit(True))
