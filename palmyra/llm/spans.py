"""Spans of texts in Spark SQL: positions of regular expression matches.

Positions count code points; ends are exclusive. Matches are leftmost and do not
overlap. All patterns here are written so that Java's matcher neither recurses per
character (possessive groups) nor tries again inside a run that failed
(look-behind), so a text of any length costs time in proportion.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,value:string>>"


def matches(text: Column, pattern: str, when: Column | None = None) -> Column:
    """All matches of ``pattern`` as (start, end, value). ``split`` and
    ``regexp_extract_all`` walk through the same matches, so the lengths of the
    pieces between them give the positions. ``when`` skips texts that cannot match."""
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"),
                         F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value"))
    empty = F.array().cast(SPAN)

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["gap"])
        end = start + F.char_length(x["value"])
        span = F.array(F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value")))
        return F.struct(F.coalesce(end, start).alias("at"),
                        F.when(x["value"].isNull(), acc["out"])
                        .otherwise(F.concat(acc["out"], span)).alias("out"))

    found = F.aggregate(parts, F.struct(F.lit(0).alias("at"), empty.alias("out")), step)["out"]
    return found if when is None else F.when(when, found).otherwise(empty)


def values_after(text: Column, name: str, value: str, when: Column) -> Column:
    """What ``value`` matches right after each match of ``name``, as (start, end, value),
    up to the next name. The pieces that ``split`` leaves between the names hold the
    values, however far a name is from its value or how long either is."""
    gaps = F.split(text, name, -1)
    names = F.regexp_extract_all(text, F.lit(name), F.lit(0))
    parts = F.transform(names, lambda x, i: F.struct(
        (F.char_length(gaps[i]) + F.char_length(x)).alias("skip"),
        F.regexp_extract(gaps[i + 1], f"^(?:{value})", 0).alias("value")))
    empty = F.array().cast(SPAN)

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["skip"]
        span = F.array(F.struct(start.alias("start"), (start + F.char_length(x["value"])).alias("end"),
                                x["value"].alias("value")))
        return F.struct(start.alias("at"), F.when(x["value"] == "", acc["out"])
                        .otherwise(F.concat(acc["out"], span)).alias("out"))

    found = F.aggregate(parts, F.struct(F.lit(0).alias("at"), empty.alias("out")), step)["out"]
    return F.when(when, found).otherwise(empty)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of ``value`` pass the Luhn check."""
    each = F.transform(F.split(F.reverse(digits(value)), ""), lambda d: d.cast("int"))
    total = F.aggregate(
        F.transform(F.filter(each, lambda d: d.isNotNull()),
                    lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)),
        F.lit(0), lambda a, d: a + d)
    return total % 10 == 0


def before(text: Column, span: Column, n: int) -> Column:
    """Up to n characters in front of a span."""
    return F.substring(text, F.greatest(span["start"] - n, F.lit(0)) + 1,
                       F.least(span["start"], F.lit(n)))


def after(text: Column, span: Column, n: int) -> Column:
    return F.substring(text, span["end"] + 1, F.lit(n))
