"""Monthly rainfall and water balance per estate (P1a, P1, P2).

``monthly_rainfall`` turns gauge readings into one row per (year, month,
estate). ``initial_balance`` runs the capped balance over the whole history;
``update_balance`` computes one new month, seeded from the stored balance of
the month before (or of last December), and returns the rows to write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palmyra.functions.periods import in_period, last_december, period_index, period_of, previous_month
from palmyra.functions.scalar import (CAPACITY, EPOCH, OPENING_RESERVE, clamp,
                                      evapotranspiration)
from palmyra.operators.balance import capped_balance, carried_balance
from palmyra.operators.skew import spread_join

BALANCE_COLUMNS = [
    "Tahun", "Bulan", "KodeKebun", "TipeKebun", "RainyDays", "RainFallValueAVG",
    "WaterReserve", "WaterEvapotranspiration", "WaterBalance", "WaterReserveAfterEvapor",
    "WaterDeficit",
]
MONTHLY_COLUMNS = ["Tahun", "Bulan", "KodeKebun", "TipeKebun", "RainyDays",
                   "RainFallValueAVG", "WaterEvapotranspiration"]


def station_multiplicity(stations: DataFrame) -> DataFrame:
    """How many station rows list each (estate, location).

    The source full-joins readings to the station table, which only repeats a
    reading once per matching station row. Joining the readings to this
    count instead gives the same sums and counts without multiplying rows."""
    return stations.groupBy("StationEstate", "StationLokasi").agg(
        F.count(F.lit(1)).alias("_mult"))


def duplicate_units(unit_types: DataFrame) -> DataFrame:
    """Units listed more than once in the unit-type table (an input error:
    each would double its estate's rows)."""
    return (unit_types.groupBy("Unit").agg(F.count(F.lit(1)).alias("listed"))
            .where(F.col("listed") > 1))


STATE_KEYS = ["Tahun", "Bulan", "Estate", "Lokasi"]


def reading_state(readings: DataFrame, *extra: str) -> DataFrame:
    """Partial aggregates of readings, one row per month, estate and location: a bitmask
    of the days (1 to 31 fit a long), the sum of the values and the count of dated
    readings. States of any two sets of readings merge (:func:`merge_state`) into that of
    both, so a month can be brought up to date from new rows and its state alone."""
    return (readings.where(F.col("RainFallValue") > 0).groupBy(*STATE_KEYS, *extra).agg(
        F.bit_or(F.expr("shiftleft(CAST(1 AS BIGINT), dayofmonth(`Date`))")).alias("Days"),
        F.sum("RainFallValue").alias("Total"), F.count(F.dayofmonth("Date")).alias("Readings")))


def merge_state(state: DataFrame) -> DataFrame:
    """One row per month, estate and location from any number of partial ones."""
    return state.groupBy(*STATE_KEYS).agg(F.bit_or("Days").alias("Days"), F.sum("Total").alias("Total"),
                                          F.sum("Readings").alias("Readings"))


def monthly_from_state(state: DataFrame, stations: DataFrame, unit_types: DataFrame,
                       *, period: tuple[int, int] | None = None, merged: bool = False) -> DataFrame:
    """Monthly rows from partial aggregates (``merged``: they are whole already). The
    station table meets one row per month and location, never the readings."""
    if period is not None:
        state = state.where(in_period("Tahun", "Bulan", period))
    mult = station_multiplicity(stations)
    r = state if merged else merge_state(state)
    r = r.join(mult, (r["Estate"] == mult["StationEstate"]) & (r["Lokasi"] == mult["StationLokasi"]),
               "left")
    w = F.coalesce(F.col("_mult"), F.lit(1))
    # Distinct days are the bits set in an OR of 1 << day; distinct locations are the
    # non-null location groups. Both levels aggregate partially before their shuffle.
    monthly = r.groupBy("Tahun", "Bulan", F.col("Estate").alias("KodeKebun")).agg(
        F.coalesce(F.bit_count(F.bit_or("Days")).cast("long"), F.lit(0).cast("long"))
        .alias("RainyDays"),
        F.try_divide(F.sum(F.col("Total") * w), F.count("Lokasi")).alias("RainFallValueAVG"),
        F.sum(F.col("Readings") * w).alias("_n_readings"),
    ).withColumn("WaterEvapotranspiration", evapotranspiration("_n_readings"))
    return (monthly.join(unit_types, monthly["KodeKebun"] == unit_types["Unit"])
            .select("Tahun", "Bulan", "KodeKebun", F.col("UnitType").alias("TipeKebun"),
                    "RainyDays", "RainFallValueAVG", "WaterEvapotranspiration"))


def monthly_rainfall(readings: DataFrame, stations: DataFrame, unit_types: DataFrame,
                     *, period: tuple[int, int] | None = None) -> DataFrame:
    if period is not None:
        readings = readings.where(in_period("Tahun", "Bulan", period))
    return monthly_from_state(reading_state(readings), stations, unit_types, merged=True)


def initial_balance(readings: DataFrame, stations: DataFrame, unit_types: DataFrame, *,
                    epoch: tuple[int, int] = EPOCH, opening: float = OPENING_RESERVE,
                    capacity: float = CAPACITY, mode: str = "reference",
                    chunk_by_year: bool = False, doubled: str | None = None) -> DataFrame:
    """Full rebuild of the balance table. ``doubled``: see ``capped_balance``.

    An estate whose first month is the epoch opens with ``opening`` in
    reserve and a balance of ``opening + mean - ET``, ET taken from the
    number of distinct rainy days; any other first month opens at 0.

    ``chunk_by_year`` runs the fold as a two-level scan (per estate-year,
    then across years), so no task ever holds more than one year of an
    estate plus one summary row per year."""
    m = monthly_rainfall(readings, stations, unit_types)
    ey, em = epoch
    bal0 = (F.lit(opening) + F.col("RainFallValueAVG")
            - evapotranspiration("RainyDays")).cast("double")
    m = m.select(
        *MONTHLY_COLUMNS,
        F.lit(float(opening)).alias("WaterReserve"),
        bal0.alias("WaterBalance"),
        clamp(bal0, 0.0, capacity).alias("WaterReserveAfterEvapor"),
        ((F.col("Tahun") == ey) & (F.col("Bulan") == em)).alias("_epoch"),
    )
    out = capped_balance(m, ["KodeKebun"], ["Tahun", "Bulan"], "RainFallValueAVG",
                         "WaterEvapotranspiration", mode=mode, capacity=capacity,
                         opening="_epoch", chunk="Tahun" if chunk_by_year else None, doubled=doubled)
    return out.select(*BALANCE_COLUMNS, *([doubled] if doubled else []))


def readings_with_stations(readings: DataFrame, stations: DataFrame) -> DataFrame:
    """The source's FULL JOIN of readings and stations on (estate, location),
    without the later positive-reading filter.

    A full outer join cannot be broadcast, so written directly it would
    shuffle every reading. Here it is the readings left-joined to the
    stations, plus the stations that match no reading, found against the
    distinct reading keys (partially aggregated before their shuffle).
    Readings without an estate or a location go round the join, and those of a
    location with a large share of all readings are dealt over several tasks."""
    keys = ["Estate", "Lokasi"]
    own = stations.select(F.col("StationEstate").alias("Estate"), F.col("StationLokasi").alias("Lokasi"),
                          "StationEstate", "StationLokasi")
    matched = spread_join(readings, own, keys).select(*readings.columns, *stations.columns)
    lonely = own.join(readings.select(*keys).distinct(), keys, "left_anti")
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in readings.schema.fields]
    return matched.unionByName(lonely.select(*missing, *stations.columns))


def history_slice(history: DataFrame, as_of, columns=BALANCE_COLUMNS) -> DataFrame:
    """Stored rows of the month before ``as_of`` and of last December
    (a UNION, so duplicates collapse). One scan with an OR filter."""
    return (history.where(in_period("Tahun", "Bulan", previous_month(as_of))
                          | in_period("Tahun", "Bulan", last_december(as_of)))
            .select(*columns).distinct())


def seed_rows(history: DataFrame, as_of) -> DataFrame:
    """Rows that carry state into the month of ``as_of``: the previous month
    if the slice holds any row of it (any estate), else last December.

    Both candidate periods lie before ``as_of``; the previous month is the
    later one whenever it exists, so the seed is the slice's latest period,
    found with a scalar subquery (no driver round trip, no cross join)."""
    s = history_slice(history, as_of)
    p = period_index("Tahun", "Bulan")
    return s.where(p == s.select(F.max(p)).scalar())


def update_balance(readings: DataFrame, stations: DataFrame, unit_types: DataFrame,
                   history: DataFrame, as_of, *, capacity: float = CAPACITY,
                   mode: str = "reference", doubled: str | None = None) -> DataFrame:
    """Rows to write for the month of ``as_of``: the seed rows (unchanged)
    and the new month's rows, whose balance carries on from the seed.

    Ordered by (year, month), so a December seed precedes January; a new
    estate without a seed opens at 0."""
    new = monthly_rainfall(readings, stations, unit_types, period=period_of(as_of))
    new = new.select(
        *MONTHLY_COLUMNS,
        *[F.lit(0.0).alias(c) for c in ("WaterReserve", "WaterBalance",
                                        "WaterReserveAfterEvapor", "WaterDeficit")],
        F.lit(False).alias("_seed"))
    seed = seed_rows(history, as_of).withColumn("_seed", F.lit(True))
    frame = seed.unionByName(new)
    out = capped_balance(frame, ["KodeKebun"], ["Tahun", "Bulan"], "RainFallValueAVG",
                         "WaterEvapotranspiration", mode=mode, capacity=capacity,
                         fixed="_seed", doubled=doubled)
    return out.select(*BALANCE_COLUMNS, *([doubled] if doubled else []))


def update_balance_from(monthly: DataFrame, history: DataFrame, first: tuple[int, int], *,
                        capacity: float = CAPACITY, mode: str = "reference",
                        doubled: str | None = None) -> DataFrame:
    """Rows of every month from ``first`` on, as :func:`update_balance` run month by month
    leaves them: computed from ``monthly``, beside the stored rows whose keys it does not
    have. One plan, whatever the number of months.

    Each month carries on from its seed period: the month before, or last December where
    that holds no row of any estate (January: last December). Which months hold rows is
    known beforehand, so the seed period is a column, and every estate's months are folded
    in one pass that keeps the last row's state and the last December's."""
    p = period_index("Tahun", "Bulan")
    start = first[0] * 12 + first[1] - 1
    keys = ["Tahun", "Bulan", "KodeKebun"]
    new = monthly.where(p >= start)
    stored = history.where(p >= start)
    kept = stored.join(new.select(*keys).distinct(), keys, "left_anti").select(*BALANCE_COLUMNS)
    december = (first[0] - 1) * 12 + 11
    before = history.where((p < start) & ((p == start - 1) | (p == december))).select(*BALANCE_COLUMNS)

    nothing = [F.lit(0.0).alias(c) for c in ("WaterReserve", "WaterBalance",
                                             "WaterReserveAfterEvapor", "WaterDeficit")]
    rows = (new.select(*MONTHLY_COLUMNS, *nothing).withColumn("_kept", F.lit(False))
            .unionByName(kept.withColumn("_kept", F.lit(True)))
            .unionByName(before.distinct().withColumn("_kept", F.lit(True)))
            .withColumn("_period", p))
    held = rows.select("_period").distinct()        # one row per calendar month
    ahead = held.select((F.col("_period") + 1).alias("_period"), F.lit(True).alias("_follows"))
    seeds = held.join(ahead, "_period", "left").select(
        "_period", F.when(F.col("_follows"), F.col("_period") - 1)
        .otherwise(F.floor(F.col("_period") / 12) * 12 - 1).cast("int").alias("_seed"))
    out = carried_balance(rows.join(seeds, "_period"), ["KodeKebun"], "_period", "_seed",
                          "RainFallValueAVG", "WaterEvapotranspiration", mode=mode,
                          capacity=capacity, fixed="_kept", keep="_kept", doubled=doubled)
    more = [doubled] if doubled else []
    computed = out.where(~F.col("_kept")).select(*BALANCE_COLUMNS, *more)
    return computed.unionByName(kept.select("*", *(F.lit(0).alias(c) for c in more)))
