"""Registered queries (Spark) and their DuckDB oracle SQL.

Each query runs a library operator or job on the stand-in tables over the
whole driver tables; the oracle states the same result in plain SQL in the
shape of the source jobs (full join, correlated totals by self-join,
recursive CTE for the balance). Doubles are rounded to 6 decimals on both
sides with the same formula, ``round(x * 1e6) / 1e6``, and a zero is always
written as +0.0. Dates are presented as ISO text on both sides.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palmyra.checks.standins import standin, with_standins
from palmyra.functions.periods import in_period, period_index
from palmyra.functions.scalar import CAPACITY as FIXED_CAPACITY
from palmyra.functions.scalar import DEFAULT_BJR, OPENING_RESERVE, guarded_divide
from palmyra.operators.fill import forward_fill
from palmyra.operators.proration import netto_totals
from palmyra.operators.refresh import append, replace_all, replace_keys, replace_where
from palmyra.plans import bjr as bjr_plan
from palmyra.plans import jobs, rainfall, weighbridge
from palmyra.sources.bucketed import bucket_count, colocating_session, open_bucketed, write_bucketed
from palmyra.sources.ordered import read_ordered, write_ordered
from palmyra.sources.tables import positional
from palmyra.sources.workbook import export_workbook, load_workbook
from palmyra.sources.writers import (cut_lineage, export_csv, live_slots, read_csv, scratch_path,
                                     slot_values)

# Parameters of the stand-in runs.
EPOCH = (1995, 1)
OPENING = OPENING_RESERVE
CAPACITY = FIXED_CAPACITY
AS_OF_UPDATE = dt.date(1998, 6, 15)
AS_OF_JANUARY = dt.date(1998, 1, 20)
AS_OF_FALLBACK = dt.date(1998, 5, 10)
AS_OF_UNION = dt.date(1999, 3, 1)
AS_OF_BJR = dt.date(1998, 3, 15)
AS_OF_WB = dt.date(1998, 6, 30)
FOLD_BEFORE = (1999, 1)        # months before this one are closed
LATE_FROM = (1997, 11)
BLOCK_EXCLUDE = ("PROMO",)     # division = part type
BLOCK_CODE_LEN = 7             # block = brand, "Brand#1".."Brand#9"
WB_EXCLUDE = ("P",)            # division = order status
BUCKETS = 8


def half_up(x):
    """``F.round(x)`` of doubles, without the decimal number that Spark makes of each: the
    nearest whole number, and of two that are equally near the one further from zero."""
    near = F.rint(x)
    return F.when(F.abs(x - near) == 0.5, x + F.signum(x) * 0.5).otherwise(near)


def _r(c):
    return half_up(c * 1e6) / 1e6 + 0.0     # -0.0 + 0.0 is 0.0: no negative zero


def _presented(f: T.StructField):
    if isinstance(f.dataType, T.DoubleType):
        return _r(F.col(f.name)).alias(f.name)
    if isinstance(f.dataType, T.DateType):  # ISO text: same value on any client path
        return F.col(f.name).cast("string").alias(f.name)
    return F.col(f.name)


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[_presented(f) for f in df.schema.fields])


def R(x: str) -> str:
    r = f"(round(({x}) * 1e6) / 1e6)"
    return f"CASE WHEN {r} = 0 THEN 0.0 ELSE {r} END"


def GD(n: str, d: str) -> str:
    n, d = f"({n})", f"({d})"
    return (f"CASE WHEN {n} IS NULL OR {d} IS NULL THEN CAST(NULL AS DOUBLE) "
            f"WHEN {d} = 0 AND {n} = 0 THEN 0.0 "
            f"WHEN {d} = 0 AND {n} > 0 THEN CAST('inf' AS DOUBLE) "
            f"WHEN {d} = 0 THEN CAST('-inf' AS DOUBLE) "
            f"ELSE CAST({n} AS DOUBLE) / {d} END")


def CLAMP(x: str, cap: float = CAPACITY) -> str:
    return (f"CAST(CASE WHEN ({x}) <= 0 THEN 0.0 WHEN ({x}) >= {cap} THEN {cap} "
            f"ELSE ({x}) END AS DOUBLE)")


def DEFICIT(x: str) -> str:
    return f"CASE WHEN ({x}) < 0 THEN -({x}) WHEN ({x}) >= 0 THEN 0.0 END"


# ---------------------------------------------------------------- rainfall

def _rain_inputs(spark, d):
    return (standin(spark, d, "readings"), standin(spark, d, "stations"),
            standin(spark, d, "unit_types"))


def q_monthly_rainfall(spark: SparkSession, d: str) -> DataFrame:
    return rounded(rainfall.monthly_rainfall(*_rain_inputs(spark, d)))


def q_full_join_stations(spark: SparkSession, d: str) -> DataFrame:
    readings, stations, _ = _rain_inputs(spark, d)
    return rounded(rainfall.readings_with_stations(readings, stations))


def _initial(spark, d, mode, chunk_by_year=False):
    return rainfall.initial_balance(*_rain_inputs(spark, d), epoch=EPOCH, opening=OPENING,
                                    capacity=CAPACITY, mode=mode, chunk_by_year=chunk_by_year)


def q_initial_balance_reference(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_initial(spark, d, "reference"))


def q_initial_balance_intended(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_initial(spark, d, "intended"))


def q_initial_balance_chunked(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_initial(spark, d, "reference", chunk_by_year=True))


def _update(spark, d, as_of, history_filter, mode="reference"):
    # The stored balance table: written once to the shared checkpoint folder,
    # as the monthly job reads it from storage.
    history = cut_lineage(_initial(spark, d, mode).where(history_filter))
    return rounded(rainfall.update_balance(*_rain_inputs(spark, d), history, as_of,
                                           capacity=CAPACITY, mode=mode))


def _before(as_of):
    return period_index("Tahun", "Bulan") < F.lit(as_of.year * 12 + as_of.month - 1)


def q_update_balance(spark: SparkSession, d: str) -> DataFrame:
    return _update(spark, d, AS_OF_UPDATE, _before(AS_OF_UPDATE))


def q_update_balance_intended(spark: SparkSession, d: str) -> DataFrame:
    return _update(spark, d, AS_OF_UPDATE, _before(AS_OF_UPDATE), mode="intended")


def q_update_balance_january(spark: SparkSession, d: str) -> DataFrame:
    return _update(spark, d, AS_OF_JANUARY, _before(AS_OF_JANUARY))


def q_update_balance_fallback(spark: SparkSession, d: str) -> DataFrame:
    # The month before as_of is missing from the history: seed from December.
    return _update(spark, d, AS_OF_FALLBACK, F.col("Tahun") < AS_OF_FALLBACK.year)


def q_period_union(spark: SparkSession, d: str) -> DataFrame:
    cols = ["Tahun", "Bulan", "KodeKebun", "TipeKebun"]
    hist = standin(spark, d, "order_history").select(*cols)
    return rainfall.history_slice(hist, AS_OF_UNION, columns=cols)


# ---------------------------------------------------------------- BJR

def _block_inputs(spark, d):
    return (standin(spark, d, "block_fact"), standin(spark, d, "unit"),
            standin(spark, d, "division"), standin(spark, d, "block"))


def q_block_bjr_top1(spark: SparkSession, d: str) -> DataFrame:
    return rounded(bjr_plan.block_bjr(*_block_inputs(spark, d)))


def q_block_bjr_month(spark: SparkSession, d: str) -> DataFrame:
    return rounded(bjr_plan.block_bjr(*_block_inputs(spark, d), as_of=AS_OF_BJR))


def _lineitem_fill(spark, d, chunk):
    li = spark.read.parquet(f"{d}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_shipdate").cast("date").alias("l_shipdate"), "l_discount")
    if chunk:
        li = li.withColumn("_year", F.year("l_shipdate"))
    out = forward_fill(li, "l_discount", ["l_partkey"],
                       ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey"],
                       "filled", default=DEFAULT_BJR, chunk="_year" if chunk else None)
    return rounded(out.drop("_year"))


def q_ffill_zero_missing(spark: SparkSession, d: str) -> DataFrame:
    return _lineitem_fill(spark, d, chunk=False)


def q_ffill_zero_missing_chunked(spark: SparkSession, d: str) -> DataFrame:
    return _lineitem_fill(spark, d, chunk=True)


def q_clean_bjr(spark: SparkSession, d: str) -> DataFrame:
    extract = bjr_plan.block_bjr(*_block_inputs(spark, d))
    return rounded(bjr_plan.clean_bjr(extract, exclude=BLOCK_EXCLUDE, code_len=BLOCK_CODE_LEN))


def q_load_bjr(spark: SparkSession, d: str) -> DataFrame:
    existing = standin(spark, d, "bjr")
    return rounded(bjr_plan.load_bjr(*_block_inputs(spark, d), existing, AS_OF_BJR,
                                     exclude=BLOCK_EXCLUDE, code_len=BLOCK_CODE_LEN))


# ---------------------------------------------------------------- weighbridge

def _wb_inputs(spark, d):
    bjr = bjr_plan.clean_bjr(standin(spark, d, "bjr"), exclude=WB_EXCLUDE)
    return bjr, standin(spark, d, "weighbridge")


def _stored_wb_inputs(spark, wh):
    """The same rows from the warehouse, which holds them already."""
    return (bjr_plan.clean_bjr(wh.read(spark, "bjr"), exclude=WB_EXCLUDE),
            wh.read(spark, "weighbridge"))


def q_kg_actual(spark: SparkSession, d: str) -> DataFrame:
    # Janjang is a nullable count here; presented as DOUBLE on both sides so
    # every client (tuples or pandas) sees NULL the same way.
    out = weighbridge.kg_actual(*_wb_inputs(spark, d))
    return rounded(out.withColumn("Janjang", F.col("Janjang").cast("double")))


def q_netto_totals(spark: SparkSession, d: str) -> DataFrame:
    rows = weighbridge.kg_actual(*_wb_inputs(spark, d))
    return rounded(netto_totals(rows, weighbridge.GROUP))


def q_prorate_netto(spark: SparkSession, d: str) -> DataFrame:
    return rounded(weighbridge.prorate_netto(*_wb_inputs(spark, d)))


def q_prorate_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """Both sides stored bucketed, as one slice, then prorated without a shuffle of the
    weighbridge rows."""
    bjr, wb = _wb_inputs(spark, d)
    at, buckets = {}, bucket_count(wb, BUCKETS)
    for name, rows in (("bjr", bjr), ("wb", weighbridge.with_month(wb))):
        at[name] = scratch_path(spark, f"bucketed-{name}")
        write_bucketed(rows, at[name], 0, weighbridge.BUCKET_KEYS, buckets)
    own = colocating_session(spark)
    return rounded(weighbridge.prorate_colocated(open_bucketed(own, at["bjr"]),
                                                 open_bucketed(own, at["wb"])))


def q_load_wb_actual(spark: SparkSession, d: str) -> DataFrame:
    # Both tables are read four times (totals and rows, of all years and of one), so they
    # are stored first; the stand-ins' joins would else run each time.
    bjr, wb = (cut_lineage(standin(spark, d, t), t) for t in ("bjr", "weighbridge"))
    existing = cut_lineage(weighbridge.prorate_netto(bjr_plan.clean_bjr(bjr, exclude=WB_EXCLUDE), wb))
    return rounded(weighbridge.load_wb_actual(bjr, wb, existing, AS_OF_WB, exclude=WB_EXCLUDE))


def q_guarded_division(spark: SparkSession, d: str) -> DataFrame:
    li = spark.read.parquet(f"{d}/lineitem.parquet")
    return rounded(li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        guarded_divide(F.col("l_quantity") * F.col("l_discount"), F.col("l_tax")).alias("ratio"),
        guarded_divide(F.col("l_discount") - 0.05, F.col("l_tax")).alias("ratio_signed")))


# ---------------------------------------------------------------- refresh

def _orders(spark, d):
    return standin(spark, d, "order_history")


def q_replace_month(spark: SparkSession, d: str) -> DataFrame:
    h = _orders(spark, d)
    new = (h.where(in_period("Tahun", "Bulan", (1999, 3)) & (F.col("TipeKebun") != "F"))
           .withColumn("o_totalprice", F.col("o_totalprice") * 2))
    return rounded(replace_where(h, new, in_period("Tahun", "Bulan", (1999, 3))))


def q_replace_year(spark: SparkSession, d: str) -> DataFrame:
    h = _orders(spark, d)
    new = (h.where((F.col("Tahun") == 1999) & (F.col("TipeKebun") == "O"))
           .withColumn("o_totalprice", F.col("o_totalprice") + 1))
    return rounded(replace_where(h, new, F.col("Tahun") == 1999))


def q_replace_keys(spark: SparkSession, d: str) -> DataFrame:
    h = _orders(spark, d)
    new = (h.where(in_period("Tahun", "Bulan", (1999, 3))
                   & F.col("KodeKebun").isin("1-URGENT", "2-HIGH") & (F.col("TipeKebun") == "O"))
           .withColumn("o_totalprice", F.col("o_totalprice") * 3))
    return rounded(replace_keys(h, new, ["Tahun", "Bulan", "KodeKebun"]))


def _order_summary(h):
    return h.groupBy("Tahun", "Bulan", "KodeKebun", "TipeKebun").agg(
        F.max("o_orderkey").alias("o_orderkey"), F.sum("o_totalprice").alias("o_totalprice"))


def q_replace_all(spark: SparkSession, d: str) -> DataFrame:
    h = _orders(spark, d)
    return rounded(replace_all(h, _order_summary(h)))


def q_append_rows(spark: SparkSession, d: str) -> DataFrame:
    h = _orders(spark, d)
    return rounded(append(h, _order_summary(h)))


def q_csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    h = _orders(spark, d)
    path = scratch_path(spark, "csv_roundtrip")
    export_csv(h, path)
    schema = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(h.schema)])
    back = read_csv(spark, path, schema)
    return rounded(positional(back, h.columns))


def q_workbook_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Written as workbook parts, one a task, and read back."""
    path = scratch_path(spark, "workbook-export")
    h = standin(spark, d, "order_history")
    export_workbook(h, path)
    return rounded(load_workbook(spark, path, h.schema))


def q_ordered_by_estate(spark: SparkSession, d: str) -> DataFrame:
    """Monthly rainfall written in the order of estate and month; each row's position
    comes from the files, read in the order of their names."""
    path = scratch_path(spark, "ordered")
    write_ordered(rainfall.monthly_rainfall(*_rain_inputs(spark, d)), path, ["KodeKebun", "Tahun", "Bulan"])
    return read_ordered(spark, path).select("position", "KodeKebun", "Tahun", "Bulan", "RainyDays")


# ---------------------------------------------------------------- jobs

def _warehouse(spark, d, *tables):
    wh = jobs.Warehouse(scratch_path(spark, "job-warehouse"))
    for t in tables:
        if t == "readings":
            jobs.append_readings(standin(spark, d, t), wh, "load", 0)
        else:
            jobs.write_table(standin(spark, d, t), wh, t)
    return wh


def q_append_store(spark: SparkSession, d: str) -> DataFrame:
    """Two sources append, one of them twice under one batch number: its first try also
    had rows of months that the second has none of, which must go."""
    wh = _warehouse(spark, d)
    readings = standin(spark, d, "readings")
    early = F.col("Tahun") < 1996
    jobs.append_readings(readings.where(F.col("Tahun") < 1997), wh, "load", 0)
    jobs.append_readings(readings.where(early), wh, "load", 0)
    jobs.append_readings(readings.where(~early), wh, "stream", 0)
    return rounded(wh.read(spark, "readings"))


def _batch_of(name: str = "readings"):
    """Three batches, each with rows of all months: so two of them bring late rows."""
    day = F.dayofmonth("Date")
    return F.when(day % 3 == 0, 0).when(day % 3 == 1, 1).otherwise(2)


def _in_batches(spark: SparkSession, d: str, wh: jobs.Warehouse) -> None:
    readings = standin(spark, d, "readings").withColumn("_batch", _batch_of())
    jobs.append_readings(readings.where("_batch < 2").drop("_batch"), wh, "load", 0)    # a first try
    for i in range(3):
        jobs.append_readings(readings.where(F.col("_batch") == i).drop("_batch"), wh, "load", i)


def q_monthly_rainfall_merged(spark: SparkSession, d: str) -> DataFrame:
    """Monthly rows from the stored partial aggregates of three batches; closed months'
    batches are folded before the last one comes."""
    wh = _warehouse(spark, d, "stations", "unit_types")
    _in_batches(spark, d, wh)
    jobs.fold_batches(spark, wh, FOLD_BEFORE)
    return rounded(rainfall.monthly_from_state(wh.read(spark, "rainfall_state"), wh.read(spark, "stations"),
                                               wh.read(spark, "unit_types")))


def q_folded_slots(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each month of the readings table after folding, with its slots."""
    wh = _warehouse(spark, d)
    _in_batches(spark, d, wh)
    jobs.append_readings(standin(spark, d, "readings").limit(0), wh, "load", 3)
    jobs.fold_batches(spark, wh, FOLD_BEFORE)
    slots = [slot_values(x) for x in live_slots(spark, wh.path("readings"))[1]]
    counted = spark.createDataFrame([(int(v["Tahun"]), int(v["Bulan"]), 1) for v in slots],
                                    "Tahun int, Bulan int, one int")
    return (wh.read(spark, "readings").groupBy("Tahun", "Bulan").agg(F.count("*").alias("n_rows"))
            .join(counted.groupBy("Tahun", "Bulan").agg(F.sum("one").alias("n_slots")), ["Tahun", "Bulan"]))


def q_late_update_store(spark: SparkSession, d: str) -> DataFrame:
    """The balance was stored without the readings of some days; those arrive late, and
    one job brings all months from the first one that they touch up to date."""
    wh = _warehouse(spark, d, "stations", "unit_types")
    readings = standin(spark, d, "readings")
    late = _is_late()
    jobs.append_readings(readings.where(~late), wh, "load", 0)
    jobs.run_initial_balance(spark, wh, epoch=EPOCH, opening=OPENING, capacity=CAPACITY, mode="intended")
    jobs.append_readings(readings.where(late), wh, "stream", 0)
    jobs.run_balance_from(spark, wh, *LATE_FROM, capacity=CAPACITY, mode="intended")
    return rounded(wh.read(spark, "rainfall_balance"))


def _is_late():
    return (F.col("Tahun") * 12 + F.col("Bulan") >= LATE_FROM[0] * 12 + LATE_FROM[1]) \
        & (F.dayofmonth("Date") % 5 == 0)


def q_job_p1_store(spark: SparkSession, d: str) -> DataFrame:
    wh = _warehouse(spark, d, *RAIN)
    jobs.run_initial_balance(spark, wh, epoch=EPOCH, opening=OPENING, capacity=CAPACITY)
    return rounded(wh.read(spark, "rainfall_balance"))


def q_job_p2_store(spark: SparkSession, d: str) -> DataFrame:
    """The stored month starts with other values, and one estate more."""
    wh = _warehouse(spark, d, *RAIN)
    y, m = AS_OF_UPDATE.year, AS_OF_UPDATE.month
    history = cut_lineage(_initial(spark, d, "reference").where(_before(AS_OF_UPDATE)))
    stale = (rainfall.update_balance(*_rain_inputs(spark, d), history, AS_OF_UPDATE, capacity=CAPACITY)
             .where(in_period("Tahun", "Bulan", (y, m))).withColumn("WaterBalance", F.lit(-1.0)))
    other = spark.createDataFrame([(y, m, "OTHER", "OTHER", 1, 2.0, 3.0, 120, 4.0, 5.0, 6.0)],
                                  stale.schema)
    jobs.write_table(history.unionByName(stale).unionByName(other), wh, "rainfall_balance")
    jobs.run_monthly_balance(spark, wh, AS_OF_UPDATE, capacity=CAPACITY)
    return rounded(wh.read(spark, "rainfall_balance", Tahun=y, Bulan=m))


def q_job_p3_store(spark: SparkSession, d: str) -> DataFrame:
    wh = _warehouse(spark, d, *BLOCK, "bjr")
    jobs.run_bjr(spark, wh, AS_OF_BJR, exclude=BLOCK_EXCLUDE, code_len=BLOCK_CODE_LEN)
    return rounded(wh.read(spark, "bjr"))


def q_job_p4_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """As ``job_p4_store``, on the year's bucketed weighbridge."""
    wh = _warehouse(spark, d, "weighbridge", "bjr")
    jobs.write_table(weighbridge.prorate_netto(*_stored_wb_inputs(spark, wh))
                     .where(F.year("FullDate") != AS_OF_WB.year), wh, "wb_actual", as_dealt=True)
    buckets = bucket_count(wh.read(spark, "weighbridge", Year=AS_OF_WB.year), BUCKETS)
    jobs.bucket_weighbridge(spark, wh, AS_OF_WB.year, buckets)
    jobs.run_wb_actual(spark, wh, AS_OF_WB, buckets=buckets, exclude=WB_EXCLUDE)
    return rounded(wh.read(spark, "wb_actual"))


def q_job_p4_store(spark: SparkSession, d: str) -> DataFrame:
    """The stored year starts with other values; the other years stay."""
    wh = _warehouse(spark, d, "weighbridge", "bjr")
    stored = weighbridge.prorate_netto(*_stored_wb_inputs(spark, wh))
    jobs.write_table(stored.withColumn("KG_PKS", F.when(F.year("FullDate") == AS_OF_WB.year, -1.0)
                                       .otherwise(F.col("KG_PKS"))), wh, "wb_actual", as_dealt=True)
    jobs.run_wb_actual(spark, wh, AS_OF_WB, exclude=WB_EXCLUDE)
    return rounded(wh.read(spark, "wb_actual"))


QUERIES = {
    "append_store": q_append_store,
    "monthly_rainfall_merged": q_monthly_rainfall_merged,
    "folded_slots": q_folded_slots,
    "late_update_store": q_late_update_store,
    "job_p1_store": q_job_p1_store,
    "job_p2_store": q_job_p2_store,
    "job_p3_store": q_job_p3_store,
    "job_p4_store": q_job_p4_store,
    "job_p4_bucketed": q_job_p4_bucketed,
    "monthly_rainfall": q_monthly_rainfall,
    "full_join_stations": q_full_join_stations,
    "initial_balance_reference": q_initial_balance_reference,
    "initial_balance_intended": q_initial_balance_intended,
    "initial_balance_chunked": q_initial_balance_chunked,
    "update_balance": q_update_balance,
    "update_balance_intended": q_update_balance_intended,
    "update_balance_january": q_update_balance_january,
    "update_balance_fallback": q_update_balance_fallback,
    "period_union": q_period_union,
    "block_bjr_top1": q_block_bjr_top1,
    "block_bjr_month": q_block_bjr_month,
    "ffill_zero_missing": q_ffill_zero_missing,
    "ffill_zero_missing_chunked": q_ffill_zero_missing_chunked,
    "clean_bjr": q_clean_bjr,
    "load_bjr": q_load_bjr,
    "kg_actual": q_kg_actual,
    "netto_totals": q_netto_totals,
    "prorate_netto": q_prorate_netto,
    "prorate_bucketed": q_prorate_bucketed,
    "load_wb_actual": q_load_wb_actual,
    "guarded_division": q_guarded_division,
    "replace_month": q_replace_month,
    "replace_year": q_replace_year,
    "replace_keys": q_replace_keys,
    "replace_all": q_replace_all,
    "append_rows": q_append_rows,
    "csv_roundtrip": q_csv_roundtrip,
    "workbook_roundtrip": q_workbook_roundtrip,
    "ordered_by_estate": q_ordered_by_estate,
}


# ================================================================ oracle SQL

RAIN = ["readings", "stations", "unit_types"]

MONTHLY_CTE = """
monthly AS (
  SELECT a.Tahun, a.Bulan, a.Estate AS KodeKebun,
         count(DISTINCT day(a.Date)) AS RainyDays,
         sum(coalesce(a.RainFallValue, 0)) / nullif(count(DISTINCT a.Lokasi), 0) AS avg_rain,
         CASE WHEN count(day(a.Date)) <= 10 THEN 150 ELSE 120 END AS et
  FROM readings a
  FULL JOIN stations b ON b.StationEstate = a.Estate AND b.StationLokasi = a.Lokasi
  WHERE a.RainFallValue > 0
  GROUP BY a.Tahun, a.Bulan, a.Estate),
mt AS (
  SELECT m.Tahun, m.Bulan, m.KodeKebun, u.UnitType AS TipeKebun,
         CAST(m.RainyDays AS BIGINT) AS RainyDays, CAST(m.avg_rain AS DOUBLE) AS avg_rain,
         CAST(m.et AS INT) AS et
  FROM monthly m JOIN unit_types u ON u.Unit = m.KodeKebun)"""


def _balance_ctes(mode: str) -> str:
    ey, em = EPOCH
    epoch = f"(Tahun = {ey} AND Bulan = {em})"
    bal0 = (f"CASE WHEN {epoch} THEN ({OPENING} + avg_rain) - "
            f"(CASE WHEN RainyDays <= 10 THEN 150 ELSE 120 END) "
            f"ELSE (avg_rain + 0.0) - et END")
    prev = "r.reserve" if mode == "reference" else "r.close"
    return f""",
{MONTHLY_CTE.strip()},
seq AS (SELECT *, row_number() OVER (PARTITION BY KodeKebun ORDER BY Tahun, Bulan) AS rn FROM mt),
rec AS (
  SELECT KodeKebun, rn, Tahun, Bulan, TipeKebun, RainyDays, avg_rain, et,
         CAST(CASE WHEN {epoch} THEN {OPENING} ELSE 0.0 END AS DOUBLE) AS reserve,
         CAST({bal0} AS DOUBLE) AS bal,
         {CLAMP(bal0)} AS close
  FROM seq WHERE rn = 1
  UNION ALL
  SELECT s.KodeKebun, s.rn, s.Tahun, s.Bulan, s.TipeKebun, s.RainyDays, s.avg_rain, s.et,
         r.close AS reserve,
         CAST((s.avg_rain + {prev}) - s.et AS DOUBLE) AS bal,
         {CLAMP(f"(s.avg_rain + {prev}) - s.et")} AS close
  FROM rec r JOIN seq s ON s.KodeKebun = r.KodeKebun AND s.rn = r.rn + 1),
init AS (
  SELECT Tahun, Bulan, KodeKebun, TipeKebun, RainyDays, avg_rain AS RainFallValueAVG,
         reserve AS WaterReserve, et AS WaterEvapotranspiration, bal AS WaterBalance,
         close AS WaterReserveAfterEvapor, {DEFICIT("bal")} AS WaterDeficit
  FROM rec)"""


BALANCE_SELECT = f"""
SELECT Tahun, Bulan, KodeKebun, TipeKebun, RainyDays, {R("RainFallValueAVG")} AS RainFallValueAVG,
       {R("WaterReserve")} AS WaterReserve, WaterEvapotranspiration,
       {R("WaterBalance")} AS WaterBalance, {R("WaterReserveAfterEvapor")} AS WaterReserveAfterEvapor,
       {R("WaterDeficit")} AS WaterDeficit"""


def _sql_initial(mode: str) -> str:
    return with_standins(RAIN, _balance_ctes(mode) + BALANCE_SELECT + " FROM init",
                         recursive=True)


def _sql_update(as_of: dt.date, history_where: str, mode: str = "reference") -> str:
    y, m = as_of.year, as_of.month
    prev = "s.WaterReserve" if mode == "reference" else "s.WaterReserveAfterEvapor"
    body = _balance_ctes(mode) + f""",
hist AS (SELECT * FROM init WHERE {history_where}),
slice AS (
  SELECT * FROM hist WHERE Tahun = {y} AND Bulan = {m - 1}
  UNION
  SELECT * FROM hist WHERE Tahun = {y - 1} AND Bulan = 12),
seed AS (
  SELECT * FROM slice
  WHERE Tahun * 12 + Bulan = (SELECT max(Tahun * 12 + Bulan) FROM slice)),
newm AS (SELECT * FROM mt WHERE Tahun = {y} AND Bulan = {m}),
newc AS (
  SELECT n.Tahun, n.Bulan, n.KodeKebun, n.TipeKebun, n.RainyDays, n.avg_rain AS RainFallValueAVG,
         CASE WHEN s.KodeKebun IS NULL THEN 0.0 ELSE s.WaterReserveAfterEvapor END AS WaterReserve,
         n.et AS WaterEvapotranspiration,
         CAST((n.avg_rain + CASE WHEN s.KodeKebun IS NULL THEN 0.0 ELSE {prev} END) - n.et AS DOUBLE) AS WaterBalance
  FROM newm n LEFT JOIN seed s ON s.KodeKebun = n.KodeKebun),
frame AS (
  SELECT Tahun, Bulan, KodeKebun, TipeKebun, RainyDays, RainFallValueAVG, WaterReserve,
         WaterEvapotranspiration, WaterBalance, WaterReserveAfterEvapor,
         {DEFICIT("WaterBalance")} AS WaterDeficit
  FROM seed
  UNION ALL
  SELECT Tahun, Bulan, KodeKebun, TipeKebun, RainyDays, RainFallValueAVG, WaterReserve,
         WaterEvapotranspiration, WaterBalance, {CLAMP("WaterBalance")} AS WaterReserveAfterEvapor,
         {DEFICIT("WaterBalance")} AS WaterDeficit
  FROM newc)""" + BALANCE_SELECT + " FROM frame"
    return with_standins(RAIN, body, recursive=True)


def _sql_late() -> str:
    """The stored balance before the late readings; then every month from LATE_FROM on,
    each estate's rows carrying on from the seed period of their month."""
    first = 12 * LATE_FROM[0] + LATE_FROM[1]
    early = with_standins(RAIN, "").replace(
        "FROM lineitem)", f"FROM lineitem WHERE NOT (year(l_shipdate) * 12 + month(l_shipdate) >= {first}"
        " AND day(l_shipdate) % 5 = 0))", 1)
    columns = ("Tahun, Bulan, KodeKebun, TipeKebun, RainyDays, RainFallValueAVG, WaterReserve,"
               " WaterEvapotranspiration, WaterBalance, WaterReserveAfterEvapor, WaterDeficit")
    whole = with_standins(RAIN, ", " + MONTHLY_CTE.strip() + " SELECT * FROM mt")
    stored = early.replace("WITH ", "WITH RECURSIVE ", 1) + _balance_ctes("intended") + " SELECT * FROM init"
    return f"""
WITH RECURSIVE stored AS MATERIALIZED ({stored}),
whole AS MATERIALIZED ({whole}),
new AS (SELECT * FROM whole WHERE Tahun * 12 + Bulan >= {first}),
kept AS (
  SELECT {columns} FROM stored s WHERE Tahun * 12 + Bulan >= {first} AND NOT EXISTS (
    SELECT 1 FROM new n WHERE n.Tahun = s.Tahun AND n.Bulan = s.Bulan AND n.KodeKebun = s.KodeKebun)),
fixed AS (SELECT {columns} FROM stored WHERE Tahun * 12 + Bulan < {first} UNION ALL SELECT {columns} FROM kept),
held AS (SELECT DISTINCT Tahun * 12 + Bulan AS p FROM fixed UNION SELECT DISTINCT Tahun * 12 + Bulan FROM new),
todo AS (
  SELECT n.*, n.Tahun * 12 + n.Bulan AS p,
         CASE WHEN n.Tahun * 12 + n.Bulan - 1 IN (SELECT p FROM held) THEN n.Tahun * 12 + n.Bulan - 1
              ELSE n.Tahun * 12 END AS seed FROM new n),
chain AS (
  SELECT Tahun * 12 + Bulan AS p, {columns} FROM fixed
  UNION ALL
  SELECT t.p, t.Tahun, t.Bulan, t.KodeKebun, t.TipeKebun, t.RainyDays, t.avg_rain, 0.0, t.et,
         CAST(t.avg_rain - t.et AS DOUBLE), {CLAMP("t.avg_rain - t.et")}, {DEFICIT("t.avg_rain - t.et")}
  FROM todo t WHERE NOT EXISTS (SELECT 1 FROM fixed f WHERE f.KodeKebun = t.KodeKebun
                                AND f.Tahun * 12 + f.Bulan = t.seed)
    AND NOT EXISTS (SELECT 1 FROM todo o WHERE o.KodeKebun = t.KodeKebun AND o.p = t.seed)
  UNION ALL
  SELECT t.p, t.Tahun, t.Bulan, t.KodeKebun, t.TipeKebun, t.RainyDays, t.avg_rain,
         c.WaterReserveAfterEvapor, t.et,
         CAST((t.avg_rain + c.WaterReserveAfterEvapor) - t.et AS DOUBLE),
         {CLAMP("(t.avg_rain + c.WaterReserveAfterEvapor) - t.et")},
         {DEFICIT("(t.avg_rain + c.WaterReserveAfterEvapor) - t.et")}
  FROM chain c JOIN todo t ON t.KodeKebun = c.KodeKebun AND t.seed = c.p)
""" + BALANCE_SELECT + " FROM chain"


def _idx(d: dt.date) -> int:
    return d.year * 12 + d.month


BLOCK = ["block_fact", "unit", "division", "block"]


def _top1_cte(where: str = "") -> str:
    return f""",
ranked AS (
  SELECT row_number() OVER (
           PARTITION BY a.Year, a.Month, b.UnitCode, c.DivisionCode, d.KodeBlok
           ORDER BY a.BJRPabrik DESC NULLS FIRST,
                    CAST(year(a.TanggalTanam) AS BIGINT) ASC NULLS LAST,
                    a.LuasTanahYangDitanam ASC NULLS LAST, a.JenisKegiatan ASC NULLS LAST,
                    a.BJRSensus ASC NULLS LAST) AS RN,
         a.Year, a.Month, b.UnitCode AS KodeKebun, c.DivisionCode AS KodeDivisi, d.KodeBlok,
         CAST(year(a.TanggalTanam) AS BIGINT) AS TahunTanam,
         a.LuasTanahYangDitanam AS LuasTanam, a.JenisKegiatan, a.BJRPabrik, a.BJRSensus
  FROM block_fact a
  JOIN unit b ON a.UnitID = b.UnitID
  JOIN division c ON a.DivisionID = c.DivisionID
  JOIN block d ON d.BlokID = a.BlokID
  {where}),
top1 AS (
  SELECT Year AS Tahun, Month AS Bulan, KodeKebun, KodeDivisi, KodeBlok, TahunTanam,
         JenisKegiatan, sum(LuasTanam) AS LuasTanam, sum(BJRPabrik) AS BJRPabrik,
         sum(BJRSensus) AS BJRSensus
  FROM ranked WHERE RN = 1
  GROUP BY Year, Month, KodeKebun, KodeDivisi, KodeBlok, TahunTanam, JenisKegiatan)"""


def _clean_ctes(src: str, name: str, exclude, code_len: int) -> str:
    excl = ", ".join(f"'{v}'" for v in exclude)
    return f""",
{name}_0 AS (
  SELECT Tahun, Bulan, KodeKebun, KodeDivisi, KodeBlok, CAST(TahunTanam AS BIGINT) AS TahunTanam,
         JenisKegiatan, LuasTanam, coalesce(BJRSensus, 0.0) AS BJRSensus,
         coalesce(BJRPabrik, 0.0) AS BJRPabrik
  FROM {src}),
{name}_1 AS (
  SELECT *, CASE WHEN KodeKebun IS NULL OR KodeBlok IS NULL THEN NULL
                 ELSE last_value(nullif(BJRPabrik, 0) IGNORE NULLS) OVER (
                        PARTITION BY KodeKebun, KodeBlok
                        ORDER BY Tahun, Bulan, KodeDivisi ASC NULLS LAST
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS fill
  FROM {name}_0),
{name} AS (
  SELECT Tahun, Bulan, KodeKebun, KodeDivisi, KodeBlok, TahunTanam, JenisKegiatan, LuasTanam,
         BJRSensus, coalesce(fill, {DEFAULT_BJR}) AS BJRPabrik
  FROM {name}_1
  WHERE coalesce(KodeDivisi NOT IN ({excl}), true) AND coalesce(length(KodeBlok) = {code_len}, true))"""


CLEAN_SELECT = f"""
SELECT Tahun, Bulan, KodeKebun, KodeDivisi, KodeBlok, TahunTanam, JenisKegiatan,
       {R("LuasTanam")} AS LuasTanam, {R("BJRSensus")} AS BJRSensus, {R("BJRPabrik")} AS BJRPabrik"""


def _sql_block_top1(where: str = "") -> str:
    body = _top1_cte(where) + f"""
SELECT Tahun, Bulan, KodeKebun, KodeDivisi, KodeBlok, TahunTanam, JenisKegiatan,
       {R("LuasTanam")} AS LuasTanam, {R("BJRPabrik")} AS BJRPabrik, {R("BJRSensus")} AS BJRSensus
FROM top1"""
    return with_standins(BLOCK, body)


def _fill_sql() -> str:
    return f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate,
       {R("l_discount")} AS l_discount,
       {R(f'''coalesce(last_value(nullif(l_discount, 0) IGNORE NULLS) OVER (
             PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), {DEFAULT_BJR})''')} AS filled
FROM lineitem"""


WB = ["bjr", "weighbridge"]


def _kg_ctes(bjr_where: str = "", wb_where: str = "", suffix: str = "") -> str:
    s = suffix
    return _clean_ctes(f"(SELECT * FROM bjr {bjr_where})", f"bc{s}", WB_EXCLUDE, 4) + f""",
kg{s} AS (
  SELECT w.FullDate, w.KodeKebun, w.ShortNameKebun, w.KodeDivisi, w.KodeBlok, b.TahunTanam,
         w.TotalPokok, b.LuasTanam, w.netto, w.Janjang, b.BJRPabrik AS BJR,
         w.Janjang * b.BJRPabrik AS KG_ACT
  FROM (SELECT * FROM weighbridge {wb_where}) w
  JOIN bc{s} b ON b.Tahun = year(w.FullDate) AND b.Bulan = month(w.FullDate)
              AND b.KodeKebun = w.KodeKebun AND b.KodeDivisi = w.KodeDivisi
              AND b.KodeBlok = w.KodeBlok),
nt{s} AS (SELECT FullDate, KodeKebun, KodeDivisi, netto FROM kg{s} WHERE netto != 0),
kt{s} AS (
  SELECT n.FullDate, n.KodeKebun, n.KodeDivisi, n.netto,
         coalesce(sum(k.KG_ACT), 0.0) AS KG_Total
  FROM nt{s} n JOIN kg{s} k ON k.FullDate = n.FullDate AND k.KodeKebun = n.KodeKebun
                          AND k.KodeDivisi = n.KodeDivisi
  GROUP BY n.FullDate, n.KodeKebun, n.KodeDivisi, n.netto),
pr{s} AS (
  SELECT k.FullDate, k.KodeKebun, k.ShortNameKebun, k.KodeDivisi, k.KodeBlok, k.TahunTanam,
         k.TotalPokok, k.LuasTanam, t.netto, coalesce(k.Janjang, 0) AS Janjang, k.BJR,
         coalesce(t.KG_Total, 0.0) AS KG_Total, k.KG_ACT,
         {GD("k.KG_ACT * t.netto", "coalesce(t.KG_Total, 0.0)")} AS KG_PKS
  FROM kg{s} k JOIN kt{s} t ON t.FullDate = k.FullDate AND t.KodeKebun = k.KodeKebun
                         AND t.KodeDivisi = k.KodeDivisi),
pp{s} AS (SELECT *, {GD("KG_PKS", "Janjang")} AS BJR_PKS FROM pr{s})"""


PRORATE_SELECT = f"""
SELECT CAST(FullDate AS VARCHAR) AS FullDate, KodeKebun, ShortNameKebun, KodeDivisi,
       KodeBlok, TahunTanam, TotalPokok,
       {R("LuasTanam")} AS LuasTanam, {R("netto")} AS netto, Janjang, {R("BJR")} AS BJR,
       {R("KG_Total")} AS KG_Total, {R("KG_ACT")} AS KG_ACT, {R("KG_PKS")} AS KG_PKS,
       {R("BJR_PKS")} AS BJR_PKS"""


def _orders_sql(body: str) -> str:
    return with_standins(["order_history"], body)


ORDER_COLS = "Tahun, Bulan, KodeKebun, TipeKebun, o_orderkey"

ORACLE = {
    "monthly_rainfall": with_standins(RAIN, "," + MONTHLY_CTE.strip() + f"""
SELECT Tahun, Bulan, KodeKebun, TipeKebun, RainyDays, {R("avg_rain")} AS RainFallValueAVG,
       et AS WaterEvapotranspiration FROM mt"""),
    "full_join_stations": with_standins(RAIN[:2], f"""
SELECT a.Tahun, a.Bulan, a.Estate, a.Lokasi, CAST(a.Date AS VARCHAR) AS Date,
       {R("a.RainFallValue")} AS RainFallValue,
       b.StationEstate, b.StationLokasi
FROM readings a FULL JOIN stations b ON b.StationEstate = a.Estate AND b.StationLokasi = a.Lokasi"""),
    "initial_balance_reference": _sql_initial("reference"),
    "initial_balance_intended": _sql_initial("intended"),
    "initial_balance_chunked": _sql_initial("reference"),
    "update_balance": _sql_update(AS_OF_UPDATE, f"Tahun * 12 + Bulan < {_idx(AS_OF_UPDATE)}"),
    "update_balance_intended": _sql_update(AS_OF_UPDATE,
                                           f"Tahun * 12 + Bulan < {_idx(AS_OF_UPDATE)}",
                                           "intended"),
    "update_balance_january": _sql_update(AS_OF_JANUARY,
                                          f"Tahun * 12 + Bulan < {_idx(AS_OF_JANUARY)}"),
    "update_balance_fallback": _sql_update(AS_OF_FALLBACK, f"Tahun < {AS_OF_FALLBACK.year}"),
    "period_union": _orders_sql(f"""
SELECT Tahun, Bulan, KodeKebun, TipeKebun FROM order_history
WHERE Tahun = {AS_OF_UNION.year} AND Bulan = {AS_OF_UNION.month - 1}
UNION
SELECT Tahun, Bulan, KodeKebun, TipeKebun FROM order_history
WHERE Tahun = {AS_OF_UNION.year - 1} AND Bulan = 12"""),
    "block_bjr_top1": _sql_block_top1(),
    "block_bjr_month": _sql_block_top1(
        f"WHERE a.Year = {AS_OF_BJR.year} AND a.Month = {AS_OF_BJR.month}"),
    "ffill_zero_missing": _fill_sql(),
    "ffill_zero_missing_chunked": _fill_sql(),
    "clean_bjr": with_standins(BLOCK, (_top1_cte() + _clean_ctes("top1", "cb", BLOCK_EXCLUDE,
                                                                  BLOCK_CODE_LEN))
                               + CLEAN_SELECT + " FROM cb"),
    "load_bjr": with_standins(BLOCK + ["bjr"], (_top1_cte(
        f"WHERE a.Year = {AS_OF_BJR.year} AND a.Month = {AS_OF_BJR.month}")
        + _clean_ctes("top1", "cb", BLOCK_EXCLUDE, BLOCK_CODE_LEN)) + f""",
tbl AS (
  SELECT Tahun, Bulan, KodeKebun, KodeDivisi, KodeBlok, TahunTanam, JenisKegiatan, LuasTanam,
         BJRSensus, BJRPabrik
  FROM bjr WHERE NOT coalesce(Tahun = {AS_OF_BJR.year} AND Bulan = {AS_OF_BJR.month}, false)
  UNION ALL
  SELECT * FROM cb)""" + CLEAN_SELECT + " FROM tbl"),
    "kg_actual": with_standins(WB, _kg_ctes() + f"""
SELECT CAST(FullDate AS VARCHAR) AS FullDate, KodeKebun, ShortNameKebun, KodeDivisi,
       KodeBlok, TahunTanam, TotalPokok,
       {R("LuasTanam")} AS LuasTanam, {R("netto")} AS netto,
       CAST(Janjang AS DOUBLE) AS Janjang, {R("BJR")} AS BJR,
       {R("KG_ACT")} AS KG_ACT FROM kg"""),
    "netto_totals": with_standins(WB, _kg_ctes() + f"""
SELECT CAST(FullDate AS VARCHAR) AS FullDate, KodeKebun, KodeDivisi, {R("netto")} AS netto,
       {R("KG_Total")} AS KG_Total
FROM kt"""),
    "prorate_netto": with_standins(WB, _kg_ctes() + PRORATE_SELECT + " FROM pp"),
    "load_wb_actual": with_standins(WB, _kg_ctes() + _kg_ctes(
        f"WHERE Tahun = {AS_OF_WB.year}", f"WHERE year(FullDate) = {AS_OF_WB.year}", "y") + f""",
tbl AS (
  SELECT * FROM pp WHERE NOT coalesce(year(FullDate) = {AS_OF_WB.year}, false)
  UNION ALL
  SELECT * FROM ppy)""" + PRORATE_SELECT + " FROM tbl"),
    "append_store": with_standins(RAIN[:1], f"""
SELECT Tahun, Bulan, Estate, Lokasi, CAST(Date AS VARCHAR) AS Date,
       {R("RainFallValue")} AS RainFallValue FROM readings"""),
    "job_p1_store": _sql_initial("reference"),
    "folded_slots": with_standins(RAIN[:1], f"""
SELECT Tahun, Bulan, count(*) AS n_rows,
       CASE WHEN Tahun * 12 + Bulan < {12 * FOLD_BEFORE[0] + FOLD_BEFORE[1]} THEN 1
            ELSE count(DISTINCT day(Date) % 3) END AS n_slots
FROM readings GROUP BY Tahun, Bulan"""),
    "late_update_store": _sql_late(),
    "guarded_division": f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       {R(GD("l_quantity * l_discount", "l_tax"))} AS ratio,
       {R(GD("l_discount - 0.05", "l_tax"))} AS ratio_signed
FROM lineitem""",
    "replace_month": _orders_sql(f"""
SELECT {ORDER_COLS}, {R("o_totalprice")} AS o_totalprice FROM order_history
WHERE NOT coalesce(Tahun = 1999 AND Bulan = 3, false)
UNION ALL
SELECT {ORDER_COLS}, {R("o_totalprice * 2")} AS o_totalprice FROM order_history
WHERE Tahun = 1999 AND Bulan = 3 AND TipeKebun <> 'F'"""),
    "replace_year": _orders_sql(f"""
SELECT {ORDER_COLS}, {R("o_totalprice")} AS o_totalprice FROM order_history
WHERE NOT coalesce(Tahun = 1999, false)
UNION ALL
SELECT {ORDER_COLS}, {R("o_totalprice + 1")} AS o_totalprice FROM order_history
WHERE Tahun = 1999 AND TipeKebun = 'O'"""),
    "replace_keys": _orders_sql(f""",
new AS (
  SELECT Tahun, Bulan, KodeKebun, TipeKebun, o_orderkey, o_totalprice * 3 AS o_totalprice
  FROM order_history
  WHERE Tahun = 1999 AND Bulan = 3 AND KodeKebun IN ('1-URGENT', '2-HIGH') AND TipeKebun = 'O')
SELECT {ORDER_COLS}, {R("o_totalprice")} AS o_totalprice FROM order_history h
WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.Tahun = h.Tahun AND n.Bulan = h.Bulan
                                        AND n.KodeKebun = h.KodeKebun)
UNION ALL
SELECT {ORDER_COLS}, {R("o_totalprice")} AS o_totalprice FROM new"""),
    "replace_all": _orders_sql(f"""
SELECT Tahun, Bulan, KodeKebun, TipeKebun, max(o_orderkey) AS o_orderkey,
       {R("sum(o_totalprice)")} AS o_totalprice
FROM order_history GROUP BY Tahun, Bulan, KodeKebun, TipeKebun"""),
    "append_rows": _orders_sql(f"""
SELECT {ORDER_COLS}, {R("o_totalprice")} AS o_totalprice FROM order_history
UNION ALL
SELECT Tahun, Bulan, KodeKebun, TipeKebun, max(o_orderkey) AS o_orderkey,
       {R("sum(o_totalprice)")} AS o_totalprice
FROM order_history GROUP BY Tahun, Bulan, KodeKebun, TipeKebun"""),
    "csv_roundtrip": _orders_sql(f"""
SELECT {ORDER_COLS}, {R("o_totalprice")} AS o_totalprice FROM order_history"""),
}
_P2 = _sql_update(AS_OF_UPDATE, f"Tahun * 12 + Bulan < {_idx(AS_OF_UPDATE)}")
ORACLE |= {
    "monthly_rainfall_merged": ORACLE["monthly_rainfall"],
    "workbook_roundtrip": ORACLE["csv_roundtrip"],
    "ordered_by_estate": with_standins(RAIN, ", " + MONTHLY_CTE.strip() + """
SELECT row_number() OVER (ORDER BY KodeKebun, Tahun, Bulan) AS position, KodeKebun, Tahun, Bulan, RainyDays
FROM mt"""),
    "job_p2_store": f"""
SELECT * FROM ({_P2}) WHERE Tahun = {AS_OF_UPDATE.year} AND Bulan = {AS_OF_UPDATE.month}
UNION ALL
SELECT {AS_OF_UPDATE.year}, {AS_OF_UPDATE.month}, 'OTHER', 'OTHER', 1, 2.0, 3.0, 120, 4.0, 5.0, 6.0""",
    "job_p3_store": ORACLE["load_bjr"],
    "job_p4_store": ORACLE["load_wb_actual"],
    "job_p4_bucketed": ORACLE["load_wb_actual"],
    "prorate_bucketed": ORACLE["prorate_netto"],
}
