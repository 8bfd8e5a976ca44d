"""Arriving reading files update the readings table and the months after them."""

import datetime as dt

import pytest

from palmyra.checks.standins import standin
from palmyra.plans import jobs
from palmyra.sources.writers import scratch_path
from palmyra.streaming import start_monthly_updates

READING = "Tahun int, Bulan int, Estate string, Lokasi string, Date date, RainFallValue double"


def _key(r):
    return tuple((v is None, str(v)) for v in r)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=_key)


def _warehouse(spark, sf0001, readings, name):
    wh = jobs.Warehouse(scratch_path(spark, name))
    jobs.append_readings(readings, wh, "load", 0)
    for t in ("stations", "unit_types"):
        jobs.write_table(standin(spark, sf0001, t), wh, t)
    jobs.run_initial_balance(spark, wh, epoch=(1995, 1), mode="intended")
    return wh


def _run(spark, wh, landing, checkpoint):
    q = start_monthly_updates(spark, wh, landing, checkpoint=checkpoint, mode="intended",
                              available_now=True)
    q.awaitTermination(300)
    assert q.exception() is None


def test_late_reading_recomputes_the_months_after_it(spark, sf0001):
    some = standin(spark, sf0001, "readings").where("Tahun = 1998 AND Estate IN ('1', '2', '3', '4')")
    wh = _warehouse(spark, sf0001, some, "stream-wh")
    other = _warehouse(spark, sf0001, some, "plain-wh")
    late = spark.createDataFrame([(1998, 2, "1", "1", dt.date(1998, 2, 3), 90.0)], READING)
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    late.write.parquet(landing)
    _run(spark, wh, landing, checkpoint)

    jobs.append_readings(late, other, "late", 0)
    newest = other.read(spark, "rainfall_balance").selectExpr("max(Tahun * 12 + Bulan - 1)").first()[0]
    for p in range(1998 * 12 + 1, newest + 1):
        jobs.run_monthly_balance(spark, other, dt.date(p // 12, p % 12 + 1, 1), mode="intended")
    got = _rows(wh.read(spark, "rainfall_balance"))
    assert got == _rows(other.read(spark, "rainfall_balance")) and got

    # A restart goes on where the stream was; a second file is one more batch.
    _run(spark, wh, landing, checkpoint)
    assert wh.read(spark, "readings").count() == some.count() + 1
    late.write.mode("append").parquet(landing)
    _run(spark, wh, landing, checkpoint)
    assert wh.read(spark, "readings").count() == some.count() + 2


def test_late_december_carries_into_the_new_year(spark):
    wh = jobs.Warehouse(scratch_path(spark, "december"))
    months = [(1997, 12), (1998, 1), (1998, 2)]
    rows = [(y, m, "E", "1", dt.date(y, m, 5), 150.0) for y, m in months]
    jobs.append_readings(spark.createDataFrame(rows, READING), wh, "load", 0)
    jobs.write_table(spark.createDataFrame([("E", "1")], "StationEstate string, StationLokasi string"),
                     wh, "stations")
    jobs.write_table(spark.createDataFrame([("E", "T")], "Unit string, UnitType string"), wh, "unit_types")
    jobs.run_initial_balance(spark, wh, mode="intended")
    balances = lambda: [r.WaterReserveAfterEvapor for r in
                        wh.read(spark, "rainfall_balance").orderBy("Tahun", "Bulan").collect()]
    assert balances() == [0.0, 0.0, 0.0]        # 150 in, 150 out each month
    landing = scratch_path(spark, "landing")
    spark.createDataFrame([(1997, 12, "E", "1", dt.date(1997, 12, 9), 85.0)], READING).write.parquet(landing)
    _run(spark, wh, landing, scratch_path(spark, "checkpoint"))
    assert balances() == [85.0, 85.0, 85.0]


def test_a_stream_needs_a_checkpoint(spark):
    wh = jobs.Warehouse(scratch_path(spark, "no-checkpoint"))
    with pytest.raises(TypeError):
        start_monthly_updates(spark, wh, "/nowhere")
    with pytest.raises(ValueError):
        start_monthly_updates(spark, wh, "/nowhere", checkpoint="")
