"""Batches of readings: retries, merged state, folding, late data in one job."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from palmyra.checks.standins import standin
from palmyra.plans import jobs, rainfall
from palmyra.sources.writers import _put_snapshot, live_slots, publish, scratch_path, slot_values, table_state

READING = "Tahun int, Bulan int, Estate string, Lokasi string, Date date, RainFallValue double"


def _key(r):
    return tuple((v is None, str(v)) for v in r)


def _rows(df):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()), key=_key)


def _month(spark, *days):
    return spark.createDataFrame([(y, m, "E", "1", dt.date(y, m, d), 4.0) for y, m, d in days], READING)


def test_retry_with_fewer_periods_leaves_nothing_behind(spark):
    w = jobs.Warehouse(scratch_path(spark, "fewer"))
    jobs.append_readings(_month(spark, (1998, 6, 1), (1998, 7, 1)), w, "load", 0)
    jobs.append_readings(_month(spark, (1998, 7, 9)), w, "load-0", 1)       # another source
    jobs.append_readings(_month(spark, (1998, 6, 2)), w, "load", 0)
    assert [str(r.Date) for r in w.read(spark, "readings").orderBy("Date").collect()] == [
        "1998-06-02", "1998-07-09"]
    assert w.read(spark, "rainfall_state").count() == 2
    jobs.append_readings(_month(spark, (1998, 6, 2)).limit(0), w, "load", 0)
    assert w.read(spark, "readings").count() == 1


def test_any_split_into_batches_gives_the_same_months(spark, sf0001):
    readings, rng = standin(spark, sf0001, "readings").cache(), random.Random(4)
    stations, units = standin(spark, sf0001, "stations"), standin(spark, sf0001, "unit_types")
    want = _rows(rainfall.monthly_rainfall(readings, stations, units))
    for n in (1, 3):
        w = jobs.Warehouse(scratch_path(spark, f"split-{n}"))
        part = F.pmod(F.xxhash64(*readings.columns, F.lit(rng.random())), F.lit(n))
        for i in rng.sample(range(n), n):
            jobs.append_readings(readings.where(part == i), w, f"s{i}", 0)
        got = rainfall.monthly_from_state(w.read(spark, "rainfall_state"), stations, units)
        assert _rows(got) == want
    state = rainfall.reading_state(readings.where(part == 0)).unionByName(rainfall.reading_state(readings.where(part != 0)))
    assert _rows(rainfall.monthly_from_state(state, stations, units)) == want


def test_only_the_state_is_scanned(spark):
    w = jobs.Warehouse(scratch_path(spark, "scanned"))
    jobs.append_readings(_month(spark, (1998, 6, 1)), w, "load", 0)
    files = rainfall.merge_state(w.read(spark, "rainfall_state", Tahun=1998, Bulan=6)).inputFiles()
    assert files and all("/rainfall_state/" in f for f in files)


def test_folding(spark):
    w = jobs.Warehouse(scratch_path(spark, "fold"))
    for i in range(4):
        jobs.append_readings(_month(spark, (1998, 5, i + 1), (1998, 6, i + 1), (1998, 7, i + 1)), w, "load", i)
    jobs.append_readings(_month(spark, (1998, 7, 20)), w, "load", 4)
    before = _rows(w.read(spark, "readings"))
    months = lambda t: sorted((v["Bulan"], v["batch"]) for v in map(
        slot_values, live_slots(spark, w.path(t))[1]))
    assert jobs.fold_batches(spark, w, (1998, 7)) == 12
    for t in ("readings", "rainfall_state"):
        assert months(t) == [("5", "folded"), ("6", "folded"), *(("7", f"load-{i}") for i in range(5))]
    assert _rows(w.read(spark, "readings")) == before
    assert w.read(spark, "rainfall_state").where("Bulan = 5").first().Readings == 4
    assert jobs.fold_batches(spark, w, (1998, 7)) == 0
    # The newest batch may be tried again, a folded one may not.
    jobs.append_readings(_month(spark, (1998, 7, 21)), w, "load", 4)
    assert w.read(spark, "readings").count() == len(before)
    with pytest.raises(ValueError, match="final"):
        jobs.append_readings(_month(spark, (1998, 5, 1)), w, "load", 3)
    # A late batch of a folded month is folded with it later.
    jobs.append_readings(_month(spark, (1998, 5, 30)), w, "load", 5)
    jobs.append_readings(_month(spark, (1998, 8, 1)), w, "load", 6)
    assert jobs.fold_batches(spark, w, (1998, 7)) == 2
    assert [b for m, b in months("readings") if m == "5"] == ["folded"]
    assert w.read(spark, "readings").count() == len(before) + 2


def test_state_needs_no_spark_job_and_no_replay(spark):
    base = scratch_path(spark, "snapshots")
    t = spark.createDataFrame([(1, "a b/é")], "x int, batch string")
    for _ in range(7):
        publish(t, base, ["batch"], replaces=[])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("state", "state")
    try:
        seq, slots = live_slots(spark, base)
        assert list(tracker.getJobIdsForGroup("state")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert seq == 7 and [slot_values(s) for s in slots] == [{"batch": "a b/é"}]
    from palmyra.sources.writers import _snapshots
    assert len(_snapshots(spark, base)) <= 6       # what is listed does not grow with commits


def test_a_second_writer_is_refused(spark):
    base = scratch_path(spark, "two-writers")
    t = spark.createDataFrame([(1, "a")], "x int, batch string")
    publish(t, base, ["batch"])
    with pytest.raises(RuntimeError, match="another writer"):
        _put_snapshot(spark, base, table_state(spark, base))
    with pytest.raises(ValueError):        # a check that fails leaves the table as it was
        publish(t, base, ["batch"], replaces=[], check=lambda: (_ for _ in ()).throw(ValueError("no")))
    assert live_slots(spark, base)[0] == 1


def _random_history(rng, spark):
    """Months with gaps, estates that come and go, and stored rows without readings."""
    periods = sorted(rng.sample(range(1997 * 12 + 6, 1999 * 12 + 8), 16))
    estates = ["A", "B", "C", "D"]
    readings = [(p // 12, p % 12 + 1, e, "1", dt.date(p // 12, p % 12 + 1, rng.randint(1, 28)),
                 float(rng.randint(20, 400))) for p in periods for e in estates if rng.random() < 0.7]
    extra = [(p // 12, p % 12 + 1, "OLD", "T", 1, 5.0, 10.0, 120, 20.0, float(rng.randint(0, 200)), 0.0)
             for p in rng.sample(periods, 3)]
    return readings, extra, periods


@pytest.mark.parametrize("seed,mode", [(1, "reference"), (4, "intended")])
def test_one_job_equals_the_monthly_job_month_by_month(spark, seed, mode):
    rng = random.Random(seed)
    readings, extra, periods = _random_history(rng, spark)
    stations = spark.createDataFrame([(e, "1") for e in "ABCD"], "StationEstate string, StationLokasi string")
    units = spark.createDataFrame([(e, "T") for e in "ABCD"], "Unit string, UnitType string")
    late = rng.sample(range(len(readings)), len(readings) // 4)
    some = [r for i, r in enumerate(readings) if i not in late]
    first = min(readings[i][0] * 12 + readings[i][1] - 1 for i in late)
    whs = []
    for name in ("one", "loop"):
        w = jobs.Warehouse(scratch_path(spark, f"late-{name}"))
        jobs.append_readings(spark.createDataFrame(some, READING), w, "load", 0)
        jobs.write_table(stations, w, "stations")
        jobs.write_table(units, w, "unit_types")
        jobs.run_initial_balance(spark, w, epoch=(periods[0] // 12, periods[0] % 12 + 1), mode=mode)
        b = w.read(spark, "rainfall_balance")
        jobs.write_table(b.unionByName(spark.createDataFrame(extra, b.schema)), w, "rainfall_balance")
        jobs.append_readings(spark.createDataFrame([readings[i] for i in late], READING), w, "late", 0)
        whs.append(w)
    one, loop = whs
    jobs.run_balance_from(spark, one, first // 12, first % 12 + 1, mode=mode)
    for p in range(first, periods[-1] + 1):
        jobs.run_monthly_balance(spark, loop, dt.date(p // 12, p % 12 + 1, 1), mode=mode)
    got = _rows(one.read(spark, "rainfall_balance"))
    assert got == _rows(loop.read(spark, "rainfall_balance")) and any("OLD" in r for r in got)


def test_a_reading_of_a_far_year_costs_no_more(spark):
    w = jobs.Warehouse(scratch_path(spark, "far"))
    jobs.append_readings(_month(spark, (1998, 5, 1), (9999, 12, 1)), w, "load", 0)
    jobs.write_table(spark.createDataFrame([("E", "1")], "StationEstate string, StationLokasi string"), w, "stations")
    jobs.write_table(spark.createDataFrame([("E", "T")], "Unit string, UnitType string"), w, "unit_types")
    jobs.run_initial_balance(spark, w)
    jobs.run_balance_from(spark, w, 1998, 5)
    assert w.read(spark, "rainfall_balance").count() == 2
