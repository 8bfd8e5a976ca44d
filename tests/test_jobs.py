"""The four jobs end to end on warehouse tables written from the stand-ins."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from palmyra.checks.standins import standin
from palmyra.plans import bjr as bjr_plan
from palmyra.plans import jobs, rainfall, weighbridge
from palmyra.sources.writers import SHUFFLE_CLEANUP, scratch_path

L1 = ("readings", "stations", "unit_types", "block_fact", "unit", "division", "block",
      "weighbridge")


def _key(r):
    return tuple((v is None, str(v)) for v in r)


def _same(a, b):
    return sorted(a.collect(), key=_key) == sorted(b.select(*a.columns).collect(), key=_key)


@pytest.fixture(scope="module")
def wh(spark, sf0001):
    w = jobs.Warehouse(scratch_path(spark, "warehouse"))
    for t in L1:
        df = standin(spark, sf0001, t)
        if t == "readings":
            jobs.append_readings(df, w, "load", 0)
        else:
            jobs.write_table(df, w, t)
    return w


def test_p1_then_p2(spark, wh):
    jobs.run_initial_balance(spark, wh, epoch=(1995, 1))
    p1 = wh.read(spark, "rainfall_balance")
    expect = rainfall.initial_balance(wh.read(spark, "readings"), wh.read(spark, "stations"),
                                      wh.read(spark, "unit_types"), epoch=(1995, 1))
    assert p1.count() == expect.count() > 0 and _same(expect, p1)

    as_of = dt.date(1998, 6, 15)
    frame = rainfall.update_balance(wh.read(spark, "readings"), wh.read(spark, "stations"),
                                    wh.read(spark, "unit_types"), p1, as_of)
    frame = [tuple(r) for r in frame.where("Bulan = 6").collect()]
    before = p1.where("NOT (Tahun = 1998 AND Bulan = 6)").collect()
    jobs.run_monthly_balance(spark, wh, as_of)
    after = wh.read(spark, "rainfall_balance")
    assert sorted(map(tuple, after.where("Tahun = 1998 AND Bulan = 6").collect()), key=_key) \
        == sorted(frame, key=_key)
    assert sorted(map(tuple, after.where("NOT (Tahun = 1998 AND Bulan = 6)").collect()),
                  key=_key) == sorted(map(tuple, before), key=_key)
    # Idempotent: running the month again changes nothing.
    once = sorted(map(tuple, after.collect()), key=_key)
    jobs.run_monthly_balance(spark, wh, as_of)
    assert sorted(map(tuple, wh.read(spark, "rainfall_balance").collect()), key=_key) == once


def test_p3_month_and_empty_month(spark, wh):
    as_of = dt.date(1998, 3, 15)
    export = scratch_path(spark, "bjr-export")
    jobs.run_bjr(spark, wh, as_of, export_path=export, exclude=("PROMO",), code_len=7)
    stored = wh.read(spark, "bjr")
    expect = bjr_plan.clean_bjr(
        bjr_plan.block_bjr(wh.read(spark, "block_fact"), wh.read(spark, "unit"),
                           wh.read(spark, "division"), wh.read(spark, "block"), as_of=as_of),
        exclude=("PROMO",), code_len=7)
    assert stored.count() == expect.count() > 0 and _same(expect, stored)
    assert spark.read.option("header", True).csv(export).count() == expect.count()
    # A month without data empties its partition (the slice is still replaced).
    jobs.run_bjr(spark, wh, as_of, exclude=tuple(r.DivisionCode for r in
                                                 wh.read(spark, "division").select(
                                                     "DivisionCode").distinct().collect()))
    assert wh.read(spark, "bjr").where("Tahun = 1998 AND Bulan = 3").count() == 0


def test_p4_year(spark, wh, sf0001):
    jobs.write_table(standin(spark, sf0001, "bjr"), wh, "bjr")
    jobs.run_wb_actual(spark, wh, dt.date(1998, 6, 30), exclude=("P",))
    stored = wh.read(spark, "wb_actual")
    bjr = bjr_plan.clean_bjr(standin(spark, sf0001, "bjr").where("Tahun = 1998"),
                             exclude=("P",))
    wb = standin(spark, sf0001, "weighbridge").where(F.year("FullDate") == 1998)
    expect = weighbridge.prorate_netto(bjr, wb)
    assert stored.count() == expect.count() > 0 and _same(expect, stored)


def test_cli_runs_jobs(spark, wh):
    from palmyra.__main__ import main
    main(["p1", "--warehouse", wh.root, "--epoch", "1995-01"])
    n = wh.read(spark, "rainfall_balance").count()
    main(["p2", "--warehouse", wh.root, "--as-of", "1998-07-31"])
    assert wh.read(spark, "rainfall_balance").count() == n > 0
    main(["p3", "--warehouse", wh.root, "--as-of", "1998-04-02", "--exclude", "PROMO",
          "--code-len", "7", "--show", "3"])
    assert wh.read(spark, "bjr").where("Tahun = 1998 AND Bulan = 4").count() > 0


def test_duplicate_unit_is_an_input_error(spark, sf0001):
    w = jobs.Warehouse(scratch_path(spark, "dup-units"))
    jobs.append_readings(standin(spark, sf0001, "readings"), w, "load", 0)
    standin(spark, sf0001, "stations").write.parquet(w.path("stations"))
    units = standin(spark, sf0001, "unit_types")
    units.unionByName(units.limit(1)).write.parquet(w.path("unit_types"))
    with pytest.raises(ValueError, match="more than once"):
        jobs.run_initial_balance(spark, w, epoch=(1995, 1))


def _rows(df):
    return sorted(map(tuple, df.collect()), key=_key)


def _breaking(df):
    """The frame with one column that raises while its rows are written."""
    c = df.columns[-1]
    bad = F.when(F.col(c).isNull() | (F.rand() >= 0), F.raise_error(F.lit("lost half way")))
    return df.withColumn(c, F.coalesce(bad.cast(df.schema[c].dataType), F.col(c)))


@pytest.mark.parametrize("job", ["p1", "p2", "p3", "p4"])
def test_failed_run_changes_nothing_and_can_be_run_again(spark, sf0001, monkeypatch, job):
    w = jobs.Warehouse(scratch_path(spark, f"failing-{job}"))
    for t in L1:
        df = standin(spark, sf0001, t)
        jobs.append_readings(df, w, "load", 0) if t == "readings" else jobs.write_table(df, w, t)
    as_of = dt.date(1998, 6, 15)
    table, module, plan, run = {
        "p1": ("rainfall_balance", rainfall, "initial_balance",
               lambda: jobs.run_initial_balance(spark, w, epoch=(1995, 1))),
        "p2": ("rainfall_balance", rainfall, "update_balance",
               lambda: jobs.run_monthly_balance(spark, w, as_of)),
        "p3": ("bjr", bjr_plan, "clean_bjr",
               lambda: jobs.run_bjr(spark, w, as_of, exclude=("PROMO",), code_len=7)),
        "p4": ("wb_actual", weighbridge, "prorate_netto",
               lambda: jobs.run_wb_actual(spark, w, as_of, exclude=("P",)))}[job]
    jobs.run_initial_balance(spark, w, epoch=(1995, 1))
    jobs.write_table(standin(spark, sf0001, "bjr"), w, "bjr")
    if job == "p2":     # a row that the new frame does not have stays in the month
        y = w.read(spark, "rainfall_balance", Tahun=1998, Bulan=6)
        jobs.write_table(y.unionByName(y.limit(1).withColumn("KodeKebun", F.lit("OLD"))), w,
                         "rainfall_balance", replaces=["Tahun=1998/Bulan=6"])
    if job == "p4":
        run()
    before = _rows(w.read(spark, table))
    right = getattr(module, plan)
    with monkeypatch.context() as m:
        m.setattr(module, plan, lambda *a, **k: _breaking(right(*a, **k)))
        with pytest.raises(Exception, match="lost half way"):
            run()
    assert _rows(w.read(spark, table)) == before
    run()
    again = _rows(w.read(spark, table))
    run()
    assert _rows(w.read(spark, table)) == again and again
    if job == "p2":
        assert any("OLD" in r for r in again)


def test_old_versions_go_after_publishing(spark, wh):
    import pathlib
    jobs.run_bjr(spark, wh, dt.date(1998, 5, 1), exclude=("PROMO",), code_len=7)
    jobs.run_bjr(spark, wh, dt.date(1998, 5, 1), exclude=("PROMO",), code_len=7)
    from palmyra.sources.writers import live_slots
    base = wh.path("bjr").removeprefix("file:")
    versions = {p.name for p in pathlib.Path(base).glob("d=*")}
    assert versions == {f"d={v}" for v in live_slots(spark, wh.path("bjr"))[1].values()}


def test_two_sources_may_use_one_batch_number(spark):
    w = jobs.Warehouse(scratch_path(spark, "two-sources"))
    row = [(1998, 6, "E", "1", dt.date(1998, 6, 1), 4.0)]
    one = spark.createDataFrame(row, "Tahun int, Bulan int, Estate string, Lokasi string, Date date, "
                                     "RainFallValue double")
    jobs.append_readings(one, w, "load", 0)
    jobs.append_readings(one, w, "stream", 0)
    jobs.append_readings(one, w, "stream", 0)
    assert w.read(spark, "readings").count() == 2
    with pytest.raises(ValueError):
        jobs.append_readings(one, w, "", 0)


def test_facts_are_read_by_period(spark, wh):
    import contextlib
    import io
    for df, filters in ((wh.read(spark, "weighbridge", Year=1998), "(Year#"),
                        (wh.read(spark, "block_fact").where("Year = 1998 AND Month = 3"), "(Month#")):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain("formatted")
        line = next(x for x in out.getvalue().splitlines() if "PartitionFilters" in x)
        assert filters in line, line


def test_multiplied_rows_are_not_shuffled_and_shuffles_go(spark, sf0001):
    """The yearly job writes what its join multiplied without a shuffle of it, and a write
    leaves no shuffle files behind."""
    import os

    from palmyra.checks.queries import AS_OF_WB, _warehouse

    w = _warehouse(spark, sf0001, "weighbridge", "bjr")
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()

    def files():
        return {f for d in dirs for _, _, names in os.walk(d.toString()) for f in names if f.startswith("shuffle_")}

    before, seen = files(), []
    hint = type(spark.range(0)).hint
    type(spark.range(0)).hint = lambda self, name, *a: seen.append(name) or hint(self, name, *a)
    try:
        jobs.run_wb_actual(spark, w, AS_OF_WB, exclude=("P",))
    finally:
        type(spark.range(0)).hint = hint
    assert "rebalance" not in seen
    until = time.time() + 20       # the executors remove them in the background
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before
    assert w.read(spark, "wb_actual").count() > 0
    assert spark.conf.get(SHUFFLE_CLEANUP, None) is None


def test_writes_by_period_keep_a_file_open_for_each(spark, monkeypatch):
    """No sort of a task's rows by period; beyond OPEN_PERIODS periods in a task the rows are
    all written too, null periods are one more, and the submitter's number stays."""
    from pyspark.sql.readwriter import DataFrameWriter

    from palmyra.sources.writers import OPEN_FILES, OPEN_PERIODS, publish

    seen, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet",
                        lambda self, *a, **k: seen.append(spark.conf.get(OPEN_FILES)) or write(self, *a, **k))
    before = spark.conf.get(OPEN_FILES)
    for periods in (OPEN_PERIODS - 2, 3 * OPEN_PERIODS):
        df = spark.range(4000).select("id", F.when(F.col("id") % 7 > 0, F.col("id") % periods).alias("p")).coalesce(1)
        for dealt in (False, True):
            at = scratch_path(spark, "open-periods")
            publish(df, at, ["p"], as_dealt=dealt)
            back = spark.read.option("basePath", at).parquet(f"{at}/d=*").select("id", F.col("p").cast("long"))
            assert _rows(back) == _rows(df)
    assert set(seen) == {str(OPEN_PERIODS)} and spark.conf.get(OPEN_FILES) == before
    try:
        spark.conf.set(OPEN_FILES, "3")
        publish(df, scratch_path(spark, "open-periods"), ["p"])
        assert seen[-1] == "3" and spark.conf.get(OPEN_FILES) == "3"
    finally:
        spark.conf.unset(OPEN_FILES)
