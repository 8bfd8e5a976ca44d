"""Checks that ride on the writing pass: the job refuses before it publishes."""

import datetime as dt

import pytest

from palmyra.plans import jobs
from palmyra.sources.tables import SCHEMAS
from palmyra.sources.workbook import load_workbook
from palmyra.sources.writers import live_slots, scratch_path

READING = "Tahun int, Bulan int, Estate string, Lokasi string, Date date, RainFallValue double"


def test_doubled_unit_is_refused_without_a_job_of_its_own(spark):
    w = jobs.Warehouse(scratch_path(spark, "doubled"))
    rows = [(1998, m, e, "1", dt.date(1998, m, 3), 9.0) for m in (1, 2) for e in "AB"]
    jobs.append_readings(spark.createDataFrame(rows, READING), w, "load", 0)
    jobs.write_table(spark.createDataFrame([("A", "1")], "StationEstate string, StationLokasi string"), w, "stations")
    units = spark.createDataFrame([("A", "T"), ("B", "T")], "Unit string, UnitType string")
    jobs.write_table(units, w, "unit_types")
    jobs.run_initial_balance(spark, w)
    before = live_slots(spark, w.path("rainfall_balance"))
    jobs.write_table(units.unionByName(units.where("Unit = 'B'")), w, "unit_types")
    for run in (lambda: jobs.run_initial_balance(spark, w),
                lambda: jobs.run_monthly_balance(spark, w, dt.date(1998, 2, 1)),
                lambda: jobs.run_balance_from(spark, w, 1998, 1)):
        with pytest.raises(ValueError, match="more than once .e.g. B."):
            run()
        assert live_slots(spark, w.path("rainfall_balance")) == before


def _block_tables(spark, planted):
    fact = [(2024, 5, 1, 1, i, d, 2.0, "X", 9.0, 8.0) for i, d in enumerate(planted)]
    return {"block_fact": spark.createDataFrame(fact, SCHEMAS["block_fact"]),
            "unit": spark.createDataFrame([(1, "E")], SCHEMAS["unit"]),
            "division": spark.createDataFrame([(1, "D")], SCHEMAS["division"]),
            "block": spark.createDataFrame([(i, f"B00{i}") for i in range(len(planted))], SCHEMAS["block"])}


def test_null_planting_years_are_counted_or_refused(spark):
    w = jobs.Warehouse(scratch_path(spark, "planting"))
    for name, df in _block_tables(spark, [dt.date(2010, 1, 1), None, dt.date(2011, 1, 1)]).items():
        jobs.write_table(df, w, name)
    as_of = dt.date(2024, 5, 9)
    with pytest.raises(ValueError, match="1 of 3 rows"):
        jobs.run_bjr(spark, w, as_of, refuse_null_years=True)
    assert w.read(spark, "bjr").count() == 0
    book = scratch_path(spark, "planting-book")
    assert jobs.run_bjr(spark, w, as_of, workbook_path=book) == {"n": 1, "n_rows": 3}
    assert load_workbook(spark, book, SCHEMAS["bjr"]).count() == 3
    assert jobs.run_bjr(spark, w, dt.date(2024, 6, 9), refuse_null_years=True)["n_rows"] == 0


def test_a_month_without_rows_is_written_and_its_checks_hold(spark):
    w = jobs.Warehouse(scratch_path(spark, "no-rows"))
    jobs.append_readings(spark.createDataFrame([(1998, 1, "A", "1", dt.date(1998, 1, 3), 9.0)], READING), w, "load", 0)
    jobs.write_table(spark.createDataFrame([("A", "1")], "StationEstate string, StationLokasi string"), w, "stations")
    jobs.write_table(spark.createDataFrame([("A", "T")], "Unit string, UnitType string"), w, "unit_types")
    jobs.run_initial_balance(spark, w)
    for mode in ("reference", "intended"):
        jobs.run_monthly_balance(spark, w, dt.date(1998, 5, 1), mode=mode)
    assert [r.Bulan for r in w.read(spark, "rainfall_balance").collect()] == [1]
