"""Plan checks: pushdown, pruning, top-1 limit, no Python or cartesian nodes."""

import contextlib
import datetime as dt
import io

import pytest

import __spark_entry__ as E
from palmyra.checks.queries import ORACLE, QUERIES
from palmyra.plans import rainfall
from palmyra.plans.bjr import block_bjr
from palmyra.sources.tables import load, SCHEMAS
from palmyra.sources.writers import cut_lineage, scratch_path

BAD_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_or_cartesian_nodes(spark, sf0001, name):
    p = plan(QUERIES[name](spark, sf0001))
    assert not [n for n in BAD_NODES if n in p], p


def test_oracle_for_every_query():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == rainfall.BALANCE_COLUMNS


@pytest.fixture(scope="module")
def warehouse(spark, sf0001):
    """Stand-in tables written as real parquet tables, read back with schema."""
    from palmyra.checks.standins import standin
    base = scratch_path(spark, "warehouse")
    for name in ("readings", "stations", "unit_types", "block_fact", "unit", "division",
                 "block"):
        standin(spark, sf0001, name).write.partitionBy(
            *(["Tahun", "Bulan"] if name == "readings" else [])).parquet(f"{base}/{name}")
    return {n: load(spark, f"{base}/{n}", n) for n in
            ("readings", "stations", "unit_types", "block_fact", "unit", "division", "block")}


def test_monthly_update_prunes_partitions_and_columns(spark, warehouse):
    w = warehouse
    df = rainfall.monthly_rainfall(w["readings"], w["stations"], w["unit_types"],
                                   period=(1998, 6))
    p = plan(df)
    assert "PartitionFilters: [isnotnull(Tahun" in p and "(Tahun#" in p and "= 1998)" in p
    assert "PushedFilters: [IsNotNull(RainFallValue), GreaterThan(RainFallValue,0.0)" in p
    scan = [ln for ln in p.splitlines() if "ReadSchema" in ln and "Lokasi" in ln][0]
    assert "RainFallValue" in scan and "Date" in scan


def test_top1_is_limited_before_shuffle(spark, warehouse):
    w = warehouse
    df = block_bjr(w["block_fact"], w["unit"], w["division"], w["block"], as_of=dt.date(1998, 3, 1))
    p = plan(df)
    # Partial top-1 before the shuffle, final after it.
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p
    assert "PushedFilters: [IsNotNull(Year), IsNotNull(Month), EqualTo(Year,1998), EqualTo(Month,3)" in p


def test_schema_check(spark):
    bad = spark.createDataFrame([(1,)], "Tahun int")
    with pytest.raises(ValueError):
        from palmyra.sources.tables import conform
        conform(bad, "readings")
    assert [f.name for f in SCHEMAS["stations"]] == ["StationEstate", "StationLokasi"]


def test_library_collects_nothing_whole():
    """Driver round trips in the library: only scalars and the commit log (a row
    per commit and period)."""
    import pathlib
    import re
    root = pathlib.Path(__file__).resolve().parent.parent / "palmyra"
    hits = {}
    for f in root.rglob("*.py"):
        if "checks" in f.parts or "llm" in f.parts:
            continue
        for pat in (r"\.collect\(\)", r"\.toPandas\(\)", r"\.rdd\b", r"localCheckpoint"):
            n = len(re.findall(pat, f.read_text()))
            if n:
                hits[(f.name, pat)] = n
    assert hits == {}


def test_scale_shapes(spark, sf0001):
    from palmyra.checks.standins import standin
    from palmyra.plans import weighbridge
    from palmyra.plans.bjr import clean_bjr
    r, s, u = (standin(spark, sf0001, t) for t in ("readings", "stations", "unit_types"))
    # Distinct days and locations without expanding the raw rows.
    assert "Expand" not in plan(rainfall.monthly_rainfall(r, s, u))
    # The full join never shuffles the readings for a full outer join.
    p = plan(rainfall.readings_with_stations(r, s))
    assert "FullOuter" not in p and "BroadcastHashJoin" in p
    # Weighbridge rows meet the (small) cleaned BJR table through a broadcast.
    stored = cut_lineage(standin(spark, sf0001, "bjr"))
    bjr = clean_bjr(stored, exclude=("P",))
    wb = cut_lineage(standin(spark, sf0001, "weighbridge"))
    p = plan(weighbridge.kg_actual(bjr, wb))
    assert "SortMergeJoin" not in p and "Left keys [5]" in p, p


def scans(df, table):
    """Scans of a table in the plan that ran, without those that are reused."""
    df.collect()
    ran = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return sum("FileScan" in line and f"/{table}" in line for line in ran.splitlines())


def test_totals_read_the_weighbridge_once(spark, sf0001):
    from palmyra.checks.standins import standin
    from palmyra.operators.proration import netto_totals
    from palmyra.plans import weighbridge
    from palmyra.plans.bjr import clean_bjr
    bjr = clean_bjr(cut_lineage(standin(spark, sf0001, "bjr"), "bjr"), exclude=("P",))
    path = scratch_path(spark, "weighed")
    standin(spark, sf0001, "weighbridge").write.parquet(path)
    wb = spark.read.parquet(path)
    totals = netto_totals(weighbridge.kg_actual(bjr, wb), weighbridge.GROUP)
    name = path.rsplit("/", 1)[1][:30]
    assert scans(totals, f"palmyra/{name}") == 1
    assert scans(weighbridge.prorate_netto(bjr, wb), f"palmyra/{name}") == 2


def test_chunked_balance_reads_the_readings_once(spark, sf0001):
    from palmyra.checks.standins import standin
    r, s, u = (standin(spark, sf0001, t) for t in ("readings", "stations", "unit_types"))
    path = scratch_path(spark, "raw-readings")
    r.write.parquet(path)
    name = path.rsplit("/", 1)[1][:30]
    df = rainfall.initial_balance(spark.read.parquet(path), s, u, epoch=(1995, 1), chunk_by_year=True)
    assert scans(df, f"palmyra/{name}") == 1


def test_plan_functions_start_no_job(spark, sf0001):
    from palmyra.checks.standins import standin
    from palmyra.plans import weighbridge
    from palmyra.plans.bjr import clean_bjr
    t = {n: standin(spark, sf0001, n) for n in ("readings", "stations", "unit_types", "block_fact",
                                                "unit", "division", "block", "bjr", "weighbridge")}
    spark.sparkContext.setJobGroup("planning", "plan functions")
    rainfall.initial_balance(t["readings"], t["stations"], t["unit_types"])
    rainfall.readings_with_stations(t["readings"], t["stations"])
    block_bjr(t["block_fact"], t["unit"], t["division"], t["block"])
    weighbridge.prorate_netto(clean_bjr(t["bjr"]), t["weighbridge"])
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_fill_keeps_rows_without_a_key_out_of_the_window(spark):
    from pyspark.sql import functions as F
    from palmyra.operators.fill import forward_fill
    df = spark.range(20_000).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 70).alias("k"), F.col("id").alias("t"),
        (F.col("id") % 3).cast("double").alias("v"), (F.col("id") % 4).alias("c"))
    df = cut_lineage(df, "keyless")
    for chunk in (None, "c"):
        out = forward_fill(df, "v", ["k"], ["t"], "f", chunk=chunk)
        assert out.count() == 20_000 and out.where("k is null and f is not null").count() == 0
        p = plan(out)
        assert "PushedFilters: [IsNotNull(k)]" in p and "Union" in p, p


def test_yearly_load_builds_its_inputs_once(spark, sf0001):
    """The stand-ins' joins are not part of the plan any more; the rows are those of the plan
    straight from the stand-ins."""
    from palmyra.checks import queries as q
    from palmyra.checks.standins import standin
    from palmyra.plans import weighbridge
    from palmyra.plans.bjr import clean_bjr
    got = QUERIES["load_wb_actual"](spark, sf0001)
    assert "lineitem" not in plan(got)
    bjr, wb = standin(spark, sf0001, "bjr"), standin(spark, sf0001, "weighbridge")
    want = q.rounded(weighbridge.load_wb_actual(
        bjr, wb, weighbridge.prorate_netto(clean_bjr(bjr, exclude=q.WB_EXCLUDE), wb), q.AS_OF_WB,
        exclude=q.WB_EXCLUDE))
    rows = [sorted(map(tuple, df.collect()), key=repr) for df in (got, want)]
    assert rows[0] == rows[1] and rows[0] and got.dtypes == want.dtypes


def test_rounding_has_no_negative_zero(spark):
    from palmyra.checks.queries import rounded
    df = spark.createDataFrame([(-0.0,), (-1e-9,), (0.0,), (None,), (-2.5e-6,), (2.5e-6,), (float("inf"),)],
                               "v double").coalesce(1)
    df = cut_lineage(df, "zeros")       # rows of a list would be rounded by the planner
    assert [str(r.v) for r in rounded(df).collect()] == ["0.0", "0.0", "0.0", "None", "-3e-06", "3e-06", "inf"]
    # One value a column, not a case on a value that is computed for each branch.
    assert "= 0.0)" not in plan(rounded(df))
