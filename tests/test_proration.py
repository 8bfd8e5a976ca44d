"""Proration of netto over blocks: hand-computed cases and variants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from palmyra.functions.scalar import guarded_divide
from palmyra.plans.weighbridge import OUTPUT_COLUMNS, prorate_netto

DAY = dt.date(2024, 5, 7)
BJR = {"A": 10.0, "B": 20.0, "C": 10.0, "D": 10.0}


def _run(spark, wb_rows):
    bjr = spark.createDataFrame(
        [(2024, 5, "E", "D1", b, 2010, "P", 1.0, 0.0, v) for b, v in BJR.items()],
        "Tahun int, Bulan int, KodeKebun string, KodeDivisi string, KodeBlok string, "
        "TahunTanam long, JenisKegiatan string, LuasTanam double, BJRSensus double, "
        "BJRPabrik double")
    wb = spark.createDataFrame(
        [(DAY, "E", "EST", "D1", b, 2011, 10, netto, jj) for b, jj, netto in wb_rows],
        "FullDate date, KodeKebun string, ShortNameKebun string, KodeDivisi string, "
        "KodeBlok string, TahunTanam int, TotalPokok long, netto double, Janjang long")
    out = prorate_netto(bjr, wb)
    assert out.columns == OUTPUT_COLUMNS
    return out.collect()


def test_base_case(spark):
    got = {r.KodeBlok: r for r in _run(spark, [("A", 100, 4000.0), ("B", 50, 0.0),
                                               ("C", 0, 0.0), ("D", None, 0.0)])}
    exp = {"A": (1000.0, 2000.0, 4000.0, 2000.0, 20.0), "B": (1000.0, 2000.0, 4000.0, 2000.0, 40.0),
           "C": (0.0, 2000.0, 4000.0, 0.0, 0.0), "D": (None, 2000.0, 4000.0, None, None)}
    for b, e in exp.items():
        r = got[b]
        assert (r.KG_ACT, r.KG_Total, r.netto, r.KG_PKS, r.BJR_PKS) == e
    assert got["D"].Janjang == 0 and got["A"].TahunTanam == 2010


def test_same_netto_twice_halves_shares(spark):
    got = _run(spark, [("A", 100, 4000.0), ("B", 50, 4000.0)])
    assert {r.KG_Total for r in got} == {4000.0}
    assert sorted(r.KG_PKS for r in got) == [1000.0, 1000.0]


def test_two_nettos_duplicate_rows(spark):
    got = _run(spark, [("A", 100, 4000.0), ("B", 50, 3000.0)])
    assert sorted((r.KodeBlok, r.netto) for r in got) == [
        ("A", 3000.0), ("A", 4000.0), ("B", 3000.0), ("B", 4000.0)]


def test_no_netto_no_rows(spark):
    assert _run(spark, [("A", 100, 0.0), ("B", 50, 0.0)]) == []


def test_all_zero_bunches(spark):
    got = _run(spark, [("A", 0, 4000.0), ("B", 0, 0.0)])
    assert {(r.KG_PKS, r.BJR_PKS) for r in got} == {(0.0, 0.0)}


def test_one_netto_shares_sum_to_netto(spark):
    got = _run(spark, [("A", 100, 5000.0), ("B", 70, 0.0), ("C", 30, 0.0)])
    assert sum(r.KG_PKS for r in got) == pytest.approx(5000.0)


def test_guarded_divide(spark):
    df = spark.createDataFrame([(None, 1.0), (1.0, None), (0.0, 0.0), (3.0, 0.0), (-3.0, 0.0),
                                (3.0, 2.0)], "n double, d double")
    got = [r.q for r in df.select(guarded_divide("n", "d").alias("q")).collect()]
    assert got == [None, None, 0.0, float("inf"), float("-inf"), 1.5]
    assert df.select(guarded_divide(F.col("n"), F.lit(0)).alias("q")).count() == 6


def test_guarded_divide_property(spark):
    """Against IEEE division with NaN -> 0 and NULL kept, on generated values."""
    import math

    import numpy as np
    from hypothesis import given, settings
    from hypothesis import strategies as st

    num = st.one_of(st.none(), st.sampled_from([0.0, -0.0, 1.5, -2.0, 1e300]),
                    st.floats(allow_nan=False, allow_infinity=False, width=32))
    pairs = st.lists(st.tuples(num, num), min_size=1, max_size=60)

    @settings(max_examples=6, deadline=None)
    @given(pairs)
    def check(rows):
        df = spark.createDataFrame(rows, "n double, d double")
        got = [r.q for r in df.select(guarded_divide("n", "d").alias("q")).collect()]
        for (n, d), q in zip(rows, got):
            if n is None or d is None:
                assert q is None
                continue
            with np.errstate(all="ignore"):
                e = float(np.float64(n) / np.float64(d))
            e = 0.0 if math.isnan(e) else e
            if d == 0 and n != 0:
                assert q == math.copysign(math.inf, n)
            else:
                assert q == e
    check()
