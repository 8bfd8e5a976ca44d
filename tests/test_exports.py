"""Ordered output and workbook export, read back."""

import datetime as dt
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from palmyra.sources.ordered import read_ordered, write_ordered
from palmyra.sources.workbook import (LIST, _listed, _store, export_workbook, load_workbook,
                                      read_workbook, write_workbook)
from palmyra.sources.writers import scratch_path


def test_files_in_name_order_hold_the_table_in_order(spark):
    rows = spark.range(5000).select(F.concat(F.lit("E"), F.pmod(F.xxhash64("id"), F.lit(37))).alias("estate"), "id")
    path = scratch_path(spark, "ordered")
    write_ordered(rows, path, ["estate", F.desc("id")], files=8)
    got = read_ordered(spark, path).collect()
    assert len({r.file for r in got}) > 1 and {r.position for r in got} == set(range(1, 5001))
    want = sorted(rows.collect(), key=lambda r: (r.estate, -r.id))
    assert [(r.estate, r.id) for r in sorted(got, key=lambda r: r.position)] == [(r.estate, r.id) for r in want]
    assert [(r.file, r.place) for r in sorted(got, key=lambda r: r.position)] == sorted((r.file, r.place) for r in got)


def test_ordered_empty_and_null_keys(spark):
    path = scratch_path(spark, "ordered-null")
    rows = spark.createDataFrame([(None, 1), ("b", 2), ("a", 3), (None, 4)], "k string, v int")
    write_ordered(rows, path, ["k"])
    assert [r.k for r in read_ordered(spark, path).orderBy("position").collect()] == [None, None, "a", "b"]
    empty = scratch_path(spark, "ordered-empty")
    write_ordered(rows.limit(0), empty, ["k"])
    assert read_ordered(spark, empty, rows.schema).count() == 0


ODD = [("a & <b> \"c\"", 1, 2**53, 1.5, True, dt.date(2024, 2, 29)), ("", -7, -1, -0.25, False, None),
       (None, None, None, None, None, None), ("  two\nlines\ttab \r ", 0, 0, 1e-300, True, dt.date(1, 1, 1)),
       ("_x0041_ \x00\x1f é 日本 😀", 5, 6, 1e300, False, dt.date(9999, 12, 31))]
SCHEMA = "t string, i int, l long, d double, b boolean, day date"


def test_workbook_round_trip(spark):
    df = spark.createDataFrame(ODD * 3, SCHEMA).repartition(4)
    path = scratch_path(spark, "workbook")
    export_workbook(df, path)
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted(map(tuple, load_workbook(spark, path, df.schema).collect()), key=key) \
        == sorted(map(tuple, df.collect()), key=key)
    some = load_workbook(spark, path, df.select("d", "t").schema)       # columns go by name
    assert sorted(map(tuple, some.collect()), key=key) == sorted(map(tuple, df.select("d", "t").collect()), key=key)
    export_workbook(df.limit(2), path)
    assert load_workbook(spark, path, df.schema).count() == 17
    with pytest.raises(Exception, match="appended"):
        df.write.format("workbook").mode("overwrite").save(path)


def test_a_failed_task_leaves_nothing_that_counts(spark):
    path = scratch_path(spark, "workbook-failing")
    df = spark.range(100).repartition(4).select(
        F.when(F.col("id") == 77, F.raise_error(F.lit("lost half way"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost half way"):
        export_workbook(df, path)
    assert _listed(*_store(path)) == []
    export_workbook(spark.range(5), path)
    assert load_workbook(spark, path, spark.range(1).schema).count() == 5
    assert LIST == "_parts.json"


def test_sheets_and_parts_are_valid_packages():
    out = io.BytesIO()
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("s", T.StringType())])
    assert write_workbook(out, ["n", "s"], iter([(i, f"r{i}") for i in range(25)]), sheet_rows=11) == 25
    with zipfile.ZipFile(out) as book:
        assert book.testzip() is None
        assert sum(n.startswith("xl/worksheets/") for n in book.namelist()) == 3
        from xml.etree import ElementTree
        for name in book.namelist():
            ElementTree.fromstring(book.read(name))
    assert list(read_workbook(out, schema)) == [(i, f"r{i}") for i in range(25)]
    empty = io.BytesIO()
    assert write_workbook(empty, ["n", "s"], iter([])) == 0 and list(read_workbook(empty, schema)) == []
