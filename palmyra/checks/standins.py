"""Warehouse tables played by the driver's TPC-H-like tables.

The warehouse tables are not part of the test data, so each one is derived
from the driver tables with one SELECT. The same SQL text runs in Spark
(``spark.sql(text, lineitem=df, ...)``) and, with table names filled in, in
DuckDB for the oracle queries, so both sides start from identical input.

Roles: gauge readings = line items (estate = supplier, location = line
number, unknown for one estate in ten in February, reading = quantity x 4,
zero when there is no discount); stations =
suppliers (suppliers with a negative balance are listed twice, to exercise a
duplicated station); unit types = supplier region. Block fact = line items
with supplier, part type and brand as estate, division and block (unknown for
some). Weighbridge
= line items of orders (estate = priority, division = status); its BJR table
is aggregated from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

STANDINS: dict[str, tuple[tuple[str, ...], str]] = {
    "readings": (("lineitem",), """
SELECT CAST(year(l_shipdate) AS INT) AS Tahun,
       CAST(month(l_shipdate) AS INT) AS Bulan,
       CAST(l_suppkey AS STRING) AS Estate,
       CASE WHEN l_suppkey % 10 = 3 AND month(l_shipdate) = 2 THEN NULL
            ELSE CAST(l_linenumber AS STRING) END AS Lokasi,
       CAST(l_shipdate AS DATE) AS Date,
       CASE WHEN l_discount = 0 THEN 0.0 ELSE l_quantity * 4 END AS RainFallValue
FROM {lineitem}"""),
    "stations": (("supplier",), """
SELECT CAST(s_suppkey AS STRING) AS StationEstate,
       CAST(s_nationkey % 7 + 1 AS STRING) AS StationLokasi
FROM {supplier}
UNION ALL
SELECT CAST(s_suppkey AS STRING) AS StationEstate,
       CAST(s_nationkey % 7 + 1 AS STRING) AS StationLokasi
FROM {supplier} WHERE s_acctbal < 0"""),
    "unit_types": (("supplier", "nation", "region"), """
SELECT CAST(s.s_suppkey AS STRING) AS Unit, r.r_name AS UnitType
FROM {supplier} s
JOIN {nation} n ON s.s_nationkey = n.n_nationkey
JOIN {region} r ON n.n_regionkey = r.r_regionkey"""),
    "block_fact": (("lineitem",), """
SELECT CAST(year(l_shipdate) AS INT) AS Year,
       CAST(month(l_shipdate) AS INT) AS Month,
       l_suppkey AS UnitID, l_partkey AS DivisionID, l_partkey AS BlokID,
       make_date(CAST(year(l_shipdate) - l_partkey % 20 AS INT),
                 CAST(1 + l_partkey % 12 AS INT), 1) AS TanggalTanam,
       l_quantity AS LuasTanahYangDitanam,
       l_returnflag AS JenisKegiatan,
       CASE WHEN l_tax = 0 THEN NULL ELSE l_discount * 100 END AS BJRPabrik,
       CASE WHEN l_linestatus = 'F' THEN NULL ELSE l_tax * 100 END AS BJRSensus
FROM {lineitem}"""),
    "unit": (("supplier",), "SELECT s_suppkey AS UnitID, s_name AS UnitCode FROM {supplier}"),
    "division": (("part",), "SELECT p_partkey AS DivisionID, p_type AS DivisionCode FROM {part}"),
    "block": (("part",), "SELECT p_partkey AS BlokID, CASE WHEN p_partkey % 9 <> 4 "
              "THEN p_brand END AS KodeBlok FROM {part}"),
    "weighbridge": (("lineitem", "orders"), """
SELECT CAST(o.o_orderdate AS DATE) AS FullDate,
       o.o_orderpriority AS KodeKebun,
       substr(o.o_orderpriority, 3) AS ShortNameKebun,
       o.o_orderstatus AS KodeDivisi,
       concat('B', CAST(l.l_partkey % 1100 AS STRING)) AS KodeBlok,
       CAST(year(o.o_orderdate) - l.l_partkey % 20 AS INT) AS TahunTanam,
       l.l_partkey % 500 AS TotalPokok,
       CASE WHEN l.l_linenumber <= 2
            THEN CAST(floor(o.o_totalprice / 10000) AS DOUBLE) * 10000
            ELSE 0.0 END AS netto,
       CASE WHEN l.l_discount = 0 THEN CAST(0 AS BIGINT)
            WHEN l.l_tax = 0 THEN CAST(NULL AS BIGINT)
            ELSE CAST(l.l_quantity AS BIGINT) END AS Janjang
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey"""),
    "bjr": (("lineitem", "orders"), """
SELECT CAST(year(o.o_orderdate) AS INT) AS Tahun,
       CAST(month(o.o_orderdate) AS INT) AS Bulan,
       o.o_orderpriority AS KodeKebun,
       o.o_orderstatus AS KodeDivisi,
       CASE WHEN l.l_partkey % 11 <> 4
            THEN concat('B', CAST(l.l_partkey % 1100 AS STRING)) END AS KodeBlok,
       CAST(min(year(o.o_orderdate) - l.l_partkey % 20) AS BIGINT) AS TahunTanam,
       min(l.l_returnflag) AS JenisKegiatan,
       sum(l.l_quantity) AS LuasTanam,
       max(l.l_tax) * 100 AS BJRSensus,
       max(l.l_discount) * 100 AS BJRPabrik
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
GROUP BY CAST(year(o.o_orderdate) AS INT), CAST(month(o.o_orderdate) AS INT),
         o.o_orderpriority, o.o_orderstatus,
         CASE WHEN l.l_partkey % 11 <> 4
              THEN concat('B', CAST(l.l_partkey % 1100 AS STRING)) END"""),
    "order_history": (("orders",), """
SELECT CAST(year(o_orderdate) AS INT) AS Tahun,
       CAST(month(o_orderdate) AS INT) AS Bulan,
       o_orderpriority AS KodeKebun,
       o_orderstatus AS TipeKebun,
       o_orderkey, o_totalprice
FROM {orders}"""),
}


def standin(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tables, sql = STANDINS[name]
    dfs = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables}
    return spark.sql(sql, **dfs)


def standin_sql(name: str) -> str:
    tables, sql = STANDINS[name]
    return sql.format(**{t: t for t in tables})


def with_standins(names, body: str, recursive: bool = False) -> str:
    """DuckDB text: the named stand-ins as CTEs, then ``body`` (which may go
    on with more CTEs after a leading comma)."""
    ctes = ",\n".join(f"{n} AS ({standin_sql(n)})" for n in names)
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}\n{body}"
