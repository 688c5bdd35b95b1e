"""Demo inputs derived from the generic test tables.

The same text runs in Spark SQL and DuckDB: whole-number micro-degrees and one
division give both engines identical doubles. ``{name}`` stands for a source table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curbwise.session import staged_path, still_staged
from curbwise.sources.replace import gathered

DEMO_SQL: dict[str, str] = {}

# One customer in six asks in a far zone, of one kind (t) each: where the nearest
# pickup is 130, 180, 250, 400 or 700 m away (the last kind with very many spots,
# the one before with some of them in another rough cell, so that nothing is
# recommended), or where one pickup has most of the orders.
DEMO_SQL["order"] = """
WITH k AS (
  SELECT CAST(o_orderkey AS BIGINT) AS oid, CAST(o_custkey AS BIGINT) AS uid,
         CAST(o_orderkey % 84 AS BIGINT) AS d, CAST((o_custkey * 7919) % 48 AS BIGINT) AS s,
         CASE WHEN o_custkey % 6 = 5 THEN 1 + CAST((o_custkey - 5) / 6 AS BIGINT) % 6 ELSE 0 END AS t,
         CAST((o_custkey - 5 - (o_custkey - 5) % 36) / 36 AS BIGINT) % 3 AS far
  FROM {orders}),
m AS (
  SELECT oid, uid, d, t,
    CASE WHEN uid % 5 < 4 THEN 'bj' ELSE 'sh' END AS city,
    CASE WHEN uid % 5 < 4 THEN 39900000 ELSE 31200000 END
      + CASE WHEN t = 0 THEN CAST((s - s % 8) / 8 AS BIGINT) * 2500 WHEN t = 5 THEN 66600 ELSE 38600 + t * 5500 END AS la,
    CASE WHEN uid % 5 < 4 THEN 116300000 ELSE 121400000 END + CASE WHEN t = 0 THEN (s % 8) * 3200 WHEN t = 5 THEN -3300 WHEN t = 4 AND far = 0 THEN 5000 WHEN t = 6 THEN 11000
      ELSE far * 11000 END AS ln
  FROM k),
v AS (
  SELECT oid, uid, d, t, city, la, ln, 0 AS rev FROM m
  UNION ALL
  SELECT oid, uid, d, t, city, la, ln, 1 AS rev FROM m WHERE oid % 7 = 0),
w AS (
  SELECT oid, uid, d, city, la, ln, rev,
    CASE t WHEN 0 THEN ((oid * oid) % 29 - 14) * 60 WHEN 1 THEN 1300 + oid % 9 * 20 WHEN 2 THEN 1750 + oid % 9 * 20
      WHEN 3 THEN oid % 5 * 30 WHEN 4 THEN oid % 7 * 40 WHEN 5 THEN (oid * 7) % 47 * 108 - 2300
      ELSE CASE WHEN oid % 2 = 0 THEN 0 ELSE (oid % 11 * (oid % 5) - 20) * 20 END END AS north,
    CASE t WHEN 0 THEN ((oid * oid + uid) % 23 - 11) * 70 WHEN 1 THEN oid % 5 * 40 WHEN 2 THEN oid % 5 * 40
      WHEN 3 THEN 3100 + oid % 9 * 30 WHEN 4 THEN 4900 + oid % 9 * 30 WHEN 5 THEN 6300 + (oid * 11) % 41 * 100
      ELSE CASE WHEN oid % 2 = 0 THEN 0 ELSE (oid % 7 * (oid % 13) - 36) * 12 END END AS east
  FROM v)
SELECT
  CAST(20170101 + CAST((d - d % 28) / 28 AS BIGINT) * 100 + d % 28 AS INT) AS dt,
  city, oid AS service_order_id, uid AS user_id, oid % 97 AS driver_id,
  CAST(1483228800 + d * 86400 + (oid * 61) % 86400 AS INT) AS start_time,
  CAST(1483228800 + d * 86400 + (oid * 61) % 86400 + 600 + oid % 1800 AS INT) AS end_time,
  concat('sp', CAST(oid % 48 AS VARCHAR(8))) AS start_position,
  concat('sa', CAST(oid % 48 AS VARCHAR(8))) AS start_address,
  concat('ep', CAST(oid % 31 AS VARCHAR(8))) AS end_position,
  concat('ea', CAST(oid % 31 AS VARCHAR(8))) AS end_address,
  CAST(la + ((oid * 31) % 11 - 5) * 40 AS DOUBLE) / 1000000 AS expect_start_latitude,
  CAST(ln + ((oid * 37) % 13 - 6) * 40 AS DOUBLE) / 1000000 AS expect_start_longitude,
  CAST(la + 20000 + oid % 500 AS DOUBLE) / 1000000 AS expect_end_latitude,
  CAST(ln + 30000 + oid % 700 AS DOUBLE) / 1000000 AS expect_end_longitude,
  CASE WHEN oid % 50 = 11 THEN CAST(0 AS DOUBLE) ELSE CAST(la + north + rev * 20 AS DOUBLE) / 1000000 END AS start_latitude,
  CAST(ln + east AS DOUBLE) / 1000000 AS start_longitude,
  CAST(la + 20100 + oid % 500 AS DOUBLE) / 1000000 AS end_latitude,
  CAST(ln + 30100 + oid % 700 AS DOUBLE) / 1000000 AS end_longitude,
  CASE WHEN oid % 20 = 3 THEN 3 ELSE 7 END AS status,
  CASE WHEN uid % 40 = 5 THEN concat('测试', CAST(uid AS VARCHAR(12))) ELSE concat('p', CAST(uid AS VARCHAR(12))) END AS passenger_name,
  1483228800 + oid + rev * 3600 AS update_time
FROM w
"""

DEMO_SQL["order_ext"] = """
SELECT
  CAST(20170101 + CAST((o_orderkey % 84 - (o_orderkey % 84) % 28) / 28 AS BIGINT) * 100 + (o_orderkey % 84) % 28 AS INT) AS dt,
  CASE WHEN o_custkey % 5 < 4 THEN 'bj' ELSE 'sh' END AS dest_city,
  CAST(o_orderkey AS BIGINT) AS service_order_id,
  CAST(116300000 + o_orderkey % 900 AS DOUBLE) / 1000000 AS create_order_longitude,
  CASE WHEN o_orderkey % 33 = 9 THEN CAST(0 AS DOUBLE) ELSE CAST(39900000 + o_orderkey % 700 AS DOUBLE) / 1000000 END AS create_order_latitude,
  CAST(39900100 + o_orderkey % 700 AS DOUBLE) / 1000000 AS confirm_latitude,
  CAST(116300100 + o_orderkey % 900 AS DOUBLE) / 1000000 AS confirm_longitude,
  CAST(39900200 + o_orderkey % 700 AS DOUBLE) / 1000000 AS arrive_latitude,
  CAST(116300200 + o_orderkey % 900 AS DOUBLE) / 1000000 AS arrive_longitude,
  1483228800 + CAST(o_orderkey AS BIGINT) AS update_time
FROM {orders} WHERE o_orderkey % 10 <> 4
"""

DEMO_SQL["poi"] = """
SELECT CAST(p_partkey AS BIGINT) AS poi_id,
  CASE WHEN p_partkey % 5 < 4 THEN 'bj' ELSE 'sh' END AS city,
  CAST(CASE WHEN p_partkey % 5 < 4 THEN 39900000 ELSE 31200000 END + (p_partkey * 613) % 13500 AS DOUBLE) / 1000000 AS lat,
  CAST(CASE WHEN p_partkey % 5 < 4 THEN 116300000 ELSE 121400000 END + (p_partkey * 977) % 23500 AS DOUBLE) / 1000000 AS lng,
  concat(p_name, '-', CAST(p_partkey % 37 AS VARCHAR(4))) AS name,
  CASE p_partkey % 11 WHEN 0 THEN '100000' WHEN 1 THEN '991400' WHEN 2 THEN '150700' WHEN 3 THEN '150500'
    WHEN 4 THEN '150800' WHEN 5 THEN '150600' WHEN 6 THEN '150400' WHEN 7 THEN '150200'
    WHEN 8 THEN '120302' WHEN 9 THEN '190301' ELSE '060101' END AS typecode
FROM {part}
"""

DEMO_SQL["road"] = """
SELECT CAST(c.c_custkey AS BIGINT) AS point_id,
  CAST(39900000 + (c.c_custkey * 389) % 13500 AS DOUBLE) / 1000000 AS lat,
  CAST(116300000 + (c.c_custkey * 571) % 23500 AS DOUBLE) / 1000000 AS lng,
  concat('road', CAST(k AS VARCHAR(4))) AS name,
  CAST((c.c_custkey * 17 + k * 29) % 2990 AS DOUBLE) / 10 AS distance,
  CASE (c.c_custkey + k) % 8 WHEN 0 THEN '北' WHEN 1 THEN '东北' WHEN 2 THEN '东' WHEN 3 THEN '东南'
    WHEN 4 THEN '南' WHEN 5 THEN '西南' WHEN 6 THEN '西' ELSE '西北' END AS direction,
  CASE WHEN k % 3 = 2 THEN 'roadinter' ELSE 'road' END AS type
FROM (
  SELECT c_custkey, 0 AS k FROM {customer} UNION ALL SELECT c_custkey, 1 AS k FROM {customer}
  UNION ALL SELECT c_custkey, 2 AS k FROM {customer} UNION ALL SELECT c_custkey, 3 AS k FROM {customer}) c
WHERE c.c_custkey % 9 <> 0
"""

# An address for each customer; the other address inputs miss one customer in eleven.
DEMO_SQL["whole_address"] = """
SELECT CAST(c_custkey AS BIGINT) AS point_id,
  concat('北京市', '北京市', '海淀区', CASE WHEN c_custkey % 5 = 1 THEN '' WHEN c_custkey % 7 = 3 THEN '上庄乡' WHEN c_custkey % 2 = 0 THEN '中关村街道' ELSE '上庄镇' END, '路', CAST(c_custkey AS VARCHAR(12)), '号') AS formatted_address,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE '北京市' END AS province,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE '北京市' END AS city,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE '海淀区' END AS district,
  CASE WHEN c_custkey % 3 = 0 OR c_custkey % 5 = 1 THEN NULL WHEN c_custkey % 7 = 3 THEN '上庄乡' WHEN c_custkey % 2 = 0 THEN '中关村街道' ELSE '上庄镇' END AS township
FROM {customer}
"""

DEMO_SQL["address"] = DEMO_SQL["whole_address"].rstrip("\n") + " WHERE c_custkey % 11 <> 6\n"

DEMO_SQL["request"] = """
SELECT CAST(c_custkey AS BIGINT) AS request_id,
  CASE WHEN c_custkey % 5 < 4 THEN 'bj' ELSE 'sh' END AS city,
  CAST(CASE WHEN c_custkey % 5 < 4 THEN 39900000 ELSE 31200000 END + (c_custkey % 6) * 2500 + (c_custkey % 11 - 5) * 40 + CASE WHEN c_custkey % 13 = 0 THEN 500000 WHEN c_custkey % 7 = 2 THEN 45000 ELSE 0 END AS DOUBLE) / 1000000 AS lat,
  CAST(CASE WHEN c_custkey % 5 < 4 THEN 116300000 ELSE 121400000 END + (c_custkey % 8) * 3200 + (c_custkey % 13 - 6) * 40 AS DOUBLE) / 1000000 AS lng
FROM {customer}
"""


SOURCE_TABLES = ("orders", "part", "customer", "nation")


_staged: dict[tuple[str, str, str], str] = {}


def demo_plan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived input as a lazy plan over the source Parquet files."""
    text = DEMO_SQL[name]
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in SOURCE_TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def demo_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same input as a table, derived once per session and again where its folder is gone.

    Production inputs are Parquet tables; staging the derived rows gives the
    operators the same kind of scan.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    plan = demo_plan(spark, sf_dir, name)
    if key not in _staged or not still_staged(spark, _staged[key]):
        path = staged_path(spark, f"demo-{name}")
        if "dt" in plan.columns:  # a folder per day, as raw orders have
            gathered(plan, "dt").write.partitionBy("dt").parquet(path)
        else:
            plan.write.parquet(path)
        _staged[key] = path
    return spark.read.schema(plan.schema).parquet(_staged[key]).select(*plan.columns)
