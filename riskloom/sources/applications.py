"""Application records derived from the order tables, for tests and queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Runs unchanged in Spark SQL and DuckDB; tables are named in braces for ``spark.sql``.
SQL = """
SELECT o.o_orderkey AS app_id,
  concat('P', CAST(o.o_custkey AS STRING)) AS passport_id,
  CAST(o.o_custkey % 120 AS STRING) AS contact_number,
  split_part(p.p_name, ' ', 1) AS first_name,
  split_part(p.p_name, ' ', 2) AS last_name,
  p.p_name AS full_name,
  concat(split_part(p.p_name, ' ', 1), CASE o.o_orderkey % 3 WHEN 0 THEN '.' WHEN 1 THEN '_' ELSE '' END,
    split_part(p.p_name, ' ', 2), CAST(o.o_custkey % 100 AS STRING), '@', lower(c.c_mktsegment),
    CASE o.o_orderkey % 3 WHEN 0 THEN '.com' WHEN 1 THEN '.co.uk' ELSE '.org' END) AS email,
  concat(p.p_type, ' ', CAST(o.o_custkey % 40 AS STRING)) AS city,
  n.n_name AS country, n2.n_name AS provider_country,
  CAST(o.o_custkey % 60 AS STRING) AS postcode,
  concat('10.0.', CAST(o.o_custkey % 50 AS STRING)) AS ip_short,
  o.o_orderpriority AS browser,
  CASE o.o_orderkey % 4 WHEN 0 THEN 'en-us,fr-fr' WHEN 1 THEN 'fr' WHEN 2 THEN 'DE-de, en-gb' END AS browser_language,
  o.o_orderdate AS app_date,
  CASE c.c_nationkey % 4 WHEN 0 THEN 'Europe/Paris' WHEN 1 THEN 'America/New_York' WHEN 2 THEN 'Asia/Tokyo' END AS local_timezone,
  CASE o.o_orderkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'no' END AS ueclf_24_app,
  CASE o.o_orderkey % 5 WHEN 0 THEN 'yes' ELSE 'NO' END AS uelf_25_app,
  CASE o.o_orderkey % 7 WHEN 0 THEN 'CLEANSED' WHEN 1 THEN 'OK' END AS cleansed
FROM {orders} o JOIN {customer} c ON c.c_custkey = o.o_custkey
JOIN {nation} n ON n.n_nationkey = c.c_nationkey
JOIN {nation} n2 ON n2.n_nationkey = (c.c_nationkey + CASE WHEN o.o_orderkey % 5 = 0 THEN 1 ELSE 0 END) % 25
JOIN {part} p ON p.p_partkey = o.o_orderkey % 200
"""
TABLES = ("orders", "customer", "nation", "part")


def duckdb_sql() -> str:
    return SQL.format(**{t: t for t in TABLES})


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order; ``row_id`` repeats app_id as the row order."""
    df = spark.sql(SQL, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES})
    return df.selectExpr("*", "app_id AS row_id").withColumn("app_date", df["app_date"].cast("timestamp"))
