"""Record-linkage inputs derived from the driver's tables, in SQL that Spark and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = "customer nation part documents orders lineitem pages conversations".split()

#: One clean record a customer; up to five noisy copies of eight kinds; the customer key is the truth.
REGISTRY = """
WITH base AS (
  SELECT c_custkey AS k, CASE c_custkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS country,
    split_part(text, ' ', 2) AS w2, split_part(text, ' ', 3) AS w3, split_part(text, ' ', 4) AS w4, p_name, n_name,
    CASE c_custkey % 4 WHEN 0 THEN 'Inc' WHEN 1 THEN 'LLC' WHEN 2 THEN 'SARL' ELSE 'Pvt Ltd' END AS legal,
    (c_custkey * 37) % 900 + 1 AS num
  FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {part} ON p_partkey = c_custkey
    JOIN (SELECT count(*) AS n_docs FROM {documents}) AS n ON 1 = 1 JOIN {documents} ON doc_id = c_custkey % n_docs),
clean AS (
  SELECT k, country, w2, w3, w4, p_name, n_name, legal, num, concat_ws(' ', w2, w3, p_name, legal) AS name,
    concat(CAST(num AS VARCHAR(20)), ' ', w4, ' Street, ', n_name) AS address FROM base),
copies AS (SELECT c.*, j.j, (k + j.j) % 8 AS kind FROM clean AS c JOIN (VALUES (0), (1), (2), (3), (4)) AS j(j) ON j.j < k % 6)
SELECT concat('S1-', CAST(k AS VARCHAR(20))) AS entity_id, 1 AS source, country, name AS business_name, address AS business_address, concat('S1-', CAST(k AS VARCHAR(20))) AS owner FROM clean
UNION ALL
SELECT concat('S', CAST(2 + j % 2 AS VARCHAR(20)), '-', CAST(k * 10 + j AS VARCHAR(20))) AS entity_id, 2 + j % 2 AS source, country,
  CASE kind WHEN 0 THEN upper(replace(name, 'ß', 'ss')) WHEN 1 THEN concat_ws(' ', legal, p_name, w3, w2) WHEN 2 THEN concat('M/s ', name)
    WHEN 3 THEN concat(name, ' (ID: ', CAST(k AS VARCHAR(20)), ')') WHEN 4 THEN concat(replace(name, ' ', ''), '.com') ELSE name END AS business_name,
  CASE kind WHEN 5 THEN '' WHEN 6 THEN concat(n_name, ', ', w4, ' Street ', CAST(num AS VARCHAR(20)), ' NULL')
    WHEN 7 THEN concat(CAST(num + 1 AS VARCHAR(20)), ' ', w4, ' st, ', n_name) ELSE address END AS business_address,
  concat('S1-', CAST(k AS VARCHAR(20))) AS owner
FROM copies
"""
#: Scored pairs of entities and records, with labels.
SCORED = """
SELECT s1_id, cand_id, CAST(2 + cand_id % 2 AS INT) AS source, CASE s1_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS country,
  CAST((cand_id * 7919 + s1_id * 31) % 1000 AS DOUBLE) / 1000 AS score, CAST((cand_id + s1_id) % 4 = 0 AS INT) AS y
FROM (SELECT DISTINCT o_custkey AS s1_id, l_partkey AS cand_id FROM {orders} JOIN {lineitem} ON l_orderkey = o_orderkey) AS p
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _made(spark: SparkSession, sf_dir: str, sql: str, **instead: DataFrame) -> DataFrame:
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in sql} | instead)


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity_id, source, country, business_name, business_address, owner.

    The SQL takes the second to fourth word of a text: the others are left behind where it is read, not sent to the join."""
    words = table(spark, sf_dir, "documents").select("doc_id", F.substring_index("text", " ", 4).alias("text"))
    return _made(spark, sf_dir, REGISTRY, documents=words)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """s1_id, cand_id, source, country, score, y."""
    return _made(spark, sf_dir, SCORED)


def duck(sql: str) -> str:
    return sql.format(**{t: t for t in TABLES})
