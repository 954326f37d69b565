"""Inputs of the registered queries, derived from the given tables.

The SQL is written so that Spark and DuckDB read it the same way; the checks use it as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tableferry.sources.tables import table

ROW = """
SELECT o_orderkey % 4 AS lane, o_orderkey AS ord,
       concat_ws('|', CAST(o_orderkey AS STRING), CAST(o_custkey AS STRING), o_orderstatus,
                 o_orderpriority) AS enc
FROM orders"""

MSG = """
SELECT user_id % 4 AS lane, event_id AS msg_id, concat('topic_', event_type) AS topic,
       ts AS publish_time, db_type, target_table, batch_id, n_rows,
       concat('[', repeat(concat(item, ','), n_rows - 1), item, ']') AS data, item
FROM (
  SELECT *,
       CASE WHEN event_id % 11 = 0 THEN '' WHEN event_id % 13 = 0 THEN 'HDFS'
            WHEN event_id % 2 = 0 THEN 'ClickHouse' ELSE 'kudu' END AS db_type,
       CASE WHEN event_id % 17 = 0 THEN '' WHEN event_id % 19 = 0 THEN 'impala::tmp.missing'
            ELSE concat('impala::tmp.', event_type) END AS target_table,
       CAST(CAST(ts AS DATE) AS STRING) AS batch_id,
       CASE WHEN event_id % 23 = 0 THEN substr(props, 1, length(props) - 1)
            WHEN event_id % 29 = 0 THEN '{"k": "x"}'
            ELSE props END AS item,
       CAST(1 + event_id % 5 AS INT) AS n_rows
  FROM events) raw"""

CLEAR = """
SELECT event_id AS msg_id, event_type AS clear_table, CAST(user_id % 3 AS STRING) AS part,
       concat('b', CAST(CAST(floor(event_id / 400.0) AS INT) AS STRING)) AS batch_id, value
FROM events"""

STAT = """
SELECT CAST({day} AS INT) AS date, event_type AS platform, CAST(user_id % 20 AS STRING) AS shop_id,
       CAST(user_id AS STRING) AS snick, COUNT(*) AS dialog_count
FROM events GROUP BY ALL"""
STAT_SPARK = STAT.format(day="date_format(ts, 'yyyyMMdd')")
STAT_SQL = STAT.format(day="strftime(ts, '%Y%m%d')")

DAY_SPARK = "CAST(date_format(ts, 'yyyyMMdd') AS BIGINT)"
DAY_SQL = "CAST(strftime(ts, '%Y%m%d') AS BIGINT)"

# The targets that exist.
KNOWN_TARGETS = ("tmp.click", "tmp.error", "tmp.purchase", "tmp.signup", "tmp.view")


def derived(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    """Run fixture SQL over the named tables."""
    frames = {n: table(spark, sf_dir, n) for n in names}
    text = sql
    for n in names:
        text = text.replace(f"FROM {n}", "FROM {" + n + "}")
    # braces of JSON text in the SQL are kept apart from the table placeholders
    text = text.replace('{"k": "x"}', '{{"k": "x"}}')
    return spark.sql(text, **frames)


def rows(spark, sf_dir) -> DataFrame:
    return derived(spark, sf_dir, ROW, "orders")


def messages(spark, sf_dir) -> DataFrame:
    return derived(spark, sf_dir, MSG, "events").drop("item")


def clears(spark, sf_dir) -> DataFrame:
    return derived(spark, sf_dir, CLEAR, "events")


def stats(spark, sf_dir) -> DataFrame:
    return derived(spark, sf_dir, STAT_SPARK, "events")
