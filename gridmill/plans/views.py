"""Views of the given tables in the shapes that the operators read, and the same views in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ntz(df: DataFrame) -> DataFrame:
    """All timestamps without zone, as the SQL side has them."""
    return df.select(*[F.col(f"`{c}`").cast("timestamp_ntz").alias(c) if kind == "timestamp" else F.col(f"`{c}`") for c, kind in df.dtypes])


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.withColumn("ts", F.col("ts").cast("timestamp"))


KINDS = {"view": "actual_load", "click": "load_forecast", "purchase": "net_generation", "error": "total_interchange"}


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long observations: hourly sums of event values per region and variable."""
    e = events(spark, sf_dir).filter("event_type <> 'signup'")
    kind = F.lit(None).cast("string")
    for k, v in KINDS.items():
        kind = F.when(F.col("event_type") == k, v).otherwise(kind)
    keyed = e.select(F.date_trunc("hour", "ts").alias("observed_at"), F.concat(F.lit("R"), F.pmod("user_id", F.lit(4)).cast("string")).alias("region"), kind.alias("variable"), F.col("value").cast("decimal(18,2)").alias("v"))
    return keyed.groupBy("observed_at", "region", "variable").agg(F.sum("v").cast("double").alias("value"))


OBS = """obs AS (SELECT date_trunc('hour', ts) AS observed_at, 'R' || (user_id % 4) AS region,
  CASE event_type WHEN 'view' THEN 'actual_load' WHEN 'click' THEN 'load_forecast' WHEN 'purchase' THEN 'net_generation' WHEN 'error' THEN 'total_interchange' END AS variable,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM events WHERE event_type <> 'signup' GROUP BY ALL)"""

WIDE = OBS + """, wide AS (SELECT observed_at, region, max(value) FILTER (variable = 'actual_load') AS actual_load, max(value) FILTER (variable = 'load_forecast') AS load_forecast,
  max(value) FILTER (variable = 'net_generation') AS net_generation, max(value) FILTER (variable = 'total_interchange') AS total_interchange FROM obs GROUP BY ALL)"""

OWN = "NATION_1"


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily flows between the suppliers' and the customers' nations."""
    t = lambda n: table(spark, sf_dir, n)
    a, b = t("nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("from_region")), t("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("to_region"))
    joined = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(a, "s_nationkey").join(b, "c_nationkey")
    day = F.date_trunc("day", F.col("l_shipdate").cast("timestamp"))
    return joined.groupBy(day.alias("observed_at"), "from_region", "to_region").agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("value"))


FLOWS = """flows AS (SELECT date_trunc('day', l_shipdate) AS observed_at, a.n_name AS from_region, b.n_name AS to_region, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation a ON s_nationkey = a.n_nationkey JOIN nation b ON c_nationkey = b.n_nationkey GROUP BY ALL)"""


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as text records."""
    d = table(spark, sf_dir, "documents")
    at = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(mins=F.col("doc_id").cast("int"))
    return d.select("doc_id", F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("record_id"), "text", F.col("lang").alias("region"), "source", at.alias("published_at"))


DOCS = "docs AS (SELECT doc_id, 'doc:' || doc_id AS record_id, text, lang AS region, source, TIMESTAMP '2024-01-01' + to_minutes(CAST(doc_id AS INTEGER)) AS published_at FROM documents)"
