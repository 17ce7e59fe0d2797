"""Queries of the streaming operators (I15, P32, X), run over all that is there and so equal to their batch forms."""

from pyspark.sql import functions as F

from gridmill.operators.features import local_time
from gridmill.plans import views as V
from gridmill.plans.registry import query, shared
from gridmill.sources.keyed import KeyedTable
from gridmill.streaming import streams as X


def _landed(spark, sf, where="true"):
    """A landing folder with the events, each twice, for the streams to read."""
    path = shared(spark)
    rows = V.events(spark, sf).filter(where)
    rows.unionByName(rows).write.parquet(path)
    return X.read_files(spark, path, rows.schema)


@query("stream_dedupe", "SELECT event_id, event_type FROM events")
def _(spark, sf):
    out = shared(spark)
    X.append_to(X.deduped(_landed(spark, sf), "event_id", "ts", "60 days").select("event_id", "event_type"), out, shared(spark)).awaitTermination()
    return spark.read.parquet(out)


@query("stream_standardize", "SELECT event_id, timezone('America/New_York', timezone('UTC', ts)) AS ts_local, value * 2 AS twice FROM events, range(2) WHERE event_type <> 'error'")
def _(spark, sf):
    out = shared(spark)

    def standardize(df):
        return df.filter("event_type <> 'error'").select("event_id", local_time("ts").alias("ts_local"), (F.col("value") * 2).alias("twice"))

    X.append_to(X.standardized(_landed(spark, sf), standardize), out, shared(spark)).awaitTermination()
    return spark.read.parquet(out)


# Landings of six days each. Of the last twelve hours of one, every tenth row comes with the next; of the first, every 97th comes with the last, too late to count.
_LANDINGS = """b AS (SELECT min(CAST(ts AS DATE)) AS first_day FROM events), l AS (SELECT e.*, CAST(floor(date_diff('day', first_day, CAST(ts AS DATE)) / 6) AS INTEGER) AS landing FROM events e, b),
k AS (SELECT * FROM l WHERE NOT (landing = 0 AND event_id % 97 = 0 AND (SELECT max(landing) FROM l) > 1))"""


def _landings(spark, sf):
    """The events with the number of the landing they come with, and how many landings there are."""
    e = V.events(spark, sf)
    first = F.lit(e.agg(F.to_date(F.min("ts"))).first()[0])
    own = F.floor(F.date_diff(F.to_date("ts"), first) / 6).cast("int")
    last = e.agg(F.max(own)).first()[0]
    late = (F.col("event_id") % 10 == 0) & (F.floor(F.date_diff(F.to_date(F.col("ts") + F.expr("interval 12 hours")), first) / 6) > own)
    landing = F.when((own == 0) & (F.col("event_id") % 97 == 0), last).when(late, F.least(own + 1, F.lit(last))).otherwise(own)
    return e.withColumn("landing", landing), last + 1


@query("stream_hourly_counts", f"""WITH {_LANDINGS} SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, round(avg(value / 100), 6) AS severity_mean,
 max(value / 100) AS severity_max, count(*) FILTER (value / 100 >= 0.7) AS severe_document_count FROM k GROUP BY ALL""")
def _(spark, sf):
    rows, n = _landings(spark, sf)
    landed, checkpoint = shared(spark), shared(spark)
    table = X.windows_table(spark, shared(spark), "event_type")
    for k in range(n):
        rows.filter(F.col("landing") == k).drop("landing").write.mode("append").parquet(landed)
        stream = X.read_files(spark, landed, rows.drop("landing").schema).withColumn("severity_score", F.col("value") / 100)
        X.windows_to(X.hourly_counts(stream, "ts", "event_type"), table, checkpoint).awaitTermination()
    return table.read().withColumns({"total": F.col("total").cast("double"), "severity_mean": F.round("severity_mean", 6)})


@query("stream_upsert", "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1")
def _(spark, sf):
    table = KeyedTable(spark, shared(spark), ["user_id"], "event_id", buckets=8)
    landed, checkpoint, rows = shared(spark), shared(spark), V.events(spark, sf)
    for k in range(3):
        # Every landing repeats a third of the events, so each comes once at least and some old ones come again.
        rows.filter(F.col("event_id") % 3 >= 2 - k).write.mode("append").parquet(landed)
        stream = X.read_files(spark, landed, rows.schema).select("user_id", "event_id", "event_type")
        X.upsert_to(stream, table, checkpoint).awaitTermination()
    return table.read()
