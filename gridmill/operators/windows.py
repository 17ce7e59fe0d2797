"""Ingestion windows, grids and ranges (rows I01 to I13, A20)."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def incremental_start(checkpoint: Column, to_date: Column, lookback_days: int) -> Column:
    """The checkpoint, else the end, less the lookback."""
    if lookback_days < 0:
        raise ValueError("lookback must not be negative")
    return F.coalesce(checkpoint, to_date) - F.make_interval(days=F.lit(lookback_days))


def in_window(ts: Column, start: Column, end: Column) -> Column:
    """Half-open [start, end)."""
    return (ts >= start) & (ts < end)


def backfill_windows(spark: SparkSession, start: datetime, end: datetime, days: int) -> DataFrame:
    """Half-open windows of ``days`` days from start to end, the last one clipped; equal bounds give none."""
    if days < 1 or end < start:
        raise ValueError("window size must be at least 1 and bounds in order")
    if start == end:
        return spark.createDataFrame([], "window_no int, window_start timestamp, window_end timestamp")
    first, last = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    step = F.make_dt_interval(days=F.lit(days))
    starts = F.sequence(first, last - F.expr("interval 1 microsecond"), step)
    return spark.range(1).select(F.posexplode(starts).alias("window_no", "window_start")).withColumn("window_end", F.least(F.col("window_start") + step, last))


def assign_windows(rows: DataFrame, windows: DataFrame, ts: str) -> DataFrame:
    """Every row with each window [window_start, window_end) it falls into, by an equi-join on bins; rows in no window are left out.

    Windows may differ in width, overlap and leave gaps; an empty or null one holds no
    row. A window's bins are as wide as the next power of two of its width (in
    microseconds), so it meets two of them at most, and a row looks into one bin for
    each such width that there is: 63 at most, whatever the windows.
    """
    bounds = windows.filter("window_start < window_end").withColumns({"_a": F.unix_micros("window_start"), "_b": F.unix_micros("window_end")})
    # bin() gives the binary digits: as many as the least power of two that is no less has zeros.
    bounds = bounds.withColumn("_level", F.when(F.col("_b") - F.col("_a") > 1, F.length(F.bin(F.col("_b") - F.col("_a") - 1))).otherwise(0))
    levels = sorted(r[0] for r in bounds.select("_level").distinct().collect())
    bins = lambda at, level: F.call_function("shiftright", at, level)  # noqa: E731  floor, for stamps before 1970, too
    cut = bounds.withColumn("_bin", F.explode(F.array_distinct(F.array(bins(F.col("_a"), F.col("_level")), bins(F.col("_b") - 1, F.col("_level"))))))
    placed = rows.withColumn("_at", F.unix_micros(ts)).filter("_at is not null")
    placed = placed.withColumn("_level", F.explode(F.array(*[F.lit(k) for k in levels]).cast("array<int>"))).withColumn("_bin", bins(F.col("_at"), F.col("_level")))
    return placed.join(cut, ["_level", "_bin"]).filter((F.col("_at") >= F.col("_a")) & (F.col("_at") < F.col("_b"))).drop("_at", "_level", "_bin", "_a", "_b")


#: Steps that windows' bounds may keep to, in microseconds: day, hour, minute, second, millisecond.
STEPS = (86_400_000_000, 3_600_000_000, 60_000_000, 1_000_000, 1_000)


def window_totals(rows: DataFrame, windows: DataFrame, ts: str, value: str, *by: str) -> DataFrame:
    """``by``, n, first and last (least and greatest value) of the rows in the windows of a key, without a pair of a row and a window; keys without rows are left out.

    Time is counted in the widest of ``STEPS`` that all bounds keep to, else in
    microseconds. Rows are added up by step, and the steps by bins of one, two, four and
    so on. A window is cut into the bins that make it up, at most two of each width:
    its total is theirs, however many rows they hold.
    """
    micros = windows.filter("window_start < window_end").select(*by, F.unix_micros("window_start").alias("_a"), F.unix_micros("window_end").alias("_b"))
    uneven = [F.max((F.col("_a") % s != 0) | (F.col("_b") % s != 0)).alias(f"s{s}") for s in STEPS]
    seen = micros.agg(F.min("_a").alias("a"), F.max("_b").alias("b"), F.max(F.col("_b") - F.col("_a")).alias("width"), *uneven).first()
    step = next((s for s in STEPS if seen[f"s{s}"] is False), 1)
    levels = F.sequence(F.lit(0), F.lit(max(1, (seen.width or 1) // step).bit_length() - 1))
    shift = lambda at, level: F.call_function("shiftright", at, level)  # noqa: E731  floor, for stamps before 1970, too

    def cut(level):
        # Bins of this width from the first that begins in the window to the last that ends in it: an odd one at either end is no half of a wider one within.
        a, b = -shift(-F.col("_a"), level), shift(F.col("_b"), level)
        odd = lambda x: F.pmod(x, F.lit(2)) == 1
        bins = lambda at, holds: F.struct(level.alias("_level"), F.when((a < b) & holds, at).alias("_bin"))
        return F.array(bins(a, odd(a)), bins(b - 1, odd(b)))

    made = micros.withColumns({"_a": F.expr(f"_a div {step}"), "_b": F.expr(f"_b div {step}")})
    cuts = made.select(*by, F.explode(F.filter(F.flatten(F.transform(levels, cut)), lambda c: c["_bin"].isNotNull())).alias("c")).select(*by, "c._level", "c._bin")
    totals = lambda n: (F.sum(n).alias("n"), F.min("first").alias("first"), F.max("last").alias("last"))
    stamped = rows.select(F.unix_micros(ts).alias("_at"), F.col(value).alias("first"), F.col(value).alias("last"), F.lit(1).cast("long").alias("n")).filter((F.col("_at") >= F.lit(seen.a)) & (F.col("_at") < F.lit(seen.b)))
    steps = stamped.groupBy(F.expr(f"(_at - pmod(_at, {step})) div {step}").alias("_step")).agg(*totals("n"))
    bins = steps.withColumn("_level", F.explode(levels)).groupBy("_level", shift(F.col("_step"), F.col("_level")).alias("_bin")).agg(*totals("n"))
    return cuts.join(bins, ["_level", "_bin"]).groupBy(*by).agg(*totals("n"))


def backfill_summary(runs: DataFrame) -> DataFrame:
    """Windows done, and what was fetched, written and skipped, over the window rows of a backfill."""
    return runs.agg(F.count("*").alias("windows"), F.count_if(F.col("status") == "success").alias("windows_done"), *[F.sum(c).alias(c) for c in ("fetched", "written", "skipped")])


def quarter_hours(start: Column, end: Column, latest: Column | None = None) -> Column:
    """The 15-minute grid of [start, end), both floored, capped at ``latest``; an array of stamps, empty where start is not before end."""
    floor = lambda c: F.timestamp_micros((F.floor(F.unix_micros(c) / 900_000_000) * 900_000_000).cast("long"))
    last = F.least(floor(end), latest) if latest is not None else floor(end)
    step = F.expr("interval 15 minutes")
    return F.when(floor(start) < last, F.sequence(floor(start), last - step, step)).otherwise(F.array().cast("array<timestamp>"))


def stratified_days(days: DataFrame, per_month: int) -> DataFrame:
    """``per_month`` days of each month, evenly spaced from the first to the last; ties of rounding go to even."""
    if per_month < 1:
        raise ValueError("at least one day a month")
    months = days.select("day", F.date_trunc("month", "day").cast("date").alias("month")).distinct()
    listed = months.groupBy("month").agg(F.array_sort(F.collect_list("day")).alias("days"))
    n, k = F.size("days"), F.least(F.lit(per_month), F.size("days"))
    places = F.when(k == 1, F.array(F.lit(0))).otherwise(F.transform(F.sequence(F.lit(0), k - 1), lambda i: F.bround(i * (n - 1) / (k - 1), 0).cast("int")))
    return listed.select("month", F.explode(F.array_distinct(places)).alias("at"), "days").select("month", F.element_at("days", F.col("at") + 1).alias("day"))


def direction_filter(own: str, from_col: str, to_col: str, direction: str, neighbours: list[str] | None = None) -> Column:
    """Outbound, inbound or both, with an optional list of neighbours; a row that fits both ways counts once."""
    out, into = F.col(from_col) == own, F.col(to_col) == own
    if neighbours:
        out, into = out & F.col(to_col).isin(neighbours), into & F.col(from_col).isin(neighbours)
    try:
        return {"outbound": out, "inbound": into, "both": out | into}[direction]
    except KeyError:
        raise ValueError("direction must be outbound, inbound or both") from None


def missing_dates(df: DataFrame, day: str, *by: str) -> DataFrame:
    """The days between the first and the last that have no row, per series if keys are named."""
    seen = df.select(*by, F.to_date(day).alias("day")).distinct()
    ends = seen.groupBy(*by).agg(F.min("day").alias("a"), F.max("day").alias("b"))
    return ends.filter("a is not null").select(*by, F.explode(F.sequence("a", "b")).alias("day")).join(seen, [*by, "day"], "left_anti")


def day_span(start: datetime, days: int) -> list[datetime]:
    return [start + timedelta(days=i) for i in range(days)]
