"""Exploration and data quality (rows A01 to A26)."""

from __future__ import annotations

import functools
import math
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmill.operators.features import CHUNK, add_lags


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Counts and shares of a column's values, most frequent first, ties by value."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("_t"))
    shared = counts.join(F.broadcast(total)).withColumn("share", F.col("n") / F.col("_t")).drop("_t")
    ordered = shared.orderBy(F.desc("n"), F.asc("value"))
    return ordered.limit(top) if top else ordered


def null_fraction(df: DataFrame) -> DataFrame:
    """The share of nulls in each column, in one pass."""
    row = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns])
    return row.unpivot([], df.columns, "column_name", "null_fraction")


def duplicate_rate(df: DataFrame, *keys: str) -> DataFrame:
    """Rows, distinct keys and the share of rows that repeat an earlier one."""
    per = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return per.agg(F.sum("_n").alias("n"), F.count("*").alias("n_distinct")).withColumn("dup_rate", 1 - F.col("n_distinct") / F.col("n"))


def duplicate_members(df: DataFrame, *keys: str) -> DataFrame:
    """All rows whose key occurs more than once."""
    return df.join(df.groupBy(*keys).agg(F.count("*").alias("group_size")).filter("group_size > 1"), list(keys))


#: Relative rank error of the first look at a quantile, and rows of a group up to which all its values are looked at.
RANKS, SMALL = 10_000, 20_000
QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def describe(df: DataFrame, column: str, *by: str) -> DataFrame:
    """Count, mean, deviation, range and exact quartiles, per group if any.

    Quartiles are selected, not sorted for: one aggregation gives, beside the other
    figures, two values that a quartile's ranks are sure to lie between (a sketch whose
    rank error is bounded); of the counts of distinct values only those between are put
    in order, a few in ten thousand of a large group, and those below are added up.
    Values are interpolated between ranks. Nulls are not counted; NaN is the greatest.
    """
    c, value = F.col(column), F.col(column).cast("double")
    ends = [p for s in QUARTILES.values() for p in (s - 2 / RANKS, s + 2 / RANKS)]
    keys = [F.col(f"`{g}`").alias(f"_g{i}") for i, g in enumerate(by)] or [F.lit(0).alias("_g0")]
    names = [f"_g{i}" for i in range(max(1, len(by)))]
    keyed = df.select(*keys, c.alias("_c"), value.alias("_v"))
    stats = keyed.groupBy(*names).agg(F.count("_c").alias("n"), F.avg("_c").alias("mean"), F.stddev_samp("_c").alias("std"), F.min("_c").alias("min"), F.max("_c").alias("max"), F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.percentile_approx("_v", ends, RANKS).alias("_ends"))
    counts = keyed.filter("_v is not null").groupBy(*names, "_v").agg(F.count("*").alias("_k"))
    bounds = [F.struct(F.when(F.col("n") <= SMALL, F.col("_low")).otherwise(F.get("_ends", F.lit(2 * q))).alias("low"), F.when(F.col("n") <= SMALL, F.col("_high")).otherwise(F.get("_ends", F.lit(2 * q + 1))).alias("high")) for q in range(len(QUARTILES))]
    brackets = stats.select(*[F.col(k).alias(f"_s{k}") for k in names], F.col("n").alias("_n"), F.array(*bounds).alias("_b"))
    same = lambda left, right: functools.reduce(lambda x, y: x & y, [F.col(f"{left}{k}").eqNullSafe(F.col(f"{right}{k}")) for k in names])
    met = counts.join(brackets, same("", "_s"))
    # A value below a quartile's bracket only adds to the sum; one within is kept with its count.
    which = F.array_compact(F.array(*[F.when(F.col("_v") <= F.col("_b")[q]["high"], F.struct(F.lit(q).alias("q"), (F.col("_v") >= F.col("_b")[q]["low"]).alias("within"))) for q in range(len(QUARTILES))]))
    parts = met.select(*names, "_v", "_k", "_n", F.explode(which).alias("_q")).select(*names, "_n", F.col("_q.q").alias("_q"), F.when(F.col("_q.within"), F.col("_v")).alias("_v"), F.col("_q.within").alias("_in"), "_k")
    summed = parts.groupBy(*names, "_n", "_q", "_in", "_v").agg(F.sum("_k").alias("_k"))
    # The one row of what is below comes first (false before true).
    upto = F.sum("_k").over(Window.partitionBy(*names, "_q").orderBy("_in", "_v").rowsBetween(Window.unboundedPreceding, 0))
    placed = summed.withColumn("_to", upto).filter("_in")
    made = []
    for q, (name, share) in enumerate(QUARTILES.items()):
        rank = (F.col("_n") - 1) * share
        at = lambda k, q=q: F.max(F.when((F.col("_q") == q) & (F.col("_to") > k) & (F.col("_to") - F.col("_k") <= k), F.col("_v")))
        low, high, part = at(F.floor(rank)), at(F.ceil(rank)), F.max(rank - F.floor(rank))
        # A rank of its own is the value itself: nothing times an infinite gap would not be.
        made.append(F.when(low == high, low).otherwise(low + (high - low) * part).alias(name))
    quartiles = placed.groupBy(*names).agg(*made).select(*[F.col(k).alias(f"_r{k}") for k in names], *QUARTILES)
    out = stats.join(quartiles, same("", "_r"), "left")
    return out.select(*[F.col(f"_g{i}").alias(g) for i, g in enumerate(by)], "n", "mean", "std", "min", *QUARTILES, "max")


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """How often each run of a-z occurs in the lower-cased texts."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"\b[a-z]+\b"), F.lit(0))
    return df.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def top(df: DataFrame, n: int, count: str, *ties: str) -> DataFrame:
    return df.orderBy(F.desc(count), *ties).limit(n)


def counts_matrix(df: DataFrame, row: Column, name: str, column: str, values: list[str]) -> DataFrame:
    """Counts by row and column value, zero where there is none."""
    return df.groupBy(row.alias(name)).pivot(column, values).agg(F.count(F.lit(1))).na.fill(0, values)


def json_field_counts(df: DataFrame, column: str, field: str) -> DataFrame:
    """Counts of a field inside JSON text; rows that cannot be read are left out."""
    found = F.get_json_object(column, f"$.{field}")
    return df.select(found.alias("field_value")).filter("field_value is not null").groupBy("field_value").agg(F.count("*").alias("n"))


def keyword_hits(df: DataFrame, text: str, terms: list[str]) -> DataFrame:
    """How many texts hold each term, in one pass."""
    row = df.agg(*[F.count_if(F.lower(text).contains(t)).alias(t) for t in terms])
    return row.unpivot([], [F.col(f"`{t}`") for t in terms], "term", "n")


def explode_counts(df: DataFrame, items: Column) -> DataFrame:
    """A10: counts of the items of list columns."""
    return df.select(F.explode(items).alias("item")).groupBy("item").agg(F.count("*").alias("n"))


def location_parts(df: DataFrame, key: str, column: str) -> DataFrame:
    """A row for each location of a list, in its eight parts."""
    names = ("type", "name", "country", "adm1", "adm2", "latitude", "longitude", "feature_id")
    parts = df.select(key, F.explode(F.split(column, ";")).alias("_l")).filter("trim(_l) <> ''")
    return parts.select(key, *[F.nullif(F.trim(F.get(F.split("_l", "#"), F.lit(i))), F.lit("")).alias(n) for i, n in enumerate(names)])


def bridge(df: DataFrame, key: str, items: Column, name: str) -> DataFrame:
    """The distinct pairs of a key and the items of its list."""
    return df.select(key, F.explode(items).alias(name)).distinct()


def matches_any(c: Column, words: list[str]) -> Column:
    """Whether the text, in any case, has one of the words at word boundaries, by one regular expression; null has none."""
    pattern = r"(?i)\b(?:" + "|".join(re.escape(w) for w in words) + r")\b"
    return F.coalesce(c.rlike(pattern), F.lit(False))


def location_shares(parts: DataFrame, column: str) -> DataFrame:
    """Counts of a part of the locations with their share of all, most frequent first."""
    return value_counts(parts.filter(F.col(column).isNotNull()), column)


def city_counts(parts: DataFrame, country: str, types: tuple[str, ...] = ("3", "4")) -> DataFrame:
    """How often each city of one country is named; cities are the locations of the given types."""
    cities = parts.filter((F.col("country") == country) & F.col("type").isin(*types))
    return cities.groupBy("name").agg(F.count("*").alias("n"))


def any_term(c: Column, terms: list[str]) -> Column:
    """Whether the lower-cased text holds any of the terms; null holds none."""
    return F.coalesce(F.exists(F.array(*[F.lit(t) for t in terms]), lambda t: F.contains(F.lower(c), t)), F.lit(False))


def relevance_score(*flags: Column) -> Column:
    """How many of the flags hold."""
    total = F.lit(0)
    for f in flags:
        total = total + F.coalesce(f, F.lit(False)).cast("int")
    return total


def hash_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """N rows chosen by a seeded hash of the key, the same on every run."""
    return df.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(n)


def resample_daily(df: DataFrame, time: str, value: str, *by: str) -> DataFrame:
    """The mean of each day from the first to the last, per series if keys are named; days without rows have null."""
    daily = df.groupBy(*by, F.to_date(time).alias("day")).agg(F.avg(value).alias("mean"), F.count(value).alias("n"))
    ends = daily.groupBy(*by).agg(F.min("day").alias("a"), F.max("day").alias("b")).filter("a is not null")
    return ends.select(*by, F.explode(F.sequence("a", "b")).alias("day")).join(daily, [*by, "day"], "left").select(*by, "day", "mean", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def weekday_hour_profile(df: DataFrame, time: str, value: str) -> DataFrame:
    """The mean by hour (rows) and weekday, Monday first (columns)."""
    names = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]
    wide = df.withColumn("_w", F.weekday(time)).groupBy(F.hour(time).alias("hour")).pivot("_w", list(range(7))).agg(F.avg(value))
    return wide.select("hour", *[F.col(str(i)).alias(n) for i, n in enumerate(names)])


def interpolate_hourly(df: DataFrame, time: str, value: str, group: list[str]) -> DataFrame:
    """Hourly means of each group on a full grid, gaps filled along a line; the grid ends at known hours.

    Every known hour brings the gap before it, from the known hour before; that is one
    lag, taken over chunks of a group's order, so no task holds a whole group.
    """
    hourly = df.groupBy(*group, F.date_trunc("hour", time).alias("hour")).agg(F.avg(value).alias("known")).filter("known is not null")
    pairs = add_lags(hourly.withColumn("_p", F.struct("hour", "known")), "_p", [1], group, "hour", CHUNK)
    step, p = F.expr("interval 1 hour"), F.col("_p_lag_1")
    hours = F.when(p.isNull(), F.array("hour")).otherwise(F.sequence(p["hour"] + step, F.col("hour"), step))
    rows = pairs.select(*group, F.col("hour").alias("_to"), "known", p.alias("_from"), F.explode(hours).alias("hour"))
    share = (F.unix_timestamp("hour") - F.unix_timestamp("_from.hour")) / (F.unix_timestamp("_to") - F.unix_timestamp("_from.hour"))
    line = F.col("_from.known") + (F.col("known") - F.col("_from.known")) * share
    own = F.col("hour") == F.col("_to")
    return rows.select(*group, "hour", F.when(own, F.col("known")).otherwise(line).alias("value"), (~own).alias("filled"))


def spectral_power(df: DataFrame, index: str, value: str, periods: list[float]) -> DataFrame:
    """The power of the linearly detrended series at given periods, from sums over the rows; no transform of the whole series."""
    line = df.agg(F.regr_slope(value, index).alias("_b"), F.regr_intercept(value, index).alias("_a"), F.count(value).alias("_n"))
    rest = df.join(F.broadcast(line)).select(F.col(index).alias("t"), (F.col(value) - F.col("_a") - F.col("_b") * F.col(index)).alias("x"), "_n")
    sums = []
    for i, p in enumerate(periods):
        angle = F.col("t") * (2 * math.pi / p)
        sums += [F.sum(F.col("x") * F.cos(angle)).alias(f"c{i}"), F.sum(F.col("x") * F.sin(angle)).alias(f"s{i}")]
    row = rest.groupBy("_n").agg(*sums)
    made = [F.struct(F.lit(float(p)).alias("period"), (2 * (F.col(f"c{i}") ** 2 + F.col(f"s{i}") ** 2) / F.col("_n") ** 2).alias("power")) for i, p in enumerate(periods)]
    return row.select(F.explode(F.array(*made)).alias("r")).select("r.period", "r.power")


def segment_events(df: DataFrame, key: str, order: str, starts: Column, text: str) -> DataFrame:
    """Lines in order; one that starts an event opens a segment and the next ones join it. Lines before the first start are left out."""
    w = Window.partitionBy(key).orderBy(order)
    numbered = df.withColumn("segment", F.sum(starts.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))).filter("segment > 0")
    listed = numbered.groupBy(key, "segment").agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t")))).alias("_l"))
    return listed.select(key, F.col("segment").cast("long").alias("segment"), F.size("_l").cast("long").alias("n_lines"), F.array_join(F.transform("_l", lambda s: s["t"]), "\n").alias("event_text"))


def key_set_counts(df: DataFrame, column: str) -> DataFrame:
    """How often each set of map keys occurs."""
    return df.groupBy(F.array_join(F.array_sort(F.map_keys(column)), ",").alias("keys")).agg(F.count("*").alias("n"))
