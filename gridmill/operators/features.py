"""Feature transforms and feature sets (rows F01 to F17)."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmill.operators.guards import require_columns, require_unique

EASTERN = "America/New_York"
VARIABLES = ("actual_load", "load_forecast", "net_generation", "total_interchange")
LAGS = (1, 24, 168)


def long_to_wide(df: DataFrame, index: list[str], variable: str, value: str, variables: list[str], check: bool | str = True) -> DataFrame:
    """a column per variable; two rows for one (index, variable) are an error. The variables are given, which saves a job.

    The error comes at once (``check=True``, at the price of a job), or when the result
    is computed (``check="plan"``, in the same aggregation), or never.
    """
    if check is True:
        require_unique(df, *index, variable)
    if check == "plan":
        return df.groupBy(*index).agg(*[_only(F.col(variable) == v, F.col(value), f"two rows for {v}").alias(v) for v in variables])
    return df.groupBy(*index).pivot(variable, list(variables)).agg(F.first(value))


def _only(which: Column, value: Column, message: str) -> Column:
    """The value of the one row of a group that ``which`` holds for; an error if it holds for two."""
    return F.when(F.count_if(which) > 1, F.raise_error(F.lit(message)).cast("double")).otherwise(F.first(F.when(which, value), ignorenulls=True))


def expand_dimensions(df: DataFrame, column: str, keys: list[str], prefix: str = "", drop: bool = True) -> DataFrame:
    """map keys as columns; a name that is there already is an error."""
    names = [prefix + k for k in keys]
    clash = set(names) & set(df.columns)
    if clash:
        raise ValueError(f"columns already there: {', '.join(sorted(clash))}")
    out = df.select("*", *[F.col(column).getItem(k).alias(n) for k, n in zip(keys, names)])
    return out.drop(column) if drop else out


def add_calendar(df: DataFrame, time: str, timezone: str = "UTC") -> DataFrame:
    """hour, day_of_week (Monday 0), day_name, day_type, month, is_weekend, in UTC unless another zone is asked for."""
    t = F.from_utc_timestamp(time, timezone)
    weekend = F.weekday(t) >= 5
    return df.withColumns({
        "hour": F.hour(t), "day_of_week": F.weekday(t), "day_name": F.date_format(t, "EEEE"),
        "day_type": F.when(weekend, "weekend").otherwise("weekday"), "month": F.month(t), "is_weekend": weekend.cast("int"),
    })


def federal_holidays(first_year: int, last_year: int) -> list[date]:
    """Observed US federal holidays: fixed dates move from Saturday to Friday and from Sunday to Monday, others are nth weekdays."""

    def nth(year: int, month: int, weekday: int, n: int) -> date:
        if n < 0:
            end = date(year + month // 12, month % 12 + 1, 1) - timedelta(days=1)
            return end - timedelta(days=(end.weekday() - weekday) % 7)
        start = date(year, month, 1)
        return start + timedelta(days=(weekday - start.weekday()) % 7 + 7 * (n - 1))

    found = set()
    for y in range(first_year - 1, last_year + 2):
        fixed = [date(y, 1, 1), date(y, 7, 4), date(y, 11, 11), date(y, 12, 25)] + ([date(y, 6, 19)] if y >= 2021 else [])
        found |= {d + timedelta(days={5: -1, 6: 1}.get(d.weekday(), 0)) for d in fixed}
        found |= {nth(y, 1, 0, 3), nth(y, 2, 0, 3), nth(y, 5, 0, -1), nth(y, 9, 0, 1), nth(y, 10, 0, 2), nth(y, 11, 3, 4)}
    return sorted(d for d in found if first_year <= d.year <= last_year)


def add_holiday(df: DataFrame, time: str, timezone: str = EASTERN, years: tuple[int, int] = (1970, 2070)) -> DataFrame:
    """is_holiday, 1 on observed federal holidays by the local date. The holidays are a rule-made list of fixed size, so they stand in the expression."""
    days = F.array(*[F.lit(d) for d in federal_holidays(*years)])
    local = F.to_date(F.from_utc_timestamp(time, timezone))
    return df.withColumn("is_holiday", F.coalesce(F.array_contains(days, local), F.lit(False)).cast("int"))


def local_time(time: str | Column, timezone: str = EASTERN) -> Column:
    """the wall clock of the zone, as a timestamp without zone."""
    return F.from_utc_timestamp(time, timezone).cast("timestamp_ntz")


#: Rows of a series that one task orders at a time, where a long series is cut.
CHUNK = 50_000


def ranked(df: DataFrame, group: list[str], time: str, rank: str = "_rank") -> DataFrame:
    """The rows with their place in their group's order of time, from 0, without putting a group into one task.

    Rows are numbered within a group's month; the months' counts, a small table, are
    summed up to what each month's numbers start from. Rows of one time are in any order.
    """
    monthly = df.withColumn("_month", F.date_trunc("month", F.col(time)))
    keys = [*group, "_month"]
    within = monthly.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(time)) - 1)
    counts = monthly.groupBy(*keys).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*[F.col(k).alias(f"_s_{k}") for k in keys], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    on = [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys]
    return within.join(starts, on).withColumn(rank, F.col(rank) + F.col("_start")).select(*df.columns, rank)


def _overlapping(df: DataFrame, group: list[str], time: str, reach: int, chunk: int) -> tuple[DataFrame, Window]:
    """The rows by chunks of each group's order, each chunk with the last ``reach`` rows of the one before it (``_own`` is false on those); and the window over a chunk."""
    chunk = max(chunk, reach)
    number = F.floor(F.col("_rank") / chunk)
    own = F.struct(number.alias("at"), F.lit(True).alias("own"))
    ahead = F.struct((number + 1).alias("at"), F.lit(False).alias("own"))
    placed = ranked(df, group, time).withColumn("_c", F.explode(F.when(F.col("_rank") % chunk >= chunk - reach, F.array(own, ahead)).otherwise(F.array(own))))
    return placed.select("*", F.col("_c.at").alias("_at"), F.col("_c.own").alias("_own")).drop("_c"), Window.partitionBy(*group, "_at").orderBy("_rank")


def add_lags(df: DataFrame, column: str, lags: list[int], group: list[str], time: str, chunk: int | None = None) -> DataFrame:
    """earlier rows' values per group. A lag counts rows; one below 1 is an error.

    With ``chunk``, long groups are ordered that many rows at a time, with the rows that
    the lags reach back to carried over, so no task holds a whole group.
    """
    if any(n < 1 for n in lags):
        raise ValueError("lags must be positive")
    require_columns(df, column, time, *group)
    if chunk is None:
        rows, w = df, Window.partitionBy(*group).orderBy(time)
    else:
        rows, w = _overlapping(df, group, time, max(lags), chunk)
    made = rows.withColumns({f"{column}_lag_{n}": F.lag(column, n).over(w) for n in lags})
    return made if chunk is None else made.filter("_own").drop("_rank", "_at", "_own")


def add_rolling_means(df: DataFrame, columns: list[str], windows: list[int], group: list[str], time: str, chunk: int | None = None) -> DataFrame:
    """the mean of the ``w`` rows before, null unless all are there and not null. ``chunk`` as for lags."""
    rows, base = (df, Window.partitionBy(*group).orderBy(time)) if chunk is None else _overlapping(df, group, time, max(windows), chunk)
    made = {}
    for c in columns:
        for n in windows:
            w = base.rowsBetween(-n, -1)
            made[f"{c}_mean_{n}"] = F.when(F.count(c).over(w) == n, F.avg(c).over(w))
    out = rows.withColumns(made)
    return out if chunk is None else out.filter("_own").drop("_rank", "_at", "_own")


def mean_vectors(df: DataFrame, group: list[str], vector: str) -> DataFrame:
    """The element-wise mean of the vectors of each group; nulls are passed over, a group without any has an empty list. Vectors of a group have one length.

    One aggregation: sums of vectors combine before the shuffle, one vector a group and task.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    name = f"mean_{vector}"
    known = df.filter(F.col(vector).isNotNull()).withColumn("_v", array_to_vector(F.col(vector).cast("array<double>")))
    means = known.groupBy(*group).agg(vector_to_array(Summarizer.mean(F.col("_v"))).alias(name))
    without = df.groupBy(*group).agg(F.count(vector).alias("_n")).filter("_n = 0").select(*group, F.array().cast("array<double>").alias(name))
    return means.unionByName(without)


def hourly_text(df: DataFrame, time: str = "published_at", region: str = "region", key: str = "record_id", vector: str | None = None) -> DataFrame:
    """texts per hour and region, and their mean vector if a vector column is named; rows without time or region keep a group of their own."""
    hourly = df.withColumn("observed_at", F.date_trunc("hour", time)).withColumn("region", F.col(region))
    counts = hourly.groupBy("observed_at", "region").agg(F.count(key).alias("document_count"))
    if vector is None:
        return counts
    means = mean_vectors(hourly, ["observed_at", "region"], vector)
    both = counts.alias("c").join(means.alias("m"), [F.col(f"c.{k}").eqNullSafe(F.col(f"m.{k}")) for k in ("observed_at", "region")])
    return both.select("c.observed_at", "c.region", "document_count", f"mean_{vector}")


def hourly_severity(df: DataFrame, time: str, group: list[str], severe: float = 0.7) -> DataFrame:
    """size, mean, maximum and count of severe rows per hour; null keys are kept."""
    return df.groupBy(*group, F.date_trunc("hour", time).alias("observed_at")).agg(F.count("*").alias("document_count"), F.avg("severity_score").alias("severity_mean"), F.max("severity_score").alias("severity_max"), F.count_if(F.col("severity_score") >= severe).alias("severe_document_count"))


# Fixed severities of bulletin products, and fixed weights of words in bulletins and in news.
PRODUCT_SEVERITY = {"AFD": 0.10, "HWO": 0.30, "SPS": 0.40, "LSR": 0.55, "WSW": 0.70, "NPW": 0.75}
BULLETIN_TERMS = {"advisory": 0.15, "watch": 0.30, "warning": 0.50, "significant": 0.20, "severe": 0.30, "extreme": 0.40, "dangerous": 0.30, "life threatening": 0.50, "widespread": 0.20, "major": 0.25}
NEWS_TERMS = {"power outage": 0.40, "grid emergency": 0.50, "energy emergency": 0.50, "rolling blackout": 0.50, "load shedding": 0.50, "extreme heat": 0.35, "heat wave": 0.30, "winter storm": 0.30, "extreme cold": 0.35, "polar vortex": 0.35, "natural gas shortage": 0.40, "pipeline outage": 0.40, "generation outage": 0.40}


def term_score(text: Column, terms: dict[str, float], most: float) -> Column:
    """The weights of the terms that occur, added in the order given and capped."""
    low, score = F.lower(F.coalesce(text, F.lit(""))), F.lit(0.0)
    for term, weight in terms.items():
        score = score + F.when(low.contains(term), F.lit(weight)).otherwise(0.0)
    return F.least(score, F.lit(most))


def _unit(c: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(c, F.lit(1.0)))


def bulletin_severity(product: Column, text: Column, terms: dict[str, float] = BULLETIN_TERMS, products: dict[str, float] = PRODUCT_SEVERITY) -> Column:
    """the product's severity plus that of its words (0.5 at most), within 0 and 1."""
    base = F.lit(0.0)
    for name, weight in products.items():
        base = F.when(F.upper(product) == name, F.lit(weight)).otherwise(base)
    return _unit(base + term_score(text, terms, 0.5))


def news_severity(text: Column, tone: Column, terms: dict[str, float] = NEWS_TERMS) -> Column:
    """the words' score (0.8 at most), lowered to three quarters where the tone is not negative; an unreadable tone counts as 0."""
    t = F.coalesce(tone.try_cast("double"), F.lit(0.0))
    return _unit(term_score(text, terms, 0.8) * (F.lit(0.75) + F.lit(0.25) * (F.greatest(F.lit(0.0), F.least(-t, F.lit(10.0))) / 10)))


def region_hourly(obs: DataFrame, check: bool | str = True, chunk: int | None = CHUNK) -> DataFrame:
    """hourly features per region from long observations: variables as columns, local time, load lags, calendar and holiday. ``chunk`` as for lags."""
    wide = long_to_wide(obs.select("observed_at", "region", "variable", "value"), ["observed_at", "region"], "variable", "value", list(VARIABLES), check)
    wide = wide.withColumn("observed_at_local", local_time("observed_at"))
    return add_holiday(add_calendar(add_lags(wide, "actual_load", list(LAGS), ["region"], "observed_at", chunk), "observed_at"), "observed_at")


def local_midnight(time: Column, timezone: str = EASTERN) -> Column:
    """The UTC instant at which the row's local day begins."""
    return F.to_utc_timestamp(F.date_trunc("day", F.from_utc_timestamp(time, timezone)), timezone)


def region_daily(hourly: DataFrame, timezone: str = EASTERN) -> DataFrame:
    """mean, least and greatest load and summed generation per local day; rows without a region are left out."""
    day = local_midnight(F.col("observed_at"), timezone)
    return hourly.filter("region is not null and observed_at is not null").groupBy(day.alias("observed_at"), "region").agg(F.avg("actual_load").alias("load_mean"), F.min("actual_load").alias("load_min"), F.max("actual_load").alias("load_max"), F.coalesce(F.sum("net_generation"), F.lit(0.0)).alias("generation_sum"))


def interchange_totals(flows: DataFrame, own: str) -> DataFrame:
    """what the area imports, exports and their difference per time, in one pass over the flows."""
    into, out = F.col("to_region") == own, F.col("from_region") == own
    return flows.filter((into | out) & F.col("observed_at").isNotNull()).groupBy("observed_at").agg(F.sum(F.when(into, F.col("value"))).alias("imports"), F.sum(F.when(out, F.col("value"))).alias("exports")).select("observed_at", F.lit(own).alias("region"), "imports", "exports", (F.coalesce("imports", F.lit(0.0)) - F.coalesce("exports", F.lit(0.0))).alias("net_imports"), local_time("observed_at").alias("observed_at_local"))


def interchange_totals_by_join(flows: DataFrame, own: str) -> DataFrame:
    """F14 as two filtered sums and a full outer join; equal to the one-pass form."""
    total = lambda column, name: flows.filter((F.col(column) == own) & F.col("observed_at").isNotNull()).groupBy("observed_at").agg(F.sum("value").alias(name))
    both = total("to_region", "imports").join(total("from_region", "exports"), "observed_at", "full_outer")
    return both.select("observed_at", F.lit(own).alias("region"), "imports", "exports", (F.coalesce("imports", F.lit(0.0)) - F.coalesce("exports", F.lit(0.0))).alias("net_imports"), local_time("observed_at").alias("observed_at_local"))


def _add_lags_of(df: DataFrame, columns: list[str], lag: int, chunk: int | None) -> DataFrame:
    """One lag of several columns per region, in one pass over the order of time."""
    both = add_lags(df.withColumn("_both", F.struct(*columns)), "_both", [lag], ["region"], "observed_at", chunk)
    return both.withColumns({f"{c}_lag_{lag}": F.col(f"_both_lag_{lag}.{c}") for c in columns}).drop("_both", f"_both_lag_{lag}")


def interchange_hourly(flows: DataFrame, own: str, chunk: int | None = CHUNK) -> DataFrame:
    """F14 with each total's value 24 rows before. ``chunk`` as for lags: the area is one series, so its rows are ordered by chunks."""
    return _add_lags_of(interchange_totals(flows, own), ["imports", "exports"], 24, chunk)


def interchange_daily(totals: DataFrame, timezone: str = EASTERN, chunk: int | None = CHUNK) -> DataFrame:
    """F16: local-day means of the totals and those of the day before. ``chunk`` as for lags."""
    day = local_midnight(F.col("observed_at"), timezone)
    daily = totals.filter("region is not null and observed_at is not null").groupBy(day.alias("observed_at"), "region").agg(F.avg("imports").alias("imports_mean"), F.avg("exports").alias("exports_mean"))
    return _add_lags_of(daily, ["imports_mean", "exports_mean"], 1, chunk)


def build_feature_set(read, build, write, enabled: bool = True) -> dict:
    """A feature or dataset job: skipped if disabled or without input, empty if nothing comes out, else written; with the row counts."""
    if not enabled:
        return {"status": "skipped", "reason": "disabled", "rows": 0}
    df = read()
    if df is None or df.isEmpty():
        return {"status": "skipped", "reason": "no input", "rows": 0}
    made = build(df)
    if made.isEmpty():
        return {"status": "empty", "rows": 0}
    write(made)
    return {"status": "success", "rows": made.count()}
