"""From landed payloads to typed records (rows I02, I04, I14, P01, P07, P08, P18, P27 to P29, P31)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmill.functions import scalars as S
from gridmill.functions.text import html_to_text


def envelope(df: DataFrame, source: str, record_id: Column, published_at: Column, retrieved_at: Column) -> DataFrame:
    """Any rows as landed records; the payload is the row as JSON."""
    return df.select(F.lit(source).alias("source"), record_id.alias("record_id"), published_at.alias("published_at"), retrieved_at.alias("retrieved_at"), F.to_json(F.struct(*df.columns)).alias("raw"))


def payload(bronze: DataFrame, schema: str) -> DataFrame:
    """Landed records with the payload parsed into ``p``; one that cannot be read is null."""
    return bronze.withColumn("p", F.from_json("raw", schema))


def missing_ids(bronze: DataFrame, key: str = "record_id") -> DataFrame:
    """Rows, and rows without an id."""
    return bronze.agg(F.count("*").alias("n"), F.count_if(F.coalesce(F.trim(key), F.lit("")) == "").alias("n_missing"))


def require_ids(bronze: DataFrame, key: str = "record_id", source: str | None = None) -> DataFrame:
    """An error if any row has no id or another source."""
    wrong = missing_ids(bronze, key).first()["n_missing"]
    if wrong or (source is not None and not bronze.filter(~F.col("source").eqNullSafe(source)).isEmpty()):
        raise ValueError("rows without an id or of another source")
    return bronze


def migrated(df: DataFrame, record_id: Column) -> tuple[DataFrame, DataFrame]:
    """Old rows under the envelope, and the index of their ids: the payload is ``raw`` if there is one, else the whole row; ids are made anew, and of rows with one id the first payload is kept."""
    raw = F.coalesce(F.col("raw"), F.to_json(F.struct(*[c for c in df.columns if c != "raw"]))) if "raw" in df.columns else F.to_json(F.struct(*df.columns))
    made = df.select(record_id.alias("record_id"), raw.alias("raw")).groupBy("record_id").agg(F.min("raw").alias("raw"))
    return made, made.select("record_id")


def region_observations(rows: DataFrame, source: str = "eia930_region") -> tuple[DataFrame, DataFrame]:
    """Numeric records from (period, respondent, type, value, value-units) rows, and the rejects: an unknown code, an unreadable hour or value."""
    code = F.col("type")
    variable = F.get(F.transform(F.array(code), lambda c: S.literal_map(S.MEASURES)[c]), F.lit(0))
    region = F.upper("respondent")
    made = rows.select("*", variable.alias("_variable"), S.parse_hour_period(F.col("period")).alias("_at"), S.parse_number(F.col("value")).alias("_value"))
    good = F.col("_variable").isNotNull() & F.col("_at").isNotNull() & F.col("_value").isNotNull() & region.isNotNull()
    record_id = F.concat(F.lit(f"{source}:"), F.col("respondent"), F.lit(":"), code, F.lit(":"), F.col("period"))
    kept = made.filter(good).select(record_id.alias("record_id"), F.lit(source).alias("source"), F.col("_at").alias("observed_at"), F.col("_variable").alias("variable"), F.col("_value").alias("value"), region.alias("region"), S.normalize_unit(F.col("value-units")).alias("unit"), F.create_map(F.lit("respondent"), region, F.lit("measurement_type"), code).alias("dimensions"))
    return kept, made.filter(~F.coalesce(good, F.lit(False))).select(*rows.columns)


def interchange_observations(rows: DataFrame, own: str, source: str = "eia930_interchange") -> DataFrame:
    """Numeric records of flows, with the names of both sides as dimensions; unreadable rows are left out."""
    a, b = F.upper("fromba"), F.upper("toba")
    record_id = F.concat(F.lit(f"{source}:"), a, F.lit(":"), b, F.lit(":"), F.col("period"))
    made = rows.select(record_id.alias("record_id"), F.lit(source).alias("source"), S.parse_hour_period(F.col("period")).alias("observed_at"), F.lit("interchange").alias("variable"), S.parse_number(F.col("value")).alias("value"), F.lit(own).alias("region"), S.normalize_unit(F.col("value-units")).alias("unit"), F.create_map(F.lit("from_region"), F.col("fromba-name"), F.lit("to_region"), F.col("toba-name")).alias("dimensions"), a.alias("from_region"), b.alias("to_region"))
    return made.filter("observed_at is not null and value is not null")


def news_graph_records(gkg: DataFrame, source: str = "gdelt") -> DataFrame:
    """Text records from knowledge-graph rows; rows without an id or a readable time are left out. The region is the first location key."""
    precise = S.extract_tag(F.col("Extras"), "PAGE_PRECISEPUBTIMESTAMP")
    stamp = F.col("GDELT_TIMESTAMP") if "GDELT_TIMESTAMP" in gkg.columns else F.lit(None).cast("string")
    places = S.parse_locations(F.col("Locations"))
    exact = precise != ""
    metadata = F.struct(F.col("SourceCommonName").alias("source_common_name"), F.when(exact, "page_metadata").otherwise("gdelt").alias("time_source"), F.when(exact, "second").otherwise("15min").alias("time_precision"), S.split_values(F.col("Organizations")).alias("organizations"), S.split_values(F.col("Persons")).alias("persons"), places.alias("locations"), F.col("Tone").alias("tone"))
    rows = gkg.select(S.blank_to_null(F.col("GKGRECORDID")).alias("_id"), S.coalesce_timestamp(precise, stamp, F.col("DATE")).alias("published_at"), S.extract_tag(F.col("Extras"), "PAGE_TITLE").alias("title"), F.col("DocumentIdentifier").alias("url"), F.get(places, F.lit(0)).alias("region"), S.split_values(F.col("Themes")).alias("categories"), metadata.alias("metadata"))
    return rows.filter("_id is not null and published_at is not null").select(F.concat(F.lit(f"{source}::"), "_id").alias("record_id"), F.lit(source).alias("source"), "title", F.lit("").alias("text"), "published_at", "url", "region", "categories", "metadata")


def text_map(**entries: Column) -> Column:
    """A map of texts, keys in the order given, nulls kept."""
    return F.create_map(*[x for k, v in entries.items() for x in (F.lit(k), v.cast("string"))])


def field(df: DataFrame, struct: str, name: str) -> Column:
    """A field of a struct column, null where the schema has none."""
    names = df.schema[struct].dataType.names if struct in df.columns else []
    return F.col(f"`{struct}`.`{name}`") if name in names else F.lit(None).cast("string")


def notices(df: DataFrame, base_url: str = "https://www.misoenergy.org", source: str = "miso_notifications", region: str = "MISO") -> DataFrame:
    """Records from grouped notices (topic, notifications): one a notice, its id a hash of subject, publish date and link; the time may be null."""
    n = df.select("topic", F.explode("notifications").alias("n"))
    has = lambda name: field(n, "n", name)
    identity = S.stable_hash(subject=has("subject"), publish_date=has("publishDate"), permanent_link=has("permanentLinkUrl"))
    body = F.trim(F.regexp_replace(html_to_text(F.coalesce(has("body"), F.lit(""))), " {2,}", " "))
    return n.select(
        F.concat(F.lit("miso:"), identity).alias("record_id"), F.lit(source).alias("source"), has("subject").alias("title"), body.alias("text"), S.parse_utc(has("publishDateUnformatted")).alias("published_at"),
        S.absolute_url(has("permanentLinkUrl"), base_url).alias("url"), F.lit(region).alias("region"), F.array_compact(F.array(F.lit("market_notice"), F.nullif(F.col("topic"), F.lit("")))).alias("categories"),
        text_map(topic=F.col("topic"), notification_id=has("id"), publish_date=has("publishDate")).alias("metadata"),
    )


def articles(df: DataFrame, source: str = "newsapi", query: str | None = None, language: str | None = None, sort_by: str | None = None) -> DataFrame:
    """Records from articles (url, publishedAt, title, description, content, and author and source if there); those without URL or date are left out. The id is a hash of the trimmed URL."""
    own = lambda name: F.col(name) if name in df.columns else F.lit(None).cast("string")
    made = df.withColumn("_url", S.blank_to_null(F.col("url"))).withColumn("_at", S.parse_utc(F.col("publishedAt"))).filter("_url is not null and _at is not null")
    metadata = text_map(news_source=field(df, "source", "name"), news_source_id=field(df, "source", "id"), author=own("author"), query=F.lit(query), language=F.lit(language), sort_by=F.lit(sort_by))
    return made.select(
        F.concat(F.lit(f"{source}:"), S.stable_hash(url=F.col("_url"))).alias("record_id"), F.lit(source).alias("source"), "title", S.join_nonblank(own("title"), own("description"), own("content")).alias("text"),
        F.col("_at").alias("published_at"), "url", F.lit(None).cast("string").alias("region"), F.array(F.lit("news")).alias("categories"), metadata.alias("metadata"),
    )


# Fixed keys of an alert's metadata beside the area asked for, and the properties that they come from.
ALERT_KEYS = {
    "event": "event", "severity": "severity", "urgency": "urgency", "certainty": "certainty", "status": "status", "message_type": "messageType", "category": "category", "response": "response",
    "sender": "sender", "sender_name": "senderName", "area_desc": "areaDesc", "geocode": "geocode", "affected_zones": "affectedZones", "effective_at": "effective", "expires_at": "expires", "ends_at": "ends",
}


def alerts(df: DataFrame, source: str = "weather_alerts") -> DataFrame:
    """Records from alert features (``query_area``, ``properties`` struct, ``id``); one without id or a readable ``sent`` is left out. The id and the URL fall back from property to feature; nested properties stand in the metadata as JSON."""

    def p(name: str) -> Column:
        c = field(df, "properties", name)
        kind = df.schema["properties"].dataType[name].dataType.simpleString() if name in df.schema["properties"].dataType.names else "string"
        return F.to_json(c) if kind.startswith(("struct", "array", "map")) else c

    own = lambda name: F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")
    first = lambda *cs: F.coalesce(*[F.nullif(c, F.lit("")) for c in cs])
    parts = [F.when(F.trim(p(c)) != "", p(c)) for c in ("headline", "description", "instruction")]
    made = df.select(
        first(p("id"), own("id")).alias("record_id"), F.lit(source).alias("source"), p("headline").alias("title"), F.concat_ws("\n\n", *parts).alias("text"), S.parse_utc(p("sent")).alias("published_at"),
        first(p("@id"), own("@id"), own("id")).alias("url"), own("query_area").alias("region"), F.array_compact(F.array(*[F.nullif(p(c), F.lit("")) for c in ("event", "severity", "urgency")])).alias("categories"),
        text_map(query_area=own("query_area"), **{k: p(v) for k, v in ALERT_KEYS.items()}).alias("metadata"),
    )
    return made.filter("record_id is not null and published_at is not null")


def alert_areas(areas: list[str] | str) -> list[str]:
    """The areas to ask for: trimmed, in upper case, blanks left out."""
    return [a.strip().upper() for a in ([areas] if isinstance(areas, str) else areas) if a.strip()]


def relevant_news(gkg: DataFrame, themes: list[str], organizations: list[str], locations: list[str], least: int = 1) -> DataFrame:
    """Rows that match (theme and location) or organisation, with their flags."""
    flagged = gkg.withColumns({
        "theme_match_count": S.overlap_count(S.parse_themes(F.col("Themes")), themes),
        "organization_match": S.any_match(S.parse_orgs(F.col("V2Organizations")), organizations),
        "location_match": S.any_match(S.parse_locations(F.col("V2Locations")), locations),
    }).withColumn("theme_match", F.col("theme_match_count") >= least)
    return flagged.filter(S.relevant(F.col("theme_match"), F.col("location_match"), F.col("organization_match")))


def standardize_counts(good: DataFrame, rejects: DataFrame) -> DataFrame:
    """How many rows were read, standardised and rejected."""
    return good.agg(F.count("*").alias("n_good")).join(rejects.agg(F.count("*").alias("n_rejected"))).select((F.col("n_good") + F.col("n_rejected")).alias("n_read"), "n_good", "n_rejected")
