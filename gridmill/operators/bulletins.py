"""Weather bulletins: products, headers, times, sections and records (rows P20 to P26)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmill.functions.scalars import blank_to_null, let, literal_map, stable_hash

# Fixed fields of a bulletin's heading, in order: sequence number, data designator, station, day and time, product key.
HEADING = {"raw_id": r"\d{3}", "wmo": r"[A-Z]{4}\d{2}", "office": r"[A-Z]{4}", "issued_code": r"\d{6}", "pil": r"[A-Z]{6}"}
HEADER = r"\s+".join(f"({field})" for field in HEADING.values())

# Fixed US zone names.
ZONES = {"EST": "America/New_York", "EDT": "America/New_York", "CST": "America/Chicago", "CDT": "America/Chicago", "MST": "America/Denver", "MDT": "America/Denver", "PST": "America/Los_Angeles", "PDT": "America/Los_Angeles"}

# Fixed load zones of forecast offices.
LOAD_ZONES = {
    "MPX": 1, "DLH": 1, "FGF": 1, "ABR": 1, "FSD": 1, "BIS": 1,
    "MKX": 2, "GRB": 2, "ARX": 2, "MQT": 2,
    "DMX": 3, "DVN": 3,
    "ILX": 4,
    "LSX": 5, "SGF": 5, "EAX": 5,
    "IND": 6, "IWX": 6, "LMK": 6, "PAH": 6,
    "DTX": 7, "GRR": 7, "APX": 7,
    "LZK": 8, "MEG": 8,
    "LIX": 9, "LCH": 9, "SHV": 9, "JAN": 9,
    "BMX": 10, "MOB": 10,
}

# Fixed words of a stamp, in any case, and of the lines that stand before a product's stamp.
MONTHS = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()
WEEKDAYS = "Mon Tue Wed Thu Fri Sat Sun".split()
HALVES = ("AM", "PM")
OFFICE_LINE, ISSUER_LINE, ISSUED = "national weather service", "issued by national weather service", "issued at "

MARK = "\x01"

#: Before a line that starts or ends a section: a dot and a capital or digit, ``&&``, ``$$``.
SECTION_EDGE = r"(?m)^(?=\.[A-Z0-9]|&&|\$\$)"
#: A section's first words, each of capitals, digits, slashes and dashes, and what may stand between them and the three dots.
TITLE_WORD = r"[A-Z0-9][A-Z0-9/-]*"
ROUND, SLASHED = r"\s+\(((?:(?!\)\.\.\.).)*)\)", r"\s+/((?:(?!/\.\.\.).)*)/"


def unix_newlines(c: Column) -> Column:
    return F.regexp_replace(c, r"\r\n?", "\n")


def split_products(c: Column) -> Column:
    """P20: the products of a response, one from each header to the next; what stands before the first header is left out."""
    marked = F.regexp_replace(unix_newlines(c), HEADER, MARK + "$0")
    return F.transform(F.slice(F.split(marked, MARK), F.lit(2), F.greatest(F.size(F.split(marked, MARK)) - 1, F.lit(0))), lambda x: F.trim(x, F.lit(" \t\r\n")))


def parse_header(c: Column) -> Column:
    """The fields of the first header; all null where there is none."""
    part = lambda i: F.nullif(F.regexp_extract(c, HEADER, i), F.lit(""))
    fields = {name: part(i) for i, name in enumerate(HEADING, 1)}
    line = F.when(fields["wmo"].isNotNull(), F.concat_ws(" ", fields["wmo"], fields["office"], fields["issued_code"]))
    return F.struct(*[value.alias(name) for name, value in fields.items()], line.alias("wmo_header"))


def _listed(c: Column, words) -> Column:
    """The place of a word, in any case, in a list; 0 where it is not there."""
    return F.array_position(F.array(*[F.lit(w.upper()) for w in words]), F.upper(c)).cast("int")


def _tokens(line: Column) -> Column:
    """The words of a stamp, without the ``Issued at`` before them."""
    return F.split(F.rtrim(F.regexp_replace(line, rf"(?i)^{ISSUED.strip()}\s+", ""), F.lit(" \t")), r"\s+")


def is_stamp_line(line: Column) -> Column:
    """Whether a line is an issuance time: up to four digits of the clock, AM or PM, a zone, a weekday, a month, a day and a year, in any case, nothing before or after them."""
    digits = lambda c, least, most: c.rlike(f"^[0-9]{{{least},{most}}}$")

    def holds(t: Column) -> Column:
        at = lambda i: F.get(t, F.lit(i))
        return F.coalesce((F.size(t) == 7) & digits(at(0), 1, 4) & (_listed(at(1), HALVES) > 0) & at(2).rlike("^[A-Za-z]{2,5}$") & (_listed(at(3), WEEKDAYS) > 0) & (_listed(at(4), MONTHS) > 0) & digits(at(5), 1, 2) & digits(at(6), 4, 4), F.lit(False))

    # Most lines are told by their first character.
    return F.when(line.rlike("^[0-9Ii]"), let(_tokens(line), holds)).otherwise(False)


def issued_text(c: Column) -> Column:
    """The stamp on the line below the office's line (and the line of who issued it for the office, if there is one); null where there is none. A time elsewhere in the text is not the product's."""

    def stamp_after(lines: Column) -> Column:
        at = lambda i: F.coalesce(F.get(lines, i), F.lit(""))
        below = lambda i: F.when(F.lower(at(i + 1)).startswith(ISSUER_LINE), at(i + 2)).otherwise(at(i + 1))
        below_office = F.transform(lines, lambda line, i: F.when(F.lower(line).startswith(OFFICE_LINE), below(i)))
        return F.get(F.filter(below_office, lambda line: F.coalesce(is_stamp_line(line), F.lit(False))), F.lit(0))

    return F.trim(let(F.split(unix_newlines(c), "\n"), stamp_after))


def local_text_to_utc(c: Column) -> Column:
    """The UTC time of ``hmm AM/PM TZ Dow Mon d yyyy`` or ``HHMM TZ Dow Mon d yyyy``, words in any case; what is no such time is null.

    The weekday must be one, whole or short of its last letter, but is not held against the date.
    """

    def read(t: Column) -> Column:
        half = F.coalesce(_listed(F.get(t, F.lit(1)), HALVES), F.lit(0))
        at = lambda i: F.coalesce(F.get(t, F.when(half > 0, i + 1).otherwise(i)), F.lit(""))
        clock = F.lpad(F.get(t, F.lit(0)), 4, "0")
        hour, minute = F.substring(clock, 1, 2).cast("int"), F.substring(clock, 3, 2).cast("int")
        hour24 = F.when(half == 0, F.when(hour <= 23, hour)).when((hour >= 1) & (hour <= 12), hour % 12 + F.when(half == 2, 12).otherwise(0))
        month = F.nullif(_listed(at(3), MONTHS), F.lit(0))
        weekday = F.greatest(_listed(at(2), WEEKDAYS), _listed(at(2), [d[:2] for d in WEEKDAYS]))
        zone = literal_map(ZONES)[F.upper(at(1))]
        text = F.format_string("%04d-%02d-%02d %02d:%02d:00", at(5).cast("int"), month, at(4).cast("int"), hour24, minute)
        good = month.isNotNull() & hour24.isNotNull() & (minute <= 59) & (weekday > 0) & zone.isNotNull()
        return F.when(good, F.to_utc_timestamp(F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")), F.coalesce(zone, F.lit("UTC"))))

    def whole(t: Column) -> Column:
        half = F.coalesce(_listed(F.get(t, F.lit(1)), HALVES), F.lit(0)) > 0
        n = F.size(t)
        shape = (n == F.when(half, 7).otherwise(6)) & F.get(t, F.lit(0)).rlike("^[0-9]{1,4}$") & F.get(t, n - 2).rlike("^[0-9]{1,2}$") & F.get(t, n - 1).rlike("^[0-9]{4}$")
        return F.when(F.coalesce(shape, F.lit(False)), read(t))

    return let(_tokens(F.trim(c)), whole)


def section_name(c: Column) -> Column:
    return F.regexp_replace(F.upper(F.trim(F.regexp_replace(c, r"\s+", " "))), r"^[A-Z]{3}\s+(?=WATCHES/WARNINGS/ADVISORIES$)", "")


def section_head(chunk: Column) -> Column:
    """Title, detail in round brackets or slashes, and the length of the head of a chunk that starts a section; a title of '' where it does not."""
    title = rf"^\.({TITLE_WORD}(?: {TITLE_WORD})*)"
    plain, round_, slashed = (rf"(?s){title}{between}\.\.\." for between in ("", ROUND, SLASHED))
    found = [F.regexp_extract(chunk, pattern, 0) for pattern in (plain, round_, slashed)]
    head = F.coalesce(*[F.nullif(f, F.lit("")) for f in found], F.lit(""))
    detail = F.when(found[0] != "", F.lit("")).otherwise(F.concat(F.regexp_extract(chunk, round_, 2), F.regexp_extract(chunk, slashed, 2)))
    return F.struct(F.regexp_extract(head, rf"(?s){title}", 1).alias("name"), detail.alias("detail"), F.length(head).alias("size"))


def parse_sections(df: DataFrame, key: str, text: str) -> DataFrame:
    """A row per section: name, detail, text without its issuance line, that line and its time. Of sections with one name the last counts.

    The text is cut before every line that can start or end a section; a piece with a
    title and three dots is a section, all others are left out.
    """
    pieces = df.select(key, F.posexplode(F.split(unix_newlines(F.col(text)), SECTION_EDGE)).alias("at", "piece"))
    headed = pieces.filter(F.col("piece").startswith(".")).withColumn("head", section_head(F.col("piece"))).filter("head.size > 0")
    rows = headed.withColumn("content", F.substring(F.col("piece"), F.col("head.size") + 1, F.length("piece")))
    lines = F.split("content", "\n")
    issued = lambda line: F.lower(line).startswith(ISSUED) & is_stamp_line(line)
    stamp = F.trim(F.get(F.filter(lines, issued), F.lit(0)))
    content = F.regexp_replace(F.array_join(F.transform(lines, lambda line: F.when(issued(line), "").otherwise(line)), "\n"), r"\n{3,}", "\n\n")
    made = rows.select(key, "at", section_name(F.col("head.name")).alias("section"), blank_to_null(F.regexp_replace("head.detail", r"\s+", " ")).alias("detail"), F.trim(content, F.lit(" \t\r\n")).alias("section_text"), stamp.alias("issued_at_text"), local_text_to_utc(stamp).alias("published_at"))
    last = made.groupBy(key, "section").agg(F.max_by(F.struct("detail", "section_text", "issued_at_text", "published_at"), "at").alias("r"))
    return last.select(key, "section", "r.*")


def bronze_bulletins(df: DataFrame, pil: str, response: str, source: str = "iem_afos") -> DataFrame:
    """Landed responses as product rows with header, time and id; the requested key stands in for a missing one. Products without a readable time are marked as rejects."""
    products = df.filter(F.trim(response) != "").filter(~F.ltrim(response).startswith("ERROR:")).select(F.col(pil).alias("requested"), F.posexplode(split_products(F.col(response))).alias("product_no", "raw_text"))
    read = products.withColumn("header", parse_header(F.col("raw_text"))).withColumn("pil", F.coalesce("header.pil", "requested")).withColumn("issued_at_text", issued_text(F.col("raw_text")))
    timed = read.withColumn("published_at", local_text_to_utc(F.col("issued_at_text")))
    stamp = F.date_format("published_at", "yyyy-MM-dd HH:mm:ssxxx")
    identity = stable_hash(source=F.lit(source), pil=F.col("pil"), office=F.col("header.office"), issued_code=F.col("header.issued_code"), raw_id=F.col("header.raw_id"), published_at=stamp)
    return timed.select(F.lit(source).alias("source"), F.concat(F.lit("iem::"), identity).alias("record_id"), "published_at", "pil", "header", "issued_at_text", "raw_text", F.col("published_at").isNull().alias("rejected"))


def load_zones(spark: SparkSession) -> DataFrame:
    """Offices and their load zones, a table of fixed size."""
    return spark.createDataFrame(list(LOAD_ZONES.items()), "office string, lrz int")


def standard_bulletins(bronze: DataFrame) -> DataFrame:
    """Text records: office, title, categories, metadata without nulls, region, and the zone of the office (null for offices outside)."""
    office = F.coalesce("header.office", F.when(F.length("pil") >= 6, F.substring("pil", 4, 100)))
    product = F.substring("pil", 1, 3)
    rows = bronze.filter("not rejected").withColumn("office", office).filter("office is not null").withColumn("region", F.right("office", F.lit(3)))
    entries = {"product_type": product, "office": F.col("office"), "pil": F.col("pil"), "wmo": F.col("header.wmo"), "wmo_header": F.col("header.wmo_header"), "issued_code": F.col("header.issued_code"), "raw_id": F.col("header.raw_id")}
    metadata = F.map_filter(F.create_map(*[x for k, v in entries.items() for x in (F.lit(k), v)]), lambda k, v: v.isNotNull())
    zones = load_zones(bronze.sparkSession).withColumnRenamed("office", "region")
    made = rows.select("record_id", "source", F.concat_ws(" | ", product, "office", blank_to_null(F.col("issued_at_text"))).alias("title"), F.trim("raw_text").alias("text"), "published_at", "region", F.array(*[F.lit(x) for x in ("weather", "nws", "iem", "afos")], F.lower(product)).alias("categories"), metadata.alias("metadata"))
    return made.join(F.broadcast(zones), "region", "left").withColumn("dimensions", F.create_map(F.lit("lrz"), F.col("lrz").cast("string"))).drop("lrz")
