"""Column functions for parsing and normalising raw values (rows P02 to P17, P30). All are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO = "yyyy-MM-dd'T'HH:mm:ss"

# Fixed unit names, by lower-case spelling.
UNITS = {"megawatthours": "MWh", "megawatt hours": "MWh", "mwh": "MWh", "megawatts": "MW", "megawatt": "MW", "mw": "MW"}
# Fixed measurement codes.
MEASURES = {"D": "actual_load", "DF": "load_forecast", "NG": "net_generation", "TI": "total_interchange"}


def let(value: Column, then) -> Column:
    """``then`` of a value that is computed once, where a column named in several places would be computed in each."""
    return F.element_at(F.transform(F.array(value), then), 1)


def literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def blank_to_null(c: Column) -> Column:
    """Null for null, empty or blank text, else the text without white space at its ends."""
    return F.nullif(F.trim(c, F.lit(" \t\n\r\x0b\x0c")), F.lit(""))


def parse_utc(c: Column) -> Column:
    """A timestamp from ISO text or a date; a ``Z`` or an offset is honoured, no zone means UTC; what cannot be read is null."""
    return F.try_to_timestamp(F.trim(c))


def format_utc(c: Column) -> Column:
    """ISO text in UTC with a numeric offset, with microseconds where there are any; null stays null."""
    second = F.date_format(c, ISO)
    return F.concat(F.when(F.unix_micros(c) % 1_000_000 == 0, second).otherwise(F.date_format(c, ISO + ".SSSSSS")), F.lit("+00:00"))


def parse_hour_period(c: Column) -> Column:
    """``YYYY-MM-DDTHH`` as a timestamp; anything else is null."""
    return F.when(F.trim(c).rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}$"), F.try_to_timestamp(F.trim(c), F.lit("yyyy-MM-dd'T'HH")))


def parse_number(c: Column) -> Column:
    """A double from text with thousands commas; null, empty or unreadable is null."""
    return F.trim(F.replace(c, F.lit(","), F.lit(""))).try_cast("double")


def normalize_unit(c: Column) -> Column:
    """The standard name of a unit; null is ``unknown``, an unlisted unit its trimmed self."""
    return F.coalesce(F.get(F.transform(F.array(F.lower(F.trim(c))), lambda u: literal_map(UNITS)[u]), F.lit(0)), F.trim(c), F.lit("unknown"))


def split_values(c: Column, sep: str = ";") -> Column:
    """The trimmed non-blank items of a delimited list; null gives an empty list."""
    return F.coalesce(F.filter(F.transform(F.split(c, sep), lambda x: F.trim(x)), lambda x: x != ""), F.array().cast("array<string>"))


def parse_themes(c: Column) -> Column:
    """P10: the distinct items in upper case, in order of first use."""
    return F.array_distinct(F.transform(split_values(c), F.upper))


def parse_orgs(c: Column) -> Column:
    """Distinct names, what stands before the first comma of each item, in upper case."""
    return F.array_distinct(F.transform(split_values(c), lambda x: F.upper(F.trim(F.split_part(x, F.lit(","), F.lit(1))))))


def parse_locations(c: Column) -> Column:
    """Sorted distinct keys of ``type#name#country#adm1#...`` items: country, region and country-region."""

    def keys(item: Column) -> Column:
        parts = F.split(item, "#")
        country, region = (F.coalesce(F.upper(F.trim(F.get(parts, F.lit(i)))), F.lit("")) for i in (2, 3))
        return F.array(country, region, F.when((country != "") & (region != ""), F.concat(country, F.lit("-"), region)).otherwise(""))

    found = F.flatten(F.transform(F.split(F.coalesce(c, F.lit("")), ";"), keys))
    return F.array_sort(F.array_distinct(F.filter(found, lambda x: x != "")))


def extract_tag(c: Column, tag: str) -> Column:
    """The trimmed text of the first such element, '' where there is none; the dot spans lines."""
    return F.coalesce(F.trim(F.regexp_extract(c, f"(?s)<{tag}>(.*?)</{tag}>", 1)), F.lit(""))


def coalesce_timestamp(*stamps: Column) -> Column:
    """The first non-blank ``YYYYMMDDHHMMSS`` stamp, parsed in UTC; unreadable is null."""
    return F.try_to_timestamp(F.coalesce(*[blank_to_null(s) for s in stamps]), F.lit("yyyyMMddHHmmss"))


def overlap_count(items: Column, targets: list[str]) -> Column:
    """How many of the targets are among the items."""
    return F.size(F.array_intersect(items, F.array(*[F.lit(t) for t in normalized_targets(targets)])))


def clean_row(df, *required: str):
    """Rows with NaN as null, and the rejects: rows where a required text is null or blank."""
    numbers = {"float", "double"}
    clean = df.select(*[F.when(~F.isnan(f"`{c}`"), F.col(f"`{c}`")).alias(c) if kind in numbers else F.col(f"`{c}`") for c, kind in df.dtypes])
    good = F.lit(True)
    for c in required:
        good = good & blank_to_null(F.col(f"`{c}`")).isNotNull()
    return clean.filter(good), clean.filter(~good)


def normalized_targets(targets: list[str]) -> list[str]:
    """Target names trimmed, in upper case, blanks dropped."""
    return sorted({t.strip().upper() for t in targets if t.strip()})


def theme_match(themes: Column, targets: list[str], least: int = 1) -> Column:
    """At least ``least`` of the target themes."""
    return overlap_count(themes, targets) >= least


def any_match(items: Column, targets: list[str]) -> Column:
    """Any overlap with the targets; null items match nothing."""
    return F.coalesce(F.arrays_overlap(items, F.array(*[F.lit(t) for t in normalized_targets(targets)])), F.lit(False))


def relevant(theme: Column, location: Column, organization: Column) -> Column:
    """(theme and location) or organisation; null flags are false."""
    no = F.lit(False)
    return (F.coalesce(theme, no) & F.coalesce(location, no)) | F.coalesce(organization, no)


# Fixed short escapes of JSON text; other control characters are written as four hex digits.
ESCAPES = {"\\": "\\\\", '"': '\\"', "\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}


def json_text(c: Column) -> Column:
    """A text as JSON: quoted, with quotes, backslashes and control characters escaped and all else as it is."""
    out = c
    for char, escaped in ESCAPES.items():
        out = F.replace(out, F.lit(char), F.lit(escaped))
    rare = out
    for code in range(32):
        if chr(code) not in ESCAPES:
            rare = F.replace(rare, F.lit(chr(code)), F.lit(f"\\u{code:04x}"))
    return F.concat(F.lit('"'), F.when(c.rlike(r"[\x00-\x07\x0b\x0e-\x1f]"), rare).otherwise(out), F.lit('"'))


def canonical_json(**values: Column) -> Column:
    """Key-sorted JSON text with ', ' and ': ' between; texts quoted and escaped, non-ASCII kept, whole numbers and booleans bare, nulls as null, all else as quoted text."""
    bare = lambda c: F.typeof(c).isin("tinyint", "smallint", "int", "bigint", "boolean")
    written = lambda c: F.coalesce(F.when(bare(c), c.cast("string")).otherwise(json_text(c.cast("string"))), F.lit("null"))
    parts = [F.concat(F.lit(f'"{k}": '), written(values[k])) for k in sorted(values)]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def stable_hash(**values: Column) -> Column:
    """SHA-256 of the canonical JSON."""
    return F.sha2(canonical_json(**values), 256)


def absolute_url(c: Column, base: str) -> Column:
    """The URL itself if it is absolute, else under the base; blank is null."""
    url = blank_to_null(c)
    return F.when(url.startswith("http"), url).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), F.ltrim(url, F.lit("/"))))


def join_nonblank(*columns: Column, sep: str = "\n\n") -> Column:
    """The trimmed non-blank texts joined by a blank line."""
    return F.concat_ws(sep, *[blank_to_null(c) for c in columns])


def categorize_status(c: Column) -> Column:
    """The category of an HTTP status."""
    return F.when(c.isNull(), "unknown").when(c == 403, "forbidden").when(c == 404, "not_found").when(c == 429, "rate_limited").when((c >= 500) & (c < 600), "server_error").otherwise("http_error")


def is_precise_timestamp(c: Column) -> Column:
    """Text that has a time of day and can be read as ISO."""
    text = F.trim(c)
    return F.coalesce(text.rlike("[T:]") & F.try_to_timestamp(text).isNotNull(), F.lit(False))


def url_domain(c: Column) -> Column:
    """The host of a URL in lower case without ``www.``; null where there is none."""
    return F.regexp_replace(F.lower(F.try_parse_url(c, F.lit("HOST"))), r"^www\.", "")


def title_from_url(c: Column) -> Column:
    """A title from the last part of a URL's path: extension off, separators to spaces, long numbers off, title case."""
    path = F.try_parse_url(c, F.lit("PATH"))
    slug = F.regexp_extract(F.rtrim(path, F.lit("/")), r"([^/]*)$", 1)
    words = F.regexp_replace(F.regexp_replace(F.regexp_replace(slug, r"\.[A-Za-z0-9]+$", ""), r"[-_+]+", " "), r"\b\d{5,}\b", "")
    return F.initcap(F.trim(F.regexp_replace(words, r"\s+", " ")))
