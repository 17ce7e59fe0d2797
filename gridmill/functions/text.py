"""Text cleaning (rows T01 to T05)."""

from __future__ import annotations

import html
import html.entities
import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmill.functions.scalars import let

# Fixed test of what counts as a tag.
TAG = r"<[a-zA-Z!/][^>]*>"


#: References that most texts keep to; replaced in this order, the ampersand last, they decode as one pass would.
COMMON = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": "\u00a0", "&copy;": "\u00a9", "&middot;": "\u00b7", "&ndash;": "\u2013", "&mdash;": "\u2014", "&hellip;": "\u2026", "&lsquo;": "\u2018", "&rsquo;": "\u2019", "&ldquo;": "\u201c", "&rdquo;": "\u201d", "&amp;": "&"}
UNCOMMON = rf"&(?!(?:{'|'.join(k[1:] for k in COMMON)}))[^\t\n\f <&;]"
#: What can be a reference: a number, decimal or hexadecimal, or a name of up to 32 characters, the semicolon optional.
REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
#: A reference that its semicolon ends, and one of these that is not common.
CLOSED = r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[^\t\n\f <&#;]{1,32});"
UNCOMMON_CLOSED = rf"&(?!(?:{'|'.join(k[1:] for k in COMMON)}))[^\t\n\f <&;]+;"
#: Code points that a numeric reference does not stand for as they are: controls, halves of pairs and no characters.
_ODD_RANGES = (range(0, 160), range(0xFDD0, 0xFDF0), *(range(0x10000 * p + 0xFFFE, 0x10000 * p + 0x10000) for p in range(17)))


def _literal_table(table: dict[str, str]) -> Column:
    """A table as a map that is put together once, when the plan is made."""
    return F.str_to_map(F.lit("\x02".join(f"{k}\x01{v}" for k, v in table.items())), F.lit("\x02"), F.lit("\x01"))


def _reference(ref: Column, closed: bool) -> Column:
    """What one reference stands for; itself where it is none. A closed one is a name as a whole or not at all."""
    odd = _literal_table({str(n): html.unescape(f"&#{n};") for r in _ODD_RANGES for n in r if n not in (1, 2) and html.unescape(f"&#{n};") != chr(n)})
    names = _literal_table(html.entities.html5)
    digits = F.regexp_extract(ref, "^&#[xX]?0*([0-9a-fA-F]*);?$", 1)

    def of_number(n: Column) -> Column:
        bad = (n > 0x10FFFF) | ((n >= 0xD800) & (n <= 0xDFFF))
        as_is = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        return F.when(bad, "\ufffd").when(n.isin(1, 2), "").otherwise(F.coalesce(F.try_element_at(odd, n.cast("string")), as_is))

    value = F.when(F.length(digits) > 8, F.lit(1 << 40)).otherwise(F.conv(F.when(digits == "", "0").otherwise(digits), 10, 10).cast("long"))
    hexed = F.when(F.length(digits) > 8, F.lit(1 << 40)).otherwise(F.conv(F.when(digits == "", "0").otherwise(digits), 16, 10).cast("long"))
    number = let(F.when(ref.rlike("^&#[xX]"), hexed).otherwise(value), of_number)
    name = F.substring(ref, 2, 100)
    # The longest name that the reference begins with; what is left of it stays.
    cut = F.get(F.filter(F.sequence(F.length(name), F.lit(2), F.lit(-1)), lambda k: F.try_element_at(names, F.substring(name, F.lit(1), k)).isNotNull()), F.lit(0))
    named = let(cut, lambda k: F.when(k.isNull(), ref).otherwise(F.concat(F.try_element_at(names, F.substring(name, F.lit(1), k)), F.substring(name, k + 1, F.lit(100)))))
    if closed:
        return F.when(ref.startswith("&#"), number).otherwise(F.coalesce(F.try_element_at(names, name), ref))
    return F.when(ref.startswith("&#"), number).when(F.length(name) < 2, ref).otherwise(named)


def decode_entities(c: Column, closed: bool = False) -> Column:
    """Named and numeric character references as what they stand for, as HTML 5 reads them; with ``closed`` only those that end with a semicolon, so that one that was cut off stays as it is. Texts that keep to the common names are a few replacements."""
    reference, uncommon = (CLOSED, UNCOMMON_CLOSED) if closed else (REFERENCE, UNCOMMON)

    def decoded(t: Column) -> Column:
        simple = t
        for name, value in COMMON.items():
            simple = F.replace(simple, F.lit(name), F.lit(value))
        parts = F.split(t, reference, -1)
        full = let(F.regexp_extract_all(t, F.lit(reference), F.lit(0)), lambda refs: F.array_join(F.transform(parts, lambda p, i: F.concat(p, F.coalesce(_reference(F.get(refs, i), closed), F.lit("")))), ""))
        return F.when(~F.contains(t, F.lit("&")), t).when(~t.rlike(uncommon), simple).otherwise(full)

    return let(c, decoded)


@F.pandas_udf(T.StringType())
def _unescaped(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


@F.pandas_udf(T.StringType())
def _unescaped_closed(texts: pd.Series) -> pd.Series:
    known = lambda m: html.unescape(m[0]) if m[0][1] == "#" or m[0][1:] in html.entities.html5 else m[0]
    return texts.map(lambda t: re.sub(CLOSED, known, t), na_action="ignore")


def _decoded_for_python(c: Column) -> Column:
    """``decode_entities`` where a Python function comes next, which cannot take what nested lambdas make. Texts without an ampersand are sent as nulls."""
    return F.coalesce(_unescaped(F.when(F.contains(c, F.lit("&")), c)), c)


def _closed_for_python(c: Column) -> Column:
    """``decode_closed`` where a Python function comes next."""
    return F.coalesce(_unescaped_closed(F.when(F.contains(c, F.lit("&")), c)), c)


def decode_closed(c: Column) -> Column:
    """``decode_entities`` of the references that end with a semicolon."""
    return decode_entities(c, closed=True)


def html_to_text(c: Column, decode: Callable[[Column], Column] = decode_entities) -> Column:
    """Script, style and comment blocks go, tags become spaces, entities are decoded."""
    out = F.regexp_replace(c, r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>", " ")
    return decode(F.regexp_replace(F.regexp_replace(out, r"(?s)<!--.*?-->", " "), TAG, " "))


def strip_html(c: Column, decode: Callable[[Column], Column] = decode_entities) -> Column:
    """The text of HTML; what holds no tag is unchanged."""
    return F.when(c.rlike(TAG), html_to_text(c, decode)).otherwise(c)


@F.pandas_udf(T.StringType())
def _nfkc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


def normalize_unicode(c: Column) -> Column:
    """Unicode NFKC. Pure ASCII, most rows, is its own form; such rows are sent to Python as nulls."""
    return F.coalesce(_nfkc(F.when(~c.rlike(r"^\p{ASCII}*$"), c)), c)


def normalize_whitespace(c: Column) -> Column:
    """Runs of any white space become one space; both ends are trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def truncate_text(c: Column, most: int = 8000) -> Column:
    """The first ``most`` characters."""
    return F.substring(c, 1, most)


def clean_text(c: Column, most: int = 8000, closed: bool = False) -> Column:
    """T01 to T04 in this order; null gives ''. A cut can leave a trailing space. With ``closed`` only references that end with a semicolon are decoded."""
    return F.coalesce(truncate_text(normalize_whitespace(normalize_unicode(strip_html(c, _closed_for_python if closed else _decoded_for_python))), most), F.lit(""))
