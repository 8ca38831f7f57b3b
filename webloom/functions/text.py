"""Text column builders: whitespace rules, script/style removal, entities, page text."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values ------------------------------------------------------------------
# Characters Python's str.strip() removes (str.isspace): \t \n \v \f \r, \x1c-\x1f,
# space, \x85, \xa0,  ,  - ,  ,  ,  ,  , 　.
PY_WHITESPACE_CLASS = (r"[\t\n\x{0B}\x{0C}\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
                       r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
# Characters removed in strip mode: newline, space, tab, carriage return.
STRIP_CHARS = " \n\t\r"
# XPath normalize-space() whitespace: space, tab, carriage return, newline.
XML_NON_SPACE = r"[^ \t\r\n]"
# A character reference: decimal, hexadecimal or named.
REFERENCE_RE = r"&(?:#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);"
# A tag, end tag, declaration or instruction; "<" before anything else is text.
TAG_RE = r"<[A-Za-z/!?][^>]*>"
# comments, scripts and styles in one left-to-right pass (a "<!--" inside a script is
# script text, and a "</script>" inside a comment is comment text); an unclosed script or style
# reaches to the end of the page
NON_TEXT_RE = r"(?is)<!--.*?-->|<script\b[^>]*>.*?(?:</script\s*>|\z)|<style\b[^>]*>.*?(?:</style\s*>|\z)"
# -------------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_ws(text) -> Column:
    """H1: delete every newline, space, tab and carriage return (NBSP kept)."""
    return F.translate(_c(text), STRIP_CHARS, "")


def py_strip(text) -> Column:
    """H2: trim both ends with Python's Unicode whitespace set (SQL trim is spaces only)."""
    t = F.regexp_replace(_c(text), "^" + PY_WHITESPACE_CLASS + "+", "")
    return F.regexp_replace(t, PY_WHITESPACE_CLASS + "+$", "")


def non_blank(text) -> Column:
    """Normalize-space(.) is not empty."""
    return _c(text).rlike(XML_NON_SPACE)


def _code_point(ref: Column) -> Column:
    hexd = F.regexp_extract(ref, r"&#[xX]([0-9A-Fa-f]+);", 1)
    dec = F.regexp_extract(ref, r"&#([0-9]+);", 1)
    # leading zeros carry no value; more digits than the largest code point has make an invalid one
    hexd, dec = (F.regexp_replace(x, "^0+", "") for x in (hexd, dec))
    return (F.when((hexd != "") & (F.length(hexd) <= 6), F.conv(hexd, 16, 10).cast("bigint"))
            .when((dec != "") & (F.length(dec) <= 7), dec.cast("bigint")))


def _char(c: Column) -> Column:
    """The character of code point ``c``: its UTF-16 code units decoded as UTF-16BE."""
    hi = F.lpad(F.hex(F.lit(0xD800) + F.shiftright(c - 0x10000, 10)), 4, "0")
    lo = F.lpad(F.hex(F.lit(0xDC00) + (c - 0x10000).bitwiseAND(0x3FF)), 4, "0")
    units = F.when(c < 0x10000, F.lpad(F.hex(c), 4, "0")).otherwise(F.concat(hi, lo))
    return F.decode(F.unhex(units), "UTF-16BE")


def _named() -> Column:
    """Name -> character of the standard library's HTML table, as one constant map."""
    table = {name[:-1]: char for name, char in html5.items() if name.endswith(";")}
    return F.from_json(F.lit(json.dumps(table)), "map<string,string>")


def decode_entities(text) -> Column:
    """Every character reference that ends in ';' replaced by its character, each once.

    One pass: the text is split around the references and re-joined with the decoded ones, so a decoded
    character never becomes part of another reference. Unknown names and invalid code points (0, surrogates,
    beyond U+10FFFF) stay as written. Texts without '&' skip the work."""
    t = _c(text)
    refs = F.regexp_extract_all(t, F.lit(REFERENCE_RE), 0)
    parts = F.split(t, REFERENCE_RE, -1)
    named = _named()

    def one(ref):
        c = _code_point(ref)
        ok = (c >= 1) & (c <= 0x10FFFF) & ~((c >= 0xD800) & (c <= 0xDFFF))
        numeric = F.when(F.coalesce(ok, F.lit(False)), _char(c))
        name = F.try_element_at(named, F.substring(ref, F.lit(2), F.length(ref) - 2))
        return F.coalesce(F.when(ref.startswith("&#"), numeric).otherwise(name), ref)

    decoded = F.concat(F.transform(refs, one), F.array(F.lit("")))
    joined = F.array_join(F.zip_with(parts, decoded, lambda p, d: F.concat(p, d)), "")
    return F.when(t.contains("&"), joined).otherwise(t)


def clean_markup(html) -> Column:
    """Comments, scripts and styles removed in one pass: the input of links and page text."""
    return F.regexp_replace(_c(html), NON_TEXT_RE, "")


def page_text(html) -> Column:
    """Whole-page text (script/style/comments dropped, tags removed, entities decoded)."""
    return decode_entities(F.regexp_replace(clean_markup(html), TAG_RE, ""))


def add_page_text(df: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """A6 as a column: the stripped markup is its own projection, so the entity decoder
    (which reads it several times, outside whole-stage codegen) reads a plain column;
    Spark does not inline an expensive expression that is referenced more than once."""
    raw = "_" + out + "_raw"
    stripped = df.withColumn(raw, F.regexp_replace(clean_markup(html), TAG_RE, ""))
    return stripped.withColumn(out, decode_entities(raw)).drop(raw)
