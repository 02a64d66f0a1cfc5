"""Column expressions over weather and page text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns, and the characters a cell is trimmed of.
UNSIGNED_INTEGER = r"(\d+)"
SIGNED_DECIMAL = r"(-?\d+(?:\.\d+)?)"
CLOCK_24H = r"^(\d{1,2}:\d{2})"
CLOCK_12H = r"(?i)^(\d{1,2}:\d{2} (?:AM|PM))"
WHITESPACE = " \t\n\r\x0b\x0c\u00a0"
ENTITIES = {
    " ": ["&nbsp;", "&#160;", "&#xa0;"],
    '"': ["&quot;", "&#34;", "&#x22;"],
    "'": ["&apos;", "&#39;", "&#x27;"],
    "°": ["&deg;", "&#176;", "&#xb0;"],
    "-": ["&minus;", "&#8722;", "&#x2212;", "\u2212"],
    "<": ["&lt;", "&#60;", "&#x3c;"],
    ">": ["&gt;", "&#62;", "&#x3e;"],
    "&": ["&amp;", "&#38;", "&#x26;"],
}


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def extract_number(
    text: Column, pattern: str = UNSIGNED_INTEGER, kind: str = "int", default=None
) -> Column:
    """First match of ``pattern`` as a number; ``default`` (null) where there is none.

    The default pattern reads the first digit run, so it loses sign and fraction; pass
    ``SIGNED_DECIMAL`` with ``kind="double"`` to keep them, and ``default=0`` for calm wind.
    """
    number = F.regexp_extract(text, pattern, 1).try_cast(kind)
    if default is None:
        return number
    return F.when(text.isNotNull(), F.coalesce(number, F.lit(default).cast(kind)))


def clean_time(raw: Column, keep_meridiem: bool = True) -> Column:
    """Clock prefix of a time cell: empty stays empty, text without a clock stays as cleaned.

    ``keep_meridiem=False`` cuts "12:51 am" to "12:51", which merges the halves of the day.
    """
    text = strip(F.replace(raw, F.lit("\n"), F.lit(" ")))
    half_day = F.regexp_extract(text, CLOCK_12H, 1)
    full_day = F.regexp_extract(text, CLOCK_24H, 1)
    clock = F.when(full_day != "", full_day).otherwise(text)
    if keep_meridiem:
        clock = F.when(half_day != "", half_day).otherwise(clock)
    return F.when(F.coalesce(raw, F.lit("")) == "", F.lit("")).otherwise(clock)


def merge_datetime(date: Column, time: Column) -> Column:
    """"date time", or empty text if either is missing."""
    missing = (F.coalesce(date, F.lit("")) == "") | (F.coalesce(time, F.lit("")) == "")
    return F.when(missing, F.lit("")).otherwise(F.concat_ws(" ", date, time))


def url_param(url: Column, name: str) -> Column:
    """First value of a query parameter; empty text if there is none. Never fails on a bad URL."""
    return F.regexp_extract(url, rf"^[^?#]*\?(?:[^#]*&)?{re.escape(name)}=([^&#]*)", 1)


def url_param_date(url: Column, link_text: Column, name: str = "hd") -> Column:
    """yyyy-MM-dd from an eight-character parameter, else the link's own text."""
    value = url_param(url, name)
    dashed = F.concat_ws(
        "-", F.substring(value, 1, 4), F.substring(value, 5, 2), F.substring(value, 7, 2)
    )
    return F.when(F.length(value) == 8, dashed).otherwise(strip(link_text))


def cell_text(markup: Column) -> Column:
    """Visible text of a table cell: line breaks kept, tags dropped, entities read, trimmed.

    A minus sign becomes a hyphen, which number patterns and casts read.
    """
    text = F.regexp_replace(markup, r"(?i)<br\s*/?>", "\n")
    text = F.regexp_replace(text, r"<[^>]*>", "")
    for char, entities in ENTITIES.items():
        text = F.regexp_replace(text, "(?i)" + "|".join(entities), char)
    return strip(text)


def zone_label(borough: Column, zone: Column) -> Column:
    return F.format_string("(%s) %s", borough, zone)
