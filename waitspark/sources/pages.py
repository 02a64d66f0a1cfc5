"""Rows and cells of HTML pages held in a DataFrame, by built-in regular expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitspark.functions.text import cell_text


def element_pattern(tag: str) -> str:
    """Matches one element, its content in group 1."""
    return rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>"


def pages_with_param(pages: DataFrame, name: str, url: str = "url") -> DataFrame:
    """Pages whose link carries ``name=``; a substring test, so it reaches the Parquet scan."""
    return pages.filter(F.col(url).contains(f"{name}="))


def html_table(html: Column, table_id: str) -> Column:
    """Body of the table with the given id; empty text if the page has none."""
    table = F.regexp_extract(
        html, rf"(?is)<table[^>]*\bid=[\"']?{table_id}\b[^>]*>(.*?)</table\s*>", 1
    )
    return F.regexp_extract(table, element_pattern("tbody"), 1)


def html_rows(
    pages: DataFrame,
    keys: Sequence[str],
    tag: str = "tr",
    html: Column | str = "html",
) -> DataFrame:
    """One row per ``tag`` element: the key columns, its position in the page and its markup."""
    source = F.col(html) if isinstance(html, str) else html
    found = F.regexp_extract_all(source, F.lit(element_pattern(tag)), F.lit(1))
    return pages.select(*keys, F.posexplode(found).alias("position", "markup"))


def row_cells(markup: Column, tag: str = "td") -> Column:
    """Array of the cell texts of one row."""
    found = F.regexp_extract_all(markup, F.lit(element_pattern(tag)), F.lit(1))
    return F.transform(found, cell_text)


_SCAN = "struct<at:int,depth:int,start:int,done:boolean,spans:array<struct<start:int,size:int>>>"


def top_elements(markup: Column, tag: str, container: str = "table") -> Column:
    """Contents of the ``tag`` elements of ``markup`` that lie in no ``container`` opened inside it, as an array.

    The tags are folded from left to right with the number of open containers, so elements of an inner
    container end nothing outside. An element also ends where the next one begins, at the end of
    the container that ``markup`` begins in, which ends the scan, and at the end of the text.
    """
    tokens = F.regexp_extract_all(
        markup, F.lit(rf"(?is)<!--.*?-->|</?(?:{tag}|{container})(?:\s[^>]*|/)?>|[^<]+|<"), F.lit(0)
    )

    def is_tag(token: Column, name: str, closing: bool) -> Column:
        return token.rlike(rf"(?is)^<{'/' if closing else ''}(?:{name})(?:\s[^>]*|/)?>$")

    def step(s: Column, token: Column) -> Column:
        top = (s["depth"] == 0) & ~s["done"]
        opens, closes = is_tag(token, container, False), is_tag(token, container, True)
        begins = top & is_tag(token, tag, False)
        leaves = top & closes
        ends = begins | leaves | (top & is_tag(token, tag, True))
        after = s["at"] + F.length(token)
        span = F.struct(s["start"].alias("start"), (s["at"] - s["start"]).alias("size"))
        return F.struct(
            after.alias("at"),
            F.greatest(F.lit(0), s["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)).alias("depth"),
            F.when(begins, after).when(ends, F.lit(0)).otherwise(s["start"]).alias("start"),
            (s["done"] | leaves).alias("done"),
            F.when(ends & (s["start"] > 0), F.concat(s["spans"], F.array(span))).otherwise(s["spans"]).alias("spans"),
        ).cast(_SCAN)

    first = F.struct(F.lit(1), F.lit(0), F.lit(0), F.lit(False), F.array()).cast(_SCAN)
    scanned = F.aggregate(tokens, first, step)
    last = F.struct(scanned["start"].alias("start"), (scanned["at"] - scanned["start"]).alias("size"))
    spans = F.when(scanned["start"] > 0, F.concat(scanned["spans"], F.array(last))).otherwise(scanned["spans"])
    return F.transform(spans, lambda s: F.substring(markup, s["start"], s["size"]))


def table_rows(pages: DataFrame, keys: Sequence[str], table_id: str, html: Column | str = "html") -> DataFrame:
    """One row per row of the table with the given id: the key columns, its position and its markup.

    Tables inside a cell stay in that cell's markup.
    """
    source = F.col(html) if isinstance(html, str) else html
    inside = F.regexp_extract(source, rf"(?is)<table[^>]*\bid=[\"']?{table_id}\b[^>]*>(.*)$", 1)
    return pages.select(*keys, inside.alias("_inside")).select(
        *keys, F.posexplode(top_elements(F.col("_inside"), "tr")).alias("position", "markup")
    )
