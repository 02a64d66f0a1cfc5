"""Main text of web pages: structure says where the article is, a host's suffixes say what repeats.

1. A page becomes blocks of tokens, each in a region: ``article`` (inside article or main elements),
   ``furniture`` (inside menus, headers, footers, sidebars, notices, adverts, forms, comments, by element,
   role, class or id), or ``open``. Class and id names are taken apart at hyphens, digits and capitals, and a part
   such as comments or footer decides; see ``_furniture_names`` for what speaks against it. An article or
   main inside a form or a wrapper that only its class or id marks is an article all the same, but not inside
   comments, adverts, sidebars and lists of related pages.
2. The token streams of a host's pages are one text whose suffixes are ordered by their first ``RUN``
   tokens: prefix doubling names each suffix's first 1, 2, 4, ... tokens, and suffixes of one name form an
   interval of the host's suffix array. Intervals are found by grouping (host, name), so no host is
   ever in one task, and the grouping combines inside the tasks. A suffix ends with its block, so
   a block shorter than ``RUN`` is a suffix of its own; every block is also named whole.
3. An interval is boilerplate if it has suffixes outside articles on at least two pages of the host that
   differ in their own text and on at least ``SHARE`` of the host's pages, and on more pages outside
   articles than inside. Pages that differ only in furniture or title do not make their text boilerplate.
4. A page that has an article consists of its article blocks, whole: text inside an article stays even if it
   repeats, as articles may share passages. Any other page consists of its open blocks without the tokens
   that boilerplate suffixes cover; their unique runs stay. A page that would lose all its paragraphs keeps them. Blocks are joined in page order.

Null html is
an empty page with empty text; null urls share one host. Repeated rows get equal texts. Empty input gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitspark.llm.common import WordHashes, hashed
from waitspark.llm.kneser_ney import chain
from waitspark.workspace import materialize

#: Tokens that make a repeated run; a power of two.
RUN = 8
#: Boilerplate stands on at least this share of a host's pages.
SHARE = 0.1
#: Tokens of a block that is prose.
PARAGRAPH = 20

# HTML's own element names, by what they mean here.
RAW = ("script", "style", "noscript", "template", "svg", "iframe", "object", "textarea", "title")
FURNITURE_TAGS = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "head", "fieldset"}
ARTICLE_TAGS = {"article", "main"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
    "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
#: Elements whose end is often left out; they hold no region.
LOOSE = {"p", "li", "dt", "dd", "tr", "td", "th", "option", "h1", "h2", "h3", "h4", "h5", "h6"}
FURNITURE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}
#: Those whose elements often hold articles that are not the page's.
COMMENT_WORDS = {"comment", "comments", "disqus", "respond", "related", "sidebar", "promo", "promotion", "ad", "ads", "widget", "sponsored"}
#: Words that make a name one of furniture whatever stands beside them, as in reader-comments or pageFooter.
FURNITURE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie",
    "cookies", "disqus", "footer", "header", "masthead", "nav", "navbar", "navigation", "newsletter", "popup", "promo", "promotion",
    "related", "respond", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe",
}
#: Words that do so only beside others of furniture or of layout.
LESSER_WORDS = {"banner", "menu", "modal", "notice", "notices", "pager", "pagination", "toolbar", "widget"}
#: After these, or in names that begin so, a word speaks of something else: has-sidebar, category-social.
OTHERWISE = {"has", "with", "no", "without", "not"}
TOPICS = {"category", "tag", "type", "format", "status"}
#: An element named so as well holds the page rather than a part of it.
LAYOUT = {"layout", "page", "grid", "columns", "wrapper", "container", "body"}
#: Inside an article a header is the article's own, and what is related is its subject unless it is a list of these.
OWN_WORDS = {"header", "related"}
LISTED = {"posts", "articles", "stories", "links", "items", "content", "reading", "news", "topics"}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<svg\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?<=/)>"
    rf"|<(?P<raw>{'|'.join(RAW)})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-z][^>]*(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
#: What a lesser word may have beside it in a name; any other part speaks of something else.
FURNITURE_PARTS = FURNITURE_WORDS | LESSER_WORDS | {
    "area", "bar", "block", "box", "buttons", "button", "container", "content", "form", "inner", "items", "left", "links", "list", "main",
    "mobile", "outer", "panel", "primary", "right", "secondary", "section", "site", "slot", "top", "bottom", "unit", "wrap", "wrapper",
}
#: Parts of a name: at hyphens and the like, digits, and where small letters meet a capital.
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

#: MARKED is furniture that an article inside ends: by class or id, or a form.
OPEN, ARTICLE, FURNITURE, MARKED = 0, 1, 2, 3


@dataclass
class Block:
    region: int
    tokens: list[str]


def _furniture_names(names: str, article: bool, inside: bool) -> tuple[bool, bool]:
    """(whether a class name or id is one of furniture, and one of an element whose articles are not the page's).

    ``article``: the element is an article itself, whose names tell its subject too, so only names made of
    nothing but furniture count. ``inside``: it stands in an article.
    """
    furniture = foreign = False
    for name in names.split():
        parts = [p.lower() for p in _NAME_PART.findall(name)]
        if not parts or parts[0] in TOPICS or OTHERWISE.intersection(parts):
            continue
        words = FURNITURE_WORDS.intersection(parts)
        if inside and not LISTED.intersection(parts):
            words -= OWN_WORDS
        made = FURNITURE_PARTS.issuperset(parts)
        if (article or not words) and not (made and (words or LESSER_WORDS.intersection(parts))):
            if not (article and words & COMMENT_WORDS):
                continue
        furniture = True
        foreign = foreign or bool(COMMENT_WORDS.intersection(parts)) and not LAYOUT.intersection(parts)
    return furniture, foreign


def _own_region(name: str, attributes: str, above: int) -> int:
    """Region of an element given the region around it; furniture stays furniture, MARKED up to an article."""
    if above == FURNITURE:
        return FURNITURE
    role = words = ""
    article = name in ARTICLE_TAGS
    if attributes:
        for key, a, b, c in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), a or b or c
            if key == "role":
                role = value.strip().lower()
            elif key in ("class", "id"):
                words += " " + value
            elif key == "itemprop":
                article = article or value.lower() == "articlebody"
    if role in FURNITURE_ROLES or (name in FURNITURE_TAGS - {"form"} and not (name == "header" and above == ARTICLE)):
        return FURNITURE
    if words and name not in ("body", "html", "main"):
        furniture, foreign = _furniture_names(words, name in ARTICLE_TAGS, above == ARTICLE)
        if furniture:
            # Comments hold articles of their own, which are none of the page.
            return FURNITURE if foreign or name in ARTICLE_TAGS or above == ARTICLE else MARKED
    if name == "form":
        return FURNITURE if above == ARTICLE else MARKED
    return ARTICLE if article or role == "main" else above


def blocks(page: str) -> list[Block]:
    """Blocks of a page in order, with their regions; blocks without words are left out."""
    found: list[Block] = []
    pieces: list[str] = []
    stack: list[tuple[str, int]] = []
    #: How many elements of a name are open, so an end tag without its start costs nothing.
    opened: Counter[str] = Counter()
    region = OPEN

    def cut(length: int) -> None:
        opened.subtract(name for name, _ in stack[length:])
        del stack[length:]

    def close() -> None:
        tokens = entities.unescape("".join(pieces)).split()
        pieces.clear()
        if tokens:
            found.append(Block(region, tokens))

    at = 0
    for match in _TAG.finditer(page):
        if match.start() > at:
            pieces.append(page[at : match.start()])
        at = match.end()
        name = match["name"]
        if name is None:
            continue
        name = name.lower()
        if name == "br":
            pieces.append(" ")
            continue
        if name in INLINE:
            attributes = match["attributes"]
            if not match["end"] and name in ("a", "span", "label") and "=" in attributes and _own_region(name, attributes, region) in (FURNITURE, MARKED) and region not in (FURNITURE, MARKED):
                close()
                stack.append((name, region := FURNITURE))
                opened[name] += 1
            elif match["end"] and stack and stack[-1][0] == name:
                close()
                cut(len(stack) - 1)
                region = stack[-1][1] if stack else OPEN
            continue
        close()
        if name in VOID:
            continue
        if match["end"]:
            if opened[name] > 0:
                last = len(stack) - 1
                while stack[last][0] != name:
                    last -= 1
                cut(last)
            region = stack[-1][1] if stack else OPEN
            continue
        if name == "body":
            # The body ends a head whose end is left out.
            stack = [x for x in stack if x[0] != "head"]
            opened["head"] = 0
            region = stack[-1][1] if stack else OPEN
        own = _own_region(name, match["attributes"], region)
        if name in LOOSE:
            # A paragraph ends one before it; it needs a place only if it is furniture itself.
            while stack and stack[-1][0] in LOOSE:
                cut(len(stack) - 1)
            region = stack[-1][1] if stack else OPEN
            own = _own_region(name, match["attributes"], region)
            if own == region:
                continue
        stack.append((name, own))
        opened[name] += 1
        region = own
    rest = page[at:]
    pieces.append(rest)
    close()
    return found


def run_names(h: np.ndarray) -> np.ndarray:
    """Names of the ``RUN`` tokens from each place that has so many, by prefix doubling."""
    name, width = h, 1
    while width < RUN:
        if len(name) <= width:
            return np.zeros(0, np.uint64)
        name = chain(name[:-width], name[width:])
        width *= 2
    return name


def whole_name(h: np.ndarray) -> np.uint64:
    """Name of a block as a whole, apart from all run names."""
    places = np.arange(1, len(h) + 1, dtype=np.uint64)
    return np.uint64(np.bitwise_xor.reduce(chain(places, h)) ^ np.uint64(0x57484F4C45))


def suffixes(page: list[Block], cache: WordHashes) -> list[tuple[int, np.ndarray]]:
    """For each block its region and the names under which it may repeat, the whole block's first."""
    found = []
    for block in page:
        h = hashed([t.encode() for t in block.tokens], cache)
        names = np.array([whole_name(h)], dtype=np.uint64)
        found.append((block.region, names if block.region == ARTICLE else np.concatenate([names, run_names(h)])))
    return found


def kept_text(page: list[Block], boilerplate: set[int]) -> str:
    """The page's text once the names in ``boilerplate`` are known.

    If no block of at least ``PARAGRAPH`` tokens would be left, the open blocks that had so many stay whole:
    some other page has all this page's text, so it is a copy with other trimmings.
    """
    wanted = ARTICLE if any(b.region == ARTICLE for b in page) else OPEN
    own = [b.tokens for b in page if b.region == wanted]
    if wanted == ARTICLE or not boilerplate:
        return " ".join(t for tokens in own for t in tokens)
    cache = WordHashes()
    kept: list[list[str]] = []
    for tokens in own:
        names = suffixes([Block(OPEN, tokens)], cache)[0][1].tolist()
        covered = [i for i, n in enumerate(names[1:]) if n in boilerplate]
        gone = {i + k for i in covered for k in range(RUN)}
        kept.append([] if names[0] in boilerplate else [t for i, t in enumerate(tokens) if i not in gone])
    if not any(len(tokens) >= PARAGRAPH for tokens in kept):
        kept = [whole if len(whole) >= PARAGRAPH else left for whole, left in zip(own, kept)]
    return " ".join(t for tokens in kept for t in tokens)


def _pages(pages: DataFrame) -> DataFrame:
    """host, key (a digest of the row), html."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    content = F.coalesce(F.col("html").cast("string"), F.lit(""))
    return pages.select("page_id", "url", host.alias("host"), F.md5(content).alias("key"), content.alias("html"))


def names_of(rows: DataFrame) -> DataFrame:
    """(host, page, name, inside): the suffixes of a page's blocks, each once, with a digest of the page's own text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            host, key, name, inside = [], [], [], []

            def emit() -> pa.RecordBatch:
                out = pa.RecordBatch.from_arrays(
                    [pa.array(host, pa.string()), pa.array(key, pa.string()), pa.array(np.concatenate(name).view(np.int64)), pa.array(inside, pa.bool_())],
                    names=["host", "page", "name", "inside"],
                )
                for column in (host, key, name, inside):
                    column.clear()
                return out

            for h, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                page = blocks(html)
                own = " ".join(t for b in page if b.region in (OPEN, ARTICLE) for t in b.tokens)
                digest = hashlib.md5(own.encode()).hexdigest()
                found = suffixes(page, cache)
                for within in (False, True):
                    names = [n for region, n in found if (region == ARTICLE) == within]
                    if names:
                        unique = np.unique(np.concatenate(names))
                        host.extend([h] * len(unique))
                        key.extend([digest] * len(unique))
                        name.append(unique)
                        inside.extend([within] * len(unique))
                if len(host) > 50_000:
                    yield emit()
            if host:
                yield emit()

    return rows.select("host", "html").mapInArrow(run, "host string, page string, name long, inside boolean")


def boilerplate(rows: DataFrame) -> DataFrame:
    """(host, name) of the intervals that are boilerplate."""
    out = ~F.col("inside")
    pages = rows.groupBy(F.col("host").alias("_host")).agg(F.count("*").alias("pages"))
    found = (
        names_of(rows)
        .groupBy("host", "name")
        .agg(
            F.min(F.when(out, F.col("page"))).alias("first"),
            F.max(F.when(out, F.col("page"))).alias("last"),
            F.count(F.when(out, 1)).alias("outside"),
            F.count(F.when(F.col("inside"), 1)).alias("inside"),
        )
        .filter((F.col("first") != F.col("last")) & (F.col("outside") > F.col("inside")))
    )
    common = found.join(materialize(pages, "host-pages"), F.col("host") == F.col("_host"))
    return common.filter(F.col("outside") >= F.col("pages") * SHARE).select("host", "name")


def concerned(rows: DataFrame) -> DataFrame:
    """(host, key, name): the suffixes of the open blocks of pages without an article, which need a verdict."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            for h, k, page in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found = blocks(page)
                if any(b.region == ARTICLE for b in found):
                    continue
                names = [n for _, n in suffixes([b for b in found if b.region == OPEN], cache)]
                if names:
                    joined = np.unique(np.concatenate(names)).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([h] * len(joined), pa.string()), pa.array([k] * len(joined), pa.string()), pa.array(joined)],
                        names=["host", "key", "name"],
                    )

    return rows.select("host", "key", "html").mapInArrow(run, "host string, key string, name long")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for each row of ``pages``."""
    rows = _pages(pages)
    common = materialize(boilerplate(rows), "boilerplate")
    hits = concerned(rows).join(common, ["host", "name"], "left_semi").distinct()
    hits = materialize(hits.groupBy("host", "key").agg(F.collect_list("name").alias("names")), "page-boilerplate")
    hits = hits.select(F.col("host").alias("_host"), F.col("key").alias("_key"), "names")
    joined = rows.join(hits, (F.col("host") == F.col("_host")) & (F.col("key") == F.col("_key")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [kept_text(blocks(page), {n % 2**64 for n in names or ()}) for page, names in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    kind = dict(pages.dtypes)["page_id"]
    return joined.select("page_id", "url", "html", "names").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
