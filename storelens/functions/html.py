"""Expressions over HTML text and URLs. Everything stays in the JVM."""

from __future__ import annotations

from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

_PIECE = r"&#?[A-Za-z0-9]+;|[^&]+|&"
# What is never closed reaches to the end of the page, as in a browser.
_INVISIBLE = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)"
_HREF = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)"""
_BASE = r"^([A-Za-z][A-Za-z0-9+.\-]*):(?://([^/?#]*))?([^?#]*)(\?[^#]*)?"


def visible(html: Column) -> Column:
    """HTML without comments, scripts and style blocks."""
    return F.regexp_replace(html, _INVISIBLE, "")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, also inside a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _code_point(number: Column) -> Column:
    padded = F.lpad(F.hex(number), 8, "0")
    known = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    return F.when(known, F.decode(F.unhex(padded), "UTF-32"))


# Names of HTML 5 in byte order and what they stand for, each as one literal that is split when the plan is optimised.
_NAMES = sorted(n for n in html5 if n.endswith(";"))


def _named(part: Column) -> Column:
    """What a named reference stands for, by binary search; NULL for no such name."""
    names = F.split(F.lit("\n".join(f"&{n}" for n in _NAMES)), "\n")
    # A line feed stands for a name itself, so another character separates the values.
    values = F.split(F.lit("\x1f".join(html5[n] for n in _NAMES)), "\x1f")

    def halve(at: Column, step: Column) -> Column:
        further = at + step
        fits = (further <= len(_NAMES)) & (F.coalesce(F.get(names, further - 1), F.lit("")) <= part)
        return F.when(fits, further).otherwise(at)

    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(_NAMES).bit_length()))])
    place = F.aggregate(steps, F.lit(0), halve)
    return let(place, lambda i: F.when(F.get(names, i - 1) == part, F.get(values, i - 1)))


def unescape(text: Column) -> Column:
    """Character references replaced once, left to right.

    Named references are those of HTML 5; numeric ones may be decimal or hexadecimal, of any length.
    """
    def piece(part: Column) -> Column:
        decimal = F.regexp_extract(part, r"^&#0*(\d+);$", 1).try_cast("bigint")
        hexa = F.nullif(F.regexp_extract(part, r"^&#[xX]0*([0-9A-Fa-f]+);$", 1), F.lit(""))
        numeric = F.coalesce(decimal, F.conv(hexa, 16, 10).try_cast("bigint"))
        return (
            F.when(~part.startswith("&"), part)
            .when(part == "&amp;", "&")
            .when(part.startswith("&#"), F.coalesce(let(numeric, _code_point), part))
            .otherwise(F.coalesce(_named(part), part))
        )

    decoded = F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_PIECE), F.lit(0)), piece), "")
    return F.when(text.contains("&"), decoded).otherwise(text)


# A tag with quoted values, any other thing in angle brackets, a stretch of text, or a bracket that opens nothing.
_TOKEN = r"""</?[A-Za-z](?:[^'">]++|"[^"]*+"|'[^']*+')*+>|<[^>]*>|[^<]+|<"""
_NAME = r"^</?([A-Za-z][^\s/>]*)"
_CLASS = r"""(?i)\sclass\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)"""


def tokens(html: Column) -> Column:
    """The page as an array of (tag, closes, classes, text), in order.

    A tag has its name in lower case and its classes between blanks; a text has NULL as tag, is unescaped and trimmed.
    Comments, scripts and style blocks are left out.
    """
    def name(part: Column) -> Column:
        is_tag = part.startswith("<") & (F.length(part) > 1)
        return F.struct(part.alias("part"), F.when(is_tag, F.lower(F.regexp_extract(part, _NAME, 1))).alias("tag"))

    def read(named: Column) -> Column:
        part, tag = named.part, named.tag
        classes = F.translate(F.regexp_extract(part, _CLASS, 1), "\"'\t\n\f\r", "      ")
        text = F.regexp_replace(unescape(part), r"^[\s\u00a0]+|[\s\u00a0]+$", "")
        return F.struct(
            tag.alias("tag"),
            part.startswith("</").alias("closes"),
            F.when(tag.isin("p", "ul"), F.concat(F.lit(" "), classes, F.lit(" "))).alias("classes"),
            F.when(tag.isNull(), text).alias("text"),
        )

    # Two steps, as an expression named inside a lambda is worked out at each of its uses.
    return F.transform(F.transform(F.regexp_extract_all(visible(html), F.lit(_TOKEN), F.lit(0)), name), read)


def hrefs(html: Column) -> Column:
    """Array of the ``href`` values of all anchors, in page order, unescaped."""
    raw = F.regexp_extract_all(visible(html), F.lit(_HREF), F.lit(1))
    return F.transform(
        raw,
        lambda v: unescape(
            F.trim(F.regexp_replace(v, r"""^(["'])(.*)\1$""", "$2"))
        ),
    )


def authority(url: Column) -> Column:
    """Host with port and user part; empty when the URL has none."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)


def _without_dots(path: Column) -> Column:
    """Path with ``.`` and ``..`` segments resolved; it must start with a slash."""
    segments = F.split(path, "/", -1)
    last = F.element_at(segments, -1)
    tail = F.when(last.isin(".", ".."), F.concat(segments, F.array(F.lit("")))).otherwise(segments)

    def step(done: Column, segment: Column) -> Column:
        shorter = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1)))
        return (
            F.when(segment == "..", shorter)
            .when(segment == ".", done)
            .otherwise(F.concat(done, F.array(segment)))
        )

    start = F.slice(tail, F.lit(1), F.lit(1))
    rest = F.slice(tail, F.lit(2), F.greatest(F.size(tail) - 1, F.lit(0)))
    resolved = F.array_join(F.aggregate(rest, start, step), "/")
    has_dots = path.rlike(r"/\.\.?(/|$)")
    return F.when(has_dots, resolved).otherwise(path)


def resolve(base: Column, href: Column) -> Column:
    """Absolute URL of a link found on the page ``base``."""
    scheme = F.regexp_extract(base, _BASE, 1)
    host = F.regexp_extract(base, _BASE, 2)
    path = F.regexp_extract(base, _BASE, 3)
    query = F.regexp_extract(base, _BASE, 4)
    root = F.concat(scheme, F.lit("://"), host)
    folder = F.when(path.contains("/"), F.regexp_replace(path, r"[^/]*$", "")).otherwise("/")
    href_path = F.regexp_extract(href, r"^([^?#]*)", 1)
    href_rest = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(root, _without_dots(href_path), href_rest))
        .when(href.startswith("?"), F.concat(root, path, href))
        .when(href.startswith("#"), F.concat(root, path, query, href))
        .otherwise(F.concat(root, _without_dots(F.concat(folder, href_path)), href_rest))
    )
