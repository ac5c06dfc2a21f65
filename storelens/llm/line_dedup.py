"""Site-relative line removal: lines that stand on too large a part of a host's pages are boilerplate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import salted

# A line goes when it stands on more than this part of the pages of its host ...
RATIO = 0.3
# ... and on so many of them at least, so that hosts with a few pages keep their text.
LEAST_PAGES = 3
SALTS = 32
BLOCKS = (
    "address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|head|header|hr|html|li|"
    "main|nav|ol|option|p|pre|section|select|table|td|th|title|tr|ul"
)


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def html_lines(html: Column) -> Column:
    """The visible lines of a page: text between block tags, without scripts, styles, comments and inline tags."""
    bare = html
    for name in ("script", "style"):
        bare = F.regexp_replace(bare, f"(?is)<{name}[^>]*>.*?</{name}>", " ")
    bare = F.regexp_replace(bare, "(?s)<!--.*?-->", " ")
    broken = F.regexp_replace(F.regexp_replace(bare, "[\\t\\r ]+", " "), f"(?i)</?(?:{BLOCKS})(?:[ /][^>]*)?>", "\n")
    return text_lines(F.regexp_replace(broken, "<[^>]*>", ""))


def text_lines(text: Column) -> Column:
    """Lines without blanks around them; empty ones are left out."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(x)), lambda x: x != "")


def drop_site_lines(
    pages: DataFrame, host: Column, lines: Column, id_col: str = "page_id", ratio: float = RATIO,
    least_pages: int = LEAST_PAGES, salts: int = SALTS,
) -> DataFrame:
    """One row per page: id, host, host_pages, n_lines, n_dropped and text, the lines left joined by line ends.

    ``host`` and ``lines`` are expressions over ``pages``. A line of a host goes where it stands on more than ``ratio``
    of its pages and on ``least_pages`` at least; a line that repeats within a page counts once for it. NULL hosts
    form one site, as the empty host does; a page without lines counts as a page and gives empty text. Repeated rows
    are pages of their own. Other columns of ``pages`` are ignored. No rows in, no rows out.

    Lines are counted as (host, hash) with partial sums and held against the ratio by host and salt, so a host with a
    third of all pages is spread over tasks. At most (mean lines per page) / ``ratio`` lines of a host can be boilerplate, so they fit one short array per host,
    and pages meet it by host and salt.
    """
    read = pages.select(F.col(id_col), F.coalesce(host, F.lit("")).alias("host_"), lines.alias("lines_"))
    hashed = read.select("host_", F.explode(
        F.array_distinct(F.transform("lines_", lambda x: F.xxhash64(x)))
    ).alias("line_"))
    counts = hashed.groupBy("host_", "line_").agg(F.count("*").alias("on_")).where(F.col("on_") >= least_pages)
    totals = read.groupBy("host_").agg(F.count("*").alias("pages_"))
    dealt = counts.withColumn("salt_", F.pmod("line_", F.lit(salts)).cast("int"))
    over = dealt.join(salted(totals, salts), ["host_", "salt_"]).where(F.col("on_") > ratio * F.col("pages_"))
    often = totals.join(over.groupBy("host_").agg(F.collect_list("line_").alias("often_")), "host_", "left")
    often = often.withColumn("often_", F.coalesce("often_", F.array().cast("array<bigint>")))
    spread = read.withColumn("salt_", F.pmod(F.xxhash64(id_col), F.lit(salts)).cast("int"))
    met = spread.join(salted(often, salts), ["host_", "salt_"])
    kept = F.filter("lines_", lambda x: ~F.array_contains("often_", F.xxhash64(x)))
    return met.withColumn("kept_", kept).select(
        F.col(id_col), F.col("host_").alias("host"), F.col("pages_").alias("host_pages"),
        F.size("lines_").cast("long").alias("n_lines"),
        (F.size("lines_") - F.size("kept_")).cast("long").alias("n_dropped"), F.array_join("kept_", "\n").alias("text"),
    )
