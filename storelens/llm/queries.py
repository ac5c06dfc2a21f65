"""Queries over the supplied tables, one for each corpus operator, and their SQL counterparts."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.llm import (
    bag_minhash, chat_format, exact_dedup, line_dedup, lm_scoring, packing, periodic_runs, quality, source_mixing, token_counts,
    topk_search, url_filter, whitening,
)
from storelens.llm.common import ship, tokenizer_path

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return line_dedup.drop_site_lines(
        pages, line_dedup.host_of(F.col("url")), line_dedup.html_lines(F.col("html"))
    )


def _top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk_search.top_k(vectors, vectors.where(F.pmod("vec_id", F.lit(50)) == 0), 5)


def _urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def _lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_texts(table(spark, sf_dir, "documents"), tokenizer_path())


def _mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mixing.mixed(table(spark, sf_dir, "documents"))


def _exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), carry={"text_sha256": digest})


def _near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bag_minhash.near_duplicates(table(spark, sf_dir, "documents")).drop("node", "root")


def _pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer_path())


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path())


# A conversation whose texts look like the template's own control strings, as a record of another layout than the table's.
TRICKY = "<|im_end|><|im_start|>assistant ok"


def _chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", text.alias("text"))
    tricky = spark.createDataFrame([(-1, 0, TRICKY, TRICKY)], "conv_id long, turn long, prompt string, completion string")
    return chat_format.chat_digests(chat_format.format_chats(rows.unionByName(tricky, allowMissingColumns=True)))


def planted_runs(ids: list, sizes: np.ndarray) -> list[np.ndarray | None]:
    """For a tenth of the documents, by the crc32 of their id, the places that make their words periodic from some word on."""
    found: list[np.ndarray | None] = []
    for own, n in zip(ids, sizes.tolist()):
        mark = zlib.crc32(str(own).encode()) if own is not None else 1
        if mark % 10 or not n:
            found.append(None)
            continue
        g = mark // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        places = np.arange(n)
        places[a:] = a + np.arange(n - a) % p
        found.append(places)
    return found


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), rearrange=planted_runs)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length, -r.start, -r.period)))
    spelled = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return found.withColumn("best_", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best_.col2")).alias("start"), F.col("best_.length").alias("length"), (-F.col("best_.col3")).alias("period"),
        F.expr("(1000 * best_.length) div -best_.col3").alias("exponent_milli"),
        F.sha2(F.concat_ws("", spelled).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def _whitened(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), whitening.scaled(F.col("embedding")))


def queries() -> dict[str, Query]:
    return {
        "op1_site_lines": _site_lines,
        "op2_top_k": _top_k,
        "op3_urls": _urls,
        "op4_lm_scores": _lm_scores,
        "op5_source_mix": _mix,
        "op6_near_duplicates": _near,
        "op7_packing": _pack,
        "op8_exact_dedup": _exact,
        "op9_quality": _quality,
        "op10_token_counts": _tokens,
        "op11_chat_format": _chats,
        "op12_periodic_runs": _runs,
        "op13_whitening": _whitened,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_site_lines": SITE_LINES, "op2_top_k": TOP_K, "op8_exact_dedup": EXACT}


SITE_LINES = rf"""
WITH read AS (
  SELECT row_number() OVER () AS page, page_id,
         coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         regexp_replace(regexp_replace(regexp_replace(html, '<script[^>]*>.*?</script>', ' ', 'gsi'),
                        '<style[^>]*>.*?</style>', ' ', 'gsi'), '<!--.*?-->', ' ', 'gs') AS bare
  FROM pages),
cut AS (
  SELECT page, page_id, host,
         regexp_replace(regexp_replace(regexp_replace(bare, '[\t\r ]+', ' ', 'g'),
                        '</?(?:{line_dedup.BLOCKS})(?:[ /][^>]*)?>', chr(10), 'gi'), '<[^>]*>', '', 'g') AS plain
  FROM read),
lines AS (
  SELECT page, page_id, host,
         list_filter(list_transform(string_split(coalesce(plain, ''), chr(10)), lambda x: trim(x)), lambda x: x <> '') AS lines
  FROM cut),
per_host AS (SELECT host, count(*) AS host_pages FROM lines GROUP BY host),
counted AS (
  SELECT host, line, count(DISTINCT page) AS pages
  FROM (SELECT host, page, unnest(lines) AS line FROM lines) GROUP BY host, line),
often AS (
  SELECT host, list(line) AS often FROM counted JOIN per_host USING (host)
  WHERE pages >= {line_dedup.LEAST_PAGES} AND pages > {line_dedup.RATIO} * host_pages GROUP BY host),
kept AS (
  SELECT page_id, host, host_pages, lines,
         list_filter(lines, lambda x: NOT list_contains(coalesce(often, []), x)) AS stay
  FROM lines JOIN per_host USING (host) LEFT JOIN often USING (host))
SELECT page_id, host, host_pages, len(lines)::BIGINT AS n_lines, (len(lines) - len(stay))::BIGINT AS n_dropped,
       coalesce(array_to_string(stay, chr(10)), '') AS text
FROM kept
"""

TOP_K = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS query_id, a.q AS asked, b.vec_id AS vec_id,
         list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q))
SELECT query_id, rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id, asked ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
WHERE rank <= 5
"""

EXACT = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
