"""Exact top-k search by inner product: tiled matrix products, partial selection per tile, tree merge."""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows of a tile on either side; a task holds two blocks of vectors and one square of scores.
TILE_ROWS = 2048
# So many tiles' lists of a query are merged in one step of the tree.
FAN_IN = 32

Tile = Callable[[tuple, pa.Table, pa.Table], pa.Table]
_OUT = pa.schema([("query_id", pa.int64()), ("ask_", pa.int64()), ("shard", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])


def quantised(vector: Column) -> Column:
    """Component x as floor(256 * x), x as double; NULL for a vector that is NULL or has a NULL or non-finite component."""
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * 256.0).cast("long"))
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(x))
    return F.when(finite, whole)


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, marks and vectors of a block by ascending id, rows that repeat all once."""
    ids = table.column("vec_id").to_numpy()
    flat = table.column("vector_").combine_chunks().flatten().to_numpy()
    both = np.column_stack([ids, table.column("ask_").to_numpy(), flat.reshape(len(ids), -1)])
    both = np.unique(both, axis=0)
    return both[:, 0], both[:, 1], both[:, 2:]


def _products(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Exact integer inner products; beyond the range of long they stop at its ends."""
    bound = shard.shape[1] * float(np.abs(queries).max(initial=0)) * float(np.abs(shard).max(initial=0))
    if bound < 2.0**53:  # every partial sum is a whole number that a double holds
        return (queries.astype("f8") @ shard.T.astype("f8")).astype(np.int64)
    wide = queries.astype(object) @ shard.T.astype(object)
    return np.clip(wide, -(2**63) + 1, 2**63 - 1).astype(np.int64)


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest scores of each row, the smaller column first among equals."""
    width = scores.shape[1]
    if np.abs(scores).max(initial=0) < 2**62 // (width + 1):
        ranked = scores * width + (width - 1 - np.arange(width))
        if k >= width:
            return np.argsort(-ranked, axis=1)
        part = np.argpartition(-ranked, k - 1, axis=1)[:, :k]
        return np.take_along_axis(part, np.argsort(-np.take_along_axis(ranked, part, 1), axis=1), 1)
    return np.argsort(-scores, axis=1, kind="stable")[:, :k]


def _tile(k: int) -> Tile:
    def search(key: tuple, queries: pa.Table, vectors: pa.Table) -> pa.Table:
        if not queries.num_rows or not vectors.num_rows:
            return _OUT.empty_table()
        query_ids, asks, left = _matrix(queries)
        ids, _, right = _matrix(vectors)
        scores = _products(left, right)
        own = query_ids[:, None] == ids[None, :]
        scores[own] = np.iinfo(np.int64).min // (4 * len(ids))
        best = _best(scores, min(k + int(own.sum(1).max()), len(ids)))
        rows = np.repeat(np.arange(len(query_ids)), best.shape[1])
        columns = best.ravel()
        rest = ~own[rows, columns]
        rows, columns = rows[rest], columns[rest]
        shard = np.full(len(rows), key[2].as_py(), np.int32)
        return pa.table([query_ids[rows], asks[rows], shard, ids[columns], scores[rows, columns]], schema=_OUT)

    return search


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """The ``k`` rows of ``vectors`` with the highest score for each row of ``queries``: query_id, rank, vec_id, score.

    The score is the integer inner product of the quantised vectors. Ties go to the smaller id; a row with the query's
    own id is no candidate. Fewer candidates give fewer rows. Rows take no part when id or vector is NULL or when a
    component is NULL or not finite; vectors are only compared with queries of their own length. Rows that repeat id
    and vector count once; rows of one id with several vectors are queries of their own, with the same query_id, and
    candidates of their own, so an id may stand twice in a list. Other columns are ignored. No rows in, no rows out.

    Queries and vectors are dealt by hash to blocks of about ``tile_rows`` rows; each vector goes to one tile per
    query block and each query to one tile per shard, so a task only ever holds two blocks.
    """
    def clean(frame: DataFrame) -> DataFrame:
        rows = frame.select(F.col(id_col).alias("vec_id"), quantised(F.col(vector_col)).alias("vector_"))
        return rows.where("vec_id is not null and vector_ is not null").withColumn("size_", F.size("vector_")).withColumn(
            "ask_", F.xxhash64("vec_id", "vector_"))

    rows, asked = clean(vectors), clean(queries)
    blocks = max(1, ceil(asked.count() / tile_rows))
    shards = max(1, ceil(rows.count() / tile_rows))
    left = asked.withColumn("block_", F.pmod("ask_", F.lit(blocks)).cast("int")).withColumn(
        "shard_", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    )
    right = rows.withColumn("shard_", F.pmod("ask_", F.lit(shards)).cast("int")).withColumn(
        "block_", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    keys = ["size_", "block_", "shard_"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        _tile(k), "query_id long, ask_ long, shard int, vec_id long, score long"
    )
    while shards > 1:
        shards = ceil(shards / FAN_IN)
        found = _merged(found.withColumn("shard", F.expr(f"shard div {FAN_IN}").cast("int")), k, "query_id", "ask_", "shard")
    return _merged(found, k, "query_id", "ask_").select("query_id", "rank", "vec_id", "score")


def _merged(found: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
