"""Near duplicates by BagMinHash signatures of word shingles, bands and an exact check of multiset overlap."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import held, maybe_in, release, slices, texts_of, unused
from storelens.llm.components import components
from storelens.llm.word_shingles import mixed, shingle_sets
from storelens.session import materialize

SIMILAR = 0.8
BANDS, ROWS = 32, 5
SLICE_BYTES = 2_000_000
# Buckets of at most so many texts give all their pairs; of larger ones each text is first held against one of them.
SMALL = 6
# Texts of a block when what is left of a large bucket is compared block by block.
BLOCK = 1024
_UNIT = 1 / (1 << 53)


def _uniform(state: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of a process and step, and a number in (0, 1) from it."""
    value = mixed(state + np.uint64(0x9E3779B97F4A7C15 * step % 2**64))
    return value, ((value >> np.uint64(11)) + 0.5) * _UNIT


def signatures(row: np.ndarray, value: np.ndarray, weight: np.ndarray, rows: int, size: int) -> np.ndarray:
    """Weighted-Jaccard signatures, ``rows`` x ``size``; rows without shingles keep the largest number.

    The weights above 0 are cut into the levels (0, 1], (1, 2], (2, 4] ... and a shingle has for each level up to its
    weight a Poisson process whose rate is the level's width. A point of a process has a time, a register and a weight
    within the level, all hashes of shingle and level; it counts where that weight is no more than the shingle's. A
    register holds the first point, so two rows agree in it with the probability sum of minima / sum of maxima.

    A row with total weight W has its registers filled by about size * (log(size) + 7) / W; processes are followed only
    up to there, and the few rows with a register still open are followed twice as long.
    """
    best = np.full(rows * size, np.iinfo(np.uint64).max, np.uint64)
    total = np.bincount(row, weight, rows)
    limit = np.where(total > 0, size * (np.log(size) + 7) / np.maximum(total, 1), 0)
    todo = total > 0
    while todo.any():
        used = todo[row]
        _follow(best, row[used], value[used], weight[used], limit, size)
        todo = (best.reshape(rows, size) == np.iinfo(np.uint64).max).any(1) & (total > 0)
        limit = limit * 2
    return best.reshape(rows, size)


def _follow(best, row, value, weight, limit, size) -> None:
    low, high, level = 0, 1, 0
    while len(row):
        state = mixed(value ^ np.uint64(0xD1B54A32D192ED03 + level))
        at, owner, most = np.zeros(len(row)), row, weight
        step = 0
        while len(owner):
            _, u = _uniform(state, 2 * step + 1)
            at = at - np.log(u) / (high - low)
            open_ = at <= limit[owner]
            at, owner, state, most = at[open_], owner[open_], state[open_], most[open_]
            point, v = _uniform(state, 2 * step + 2)
            counts = low + v * (high - low) <= most
            cell = owner[counts] * size + (point[counts] % np.uint64(size)).astype(np.int64)
            stamp = at[counts].astype(np.float32).view(np.uint32).astype(np.uint64)
            np.minimum.at(best, cell, (stamp << np.uint64(32)) | (mixed(point[counts]) >> np.uint64(32)))
            step += 1
        low, high, level = high, 2 * high, level + 1
        deeper = weight > low
        row, value, weight = row[deeper], value[deeper], weight[deeper]


def text_key(text: Column) -> Column:
    """128 bits of a hash that tells texts apart; NULL counts as empty text."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)), 1, 16)


def band_keys(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Puts ``bands`` in the place of ``text`` in rows (id, node, text); no bands without words."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("signatures", dict)
        for batch in slices(batches, "text", SLICE_BYTES):
            texts = texts_of(batch.column("text"))
            row, value, weight = shingle_sets(texts)
            found = signatures(row, value, weight, len(texts), bands * rows).reshape(len(texts), bands, rows)
            keys = np.zeros((len(texts), bands), np.uint64)
            for n in range(rows):
                keys = mixed(keys + found[:, :, n] * np.uint64(0xC2B2AE3D27D4EB4F))
            some = np.bincount(row, minlength=len(texts)) > 0
            offsets = np.concatenate([[0], np.cumsum(some * bands)]).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[some].ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("node"), listed], names=["id", "node", "bands"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(sign, f"id {kind}, node binary, bands array<long>")


def shingle_arrays(docs: DataFrame) -> DataFrame:
    """(node, items): each shingle of a text once for each of its copies in it, as different numbers."""
    def items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("signatures", dict)
        for batch in slices(batches, "text", SLICE_BYTES):
            texts = texts_of(batch.column("text"))
            row, value, weight = shingle_sets(texts)
            copy = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
            numbers = mixed(np.repeat(value, weight) + copy.astype(np.uint64))
            ends = np.cumsum(np.bincount(row, weight, len(texts)).astype(np.int64))
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(numbers.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("node"), listed], names=["node", "items"])

    return docs.mapInArrow(items, "node binary, items array<long>")


def _verified(pairs: DataFrame, items: DataFrame, similar: float) -> DataFrame:
    """The pairs (a, b) whose multisets overlap enough."""
    left = items.select(F.col("node").alias("a"), F.col("items").alias("x_"))
    right = items.select(F.col("node").alias("b"), F.col("items").alias("y_"))
    common = F.size(F.array_intersect("x_", "y_"))
    met = pairs.join(left, "a").join(right, "b")
    return met.where(common >= similar * (F.size("x_") + F.size("y_") - common) - 1e-9).select("a", "b")


def _links_between(similar: float):
    """Of two blocks of a bucket: one link from each text to each other component that it is similar to."""
    out = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def compare(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return out.empty_table()
        roots = pa.concat_arrays([t.column("root").combine_chunks() for t in (left, right)]).dictionary_encode().indices
        own, other = np.split(roots.to_numpy(), [left.num_rows])
        lists = [t.column("items").combine_chunks() for t in (left, right)]
        coded = pa.concat_arrays([x.flatten() for x in lists]).dictionary_encode()
        codes = coded.indices.to_numpy()
        split = len(lists[0].flatten())
        x_at, y_at = (x.offsets.to_numpy() - x.offsets[0].as_py() for x in lists)
        xs, ys = codes[:split], codes[split:]
        x_size, y_size = np.diff(x_at), np.diff(y_at)
        mark = np.zeros(len(coded.dictionary), np.int32)
        a, b = [], []
        for n in range(left.num_rows):
            if (other == own[n]).all():
                continue
            mark[xs[x_at[n]:x_at[n + 1]]] = 1
            common = np.add.reduceat(mark[ys], y_at[:-1]) if len(ys) else np.zeros(0, np.int32)
            mark[xs[x_at[n]:x_at[n + 1]]] = 0
            near = (common >= similar * (x_size[n] + y_size - common) - 1e-9) & (other != own[n])
            hits = np.flatnonzero(near)
            _, first = np.unique(other[hits], return_index=True)
            a += [n] * len(first)
            b += hits[first].tolist()
        return pa.table([left.column("node").take(a), right.column("node").take(b)], schema=out) if a else out.empty_table()

    return compare


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: float = SIMILAR,
) -> DataFrame:
    """One row per row of ``docs``: id, class_id (smallest id of its class), class_size (its rows), node, root.

    node is ``text_key`` of the row and root one node of its class.

    Two texts are linked when the multisets of their five-word shingles overlap by ``similar`` or more (sum of minima /
    sum of maxima); classes are the connected components of the links. Equal texts are copies of each other; a NULL
    text is an empty one; a text of less than five words has one shingle, one without words is only linked to equal
    texts. A NULL id is no smallest id unless a class has no other. Repeated rows are in one class. Other columns are
    ignored. No rows in, no rows out.

    Signatures find pairs of that similarity with a probability of 1 - 3e-6 per pair at exactly 0.8, more above. Equal
    texts are one node from the start. A large bucket is first held against its member with the most neighbours; the
    texts that are then in different components are compared block by block inside the tasks, which give back one link
    per text and component instead of all pairs.
    """
    read = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("node"), F.col(text_col).alias("text"))
    rows = materialize(band_keys(read))
    nodes = rows.groupBy("node").agg(F.min("id").alias("least_"), F.count("*").alias("rows_"), F.first("bands").alias("bands"))
    entries = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    sized = entries.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
    members = materialize(entries.join(sized, ["band", "key"]))
    release(docs.sparkSession)

    # The text whose buckets hold the most others is the one the others most likely come from.
    load = members.groupBy("node").agg(F.sum("n").alias("load"))
    ranked = members.join(load, "node")
    pivots = ranked.groupBy("band", "key").agg(F.max(F.struct("load", "node"))["node"].alias("pivot"))
    star = members.join(pivots, ["band", "key"]).where("node <> pivot").select(
        F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
    mates = members.where(F.col("n") <= SMALL).groupBy("band", "key").agg(F.sort_array(F.collect_list("node")).alias("m"))
    mates = mates.where(F.size("m") > 2).select(F.explode("m").alias("a"), "m").select("a", F.explode("m").alias("b"))
    pairs = materialize(star.unionByName(mates.where("a < b")).distinct())

    items = materialize(_items(read, members))
    links = materialize(_verified(pairs, items, similar))
    release(docs.sparkSession)
    roots = components(links)
    release(docs.sparkSession)
    rest = _left_over(members.where(F.col("n") > SMALL), roots, items, similar)
    if not rest.isEmpty():
        roots = components(links.unionByName(rest))

    placed = nodes.select("node", "least_", "rows_").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    classes = placed.groupBy("root").agg(F.min("least_").alias("class_id"), F.sum("rows_").alias("class_size"))
    named = placed.select("node", "root").join(classes, "root")
    return rows.select("id", "node").join(named, "node").select(
        F.col("id").alias(id_col), "class_id", F.col("class_size").cast("long").alias("class_size"), "node", "root")


def _items(read: DataFrame, members: DataFrame) -> DataFrame:
    """Shingles of the texts that share a bucket with another one; each text once."""
    wanted = materialize(members.select("node").distinct())
    arrays = shingle_arrays(maybe_in(read, wanted, "node"))
    return arrays.join(wanted, "node", "left_semi").dropDuplicates(["node"])


def _left_over(members: DataFrame, roots: DataFrame, items: DataFrame, similar: float) -> DataFrame:
    """Links between texts of one large bucket that are in different components so far."""
    placed = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed_ = placed.groupBy("band", "key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("size"))
    mixed_ = mixed_.where("lo <> hi").select("band", "key", "size")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    left = placed.select("node", "root", "band", "key").join(mixed_, ["band", "key"]).withColumn("blocks", blocks)
    left = left.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).drop("size")
    left = materialize(left).join(items, "node")
    spread = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    one = left.withColumn("i", F.col("own")).withColumn("j", spread).where("j >= i")
    two = left.withColumn("j", F.col("own")).withColumn("i", spread).where("j >= i")
    keys = ["band", "key", "i", "j"]
    columns = [F.col(c).alias(c) for c in (*keys, "node", "root", "items")]
    found = one.select(*columns).groupBy(*keys).cogroup(two.select(*columns).groupBy(*keys)).applyInArrow(
        _links_between(similar), "a binary, b binary")
    return materialize(found.distinct())


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class stays, the one with the smallest id; of rows that repeat id and text, one."""
    node, stay_id, stay_node = unused(docs, "own_node_", "stay_id_", "stay_node_")
    classes = near_duplicates(docs, id_col, text_col).where(F.col(id_col).eqNullSafe(F.col("class_id")))
    first = classes.groupBy("root", F.col("class_id").alias(stay_id)).agg(F.min("node").alias(stay_node)).drop("root")
    own = docs.withColumn(node, text_key(F.col(text_col)))
    met = own.join(first, F.col(id_col).eqNullSafe(F.col(stay_id)) & (F.col(node) == F.col(stay_node)), "left_semi")
    return met.dropDuplicates([id_col, node]).select(*docs.columns)
