"""Best-fit packing of tokenised documents: planned over the histogram of lengths, then joined by rank within length."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storelens.llm.byte_bpe import Encoder, Pretokens, gathered
from storelens.llm.common import held, slices, texts_of
from storelens.session import materialize

SEQUENCE = 2048
END_ID = 0
SPECIAL = b"<|endoftext|>"
SLICE_BYTES = 4_000_000
# Spelled pre-tokens a worker keeps; with fewer it needs less memory and spells rare ones again.
KEPT = 600_000
# Ranks within a length are counted in so many parts, so a frequent length is spread over tasks.
PARTS = 512


def encoder(path: str, kept: int = KEPT) -> Encoder:
    """One for each worker process and vocabulary file."""
    return held(("encoder", path, kept), lambda: Encoder(path, kept))


def token_ids(texts: pa.Array, tokens: Encoder, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, each text with ``end_id`` behind it, and where the texts end."""
    found = Pretokens(texts, SPECIAL)
    flat, begins, lengths = tokens.ids(found.distinct)
    ends = np.cumsum(found.totals(lengths)) if len(texts) else np.zeros(0, np.int64)
    stream = gathered(flat, begins[found.codes], lengths[found.codes]).astype(np.uint32)
    return np.insert(stream, ends, end_id), ends + np.arange(1, len(texts) + 1)


def pieces_of(
    docs: DataFrame, path: str, size: int = SEQUENCE, id_col: str = "doc_id", text_col: str = "text",
    with_ids: bool = False, kept: int = KEPT, slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Rows (id, piece, start, length, ids_crc32 and with ``with_ids`` the ids) of at most ``size`` tokens.

    Only longer documents are cut: into pieces of ``size`` tokens, of which the first may be shorter.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path, kept)
        for batch in slices(batches, "text", slice_bytes):
            stream, ends = token_ids(texts_of(batch.column("text")), tokens)
            begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            lengths = ends - begins
            number = -(-lengths // size)
            row = np.repeat(np.arange(len(ends)), number)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
            first = lengths - (number - 1) * size
            start = np.where(piece == 0, 0, first[row] + (piece - 1) * size)
            length = np.where(piece == 0, first[row], size)
            at = begins[row] + start
            words = stream.astype("<u4")
            crcs = [zlib.crc32(words[a:a + n].tobytes()) for a, n in zip(at.tolist(), length.tolist())]
            columns = [
                batch.column("id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(length, pa.int64()), pa.array(crcs, pa.int64()),
            ]
            names = [id_col, "piece", "start", "length", "ids_crc32"]
            if with_ids:
                stops = np.append(at, len(stream)).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(stops), pa.array(stream.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = read.schema["id"].dataType.simpleString()
    ids = ", ids array<int>" if with_ids else ""
    return read.mapInArrow(cut, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long{ids}")


def plan_best_fit(counts: dict[int, int], size: int = SEQUENCE) -> list[tuple[int, int, int, int, int]]:
    """Slots for ``counts`` pieces of each length: (length, first rank, number, first sequence, offset).

    Long pieces first; each goes to the sequence with the least room that holds it. Sequences with the same room are
    one group, so the work and the plan grow with the number of lengths, not of pieces. The piece of rank
    first rank + n goes to sequence first sequence + n.
    """
    plan: list[tuple[int, int, int, int, int]] = []
    groups: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []
    opened = 0

    def put(room: int, start: int, number: int) -> None:
        if room and number:
            if room not in groups:
                groups[room] = []
                insort(rooms, room)
            groups[room].append((start, number))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            place = bisect_left(rooms, length)
            if place < len(rooms):
                room = rooms[place]
                start, number = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[place]
            else:
                room, start = size, opened
                number = -(-left // (size // length))
                opened += number
            each = room // length
            full = min(number, left // each)
            part = left - full * each if full < number else 0
            for layers, begin, many in ((each, start, full), (part, start + full, 1)):
                for layer in range(layers if many else 0):
                    plan.append((length, rank, many, begin, size - room + layer * length))
                    rank += many
            put(room - each * length, start, full)
            if part:
                put(room - part * length, start + full, 1)
            put(room, start + full + bool(part), number - full - bool(part))
            left -= full * each + part
    return plan


def pack(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """Adds sequence_id and offset to rows with ``length`` (1 to ``size``); all other columns pass through.

    The rank of a row within its length is its place within a part (a hash of the row) plus the rows of the parts
    before, so no task gets a whole length. The histogram has at most ``size`` rows and the plan is a small multiple
    of that, so both fit the driver and every task.
    """
    names = pieces.columns
    others = [c for c in names if c != "ids"]
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = np.array(sorted(plan_best_fit(counts, size)), np.int64).reshape(-1, 5)
    shift = 40
    keys = (plan[:, 0] << shift) + plan[:, 1]
    parted = pieces.withColumn("part_", F.pmod(F.xxhash64(*others), F.lit(PARTS)).cast("int"))
    before = Window.partitionBy("length").orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    parts = parted.groupBy("length", "part_").agg(F.count("*").alias("n_")).select(
        "length", "part_", F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("before_")
    )
    place = F.row_number().over(Window.partitionBy("length", "part_").orderBy(*others))
    ranked = parted.join(parts, ["length", "part_"]).withColumn("rank_", F.col("before_") + place - 1)
    ranked = ranked.select(*names, "rank_")

    def slot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy().astype(np.int64) for c in ("length", "rank_"))
            found = plan[np.searchsorted(keys, (length << shift) + rank, "right") - 1]
            own = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(found[:, 3] + rank - found[:, 1]), pa.array(found[:, 4])],
                names=[*names, "sequence_id", "offset"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(slot, f"{schema}, sequence_id long, offset long")


def packed(
    docs: DataFrame, path: str, size: int = SEQUENCE, kept: int = KEPT, slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Documents as pieces with their place in sequences of at most ``size`` tokens.

    doc_id, piece, start, length, ids_crc32, sequence_id, offset. NULL counts as empty text, which is one piece with
    the end token. Repeated rows are packed each, ids may be NULL, other columns are ignored. No rows in, no rows out.
    """
    return pack(materialize(pieces_of(docs, path, size, kept=kept, slice_bytes=slice_bytes)), size)
