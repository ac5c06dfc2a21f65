"""Token counts of whole texts by a compiled counting transducer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.byte_bpe import CountingTransducer, Pretokens, Vocabulary
from storelens.llm.common import held, slices, texts_of

SLICE_BYTES = 3_000_000


def transducer(path: str) -> CountingTransducer:
    """One for each worker process and vocabulary file."""
    return held(("transducer", path), lambda: CountingTransducer(Vocabulary(path)))


def count_batch(texts: pa.Array, machine: CountingTransducer) -> np.ndarray:
    special = machine.vocabulary.special
    found = Pretokens(texts, special)
    counts = np.fromiter(
        (1 if w == special else machine.count(w) for w in found.distinct), np.int64, len(found.distinct)
    )
    return found.totals(counts)


def token_counts(
    docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > ``limit``).

    ``path`` is a byte-level BPE file whose counts are given as its library gives them: without added tokens, the
    special string inside a text as one token. NULL counts as empty text, which has no tokens. Repeated rows are
    counted each, ids may be NULL, other columns are ignored. No rows in, no rows out. Nothing is shuffled; a text is
    read in chunks side by side, whatever its length.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in slices(batches, "text", SLICE_BYTES):
            counts = count_batch(texts_of(batch.column("text")), machine)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_bytes"), pa.array(counts), pa.array(counts > limit)],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    read = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(text_col).alias("text"),
    )
    kind = read.schema["id"].dataType.simpleString()
    return read.mapInArrow(count, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
