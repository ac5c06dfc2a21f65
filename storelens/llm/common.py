"""Small expressions and helpers the corpus operators share."""

from __future__ import annotations

import ctypes
import gc
import shutil
import tempfile
import time
import uuid
from collections.abc import Callable, Hashable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.session import ensure_checkpoint_dir

# White space of the corpus contracts: blank and U+0009 to U+000D.
NOT_BLANK = "[^\\x20\\x09-\\x0D]+"


def word_count(text: Column) -> Column:
    """Number of runs of characters that are not white space; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(NOT_BLANK)), F.lit(0)).cast("long")


def uniform(*columns: Column) -> Column:
    """A number in (0, 1) worked out from the columns, the same in every run."""
    return (F.pmod(F.xxhash64(*columns), F.lit(1 << 52)) + 0.5) / float(1 << 52)


def remainder(column: Column, modulus: int) -> Column:
    """crc32 of the value as text, mod ``modulus``; NULL counts as empty text."""
    text = F.coalesce(column.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(modulus))


def unused(frame: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores more as make it no column of ``frame``."""
    taken, found = {c.lower() for c in frame.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def salted(table: DataFrame, salts: int, name: str = "salt_") -> DataFrame:
    """Each row of a small table once for each salt, to meet a side spread by the same salt."""
    return table.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Cuts batches into runs of rows whose ``column`` holds about ``most`` bytes; a longer row stands alone."""
    for batch in batches:
        sizes = [len(v) if v is not None else 0 for v in _views(batch.column(column))]
        start = held = 0
        for row, size in enumerate(sizes):
            if row > start and held + size > most:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if batch.num_rows > start:
            yield batch.slice(start)
    give_back()


def _views(column: pa.Array) -> Iterator[memoryview | None]:
    """The stored bytes of a text column, row by row, without decoding them."""
    column = column.cast(pa.large_binary())
    offsets = memoryview(column.buffers()[1]).cast("q")[column.offset:column.offset + len(column) + 1]
    data = memoryview(column.buffers()[2] or b"")
    for row in range(len(column)):
        yield data[offsets[row]:offsets[row + 1]]


_held: dict[Hashable, object] = {}


def held(key: Hashable, make: Callable[[], object]) -> object:
    """What a worker process keeps from task to task; another operator's things go when a new one begins."""
    if key not in _held:
        _held.clear()
        gc.collect()
        give_back()
        _held[key] = make()
    return _held[key]


def give_back() -> None:
    """Returns what a finished task no longer uses to the system, as the worker process lives on beside others."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def texts_of(column: pa.Array) -> pa.Array:
    """Texts with NULL as empty text."""
    return column.cast(pa.large_string()).fill_null("")


ARROW_ROWS = 1000


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the installed package of public tokenizers keeps a file; it is there on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def release(spark: SparkSession, again: int = 0) -> None:
    """Lets Spark delete shuffle files of steps that are done: it does so for what neither Python nor the driver refers to.

    Python's references reach the driver up to a second late, and what served collected rows goes with the collection after
    that: then it takes ``again`` more times, half a second apart.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    for _ in range(again):
        time.sleep(0.5)
        spark.sparkContext._jvm.System.gc()


def ship(spark: SparkSession) -> None:
    """Hands the package to the Python workers once a session, for clusters on which it is not installed."""
    context = spark.sparkContext
    # Texts are long: what a worker and the buffers beside it hold follows the rows of a batch.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    if not getattr(context, "_storelens_shipped", False):
        root = Path(__file__).resolve().parent.parent
        name = f"{tempfile.mkdtemp()}/storelens"
        context.addPyFile(shutil.make_archive(name, "zip", root.parent, root.name))
        context._storelens_shipped = True


# Size of the table behind ``maybe_in``: at most FILTER_BITS / 64 rows of 16 bytes, 4 MB, so it is broadcast.
FILTER_BITS = 1 << 23


def maybe_in(frame: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``frame`` whose ``key`` is in ``keys``, and a few others: nothing but a bit table is moved for it.

    Keys are hashed to bits. With more keys than bits all rows pass, so an exact semi join has to follow.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    words = keys.select(slot.alias("slot_")).groupBy(F.expr("shiftright(slot_, 6)").alias("word_")).agg(
        F.expr("bit_or(shiftleft(1L, cast(slot_ & 63 as int)))").alias("bits_"))
    placed = frame.withColumn("slot_", slot).withColumn("word_", F.expr("shiftright(slot_, 6)"))
    met = placed.join(F.broadcast(words), "word_")
    return met.where("(shiftright(bits_, cast(slot_ & 63 as int)) & 1L) = 1").select(*frame.columns)


def stored(frame: DataFrame) -> DataFrame:
    """The rows as a compressed table in the folder all executors share, for what is read several times."""
    spark = frame.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/stored-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Deletes what ``stored`` wrote for ``table``, once no step to come reads it."""
    spark = table.sparkSession
    for folder in {name.rpartition("/")[0] for name in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
