"""Exact duplicates by progressive refinement: length, then a prefix hash, then the hash of the whole text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import unused
from storelens.session import materialize

PREFIX_CHARS = 64
# Size of the tables that say which lengths and which (length, prefix) groups have more than one row.
# They are broadcast: at most FILTER_BITS / 64 rows of 16 bytes, 4 MB. When a corpus fills
# one, more rows get a full hash than need one; the result is the same.
FILTER_BITS = 1 << 23
# A group with more than one in so many of the hashed rows is a frequent one.
HEAVY = 2000


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept`` and the columns of ``carry``.

    Texts are equal when identical; NULL counts as empty text. The row with the largest id of a group stays.
    Rows that repeat both id and text count in ``group_size`` and only one of them is kept. A NULL id is smaller
    than any other. ``carry`` holds expressions over the columns of ``docs`` which must depend on id and text only;
    they are worked out where the text is read, so texts are never shuffled. Other columns of ``docs`` are ignored.
    No rows in, no rows out.
    """
    carry = carry or {}
    sized = docs.select(
        F.col(id_col).alias("id_"), F.coalesce(F.col(text_col), F.lit("")).alias("text_"),
        *[e.alias(f"carry_{n}") for n, e in carry.items()]
    ).withColumn("len_", F.octet_length("text_"))
    by_length = _marked(sized, "same_length_", "len_")
    prefix = F.when(F.col("same_length_"), F.xxhash64(F.substring("text_", 1, PREFIX_CHARS)))
    tested = _marked(by_length.withColumn("prefix_", prefix), "same_prefix_", "len_", "prefix_")
    carried = [F.col(f"carry_{n}").alias(n) for n in carry]
    alone = tested.where("not same_prefix_").select(
        F.col("id_").alias(id_col), F.col("id_").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), *carried,
    )

    full = F.sha2(F.col("text_").cast("binary"), 256)
    hashed = tested.where("same_prefix_").select("id_", "len_", full.alias("full_"), *[f"carry_{n}" for n in carry])
    rows = materialize(hashed.groupBy("id_", "len_", "full_").agg(
        F.count("*").alias("copies_"), *[F.first(f"carry_{n}").alias(f"carry_{n}") for n in carry]
    ))
    met = _with_groups(rows).withColumn("copy_", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies_"))))
    keep = F.when(F.col("size_").isNull(), F.col("id_")).otherwise(F.col("keep_"))
    several = met.select(
        F.col("id_").alias(id_col), keep.alias("keep_id"), F.coalesce("size_", F.lit(1)).cast("long").alias("group_size"),
        (F.col("id_").eqNullSafe(keep) & (F.col("copy_") == 1)).alias("kept"), *carried,
    )
    return alone.unionByName(several)


def _marked(frame: DataFrame, name: str, *keys: str) -> DataFrame:
    """``frame`` with a mark ``name``: whether its row may share ``keys`` with another; never for a NULL key."""
    slot = F.when(F.expr(" and ".join(f"{k} is not null" for k in keys)), F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS)))
    placed = frame.withColumn("slot_", slot).withColumn("word_", F.expr("shiftright(slot_, 6)"))
    shared = placed.where("slot_ is not null").groupBy(*keys, "slot_", "word_").agg(F.count("*").alias("n_")).where("n_ > 1")
    words = shared.groupBy("word_").agg(F.expr("bit_or(shiftleft(1L, cast(slot_ & 63 as int)))").alias("bits_"))
    bit = F.expr("shiftright(bits_, cast(slot_ & 63 as int)) & 1L")
    met = placed.join(F.broadcast(words), "word_", "left").withColumn(name, F.coalesce(bit, F.lit(0)) == 1)
    return met.select(*frame.columns, name)


def _with_groups(rows: DataFrame) -> DataFrame:
    """``rows`` with keep_ and size_ of their group, NULL for a text that stands alone.

    Groups with more than one in HEAVY of all rows are fewer than that and broadcast, so no task gets such a group.
    """
    keys = ["len_", "full_"]
    groups = rows.groupBy(*keys).agg(
        F.max("id_").alias("keep_"), F.sum("copies_").alias("size_"), F.count("*").alias("rows_")).where("size_ > 1")
    total = rows.agg(F.count("*").alias("all_")).select(F.lit(1).alias("one_"), "all_")
    groups = materialize(groups.withColumn("one_", F.lit(1)).join(F.broadcast(total), "one_").select(
        *keys, "keep_", "size_", (F.col("rows_") * HEAVY > F.col("all_")).alias("heavy_")))
    heavy = F.broadcast(groups.where("heavy_").drop("heavy_"))
    rest = rows.join(heavy.select(*keys), keys, "left_anti")
    return rows.join(heavy, keys).unionByName(rest.join(groups.where("not heavy_").drop("heavy_"), keys, "left"))


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_groups`` keeps, with all their columns; of rows with one id and text, one."""
    def digest() -> Column:
        return F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)

    own, stay_id, stay_digest = unused(docs, "own_digest_", "stay_id_", "stay_digest_")
    groups = exact_groups(docs, id_col, text_col, {"digest_": digest()})
    stay = groups.where("kept").select(F.col(id_col).alias(stay_id), F.col("digest_").alias(stay_digest))
    met = docs.withColumn(own, digest()).join(
        stay, (F.col(own) == F.col(stay_digest)) & F.col(id_col).eqNullSafe(F.col(stay_id)), "left_semi"
    )
    return met.dropDuplicates([own, id_col]).select(*docs.columns)
