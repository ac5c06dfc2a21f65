"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storelens.llm.common import salted, stored, uniform, word_count
from storelens.session import materialize

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST_COPIES = 2
# Ranks are counted in so many bins, so only rows of the bins at the cut are put in order.
BINS = 1 << 16
# What a row that is too long leaves open is filled from so many rows behind the cut at once, then from the next ones.
FILL_ROWS = 256
SALTS = 32


def targets(per_source: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST_COPIES) -> DataFrame:
    """Adds ``target`` to one row per ``source`` with its ``source_size``.

    Weights repeat along the sources in code point order, NULL last. The sources share ``share`` times the sum of all
    sizes by weight; a target stops at ``most`` times the size of its source and the excess is shared again by weight,
    until no target is above: all others then stand at one level per weight. The mixture has one row per source, so
    these windows see a table as long as the list of sources.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    index = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (index % len(weights) + 1).cast("int"))
    weighed = per_source.withColumn("weight_", weight).withColumns({
        "cap_": F.col("source_size") * float(most),
        "total_": F.least(F.lit(float(share)), F.lit(float(most))) * F.sum("source_size").over(everything),
    })
    # Sources reach their cap in the order of cap / weight; the first that stays below it sets the level.
    filled = Window.orderBy(F.col("cap_") / F.col("weight_"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    rest = F.sum("weight_").over(everything) - F.coalesce(F.sum("weight_").over(filled), F.lit(0.0))
    level = (F.col("total_") - F.coalesce(F.sum("cap_").over(filled), F.lit(0.0))) / rest
    levels = weighed.withColumn("level_", level).withColumn(
        "fits_", F.col("level_") * F.col("weight_") <= F.col("cap_")
    )
    cut = F.coalesce(
        F.max(F.when(F.col("fits_"), F.col("level_"))).over(everything), F.lit(float("inf"))
    )
    return levels.withColumn("target", F.least(F.col("cap_"), cut * F.col("weight_"))).drop(
        "weight_", "cap_", "total_", "level_", "fits_"
    )


def mix_rows(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", seed=17) -> DataFrame:
    """What the sampling needs of each row: id, source, size in words, a random number and a key that tells rows apart."""
    source, text = F.col(source_col), F.coalesce(F.col(text_col), F.lit(""))
    key = F.xxhash64(F.col(id_col), source.isNull(), source, text)
    return docs.select(
        F.col(id_col).alias("id_"), source.alias("source"), word_count(F.col(text_col)).alias("size"), key.alias("key_"),
        uniform(F.lit(seed), key).alias("u_"),
    )


def _fill(zone: pd.DataFrame) -> pd.DataFrame:
    """Takes the rows at the cut in Pareto order as long as they fit; behind the first that does not, empty rows stay out."""
    zone = zone.sort_values(["rank_", "key_"])
    left, blocked = float(zone["left_"].iloc[0]), False
    taken = []
    for size in zone["words_"]:
        fits = size <= left and not (blocked and size == 0)
        blocked |= size > left
        taken.append(bool(fits))
        left -= size if fits else 0
    return zone.assign(extra_=taken)[["source", "key_", "words_", "extra_"]]


def _beside(frame: DataFrame, table: DataFrame, how: str = "inner") -> DataFrame:
    """Rows with the columns of their source in ``table``, of which every salt has a copy."""
    spread = frame.withColumn("salt_", F.pmod(F.col("key_"), F.lit(SALTS)).cast("int"))
    table = salted(table, SALTS).withColumnRenamed("source", "of_")
    met = spread.join(table, F.col("source").eqNullSafe(F.col("of_")) & (spread["salt_"] == table["salt_"]), how)
    return met.drop("salt_", "of_")


def _cuts(rows: DataFrame, room: str, words: str) -> DataFrame:
    """Sources with more words than room: the bin where it ends (cut_), the room before it (left_) and the last bin of
    FILL_ROWS rows from there (end_)."""
    order = Window.partitionBy("source").orderBy("bin_")
    bins = rows.groupBy("source", "bin_", F.col(room).alias("room_")).agg(
        F.sum(words).alias("words_"), F.count("*").alias("n_")
    ).withColumns({"upto_": F.sum("words_").over(order), "rows_": F.sum("n_").over(order)})
    first = bins.where("upto_ > room_").groupBy("source").agg(
        F.min(F.struct("bin_", "upto_", "words_", "rows_", "n_", "room_")).alias("c_")
    ).select(
        "source", F.col("c_.bin_").alias("cut_"),
        (F.col("c_.room_") - F.col("c_.upto_") + F.col("c_.words_")).alias("left_"),
        (F.col("c_.rows_") - F.col("c_.n_")).alias("before_"),
    )
    ends = bins.select(F.col("source").alias("of_"), "bin_", "rows_").join(
        first.withColumnRenamed("source", "source_"), F.col("of_").eqNullSafe(F.col("source_"))
    ).where(F.col("rows_") >= F.col("before_") + FILL_ROWS).groupBy("of_").agg(F.min("bin_").alias("end_"))
    return materialize(first.join(ends, first["source"].eqNullSafe(ends["of_"]), "left").select(
        "source", "cut_", "left_", F.coalesce("end_", F.lit(BINS)).alias("end_")
    ))


def _room_left(rooms: DataFrame, taken: DataFrame) -> DataFrame:
    """(source, left_) of ``rooms`` less the words taken."""
    used = taken.groupBy(F.col("source").alias("of_")).agg(F.sum("words_").alias("used_"))
    return rooms.join(used, rooms["source"].eqNullSafe(used["of_"]), "left").withColumn(
        "left_", F.col("left_") - F.coalesce("used_", F.lit(0.0))).drop("of_", "used_")


def _filling(units: DataFrame, cuts: DataFrame) -> DataFrame:
    """key_ of the rows from the cut on that are taken: in Pareto order each that fits what the ones before it left.

    A round puts the rows of some bins at the cut in order. Of those behind, the ones longer than the room then left can
    not be taken any more; their bins are counted without them, all before the next cut are taken, and so on until no
    row is left that fits. At last the smallest row not taken is, if that comes nearer.
    """
    columns = "source", "key_", "words_"
    fits, now, found = units, cuts, []
    while True:
        zone = _beside(fits.drop("left_"), now).where("bin_ between cut_ and end_")
        filled = stored(zone.groupBy("source").applyInPandas(
            _fill, "source string, key_ long, words_ double, extra_ boolean"))
        found.append(filled.where("extra_").select(*columns))
        rooms = materialize(_room_left(now.select("source", "left_", F.col("end_").alias("done_")), found[-1]))
        fits = _beside(units, rooms).where("bin_ > done_ and words_ > 0 and words_ <= left_").drop("done_")
        now = _cuts(fits, "left_", "words_")
        before = _beside(fits, now.select("source", "cut_"), "left").where("cut_ is null or bin_ < cut_")
        found.append(stored(before.select(*columns)))
        if now.isEmpty():
            break
    taken = reduce(DataFrame.union, found)
    rest = units.where("words_ > 0").join(taken.select("key_"), "key_", "left_anti").groupBy(
        F.col("source").alias("from_")).agg(F.min(F.struct("words_", "rank_", "key_")).alias("r_"))
    left = _room_left(cuts.select("source", "left_"), taken)
    nearer = left.join(rest, left["source"].eqNullSafe(rest["from_"])).where("r_.words_ - left_ < left_")
    return stored(taken.select("key_").union(nearer.select("r_.key_")))


def mix(rows: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST_COPIES) -> DataFrame:
    """Adds ``source_size``, ``target`` and ``copies`` to rows of ``mix_rows`` (other columns pass through).

    Every row of a source is expected target / source size times. The whole part of that is certain; the fraction p is
    the inclusion probability of one copy more, and the rows of a source are ranked by (u / (1 - u)) / (p / (1 - p)).
    They are taken in that order until the words of the source are used up; a row longer than what is left is passed
    over, and the rows behind it fill the gap, so a source misses its target by half its smallest row left at most. Reruns agree, as u is a hash of the row.
    Rows with the same id, source and text are taken alike. NULL texts have size 0, NULL is a source of its own,
    a source without words has target 0 and no copies. No rows in, no rows out.
    """
    narrow = rows.select("source", "size", "key_", "u_")
    sized = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    shares = targets(sized, weights, share, most)
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(expected + 1e-12).cast("int")
    shares = shares.withColumn("whole_", whole).withColumns({
        "p_": F.greatest(expected - F.col("whole_"), F.lit(0.0)),
    }).withColumn("rest_", F.greatest(F.col("target") - F.col("whole_") * F.col("source_size"), F.lit(0.0)))
    shares = materialize(shares)

    def ranked(frame: DataFrame) -> DataFrame:
        """Rows with their source's figures and Pareto rank; the small side goes to every salt."""
        spread = frame.withColumn("salt_", F.pmod(F.col("key_"), F.lit(SALTS)).cast("int"))
        table = salted(shares, SALTS).withColumnRenamed("source", "of_")
        met = spread.join(table, F.col("source").eqNullSafe(F.col("of_")) & (spread["salt_"] == table["salt_"]))
        odds, inclusion = F.col("u_") / (1 - F.col("u_")), F.col("p_") / (1 - F.col("p_"))
        rank = F.when(F.col("p_") > 0, odds / inclusion).otherwise(F.lit(float("inf")))
        bin_ = F.when(F.col("p_") > 0, F.floor(rank / (1 + rank) * BINS)).otherwise(F.lit(BINS)).cast("int")
        return met.drop("salt_", "of_").withColumn("rank_", rank).withColumn("bin_", bin_)

    cuts = _cuts(ranked(narrow).where("p_ > 0"), "rest_", "size")
    edge = cuts.select("source", "cut_")
    units = stored(_beside(ranked(narrow), edge).where("bin_ >= cut_ and p_ > 0").groupBy(
        "source", "key_", "rank_", "bin_").agg(F.sum("size").cast("double").alias("words_")))
    filled = _filling(units, cuts).select(F.col("key_").alias("zone_key_"), F.lit(True).alias("extra_"))
    marked = _beside(ranked(rows), edge, "left").join(
        filled, (F.col("key_") == F.col("zone_key_")) & F.expr("bin_ >= cut_"), "left"
    )
    before = F.col("cut_").isNull() | (F.col("bin_") < F.col("cut_"))
    more = (F.col("p_") > 0) & (before | F.coalesce("extra_", F.lit(False)))
    return marked.withColumn("copies", F.col("whole_") + more.cast("int")).drop(
        "whole_", "p_", "rest_", "rank_", "bin_", "cut_", "zone_key_", "extra_"
    )


def mixed(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words the mix takes) and copies."""
    rows = materialize(mix_rows(docs))
    return mix(rows).select(
        F.col("id_").alias("doc_id"), "size", "source_size", "target",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"), "copies",
    )


def resample(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with all its columns."""
    payload = F.struct(*[docs[c] for c in docs.columns])
    rows = materialize(mix_rows(docs, id_col, text_col, source_col))
    source, text = F.col(source_col), F.coalesce(F.col(text_col), F.lit(""))
    key = F.xxhash64(F.col(id_col), source.isNull(), source, text)
    kept = docs.select(payload.alias("payload_"), key.alias("key_"))
    copies = mix(rows).where("copies > 0").groupBy("key_").agg(F.max("copies").alias("copies"))
    met = kept.join(copies, "key_")
    return met.withColumn("copy_", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("payload_.*")
