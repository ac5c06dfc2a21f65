"""URL filter: rules first, then the ratio of two variable-order character models of accepted and rejected URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storelens.llm.common import remainder
from storelens.llm.line_dedup import host_of
from storelens.session import materialize

# A gram is a character with up to ORDER characters before it, as text, so no two grams share a number.
ORDER = 5
# These stand before the first and behind the last character of a text.
BEGIN, END = "\x02", "\x03"
# Contexts that a class has seen less often fall back to the next shorter one.
LEAST_SEEN = 2
# One in so many URLs with a rule is left out of the models and sets the threshold.
HELD_OUT = 5
# The threshold is one of so many steps a unit of log-likelihood per character.
STEPS = 100
# Grams that make up more than one in so many of all are fewer than this, so they are broadcast; the others meet by
# shuffle, and none of them is frequent enough to fill a task.
HEAVY = 2000

Rule = tuple[str, str, str]


def path_of(url: Column) -> Column:
    """What stands after the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest of ``rules`` (host, path, verdict) that fits; NULL where none does.

    The list is a parameter of the job. Of rules of one length the first by code point wins, of equal ones block.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1], r[2] != "block"))

    def chain(values: list[str]) -> Column:
        found = F.lit(None).cast("string")
        for (name, start, _), value in reversed(list(zip(ordered, values, strict=True))):
            inside = (host == name) | F.endswith(host, F.lit(f".{name}"))
            found = F.when(inside & F.startswith(path, F.lit(start)), F.lit(value)).otherwise(found)
        return found

    return chain([h + p for h, p, _ in ordered]), chain([v for _, _, v in ordered])


def text_of(url: Column) -> Column:
    """What the models read: all that stands behind the first ``://``, query and fragment too; empty without it."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://(.*)$", 1), F.lit(""))


def _exploded(frame: DataFrame, text: Column) -> DataFrame:
    """Each row once for each character of its text and for its end, with the gram of ORDER + 1 characters up to there."""
    signs = F.concat(F.array_repeat(F.lit(BEGIN), ORDER), F.filter(F.split(text, ""), lambda c: c != ""), F.array(F.lit(END)))
    spelled = frame.withColumn("signs_", signs)
    places = F.sequence(F.lit(1), F.size("signs_") - ORDER)
    found = F.transform(places, lambda i: F.array_join(F.slice("signs_", i, ORDER + 1), ""))
    return spelled.withColumn("gram_", F.explode(found)).drop("signs_")


def log_ratios(counts: DataFrame) -> DataFrame:
    """For every gram_ of ``counts`` the probabilities pa_ and pr_ of its last character and ratio_, log(pa_ / pr_).

    ``counts`` has a row for each gram, with a_ and r_: how often accepted and rejected URLs of the training hold it,
    both 0 for one that only other URLs hold. Witten-Bell smoothing: a class that has seen context c N times with T
    different characters gives (n + T * p') / (N + T), p' from the context that is one character shorter; the shortest
    falls back to 1 / (V + 1) with V characters in the training. A class without training leaves all ratios at 0.

    After the first step there is one row for each gram, so a context or a suffix has no more rows than there are
    different characters.
    """
    shorter = None
    for order in range(ORDER + 1):
        context = Window.partitionBy(F.expr(f"left(g_, {order})"))
        cells = counts.groupBy(F.expr(f"right(gram_, {order + 1})").alias("g_")).agg(
            F.sum("a_").alias("a_"), F.sum("r_").alias("r_"))
        cells = cells.withColumns({
            **{f"{s}n_": F.sum(f"{s}_").over(context) for s in "ar"},
            **{f"{s}t_": F.sum((F.col(f"{s}_") > 0).cast("int")).over(context) for s in "ar"},
        })
        if shorter is None:
            known = F.sum((F.col("a_") + F.col("r_") > 0).cast("int")).over(context)
            cells = cells.withColumns({
                "qa_": 1 / (known + 1), "qr_": 1 / (known + 1), "both_": (F.col("an_") > 0) & (F.col("rn_") > 0),
            })
        else:
            cells = cells.join(shorter, F.expr(f"right(g_, {order})") == F.col("s_")).drop("s_")
        p = {
            s: F.when(
                F.col(f"{s}n_") >= LEAST_SEEN,
                (F.col(f"{s}_") + F.col(f"{s}t_") * F.col(f"q{s}_")) / (F.col(f"{s}n_") + F.col(f"{s}t_")),
            ).otherwise(F.col(f"q{s}_"))
            for s in "ar"
        }
        shorter = cells.select(F.col("g_").alias("s_"), p["a"].alias("qa_"), p["r"].alias("qr_"), "both_")
    ratio = F.when(F.col("both_"), F.log("qa_") - F.log("qr_")).otherwise(0.0)
    return shorter.select(F.col("s_").alias("gram_"), F.col("qa_").alias("pa_"), F.col("qr_").alias("pr_"), ratio.alias("ratio_"))


def _mean_ratios(cells: DataFrame, ratios: DataFrame) -> DataFrame:
    """raw_, the mean ratio of the grams of each key_; ``ratios`` says for each gram whether it is heavy_."""
    heavy = F.broadcast(ratios.where("heavy_").select("gram_", "ratio_"))  # fewer than HEAVY rows
    sums = [F.sum("ratio_").alias("sum_"), F.count("*").alias("n_")]
    often = cells.join(heavy, "gram_").groupBy("key_").agg(*sums)
    rest = cells.join(heavy.select("gram_"), "gram_", "left_anti")
    seldom = rest.join(ratios.where("not heavy_").select("gram_", "ratio_"), "gram_").groupBy("key_").agg(*sums)
    both = often.unionByName(seldom).groupBy("key_").agg(F.sum("sum_").alias("sum_"), F.sum("n_").alias("n_"))
    return both.select("key_", F.round(F.col("sum_") / F.col("n_"), 9).alias("raw_"))


def judge_urls(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict, and score, the calibrated log ratio per character.

    The longest rule that fits decides. All other URLs are scored by two character models, one of the URLs the rules
    accept and one of those they reject (whole, but for the scheme); at or above the threshold is allowed. A held-out
    part of the URLs with a rule sets the threshold where the two error rates have the least sum. With no URL of a
    class the models tell nothing and the verdict is allow. NULL and texts without ``://`` have empty host and path.
    Repeated rows are judged alike and learned from as often as they are there. Other columns are ignored. No rows in,
    no rows out.

    A URL becomes one row per character. Grams are counted with partial sums; their ratios come back to the URLs by
    shuffle, but for the frequent ones, which are bounded in number and broadcast.
    """
    read = pages.groupBy(F.col(id_col).alias("id_"), F.col(url_col).alias("url_")).agg(F.count("*").alias("copies_"))
    read = read.withColumns({
        "host_": host_of(F.col("url_")), "path_": path_of(F.col("url_")),
        "key_": F.md5(F.to_json(F.struct("id_", "url_"), {"ignoreNullFields": "false"}).cast("binary")),
    })
    rule, verdict = matched_rule(F.col("host_"), F.col("path_"), rules)
    read = materialize(read.withColumns({
        "rule_": rule, "by_rule_": verdict, "learn_": verdict.isNotNull() & (remainder(F.col("id_"), HELD_OUT) != 0),
    }))
    cells = _exploded(read.select("key_", "url_", "copies_", "by_rule_", "learn_"), text_of(F.col("url_")))
    learned = F.when(F.col("learn_"), F.col("copies_")).otherwise(0)
    counts = materialize(cells.groupBy("gram_").agg(
        F.sum(F.when(F.col("by_rule_") == "allow", learned).otherwise(0)).alias("a_"),
        F.sum(F.when(F.col("by_rule_") == "block", learned).otherwise(0)).alias("r_"),
        F.count("*").alias("n_"),
    ))
    total = counts.agg(F.sum("n_").alias("all_")).select(F.lit(1).alias("one_"), "all_")
    heavy = counts.withColumn("one_", F.lit(1)).join(F.broadcast(total), "one_").select(
        "gram_", (F.col("n_") * HEAVY > F.col("all_")).alias("heavy_"))
    ratios = materialize(log_ratios(counts).join(heavy, "gram_").select("gram_", "ratio_", "heavy_"))
    raw = _mean_ratios(cells.select("key_", "gram_"), ratios)
    scored = materialize(read.join(raw, "key_"))
    threshold = materialize(_threshold(scored.where("by_rule_ is not null and not learn_")))
    score = F.col("raw_") - F.col("threshold_")
    judged = scored.withColumn("one_", F.lit(1)).join(F.broadcast(threshold), "one_").withColumn("score", score)
    return judged.withColumn("copy_", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies_")))).select(
        F.col("id_").alias(id_col), F.col("host_").alias("host"), F.col("path_").alias("path"),
        F.col("rule_").alias("rule"),
        F.coalesce("by_rule_", F.when(F.col("score") >= 0, "allow").otherwise("block")).alias("verdict"), "score",
    )


def _threshold(known: DataFrame) -> DataFrame:
    """One row: the step with the least sum of both error rates, the nearest to 0 of several; 0 without both classes."""
    good = (F.col("by_rule_") == "allow").cast("int")
    steps = known.groupBy(F.floor(F.col("raw_") * STEPS).alias("step_")).agg(
        F.sum(good).alias("good_"), F.sum(1 - good).alias("bad_")
    )
    # Ratios of probabilities that are no smaller than smoothing leaves them: some thousand steps.
    below, everything = Window.orderBy("step_").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    error = (
        F.coalesce(F.sum("good_").over(below), F.lit(0)) / F.sum("good_").over(everything)
        + 1 - F.coalesce(F.sum("bad_").over(below), F.lit(0)) / F.sum("bad_").over(everything)
    )
    both = (F.sum("good_").over(everything) > 0) & (F.sum("bad_").over(everything) > 0)
    rated = steps.withColumn("error_", F.when(both, error)).where("error_ is not null")
    best = rated.agg(F.min(F.struct("error_", F.abs("step_"), "step_")).alias("best_"))
    return best.select(F.lit(1).alias("one_"), F.coalesce(F.col("best_.step_") / STEPS, F.lit(0.0)).alias("threshold_"))
