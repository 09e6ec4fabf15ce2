"""Score distributions and the trade-off of rejection thresholds.

Input: (route, positive boolean, score); rows without a score are left out. Places come from range partitions and running sums by
blocks of places, so a class or route that holds nearly all scores is dealt evenly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyra.operators.ranks import global_row_number, prefix_sums
from papyra.shared import written


def describe(scores: DataFrame) -> DataFrame:
    """n, min, p25, median, p75, max by route and class, to four places; p25 and p75 are the values nearest in rank, the
    median is the middle or the mean of the two middle ones. Ranks come from a sort, so no class is collected."""
    ranked = written(global_row_number(scores.where("score is not null").select("route", "positive", "score"), ["route", "positive", "score"], "rank"), "score-ranks")
    groups = ranked.groupBy(F.col("route").alias("r"), F.col("positive").alias("p")).agg(F.min("rank").alias("first"), F.count("*").alias("n"))
    placed = ranked.join(groups, F.col("route").eqNullSafe(F.col("r")) & F.col("positive").eqNullSafe(F.col("p"))).withColumn("i", F.col("rank") - F.col("first"))
    at = lambda p: F.max(F.when(F.col("i") == F.bround(p * (F.col("n") - 1), 0), F.col("score")))
    middle = F.avg(F.when((F.col("i") == F.floor((F.col("n") - 1) / 2)) | (F.col("i") == F.floor(F.col("n") / 2)), F.col("score")))
    figures = {"min": F.min("score"), "p25": at(0.25), "median": middle, "p75": at(0.75), "max": F.max("score")}
    return placed.groupBy("route", "positive").agg(F.count("*").alias("n"), *[F.bround(v, 4).alias(k) for k, v in figures.items()])


def tradeoff(scores: DataFrame) -> DataFrame:
    """Candidates (threshold, lower, false_reject, leak): for each number of leaking negatives the smallest measured score that
    gives it, with the measured score before it. Rejection is strict: a score equal to the threshold passes."""
    per = scores.where("score is not null").groupBy("route", "score").agg(F.count_if("positive").alias("pos"), F.count_if(~F.col("positive")).alias("neg"))
    placed = written(global_row_number(per, ["route", "score"], "place"), "score-places")
    sums = written(prefix_sums(prefix_sums(placed, "place", "pos", "pos_before"), "place", "neg", "neg_before"), "score-sums")
    base = sums.groupBy(F.col("route").alias("r")).agg(F.min("pos_before").alias("pos_first"), F.min("neg_before").alias("neg_first"), F.sum("neg").alias("negs"), F.min("place").alias("first"))
    before = placed.select((F.col("place") + 1).alias("place"), F.col("score").alias("previous"))
    counted = sums.join(base, F.col("route").eqNullSafe(F.col("r"))).join(before, "place", "left")
    counted = counted.select(
        "route", "score", F.when(F.col("place") > F.col("first"), F.col("previous")).alias("lower"), (F.col("pos_before") - F.col("pos_first")).alias("false_reject"),
        (F.col("negs") - (F.col("neg_before") - F.col("neg_first"))).alias("leak"),
    )
    first = counted.groupBy("route", "leak").agg(F.min_by(F.struct("score", "lower", "false_reject"), "score").alias("c"))
    return first.select("route", F.bround("c.score", 4).alias("threshold"), F.bround("c.lower", 4).alias("lower"), "c.false_reject", "leak")


def separability(scores: DataFrame) -> DataFrame:
    """By route: whether every positive is above every negative, then the feasible window and its middle."""
    low, high = F.min(F.when(F.col("positive"), F.col("score"))), F.max(F.when(~F.col("positive"), F.col("score")))
    ends = scores.groupBy("route").agg(F.count("*").alias("n_questions"), low.alias("pos_min"), high.alias("neg_max"))
    apart = F.coalesce(F.col("pos_min") > F.col("neg_max"), F.lit(False))
    note = F.when(F.col("pos_min").isNull() | F.col("neg_max").isNull(), F.lit("one class is missing")).when(apart, F.lit("separable")).otherwise(F.lit("overlapping"))
    return ends.select(
        "route", "n_questions", apart.alias("separable"), F.when(apart, F.bround("neg_max", 4)).alias("window_low"), F.when(apart, F.bround("pos_min", 4)).alias("window_high"),
        F.when(apart, F.bround((F.col("pos_min") + F.col("neg_max")) / 2, 3)).alias("suggested_min_score"), note.alias("note"),
    )


def report(scores: DataFrame) -> DataFrame:
    """One row per route: separability, both distributions and the candidates by falling leak."""
    figures = describe(scores)
    box = F.struct("n", "min", "p25", "median", "p75", "max")
    boxes = figures.groupBy("route").agg(F.max(F.when(F.col("positive"), box)).alias("pos"), F.max(F.when(~F.col("positive"), box)).alias("neg"))
    both = separability(scores).where("note <> 'one class is missing'").select("route")
    candidates = tradeoff(scores).join(both, "route", "left_semi").groupBy("route").agg(F.sort_array(F.collect_list(F.struct((-F.col("leak")).alias("order"), "threshold", "lower", "false_reject", "leak"))).alias("c"))
    listed = F.transform("c", lambda c: F.struct(c["threshold"].alias("threshold"), F.array(c["lower"], c["threshold"]).alias("interval"), c["false_reject"].alias("false_reject"), c["leak"].alias("leak")))
    return separability(scores).join(boxes, "route").join(candidates.select("route", listed.alias("candidates")), "route", "left")
