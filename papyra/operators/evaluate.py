"""Retrieval and generation metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyra.schemas import JUDGE

NO_CONTEXT = "（无检索资料）"
JUDGE_METRICS = ("faithfulness", "citation", "answer_accuracy", "rejection")


def score_question(docs: Column, sources: Column, k: Column) -> Column:
    """struct of n_sources, n_hit, recall, precision, p1, mrr for hit documents in rank order; null without sources.

    Precision divides by ``k``, not by the number of hits returned.
    """
    wanted = F.array_distinct(F.filter(sources, lambda s: F.coalesce(s, F.lit("")) != ""))
    top = F.slice(docs, F.lit(1), F.greatest(k, F.lit(1)))
    top = F.when(k > 0, top).otherwise(F.slice(docs, F.lit(1), F.lit(0)))
    good = F.transform(top, lambda d: F.array_contains(wanted, d))
    n_sources, n_hit = F.size(wanted), F.size(F.array_intersect(F.array_distinct(top), wanted))
    first = F.array_position(good, F.lit(True))
    figures = F.struct(
        n_sources.alias("n_sources"), n_hit.alias("n_hit"), (n_hit / n_sources).alias("recall"),
        F.when(k > 0, F.size(F.filter(good, lambda g: g)) / k).otherwise(F.lit(0.0)).alias("precision"),
        F.coalesce(F.get(good, F.lit(0)).cast("double"), F.lit(0.0)).alias("p1"),
        F.when(first > 0, 1 / first).otherwise(F.lit(0.0)).alias("mrr"),
    )
    return F.when(n_sources > 0, figures)


def score_hits(qa: DataFrame, hits: DataFrame, k: int) -> DataFrame:
    """``qa`` (qid, sources, ...) with the figures of its hits (qid, rank, doc); questions without hits count as misses."""
    docs = hits.groupBy("qid").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "doc"))), lambda h: h["doc"]).alias("docs"))
    joined = qa.join(docs, "qid", "left").withColumn("docs", F.coalesce("docs", F.array().cast("array<string>")))
    return joined.withColumn("m", score_question(F.col("docs"), F.col("sources"), F.lit(k))).select(*qa.columns, "docs", "m.*")


def macro(rated: DataFrame, *by: str) -> DataFrame:
    """Means over the questions with sources, to three places half-even, with their number and the hit rates."""
    figures = [F.bround(F.avg(c), 3).alias(c) for c in ("recall", "precision", "p1", "mrr")]
    rated = rated.where("n_sources is not null")
    rates = [F.bround(F.avg((F.col("n_hit") > 0).cast("int")), 3).alias("any_hit"), F.bround(F.avg((F.col("n_hit") == F.col("n_sources")).cast("int")), 3).alias("all_hit")]
    return rated.groupBy(*by).agg(F.count("*").alias("n"), *figures, *rates) if by else rated.agg(F.count("*").alias("n"), *figures, *rates)


def set_report(rated: DataFrame) -> DataFrame:
    """By set: recall, MRR and P@1 for simple, recall and precision for complex; unanswerable questions are counted only."""
    by = rated.groupBy("set").agg(
        F.count_if(F.col("n_sources").isNotNull()).alias("n"), F.count_if(~F.col("answerable")).alias("unanswerable"), F.bround(F.avg("recall"), 3).alias("recall"),
        F.bround(F.avg("mrr"), 3).alias("mrr"), F.bround(F.avg("p1"), 3).alias("p1"), F.bround(F.avg("precision"), 3).alias("precision"),
    )
    simple = F.col("set") == "simple"
    return by.withColumns({"mrr": F.when(simple, F.col("mrr")), "p1": F.when(simple, F.col("p1")), "precision": F.when(~simple, F.col("precision"))})


def mark(n_hit: Column, n_sources: Column) -> Column:
    return F.when(n_sources.isNull(), F.lit("-")).when(n_hit > 0, F.lit("√")).otherwise(F.lit("×"))


def reconcile(qa: DataFrame, snapshot: DataFrame) -> DataFrame:
    """(qid, problem): questions missing from the snapshot, and snapshot rows of unknown questions."""
    missing = qa.join(snapshot, "qid", "left_anti").select("qid", F.lit("missing").alias("problem"))
    unknown = snapshot.join(qa, "qid", "left_anti").select("qid", F.lit("unknown").alias("problem"))
    return missing.unionByName(unknown)


def side_by_side(reports: DataFrame, metric: str) -> DataFrame:
    """One row per set, one column per route."""
    return reports.groupBy("set").pivot("route").agg(F.first(metric))


def snapshot(qa: DataFrame, hits: DataFrame, route: str, k: int) -> DataFrame:
    """Snapshot rows (M11): hits without text; page is null where it is missing or zero."""
    page = F.when(F.coalesce("start_page", F.lit(0)) != 0, F.array("start_page", "end_page")).alias("page")
    listed = hits.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("rank", F.struct(F.col("id").alias("chunk_id"), "doc", "section_path", page, "score").alias("h")))).alias("hits"))
    rows = qa.join(listed, "qid", "left")
    return rows.select("qid", "set", "answerable", F.lit(route).alias("route"), F.lit(k).alias("k"), F.coalesce(F.transform("hits", lambda h: h["h"]), F.expr("cast(array() as array<struct<chunk_id: string, doc: string, section_path: string, page: array<int>, score: double>>)")).alias("hits"))


def parse_judge(raw: Column) -> Column:
    """The JSON object in a reply, from its first to its last brace; null where there is none or it can't be read."""
    found = F.from_json(F.regexp_extract(raw, r"(?s)\{.*\}", 0), JUDGE)
    return F.when(F.coalesce(*[found[m] for m in JUDGE_METRICS]).isNotNull(), found)


def judge_summary(scores: DataFrame) -> DataFrame:
    """Means to three places over judged rows, overall (set null) and by set, with counts of what was left out.

    ``scores``: set, infra_failed, and the four metrics, null where the judge failed.
    """
    judged = F.coalesce(*[F.col(m) for m in JUDGE_METRICS]).isNotNull() & ~F.col("infra_failed")
    means = [F.bround(F.avg(F.when(judged, F.col(m))), 3).alias(m) for m in JUDGE_METRICS]
    return scores.groupingSets([[], [F.col("set")]], F.col("set")).agg(F.count_if(judged).alias("n"), F.count_if(F.col("infra_failed")).alias("infra_failed"), F.count_if(~judged & ~F.col("infra_failed")).alias("judge_failed"), *means)


def coverage_split(rated: DataFrame, accuracy: str = "answer_accuracy") -> DataFrame:
    """Mean accuracy of answerable questions by how many of their sources were retrieved."""
    kind = F.when(F.col("n_hit") == F.col("n_sources"), "full").when(F.col("n_hit") > 0, "partial").otherwise("none")
    return rated.where("n_sources is not null").groupBy(kind.alias("coverage")).agg(F.count("*").alias("n"), F.bround(F.avg(accuracy), 3).alias("accuracy"))


def composite(summary: DataFrame, places: int = 3) -> DataFrame:
    """Mean of the four metrics."""
    return summary.withColumn("composite", F.bround(sum(F.col(m) for m in JUDGE_METRICS) / len(JUDGE_METRICS), places))
