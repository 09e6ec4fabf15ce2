"""Question answering as one plan: retrieve, reject below the threshold, generate for the rest, check citations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyra.operators import generate, retrieve
from papyra.operators.index import Index
from papyra.providers import Generator, generate_table
from papyra.shared import written


def with_passages(hits: DataFrame, chunks: DataFrame) -> DataFrame:
    """Hits (M9) from ranked ids and the chunks; texts are fetched for the chosen ids only."""
    meta = chunks.select("id", "text", "doc", F.array_join("section_path", " / ").alias("section_path"), "start_page", "end_page")
    return hits.select("qid", "rank", "id", "score").join(meta, "id").select("qid", "rank", "id", "score", "text", "doc", "section_path", "start_page", "end_page")


def answer(index: Index, chunks: DataFrame, queries: DataFrame, generator: Generator, mode: str = "hybrid_rerank", k: int = 5, threshold: float | None = None, models: retrieve.Models | None = None) -> DataFrame:
    """Answer rows for queries (qid, text): top1, topk, rejected, answer, citations (numbers; null if rejected) and error."""
    hits = written(with_passages(retrieve.search_route(mode, index, queries, k, models), chunks), "hits")
    return answered(queries, hits, generator, mode, threshold)


def answered(queries: DataFrame, hits: DataFrame, generator: Generator, mode: str = "hybrid_rerank", threshold: float | None = None) -> DataFrame:
    """``answer`` from hits with their passages (M9)."""
    limit = generate.MIN_SCORE.get(mode, generate.MIN_SCORE["hybrid_rerank"]) if threshold is None else threshold
    yes, no = generate.split_by_threshold(queries, hits, limit)
    asked = yes.join(generate.contexts(hits), "qid").select("qid", generate.messages(F.col("text"), F.col("context")).alias("messages"))
    replies = written(generate_table(asked, generator), "replies")
    listed = hits.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "doc", "section_path", "start_page", "end_page"))).alias("hits"))
    rated = yes.join(replies, "qid").withColumn("rejected", F.lit(False)).unionByName(no.withColumns({"error": F.lit(None).cast("string"), "rejected": F.lit(True)}))
    joined = rated.join(listed, "qid", "left")
    cited = generate.citations(F.col("answer"), F.coalesce(F.transform("hits", lambda h: h["id"]), F.array().cast("array<string>")))
    numbers = F.struct(F.size(cited["valid"]).alias("valid"), F.size(cited["invalid"]).alias("invalid"), cited["none"].alias("none"))
    return joined.select("qid", F.col("text").alias("question"), F.lit(mode).alias("mode"), "top1", generate.topk(F.col("hits")).alias("topk"), "rejected", "answer", F.when(~F.col("rejected"), numbers).alias("citations"), "error")
