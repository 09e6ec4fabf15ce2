"""Rejection, context, messages and citations. The generator itself is a provider."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyra.functions.text import CITATION

# Texts and thresholds of the question-answering format.
MIN_SCORE = {"vector_only": 0.55, "hybrid_rerank": 0.58}
REJECT_ANSWER = "当前资料相关性不足，无法回答"
REFUSAL = "资料中没有相关信息"
WHOLE_TEXT = "全文"
SYSTEM_PROMPT = (
    "你是一个严谨的知识问答助手。请遵守以下规则：\n"
    "1) 只依据【资料】中的内容作答，不得引入资料之外的知识；\n"
    "2) 若【资料】不足以回答问题——完全没有相关内容，或只提到一部分、缺少回答所需的关键信息——"
    "必须直接回答「资料中没有相关信息」，不要猜测、不要编造、也不要用常识补全；\n"
    "3) 每个结论后用所依据资料片段的编号标注，格式如 [chunk_000023]；"
    "只允许使用【资料】中出现过的编号。"
)


def top1(hits: DataFrame) -> DataFrame:
    """(qid, top1): the best score of each query with hits."""
    return hits.groupBy("qid").agg(F.max("score").alias("top1"))


def rejected(best: Column, threshold: float) -> Column:
    return best.isNull() | (best < threshold)


def split_by_threshold(queries: DataFrame, hits: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) queries with top1; the generator is called for the first table only."""
    rated = queries.join(top1(hits), "qid", "left")
    return rated.where(~rejected(F.col("top1"), threshold)), rated.where(rejected(F.col("top1"), threshold)).withColumn("answer", F.lit(REJECT_ANSWER))


def _pages(h: Column, form: str) -> Column:
    return F.when(F.coalesce(h["start_page"], F.lit(0)) != 0, F.format_string(form, h["start_page"], h["end_page"])).otherwise(F.lit(""))


def _section(h: Column) -> Column:
    return F.when(F.coalesce(h["section_path"], F.lit("")) != "", h["section_path"]).otherwise(F.lit(WHOLE_TEXT))


def contexts(hits: DataFrame) -> DataFrame:
    """(qid, context, appendix) from hits (M9), in order of rank."""
    listed = hits.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "doc", "section_path", "start_page", "end_page", "text"))).alias("hits"))
    line = lambda h: F.concat(F.lit("["), h["id"], F.lit("] 来源:"), h["doc"], F.lit(" §"), _section(h), _pages(h, " p.%d~%d"), F.lit("\n"), h["text"], F.lit("\n"))
    source = lambda h: F.concat(F.lit("["), h["id"], F.lit("] "), h["doc"], F.lit(" §"), _section(h), _pages(h, " (p.%d~%d)"))
    return listed.select("qid", F.array_join(F.transform("hits", line), "\n").alias("context"), F.concat(F.lit("引用来源: "), F.array_join(F.transform("hits", source), "; ")).alias("appendix"))


def messages(question: Column, context: Column) -> Column:
    """[(role, content)]: the rules as system, passages and question as user."""
    user = F.concat(F.lit("【资料】\n"), context, F.lit("\n\n【问题】"), question)
    return F.array(F.struct(F.lit("system").alias("role"), F.lit(SYSTEM_PROMPT).alias("content")), F.struct(F.lit("user").alias("role"), user.alias("content")))


def citations(answer: Column, allowed: Column) -> Column:
    """struct(valid, invalid, none): cited ids inside and outside ``allowed``, repeats kept, and whether there are none."""
    cited = F.regexp_extract_all(F.coalesce(answer, F.lit("")), F.lit(CITATION), F.lit(1))
    return F.struct(F.filter(cited, lambda c: F.array_contains(allowed, c)).alias("valid"), F.filter(cited, lambda c: ~F.array_contains(allowed, c)).alias("invalid"), (F.size(cited) == 0).alias("none"))


def topk(hits: Column) -> Column:
    """Hits without text and score; page is [start, end], or null where start is missing or zero."""
    page = lambda h: F.when(F.coalesce(h["start_page"], F.lit(0)) != 0, F.array(h["start_page"], h["end_page"]))
    return F.transform(hits, lambda h: F.struct(h["id"].alias("id"), h["doc"].alias("doc"), h["section_path"].alias("section"), page(h).alias("page")))


def limited(queries: DataFrame, n: int, order: str = "qid") -> DataFrame:
    """The first ``n`` queries; all for 0."""
    return queries.orderBy(order).limit(n) if n else queries
