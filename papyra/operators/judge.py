"""Prompts for a judge of answers, with the passages rebuilt from the chunks that were cited as context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyra.operators.evaluate import JUDGE_METRICS, NO_CONTEXT
from papyra.operators.generate import REFUSAL, REJECT_ANSWER

INSTRUCTIONS = (
    "Rate the answer on four scales, 0, 0.5 or 1 each, with one sentence of reasons: faithfulness (nothing beyond the passages), citation "
    "(cited passages support the sentences they stand at), answer_accuracy (agrees with the reference answer) and rejection (refuses if and only if "
    f"the question can't be answered). Both 「{REJECT_ANSWER}」 and 「{REFUSAL}」 are refusals. Reply with one JSON object: "
    "{" + ", ".join(f'"{m}": <0, 0.5 or 1>, "{m}_reason": "..."' for m in JUDGE_METRICS) + ', "notes": "..."}'
)


def contexts_of(answers: DataFrame, chunks: DataFrame) -> DataFrame:
    """``answers`` (qid, topk, ...) with ``context``: the texts of its chunks in order, or a note that there are none."""
    listed = answers.select("qid", F.posexplode("topk").alias("rank", "hit")).select("qid", "rank", F.col("hit.id").alias("id"))
    texts = listed.join(chunks.select("id", "text"), "id").groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "text"))).alias("hits"))
    passage = lambda h: F.concat(F.lit("["), h["id"], F.lit("] "), h["text"])
    joined = texts.select("qid", F.array_join(F.transform("hits", passage), "\n").alias("context"))
    return answers.join(joined, "qid", "left").withColumn("context", F.coalesce("context", F.lit(NO_CONTEXT)))


def prompt(question: Column, gold: Column, answerable: Column, context: Column, answer: Column) -> Column:
    part = lambda title, value: F.concat(F.lit(f"【{title}】"), F.coalesce(value.cast("string"), F.lit("")), F.lit("\n"))
    return F.concat(F.lit(INSTRUCTIONS + "\n"), part("问题", question), part("标准答案", gold), part("可答", answerable), part("资料", F.concat(F.lit("\n"), context)), F.lit("【系统生成的回答】"), F.coalesce(answer, F.lit("")))


def prompts(answers: DataFrame, chunks: DataFrame) -> DataFrame:
    """(qid, prompt) for answers (qid, question, gold_answer, answerable, topk, answer)."""
    return contexts_of(answers, chunks).select("qid", prompt(F.col("question"), F.col("gold_answer"), F.col("answerable"), F.col("context"), F.col("answer")).alias("prompt"))


def template(answers: DataFrame) -> DataFrame:
    """Rows for judging by hand: the answers with empty marks."""
    return answers.select("*", *[F.lit(None).cast("double").alias(m) for m in JUDGE_METRICS])
