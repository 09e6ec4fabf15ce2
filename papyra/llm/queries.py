"""The queries of this subpackage, one for each operator, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyra.llm import decontam, htmldiff, knlm, mixing, puquality, risk_rules, simhash, superkmer, toxicity, warc
from papyra.llm.common import fold, read
from papyra.llm.oracles import ORACLE_SQL  # noqa: F401


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id")


def op7_superkmer_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = superkmer.drop_repeated(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_kneser_ney_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 7) == 2
    model = knlm.fit(docs.where(~held_out))
    return knlm.score(docs, model).withColumn("held_out", held_out)


def op2_capped_water_filling_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op10_risk_controlled_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = risk_rules.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_qgram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op1_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages"))


def op5_html_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmldiff.extract(read(spark, sf_dir, "pages"))


def op3_boosted_trees_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def op6_pu_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scorer = puquality.fit(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs, scorer, puquality.FOLDS, puquality.HELD_OUT, puquality.CUTOFF)


QUERIES = {f.__name__: f for f in (op4_simhash_near_dedup, op7_superkmer_substring_dedup, op8_kneser_ney_lm_scoring, op2_capped_water_filling_mix, op10_risk_controlled_quality_rules, op9_qgram_decontamination, op1_warc_round_trip, op5_html_page_differencing, op3_boosted_trees_toxicity, op6_pu_quality_classifier)}
