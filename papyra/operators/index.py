"""Inverted index and BM25 statistics as tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyra.functions.text import tokens
from papyra.shared import exists, shared_path

K1, B = 1.5, 0.75
Segmenter = Callable[[str], list[str]]


@dataclass
class Index:
    """postings(tok, id, tf), lengths(id, dl), terms(tok, df, idf, w) and norms(id, norm): Parquet tables under ``path``; id orders
    ties. w is a term's weight ln((N + 1) / (df + 1)) + 1, norm the length of a document's vector of tf * w. ``segment`` cuts
    queries as the corpus was cut."""

    path: str
    postings: DataFrame
    lengths: DataFrame
    terms: DataFrame
    norms: DataFrame
    segment: Segmenter | None = None


def token_table(corpus: DataFrame, segment: Segmenter | None = None) -> DataFrame:
    """(id, toks) of a corpus (id, text)."""
    return corpus.select("id", tokens(F.coalesce("text", F.lit("")), segment).alias("toks"))


def postings_of(toks: DataFrame) -> DataFrame:
    return toks.select("id", F.explode("toks").alias("tok")).groupBy("tok", "id").agg(F.count("*").alias("tf"))


def terms_of(postings: DataFrame, n_docs: DataFrame) -> DataFrame:
    """(tok, df, idf); a negative idf becomes a quarter of the mean idf of the vocabulary."""
    df = postings.groupBy("tok").agg(F.count("*").alias("df")).crossJoin(F.broadcast(n_docs))
    raw = df.select("tok", "df", "n", (F.log(F.col("n") - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)).alias("raw"))
    # One number is broadcast.
    mean = F.broadcast(raw.agg(F.avg("raw").alias("mean")))
    weight = F.log((F.col("n") + 1) / (F.col("df") + 1)) + 1
    return raw.crossJoin(mean).select("tok", "df", F.when(F.col("raw") < 0, 0.25 * F.col("mean")).otherwise(F.col("raw")).alias("idf"), weight.alias("w"))


def build(corpus: DataFrame, path: str | None = None, segment: Segmenter | None = None) -> Index:
    """Write the index of ``corpus`` (id, text); documents are tokenised once. With ``segment``, a function from a text to its
    words, tokens are those of its words that aren't blank."""
    spark = corpus.sparkSession
    path = path or shared_path(spark, "index")
    if corpus.isEmpty():
        raise RuntimeError("the corpus is empty: extract, clean and chunk documents before building an index")
    token_table(corpus, segment).write.mode("overwrite").parquet(f"{path}/tokens")
    toks = spark.read.parquet(f"{path}/tokens")
    # Dealt by token and document, so a common token is spread; sorted, so row groups of other tokens are skipped.
    postings_of(toks).sortWithinPartitions("tok").write.mode("overwrite").parquet(f"{path}/postings")
    toks.select("id", F.size("toks").cast("long").alias("dl")).write.mode("overwrite").parquet(f"{path}/lengths")
    postings, lengths = (spark.read.parquet(f"{path}/{t}") for t in ("postings", "lengths"))
    terms_of(postings, lengths.agg(F.count("*").alias("n"))).write.mode("overwrite").parquet(f"{path}/terms")
    weighted = postings.join(spark.read.parquet(f"{path}/terms").select("tok", "w"), "tok").select("id", (F.col("tf") * F.col("w")).alias("x"))
    weighted.groupBy("id").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm")).write.mode("overwrite").parquet(f"{path}/norms")
    return load(spark, path, segment)


_TABLES = ("postings", "lengths", "terms", "norms")


def load(spark: SparkSession, path: str, segment: Segmenter | None = None) -> Index:
    """The index under ``path``; a missing table is an error."""
    return Index(path, *(spark.read.parquet(f"{path}/{t}") for t in _TABLES), segment)


def load_or_build(spark: SparkSession, path: str, corpus: DataFrame, segment: Segmenter | None = None) -> Index:
    """The index under ``path``, built only where there is none; any other error is raised, and nothing overwritten."""
    there = [exists(spark, f"{path}/{t}") for t in _TABLES]
    return load(spark, path, segment) if any(there) else build(corpus, path, segment)


def vector_rows(chunks: DataFrame, embedded: DataFrame) -> DataFrame:
    """Rows of the vector store: chunks with flat metadata and their embeddings (id, embedding)."""
    flat = chunks.select("id", F.col("text").alias("document"), "doc", F.array_join("section_path", " / ").alias("section_path"), F.coalesce("start_page", F.lit(0)).cast("int").alias("start_page"), F.coalesce("end_page", F.lit(0)).cast("int").alias("end_page"))
    return flat.join(embedded, "id")
