"""Bounded, deterministic samples of labelled rows, for fitting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyra.llm.common import fold


def by_hash(ids: DataFrame, most: int) -> DataFrame:
    """The ``most`` rows with the least md5 of doc_id."""
    return ids.orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id").limit(most)


def agreed(labels: DataFrame, column: str, folds: int, held_out: int) -> DataFrame:
    """(doc_id, y): ids outside the held-out fold with one label, 0 or 1, however often it is given."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    rows = rows.where(fold(F.col("doc_id"), folds) != held_out)
    return rows.groupBy("doc_id").agg(F.min("y").alias("low"), F.max("y").alias("y")).where("low = y").select("doc_id", "y")


def with_texts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """``chosen`` (doc_id, ..., bounded by the caller) with the text as binary; the documents aren't shuffled."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    return rows.join(F.broadcast(chosen), "doc_id")
