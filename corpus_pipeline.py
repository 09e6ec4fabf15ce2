"""From raw documents to a training mix: each stage takes what its predecessor kept, whole.

1. quality classifier: documents predicted 0 go; 2. SimHash near-dedup: one document of each group of similarity 0.8
of five-word shingles stays; 3. substring dedup: words covered by a window that a smaller doc_id has are cut out, texts that
lose none stay as they are; 4. benchmark decontamination: documents in which an item is found go;
5. mixing to target weights: one row per document with the words that the mix takes of it.

The first four return the columns of the documents, the third with cut texts and their n_chars; extra columns pass
unchanged, whatever their names. Nulls, empties, repeated rows and empty tables are
treated as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from papyra.llm import decontam, mixing, puquality, simtiles, superkmer
from papyra.llm.common import read
from papyra.shared import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return puquality.keep_good(docs, puquality.fit(docs, read(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simtiles.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return superkmer.cut_texts(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", decontaminate),
    ("mixing", mix),
]

#: Trained and iterative stages have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
