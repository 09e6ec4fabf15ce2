"""Cleaning of blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from papyra.functions.text import is_noise, normalise_space

TAIL_MARKER = "冒险者协会"


def clean_rows(rows: Column) -> Column:
    """Table cells normalised; rows without content dropped."""
    cells = F.transform(rows, lambda r: F.transform(r, lambda c: normalise_space(F.coalesce(c, F.lit("")))))
    return F.filter(cells, lambda r: F.exists(r, lambda c: c != ""))


def clean_blocks(blocks: DataFrame) -> DataFrame:
    """Headings and paragraphs normalised, empty and noise blocks dropped; tables by their cells; other kinds dropped."""
    words, table = F.col("kind").isin("heading", "para"), F.col("kind") == "table"
    text = F.when(words, normalise_space(F.coalesce("text", F.lit("")))).otherwise(F.col("text"))
    rows = F.when(table, clean_rows(F.col("rows"))).otherwise(F.col("rows"))
    one = F.array(F.struct(text.alias("text"), rows.alias("rows")))
    keep = lambda c: (words & (c["text"] != "") & ~is_noise(c["text"])) | (table & (F.size(c["rows"]) > 0))
    # An exploded array of one or none: a filter would be pushed down and compute the text once for each mention.
    made = blocks.withColumn("_cleaned", F.explode(F.filter(one, keep)))
    return made.select(*[F.col(f"_cleaned.{c}").alias(c) if c in ("text", "rows") else F.col(c) for c in blocks.columns])


def truncate_tail(blocks: DataFrame, marker: str = TAIL_MARKER) -> DataFrame:
    """Per document, blocks up to the last heading or paragraph that ends with ``marker``; all without one."""
    ends = F.col("kind").isin("heading", "para") & F.col("text").endswith(marker)
    last = F.max(F.when(ends, F.col("block_idx"))).over(Window.partitionBy("doc"))
    return blocks.withColumn("_last", last).where("_last is null or block_idx <= _last").drop("_last")


def describe_blocks(blocks: DataFrame) -> DataFrame:
    """(doc, blocks: map of counts by kind, chars): text for headings and paragraphs, cells for tables."""
    in_cells = F.aggregate(F.flatten("rows"), F.lit(0), lambda n, c: n + F.length(F.coalesce(c, F.lit(""))))
    chars = F.when(F.col("kind") == "table", in_cells).otherwise(F.length("text"))
    by_kind = blocks.groupBy("doc", "kind").agg(F.count("*").alias("n"), F.sum(chars).alias("chars"))
    pairs = F.sort_array(F.collect_list(F.struct("kind", "n")))
    return by_kind.groupBy("doc").agg(F.map_from_entries(pairs).alias("blocks"), F.sum("chars").alias("chars"))


def manifest(blocks: DataFrame, corpus: str = "corpus", format: str = "html", human_readable: bool = True) -> DataFrame:
    return describe_blocks(blocks).select(F.col("doc").alias("source"), F.lit(format).alias("format"), F.lit(corpus).alias("corpus"), F.lit(human_readable).alias("human_readable"), "blocks", "chars")
