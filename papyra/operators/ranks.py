"""Global row numbers without a single-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from papyra.shared import written


def global_row_number(df: DataFrame, order: list[str | Column], name: str = "rank") -> DataFrame:
    """``df`` with the 1-based place of each row in ``order``; rows that tie get their places in any order.

    The rows are range-partitioned and written once, so the partition numbers stay as they are; counts of the
    partitions give each its offset. Only as many counts as partitions are broadcast.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    dealt = written(df.repartitionByRange(*cols).withColumn("_part", F.spark_partition_id()), "ranks")
    counts = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*cols))
    return dealt.join(F.broadcast(offsets), "_part").withColumn(name, within + F.col("_offset")).drop("_part", "_offset")


def prefix_sums(df: DataFrame, place: str, value: str, name: str, block: int = 65_536) -> DataFrame:
    """``df`` with the sum of ``value`` over all rows at smaller places (1-based, dense), block by block of places."""
    number = F.floor((F.col(place) - 1) / F.lit(block)).alias("_block")
    blocks = df.groupBy(number).agg(F.sum(value).alias("_sum"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    # One row for each block meets here.
    starts = blocks.select("_block", F.coalesce(F.sum("_sum").over(before(Window.orderBy("_block"))), F.lit(0)).alias("_start"))
    inner = F.coalesce(F.sum(value).over(before(Window.partitionBy("_block").orderBy(place))), F.lit(0))
    return df.withColumn("_block", number).join(F.broadcast(starts), "_block").withColumn(name, F.col("_start") + inner).drop("_block", "_start")
