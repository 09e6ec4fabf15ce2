"""Connected components over an edge table, by alternating large-star and small-star steps.

Every step is two shuffles of the edges with map-side minimums; nothing is collected but the pair of
numbers that tells whether the last round changed anything. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyra.shared import written


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 100) -> DataFrame:
    """``(node, root)`` for every node with an edge; ``root`` is the smallest node of the component.

    Null ends and loops are ignored, repeated edges count once; no edges give an empty table.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    e = written(e.where("u is not null and v is not null and u <> v").distinct(), "cc")
    mark = _mark(e)
    for _ in range(max_rounds):
        if mark[0] == 0:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        big = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = big.groupBy("u").agg(F.min("v").alias("m"))
        tied = big.join(low, "u").select("u", "v", "m")
        pair = F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
        e = written(tied.select(pair.alias("p")).select("p.u", "p.v").where("u <> v").distinct(), "cc")
        old, mark = mark, _mark(e)
        if old == mark:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = e.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    return stars.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _mark(e: DataFrame) -> tuple[int, int]:
    row = e.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("x")).first()
    return row["n"], row["x"]
