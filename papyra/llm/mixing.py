"""Mixing sources to target weights by capped water-filling. DataFrame and SQL functions only.

A source's share is its weight times a common level; sources above ``max_epochs`` times their size are
clamped there and the level of the rest is raised, until none is above. Sources are clamped in order of cap by weight, so running
sums in that order give the level that the rounds end at, in one pass for any number of sources. Whole epochs repeat every document;
the fraction left is the run of documents, in a seeded order, whose sizes come nearest to the words
still to take. The order is by a hash of 60 bits: sums over its first 12 bits find the place where a source's
run ends, and only documents with those 12 bits, one in 4,096, meet in a window. So a source may hold any
share of the rows.

Weights cycle over the sources in code-point order, null last. Nulls and empties: a null text has size 0, a
null source is a source, a null doc_id is ordered by its text. Rows that repeat a doc_id and have the
same size are alike; which of two such rows at the edge of a run is taken shows in no result. A source whose
documents are all empty has target 0. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from papyra.llm.common import WORD
from papyra.operators.ranks import global_row_number, prefix_sums
from papyra.shared import written

SHARE, WEIGHTS, MAX_EPOCHS, SEED = 1.5, (5, 2, 1), 2.0, "mix-1"
#: Up to so many sources (rows of three numbers and a name) the table of sources is broadcast; beyond, joined by shuffle.
BROADCAST_SOURCES = 50_000
_LOW_BITS = 48


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, share: float = SHARE, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """``sources`` (source_size, weight, ...) with ``target``: clamped at its cap, or its weight of what the clamped ones leave."""
    capped = sources.withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    ordered = written(global_row_number(capped, [F.col("cap") / F.col("weight"), "rank"], "place"), "mix-order")
    sums = prefix_sums(prefix_sums(ordered, "place", "cap", "clamped"), "place", "weight", "full")
    every = F.broadcast(ordered.agg((share * F.sum("source_size")).alias("total"), F.sum("weight").alias("all"), F.max(F.col("cap") / F.col("weight")).alias("top")))
    # The level if all before a source are clamped; the first source that it leaves below its cap ends the rounds.
    tried = sums.crossJoin(every).withColumn("level", (F.col("total") - F.col("clamped")) / (F.col("all") - F.col("full")))
    fits = F.when(F.col("weight") * F.col("level") <= F.col("cap"), F.struct("place", "level"))
    level = F.broadcast(tried.agg(F.coalesce(F.min(fits)["level"], F.max("top")).alias("level")))
    return ordered.crossJoin(level).withColumn("target", F.least(F.col("weight") * F.col("level"), F.col("cap"))).drop("level", "cap", "place")


def mix(docs: DataFrame, share: float = SHARE, weights: tuple[int, ...] = WEIGHTS, max_epochs: float = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken): one row per document."""
    name = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.concat(F.lit("null|"), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))).alias("name")
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("source"), F.col("source").isNull().alias("unnamed"), word_count(F.col("text")).alias("size"), name)
    place = F.conv(F.substring(F.md5(F.concat(F.lit(seed + "|"), F.col("name")).cast("binary")), 1, 15), 16, 10).cast("long")
    sized = written(named.withColumn("place", place).drop("name"), "mix-sizes")
    head = F.shiftright("place", _LOW_BITS)
    by_head = sized.groupBy("source", "unnamed", head.alias("head")).agg(F.sum("size").alias("size"))
    by_head = written(by_head, "mix-heads")
    sources = by_head.groupBy("source", "unnamed").agg(F.sum("size").alias("source_size"))
    ranked = global_row_number(sources, ["unnamed", "source"], "rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    targets = water_fill(ranked.select("source", "unnamed", "source_size", "rank", weight.alias("weight")), share, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    targets = targets.select("source", "unnamed", "source_size", "target", whole.alias("whole"), (F.col("target") - whole * F.col("source_size")).alias("need"))
    so_far = F.sum("size").over(Window.partitionBy("source", "unnamed").orderBy("head"))
    runs = by_head.withColumn("upto", so_far).join(targets, ["source", "unnamed"])
    edge = runs.where("upto >= need and upto - size < need").select("source", "unnamed", F.col("head").alias("edge"), (F.col("need") - (F.col("upto") - F.col("size"))).alias("left"))
    # With nothing left to take no head is the edge: -1 is below every head.
    plan = targets.join(edge, ["source", "unnamed"], "left").select("source", "unnamed", "source_size", "target", "whole", F.when(F.col("need") > 0, F.col("edge")).otherwise(F.lit(-1)).alias("edge"), "left")
    plan = written(plan, "mix-plan")
    if plan.count() <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    rows = sized.withColumn("head", head).join(plan, ["source", "unnamed"])
    before = F.coalesce(F.sum("size").over(Window.partitionBy("source", "unnamed").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    at_edge = rows.where("head = edge").withColumn("more", (before + F.col("size") / 2 < F.col("left")).cast("long"))
    others = rows.where("head <> edge").withColumn("more", (F.col("head") < F.col("edge")).cast("long"))
    return at_edge.unionByName(others).select("doc_id", "size", "source_size", "target", (F.col("size") * (F.col("whole") + F.col("more"))).alias("taken"))


ORACLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         CASE WHEN text IS NULL THEN 0 ELSE length(regexp_replace(regexp_replace(text, '[^\x20\x09-\x0D]+', 'x', 'g'), '[\x20\x09-\x0D]+', '', 'g')) END AS size,
         CAST(concat('0x', substr(md5(concat('mix-1|', coalesce(CAST(doc_id AS VARCHAR), concat('null|', md5(coalesce(text, '')))))), 1, 15)) AS BIGINT) AS place
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight FROM sources),
tries AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap,
         coalesce(sum(2.0::DOUBLE * source_size) OVER before, 0) AS capped, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS open,
         1.5::DOUBLE * sum(source_size) OVER () AS total, row_number() OVER before AS place
  FROM ranked WINDOW before AS (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT coalesce(min_by((total - capped) / open, place) FILTER (WHERE weight * ((total - capped) / open) <= cap), max(cap / weight)) AS level FROM tries),
targets AS (SELECT source, source_size, least(weight * level, cap) AS target FROM tries, level),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole,
         target - (CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END) * source_size AS need
  FROM targets),
placed AS (
  SELECT s.doc_id, s.size, p.source_size, p.target, p.whole, p.need,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (whole + CASE WHEN before + size / 2.0 < need THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed
"""
