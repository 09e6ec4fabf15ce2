"""Command line: ``python -m papyra STEP ...``. Each step reads and writes folders, so steps can be run one by one.

  pdfs      a folder of PDF files to cleaned blocks, Markdown and a manifest (needs the PDF library)
  blocks    pages (Parquet with page_id, html) to the same
  chunks    blocks to chunks
  vectors   chunks to the vector store, with the stand-in embedder
  index     chunks to the inverted index
  ask       questions to answers
  retrieve  questions to snapshots, one for each route
  evaluate  snapshots and questions to retrieval metrics
  calibrate snapshots to threshold reports
  judge     answers to judge prompts, replies of the stand-in, and their summary
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyra import schemas
from papyra.operators import calibrate, chunk, clean, evaluate, generate, index, judge, rag, retrieve
from papyra.providers import ExtractiveGenerator, HashEmbedder, MechanicalJudge, embed_table, judge_table
from papyra.session import session
from papyra.sources import html, io

ROUTES = {"vector_only": "D", "hybrid_rerank": "A"}


def pdfs(spark: SparkSession, a) -> None:
    _write_blocks(spark, a, io.pdf_blocks(io.scan_files(spark, a.pdfs)), "pdf")


def blocks(spark: SparkSession, a) -> None:
    _write_blocks(spark, a, html.html_blocks(spark.read.parquet(a.pages)), "html")


def _write_blocks(spark: SparkSession, a, made: DataFrame, kind: str) -> None:
    cut = clean.truncate_tail(clean.clean_blocks(made), a.marker)
    io.write_records(cut, f"{a.out}/blocks", "parquet")
    kept = spark.read.schema(schemas.BLOCK).parquet(f"{a.out}/blocks")
    io.write_records(io.render_markdown(kept), f"{a.out}/markdown")
    io.write_records(clean.manifest(kept, format=kind), f"{a.out}/manifest")


def chunks(spark: SparkSession, a) -> None:
    made = chunk.chunk_blocks(spark.read.schema(schemas.BLOCK).parquet(f"{a.out}/blocks"), a.chunk_size, a.min_chunk, a.overlap)
    io.write_records(made, f"{a.out}/chunks", "parquet")
    chunk.describe_chunks(_chunks(spark, a)).show()


def _chunks(spark: SparkSession, a) -> DataFrame:
    return spark.read.schema(schemas.CHUNK + ", seq long").parquet(f"{a.out}/chunks")


def vectors(spark: SparkSession, a) -> None:
    made = _chunks(spark, a)
    io.write_vectors(index.vector_rows(made, embed_table(made.select("id", "text"), HashEmbedder(a.dim))), f"{a.out}/vectors")


def build(spark: SparkSession, a) -> None:
    index.build(_chunks(spark, a).select("id", "text"), f"{a.out}/index")


def _questions(spark: SparkSession, a) -> DataFrame:
    return generate.limited(io.read_qa(spark, {a.set: a.questions}, a.set), a.limit, "place")


def _ready(spark: SparkSession, a) -> index.Index:
    problems = [r["problem"] for r in io.preflight(spark, a.mode, f"{a.out}/vectors", f"{a.out}/index", f"{a.out}/chunks").collect()]
    if problems:
        sys.exit("\n".join(["not ready:", *(f"- {p}" for p in problems)]))
    return index.load_or_build(spark, f"{a.out}/index", _chunks(spark, a).select("id", "text"))


def _models(spark: SparkSession, a) -> retrieve.Models:
    """The vector store that the step ``vectors`` wrote, with the stand-in embedder; reranking is by coverage."""
    return retrieve.Models(io.open_vectors(spark, f"{a.out}/vectors"), HashEmbedder(a.dim))


def ask(spark: SparkSession, a) -> None:
    asked = _questions(spark, a)
    ready = _ready(spark, a)
    found = rag.answer(ready, _chunks(spark, a), asked.select("qid", F.col("question").alias("text")), ExtractiveGenerator(), a.mode, a.k, a.threshold, _models(spark, a))
    known = asked.select("qid", "set", F.col("answer").alias("gold_answer"), "answerable", "sources")
    io.write_records(found.join(known, "qid"), f"{a.out}/answers-{a.mode}")


def snapshots(spark: SparkSession, a) -> None:
    asked, ix, made = _questions(spark, a), _ready(spark, a), _chunks(spark, a)
    found = retrieve.routes(ix, asked.select("qid", F.col("question").alias("text")), a.k, _models(spark, a), "".join(ROUTES.values()))
    for name, letter in ROUTES.items():
        hits = rag.with_passages(found[letter], made)
        io.write_records(evaluate.snapshot(asked, hits, name, a.k), f"{a.out}/snapshot-{name}")


def metrics(spark: SparkSession, a) -> None:
    asked, reports = _questions(spark, a), None
    for name in ROUTES:
        snap = io.read_snapshot(spark, f"{a.out}/snapshot-{name}")
        evaluate.reconcile(asked, snap).show()
        hits = snap.select("qid", F.posexplode("hits").alias("p", "h")).select("qid", (F.col("p") + 1).alias("rank"), F.col("h.doc").alias("doc"))
        report = evaluate.set_report(evaluate.score_hits(asked, hits, a.k)).withColumn("route", F.lit(name))
        reports = report if reports is None else reports.unionByName(report)
    io.write_records(reports, f"{a.out}/retrieval-metrics")
    evaluate.side_by_side(spark.read.json(f"{a.out}/retrieval-metrics"), "recall").show()


def thresholds(spark: SparkSession, a) -> None:
    for name in ROUTES:
        snap = io.read_snapshot(spark, f"{a.out}/snapshot-{name}")
        scores = snap.select("route", F.col("answerable").alias("positive"), F.get("hits", F.lit(0))["score"].alias("score"))
        io.write_records(calibrate.report(scores), f"{a.out}/thresholds-{name}")


def judged(spark: SparkSession, a) -> None:
    answers = spark.read.schema(schemas.ANSWER.replace("id string, set", "qid string, set", 1)).json(f"{a.out}/answers-{a.mode}")
    replies = judge_table(judge.prompts(answers, _chunks(spark, a)), MechanicalJudge())
    marks = replies.select("qid", F.col("raw").isNull().alias("infra_failed"), evaluate.parse_judge(F.col("raw")).alias("j"))
    rows = answers.join(marks, "qid").select("qid", "set", "infra_failed", *[f"j.{m}" for m in evaluate.JUDGE_METRICS])
    io.write_records(rows, f"{a.out}/judged-{a.mode}")
    evaluate.composite(evaluate.judge_summary(rows)).show()


STEPS = {"pdfs": pdfs, "blocks": blocks, "chunks": chunks, "vectors": vectors, "index": build, "ask": ask, "retrieve": snapshots, "evaluate": metrics, "calibrate": thresholds, "judge": judged}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    p = argparse.ArgumentParser(prog="papyra", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("step", choices=STEPS)
    p.add_argument("--out", required=True, help="folder of all artifacts")
    p.add_argument("--pdfs", help="folder of PDF files")
    p.add_argument("--pages", help="Parquet with page_id and html")
    p.add_argument("--questions", help="JSON array of questions")
    p.add_argument("--set", default="simple", choices=io.QA_SETS)
    p.add_argument("--mode", default="hybrid_rerank", choices=ROUTES)
    p.add_argument("--marker", default=clean.TAIL_MARKER)
    p.add_argument("--k", type=int, default=5)
    p.add_argument("--limit", type=int, default=0, help="first questions only; 0 for all")
    p.add_argument("--threshold", type=float)
    p.add_argument("--dim", type=int, default=256)
    p.add_argument("--chunk-size", type=int, default=chunk.CHUNK_SIZE)
    p.add_argument("--min-chunk", type=int, default=chunk.MIN_CHUNK)
    p.add_argument("--overlap", type=float, default=chunk.OVERLAP_RATIO)
    a = p.parse_args(argv)
    STEPS[a.step](spark or session(), a)


if __name__ == "__main__":
    main()
