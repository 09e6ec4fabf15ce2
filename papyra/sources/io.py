"""Scans and sinks of the records. Parquet is the native form; JSON lines are kept for exchange."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from papyra import schemas
from papyra.operators import layout
from papyra.shared import exists, ship, written

QA_SETS = ("simple", "complex")


def scan_files(spark: SparkSession, folder: str, suffix: str = "pdf") -> DataFrame:
    """(path, content) of the files with a suffix in any case, others left out; order by path where order matters."""
    glob = "*." + "".join(f"[{c.lower()}{c.upper()}]" for c in suffix)
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select("path", "content")


def write_records(df: DataFrame, path: str, fmt: str = "json") -> None:
    df.write.mode("overwrite").format(fmt).save(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.BLOCK).json(path).where("kind is not null")


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Chunks of all JSON-lines files under ``path``; blank lines are skipped."""
    return spark.read.schema(schemas.CHUNK).json(path).where("id is not null")


def read_qa(spark: SparkSession, paths: dict[str, str], sets: str = "all") -> DataFrame:
    """QA records of JSON arrays, by set; a trailing .pdf is taken off the sources, missing lists are empty. ``place`` is a record's
    place: within its file, files in order."""
    wanted = QA_SETS if sets == "all" else (sets,)
    tables = []
    for name in wanted:
        if name in paths:
            t = spark.read.schema(schemas.QA).option("multiLine", True).json(paths[name])
            # An array is read by one task, so the numbers within a file are dense.
            tables.append(t.withColumns({"set": F.lit(name), "place": F.monotonically_increasing_id() + (len(tables) << 52)}))
    if not tables:
        raise FileNotFoundError(f"no QA file for {sets}: {paths}")
    every = tables[0]
    for t in tables[1:]:
        every = every.unionByName(t)
    none = F.array().cast("array<string>")
    bare = F.transform(F.coalesce("sources", none), lambda s: F.regexp_replace(s, r"(?i)\.pdf$", ""))
    return every.select(F.col("id").alias("qid"), "set", "question", "answer", bare.alias("sources"), F.coalesce("evidence", none).alias("evidence"), F.coalesce("answerable", F.lit(True)).alias("answerable"), "place")


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Snapshot rows, one per question: the last of repeats, files in order of their names."""
    rows = spark.read.schema(schemas.SNAPSHOT).json(path).where("qid is not null")
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("n"))
    rows = rows.select(F.struct("set", "answerable", "route", "k", "hits").alias("r"), "qid", place.alias("place"))
    return rows.groupBy("qid").agg(F.max_by("r", "place").alias("r")).select("qid", "r.*")


def write_vectors(rows: DataFrame, path: str) -> None:
    """The vector store, replaced as a whole."""
    rows.write.mode("overwrite").parquet(path)


def open_vectors(spark: SparkSession, path: str) -> DataFrame:
    """The vector store; a missing one is an error."""
    return spark.read.schema(schemas.VECTOR_ROW).parquet(path)


def chunk_texts(answers: DataFrame, chunks: DataFrame) -> DataFrame:
    """``answers`` with the text of each chunk_id."""
    return answers.join(chunks.select(F.col("id").alias("chunk_id"), "text"), "chunk_id", "left")


def block_markdown(kind: Column, text: Column, level: Column, rows: Column) -> Column:
    """Markdown lines of one block; null for a table without rows."""
    width = F.array_max(F.transform(rows, lambda r: F.size(r)))
    line = lambda r: F.concat(F.lit("| "), F.array_join(F.concat(r, F.array_repeat(F.lit(""), width - F.size(r))), " | "), F.lit(" |"))
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), width), " | "), F.lit(" |"))
    table = F.array_join(F.concat(F.array(line(F.get(rows, F.lit(0)))), F.array(rule), F.transform(F.slice(rows, F.lit(2), F.greatest(F.size(rows) - 1, F.lit(0))), line)), "\n")
    return F.when(kind == "heading", F.concat(F.repeat(F.lit("#"), level), F.lit(" "), text)).when(kind == "para", text).when((kind == "table") & (F.size(rows) > 0), table)


def render_markdown(blocks: DataFrame) -> DataFrame:
    """(doc, markdown): blocks in order, a blank line between."""
    lines = blocks.select("doc", "block_idx", block_markdown(F.col("kind"), F.col("text"), F.col("level"), F.col("rows")).alias("md")).where("md is not null")
    parts = F.transform(F.sort_array(F.collect_list(F.struct("block_idx", "md"))), lambda p: p["md"])
    return lines.groupBy("doc").agg(F.concat(F.trim(F.array_join(parts, "\n\n")), F.lit("\n")).alias("markdown"))


def preflight(spark: SparkSession, mode: str, vectors: str, index: str | None = None, chunks: str | None = None, key_ready: bool = True) -> DataFrame:
    """(problem): what is missing for a route. A hybrid route needs an index or chunks to build one from."""
    there = lambda p: p is not None and exists(spark, p)
    problems = [] if key_ready else ["no provider key: set it in the environment or an env file"]
    if not there(vectors):
        problems.append(f"no vector store at {vectors}: write one first")
    if mode == "hybrid_rerank" and not there(index) and not there(chunks):
        problems.append("neither an index nor chunks: chunk the corpus or build the index first")
    return spark.createDataFrame([(p,) for p in problems], "problem string")


def threshold_report_json(report: DataFrame) -> DataFrame:
    return report.select("route", F.to_json(F.struct(*report.columns), {"pretty": "true"}).alias("json"))


def pdf_available() -> bool:
    import importlib.util

    return importlib.util.find_spec("fitz") is not None


def pdf_pages(files: DataFrame) -> DataFrame:
    """Lines and tables of PDF files (path, content) in one pass: a row for each line of text with its spans (line_no), and one for each
    table that is detected (table_no, rows). doc is the file's name without its suffix. A page on which detection fails has no
    tables. Needs the optional PDF library."""
    import pandas as pd

    if not pdf_available():
        raise RuntimeError("reading PDF needs the fitz module; without it start from layout lines")
    columns = ["doc", "page", "line_no", "spans", "table_no", "rows", "x0", "y0", "x1", "y1"]

    def tables_of(page):
        try:
            return [(t.bbox, [[c for c in r or []] for r in t.extract()]) for t in page.find_tables().tables]
        except Exception:
            return []

    def run(frames):
        import fitz

        for pdf in frames:
            found = []
            for path, content in zip(pdf["path"], pdf["content"]):
                name = os.path.splitext(os.path.basename(path))[0]
                for number, page in enumerate(fitz.open(stream=content, filetype="pdf"), 1):
                    lines = [x for b in page.get_text("dict")["blocks"] if b.get("type") == 0 for x in b["lines"]]
                    for n, line in enumerate(lines):
                        spans = [{"text": s["text"], "size": float(s["size"]), "flags": int(s["flags"])} for s in line["spans"]]
                        found.append((name, number, n, spans, None, None, *map(float, line["bbox"])))
                    found += [(name, number, None, None, n, rows, *map(float, box)) for n, (box, rows) in enumerate(tables_of(page))]
            made = pd.DataFrame(found, columns=columns)
            yield made.astype({"line_no": "Int32", "table_no": "Int32"})

    ship(files.sparkSession)
    return files.select("path", "content").mapInPandas(run, "doc string, page int, line_no int, spans array<struct<text: string, size: double, flags: int>>, table_no int, rows array<array<string>>, x0 double, y0 double, x1 double, y1 double")


def pdf_blocks(files: DataFrame) -> DataFrame:
    """Blocks (M2) of PDF files (path, content)."""
    pages = written(pdf_pages(files), "pdf-pages")
    lines = pages.where("line_no is not null").withColumn("l", layout.line_text(F.col("spans"))).where("l is not null").select("doc", "page", "line_no", "l.*", "x0", "y0", "x1", "y1")
    return layout.page_blocks(lines, pages.where("table_no is not null").select("doc", "page", "table_no", "x0", "y0", "x1", "y1", "rows"))
