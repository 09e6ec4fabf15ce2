"""Structure-aware chunking: sections, greedy packing, overlap, provenance and ids.

Everything is an expression over a document's sections: one ordered aggregation per section, folds inside the row, and
one shuffle by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from papyra.functions.text import let, sentences, strip
from papyra.operators.ranks import global_row_number, prefix_sums
from papyra.shared import written

CHUNK_SIZE, MIN_CHUNK, OVERLAP_RATIO = 300, 100, 0.15
BROADCAST_DOCUMENTS = 200_000

_GROUP = "struct<parts: array<string>, idx: array<int>, chars: int>"


def overlap_chars(chunk_size: int = CHUNK_SIZE, ratio: float = OVERLAP_RATIO) -> int:
    return max(1, int(chunk_size * ratio))


def title_stack(headings: Column) -> Column:
    """Fold of (level, text) in order: a heading of level n replaces what stands at n and below."""
    step = lambda s, h: F.concat(F.slice(s, F.lit(1), F.greatest(h["level"], F.lit(1)) - 1), F.array(h["text"]))
    return F.aggregate(headings, F.array().cast("array<string>"), step)


def assign_sections(blocks: DataFrame) -> DataFrame:
    """``blocks`` with section number and section_path; blocks before any heading are in section 0 with an empty path."""
    order = Window.partitionBy("doc").orderBy("block_idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    heading = F.col("kind") == "heading"
    numbered = blocks.withColumn("section", F.sum(heading.cast("int")).over(order))
    heads = F.sort_array(F.collect_list(F.when(heading, F.struct("block_idx", F.coalesce("level", F.lit(1)).alias("level"), "text"))))
    none = F.array().cast("array<string>")
    above = lambda all_: F.when(F.size(all_) > 0, F.element_at(all_, -1)).otherwise(none)
    step = lambda all_, h: F.concat(all_, F.array(F.concat(F.slice(above(all_), F.lit(1), F.greatest(h["level"], F.lit(1)) - 1), F.array(h["text"]))))
    paths = blocks.groupBy("doc").agg(heads.alias("heads")).select("doc", F.aggregate("heads", F.array().cast("array<array<string>>"), step).alias("paths"))
    path = F.when(F.col("section") > 0, F.get("paths", (F.col("section") - 1).cast("int"))).otherwise(none)
    return numbered.join(paths, "doc").withColumn("section_path", path).drop("paths")


def split_long(text: Column, chunk_size: int) -> Column:
    """Greedy groups of sentences up to ``chunk_size`` characters; a longer sentence is a group of its own."""
    empty = F.struct(F.array().cast("array<string>").alias("out"), F.lit("").alias("cur"))

    def step(acc: Column, s: Column) -> Column:
        full = (acc["cur"] != "") & (F.length(acc["cur"]) + F.length(s) > chunk_size)
        return F.struct(F.when(full, F.concat(acc["out"], F.array(acc["cur"]))).otherwise(acc["out"]).alias("out"), F.when(full, s).otherwise(F.concat(acc["cur"], s)).alias("cur"))

    return F.aggregate(sentences(text), empty, step, lambda a: F.when(a["cur"] != "", F.concat(a["out"], F.array(a["cur"]))).otherwise(a["out"]))


def _group(parts: Column, idx: Column, chars: Column) -> Column:
    return F.struct(parts.alias("parts"), idx.alias("idx"), chars.cast("int").alias("chars")).cast(_GROUP)


def pack_paragraphs(paras: Column, chunk_size: int = CHUNK_SIZE, min_chunk: int = MIN_CHUNK) -> Column:
    """Fold of (block_idx, text) in order into groups. A group is closed when the next paragraph would take it past
    ``chunk_size`` and it has ``min_chunk`` already; a paragraph over ``chunk_size`` closes the group and is split."""
    nothing = _group(F.array().cast("array<string>"), F.array().cast("array<int>"), F.lit(0))
    start = F.struct(F.array().cast(f"array<{_GROUP}>").alias("out"), nothing.alias("cur"))

    def closed(acc: Column) -> Column:
        return F.when(acc["cur"]["chars"] > 0, F.concat(acc["out"], F.array(acc["cur"]))).otherwise(acc["out"])

    def step(acc: Column, p: Column) -> Column:
        n, cur = F.length(p["text"]), acc["cur"]
        own = _group(F.array(p["text"]), F.array(p["block_idx"]), n)
        grown = _group(F.concat(cur["parts"], F.array(p["text"])), F.concat(cur["idx"], F.array(p["block_idx"])), cur["chars"] + n)
        pieces = F.transform(split_long(p["text"], chunk_size), lambda t: _group(F.array(t), F.array(p["block_idx"]), F.length(t)))
        full = (cur["chars"] > 0) & (cur["chars"] + n > chunk_size) & (cur["chars"] >= min_chunk)
        return (
            F.when(n > chunk_size, F.struct(F.concat(closed(acc), pieces).alias("out"), nothing.alias("cur")))
            .when(full, F.struct(closed(acc).alias("out"), own.alias("cur")))
            .otherwise(F.struct(acc["out"].alias("out"), grown.alias("cur")))
        )

    return F.aggregate(paras, start, step, closed)


def fuse_small(groups: Column, min_chunk: int = MIN_CHUNK) -> Column:
    """Each group under ``min_chunk`` characters, but the first, goes into the one before it."""

    def step(out: Column, g: Column) -> Column:
        last = F.element_at(out, -1)
        both = _group(F.concat(last["parts"], g["parts"]), F.concat(last["idx"], g["idx"]), last["chars"] + g["chars"])
        small = (F.size(out) > 0) & (g["chars"] < min_chunk)
        return F.when(small, F.concat(F.slice(out, F.lit(1), F.size(out) - 1), F.array(both))).otherwise(F.concat(out, F.array(g)))

    return F.aggregate(groups, F.array().cast(f"array<{_GROUP}>"), step)


def overlap_tail(text: Column, least: int) -> Column:
    """The fewest closing sentences of ``text`` that come to ``least`` characters, joined without anything between."""

    def tail(s: Column) -> Column:
        after = lambda i: F.aggregate(F.slice(s, i + 2, F.size(s)), F.lit(0), lambda n, t: n + F.length(t))
        return F.array_join(F.filter(s, lambda t, i: after(i) < least), "")

    return let(sentences(text), tail)


def chunk_run(paras: Column, chunk_size: int, min_chunk: int, least: int) -> Column:
    """Groups of one run of paragraphs as (text without prefix, source block numbers)."""

    def texts(groups: Column) -> Column:
        body = lambda g: F.array_join(g["parts"], "\n")
        before = lambda i: F.when(i > 0, overlap_tail(body(F.get(groups, i - 1)), least)).otherwise(F.lit(""))
        return F.transform(groups, lambda g, i: F.struct(F.array_join(F.filter(F.array(before(i), body(g)), lambda t: t != ""), "\n").alias("text"), g["idx"].alias("idx")))

    return let(fuse_small(pack_paragraphs(paras, chunk_size, min_chunk), min_chunk), texts)


def table_text(rows: Column) -> Column:
    return F.array_join(F.transform(rows, lambda r: F.array_join(r, " | ", "")), "\n")


def chunk_blocks(blocks: DataFrame, chunk_size: int = CHUNK_SIZE, min_chunk: int = MIN_CHUNK, overlap_ratio: float = OVERLAP_RATIO, ids: bool = True) -> DataFrame:
    """Chunks of all documents, with dense ids in order of document and place (``seq`` is the place within the document)."""
    least = overlap_chars(chunk_size, overlap_ratio)
    # One shuffle, by document: the windows and groups below all lie within a document.
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rest = assign_sections(blocks.repartition(parts, "doc")).where(F.col("kind") != "heading")
    order = Window.partitionBy("doc", "section").orderBy("block_idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    table = F.col("kind") == "table"
    # Every table is a run of its own; paragraphs between two tables are one run.
    run = 2 * F.sum(table.cast("int")).over(order) - table.cast("int")
    runs = rest.withColumn("run", run).groupBy("doc", "section", "run", table.alias("is_table")).agg(
        F.any_value("section_path").alias("section_path"),
        F.sort_array(F.collect_list(F.struct("block_idx", F.coalesce("text", F.lit("")).alias("text")))).alias("paras"),
        F.map_from_entries(F.collect_list(F.struct("block_idx", F.coalesce("page", F.lit(0)).alias("page")))).alias("pages"),
        F.max_by("rows", "block_idx").alias("rows"),
    )
    from_table = F.array(F.struct(table_text(F.col("rows")).alias("text"), F.transform("paras", lambda p: p["block_idx"]).alias("idx")))
    pieces = F.when(F.col("is_table"), from_table).otherwise(chunk_run(F.col("paras"), chunk_size, min_chunk, least))
    prefix = F.when(F.size("section_path") > 0, F.concat(F.array_join("section_path", " > "), F.lit("\n"))).otherwise(F.lit(""))
    flat = runs.select("doc", "section", "run", "is_table", "section_path", "rows", "pages", prefix.alias("prefix"), F.posexplode(pieces).alias("piece", "p"))
    pages = F.transform("p.idx", lambda b: F.element_at("pages", b))
    chunks = flat.select(
        "doc", "section", "run", "piece", "section_path", F.concat("prefix", "p.text").alias("text"),
        F.when(F.col("is_table"), F.col("rows")).otherwise(F.array().cast("array<array<string>>")).alias("rows"),
        F.coalesce(F.array_min(pages), F.lit(0)).alias("start_page"), F.coalesce(F.array_max(pages), F.lit(0)).alias("end_page"),
    )
    chunks = merge_tails(chunks, min_chunk)
    if not ids:
        return chunks
    placed = written(chunks.withColumn("place", F.row_number().over(Window.partitionBy("doc").orderBy("section", "run", "piece"))), "chunks")
    counts = written(global_row_number(placed.groupBy("doc").agg(F.count("*").alias("n")), ["doc"], "nth"), "chunk-counts")
    offsets = prefix_sums(counts, "nth", "n", "offset").select("doc", "offset")
    offsets = F.broadcast(offsets) if counts.count() <= BROADCAST_DOCUMENTS else offsets
    seq = (F.col("offset") + F.col("place")).cast("long")
    return placed.join(offsets, "doc").select(F.format_string("chunk_%06d", seq).alias("id"), "doc", "section_path", "text", "rows", "start_page", "end_page", seq.alias("seq"))


def merge_tails(chunks: DataFrame, min_chunk: int = MIN_CHUNK) -> DataFrame:
    """Per section, a last chunk whose text is under ``min_chunk`` characters and that is no table goes to the end of the one
    before it, which may be a table; page ranges are united."""
    w = Window.partitionBy("doc", "section").orderBy("run", "piece")
    after = F.lead(F.struct("text", F.size("rows").alias("n_rows"), "start_page", "end_page")).over(w)
    last = F.lead(F.lit(1), 2).over(w).isNull()
    marked = chunks.withColumns({"_next": after, "_next_last": last, "_is_last": F.lead(F.lit(1)).over(w).isNull(), "_first": F.row_number().over(w) == 1})
    takes = F.col("_next").isNotNull() & F.col("_next_last") & (F.col("_next.n_rows") == 0) & (F.length("_next.text") < min_chunk)
    gone = F.col("_is_last") & ~F.col("_first") & (F.size("rows") == 0) & (F.length("text") < min_chunk)
    page = lambda f, c: F.when(takes, f(F.col(c), F.col(f"_next.{c}"))).otherwise(F.col(c))
    joined = F.concat(F.regexp_replace("text", r"(?U)\s+$", ""), F.lit("\n"), strip(F.col("_next.text")))
    merged = marked.where(~gone).withColumns({"text": F.when(takes, joined).otherwise(F.col("text")), "start_page": page(F.least, "start_page"), "end_page": page(F.greatest, "end_page")})
    return merged.drop("_next", "_next_last", "_is_last", "_first")


def describe_chunks(chunks: DataFrame) -> DataFrame:
    n = F.length("text")
    return chunks.agg(F.count("*").alias("n_chunks"), F.bround(F.avg(n), 1).alias("mean_chars"), F.max(n).alias("max_chars"), F.min(n).alias("min_chars"))
