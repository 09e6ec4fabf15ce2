"""Layout lines to blocks.

What looks at one line, one page or neighbours in order is expressions and windows. Joining the pieces of
headings depends on what was emitted before, across the pages of a document, so ``page_blocks`` folds one document at a
time; documents are the unit of distribution.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from papyra.functions.text import ORDER_NUMBER, is_ascii_edge, join_lines, strip
from papyra.schemas import BLOCK
from papyra.shared import ship

# Distances in points, ratios and lengths of the layout rules.
PARA_GAP = 1.6
RATIO_L1, RATIO_L2 = 1.35, 1.15
SIZE_BAND = 1.0
FULL_TOLERANCE, FULL_RATIO = 6.0, 0.90
BASELINE_TOLERANCE = 2.0
ROW_OVERLAP, ROW_X_TOLERANCE = 0.3, 3.0
ROW_TITLE_MAX, GLYPH_MAX = 20, 2
HEADING_MAX, LEVEL2_MAX, BOLD_MAX = 50, 30, 25
STOPS = "。！？；，,.;"


def line_text(spans: Column) -> Column:
    """Struct of text, size and bold of a line's spans (text, size, flags); null without a span that has text."""
    full = F.filter(spans, lambda s: strip(s["text"]) != "")
    glue = lambda s, t: F.when((s != "") & is_ascii_edge(s, True) & is_ascii_edge(t, False) & ~s.endswith(" ") & ~t.startswith(" "), F.lit(" ")).otherwise(F.lit(""))
    text = strip(F.aggregate(full, F.lit(""), lambda acc, s: F.concat(acc, glue(acc, s["text"]), s["text"])))
    line = F.struct(text.alias("text"), F.array_max(F.transform(full, lambda s: s["size"])).alias("size"), F.exists(full, lambda s: s["flags"].bitwiseAND(16) != 0).alias("bold"))
    return F.when(F.size(full) > 0, line)


def _mode(rows: DataFrame, value: str, weight: Column, first: str, default: float, name: str, pages: DataFrame) -> DataFrame:
    """The heaviest value of each page, the first seen of equals."""
    summed = rows.groupBy("doc", "page", value).agg(F.sum(weight).alias("w"), F.min(first).alias("first"))
    best = summed.groupBy("doc", "page").agg(F.max_by(value, F.struct("w", -F.col("first"))).alias(name))
    return pages.join(best, ["doc", "page"], "left").withColumn(name, F.coalesce(name, F.lit(default)))


def body_size(lines: DataFrame) -> DataFrame:
    """(doc, page, body_size): size to the half point with the most characters."""
    rows = lines.withColumn("half", F.bround(F.col("size") * 2, 0) / 2)
    return _mode(rows, "half", F.length("text"), "line_no", 0.0, "body_size", lines.select("doc", "page").distinct())


def line_height(lines: DataFrame) -> DataFrame:
    """(doc, page, line_h): most frequent distance between neighbouring tops, to the half point; 1 without any."""
    w = Window.partitionBy("doc", "page").orderBy("top")
    gaps = lines.withColumn("top", F.bround("y0", 2)).withColumns({"gap": F.col("top") - F.lag("top").over(w), "nth": F.row_number().over(w)})
    gaps = gaps.where(F.col("gap").between(0.5, 60.0)).withColumn("half", F.bround(F.col("gap") * 2, 0) / 2)
    return _mode(gaps, "half", F.lit(1), "nth", 1.0, "line_h", lines.select("doc", "page").distinct())


def heading_level(text: Column, size: Column, bold: Column, body: Column) -> Column:
    """1 or 2 for a heading, 0 for text."""
    n, ratio = F.length(text), size / F.when(body > 0, body)
    stop = F.instr(F.lit(STOPS), F.substring(text, -1, 1)) > 0
    return (
        F.when(n > HEADING_MAX, 0).when(ratio >= RATIO_L1, 1).when(stop, 0).when((ratio >= RATIO_L2) & (n <= LEVEL2_MAX), 2).when(bold & (n <= BOLD_MAX), 2).otherwise(0)
    )


def is_fake_table(rows: Column) -> Column:
    """One row at most, or never more than one filled cell in a row."""
    filled = F.transform(rows, lambda r: F.size(F.filter(r, lambda c: F.coalesce(c, F.lit("")) != "")))
    return (F.size(rows) <= 1) | (F.coalesce(F.array_max(filled), F.lit(0)) <= 1)


def normalise_table(rows: Column) -> Column:
    """Cells stripped, nulls empty, rows without content dropped."""
    cells = F.transform(rows, lambda r: F.transform(r, lambda c: strip(F.coalesce(c, F.lit("")))))
    return F.filter(cells, lambda r: F.exists(r, lambda c: c != ""))


def inside_tables(lines: DataFrame, tables: DataFrame) -> DataFrame:
    """Lines that lie fully in the rectangle of a table of their page."""
    t = tables.select(F.col("doc").alias("d"), F.col("page").alias("p"), *[F.col(c).alias(f"t_{c}") for c in ("x0", "y0", "x1", "y1")])
    on = (F.col("doc") == F.col("d")) & (F.col("page") == F.col("p")) & (F.col("x0") >= F.col("t_x0")) & (F.col("y0") >= F.col("t_y0")) & (F.col("x1") <= F.col("t_x1")) & (F.col("y1") <= F.col("t_y1"))
    return lines.join(t, on, "left_semi")


def reading_order(lines: DataFrame) -> DataFrame:
    return lines.withColumn("place", F.row_number().over(Window.partitionBy("doc", "page").orderBy(F.bround("y0", 2), "x0", "line_no")))


def merge_paragraphs(lines: DataFrame, heights: DataFrame) -> DataFrame:
    """(doc, page, para, text): consecutive lines whose tops are at most 1.6 line heights apart."""
    w = Window.partitionBy("doc", "page").orderBy("place")
    ordered = reading_order(lines).join(heights, ["doc", "page"])
    gap = F.col("y0") - F.lag("y0").over(w) > F.greatest(F.lit(1.0), F.col("line_h") * PARA_GAP)
    grouped = ordered.withColumn("new", F.coalesce(gap, F.lit(False)).cast("int")).withColumn("para", F.sum("new").over(w))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("place", "text"))), lambda p: p["text"])
    return grouped.groupBy("doc", "page", "para").agg(strip(join_lines(parts)).alias("text")).where("text <> ''")


def without_order_numbers(lines: DataFrame) -> DataFrame:
    return lines.where(~F.col("text").rlike(ORDER_NUMBER))


@dataclass
class _Line:
    text: str
    size: float
    bold: bool
    x0: float
    y0: float
    x1: float
    y1: float

    def within(self, box) -> bool:
        return self.x0 >= box[0] and self.y0 >= box[1] and self.x1 <= box[2] and self.y1 <= box[3]


def _glued(parts: list[str]) -> str:
    out = ""
    for p in parts:
        out += (" " if out and p and out[-1].isascii() and p[0].isascii() else "") + p
    return out


def _level(line: _Line, body: float) -> int:
    n, ratio = len(line.text), line.size / body if body > 0 else 0.0
    if n > HEADING_MAX:
        return 0
    if ratio >= RATIO_L1:
        return 1
    if line.text[-1:] in STOPS:
        return 0
    return 2 if (ratio >= RATIO_L2 and n <= LEVEL2_MAX) or (line.bold and n <= BOLD_MAX) else 0


def join_glyphs(lines: list[_Line], body: float) -> list[_Line]:
    """Lines of one page with headings set glyph by glyph put together. A run takes glyphs of one size whose heights overlap
    and whose widths don't; a run longer than a title is left as it was."""
    runs: list[tuple[list[_Line], _Line]] = []
    for line in sorted(lines, key=lambda x: (x.y0, x.x0)):
        if runs:
            run, box = runs[-1]
            glyphs = len(line.text) <= GLYPH_MAX and len(run[0].text) <= GLYPH_MAX and _level(line, body) and _level(run[0], body)
            tall = min(box.y1, line.y1) - max(box.y0, line.y0) >= ROW_OVERLAP * min(box.y1 - box.y0, line.y1 - line.y0)
            apart = min(box.x1, line.x1) - max(box.x0, line.x0) <= ROW_X_TOLERANCE
            if glyphs and tall and apart and abs(line.size - box.size) <= SIZE_BAND:
                union = replace(box, x0=min(box.x0, line.x0), y0=min(box.y0, line.y0), x1=max(box.x1, line.x1), y1=max(box.y1, line.y1), size=max(box.size, line.size), bold=box.bold or line.bold)
                runs[-1] = (run + [line], union)
                continue
        runs.append(([line], replace(line)))
    out = []
    for run, box in runs:
        text = _glued([x.text for x in sorted(run, key=lambda x: x.x0)])
        out += run if len(text) > ROW_TITLE_MAX else [replace(box, text=text)]
    return out


class _Heading:
    """The heading that a following line may continue."""

    def __init__(self, block: dict, line: _Line, full: bool):
        self.block, self.line, self.full = block, line, full

    def takes(self, line: _Line, level: int, gap: float) -> bool:
        near = line.y0 - self.line.y1 <= gap and abs(line.size - self.line.size) <= SIZE_BAND
        return self.block["level"] == level and near and (self.full or abs(line.y0 - self.line.y0) <= BASELINE_TOLERANCE)


def blocks_of_document(pages: list[tuple[int, list[_Line], list[tuple[tuple, list]], float, float]]) -> list[dict]:
    """Blocks of the pages (number, lines, tables as (box, rows), body size, line height) of one document, in order."""
    import re

    order_number, blocks, seen = re.compile(ORDER_NUMBER.removeprefix("(?U)")), [], set()
    for page, lines, tables, body, height in pages:
        real = [box for box, rows in tables if len(rows) > 1 and max(sum(bool(c) for c in r) for r in rows) > 1]
        fake = [box for box, _ in tables if box not in real]
        blocks += [{"kind": "table", "text": "", "level": 1, "rows": rows, "page": page} for box, rows in tables if box in real]
        gap, edge = max(1.0, height * PARA_GAP), max((x.x1 for x in lines), default=0.0)
        waiting: list[_Line] = []
        heading: _Heading | None = None

        def flush():
            paras: list[list[str]] = []
            for before, line in zip([None, *waiting], waiting):
                if before is None or line.y0 - before.y0 > gap:
                    paras.append([])
                paras[-1].append(line.text)
            waiting.clear()
            texts = [_glued(p).strip() for p in paras]
            blocks.extend({"kind": "para", "text": t, "level": 1, "rows": [], "page": page} for t in texts if t)

        for line in sorted(join_glyphs(lines, body), key=lambda x: (round(x.y0, 2), x.x0)):
            if any(line.within(b) for b in real):
                flush()
                heading = None
                continue
            level = _level(line, body)
            if any(line.within(b) for b in fake):
                level = 2 if len(line.text) <= LEVEL2_MAX and line.text[-1:] not in STOPS else 0
            if not level:
                if not order_number.match(line.text):
                    heading = None
                    waiting.append(line)
                continue
            flush()
            full = line.x1 >= edge - FULL_TOLERANCE or line.x1 >= edge * FULL_RATIO
            if heading is not None and heading.takes(line, level, gap):
                heading.block["text"] = _glued([heading.block["text"], line.text])
                heading = _Heading(heading.block, line, full)
            elif (line.text, level) in seen:
                heading = None
            else:
                seen.add((line.text, level))
                blocks.append({"kind": "heading", "text": line.text, "level": level, "rows": [], "page": page})
                heading = _Heading(blocks[-1], line, full)
        flush()
    return blocks


def page_blocks(lines: DataFrame, tables: DataFrame) -> DataFrame:
    """Blocks (M2) of layout lines and detected tables: tables of a page first, then its text in reading order; paragraphs end
    with their page, headings that a document repeats are given once."""
    kept = tables.withColumn("rows", normalise_table(F.col("rows"))).where(F.size("rows") > 0)
    figures = body_size(lines).join(line_height(lines), ["doc", "page"])
    boxed = kept.groupBy("doc", "page").agg(F.sort_array(F.collect_list(F.struct("table_no", "x0", "y0", "x1", "y1", "rows"))).alias("tables"))
    line = F.struct("line_no", "text", "size", "bold", "x0", "y0", "x1", "y1")
    pages = lines.groupBy("doc", "page").agg(F.sort_array(F.collect_list(line)).alias("lines")).join(figures, ["doc", "page"]).join(boxed, ["doc", "page"], "full")

    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pages.select("doc", "page", "lines", "tables", "body_size", "line_h").repartition(parts, "doc").sortWithinPartitions("doc", "page")
    fields = [f.split() for f in BLOCK.split(", ")]
    kinds = {"string": pa.string(), "int": pa.int32(), "array<array<string>>": pa.list_(pa.list_(pa.string()))}

    def given(page, own, tables, body, height):
        boxes = [((t["x0"], t["y0"], t["x1"], t["y1"]), t["rows"]) for t in tables or []]
        return int(page), [_Line(*(x[c] for c in ("text", "size", "bold", "x0", "y0", "x1", "y1"))) for x in own or []], boxes, float(body or 0.0), float(height or 1.0)

    def out(made):
        return pa.RecordBatch.from_arrays([pa.array([b[name] for b in made], kinds[kind]) for name, kind in fields], [name for name, _ in fields])

    def fold(batches):
        """Rows in order of document and page: a document's pages are held until the next one begins."""
        doc, held, made = None, [], []

        def close():
            made.extend({**b, "doc": doc, "block_idx": k} for k, b in enumerate(blocks_of_document(held)))
            held.clear()

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if held and row[0] != doc:
                    close()
                doc = row[0]
                held.append(given(*row[1:]))
            if len(made) > 4096:
                yield out(made)
                made.clear()
        if held:
            close()
        yield out(made)

    ship(lines.sparkSession)
    return dealt.mapInArrow(fold, BLOCK)
