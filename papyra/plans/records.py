"""More queries of the library proper: marked and laid-out lines with tables, artifacts written and read back, and the steps behind
providers, run with stand-ins whose results SQL can give too. Importing this module adds them to the catalog's tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyra.functions import text as T
from papyra.operators import calibrate, chunk, clean, evaluate, generate, index, judge, layout, rag, retrieve
from papyra.plans import catalog as c
from papyra.plans.catalog import TOP_K, query, read
from papyra.providers import LetterEmbedder, OverlapReranker, ProviderError, dimension, embed_table, load_env
from papyra.shared import shared_path, written
from papyra.sources import html, io

# ---- text with page marks, dates and ideographs -------------------------------------------------------------------

_MARKED = (
    c._LINES
    + """, marked AS (
  SELECT doc_id, line_no, CASE line_no % 8
    WHEN 0 THEN '第 ' || line_no || ' 页 / 共 90 页' WHEN 1 THEN ' ' || line_no || ' ' WHEN 2 THEN '2026年4月' || (line_no % 28 + 1) || '日 18:32某处听全文'
    WHEN 3 THEN '2026 年 4 月 ' || line_no || ' 日' WHEN 4 THEN left(text, 20) || ' 中文 abc 字　，' || line_no || ' ：end' WHEN 5 THEN '<!-- ' || left(text, 9) || ' -->' || text
    WHEN 6 THEN '2026年 4月 1日  9:05 ' || line_no || '人' ELSE text END AS text FROM lines)"""
)


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the documents, seven of eight replaced by or mixed with page marks, numbers, dates, ideographs and comments."""
    n, t = F.col("line_no").cast("string"), F.col("text")
    kinds = [
        F.concat(F.lit("第 "), n, F.lit(" 页 / 共 90 页")), F.concat(F.lit(" "), n, F.lit(" ")), F.concat(F.lit("2026年4月"), (F.col("line_no") % 28 + 1).cast("string"), F.lit("日 18:32某处听全文")),
        F.concat(F.lit("2026 年 4 月 "), n, F.lit(" 日")), F.concat(F.left(t, F.lit(20)), F.lit(" 中文 abc 字　，"), n, F.lit(" ：end")), F.concat(F.lit("<!-- "), F.left(t, F.lit(9)), F.lit(" -->"), t),
        F.concat(F.lit("2026年 4月 1日  9:05 "), n, F.lit("人")), t,
    ]
    chosen = kinds[-1]
    for k, kind in enumerate(kinds[:-1]):
        chosen = F.when(F.col("line_no") % 8 == k, kind).otherwise(chosen)
    return c._doc_lines(spark, sf_dir).select("doc_id", "line_no", chosen.alias("text"))


@query(f"WITH {_MARKED} SELECT doc_id, line_no % 8 AS kind, count(*) AS lines, count(*) FILTER (WHERE {c._NOISE}) AS noise FROM marked GROUP BY doc_id, kind")
def noise_marks(spark, sf_dir):
    return _marked(spark, sf_dir).groupBy("doc_id", (F.col("line_no") % 8).cast("long").alias("kind")).agg(F.count("*").alias("lines"), F.count_if(T.is_noise(F.col("text"))).alias("noise"))


@query(f"WITH {_MARKED}, n AS (SELECT doc_id, line_no, {c._NORMAL} AS text FROM marked) SELECT doc_id, line_no::BIGINT AS line_no, length(text)::BIGINT AS chars, md5(text) AS digest FROM n")
def normalize_marks(spark, sf_dir):
    rows = _marked(spark, sf_dir).select("doc_id", F.col("line_no").cast("long").alias("line_no"), T.normalise_space(F.col("text")).alias("t"))
    return rows.select("doc_id", "line_no", F.length("t").cast("long").alias("chars"), F.md5(F.col("t").cast("binary")).alias("digest"))


@query(f"WITH {_MARKED} SELECT doc_id, line_no::BIGINT AS line_no, len({c._TOKENS})::BIGINT AS n_tokens, array_to_string({c._TOKENS}, ' ') AS toks FROM marked")
def tokenize_marks(spark, sf_dir):
    toks = T.tokens(F.col("text"))
    return _marked(spark, sf_dir).select("doc_id", F.col("line_no").cast("long").alias("line_no"), F.size(toks).cast("long").alias("n_tokens"), F.array_join(toks, " ").alias("toks"))


def _blank_words(text: str) -> list[str]:
    """A segmenter for the query below: words between single blanks, some of them empty."""
    return text.split(" ")


@query("SELECT tok, count(DISTINCT id) AS docs, count(*) AS n FROM (SELECT item_id AS id, unnest(list_filter(string_split(lower(text), ' '), lambda t: trim(t) <> '')) AS tok FROM benchmark) GROUP BY tok")
def segmented_terms(spark, sf_dir):
    """The index of the questions, cut by a given segmenter."""
    corpus = read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text")
    ix = index.build(corpus, segment=_blank_words)
    return ix.postings.groupBy("tok").agg(F.count("*").alias("docs"), F.sum("tf").alias("n"))


# ---- layout with spans and tables ---------------------------------------------------------------------------------

_SPANS = r"""
spans AS (SELECT doc_id, line_no, list_transform(string_split(text, ' '), lambda w, i: CASE WHEN i % 4 = 0 THEN '字' || w || ' ' WHEN i % 4 = 2 THEN w || '，' WHEN i % 7 = 0 THEN '  ' ELSE w END) AS parts FROM lines),
full_ AS (SELECT doc_id, line_no, list_filter(parts, lambda p: trim(p) <> '') AS parts FROM spans)"""


@query(
    f"WITH {c._LINES}, {_SPANS} SELECT doc_id, line_no::BIGINT AS line_no, md5(trim(list_reduce(parts, lambda s, t: s || CASE WHEN unicode(right(s, 1)) < 128 AND unicode(left(t, 1)) < 128 AND right(s, 1) <> ' ' AND left(t, 1) <> ' ' THEN ' ' ELSE '' END || t))) AS digest, "
    "list_max(list_transform(parts, lambda p: length(p) % 4 + 8))::DOUBLE AS size, len(list_filter(parts, lambda p: length(p) % 5 = 0)) > 0 AS bold FROM full_ WHERE len(parts) > 0"
)
def line_text(spark, sf_dir):
    words = F.transform(F.split("text", " ", -1), lambda w, i: F.when((i + 1) % 4 == 0, F.concat(F.lit("字"), w, F.lit(" "))).when((i + 1) % 4 == 2, F.concat(w, F.lit("，"))).when((i + 1) % 7 == 0, F.lit("  ")).otherwise(w))
    spans = F.transform(words, lambda w: F.struct(w.alias("text"), (F.length(w) % 4 + 8).cast("double").alias("size"), F.when(F.length(w) % 5 == 0, 20).otherwise(4).alias("flags")))
    lines = c._doc_lines(spark, sf_dir).select("doc_id", F.col("line_no").cast("long").alias("line_no"), layout.line_text(spans).alias("l")).where("l is not null")
    return lines.select("doc_id", "line_no", F.md5(F.col("l.text").cast("binary")).alias("digest"), "l.size", "l.bold")


@query(
    "WITH r AS (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x: list_transform(string_split(x, ','), lambda v, i: CASE WHEN i % 3 = 0 THEN '' WHEN length(x) % 5 = 0 THEN ' ' ELSE trim(v) END)) AS rows FROM documents WHERE text IS NOT NULL), "
    "k AS (SELECT doc_id, list_filter(rows, lambda x: len(list_filter(x, lambda v: trim(v) <> '')) > 0) AS rows FROM r) "
    "SELECT doc_id, len(rows)::BIGINT AS rows, md5(array_to_string(list_transform(rows, lambda x: array_to_string(list_transform(x, lambda v: trim(v)), '|')), chr(10))) AS digest FROM k"
)
def table_normalise(spark, sf_dir):
    """The lines of a document as rows, their clauses as cells, some null, some blank."""
    cell = lambda x: F.transform(F.split(x, ",", -1), lambda v, i: F.when((i + 1) % 3 == 0, F.lit(None)).when(F.length(x) % 5 == 0, F.lit(" ")).otherwise(v))
    made = read(spark, sf_dir, "documents").where("text is not null").select("doc_id", layout.normalise_table(F.transform(F.split("text", "\n", -1), cell)).alias("rows"))
    return made.select("doc_id", F.size("rows").cast("long").alias("rows"), F.md5(F.array_join(F.transform("rows", lambda r: F.array_join(r, "|")), "\n").cast("binary")).alias("digest"))


_GLUE = "list_reduce(list(text ORDER BY rn), lambda s, t: s || CASE WHEN s <> '' AND t <> '' AND unicode(right(s, 1)) < 128 AND unicode(left(t, 1)) < 128 THEN ' ' ELSE '' END || t)"
_FOLD = rf"""
WITH RECURSIVE {c._LAYOUT}, numbered AS (SELECT * REPLACE (CASE WHEN line_no % 11 = 5 THEN line_no % 90 || '.' ELSE text END AS text) FROM lay),
{c._BODY.replace("FROM lay ", "FROM numbered ")}, {c._HEIGHT},
o AS (
  SELECT numbered.*, body_size, greatest(1.0, line_h * 1.6) AS gap, max(x1) OVER (PARTITION BY doc, page) AS edge, contains('。！？；，,.;', right(text, 1)) AS stop,
         x0 >= 0 AND x1 <= 300 AND y0 >= 100 AND y1 <= 200 AND page % 3 = 1 AS in_real, x0 >= 0 AND x1 <= 300 AND y0 >= 200 AND y1 <= 400 AND page % 3 = 2 AS in_fake
  FROM numbered JOIN body USING (doc, page) JOIN height USING (doc, page)),
v AS (
  SELECT *, row_number() OVER (PARTITION BY doc ORDER BY page, round_even(y0, 2), x0, line_no) AS rn, regexp_matches(text, '^\d{{1,3}}[.、．]?$') AS num, x1 >= edge - 6 OR x1 >= edge * 0.9 AS wide,
    CASE WHEN in_fake THEN CASE WHEN length(text) <= 30 AND NOT stop THEN 2 ELSE 0 END WHEN length(text) > 50 THEN 0 WHEN size / body_size >= 1.35 THEN 1 WHEN stop THEN 0
         WHEN size / body_size >= 1.15 AND length(text) <= 30 THEN 2 WHEN bold AND length(text) <= 25 THEN 2 ELSE 0 END AS level
  FROM o),
r AS (
  SELECT DISTINCT doc, 0::BIGINT AS rn, 0::BIGINT AS page, NULL::BIGINT AS own, 0 AS level, false AS hon, 0 AS hlevel, 0.0::DOUBLE AS hy0, 0.0::DOUBLE AS hy1, 0.0::DOUBLE AS hsize, false AS hwide, 0::BIGINT AS hblk,
         []::VARCHAR[] AS seen, 0::BIGINT AS blk, false AS pon, 0.0::DOUBLE AS py0, 0::BIGINT AS pblk, '' AS text FROM v
  UNION ALL
  SELECT doc, rn, page, own, level, CASE WHEN skip THEN hon0 ELSE level > 0 AND NOT in_real AND own IS NOT NULL END, CASE WHEN skip THEN hlevel ELSE level END, CASE WHEN skip THEN hy0 ELSE y0 END, CASE WHEN skip THEN hy1 ELSE y1 END,
         CASE WHEN skip THEN hsize ELSE size END, CASE WHEN skip THEN hwide ELSE wide END, CASE WHEN skip THEN hblk ELSE coalesce(own, 0) END,
         CASE WHEN level > 0 AND NOT in_real AND NOT takes AND own IS NOT NULL THEN list_append(seen, level || '|' || text) ELSE seen END, greatest(blk, coalesce(own, 0)),
         CASE WHEN skip THEN pon0 ELSE level = 0 AND NOT in_real END, CASE WHEN skip THEN py0 ELSE y0 END, CASE WHEN skip THEN pblk ELSE coalesce(own, 0) END, text
  FROM (
    SELECT *, CASE WHEN in_real OR skip THEN NULL WHEN level = 0 THEN CASE WHEN pon0 AND y0 - py0 <= gap THEN pblk ELSE blk + 1 END WHEN takes THEN hblk WHEN list_contains(seen, level || '|' || text) THEN NULL ELSE blk + 1 END AS own
    FROM (
      SELECT v.doc, v.rn, v.page, v.level, v.y0, v.y1, v.size, v.wide, v.text, v.gap, v.in_real, NOT v.in_real AND v.level = 0 AND v.num AS skip, r.hon AND r.page = v.page AS hon0, r.pon AND r.page = v.page AS pon0,
             r.hlevel, r.hy0, r.hy1, r.hsize, r.hwide, r.hblk, r.seen, r.blk, r.py0, r.pblk,
             NOT v.in_real AND v.level > 0 AND r.hon AND r.page = v.page AND r.hlevel = v.level AND v.y0 - r.hy1 <= v.gap AND abs(v.size - r.hsize) <= 1 AND (r.hwide OR abs(v.y0 - r.hy0) <= 2) AS takes
      FROM r JOIN v ON v.doc = r.doc AND v.rn = r.rn + 1))),
made AS (SELECT doc, own, min(page) AS page, max(level) AS level, {_GLUE} AS text FROM r WHERE own IS NOT NULL GROUP BY doc, own),
every AS (
  SELECT doc, page, own, CASE WHEN level > 0 THEN 'heading' ELSE 'para' END AS kind, CASE WHEN level > 0 THEN text ELSE trim(text) END AS text, greatest(level, 1) AS level, 0 AS cells FROM made WHERE level > 0 OR trim(text) <> ''
  UNION ALL SELECT DISTINCT doc, page, -1, 'table', '', 1, 3 FROM lay WHERE page % 3 = 1)
SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY page, own) - 1 AS block_idx, kind, text, level::BIGINT AS level, page::BIGINT AS page, cells::BIGINT AS cells FROM every"""


# The same rows without tables and order numbers.
_PLAIN = _FOLD.replace("line_no % 11 = 5", "false").replace("page % 3 = 1", "false").replace("page % 3 = 2", "false")
c.ORACLE_SQL["layout_blocks"] = f"SELECT doc, block_idx, kind, text, level, page FROM ({_PLAIN})"


@query(_FOLD)
def layout_tables(spark, sf_dir):
    """Blocks of the documents' layout lines, with a real table on every third page, one that is none on every third, and order numbers."""
    lines = c._layout(spark, sf_dir).withColumn("text", F.when(F.col("line_no") % 11 == 5, F.concat((F.col("line_no") % 90).cast("string"), F.lit("."))).otherwise(F.col("text")))
    pages = lines.select("doc", "page").distinct()
    box = lambda y0, y1: [F.lit(v).alias(n) for n, v in (("x0", 0.0), ("y0", y0), ("x1", 300.0), ("y1", y1))]
    rows = lambda *given: F.array(*[F.array(*[F.lit(v) for v in r]) for r in given]).alias("rows")
    real = pages.where("page % 3 = 1").select("doc", "page", F.lit(0).alias("table_no"), *box(100.0, 200.0), rows((" k ", "v"), ("", " "), ("1", "")))
    fake = pages.where("page % 3 = 2").select("doc", "page", F.lit(0).alias("table_no"), *box(200.0, 400.0), rows(("only", ""), (" ", "")))
    made = layout.page_blocks(lines, real.unionByName(fake))
    cells = F.size(F.filter(F.flatten("rows"), lambda v: v != "")).cast("long")
    return made.select("doc", F.col("block_idx").cast("long").alias("block_idx"), "kind", "text", F.col("level").cast("long").alias("level"), F.col("page").cast("long").alias("page"), cells.alias("cells"))


_GLYPHS = "g AS (SELECT doc_id::VARCHAR AS doc, doc_id, 3 + doc_id % 16 AS n, line FROM (SELECT doc_id, regexp_replace(text, '[^A-Za-z]', '', 'g') AS line FROM documents) WHERE length(line) >= 18)"


@query(
    f"WITH {_GLYPHS} SELECT doc, 0::BIGINT AS block_idx, CASE WHEN n <= 10 THEN array_to_string(string_split(left(line, n::INT), ''), ' ') ELSE array_to_string(string_split(left(line, n::INT), ''), ' ') END AS text, 'heading' AS kind FROM g "
    "UNION ALL SELECT doc, 1, 'body text below the heading, long enough to be the body of the page', 'para' FROM g"
)
def glyph_headings(spark, sf_dir):
    """Headings set letter by letter on one baseline, out of order, are joined from left to right: short ones as a run of glyphs, long ones
    (over twenty characters) as a heading that is continued."""
    line = F.regexp_replace("text", "[^A-Za-z]", "")
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doc"), (3 + F.col("doc_id") % 16).cast("int").alias("n"), line.alias("line")).where("length(line) >= 18")
    letters = docs.select("doc", F.posexplode(F.split(F.left("line", F.col("n")), "")).alias("at", "text"))
    top = letters.select("doc", F.lit(1).alias("page"), (40 - F.col("at")).alias("line_no"), "text", F.lit(14.0).alias("size"), F.lit(False).alias("bold"), (50.0 + 10 * F.col("at")).alias("x0"), F.lit(20.0).alias("y0"), (59.0 + 10 * F.col("at")).alias("x1"), F.lit(34.0).alias("y1"))
    body = docs.select("doc", F.lit(1).alias("page"), F.lit(90).alias("line_no"), F.lit("body text below the heading, long enough to be the body of the page").alias("text"), F.lit(10.0).alias("size"), F.lit(False).alias("bold"), F.lit(50.0).alias("x0"), F.lit(60.0).alias("y0"), F.lit(500.0).alias("x1"), F.lit(72.0).alias("y1"))
    none = spark.createDataFrame([], "doc string, page int, table_no int, x0 double, y0 double, x1 double, y1 double, rows array<array<string>>")
    return layout.page_blocks(top.unionByName(body), none).select("doc", F.col("block_idx").cast("long").alias("block_idx"), "text", "kind")


# ---- blocks and chunks with tables --------------------------------------------------------------------------------

_MIXED = rf"""
{c._LINES}, mixed AS (
  SELECT doc_id::VARCHAR AS doc, line_no AS block_idx, CASE WHEN line_no = 0 THEN 'heading' WHEN line_no % 5 = 3 THEN 'table' WHEN line_no % 17 = 16 THEN 'figure' ELSE 'para' END AS kind, text, line_no // 10 + 1 AS page,
         [[coalesce(nullif(split_part(text, ' ', 1), 'of'), ''), ' ' || split_part(text, ' ', 2)], ['', ' '], [line_no::VARCHAR, '字 ， x']] AS rows FROM lines),
tidy AS (SELECT doc, block_idx, page, list_filter(list_transform(rows, lambda r: list_transform(r, lambda text: {c._NORMAL})), lambda r: len(list_filter(r, lambda v: v <> '')) > 0) AS rows FROM mixed WHERE kind = 'table'),
kept AS (
  SELECT doc, block_idx, kind, text, page, []::VARCHAR[][] AS rows FROM (SELECT doc, block_idx, kind, page, {c._NORMAL} AS text FROM mixed WHERE kind IN ('heading', 'para')) WHERE text <> '' AND NOT {c._NOISE}
  UNION ALL SELECT doc, block_idx, 'table', '', page, rows FROM tidy WHERE len(rows) > 0)"""


def _mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents as blocks: a heading, paragraphs, tables and blocks of a kind that is dropped."""
    n, t = F.col("line_no"), F.col("text")
    word = lambda k: F.split_part(t, F.lit(" "), F.lit(k))
    rows = F.array(F.array(F.when(word(1) != "of", word(1)), F.concat(F.lit(" "), word(2))), F.array(F.lit(None), F.lit(" ")), F.array(n.cast("string"), F.lit("字 ， x")))
    kind = F.when(n == 0, "heading").when(n % 5 == 3, "table").when(n % 17 == 16, "figure").otherwise("para")
    return c._doc_lines(spark, sf_dir).select(F.col("doc_id").cast("string").alias("doc"), n.alias("block_idx"), kind.alias("kind"), F.when(kind == "table", F.lit("")).otherwise(t).alias("text"), F.lit(1).alias("level"), F.when(kind == "table", rows).otherwise(F.array().cast("array<array<string>>")).alias("rows"), (F.floor(n / 10) + 1).cast("int").alias("page"))


_ROWS = "array_to_string(list_transform(rows, lambda r: array_to_string(r, ' | ')), chr(10))"


@query(f"WITH {_MIXED} SELECT doc, block_idx::BIGINT AS block_idx, kind, CASE WHEN kind = 'table' THEN {_ROWS} ELSE text END AS text FROM kept")
def clean_tables(spark, sf_dir):
    made = clean.clean_blocks(_mixed(spark, sf_dir))
    return made.select("doc", F.col("block_idx").cast("long").alias("block_idx"), "kind", F.when(F.col("kind") == "table", chunk.table_text(F.col("rows"))).otherwise(F.col("text")).alias("text"))


_TABLE_CHUNKS = f"""
WITH RECURSIVE {_MIXED},
sect AS (
  SELECT *, count(*) FILTER (WHERE kind = 'heading') OVER w AS section, coalesce(last_value(CASE WHEN kind = 'heading' THEN text END IGNORE NULLS) OVER w, '') AS path,
         count(*) FILTER (WHERE kind = 'table') OVER w AS tables FROM kept WINDOW w AS (PARTITION BY doc ORDER BY block_idx)),
paras AS (SELECT doc, section, path, tables AS run, block_idx AS i, text FROM sect WHERE kind = 'para'), {c._packed_sql("paras", "doc, section, path, run")},
laps AS (SELECT *, lag({c._SENT}) OVER (PARTITION BY doc, section, run ORDER BY gid) AS sents FROM fused),
made AS (
  SELECT doc, section, path, 2 * run AS run, gid, CASE WHEN sents IS NULL THEN '' ELSE {c._TAIL} || chr(10) END || text AS body, false AS is_table FROM laps
  UNION ALL SELECT doc, section, path, 2 * tables - 1, 0, {_ROWS}, true FROM sect WHERE kind = 'table'),
titled AS (SELECT doc, section, run, gid, is_table, CASE WHEN path <> '' THEN path || chr(10) ELSE '' END || body AS text, count(*) OVER (PARTITION BY doc, section) AS n, row_number() OVER (PARTITION BY doc, section ORDER BY run, gid) AS k FROM made),
tails AS (SELECT *, lead(text) OVER w AS next, lead(is_table) OVER w AS next_table FROM titled WINDOW w AS (PARTITION BY doc, section ORDER BY k)),
merged AS (
  SELECT doc, section, k, is_table, CASE WHEN k = n - 1 AND NOT next_table AND length(next) < 100 THEN regexp_replace(text, '\\s+$', '') || chr(10) || regexp_replace(next, '^\\s+|\\s+$', '', 'g') ELSE text END AS text
  FROM tails WHERE NOT (k = n AND n > 1 AND NOT is_table AND length(text) < 100))
SELECT doc, section::BIGINT AS section, row_number() OVER (PARTITION BY doc ORDER BY section, k) AS place, is_table, length(text)::BIGINT AS chars, md5(text) AS digest FROM merged"""


@query(_TABLE_CHUNKS)
def chunk_tables(spark, sf_dir):
    """Chunks of blocks with tables: tables part the runs of paragraphs, and a short last chunk goes to what stands before it."""
    from pyspark.sql import Window

    made = chunk.chunk_blocks(clean.clean_blocks(_mixed(spark, sf_dir)), ids=False)
    place = F.row_number().over(Window.partitionBy("doc").orderBy("section", "run", "piece")).cast("long")
    return made.select("doc", F.coalesce(F.col("section").cast("long"), F.lit(0)).alias("section"), place.alias("place"), (F.size("rows") > 0).alias("is_table"), F.length("text").cast("long").alias("chars"), F.md5(F.col("text").cast("binary")).alias("digest"))


@query("SELECT r_name AS doc, count(*) AS rows, string_agg(n_name || ' | ' || CASE WHEN n_nationkey % 2 = 0 THEN '' ELSE n_nationkey::VARCHAR || ' é & <' END, chr(10) ORDER BY n_nationkey) AS text FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name")
def html_tables(spark, sf_dir):
    """Tables of web pages: one page for each region, its nations as rows, with block markup and character references in the cells."""
    number = F.when(F.col("n_nationkey") % 2 == 0, F.lit("<td> </td>")).otherwise(F.concat(F.lit('<TD class="n"><p>'), F.col("n_nationkey").cast("string"), F.lit(" &#233; &amp; &#x3C;</p></TD>")))
    row = F.concat(F.lit("<tr><th>"), F.col("n_name"), F.lit("</th>"), number, F.lit("</tr>\n"))
    joined = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    pages = joined.groupBy(F.col("r_name").alias("page_id")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n_nationkey", row.alias("row")))), lambda x: x["row"]), "").alias("rows"))
    page = pages.select("page_id", F.concat(F.lit("<h1>T</h1>before<table><tr><td></td></tr>"), F.col("rows"), F.lit("</table>after")).alias("html"))
    tables = html.html_blocks(page).where("kind = 'table'")
    return tables.select("doc", F.size("rows").cast("long").alias("rows"), chunk.table_text(F.col("rows")).alias("text"))


# ---- artifacts ----------------------------------------------------------------------------------------------------

TABLES = "benchmark conversations customer documents embeddings events labels lineitem nation orders pages part region supplier".split()


@query("SELECT unnest(" + repr([f"{t}.parquet" for t in TABLES]) + ") AS file")
def source_scan(spark, sf_dir):
    """Files of the folder by their suffix, in any case."""
    return io.scan_files(spark, sf_dir, "PARQUET").select(F.element_at(F.split("path", "/"), -1).alias("file"))


@query(f"WITH {c._BLOCKS} SELECT doc, count(*) AS blocks, sum(block_idx)::BIGINT AS places, md5(string_agg(kind || level || text, '|' ORDER BY block_idx)) AS digest FROM blocks GROUP BY doc")
def blocks_round_trip(spark, sf_dir):
    path = shared_path(spark, "blocks")
    io.write_records(c._blocks(spark, sf_dir), path)
    line = F.concat("kind", F.col("level").cast("string"), "text")
    parts = F.transform(F.sort_array(F.collect_list(F.struct("block_idx", line.alias("line")))), lambda p: p["line"])
    return io.read_blocks(spark, path).groupBy("doc").agg(F.count("*").alias("blocks"), F.sum("block_idx").alias("places"), F.md5(F.array_join(parts, "|").cast("binary")).alias("digest"))


@query(c._CHUNKS + " SELECT id, doc, section_path, text, start_page, end_page FROM chunks")
def chunks_round_trip(spark, sf_dir):
    path = shared_path(spark, "chunks")
    io.write_records(c._chunks(spark, sf_dir).drop("seq"), path)
    return io.read_chunks(spark, path).select("id", "doc", F.array_join("section_path", " / ").alias("section_path"), "text", "start_page", "end_page")


@query(f"{c._HITS} SELECT qid, rank, cid AS id, text FROM hits")
def cited_texts(spark, sf_dir):
    """Texts of cited chunks looked up by id."""
    hits = c._hits(spark, sf_dir)
    chunks = read(spark, sf_dir, "documents").select(F.format_string("chunk_%06d", "doc_id").alias("id"), "text")
    found = io.chunk_texts(hits.select("qid", "rank", F.col("id").alias("chunk_id")), chunks)
    return found.select("qid", F.col("rank").cast("long").alias("rank"), F.col("chunk_id").alias("id"), "text")


@query(
    "WITH q AS (SELECT item_id, text, 'simple' AS set FROM benchmark UNION ALL SELECT item_id, text, 'complex' FROM benchmark) SELECT set || item_id AS qid, set, text AS question, CASE WHEN item_id % 3 = 0 THEN '' ELSE 'a.' || item_id || ';b' END AS sources, "
    "item_id % 4 <> 0 AS answerable FROM q"
)
def qa_scan(spark, sf_dir):
    """QA sets as JSON arrays: suffixes of sources taken off, missing lists and flags filled in."""
    asked, paths = read(spark, sf_dir, "benchmark"), {}
    for name in io.QA_SETS:
        sources = F.when(F.col("item_id") % 3 == 0, F.lit(None)).otherwise(F.array(F.concat(F.lit("a."), F.col("item_id").cast("string"), F.lit(".PDF")), F.lit("b.pdf")))
        record = F.struct(F.concat(F.lit(name), F.col("item_id").cast("string")).alias("id"), F.col("text").alias("question"), sources.alias("sources"), F.when(F.col("item_id") % 4 == 0, F.lit(False)).alias("answerable"))
        paths[name] = shared_path(spark, f"qa-{name}")
        # One file of one array, as the sets are kept.
        asked.agg(F.concat(F.lit("["), F.array_join(F.collect_list(F.to_json(record)), ",\n"), F.lit("]")).alias("value")).write.text(paths[name])
    return io.read_qa(spark, paths).select("qid", "set", "question", F.array_join("sources", ";").alias("sources"), "answerable")


_SNAP = f"{c._HITS}, s AS (SELECT qid, count(*) AS n_hits, string_agg(cid || ':' || score::DECIMAL(18, 6)::VARCHAR, ';' ORDER BY rank) AS hits FROM hits GROUP BY qid)"


@query(f"{_SNAP} SELECT item_id AS qid, item_id % 2 = 0 AS answerable, 'second' AS route, coalesce(n_hits, 0) AS n_hits, coalesce(hits, '') AS hits FROM benchmark LEFT JOIN s ON qid = item_id")
def snapshot_round_trip(spark, sf_dir):
    """Snapshots written twice: the last of a question's rows counts."""
    qa = c._questions(spark, sf_dir).select("qid", F.lit("simple").alias("set"), (F.col("qid") % 2 == 0).alias("answerable"))
    path = shared_path(spark, "snapshot")
    for mode, route in (("overwrite", "first"), ("append", "second")):
        # The rows of a run are one file; a later run's file is named after it.
        rows = evaluate.snapshot(qa, c._hits(spark, sf_dir), route, TOP_K).withColumn("qid", F.col("qid").cast("string"))
        rows.coalesce(1).write.mode(mode).json(f"{path}/{'ab'[mode == 'append']}")
    read_back = io.read_snapshot(spark, f"{path}/*")
    listed = F.array_join(F.transform("hits", lambda h: F.concat(h["chunk_id"], F.lit(":"), h["score"].cast("decimal(18,6)").cast("string"))), ";")
    return read_back.select(F.col("qid").cast("long").alias("qid"), "answerable", "route", F.size("hits").cast("long").alias("n_hits"), listed.alias("hits"))


@query(
    f"WITH {c._SCORES}, e AS (SELECT route, count(*) AS n, count(*) FILTER (WHERE positive) AS pos, round_even(min(score) FILTER (WHERE positive), 4)::DOUBLE AS pos_min, round_even(max(score) FILTER (WHERE NOT positive), 4)::DOUBLE AS neg_max FROM scores GROUP BY route) SELECT route, n, pos, pos_min, neg_max FROM e"
)
def threshold_report(spark, sf_dir):
    """The threshold reports as JSON, read back field by field."""
    made = io.threshold_report_json(calibrate.report(c._scores(spark, sf_dir)))
    get = lambda path: F.get_json_object("json", path)
    return made.select("route", get("$.n_questions").cast("long").alias("n"), get("$.pos.n").cast("long").alias("pos"), get("$.pos.min").cast("double").alias("pos_min"), get("$.neg.max").cast("double").alias("neg_max"))


@query("SELECT * FROM (VALUES ('hybrid_rerank', 2), ('vector_only', 1), ('ready', 0), ('no key', 1)) AS t(asked, problems)")
def preflight_problems(spark, sf_dir):
    """What is missing for a route: the vector store for both, an index or chunks for the hybrid one only, a key where one is needed."""
    there, nowhere = f"{sf_dir}/documents.parquet", shared_path(spark, "nothing")
    cases = [("hybrid_rerank", io.preflight(spark, "hybrid_rerank", nowhere, nowhere, nowhere)), ("vector_only", io.preflight(spark, "vector_only", nowhere, nowhere, nowhere)), ("ready", io.preflight(spark, "hybrid_rerank", there, nowhere, there)), ("no key", io.preflight(spark, "vector_only", there, key_ready=False))]
    every = None
    for name, problems in cases:
        row = problems.agg(F.lit(name).alias("asked"), F.count("problem").cast("int").alias("problems"))
        every = row if every is None else every.unionByName(row)
    return every


@query("SELECT * FROM (VALUES ('PAPYRA_A', 'one two'), ('PAPYRA_B', 'x=y'), ('PAPYRA_KEPT', 'from outside')) AS t(name, value)")
def env_settings(spark, sf_dir):
    """Settings of an env file: comments skipped, quotes stripped, what the environment has already kept. The file is the driver's own."""
    import tempfile

    os.environ["PAPYRA_KEPT"] = "from outside"
    for name in ("PAPYRA_A", "PAPYRA_B"):
        os.environ.pop(name, None)
    with tempfile.NamedTemporaryFile("w", suffix=".env") as f:
        f.write("# settings\nPAPYRA_A = 'one two'\n\nPAPYRA_B=x=y\nPAPYRA_KEPT=from the file\nnothing here\n")
        f.flush()
        load_env(f.name)
    return spark.createDataFrame([(n, os.environ[n]) for n in ("PAPYRA_A", "PAPYRA_B", "PAPYRA_KEPT")], "name string, value string")


# ---- steps behind providers ---------------------------------------------------------------------------------------


def _dense_sql(corpus: str, lexical: str) -> str:
    """CTEs ``dense`` (ranked) and the four routes over a corpus (id, text), for the letter embedder and the overlap reranker. ``lexical``
    names the ranked BM25 table."""
    letters = "list_transform(range(26), lambda k: (length(text) - length(replace(text, chr((97 + k)::INT), '')))::DOUBLE)"
    tail = c._ROUTES[c._ROUTES.index("covr AS") :].replace("tfidfr", "dense").replace("bm25r", lexical)
    fused = c._FUSED.replace("tfidfr", "dense").replace("bm25r", lexical)
    return f""",
cv AS (SELECT id, coalesce(text, '') AS text, {letters.replace("text", "coalesce(text, '')")} AS v FROM {corpus}), qv AS (SELECT item_id AS qid, text, {letters} AS v FROM benchmark),
cos AS (SELECT qid, id, round(list_dot_product(q.v, d.v) / greatest(sqrt(list_dot_product(q.v, q.v)), 1e-300) / greatest(sqrt(list_dot_product(d.v, d.v)), 1e-300), 6) AS score FROM qv q CROSS JOIN cv d),
dense AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM cos){fused},
wide AS (SELECT qid, id, rank FROM fusedr WHERE rank <= 20),
cand AS (SELECT 'A' AS route, qid, id, rank AS before FROM wide UNION ALL SELECT 'C', qid, id, rank FROM v26 WHERE rank <= 20),
chars AS (SELECT qid, list_filter(list_distinct(string_split(lower(text), '')), lambda x: x <> ' ') AS want FROM qv),
cov AS (SELECT route, qid, c.id, before, len(list_filter(want, lambda x: contains(lower(d.text), x))) / greatest(len(want), 1)::DOUBLE AS score FROM cand c JOIN chars USING (qid) JOIN cv d ON d.id = c.id),
{tail}"""


_DOC_DENSE = f"WITH {c._BM25}{_dense_sql('(SELECT doc_id AS id, text FROM documents)', 'bm25r')}"


def _store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vector store of the documents, embedded by their letters, written and opened as a step would."""

    def build():
        docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
        chunks = docs.select(F.col("id").cast("string").alias("id"), "text", F.col("id").cast("string").alias("doc"), F.array().cast("array<string>").alias("section_path"), F.lit(None).cast("int").alias("start_page"), F.lit(None).cast("int").alias("end_page"))
        path = shared_path(spark, "vectors")
        io.write_vectors(index.vector_rows(chunks, embed_table(chunks, LetterEmbedder())), path)
        return path

    return io.open_vectors(spark, c._once(spark, sf_dir, "letter-store", build))


@query("SELECT doc_id AS id, 26::BIGINT AS dim, 0::BIGINT AS page, '' AS section_path, list_sum(list_transform(range(26), lambda k: length(text) - length(replace(text, chr((97 + k)::INT), ''))))::BIGINT AS letters FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)")
def vector_store(spark, sf_dir):
    """Chunks as records with embeddings, in batches; missing pages are 0."""
    size = dimension(LetterEmbedder())
    total = F.aggregate("embedding", F.lit(0.0), lambda n, x: n + x).cast("long")
    return _store(spark, sf_dir).select(F.col("id").cast("long").alias("id"), F.when(F.size("embedding") == size, F.lit(size)).cast("long").alias("dim"), (F.col("start_page") + F.col("end_page")).cast("long").alias("page"), "section_path", total.alias("letters"))


@query(f"{_DOC_DENSE} SELECT route, qid, id, round(score, 6) AS score, rank FROM routes")
def dense_routes(spark, sf_dir):
    """The four routes with dense search over the vector store and a reranker that sees all candidates."""
    texts = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    store = _store(spark, sf_dir).select(F.col("id").cast("long").alias("id"), "embedding")
    found = retrieve.routes(c._index(spark, sf_dir), c._questions(spark, sf_dir), TOP_K, retrieve.Models(store, LetterEmbedder(), OverlapReranker(), texts))
    every = None
    for name, rows in found.items():
        part = rows.select(F.lit(name).alias("route"), "qid", "id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))
        every = part if every is None else every.unionByName(part)
    return every


class FirstPassage:
    """Cites the first passage it is given; questions whose length is a multiple of seven are refused for good."""

    def answer(self, messages: list[dict]) -> str:
        passages, _, question = messages[-1]["content"].rpartition("【问题】")
        if len(question) % 7 == 0:
            raise ProviderError(400, "refused")
        return f"see {passages[passages.index('[') : passages.index(']') + 1]} and [chunk_999999]"


_LIMIT = 0.9


@query(
    f"{_DOC_DENSE}, best AS (SELECT qid, max(score) AS top1, count(*) AS n, arg_min(id, rank) AS first FROM routes WHERE route = 'A' GROUP BY qid), "
    f"j AS (SELECT item_id AS qid, text, top1, n, first, top1 IS NULL OR top1 < {_LIMIT} AS rejected, length(text) % 7 = 0 AS failed FROM benchmark LEFT JOIN best ON qid = item_id) "
    f"SELECT qid, round(top1, 6) AS top1, rejected, CASE WHEN rejected THEN '{generate.REJECT_ANSWER}' WHEN failed THEN '' ELSE format('see [chunk_{{:06d}}] and [chunk_999999]', first) END AS answer, "
    "CASE WHEN NOT rejected AND failed THEN 'ProviderError: status 400: refused' END AS error, CASE WHEN NOT rejected THEN (NOT failed)::BIGINT END AS valid, CASE WHEN NOT rejected THEN (NOT failed)::BIGINT END AS invalid, "
    "coalesce(n, 0) AS n_hits FROM j"
)
def answers(spark, sf_dir):
    """Questions answered in one plan: dense and lexical search, reranking, rejection, generation with errors kept apart, citations."""
    chunks = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    store = _store(spark, sf_dir).select(F.col("id").cast("long").alias("id"), "embedding")
    models = retrieve.Models(store, LetterEmbedder(), OverlapReranker(), chunks)
    hits = retrieve.search_route("hybrid_rerank", c._index(spark, sf_dir), c._questions(spark, sf_dir), TOP_K, models)
    named = chunks.select(F.col("id").alias("number"), F.format_string("chunk_%06d", "id").alias("id"), "text", F.col("id").cast("string").alias("doc"), F.array().cast("array<string>").alias("section_path"), F.lit(1).alias("start_page"), F.lit(1).alias("end_page"))
    passages = rag.with_passages(hits.select("qid", "rank", F.format_string("chunk_%06d", "id").alias("id"), "score"), named)
    found = rag.answered(c._questions(spark, sf_dir), written(passages, "hits"), FirstPassage(), "hybrid_rerank", _LIMIT)
    numbers = lambda n: F.col(f"citations.{n}").cast("long").alias(n)
    return found.select("qid", F.round("top1", 6).alias("top1"), "rejected", "answer", "error", numbers("valid"), numbers("invalid"), F.coalesce(F.size("topk"), F.lit(0)).cast("long").alias("n_hits"))


_ORDERED = "SELECT item_id AS qid, row_number() OVER (ORDER BY item_id DESC) AS place FROM benchmark"


@query(f"SELECT qid, place FROM ({_ORDERED}) WHERE place <= 7")
def limited_questions(spark, sf_dir):
    """The first questions of a file, in its order and not by their ids."""
    asked = read(spark, sf_dir, "benchmark")
    path = shared_path(spark, "qa-limit")
    record = F.to_json(F.struct(F.col("item_id").cast("string").alias("id"), F.lit("?").alias("question")))
    listed = F.transform(F.sort_array(F.collect_list(F.struct((-F.col("item_id")).alias("o"), record.alias("r")))), lambda x: x["r"])
    asked.agg(F.concat(F.lit("["), F.array_join(listed, ",\n"), F.lit("]")).alias("value")).write.text(path)
    first = generate.limited(io.read_qa(spark, {"simple": path}, "simple"), 7, "place")
    return first.select(F.col("qid").cast("long").alias("qid"), (F.col("place") + 1).alias("place"))


@query(
    f"{c._HITS}, ctx AS (SELECT qid, string_agg('[' || cid || '] ' || text, chr(10) ORDER BY rank) AS context FROM hits GROUP BY qid) SELECT item_id AS qid, md5("
    + "'" + judge.INSTRUCTIONS.replace("'", "''") + "' || chr(10) || '【问题】' || b.text || chr(10) || '【标准答案】gold ' || item_id || chr(10) || '【可答】' || (item_id % 2 = 0)::VARCHAR || chr(10) || '【资料】' || chr(10) || coalesce(context, '"
    + evaluate.NO_CONTEXT + "') || chr(10) || '【系统生成的回答】' || 'answer ' || item_id) AS digest FROM benchmark b LEFT JOIN ctx ON qid = item_id"
)
def judge_prompts(spark, sf_dir):
    """Prompts for a judge, with the passages rebuilt from the ids in the answers."""
    listed = c._hits(spark, sf_dir).groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "doc", "section_path", "start_page", "end_page"))).alias("hits"))
    n = F.col("qid").cast("string")
    asked = c._questions(spark, sf_dir).join(listed.select("qid", generate.topk(F.col("hits")).alias("topk")), "qid", "left")
    given = asked.select("qid", F.col("text").alias("question"), F.concat(F.lit("gold "), n).alias("gold_answer"), (F.col("qid") % 2 == 0).alias("answerable"), "topk", F.concat(F.lit("answer "), n).alias("answer"))
    chunks = read(spark, sf_dir, "documents").select(F.format_string("chunk_%06d", "doc_id").alias("id"), "text")
    return judge.prompts(given, chunks).select("qid", F.md5(F.col("prompt").cast("binary")).alias("digest"))


@query(f"WITH {c._INDEX} SELECT tok, df, round(ln(((SELECT count(*) FROM lens) + 1) / (df + 1)) + 1, 6) AS w FROM terms")
def index_reloaded(spark, sf_dir):
    """The index of the documents, opened again from its folder instead of being built."""
    built = c._index(spark, sf_dir)
    return index.load_or_build(spark, built.path, None).terms.select("tok", "df", F.round("w", 6).alias("w"))
