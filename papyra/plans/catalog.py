"""Queries of the library proper, by name, with the SQL that DuckDB runs for the same rows.

Documents stand for the corpus, benchmark items for questions (their sources are the documents that contain
them; items in no document are the unanswerable ones), pages for laid-out documents, labels and conversations for
classes and replies. Every query reads its tables whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from papyra.functions import text as T
from papyra.operators import calibrate, chunk, clean, evaluate, generate, index, layout, retrieve
from papyra.shared import shared_path, ship, written
from papyra.sources import html, io

TOP_K = 5
ROUTES = ("A", "B", "C", "D")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return register


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_built: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, sf_dir: str, what: str, build):
    """Artifacts that several queries share are written once for a session and folder, as an index is in practice."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _built:
        _built[key] = build()
    return _built[key]


def _index(spark: SparkSession, sf_dir: str) -> index.Index:
    corpus = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return _once(spark, sf_dir, "index", lambda: index.build(corpus, shared_path(spark, "bm25")))


def _questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), "text")


def _routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build():
        found = retrieve.routes(_index(spark, sf_dir), _questions(spark, sf_dir), TOP_K)
        rows = [d.select(F.lit(name).alias("route"), "qid", "id", "score", F.col("rank").cast("long").alias("rank")) for name, d in found.items()]
        out = rows[0]
        for r in rows[1:]:
            out = out.unionByName(r)
        return written(out, "routes")

    return _once(spark, sf_dir, "routes", build)


def _qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(qid, sources, answerable): a question's sources are the documents that contain it."""

    def build():
        asked = _questions(spark, sf_dir)
        docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("body"))
        found = retrieve.containing(_index(spark, sf_dir), docs, asked).groupBy("qid").agg(F.sort_array(F.collect_list(F.col("id").cast("string"))).alias("sources"))
        joined = asked.select("qid").join(found, "qid", "left")
        return written(joined.select("qid", F.coalesce("sources", F.array().cast("array<string>")).alias("sources"), F.col("sources").isNotNull().alias("answerable")), "qa")

    return _once(spark, sf_dir, "qa", build)


def _rated(spark: SparkSession, sf_dir: str, route: str) -> DataFrame:
    hits = _routes(spark, sf_dir).where(F.col("route") == route).select("qid", "rank", F.col("id").cast("string").alias("doc"))
    return evaluate.score_hits(_qa(spark, sf_dir), hits, TOP_K)


def _bm25_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    build = lambda: written(retrieve.bm25_topk(_index(spark, sf_dir), _questions(spark, sf_dir), TOP_K), "bm25-hits")
    return _once(spark, sf_dir, "bm25-hits", build)


# ---- index and retrieval ------------------------------------------------------------------------------------------

_TOKENS = r"regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+|[\x{4e00}-\x{9fff}]')"
_INDEX = rf"""
post AS (SELECT tok, id, count(*) AS tf FROM (SELECT doc_id AS id, unnest({_TOKENS}) AS tok FROM documents) GROUP BY tok, id),
lens AS (SELECT doc_id AS id, len({_TOKENS})::BIGINT AS dl FROM documents),
raw AS (SELECT tok, count(*) AS df, ln((SELECT count(*) FROM lens) - count(*) + 0.5) - ln(count(*) + 0.5) AS raw FROM post GROUP BY tok),
terms AS (SELECT tok, df, CASE WHEN raw < 0 THEN 0.25 * (SELECT avg(raw) FROM raw) ELSE raw END AS idf FROM raw),
qtok AS (SELECT qid, tok, count(*) AS qtf FROM (SELECT item_id AS qid, unnest({_TOKENS}) AS tok FROM benchmark) GROUP BY qid, tok)"""
_BM25 = (
    _INDEX
    + """,
bm25 AS (
  SELECT qid, p.id, round(sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / (SELECT avg(dl) FROM lens)))), 6) AS score
  FROM qtok JOIN post p USING (tok) JOIN terms USING (tok) JOIN lens USING (id) GROUP BY qid, p.id),
bm25r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM bm25)"""
)
_TFIDF = """,
w AS (SELECT tok, ln(((SELECT count(*) FROM lens) + 1) / (df + 1)) + 1 AS w FROM terms),
dx AS (SELECT tok, id, tf * w AS x FROM post JOIN w USING (tok)), dn AS (SELECT id, sqrt(sum(x * x)) AS norm FROM dx GROUP BY id),
qy AS (SELECT qid, tok, qtf * w AS y FROM qtok JOIN w USING (tok)), qn AS (SELECT qid, sqrt(sum(y * y)) AS qnorm FROM qy GROUP BY qid),
tfidf AS (SELECT qid, id, round(sum(x * y) / (any_value(norm) * any_value(qnorm)), 6) AS score FROM dx JOIN qy USING (tok) JOIN dn USING (id) JOIN qn USING (qid) GROUP BY qid, id),
tfidfr AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM tfidf)"""
_FUSED = """,
v26 AS (SELECT * FROM tfidfr WHERE rank <= 26), b26 AS (SELECT * FROM bm25r WHERE rank <= 26 AND score > 0),
fused AS (
  SELECT qid, id, round(sum(1.0::DOUBLE / (60 + rank)), 12) AS rrf_score, min((list, rank)) AS first
  FROM (SELECT qid, id, 0 AS list, rank FROM v26 UNION ALL SELECT qid, id, 1, rank FROM b26) GROUP BY qid, id),
fusedr AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY rrf_score DESC, first) AS rank FROM fused)"""
_ROUTES = """,
wide AS (SELECT qid, id, rank FROM fusedr WHERE rank <= 20),
qi AS (SELECT qid, tok, greatest(idf, 0) AS idf FROM qtok JOIN terms USING (tok)), qt AS (SELECT qid, sum(idf) AS total FROM qi GROUP BY qid),
cand AS (SELECT 'A' AS route, qid, id, rank AS before FROM wide UNION ALL SELECT 'C', qid, id, rank FROM v26 WHERE rank <= 20),
seen AS (SELECT route, qid, c.id, sum(idf) AS seen FROM cand c JOIN qi USING (qid) JOIN post p ON p.id = c.id AND p.tok = qi.tok GROUP BY route, qid, c.id),
cov AS (
  SELECT c.route, c.qid, c.id, c.before, round(coalesce(CASE WHEN total > 0 THEN seen / total END, 0), 6) AS score
  FROM cand c LEFT JOIN seen s ON s.route = c.route AND s.qid = c.qid AND s.id = c.id LEFT JOIN qt ON qt.qid = c.qid),
covr AS (SELECT *, row_number() OVER (PARTITION BY route, qid ORDER BY score DESC, before) AS rank FROM cov),
v20 AS (SELECT * FROM tfidfr WHERE rank <= 20), b20 AS (SELECT * FROM bm25r WHERE rank <= 20 AND score > 0),
narrow AS (
  SELECT qid, id, round(sum(1.0::DOUBLE / (60 + rank)), 12) AS rrf_score, min((list, rank)) AS first
  FROM (SELECT qid, id, 0 AS list, rank FROM v20 UNION ALL SELECT qid, id, 1, rank FROM b20) GROUP BY qid, id),
narrowr AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY rrf_score DESC, first) AS rank FROM narrow),
routes AS (
  SELECT route, qid, id, score, rank FROM covr WHERE rank <= 5
  UNION ALL SELECT 'B', n.qid, n.id, coalesce(v.score, 0.0), n.rank FROM narrowr n LEFT JOIN v20 v ON v.qid = n.qid AND v.id = n.id WHERE n.rank <= 5
  UNION ALL SELECT 'D', qid, id, score, rank FROM tfidfr WHERE rank <= 5)"""
_QA = """,
qa AS (SELECT b.item_id AS qid, list(DISTINCT d.doc_id) FILTER (WHERE d.doc_id IS NOT NULL) AS sources FROM benchmark b LEFT JOIN documents d ON contains(d.text, b.text) GROUP BY b.item_id),
figures AS (
  SELECT route, qid, len(sources) AS n_sources, count(DISTINCT id) FILTER (WHERE list_contains(sources, id)) AS n_hit,
         count(*) FILTER (WHERE list_contains(sources, id)) AS n_chunks, min(rank) FILTER (WHERE list_contains(sources, id)) AS first
  FROM (SELECT DISTINCT route FROM routes) r CROSS JOIN qa LEFT JOIN routes USING (route, qid) WHERE len(sources) > 0 GROUP BY route, qid, sources),
rated AS (SELECT route, qid, n_sources, n_hit, n_hit::DOUBLE / n_sources AS recall, n_chunks / 5.0::DOUBLE AS precision, CASE WHEN first = 1 THEN 1.0 ELSE 0.0 END AS p1, coalesce(1.0::DOUBLE / first, 0.0) AS mrr FROM figures)"""
_MACRO = ", ".join(f"round_even(avg({c}), 3)::DOUBLE AS {c}" for c in ("recall", "precision", "p1", "mrr"))
_RATES = "round_even(avg((n_hit > 0)::INT), 3)::DOUBLE AS any_hit, round_even(avg((n_hit = n_sources)::INT), 3)::DOUBLE AS all_hit"
_ALL = f"WITH {_BM25}{_TFIDF}{_FUSED}{_ROUTES}"


@query(f"SELECT doc_id, len({_TOKENS})::BIGINT AS n_tokens, len(list_distinct({_TOKENS}))::BIGINT AS n_distinct FROM documents")
def tokenize_stats(spark, sf_dir):
    toks = T.tokens(F.coalesce("text", F.lit("")))
    pair = T.let(toks, lambda t: F.struct(F.size(t).cast("long").alias("n_tokens"), F.size(F.array_distinct(t)).cast("long").alias("n_distinct")))
    return read(spark, sf_dir, "documents").select("doc_id", pair.alias("p")).select("doc_id", "p.*")


@query(f"WITH {_INDEX} SELECT tok, df, round(idf, 6) AS idf FROM terms")
def bm25_terms(spark, sf_dir):
    return _index(spark, sf_dir).terms.select("tok", "df", F.round("idf", 6).alias("idf"))


@query(f"SELECT doc_id AS id, len({_TOKENS})::BIGINT AS dl FROM documents")
def bm25_doclen(spark, sf_dir):
    return _index(spark, sf_dir).lengths.select("id", "dl")


@query(f"WITH {_INDEX} SELECT tok, count(*) AS docs, sum(tf)::BIGINT AS occurrences FROM post GROUP BY tok")
def bm25_postings(spark, sf_dir):
    return _index(spark, sf_dir).postings.groupBy("tok").agg(F.count("*").alias("docs"), F.sum("tf").alias("occurrences"))


@query(f"WITH {_BM25} SELECT qid, id, score, rank FROM bm25r WHERE rank <= 5 AND score > 0")
def bm25_topk(spark, sf_dir):
    return _bm25_hits(spark, sf_dir).select("qid", "id", "score", F.col("rank").cast("long").alias("rank"))


@query(f"WITH {_BM25}{_TFIDF} SELECT qid, id, score, rank FROM tfidfr WHERE rank <= 5")
def tfidf_topk(spark, sf_dir):
    return retrieve.tfidf_topk(_index(spark, sf_dir), _questions(spark, sf_dir), TOP_K).select("qid", "id", "score", F.col("rank").cast("long").alias("rank"))


_KNN = """
WITH s AS (
  SELECT q.vec_id AS qid, c.vec_id AS id, q.label = c.label AS same, round(list_cosine_similarity(q.embedding::DOUBLE[], c.embedding::DOUBLE[]), 6) AS score
  FROM embeddings q CROSS JOIN embeddings c WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM s)"""


@query(_KNN + " SELECT qid, id, score, rank FROM r WHERE rank <= 5")
def vector_topk(spark, sf_dir):
    vectors = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    queries = vectors.where(F.col("id") % 20 == 0).withColumnRenamed("id", "qid")
    return retrieve.vector_topk(vectors, queries, TOP_K).select("qid", "id", "score", F.col("rank").cast("long").alias("rank"))


@query(_KNN + " SELECT qid, count(*) AS n, round(avg(same::INT), 6)::DOUBLE AS label_precision FROM r WHERE rank <= 10 GROUP BY qid")
def vector_knn_label_recall(spark, sf_dir):
    rows = read(spark, sf_dir, "embeddings")
    vectors = rows.select(F.col("vec_id").alias("id"), "embedding")
    found = retrieve.vector_topk(vectors, vectors.where(F.col("id") % 20 == 0).withColumnRenamed("id", "qid"), 10)
    label = lambda c: rows.select(F.col("vec_id").alias(c), F.col("label").alias(f"{c}_label"))
    same = found.join(label("id"), "id").join(label("qid"), "qid")
    return same.groupBy("qid").agg(F.count("*").alias("n"), F.round(F.avg((F.col("id_label") == F.col("qid_label")).cast("int")), 6).alias("label_precision"))


@query(f"WITH {_BM25}{_TFIDF}{_FUSED} SELECT qid, id, rrf_score, rank FROM fusedr")
def rrf_fuse(spark, sf_dir):
    ix, q = _index(spark, sf_dir), _questions(spark, sf_dir)
    fused = retrieve.rrf([retrieve.tfidf_topk(ix, q, 26), retrieve.bm25_topk(ix, q, 26)])
    return fused.select("qid", "id", F.col("score").alias("rrf_score"), F.col("rank").cast("long").alias("rank"))


@query(
    f"WITH {_BM25}{_TFIDF}{_FUSED} SELECT f.qid, f.id, rrf_score, coalesce(v.score, 0.0) AS score, coalesce(b.score, 0.0) AS bm25_score, f.rank FROM fusedr f "
    "LEFT JOIN v26 v ON v.qid = f.qid AND v.id = f.id LEFT JOIN b26 b ON b.qid = f.qid AND b.id = f.id WHERE f.rank <= 20"
)
def hybrid_candidates(spark, sf_dir):
    ix, q = _index(spark, sf_dir), _questions(spark, sf_dir)
    fused, each = retrieve.candidate_sizes(TOP_K)
    found = retrieve.hybrid(retrieve.tfidf_topk(ix, q, each), retrieve.bm25_topk(ix, q, each), fused)
    return found.select("qid", "id", "rrf_score", "score", "bm25_score", F.col("rank").cast("long").alias("rank"))


@query(f"{_ALL} SELECT qid, id, score, rank FROM routes WHERE route = 'A'")
def hybrid_rerank(spark, sf_dir):
    return _routes(spark, sf_dir).where("route = 'A'").drop("route")


@query(f"{_ALL} SELECT route, qid, id, score, rank FROM routes")
def ablation_routes(spark, sf_dir):
    return _routes(spark, sf_dir)


# ---- evaluation ---------------------------------------------------------------------------------------------------


@query(f"{_ALL}{_QA} SELECT qid, n_sources, n_hit, round(recall, 6) AS recall, round(precision, 6)::DOUBLE AS precision, p1::DOUBLE AS p1, round(mrr, 6) AS mrr FROM rated WHERE route = 'A'")
def score_question(spark, sf_dir):
    rated = _rated(spark, sf_dir, "A").where("n_sources is not null")
    return rated.select("qid", F.col("n_sources").cast("long").alias("n_sources"), F.col("n_hit").cast("long").alias("n_hit"), *[F.round(c, 6).alias(c) for c in ("recall", "precision", "p1", "mrr")])


@query(f"{_ALL}{_QA} SELECT count(*) AS n, {_MACRO}, {_RATES} FROM rated WHERE route = 'A'")
def retrieval_metrics(spark, sf_dir):
    return evaluate.macro(_rated(spark, sf_dir, "A"))


@query(f"{_ALL}{_QA} SELECT count(*) AS n, {_RATES} FROM rated WHERE route = 'D'")
def hit_rates(spark, sf_dir):
    return evaluate.macro(_rated(spark, sf_dir, "D")).select("n", "any_hit", "all_hit")


@query(f"{_ALL}{_QA} SELECT route, count(*) AS n, {_MACRO}, {_RATES} FROM rated GROUP BY route")
def route_compare(spark, sf_dir):
    rated = None
    for name in ROUTES:
        r = _rated(spark, sf_dir, name).withColumn("route", F.lit(name))
        rated = r if rated is None else rated.unionByName(r)
    return evaluate.macro(rated, "route")


@query(
    f"WITH {_BM25} SELECT item_id AS qid, 'missing' AS problem FROM benchmark WHERE item_id NOT IN (SELECT qid FROM bm25r WHERE rank <= 5 AND score > 0) "
    "UNION ALL SELECT DISTINCT qid, 'unknown' FROM bm25r WHERE rank <= 5 AND score > 0 AND qid NOT IN (SELECT item_id FROM benchmark b JOIN documents d ON contains(d.text, b.text))"
)
def snapshot_anti(spark, sf_dir):
    """Questions without an answer, and answers to questions that no document holds."""
    answered = _bm25_hits(spark, sf_dir).select("qid").distinct()
    missing = evaluate.reconcile(_questions(spark, sf_dir), answered).where("problem = 'missing'")
    return missing.unionByName(evaluate.reconcile(_qa(spark, sf_dir).where("answerable"), answered).where("problem = 'unknown'"))


# ---- text, blocks, chunks -----------------------------------------------------------------------------------------

_SENT = r"list_filter(list_transform(regexp_extract_all(coalesce(text, ''), '[^。！？；;!?\n]*[。！？；;!?\n]+|[^。！？；;!?\n]+\z'), lambda s: regexp_replace(s, '^\s+|\s+$', '', 'g')), lambda s: s <> '')"


@query(f"SELECT doc_id, len({_SENT})::BIGINT AS n_sentences, coalesce(list_sum(list_transform({_SENT}, lambda s: length(s))), 0)::BIGINT AS chars, md5(array_to_string({_SENT}, '|')) AS digest FROM documents")
def sentence_split(spark, sf_dir):
    total = lambda s: F.aggregate(s, F.lit(0).cast("long"), lambda n, x: n + F.length(x))
    figures = T.let(T.sentences(F.coalesce("text", F.lit(""))), lambda s: F.struct(F.size(s).cast("long").alias("n_sentences"), total(s).alias("chars"), F.md5(F.array_join(s, "|").cast("binary")).alias("digest")))
    return read(spark, sf_dir, "documents").select("doc_id", figures.alias("f")).select("doc_id", "f.*")


_TAGS = r"h[1-6]|p|li|div|nav|ul|article|footer|body"
_REFS = "regexp_replace(substr(piece, instr(piece, chr(2)) + 1), '<[^>]*>', ' ', 'g')"
for _name, _char in html.REFERENCES.items():
    _REFS = "replace({}, '{}', '{}')".format(_REFS, _name, _char.replace("'", "''"))
_BLOCKS = rf"""
cut AS (
  SELECT page_id::VARCHAR AS doc, unnest(pieces) AS piece, unnest(range(len(pieces))) AS block_idx FROM (
    SELECT page_id, string_split(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
      '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<title\b.*?</title\s*>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '(?i)<br\b[^>]*>', ' ', 'g'),
      '(?i)<(/?)({_TAGS})\b[^>]*>', chr(1) || '\1\2' || chr(2), 'g'), chr(1)) AS pieces FROM pages)),
blocks AS (
  SELECT doc, block_idx, CASE WHEN regexp_full_match(tag, 'h[1-6]') THEN 'heading' ELSE 'para' END AS kind, text, CASE WHEN regexp_full_match(tag, 'h[1-6]') THEN substr(tag, 2, 1)::INT ELSE 1 END AS level
  FROM (SELECT doc, block_idx, CASE WHEN contains(piece, chr(2)) THEN lower(split_part(piece, chr(2), 1)) ELSE '' END AS tag, trim(regexp_replace({_REFS}, '[ \t\r\n]+', ' ', 'g')) AS text FROM cut) WHERE text <> '')"""


def _blocks(spark, sf_dir):
    return html.html_blocks(read(spark, sf_dir, "pages"))


@query(f"WITH {_BLOCKS} SELECT doc, block_idx::BIGINT AS block_idx, kind, text, level::BIGINT AS level FROM blocks")
def html_blocks(spark, sf_dir):
    return _blocks(spark, sf_dir).select("doc", F.col("block_idx").cast("long").alias("block_idx"), "kind", "text", F.col("level").cast("long").alias("level"))


_NORMAL = r"trim(regexp_replace(regexp_replace(regexp_replace(replace(regexp_replace(text, '(?s)<!--.*?-->', ' ', 'g'), chr(12288), ' '), '([0-9A-Za-z])\s+([\x{4e00}-\x{9fff}])', '\1\2', 'g'), '\s*([，。、；：？！])\s*', '\1', 'g'), '[ \t]+', ' ', 'g'), chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ')"


@query(f"SELECT doc_id, length({_NORMAL})::BIGINT AS chars, md5({_NORMAL}) AS digest FROM documents")
def normalize_ws(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", T.normalise_space(F.col("text")).alias("t")).select("doc_id", F.length("t").cast("long").alias("chars"), F.md5(F.col("t").cast("binary")).alias("digest"))


_LINES = r"lines AS (SELECT doc_id, unnest(parts) AS text, unnest(range(len(parts))) AS line_no FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))"
_NOISE = r"(regexp_matches(text, '第\s*\d+\s*页|^\s*\d+\s*$') OR (length(text) <= 35 AND regexp_matches(text, '\d{4}\s*年\s*\d{1,2}\s*月\s*\d{1,2}\s*日\s+\d{1,2}:\d{2}') AND regexp_matches(text, '(听全文|\d+\s*人)$')))"


def _doc_lines(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "text"))


@query(f"WITH {_LINES} SELECT doc_id, count(*) AS lines, count(*) FILTER (WHERE {_NOISE}) AS noise FROM lines GROUP BY doc_id")
def noise_filter(spark, sf_dir):
    return _doc_lines(spark, sf_dir).groupBy("doc_id").agg(F.count("*").alias("lines"), F.count_if(T.is_noise(F.col("text"))).alias("noise"))


@query(
    f"WITH {_BLOCKS}, ends AS (SELECT *, max(CASE WHEN text LIKE '%the.' THEN block_idx END) OVER (PARTITION BY doc) AS last FROM blocks) "
    "SELECT doc, count(*) AS blocks, max(block_idx)::BIGINT AS last_block FROM ends WHERE last IS NULL OR block_idx <= last GROUP BY doc"
)
def tail_truncate(spark, sf_dir):
    kept = clean.truncate_tail(_blocks(spark, sf_dir), "the.")
    return kept.groupBy("doc").agg(F.count("*").alias("blocks"), F.max("block_idx").cast("long").alias("last_block"))


_CLEAN = f"clean AS (SELECT * FROM (SELECT doc, block_idx, kind, level, {_NORMAL} AS text FROM blocks) WHERE text <> '' AND NOT {_NOISE})"


@query(f"WITH {_BLOCKS}, {_CLEAN} SELECT doc, block_idx::BIGINT AS block_idx, kind, text FROM clean")
def clean_blocks(spark, sf_dir):
    return clean.clean_blocks(_blocks(spark, sf_dir)).select("doc", F.col("block_idx").cast("long").alias("block_idx"), "kind", "text")


@query(f"WITH {_BLOCKS} SELECT doc, count(*) FILTER (WHERE kind = 'heading') AS headings, count(*) FILTER (WHERE kind = 'para') AS paras, sum(length(text))::BIGINT AS chars FROM blocks GROUP BY doc")
def block_manifest(spark, sf_dir):
    m = clean.manifest(_blocks(spark, sf_dir))
    n = lambda k: F.coalesce(F.try_element_at("blocks", F.lit(k)), F.lit(0)).cast("long")
    return m.select(F.col("source").alias("doc"), n("heading").alias("headings"), n("para").alias("paras"), F.col("chars").cast("long").alias("chars"))


@query(
    f"WITH {_BLOCKS}, md AS (SELECT doc, trim(string_agg(CASE kind WHEN 'heading' THEN repeat('#', level) || ' ' || text ELSE text END, chr(10) || chr(10) ORDER BY block_idx)) || chr(10) AS markdown FROM blocks GROUP BY doc) "
    "SELECT doc, length(markdown)::BIGINT AS chars, md5(markdown) AS digest FROM md"
)
def render_md(spark, sf_dir):
    return io.render_markdown(_blocks(spark, sf_dir)).select("doc", F.length("markdown").cast("long").alias("chars"), F.md5(F.col("markdown").cast("binary")).alias("digest"))


@query(
    f"WITH {_BLOCKS}, {_CLEAN}, s AS (SELECT *, count(*) FILTER (WHERE kind = 'heading') OVER (PARTITION BY doc ORDER BY block_idx) AS section, "
    "last_value(CASE WHEN kind = 'heading' THEN text END IGNORE NULLS) OVER (PARTITION BY doc ORDER BY block_idx) AS title FROM clean) "
    "SELECT doc, section, coalesce(title, '') AS path, count(*) FILTER (WHERE kind <> 'heading') AS items FROM s GROUP BY doc, section, title"
)
def section_paths(spark, sf_dir):
    # The pages have headings of level 1 only, so the path is the last heading; other levels are covered by tests.
    blocks = chunk.assign_sections(clean.clean_blocks(_blocks(spark, sf_dir)))
    return blocks.groupBy("doc", "section", F.array_join("section_path", " / ").alias("path")).agg(F.count_if(F.col("kind") != "heading").alias("items")).withColumn("section", F.coalesce("section", F.lit(0)).cast("long"))


def _packed_sql(source: str, keys: str) -> str:
    """CTEs from ``source`` (keys, i, text) to ``fused`` (keys, gid, text, chars): the greedy folds as recursions over places."""
    same = " AND ".join(f"x.{k} = r.{k}" for k in keys.split(", "))
    own = ", ".join(f"x.{k}" for k in keys.split(", "))
    return f"""
sents AS (SELECT {keys}, i, unnest({_SENT}) AS s, unnest(range(len({_SENT}))) AS k FROM {source} WHERE length(text) > 300),
srec AS (
  SELECT {keys}, i, k, s, length(s) AS cur, 0 AS g FROM sents WHERE k = 0
  UNION ALL SELECT {own}, x.i, x.k, x.s, CASE WHEN r.cur + length(x.s) > 300 THEN length(x.s) ELSE r.cur + length(x.s) END, r.g + CASE WHEN r.cur + length(x.s) > 300 THEN 1 ELSE 0 END
  FROM srec r JOIN sents x ON {same} AND x.i = r.i AND x.k = r.k + 1),
items AS (
  SELECT {keys}, row_number() OVER (PARTITION BY {keys} ORDER BY i, g) AS j, text, length(text) AS n, long FROM (
    SELECT {keys}, i, 0 AS g, text, false AS long FROM {source} WHERE length(text) <= 300
    UNION ALL SELECT {keys}, i, g, string_agg(s, '' ORDER BY k), true FROM srec GROUP BY {keys}, i, g)),
prec AS (
  SELECT {keys}, j, text, n, long, n AS cur, 1 AS grp FROM items WHERE j = 1
  UNION ALL SELECT {own}, x.j, x.text, x.n, x.long, CASE WHEN r.long OR x.long OR (r.cur + x.n > 300 AND r.cur >= 100) THEN x.n ELSE r.cur + x.n END,
    r.grp + CASE WHEN r.long OR x.long OR (r.cur + x.n > 300 AND r.cur >= 100) THEN 1 ELSE 0 END FROM prec r JOIN items x ON {same} AND x.j = r.j + 1),
grp AS (SELECT {keys}, grp, sum(n) AS n, string_agg(text, chr(10) ORDER BY j) AS text FROM prec GROUP BY {keys}, grp),
gids AS (SELECT *, count(*) FILTER (WHERE grp = 1 OR n >= 100) OVER (PARTITION BY {keys} ORDER BY grp) AS gid FROM grp),
fused AS (SELECT {keys}, gid, sum(n)::BIGINT AS chars, string_agg(text, chr(10) ORDER BY grp) AS text FROM gids GROUP BY {keys}, gid)"""


_TAIL = "array_to_string(list_filter(sents, lambda s, i: coalesce(list_sum(list_transform(sents[i + 1:], lambda t: length(t))), 0) < 45), '')"
_CHUNKS = f"""
WITH RECURSIVE {_BLOCKS}, {_CLEAN},
sect AS (
  SELECT *, count(*) FILTER (WHERE kind = 'heading') OVER (PARTITION BY doc ORDER BY block_idx) AS section,
         coalesce(last_value(CASE WHEN kind = 'heading' THEN text END IGNORE NULLS) OVER (PARTITION BY doc ORDER BY block_idx), '') AS path FROM clean),
paras AS (SELECT doc, section, path, block_idx AS i, text FROM sect WHERE kind = 'para'), {_packed_sql("paras", "doc, section, path")},
laps AS (SELECT *, lag({_SENT}) OVER (PARTITION BY doc, section ORDER BY gid) AS sents FROM fused),
made AS (
  SELECT doc, section, path, gid, CASE WHEN path <> '' THEN path || chr(10) ELSE '' END || CASE WHEN sents IS NULL THEN '' ELSE {_TAIL} || chr(10) END || text AS text,
         count(*) OVER (PARTITION BY doc, section) AS n FROM laps),
tails AS (SELECT *, lead(text) OVER w AS next, gid = n AS last, lead(gid) OVER w = n AS next_last FROM made WINDOW w AS (PARTITION BY doc, section ORDER BY gid)),
merged AS (
  SELECT doc, section, path, gid, CASE WHEN next_last AND length(next) < 100 THEN regexp_replace(text, '\\s+$', '') || chr(10) || regexp_replace(next, '^\\s+|\\s+$', '', 'g') ELSE text END AS text
  FROM tails WHERE NOT (last AND n > 1 AND length(text) < 100)),
chunks AS (SELECT format('chunk_{{:06d}}', row_number() OVER (ORDER BY doc, section, gid)) AS id, doc, path AS section_path, text, 1 AS start_page, 1 AS end_page FROM merged)"""


def _chunks(spark, sf_dir):
    build = lambda: written(chunk.chunk_blocks(clean.clean_blocks(_blocks(spark, sf_dir))), "chunks")
    return _once(spark, sf_dir, "chunks", build)


@query(_CHUNKS + " SELECT * FROM chunks")
def chunk_documents(spark, sf_dir):
    return _chunks(spark, sf_dir).select("id", "doc", F.array_join("section_path", " / ").alias("section_path"), "text", "start_page", "end_page")


@query(_CHUNKS + " SELECT count(*) AS n_chunks, round_even(avg(length(text)), 1)::DOUBLE AS mean_chars, max(length(text))::BIGINT AS max_chars, min(length(text))::BIGINT AS min_chars FROM chunks")
def chunk_stats(spark, sf_dir):
    n = chunk.describe_chunks(_chunks(spark, sf_dir))
    return n.select("n_chunks", "mean_chars", F.col("max_chars").cast("long").alias("max_chars"), F.col("min_chars").cast("long").alias("min_chars"))


@query(_CHUNKS + f", {_BM25} SELECT qid, id, score, rank FROM bm25r WHERE rank <= 5 AND score > 0".replace("doc_id AS id", "id").replace("FROM documents", "FROM chunks"))
def chunk_bm25_topk(spark, sf_dir):
    """BM25 over chunks instead of documents."""
    corpus = _chunks(spark, sf_dir).select("id", "text")
    ix = _once(spark, sf_dir, "chunk-index", lambda: index.build(corpus, shared_path(spark, "chunk-bm25")))
    return retrieve.bm25_topk(ix, _questions(spark, sf_dir), TOP_K).select("qid", "id", "score", F.col("rank").cast("long").alias("rank"))


_PARAS = (
    _LINES
    + r", paras AS (SELECT doc_id, line_no AS i, text FROM (SELECT doc_id, line_no, regexp_replace(text, '^\s+|\s+$', '', 'g') AS text FROM lines) WHERE text <> '')"
)


@query(
    f"WITH RECURSIVE {_PARAS}, {_packed_sql('paras', 'doc_id')} SELECT doc_id, coalesce(count(gid), 0)::BIGINT AS groups, coalesce(string_agg(chars::VARCHAR, ',' ORDER BY gid), '') AS sizes "
    "FROM (SELECT doc_id FROM documents WHERE text IS NOT NULL) LEFT JOIN fused USING (doc_id) GROUP BY doc_id"
)
def pack_paragraphs(spark, sf_dir):
    """Groups of the lines of each document, before overlap: their number and sizes."""
    paras = F.filter(F.transform(F.split("text", "\n", -1), lambda t, i: F.struct(i.alias("block_idx"), T.strip(t).alias("text"))), lambda p: p["text"] != "")
    rows = read(spark, sf_dir, "documents").where("text is not null").select("doc_id", chunk.fuse_small(chunk.pack_paragraphs(paras)).alias("g"))
    return rows.select("doc_id", F.size("g").cast("long").alias("groups"), F.array_join(F.transform("g", lambda g: g["chars"].cast("string")), ",").alias("sizes"))


# ---- layout -------------------------------------------------------------------------------------------------------

_LAYOUT = (
    _LINES
    + """, lay AS (
  SELECT doc_id::VARCHAR AS doc, line_no // 40 + 1 AS page, line_no, text, CASE WHEN length(text) % 5 = 0 THEN 14.0 ELSE 10.0 END::DOUBLE AS size, length(text) % 7 = 0 AS bold, 50.0::DOUBLE AS x0,
         (line_no % 40) * 14.0::DOUBLE + CASE WHEN length(text) % 3 = 0 THEN 10.0 ELSE 0.0 END AS y0, 50.0::DOUBLE + least(length(text), 100) * 5.0 AS x1, (line_no % 40) * 14.0::DOUBLE + CASE WHEN length(text) % 3 = 0 THEN 22.0 ELSE 12.0 END AS y1
  FROM lines WHERE text <> '')"""
)


def _layout(spark, sf_dir):
    """Lines of documents as if set on pages of forty, with sizes, weights and gaps that follow their lengths."""
    n = F.length("text")
    shift = F.when(n % 3 == 0, 10.0).otherwise(0.0)
    top = (F.col("line_no") % 40) * 14.0 + shift
    lines = _doc_lines(spark, sf_dir).where("text <> ''")
    return lines.select(
        F.col("doc_id").cast("string").alias("doc"), (F.floor(F.col("line_no") / 40) + 1).cast("int").alias("page"), "line_no", "text", F.when(n % 5 == 0, 14.0).otherwise(10.0).alias("size"), (n % 7 == 0).alias("bold"),
        F.lit(50.0).alias("x0"), top.alias("y0"), (50.0 + F.least(n, F.lit(100)) * 5.0).alias("x1"), (top + 12.0).alias("y1"),
    )


_BODY = "body AS (SELECT doc, page, arg_max(half, (w, -first)) AS body_size FROM (SELECT doc, page, round_even(size * 2, 0) / 2 AS half, sum(length(text)) AS w, min(line_no) AS first FROM lay GROUP BY doc, page, half) GROUP BY doc, page)"
_HEIGHT = (
    "tops AS (SELECT doc, page, round_even(y0, 2) AS top FROM lay), gaps AS (SELECT doc, page, top - lag(top) OVER w AS gap, row_number() OVER w AS nth FROM tops WINDOW w AS (PARTITION BY doc, page ORDER BY top)), "
    "modes AS (SELECT doc, page, arg_max(half, (w, -first)) AS line_h FROM (SELECT doc, page, round_even(gap * 2, 0) / 2 AS half, count(*) AS w, min(nth) AS first FROM gaps WHERE gap BETWEEN 0.5 AND 60.0 GROUP BY doc, page, half) GROUP BY doc, page), "
    "height AS (SELECT doc, page, coalesce(line_h, 1.0) AS line_h FROM (SELECT DISTINCT doc, page FROM lay) LEFT JOIN modes USING (doc, page))"
)


@query(f"WITH {_LAYOUT}, {_BODY} SELECT doc, page::BIGINT AS page, body_size::DOUBLE AS body_size FROM body")
def layout_body_size(spark, sf_dir):
    return layout.body_size(_layout(spark, sf_dir)).withColumn("page", F.col("page").cast("long"))


@query(f"WITH {_LAYOUT}, {_HEIGHT} SELECT doc, page::BIGINT AS page, line_h::DOUBLE AS line_h FROM height")
def layout_line_height(spark, sf_dir):
    return layout.line_height(_layout(spark, sf_dir)).withColumn("page", F.col("page").cast("long"))


@query(
    f"WITH {_LAYOUT}, {_BODY} SELECT doc, line_no::BIGINT AS line_no, (CASE WHEN length(text) > 50 THEN 0 WHEN size / body_size >= 1.35 THEN 1 WHEN contains('。！？；，,.;', right(text, 1)) THEN 0 "
    "WHEN size / body_size >= 1.15 AND length(text) <= 30 THEN 2 WHEN bold AND length(text) <= 25 THEN 2 ELSE 0 END)::BIGINT AS level FROM lay JOIN body USING (doc, page)"
)
def heading_level(spark, sf_dir):
    lines = _layout(spark, sf_dir)
    joined = lines.join(layout.body_size(lines), ["doc", "page"])
    return joined.select("doc", F.col("line_no").cast("long").alias("line_no"), layout.heading_level(F.col("text"), F.col("size"), F.col("bold"), F.col("body_size")).cast("long").alias("level"))


@query(f"WITH {_LAYOUT} SELECT doc, line_no::BIGINT AS line_no, row_number() OVER (PARTITION BY doc, page ORDER BY round_even(y0, 2), x0, line_no) AS place FROM lay")
def reading_order(spark, sf_dir):
    return layout.reading_order(_layout(spark, sf_dir)).select("doc", F.col("line_no").cast("long").alias("line_no"), F.col("place").cast("long").alias("place"))


@query(
    f"WITH {_LAYOUT}, {_HEIGHT}, o AS (SELECT *, row_number() OVER (PARTITION BY doc, page ORDER BY round_even(y0, 2), x0, line_no) AS place FROM lay JOIN height USING (doc, page)), "
    "g AS (SELECT *, CASE WHEN y0 - lag(y0) OVER (PARTITION BY doc, page ORDER BY place) > greatest(1.0, line_h * 1.6) THEN 1 ELSE 0 END AS new FROM o), "
    "p AS (SELECT *, sum(new) OVER (PARTITION BY doc, page ORDER BY place) AS para FROM g) SELECT doc, page::BIGINT AS page, para::BIGINT AS para, count(*) AS lines, sum(length(text))::BIGINT AS chars FROM p GROUP BY doc, page, para"
)
def para_merge(spark, sf_dir):
    lines = _layout(spark, sf_dir)
    ordered = layout.reading_order(lines).join(layout.line_height(lines), ["doc", "page"])
    w = Window.partitionBy("doc", "page").orderBy("place")
    gap = F.col("y0") - F.lag("y0").over(w) > F.greatest(F.lit(1.0), F.col("line_h") * layout.PARA_GAP)
    paras = ordered.withColumn("new", F.coalesce(gap, F.lit(False)).cast("long")).withColumn("para", F.sum("new").over(w))
    return paras.groupBy("doc", F.col("page").cast("long").alias("page"), "para").agg(F.count("*").alias("lines"), F.sum(F.length("text")).cast("long").alias("chars"))


@query(f"WITH {_LAYOUT} SELECT doc, line_no::BIGINT AS line_no FROM lay WHERE x0 >= 0 AND x1 <= 300 AND y0 >= 100 AND y1 <= 300")
def rect_contain(spark, sf_dir):
    lines = _layout(spark, sf_dir)
    tables = lines.select("doc", "page").distinct().select("doc", "page", *[F.lit(v).alias(c) for c, v in (("x0", 0.0), ("y0", 100.0), ("x1", 300.0), ("y1", 300.0))])
    return layout.inside_tables(lines, tables).select("doc", F.col("line_no").cast("long").alias("line_no"))


@query(
    "SELECT doc_id, (len(r) <= 1 OR coalesce(list_max(list_transform(r, lambda x: len(list_filter(string_split(x, ' '), lambda c: c <> '')))), 0) <= 1) AS fake FROM (SELECT doc_id, string_split(text, chr(10)) AS r FROM documents)"
)
def fake_table(spark, sf_dir):
    rows = F.transform(F.split("text", "\n", -1), lambda x: F.split(x, " ", -1))
    return read(spark, sf_dir, "documents").select("doc_id", rows.alias("rows")).select("doc_id", layout.is_fake_table(F.col("rows")).alias("fake"))


@query()
def layout_blocks(spark, sf_dir):
    """Blocks of the documents' layout lines, without tables."""
    lines = _layout(spark, sf_dir)
    none = spark.createDataFrame([], "doc string, page int, table_no int, x0 double, y0 double, x1 double, y1 double, rows array<array<string>>")
    made = layout.page_blocks(lines, none)
    return made.select("doc", F.col("block_idx").cast("long").alias("block_idx"), "kind", "text", F.col("level").cast("long").alias("level"), F.col("page").cast("long").alias("page"))


# ---- generation ---------------------------------------------------------------------------------------------------

_HITS = f"WITH {_BM25}, hits AS (SELECT qid, rank, id, score, text, format('chunk_{{:06d}}', id) AS cid FROM bm25r JOIN documents ON doc_id = id WHERE rank <= 5 AND score > 0)"


def _hits(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    hits = _bm25_hits(spark, sf_dir).join(docs, "id")
    return hits.select("qid", "rank", F.format_string("chunk_%06d", "id").alias("id"), "score", "text", F.col("id").cast("string").alias("doc"), F.lit("").alias("section_path"), F.lit(1).alias("start_page"), F.lit(1).alias("end_page"))


@query(f"{_HITS}, best AS (SELECT qid, max(score) AS top1 FROM hits GROUP BY qid) SELECT item_id AS qid, top1, top1 IS NULL OR top1 < 60 AS rejected FROM benchmark LEFT JOIN best ON qid = item_id")
def reject_threshold(spark, sf_dir):
    yes, no = generate.split_by_threshold(_questions(spark, sf_dir), _bm25_hits(spark, sf_dir), 60.0)
    return yes.select("qid", "top1", F.lit(False).alias("rejected")).unionByName(no.select("qid", "top1", F.lit(True).alias("rejected")))


_CONTEXT = "ctx AS (SELECT qid, string_agg('[' || cid || '] 来源:' || id || ' §全文 p.1~1' || chr(10) || text || chr(10), chr(10) ORDER BY rank) AS context, '引用来源: ' || string_agg('[' || cid || '] ' || id || ' §全文 (p.1~1)', '; ' ORDER BY rank) AS appendix FROM hits GROUP BY qid)"


@query(f"{_HITS}, {_CONTEXT} SELECT qid, length(context)::BIGINT AS chars, md5(context) AS digest, appendix FROM ctx")
def build_context(spark, sf_dir):
    return generate.contexts(_hits(spark, sf_dir)).select("qid", F.length("context").cast("long").alias("chars"), F.md5(F.col("context").cast("binary")).alias("digest"), "appendix")


@query(f"{_HITS}, {_CONTEXT} SELECT qid, md5('【资料】' || chr(10) || context || chr(10) || chr(10) || '【问题】' || text) AS digest FROM ctx JOIN benchmark ON item_id = qid")
def build_messages(spark, sf_dir):
    asked = generate.contexts(_hits(spark, sf_dir)).join(_questions(spark, sf_dir), "qid")
    return asked.select("qid", F.md5(generate.messages(F.col("text"), F.col("context"))[1]["content"].cast("binary")).alias("digest"))


_ANSWERS = "answers AS (SELECT qid, 'see [' || list(cid ORDER BY rank)[1] || '] and [chunk_999999]' || CASE WHEN qid % 3 = 0 THEN ' and [' || list(cid ORDER BY rank)[len(list(cid))] || ']' ELSE '' END AS answer, list(cid) AS allowed FROM hits GROUP BY qid)"


@query(
    rf"{_HITS}, {_ANSWERS}, c AS (SELECT qid, allowed, regexp_extract_all(answer, '\[(chunk_\d{{6}})\]', 1) AS cited FROM answers) "
    "SELECT qid, len(list_filter(cited, lambda x: list_contains(allowed, x)))::BIGINT AS valid, len(list_filter(cited, lambda x: NOT list_contains(allowed, x)))::BIGINT AS invalid, len(cited) = 0 AS uncited FROM c"
)
def citation_check(spark, sf_dir):
    listed = _hits(spark, sf_dir).groupBy("qid").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "id"))), lambda h: h["id"]).alias("ids"))
    answer = F.concat(F.lit("see ["), F.element_at("ids", 1), F.lit("] and [chunk_999999]"), F.when(F.col("qid") % 3 == 0, F.concat(F.lit(" and ["), F.element_at("ids", -1), F.lit("]"))).otherwise(F.lit("")))
    return listed.select("qid", generate.citations(answer, F.col("ids")).alias("c")).select("qid", F.size("c.valid").cast("long").alias("valid"), F.size("c.invalid").cast("long").alias("invalid"), F.col("c.none").alias("uncited"))


@query(f"{_HITS} SELECT qid, string_agg(cid || ':' || id || ':1-1', ';' ORDER BY rank) AS topk FROM hits GROUP BY qid")
def topk_projection(spark, sf_dir):
    listed = _hits(spark, sf_dir).groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "doc", "section_path", "start_page", "end_page"))).alias("hits"))
    text = F.transform(generate.topk(F.col("hits")), lambda h: F.concat(h["id"], F.lit(":"), h["doc"], F.lit(":"), F.array_join(h["page"].cast("array<string>"), "-")))
    return listed.select("qid", F.array_join(text, ";").alias("topk"))


# ---- calibration --------------------------------------------------------------------------------------------------

_SCORES = "scores AS (SELECT lang AS route, quality = 1 AS positive, (len(regexp_extract_all(text, '[^ ]+')) * 1.0::DOUBLE / (n_chars + 1)) AS score FROM documents JOIN labels USING (doc_id))"


def _scores(spark, sf_dir):
    joined = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id")
    return joined.select(F.col("lang").alias("route"), (F.col("quality") == 1).alias("positive"), (F.regexp_count("text", F.lit("[^ ]+")) * 1.0 / (F.col("n_chars") + 1)).alias("score"))


@query(
    f"WITH {_SCORES}, p AS (SELECT *, row_number() OVER (PARTITION BY route, positive ORDER BY score) - 1 AS i, count(*) OVER (PARTITION BY route, positive) AS n FROM scores) "
    "SELECT route, positive, count(*) AS n, round_even(min(score), 4)::DOUBLE AS min, round_even(max(CASE WHEN i = round_even(0.25 * (n - 1), 0) THEN score END), 4)::DOUBLE AS p25, "
    "round_even(avg(CASE WHEN i = (n - 1) // 2 OR i = n // 2 THEN score END), 4)::DOUBLE AS median, round_even(max(CASE WHEN i = round_even(0.75 * (n - 1), 0) THEN score END), 4)::DOUBLE AS p75, round_even(max(score), 4)::DOUBLE AS max FROM p GROUP BY route, positive"
)
def score_describe(spark, sf_dir):
    return calibrate.describe(_scores(spark, sf_dir))


@query(
    f"WITH {_SCORES}, d AS (SELECT route, score, count(*) FILTER (WHERE positive) AS pos, count(*) FILTER (WHERE NOT positive) AS neg FROM scores GROUP BY route, score), "
    "c AS (SELECT route, score, lag(score) OVER w AS lower, coalesce(sum(pos) OVER b, 0)::BIGINT AS false_reject, (sum(neg) OVER (PARTITION BY route) - coalesce(sum(neg) OVER b, 0))::BIGINT AS leak FROM d "
    "WINDOW w AS (PARTITION BY route ORDER BY score), b AS (PARTITION BY route ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), "
    "f AS (SELECT *, row_number() OVER (PARTITION BY route, leak ORDER BY score) AS k FROM c) SELECT route, round_even(score, 4)::DOUBLE AS threshold, round_even(lower, 4)::DOUBLE AS lower, false_reject, leak FROM f WHERE k = 1"
)
def threshold_tradeoff(spark, sf_dir):
    return calibrate.tradeoff(_scores(spark, sf_dir))


@query(
    f"WITH {_SCORES}, e AS (SELECT route, count(*) AS n_questions, min(score) FILTER (WHERE positive) AS lo, max(score) FILTER (WHERE NOT positive) AS hi FROM scores GROUP BY route) "
    "SELECT route, n_questions, coalesce(lo > hi, false) AS separable, CASE WHEN lo > hi THEN round_even(hi, 4) END::DOUBLE AS window_low, CASE WHEN lo > hi THEN round_even(lo, 4) END::DOUBLE AS window_high, "
    "CASE WHEN lo > hi THEN round_even((lo + hi) / 2, 3) END::DOUBLE AS suggested_min_score, CASE WHEN lo IS NULL OR hi IS NULL THEN 'one class is missing' WHEN lo > hi THEN 'separable' ELSE 'overlapping' END AS note FROM e"
)
def separability(spark, sf_dir):
    return calibrate.separability(_scores(spark, sf_dir))


# ---- judging ------------------------------------------------------------------------------------------------------

_MARKS = {"faithfulness": 1, "citation": 2, "answer_accuracy": 3, "rejection": 5}
_JUDGED = (
    "judged AS (SELECT conv_id, turn, role AS set, length(text) % 11 = 0 AS infra_failed, length(text) % 13 = 0 AS broken, "
    + ", ".join(f"CASE WHEN length(text) % 13 <> 0 THEN ((length(text) // {d}) % 3) / 2.0::DOUBLE END AS {m}" for m, d in _MARKS.items())
    + " FROM conversations)"
)
_OK = "(faithfulness IS NOT NULL AND NOT infra_failed)"


def _replies(spark, sf_dir):
    """Replies as a judge might give them, with words around the JSON; some are no JSON, some calls failed."""
    n = F.length("text")
    marks = F.to_json(F.struct(*[((F.floor(n / d) % 3) / 2.0).alias(m) for m, d in _MARKS.items()]))
    raw = F.when(n % 13 == 0, F.lit("no verdict {")).otherwise(F.concat(F.lit("verdict: "), marks, F.lit(" end")))
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("role").alias("set"), (n % 11 == 0).alias("infra_failed"), evaluate.parse_judge(raw).alias("j"))


@query(f"WITH {_JUDGED} SELECT conv_id, turn, faithfulness, citation, answer_accuracy, rejection FROM judged")
def judge_parse(spark, sf_dir):
    return _replies(spark, sf_dir).select("conv_id", "turn", *[f"j.{m}" for m in _MARKS])


@query(
    f"WITH {_JUDGED} SELECT set, count(*) FILTER (WHERE {_OK}) AS n, count(*) FILTER (WHERE infra_failed) AS infra_failed, count(*) FILTER (WHERE NOT {_OK} AND NOT infra_failed) AS judge_failed, "
    + ", ".join(f"round_even(avg({m}) FILTER (WHERE {_OK}), 3)::DOUBLE AS {m}" for m in _MARKS)
    + " FROM judged GROUP BY GROUPING SETS ((), (set))"
)
def judge_summary(spark, sf_dir):
    return evaluate.judge_summary(_replies(spark, sf_dir).select("set", "infra_failed", *[f"j.{m}" for m in _MARKS]))


@query(f"{_ALL}{_QA} SELECT CASE WHEN n_hit = n_sources THEN 'full' WHEN n_hit > 0 THEN 'partial' ELSE 'none' END AS coverage, count(*) AS n, round_even(avg(mrr), 3)::DOUBLE AS accuracy FROM rated WHERE route = 'B' GROUP BY coverage")
def coverage_split(spark, sf_dir):
    return evaluate.coverage_split(_rated(spark, sf_dir, "B"), "mrr")


_MEANS = ", ".join(f"round_even(avg({m}) FILTER (WHERE {_OK}), 3)::DOUBLE AS {m}" for m in _MARKS)


@query(f"WITH {_JUDGED}, s AS (SELECT set, {_MEANS} FROM judged GROUP BY set) SELECT set, round_even((faithfulness + citation + answer_accuracy + rejection) / 4, 6)::DOUBLE AS composite FROM s")
def composite_mean(spark, sf_dir):
    summary = evaluate.judge_summary(_replies(spark, sf_dir).select("set", "infra_failed", *[f"j.{m}" for m in _MARKS])).where("set is not null")
    return evaluate.composite(summary, 6).select("set", "composite")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark questions, BM25 and fused routes over the documents, then document-level metrics by route."""
    return route_compare(spark, sf_dir)
