"""Retrieval: BM25, dense and sparse cosine, rank fusion, hybrid candidates, reranking, routes.

Everything takes a table of queries (qid, text) and answers all of them in one plan. Tables of queries
are broadcast only up to ``BROADCAST_QUERY_ROWS`` rows of tokens; larger ones join by shuffle.
Scores are rounded before ranking, so ties fall the same way whatever the order of summation.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from papyra.functions.text import tokens
from papyra.operators.index import B, K1, Index
from papyra.operators.ranks import global_row_number
from papyra.providers import Embedder, Reranker, embed_table, rerank_table
from papyra.shared import filesystem, ship, written

BROADCAST_QUERY_ROWS, SHORT_BLOCK = 200_000, 1000
RRF_K = 60


def ranked(hits: DataFrame, n: int, *tie: str, score: str = "score") -> DataFrame:
    """The best ``n`` of each qid by score, then by the tie columns, with a 1-based rank."""
    order = Window.partitionBy("qid").orderBy(F.col(score).desc(), *tie)
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def query_tokens(queries: DataFrame, index: Index) -> DataFrame:
    """(qid, tok, qtf): tokens of each query with their number, cut as the index was."""
    exploded = queries.select("qid", F.explode(tokens(F.coalesce("text", F.lit("")), index.segment)).alias("tok"))
    return exploded.groupBy("qid", "tok").agg(F.count("*").alias("qtf"))


def _sized(df: DataFrame) -> DataFrame:
    df = written(df, "query-tokens")
    return F.broadcast(df) if df.count() <= BROADCAST_QUERY_ROWS else df


def bm25(index: Index, queries: DataFrame) -> DataFrame:
    """(qid, id, score) of every document with a query token; repeated query tokens count again."""
    average = F.broadcast(index.lengths.agg(F.avg("dl").alias("avgdl")))
    wanted = query_tokens(queries, index).join(index.terms.select("tok", "idf"), "tok")
    matched = index.postings.join(_sized(wanted), "tok").join(index.lengths, "id").crossJoin(average)
    weight = F.col("idf") * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.col("avgdl")))
    return matched.groupBy("qid", "id").agg(F.round(F.sum(F.col("qtf") * weight), 6).alias("score"))


def bm25_topk(index: Index, queries: DataFrame, n: int) -> DataFrame:
    """The best ``n`` by score and id, of which those with a positive score are kept."""
    return ranked(bm25(index, queries), n, "id").where("score > 0")


def tfidf_topk(index: Index, queries: DataFrame, n: int) -> DataFrame:
    """Cosine of tf * ln((N + 1) / (df + 1)) + 1 vectors: a sparse route that needs no embedder. Norms are stored with the index."""
    q = query_tokens(queries, index).join(index.terms.select("tok", "w"), "tok").select("qid", "tok", "w", (F.col("qtf") * F.col("w")).alias("y"))
    q = _sized(q)
    q_norms = q.groupBy("qid").agg(F.sqrt(F.sum(F.col("y") * F.col("y"))).alias("q_norm"))
    dots = index.postings.join(q, "tok").groupBy("qid", "id").agg(F.sum(F.col("tf") * F.col("w") * F.col("y")).alias("dot"))
    scored = dots.join(index.norms, "id").join(q_norms, "qid")
    return ranked(scored.select("qid", "id", F.round(F.col("dot") / (F.col("norm") * F.col("q_norm")), 6).alias("score")), n, "id")


@functools.lru_cache(maxsize=2)
def _query_block(files: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(qids, unit vectors) of a table of queries in the shared folder."""
    import pyarrow.parquet as pq

    tables = []
    for file in files:
        fs, path = filesystem(file)
        with fs.open_input_file(path) as f:
            tables.append(pq.read_table(f, columns=["qid", "embedding"]))
    table = pa.concat_tables(tables)
    return table.column(0).to_numpy(), _unit(table.column(1).to_pylist())


def _unit(rows: list) -> np.ndarray:
    x = np.array(rows, np.float64)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def vector_topk(corpus: DataFrame, queries: DataFrame, n: int, block: int = 16_384, step: int = 1024) -> DataFrame:
    """Exact cosine search of queries (qid, embedding) in corpus (id, embedding): (qid, id, score, rank).

    Queries lie in the shared folder in blocks of at most ``block`` rows, which tasks read; the driver holds none. For each block a
    task multiplies its rows with ``step`` queries at a time and keeps its own best ``n`` per query, so the final ranking
    sees n rows per query and task. Null vectors are left out.
    """
    spark = corpus.sparkSession
    kinds = f"qid {queries.schema['qid'].dataType.simpleString()}, id {corpus.schema['id'].dataType.simpleString()}, score double"
    asked = written(global_row_number(queries.select("qid", "embedding").where("embedding is not null"), ["qid"], "place"), "query-vectors")
    total, found = asked.count(), None
    vectors = corpus.select("id", "embedding").where("embedding is not null")

    def search(files: tuple[str, ...]):
        def run(batches):
            qids, matrix = _query_block(files)
            best = None
            for batch in batches:
                if not batch.num_rows:
                    continue
                ids, x = batch.column(0).to_numpy(zero_copy_only=False), _unit(batch.column(1).to_pylist())
                parts = []
                for s in range(0, len(qids), step):
                    score = np.round(matrix[s : s + step] @ x.T, 6)
                    ids_all = np.broadcast_to(ids, score.shape)
                    if best is not None:
                        score, ids_all = np.concatenate([best[0][s : s + step], score], axis=1), np.concatenate([best[1][s : s + step], ids_all], axis=1)
                    order = np.lexsort((ids_all, -score), axis=1)[:, :n]
                    parts.append((np.take_along_axis(score, order, 1), np.take_along_axis(ids_all, order, 1)))
                best = tuple(np.concatenate([p[k] for p in parts]) for k in (0, 1))
            if best is not None:
                width = best[0].shape[1]
                for s in range(0, len(qids), step):
                    columns = [np.repeat(qids[s : s + step], width), best[1][s : s + step].ravel(), best[0][s : s + step].ravel()]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["qid", "id", "score"])

        ship(spark)
        return vectors.mapInArrow(run, kinds)

    for first in range(0, total, block):
        part = asked.where(F.col("place").between(first + 1, first + block)).select("qid", "embedding")
        rows = search(tuple(sorted(written(part.coalesce(8), "query-block").inputFiles())))
        found = rows if found is None else found.unionByName(rows)
    return ranked(found if found is not None else spark.createDataFrame([], kinds), n, "id")


def rrf(lists: list[DataFrame], k: int = RRF_K) -> DataFrame:
    """Fuse rankings (qid, id, rank): the sum of 1 / (k + rank); ties by first appearance, list by list."""
    tagged = [d.select("qid", "id", F.lit(i).alias("list"), F.col("rank").cast("int").alias("rank")) for i, d in enumerate(lists)]
    every = tagged[0]
    for d in tagged[1:]:
        every = every.unionByName(d)
    fused = every.groupBy("qid", "id").agg(F.round(F.sum(1.0 / (k + F.col("rank"))), 12).alias("score"), F.min(F.struct("list", "rank")).alias("first"))
    return fused.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy(F.col("score").desc(), "first"))).drop("first")


def candidate_sizes(k: int) -> tuple[int, int]:
    """For a final ``k``: fused candidates for reranking, and hits taken from each list for these."""
    fused = max(20, k + 6)
    return fused, max(20, fused + 6)


def hybrid(vector: DataFrame, lexical: DataFrame, k: int, known: DataFrame | None = None) -> DataFrame:
    """Fused best ``k`` with the score of each list; ids outside ``known`` (id) are left out before the cut."""
    fused = rrf([vector, lexical]).select("qid", "id", F.col("score").alias("rrf_score"), F.col("rank").alias("fused"))
    if known is not None:
        fused = fused.join(known.select("id"), "id", "left_semi")
    v = vector.select("qid", "id", F.col("score").alias("vec_score"))
    b = lexical.select("qid", "id", F.col("score").alias("bm25_score"))
    both = fused.join(v, ["qid", "id"], "left").join(b, ["qid", "id"], "left")
    both = both.withColumns({"score": F.coalesce("vec_score", F.lit(0.0)), "bm25_score": F.coalesce("bm25_score", F.lit(0.0))}).drop("vec_score")
    return both.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy("fused"))).where(F.col("rank") <= k).drop("fused")


def coverage_rerank(candidates: DataFrame, queries: DataFrame, index: Index, k: int) -> DataFrame:
    """Rerank by the idf-weighted share of distinct query terms in the candidate: the offline stand-in for a model."""
    q = query_tokens(queries, index).join(index.terms.select("tok", "idf"), "tok").select("qid", "tok", F.greatest("idf", F.lit(0.0)).alias("idf"))
    q = _sized(q)
    total = q.groupBy("qid").agg(F.sum("idf").alias("total"))
    pairs = candidates.select("qid", "id", F.col("rank").alias("before"))
    seen = pairs.join(q, "qid").join(index.postings.select("tok", "id"), ["tok", "id"], "left_semi").groupBy("qid", "id").agg(F.sum("idf").alias("seen"))
    scored = pairs.join(seen, ["qid", "id"], "left").join(total, "qid", "left")
    relevance = F.round(F.coalesce(F.col("seen") / F.when(F.col("total") > 0, F.col("total")), F.lit(0.0)), 6)
    return ranked(scored.select("qid", "id", "before", relevance.alias("score")), k, "before").drop("before")


def dense_topk(store: DataFrame, embedder: Embedder, queries: DataFrame, n: int) -> DataFrame:
    """The best ``n`` rows of a vector store (id, embedding) for queries (qid, text), embedded like the store was."""
    embedded = written(embed_table(queries.select(F.col("qid").alias("id"), "text"), embedder), "query-embeddings")
    return vector_topk(store, embedded.withColumnRenamed("id", "qid"), n)


@dataclass
class Models:
    """What a route asks of models: a vector store with the embedder of its queries, and a reranker with the texts (id, text) it
    reads. A part left out is stood in for by the sparse cosine and by ``coverage_rerank``."""

    store: DataFrame | None = None
    embedder: Embedder | None = None
    reranker: Reranker | None = None
    texts: DataFrame | None = None

    def vector(self, index: Index, queries: DataFrame, n: int) -> DataFrame:
        return tfidf_topk(index, queries, n) if self.store is None else dense_topk(self.store, self.embedder, queries, n)

    def rerank(self, candidates: DataFrame, queries: DataFrame, index: Index, k: int) -> DataFrame:
        """All candidates of a query go to the model together."""
        if self.reranker is None:
            return coverage_rerank(candidates, queries, index, k)
        asked = candidates.select("qid", "id", "rank").join(queries.select("qid", F.col("text").alias("question")), "qid").join(self.texts.select("id", "text"), "id")
        return rerank_table(asked, self.reranker, k)


def routes(index: Index, queries: DataFrame, k: int, models: Models | None = None, wanted: str = "ABCD") -> dict[str, DataFrame]:
    """The routes of the ablation that are ``wanted``: A hybrid and rerank, B hybrid, C vector and rerank, D vector."""
    models = models or Models()
    fused, each = candidate_sizes(k)
    vector = written(models.vector(index, queries, each), "route-vector")
    lexical = written(bm25_topk(index, queries, each), "route-bm25") if set(wanted) & set("AB") else None
    made = {
        "A": lambda: models.rerank(hybrid(vector, lexical, fused), queries, index, k),
        "B": lambda: hybrid(*(d.where(F.col("rank") <= max(20, k + 6)) for d in (vector, lexical)), k).select("qid", "id", "score", "rank"),
        "C": lambda: models.rerank(vector.where(F.col("rank") <= fused), queries, index, k),
        "D": lambda: vector.where(F.col("rank") <= k),
    }
    return {name: made[name]() for name in wanted}


def search_route(mode: str, index: Index, queries: DataFrame, k: int, models: Models | None = None) -> DataFrame:
    """``vector_only``, or hybrid with reranking for any other name."""
    name = "D" if mode == "vector_only" else "A"
    return routes(index, queries, k, models, name)[name]


def containing(index: Index, docs: DataFrame, queries: DataFrame) -> DataFrame:
    """(qid, id) of the documents (id, body) that contain a query's text (qid, text) as it stands.

    A document that does has every token inside the text, but for the first and last, which may be parts of longer ones
    there. Documents with the rarest of these tokens are looked up and compared; queries of under three tokens
    are held against all documents, in blocks of ``SHORT_BLOCK`` queries as one row each.
    """
    asked = queries.where("text is not null and text <> ''").withColumn("toks", tokens(F.col("text")))
    inner = asked.where(F.size("toks") > 2).select("qid", F.explode(F.slice("toks", F.lit(2), F.size("toks") - 2)).alias("tok")).distinct()
    known = inner.join(index.terms.select("tok", "df"), "tok", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    rarest = known.groupBy("qid").agg(F.min_by("tok", F.struct("df", "tok")).alias("tok"))
    pairs = index.postings.select("tok", "id").join(_sized(rarest), "tok").select("qid", "id")
    looked_up = docs.join(pairs, "id").join(asked.select("qid", "text"), "qid")
    few = asked.where(F.size("toks") <= 2).select("qid", "text")
    blocks = written(few.groupBy(F.pmod(F.xxhash64("qid"), F.lit(-(-few.count() // SHORT_BLOCK) or 1)).alias("block")).agg(F.collect_list(F.struct("qid", "text")).alias("asked")), "short-queries")
    held = docs.crossJoin(blocks).select("id", F.explode(F.filter("asked", lambda a: F.contains("body", a["text"]))).alias("a"))
    return looked_up.where(F.contains("body", "text")).select("qid", "id").unionByName(held.select("a.qid", "id"))
