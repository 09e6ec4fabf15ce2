import math
import random
import shutil
import time
from collections import Counter

import pytest

from pyspark.sql import functions as F

from papyra.operators import index, judge, rag, retrieve
from papyra.operators.evaluate import NO_CONTEXT
from papyra.operators.generate import REJECT_ANSWER
from papyra.providers import ExtractiveGenerator, HashEmbedder, LetterEmbedder, OverlapReranker, ProviderError, embed_table, generate_table, is_final, rerank_table, retried
from papyra.schemas import CHUNK

CORPUS = [("chunk_000001", "甲站 水位读数说明"), ("chunk_000002", "乙站 河堤夜灯 点亮"), ("chunk_000003", "丙站 渡船停开 钟点")]


def ranks(spark, *lists):
    return [spark.createDataFrame([("q", x, k + 1) for k, x in enumerate(ids)], "qid string, id string, rank int") for ids in lists]


def test_rrf(spark):
    rows = retrieve.rrf(ranks(spark, "xyz", "yxw")).orderBy("rank").collect()
    assert [r["id"] for r in rows][:2] == ["x", "y"] and {r["id"] for r in rows[2:]} == {"z", "w"}
    assert rows[0]["score"] == rows[1]["score"] == round(1 / 61 + 1 / 62, 12)
    assert [r["score"] for r in rows] == sorted((r["score"] for r in rows), reverse=True)
    (alone,) = retrieve.rrf(ranks(spark, ["alone"], [])).collect()
    assert alone["score"] == round(1 / 61, 12) and retrieve.rrf(ranks(spark, [], [])).count() == 0


def test_bm25_finds_the_chunk(spark):
    ix = index.build(spark.createDataFrame(CORPUS, "id string, text string"))
    q = spark.createDataFrame([("q1", "河堤夜灯"), ("q2", "nothing here"), ("q3", None)], "qid string, text string")
    assert [(r["qid"], r["id"]) for r in retrieve.bm25_topk(ix, q, 3).collect()] == [("q1", "chunk_000002")]
    again = index.load(spark, ix.path)
    assert again.terms.count() == ix.terms.count() and index.load_or_build(spark, ix.path, None).postings.count() == ix.postings.count()


def test_containing(spark):
    docs = [(1, "say Alpha beta gamma delta now"), (2, "alphabeta gammas"), (3, "xalpha beta gammay"), (4, ""), (5, None), (6, "ab")]
    table = spark.createDataFrame(docs, "id long, body string")
    queries = [(10, "lpha beta gamma"), (11, "b"), (12, "beta gamma delta"), (13, None), (14, ""), (15, "Alpha zeta beta gamma"), (16, "--")]
    ix = index.build(table.selectExpr("id", "body as text"))
    got = {tuple(r) for r in retrieve.containing(ix, table, spark.createDataFrame(queries, "qid long, text string")).collect()}
    assert got == {(q, i) for q, t in queries for i, d in docs if t and d and t in d}


def test_empty_corpus_is_an_error(spark):
    with pytest.raises(RuntimeError, match="empty"):
        index.build(spark.createDataFrame([], "id string, text string"))


def test_answers_end_to_end(spark):
    chunks = spark.createDataFrame([(i, "d", ["A"], t, [], 1, 2) for i, t in CORPUS], CHUNK)
    ix = index.build(chunks.select("id", "text"))
    q = spark.createDataFrame([("q1", "河堤夜灯 点亮"), ("q2", "zzz")], "qid string, text string")
    rows = {r["qid"]: r for r in rag.answer(ix, chunks, q, ExtractiveGenerator(), threshold=0.3).collect()}
    assert rows["q1"]["answer"] == "乙站 河堤夜灯 点亮 [chunk_000002]" and tuple(rows["q1"]["citations"]) == (1, 0, False) and rows["q1"]["topk"][0]["page"] == [1, 2]
    assert rows["q2"]["rejected"] and rows["q2"]["answer"] == REJECT_ANSWER and rows["q2"]["citations"] is None
    given = rag.answer(ix, chunks, q, ExtractiveGenerator(), threshold=0.3).withColumns({"gold_answer": F.lit("g"), "answerable": F.lit(True)})
    asked = {r["qid"]: r["prompt"] for r in judge.prompts(given, chunks).collect()}
    assert "[chunk_000002] 乙站" in asked["q1"] and NO_CONTEXT in asked["q2"] and set(judge.template(given).columns) > {"faithfulness"}


def test_bm25_against_the_formula(spark):
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 12)))) for i in range(30)]
    queries = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 4)))) for i in range(6)]
    got = retrieve.bm25(index.build(spark.createDataFrame(docs, "id long, text string")), spark.createDataFrame(queries, "qid long, text string"))
    bags = {i: Counter(t.split()) for i, t in docs}
    n, avg = len(docs), sum(sum(b.values()) for b in bags.values()) / len(docs)
    df = Counter(w for b in bags.values() for w in b)
    raw = {w: math.log(n - d + 0.5) - math.log(d + 0.5) for w, d in df.items()}
    idf = {w: x if x >= 0 else 0.25 * sum(raw.values()) / len(raw) for w, x in raw.items()}
    for r in got.collect():
        b = bags[r["id"]]
        want = sum(idf[w] * b[w] * 2.5 / (b[w] + 1.5 * (0.25 + 0.75 * sum(b.values()) / avg)) for w in dict(queries)[r["qid"]].split() if w in b)
        assert r["score"] == pytest.approx(want, abs=1e-6)


def test_vectors_against_brute_force(spark):
    rng = random.Random(7)
    vec = lambda: [rng.uniform(-1, 1) for _ in range(8)]
    docs = [(i, vec()) for i in range(50)] + [(50, None), (51, [0.0] * 8)]
    queries = [(i, vec()) for i in range(9)]
    s = "array<float>"
    got = retrieve.vector_topk(spark.createDataFrame(docs, f"id long, embedding {s}"), spark.createDataFrame(queries, f"qid long, embedding {s}"), 4, block=4)
    cos = lambda a, b: sum(x * y for x, y in zip(a, b)) / (math.dist(a, [0] * 8) * math.dist(b, [0] * 8) or 1)
    found: dict = {}
    for r in got.orderBy("qid", "rank").collect():
        found.setdefault(r["qid"], []).append(r["id"])
    assert found == {q: sorted((i for i, e in docs if e), key=lambda i: (-round(cos(v, docs[i][1]), 6), i))[:4] for q, v in queries}
    none = spark.createDataFrame([], f"qid long, embedding {s}")
    assert retrieve.vector_topk(spark.createDataFrame(docs, f"id long, embedding {s}"), none, 4).count() == 0


def test_hybrid_keeps_both_lists_and_known_ids(spark):
    v = spark.createDataFrame([("q", "a", 0.9, 1), ("q", "b", 0.5, 2)], "qid string, id string, score double, rank int")
    b = spark.createDataFrame([("q", "c", 7.0, 1), ("q", "a", 3.0, 2)], "qid string, id string, score double, rank int")
    rows = {r["id"]: r for r in retrieve.hybrid(v, b, 5).collect()}
    assert set(rows) == {"a", "b", "c"} and rows["a"]["rank"] == 1 and rows["c"]["score"] == 0.0 and rows["c"]["bm25_score"] == 7.0
    assert [r["id"] for r in retrieve.hybrid(v, b, 1, spark.createDataFrame([("b",)], "id string")).collect()] == ["b"]
    assert retrieve.candidate_sizes(5) == (20, 26)


def test_routes(spark):
    ix = index.build(spark.createDataFrame(CORPUS, "id string, text string"))
    q = spark.createDataFrame([("q", "河堤夜灯 点")], "qid string, text string")
    for d in retrieve.routes(ix, q, 2).values():
        assert d.where("rank = 1").first()["id"] == "chunk_000002"
    assert retrieve.search_route("vector_only", ix, q, 1).count() == retrieve.search_route("other", ix, q, 1).count() == 1


def test_rerank_provider(spark):
    class Fixed:
        def scores(self, query, documents):
            assert len(documents) == 3
            return [(1, 0.9), (0, 0.8), (2, 0.7)]

    c = spark.createDataFrame([("q", "?", i + 1, f"c{i}", f"text {i}") for i in range(3)], "qid string, question string, rank int, id string, text string")
    rows = rerank_table(c, Fixed(), 2).orderBy("rank").collect()
    assert [(r["id"], r["score"]) for r in rows] == [("c1", 0.9), ("c0", 0.8)]
    assert rerank_table(c, OverlapReranker(), 5).count() == 3 and rerank_table(c.limit(0), OverlapReranker(), 5).count() == 0


def test_rerank_provider_sees_all_candidates(spark):
    class Last:
        def scores(self, query, documents):
            return [(i, float(i)) for i in range(len(documents))]

    c = spark.createDataFrame([("q", "?", i + 1, f"c{i}", f"text {i}") for i in range(26)], "qid string, question string, rank int, id string, text string")
    assert [r["id"] for r in rerank_table(c, Last(), 3).orderBy("rank").collect()] == ["c25", "c24", "c23"]
    assert rerank_table(c, Last(), 25).count() == 20


def test_routes_with_models(spark):
    """Dense search over a store, a reranker that sees every candidate; the sparse route isn't asked."""
    corpus = spark.createDataFrame([(i, t) for i, t in enumerate(["aab", "bba", "ccc", "abc abc", "zz"])], "id long, text string")
    store = embed_table(corpus, LetterEmbedder())
    q = spark.createDataFrame([("q", "ab zz")], "qid string, text string")

    class Backwards:
        def scores(self, query, documents):
            assert query == "ab zz" and len(documents) == 5
            return [(k, float(k)) for k in range(5)]

    found = retrieve.routes(index.build(corpus), q, 2, retrieve.Models(store, LetterEmbedder(), Backwards(), corpus), "ACD")
    assert [r["id"] for r in found["D"].orderBy("rank").collect()] == [4, 0]
    order = [r["id"] for r in retrieve.dense_topk(store, LetterEmbedder(), q, 5).orderBy("rank").collect()]
    assert [r["id"] for r in found["C"].orderBy("rank").collect()] == order[:-3:-1]
    assert [r["score"] for r in found["A"].orderBy("rank").collect()] == [4.0, 3.0]


def test_refusals_are_not_tried_again(spark):
    def calls(status):
        n = []

        def call():
            n.append(1)
            raise ProviderError(status) if status else ConnectionError("gone")

        with pytest.raises(Exception):
            retried(call, pause=lambda n: 0, final=is_final)
        return len(n)

    assert [calls(s) for s in (400, 401, 404, 429, 500, 503, None)] == [1, 1, 1, 4, 4, 4, 4]
    from urllib.error import HTTPError

    assert is_final(HTTPError("u", 404, "gone", {}, None)) and not is_final(HTTPError("u", 502, "down", {}, None)) and not is_final(TimeoutError())

    class Refuses:
        def answer(self, messages):
            raise ProviderError(403, "no")

    rows = spark.createDataFrame([("q", [{"role": "user", "content": "x"}])], "qid string, messages array<struct<role: string, content: string>>")
    begun = time.time()
    assert [tuple(r) for r in generate_table(rows, Refuses(), pause=lambda n: 30.0).collect()] == [("q", "", "ProviderError: status 403: no")]
    assert time.time() - begun < 25


def test_segmenter(spark):
    pairs = lambda t: [t[i : i + 2] for i in range(0, len(t), 2)]
    ix = index.build(spark.createDataFrame([(1, "河堤 水位"), (2, "水位图")], "id long, text string"), segment=pairs)
    assert {r["tok"] for r in ix.terms.collect()} == {"河堤", " 水", "位", "水位", "图"}
    q = spark.createDataFrame([("q", "水位")], "qid string, text string")
    assert {r["id"] for r in retrieve.bm25(ix, q).collect()} == {2}


def test_index_is_built_only_where_there_is_none(spark, tmp_path):
    corpus = spark.createDataFrame([(1, "a b")], "id long, text string")
    path = str(tmp_path / "ix")
    assert index.load_or_build(spark, path, corpus).terms.count() == 2
    shutil.rmtree(tmp_path / "ix" / "terms")
    with pytest.raises(Exception):
        index.load_or_build(spark, path, corpus)
    assert not (tmp_path / "ix" / "terms").exists()


def test_embedding_provider(spark):
    rows = spark.createDataFrame([(i, f"text {i}") for i in range(21)] + [(99, None)], "id long, text string")
    out = {r["id"]: r["embedding"] for r in embed_table(rows, HashEmbedder(16)).collect()}
    assert len(out) == 22 and all(len(v) == 16 for v in out.values())
    v = index.vector_rows(spark.createDataFrame([("c", "d", ["A", "B"], "t", [], 1, None)], "id string, doc string, section_path array<string>, text string, rows array<array<string>>, start_page int, end_page int"), spark.createDataFrame([("c", [1.0])], "id string, embedding array<float>")).first()
    assert v["section_path"] == "A / B" and v["end_page"] == 0
