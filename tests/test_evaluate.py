import pytest
from pyspark.sql import functions as F

from papyra.operators import calibrate, evaluate, generate
from papyra.providers import ExtractiveGenerator, MechanicalJudge, batch_size, dimension, generate_table, HashEmbedder, judge_table, load_env, retried


def figures(spark, docs, sources, k):
    df = spark.createDataFrame([(docs, sources)], "docs array<string>, sources array<string>")
    return df.select(evaluate.score_question(F.col("docs"), F.col("sources"), F.lit(k)).alias("m")).first()["m"]


def test_score_question(spark):
    m = figures(spark, ["p", "q", "s1", "r"], ["s1"], 4)
    assert (m["recall"], m["p1"], m["mrr"]) == (1.0, 0.0, 1 / 3)
    m = figures(spark, ["s2", "q", "s1", "s5", "s4", "r", "s3"], ["s1", "s2", "s3", "s4", "s5", "s6", "s7", "s8"], 6)
    assert (m["recall"], m["precision"], m["p1"]) == (0.5, 4 / 6, 1.0)
    assert figures(spark, ["s1", "s1"], ["s1", "s2", "s3", "s4"], 2)["recall"] == 0.25
    assert figures(spark, ["D1"], [], 3) is None and figures(spark, ["D1"], [""], 3) is None
    assert figures(spark, ["D1"], ["D1"], 5)["precision"] == 0.2
    m = figures(spark, [], ["D1"], 5)
    assert (m["recall"], m["mrr"], m["p1"]) == (0.0, 0.0, 0.0) and figures(spark, ["D1"], ["D1"], 0)["precision"] == 0.0


def test_macro_and_reports(spark):
    qa = spark.createDataFrame([("a", ["D1"], "simple", True), ("b", ["D1", "D2"], "complex", True), ("c", [], "simple", False)], "qid string, sources array<string>, set string, answerable boolean")
    hits = spark.createDataFrame([("a", 1, "D1"), ("b", 1, "D2"), ("b", 2, "X")], "qid string, rank int, doc string")
    rated = evaluate.score_hits(qa, hits, 5)
    m = evaluate.macro(rated).first()
    assert (m["n"], m["recall"], m["any_hit"], m["all_hit"]) == (2, 0.75, 1.0, 0.5)
    by = {r["set"]: r for r in evaluate.set_report(rated).collect()}
    assert by["simple"]["unanswerable"] == 1 and by["simple"]["precision"] is None and by["complex"]["mrr"] is None
    assert {r["coverage"]: r["n"] for r in evaluate.coverage_split(rated, "mrr").collect()} == {"full": 1, "partial": 1}
    assert [r["m"] for r in rated.orderBy("qid").select(evaluate.mark(F.col("n_hit"), F.col("n_sources")).alias("m")).collect()] == ["√", "√", "-"]
    assert {(r["qid"], r["problem"]) for r in evaluate.reconcile(qa, hits.union(spark.createDataFrame([("z", 1, "D")], hits.schema)).select("qid").distinct()).collect()} == {("c", "missing"), ("z", "unknown")}
    both = evaluate.set_report(rated).withColumn("route", F.lit("A")).unionByName(evaluate.set_report(rated).withColumn("route", F.lit("B")))
    assert set(evaluate.side_by_side(both, "recall").columns) == {"set", "A", "B"}
    assert evaluate.macro(rated.limit(0)).first()["recall"] is None


def test_snapshot(spark):
    qa = spark.createDataFrame([("a", "simple", True), ("b", "simple", False)], "qid string, set string, answerable boolean")
    hits = spark.createDataFrame([("a", 1, "c1", 0.5, "d", "s", 2, 3), ("a", 2, "c2", 0.4, "d", "s", 0, 0)], "qid string, rank int, id string, score double, doc string, section_path string, start_page int, end_page int")
    rows = {r["qid"]: r for r in evaluate.snapshot(qa, hits, "r", 5).collect()}
    assert [h["page"] for h in rows["a"]["hits"]] == [[2, 3], None] and rows["b"]["hits"] == []


def test_judge(spark):
    raw = [("a", 'so {"faithfulness": 1, "citation": 0.5, "answer_accuracy": 0, "rejection": 1, "notes": "x"} end'), ("b", "no json"), ("c", "{broken"), ("d", None)]
    got = {r["q"]: r["j"] for r in spark.createDataFrame(raw, "q string, raw string").select("q", evaluate.parse_judge(F.col("raw")).alias("j")).collect()}
    assert got["a"]["citation"] == 0.5 and got["b"] is got["c"] is got["d"] is None
    rows = [("simple", False, 1.0, 1.0, 1.0, 1.0), ("simple", True, None, None, None, None), ("complex", False, 0.5, 0.0, 0.5, 1.0), ("complex", False, None, None, None, None)]
    out = {r["set"]: r for r in evaluate.judge_summary(spark.createDataFrame(rows, "set string, infra_failed boolean, faithfulness double, citation double, answer_accuracy double, rejection double")).collect()}
    assert (out[None]["n"], out[None]["infra_failed"], out[None]["judge_failed"], out[None]["faithfulness"]) == (2, 1, 1, 0.75)
    assert evaluate.composite(spark.createDataFrame([(1.0, 0.5, 0.5, 1.0)], "faithfulness double, citation double, answer_accuracy double, rejection double")).first()["composite"] == 0.75


def scores(spark, pos, neg, route="r"):
    return spark.createDataFrame([(route, True, x) for x in pos] + [(route, False, x) for x in neg], "route string, positive boolean, score double")


def test_overlapping_classes(spark):
    df = scores(spark, [0.95, 0.85, 0.55], [0.75, 0.25])
    box = {r["positive"]: r for r in calibrate.describe(df).collect()}[True]
    assert (box["p25"], box["median"], box["p75"]) == (0.55, 0.85, 0.95)
    r = calibrate.report(df).first()
    assert not r["separable"] and r["suggested_min_score"] is None
    assert [(c["threshold"], c["false_reject"], c["leak"]) for c in r["candidates"]] == [(0.25, 0, 2), (0.55, 0, 1), (0.85, 1, 0)]
    assert [c["interval"] for c in r["candidates"]] == [[None, 0.25], [0.25, 0.55], [0.75, 0.85]]


def test_separable_classes_and_missing_ones(spark):
    r = calibrate.report(scores(spark, [0.65, 0.92], [0.1, 0.45])).first()
    assert r["separable"] and (r["window_low"], r["window_high"], r["suggested_min_score"]) == (0.45, 0.65, 0.55)
    r = calibrate.report(scores(spark, [0.7], [])).first()
    assert r["note"] == "one class is missing" and r["candidates"] is None
    assert calibrate.tradeoff(scores(spark, [], [])).count() == 0


HIT = "qid string, rank int, id string, score double, text string, doc string, section_path string, start_page int, end_page int"


def test_threshold(spark):
    q = spark.createDataFrame([("a",), ("b",), ("c",)], "qid string")
    hits = spark.createDataFrame([("a", 0.4), ("b", 0.8), ("b", 0.2)], "qid string, score double")
    yes, no = generate.split_by_threshold(q, hits, 0.6)
    assert [r["qid"] for r in yes.collect()] == ["b"] and {(r["qid"], r["answer"]) for r in no.collect()} == {("a", generate.REJECT_ANSWER), ("c", generate.REJECT_ANSWER)}


def test_context_messages_and_answers(spark):
    hits = spark.createDataFrame([("q", 2, "chunk_000002", 0.5, "第二段", "D2", "", 0, 0), ("q", 1, "chunk_000001", 0.9, "第一段", "D1", "A / B", 2, 3)], HIT)
    r = generate.contexts(hits).first()
    assert r["context"] == "[chunk_000001] 来源:D1 §A / B p.2~3\n第一段\n\n[chunk_000002] 来源:D2 §全文\n第二段\n"
    assert r["appendix"] == "引用来源: [chunk_000001] D1 §A / B (p.2~3); [chunk_000002] D2 §全文"
    asked = generate.contexts(hits).select("qid", generate.messages(F.lit("问?"), F.col("context")).alias("messages"))
    out = generate_table(asked, ExtractiveGenerator()).first()
    assert out["answer"] == "第一段 [chunk_000001]" and out["error"] is None


def test_errors_stay_in_their_row(spark):
    class Failing:
        def answer(self, messages):
            raise RuntimeError("down")

    rows = spark.createDataFrame([("q", [("user", "x")])], "qid string, messages array<struct<role: string, content: string>>")
    out = generate_table(rows, Failing(), pause=lambda n: 0.0).first()
    assert (out["answer"], out["error"]) == ("", "RuntimeError: down")
    prompts = spark.createDataFrame([("a", "资料 x\n【系统生成的回答】x"), ("b", "【系统生成的回答】y")], "qid string, prompt string")
    raw = {r["qid"]: r["raw"] for r in judge_table(prompts, MechanicalJudge()).collect()}
    assert '"faithfulness": 1.0' in raw["a"] and '"faithfulness": 0.0' in raw["b"]


def test_retries():
    calls, pauses = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("again")
        return "ok"

    assert retried(flaky, sleep=pauses.append) == "ok" and pauses == [1.5, 3.0]
    with pytest.raises(ValueError, match="stop"):
        retried(lambda: (_ for _ in ()).throw(ValueError("stop")), final=lambda e: True, sleep=pauses.append)
    assert [batch_size(n) for n in (0, 8, 99)] == [1, 8, 10] and dimension(HashEmbedder(5)) == 5
    with pytest.raises(ValueError):
        HashEmbedder().embed([])


def test_citations_and_topk(spark):
    df = spark.createDataFrame([("见 [chunk_000001] [chunk_999999]",), ("无",), (None,)], "a string")
    got = [tuple(r["c"]) for r in df.select(generate.citations(F.col("a"), F.array(F.lit("chunk_000001"), F.lit("chunk_000002"))).alias("c")).collect()]
    assert got == [(["chunk_000001"], ["chunk_999999"], False), ([], [], True), ([], [], True)]
    hits = spark.createDataFrame([([("c1", "d", "s", 2, 3), ("c2", "d", "s", 0, 0)],)], "h array<struct<id: string, doc: string, section_path: string, start_page: int, end_page: int>>")
    assert [h["page"] for h in hits.select(generate.topk(F.col("h")).alias("t")).first()["t"]] == [[2, 3], None]
    q = spark.createDataFrame([("b",), ("a",)], "qid string")
    assert [r["qid"] for r in generate.limited(q, 1).collect()] == ["a"] and generate.limited(q, 0).count() == 2


def test_env_file(tmp_path, monkeypatch):
    monkeypatch.setenv("PAPYRA_T1", "old")
    monkeypatch.delenv("PAPYRA_T2", raising=False)
    (tmp_path / "env").write_text("# c\nPAPYRA_T1=new\nPAPYRA_T2='x y'\n\nbad line\n")
    assert load_env(str(tmp_path / "env")) == {"PAPYRA_T2": "x y"}
    monkeypatch.delenv("PAPYRA_T2")
