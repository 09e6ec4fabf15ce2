import json

import pytest

from papyra import schemas
from papyra.operators.graph import connected_components
from papyra.operators.ranks import global_row_number, prefix_sums
from papyra.sources import html, io
from papyra.streaming.ingest import ingest_pages


def test_records_round_trip(spark, tmp_path):
    blocks = spark.createDataFrame([("d", 0, "table", "", 1, [["a", None]], 1)], schemas.BLOCK)
    io.write_records(blocks, str(tmp_path / "blocks"))
    assert io.read_blocks(spark, str(tmp_path / "blocks")).collect() == blocks.collect()
    (tmp_path / "x.chunks.jsonl").write_text('{"id": "c1", "doc": "d", "section_path": ["A"], "text": "t"}\n\n{"id": "c2", "text": "u"}\n')
    rows = io.read_chunks(spark, str(tmp_path / "*.chunks.jsonl")).orderBy("id").collect()
    assert [r["id"] for r in rows] == ["c1", "c2"] and rows[0]["section_path"] == ["A"]
    joined = io.chunk_texts(spark.createDataFrame([("c1",), ("zz",)], "chunk_id string"), io.read_chunks(spark, str(tmp_path / "*.chunks.jsonl")))
    assert {(r["chunk_id"], r["text"]) for r in joined.collect()} == {("c1", "t"), ("zz", None)}


def test_files_by_suffix(spark, tmp_path):
    for name in ("b.PDF", "a.pdf", "c.txt"):
        (tmp_path / name).write_bytes(b"x")
    paths = sorted(r["path"].rsplit("/", 1)[1] for r in io.scan_files(spark, str(tmp_path)).collect())
    assert paths == ["a.pdf", "b.PDF"]
    if not io.pdf_available():
        with pytest.raises(RuntimeError):
            io.pdf_pages(io.scan_files(spark, str(tmp_path)))


def test_qa(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps([{"id": "S1", "question": "q", "answer": "a", "sources": ["x.pdf", "y.PDF", "z"], "answerable": False}, {"id": "S2", "question": "q"}]))
    rows = {r["qid"]: r for r in io.read_qa(spark, {"simple": str(tmp_path / "s.json")}).collect()}
    assert rows["S1"]["sources"] == ["x", "y", "z"] and not rows["S1"]["answerable"] and rows["S2"]["sources"] == [] and rows["S2"]["answerable"]
    with pytest.raises(FileNotFoundError):
        io.read_qa(spark, {"simple": "s"}, "complex")


def test_snapshot_last_row_wins(spark, tmp_path):
    (tmp_path / "snap.jsonl").write_text('{"qid": "a", "k": 1, "hits": []}\n{"qid": "a", "k": 2, "hits": [{"chunk_id": "c", "page": [1, 2]}]}\n')
    (row,) = io.read_snapshot(spark, str(tmp_path / "snap.jsonl")).collect()
    assert row["k"] == 2 and row["hits"][0]["page"] == [1, 2]


def test_vector_store(spark, tmp_path):
    rows = spark.createDataFrame([("c", "t", "d", "s", 1, 2, [0.5])], schemas.VECTOR_ROW)
    for _ in range(2):
        io.write_vectors(rows, str(tmp_path / "v"))
    assert io.open_vectors(spark, str(tmp_path / "v")).collect() == rows.collect()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        io.open_vectors(spark, str(tmp_path / "none")).count()
    problems = lambda *a, **b: io.preflight(spark, *a, **b).count()
    assert problems("vector_only", str(tmp_path / "v")) == 0 and problems("hybrid_rerank", str(tmp_path / "v")) == 1
    assert problems("hybrid_rerank", str(tmp_path / "none"), chunks=str(tmp_path), key_ready=False) == 2


def test_markdown(spark):
    rows = [("d", 0, "heading", "T", 2, [], 1), ("d", 1, "para", "p", 1, [], 1), ("d", 2, "table", "", 1, [["a", "b"], ["c"]], 1), ("d", 3, "table", "", 1, [], 1)]
    assert io.render_markdown(spark.createDataFrame(rows, schemas.BLOCK)).first()["markdown"] == "## T\n\np\n\n| a | b |\n| --- | --- |\n| c |  |\n"


def test_html_blocks(spark):
    page = "<html><head><title>no</title><style>p{}</style></head><body><h2>T &amp; &lt;x&gt;</h2><p>one <b>two</b><br>three<p>four<!-- no --><script>var a='<p>';</script></body>"
    rows = html.html_blocks(spark.createDataFrame([(1, page), (2, None), (3, "")], "page_id long, html string")).orderBy("block_idx").collect()
    assert [(r["kind"], r["level"], r["text"]) for r in rows] == [("heading", 2, "T & <x>"), ("para", 1, "one two three"), ("para", 1, "four")]


def test_row_numbers(spark):
    df = spark.range(1000).selectExpr("(id * 37) % 1000 as x")
    rows = global_row_number(df, ["x"], "n").collect()
    assert sorted((r["n"], r["x"]) for r in rows) == [(i + 1, i) for i in range(1000)]
    assert global_row_number(df.limit(0), ["x"]).count() == 0


def test_prefix_sums(spark):
    df = spark.range(1, 501).selectExpr("id as place", "id % 7 as v")
    got = {r["place"]: r["before"] for r in prefix_sums(df, "place", "v", "before", block=16).collect()}
    assert got == {i: sum(k % 7 for k in range(1, i)) for i in range(1, 501)}


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 100), (7, 7), (200, 102), (102, 101), (None, 3)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys((100, 101, 102, 200), 100)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_stream(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "<h1>A</h1><p>" + "text " * 40 + "</p>")], "page_id long, url string, html string")
    pages.write.parquet(str(tmp_path / "in" / "one"))
    ingest = lambda: ingest_pages(spark, str(tmp_path / "in" / "*"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    assert ingest()
    pages.selectExpr("page_id + 1 as page_id", "url", "html").write.parquet(str(tmp_path / "in" / "two"))
    assert ingest() and ingest()
    assert {r["doc"] for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {"1", "2"}


def test_html_tables_and_references(spark):
    page = '<h1>A &#233;&#xE9; &#0; &amp;#65;</h1><p>x<table class="t"><tr><th>a</th><th> b&amp;c </th></tr><tr><td><p>1</p></td><td></td></tr><tr><td></td></tr></table>tail<TABLE><tr><td>q'
    rows = html.html_blocks(spark.createDataFrame([(1, page), (2, None), (3, "<table></table>")], "page_id long, html string")).collect()
    assert [(r["kind"], r["text"], r["rows"]) for r in rows] == [("heading", "A éé &#0; &#65;", []), ("para", "x", []), ("table", "", [["a", "b&c"], ["1", ""]]), ("para", "tail", []), ("table", "", [["q"]])]


def test_last_snapshot_row_counts(spark, tmp_path):
    for n, route in (("a", "first"), ("b", "second")):
        rows = [(str(i), "simple", True, route, 5, []) for i in range(3 if n == "b" else 5)]
        spark.createDataFrame(rows, schemas.SNAPSHOT).coalesce(1).write.json(str(tmp_path / "s" / n))
    got = {r["qid"]: r["route"] for r in io.read_snapshot(spark, str(tmp_path / "s" / "*")).collect()}
    assert got == {"0": "second", "1": "second", "2": "second", "3": "first", "4": "first"}


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    from papyra import shared

    class Context:
        applicationId, master = "app", "spark://somewhere:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:  # noqa: N801
            get = staticmethod(lambda key, default: default)

    monkeypatch.setattr(shared, "ship", lambda spark: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared.shared_root(Session())
