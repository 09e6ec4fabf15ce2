import importlib
import json
import os

import pytest
from pyspark import SparkFiles

from papyra.__main__ import STEPS, main


def test_all_steps(spark, tmp_path, capsys):
    pages = [(i, f"<h1>Topic {w}</h1><p>The {w} machine works with {w} oil and was built in {1900 + i}. " + "More words follow here. " * 8 + "</p>") for i, w in enumerate(["copper", "silver", "golden", "iron"])]
    spark.createDataFrame(pages, "page_id long, html string").write.parquet(str(tmp_path / "pages"))
    asked = [{"id": "S1", "question": "which oil for the silver machine", "answer": "silver oil", "sources": ["1.pdf"]}, {"id": "S2", "question": "zebra", "answerable": False}]
    (tmp_path / "qa.json").write_text(json.dumps(asked))
    common = ["--out", str(tmp_path / "out"), "--pages", str(tmp_path / "pages"), "--questions", str(tmp_path / "qa.json"), "--threshold", "0.3"]
    with pytest.raises(SystemExit):
        main(["ask", *common], spark)
    for step in [s for s in STEPS if s != "pdfs"]:
        main([step, *common], spark)
    read = lambda name: spark.read.json(str(tmp_path / "out" / name))
    answers = {r["qid"]: r for r in read("answers-hybrid_rerank").collect()}
    assert "silver oil" in answers["S1"]["answer"] and answers["S2"]["rejected"]
    assert {r["route"]: r["recall"] for r in read("retrieval-metrics").collect()} == {"vector_only": 1.0, "hybrid_rerank": 1.0}
    assert read("thresholds-hybrid_rerank").first()["route"] == "hybrid_rerank" and read("judged-hybrid_rerank").count() == 2
    assert read("manifest").count() == 4 and spark.read.parquet(str(tmp_path / "out" / "vectors")).count() == 4


FAKE = '''
"""Stands in for the PDF library: a file is JSON of its pages."""
import json


class Table:
    def __init__(self, given):
        self.bbox, self.rows = given["box"], given["rows"]

    def extract(self):
        return self.rows


class Tables:
    def __init__(self, tables):
        self.tables = tables


class Page:
    def __init__(self, given):
        self.given = given

    def get_text(self, kind):
        lines = [{"bbox": x["box"], "spans": [{"text": t, "size": x["size"], "flags": 16 * x["bold"]} for t in x["texts"]]} for x in self.given["lines"]]
        return {"blocks": [{"type": 1}, {"type": 0, "lines": lines}]}

    def find_tables(self):
        if self.given["tables"] is None:
            raise ValueError("no tables today")
        return Tables([Table(t) for t in self.given["tables"]])


def open(stream, filetype):
    return [Page(p) for p in json.loads(stream)]
'''


def test_pdfs(spark, tmp_path, monkeypatch):
    line = lambda y, texts, size=10.0, bold=False: {"box": [50.0, y, 300.0, y + size], "size": size, "bold": bold, "texts": texts}
    pages = [
        {"lines": [line(10, ["Water", "levels"], 15.0, True), line(40, ["The river stood ", "high"]), line(52, ["for days"]), line(110, ["in table"]), line(200, [" "])], "tables": [{"box": [40.0, 100.0, 400.0, 150.0], "rows": [["day", " m "], [None, ""], ["1", "3"]]}]},
        {"lines": [line(10, ["Then it fell."])], "tables": None},
    ]
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "b.PDF").write_text(json.dumps(pages))
    (folder / "notes.txt").write_text("left out")
    fake = tmp_path / "fitz.py"
    fake.write_text(FAKE)
    monkeypatch.syspath_prepend(str(tmp_path))
    spark.sparkContext.addPyFile(str(fake))
    try:
        main(["pdfs", "--out", str(tmp_path / "out"), "--pdfs", str(folder)], spark)
    finally:
        os.remove(SparkFiles.get("fitz.py"))  # other tests find the library missing, as it is
        importlib.invalidate_caches()
    main(["chunks", "--out", str(tmp_path / "out")], spark)
    blocks = spark.read.parquet(str(tmp_path / "out" / "blocks")).orderBy("block_idx").collect()
    assert [(r["doc"], r["kind"], r["text"], r["page"]) for r in blocks] == [("b", "table", "", 1), ("b", "heading", "Water levels", 1), ("b", "para", "The river stood high for days", 1), ("b", "para", "Then it fell.", 2)]
    assert blocks[0]["rows"] == [["day", "m"], ["1", "3"]]
    assert spark.read.json(str(tmp_path / "out" / "manifest")).first()["format"] == "pdf"
    assert spark.read.parquet(str(tmp_path / "out" / "chunks")).count() == 2
