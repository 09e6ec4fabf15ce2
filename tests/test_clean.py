import pytest

from papyra.operators import clean
from papyra.schemas import BLOCK


def blocks(spark, texts, kind="para"):
    return spark.createDataFrame([("d", i, kind, t, 1, [], 1) for i, t in enumerate(texts)], BLOCK)


@pytest.mark.parametrize(
    ("texts", "kept"),
    [(["水位表", "冒险者协会", "看别的", "订阅"], 2), (["河堤已经修好。冒险者协会", "别的"], 1), (["冒险者协会明天开门", "表"], 2), (["冒险者协会", "x", "冒险者协会", "y"], 3), (["a", "b"], 2), (["a", "冒险者协会"], 2)],
)
def test_truncate_tail(spark, texts, kept):
    assert [r["text"] for r in clean.truncate_tail(blocks(spark, texts)).orderBy("block_idx").collect()] == texts[:kept]


def test_clean_blocks(spark):
    rows = [("d", 0, "heading", " 水位 ", 1, [], 1), ("d", 1, "para", "45", 1, [], 1), ("d", 2, "para", "", 1, [], 1), ("d", 3, "table", "", 1, [[" a ", None], ["", " "]], 1), ("d", 4, "table", "", 1, [[""]], 1), ("d", 5, "image", "x", 1, [], 1), ("d", 6, "para", None, 1, [], 1)]
    out = clean.clean_blocks(spark.createDataFrame(rows, BLOCK)).orderBy("block_idx").collect()
    assert [(r["kind"], r["text"], r["rows"]) for r in out] == [("heading", "水位", []), ("table", "", [["a", ""]])]


def test_describe_and_manifest(spark):
    rows = [("d", 0, "heading", "ab", 1, [], 1), ("d", 1, "para", "cde", 1, [], 1), ("d", 2, "para", "f", 1, [], 1), ("d", 3, "table", "", 1, [["x", "yy"], ["z", None]], 1)]
    r = clean.describe_blocks(spark.createDataFrame(rows, BLOCK)).first()
    assert (r["blocks"], r["chars"]) == ({"heading": 1, "para": 2, "table": 1}, 10)
    assert clean.manifest(spark.createDataFrame(rows, BLOCK)).columns == ["source", "format", "corpus", "human_readable", "blocks", "chars"]


def test_empty(spark):
    none = spark.createDataFrame([], BLOCK)
    assert clean.truncate_tail(clean.clean_blocks(none)).count() == clean.manifest(none).count() == 0
