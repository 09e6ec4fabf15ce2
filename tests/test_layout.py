import pytest
from pyspark.sql import functions as F

from papyra.operators import layout
from papyra.operators.layout import _Line, join_glyphs
from papyra.schemas import LAYOUT_LINE, PAGE_TABLE


def line(text, x0, y0, x1, y1, size=9.73, bold=True):
    return _Line(text, size, bold, x0, y0, x1, y1)


def test_glyphs_are_joined():
    out = join_glyphs([line("中", 120, 40, 131, 52), line("水", 100, 43, 111, 55), line("图", 140, 43, 151, 55)], 9.0)
    assert [x.text for x in out] == ["水中图"]


def test_what_is_not_joined():
    marks = [line("水位图", 60, 30, 110, 43, 11.0), line("水位图", 75, 30, 125, 43, 11.0)]
    assert len(join_glyphs(marks, 9.0)) == 2
    many = [line("江河", 24.0 * i, 30, 24.0 * i + 12, 43) for i in range(12)]
    assert len(join_glyphs(many, 9.0)) == 12
    body = [line("上", 15, 30, 24, 39, 9.0, False), line("下", 33, 30, 42, 39, 9.0, False)]
    assert len(join_glyphs(body, 9.0)) == 2 and join_glyphs([], 9.0) == []


@pytest.mark.parametrize(("text", "size", "bold", "want"), [("水位又高了！", 13.5, True, 1), ("灯还亮着。", 9.08, False, 0), ("下游各站", 9.08, True, 2), ("水" * 51, 13.5, True, 0), ("a", 10.5, False, 2)])
def test_heading_level(spark, text, size, bold, want):
    df = spark.createDataFrame([(text, size, bold, 9.08)], "t string, s double, b boolean, body double")
    assert df.select(layout.heading_level(F.col("t"), F.col("s"), F.col("b"), F.col("body")).alias("x")).first()["x"] == want
    assert layout._level(line(text, 0, 0, 1, 1, size, bold), 9.08) == want


@pytest.mark.parametrize(("rows", "want"), [([["a"]], True), ([["单位", ""]], True), ([["a", "b"], ["c", "d"]], False), ([["a", ""], ["b", None]], True), ([], True)])
def test_fake_table(spark, rows, want):
    assert spark.createDataFrame([(rows,)], "r array<array<string>>").select(layout.is_fake_table(F.col("r")).alias("x")).first()["x"] is want


def lines_table(spark, rows):
    return spark.createDataFrame([("d", p, n, t, s, b, x0, y0, x1, y1) for n, (p, t, s, b, x0, y0, x1, y1) in enumerate(rows)], LAYOUT_LINE)


def test_paragraphs_by_distance(spark):
    df = lines_table(spark, [(1, "一", 9.0, False, 0.0, 100.0, 10.0, 110.0), (1, "二", 9.0, False, 0.0, 120.0, 10.0, 130.0), (1, "三", 9.0, False, 0.0, 200.0, 10.0, 210.0)])
    heights = spark.createDataFrame([("d", 1, 20.0)], "doc string, page int, line_h double")
    assert [r["text"] for r in layout.merge_paragraphs(df, heights).orderBy("para").collect()] == ["一二", "三"]
    assert layout.line_height(df).first()["line_h"] == 20.0 and layout.body_size(df).first()["body_size"] == 9.0


def test_span_text(spark):
    spans = [("Ab", 9.0, 0), ("cd", 10.0, 16), (" ", 30.0, 0), ("你", 9.0, 0)]
    df = spark.createDataFrame([(spans,), ([(" ", 1.0, 0)],)], "s array<struct<text: string, size: double, flags: int>>")
    got = [r["x"] for r in df.select(layout.line_text(F.col("s")).alias("x")).collect()]
    assert tuple(got[0]) == ("Ab cd你", 10.0, True) and got[1] is None


def test_blocks_of_a_document(spark):
    rows = []
    for page in (1, 2):
        rows += [(page, "各站读数", 14.0, True, 50.0, 10.0, 150.0, 24.0), (page, f"第{page}段正文内容在这里，", 10.0, False, 50.0, 40.0, 500.0, 50.0), (page, "接着上一行。", 10.0, False, 50.0, 54.0, 300.0, 64.0), (page, "12.", 10.0, False, 50.0, 68.0, 60.0, 78.0), (page, "新的段落。", 10.0, False, 50.0, 200.0, 300.0, 210.0), (page, "格", 10.0, False, 60.0, 310.0, 90.0, 320.0)]
    tables = spark.createDataFrame([("d", 1, 0, 50.0, 300.0, 300.0, 400.0, [["格", " x "], ["", ""], ["y", "z"]]), ("d", 2, 0, 50.0, 300.0, 300.0, 400.0, [["格"]])], PAGE_TABLE)
    out = layout.page_blocks(lines_table(spark, rows), tables).orderBy("block_idx").collect()
    assert [(r["kind"], r["text"], r["page"]) for r in out] == [
        ("table", "", 1), ("heading", "各站读数", 1), ("para", "第1段正文内容在这里，接着上一行。", 1), ("para", "新的段落。", 1),
        ("para", "第2段正文内容在这里，接着上一行。", 2), ("para", "新的段落。", 2), ("heading", "格", 2),
    ]
    assert out[0]["rows"] == [["格", "x"], ["y", "z"]] and out[-1]["level"] == 2


def test_heading_goes_on_in_the_next_line(spark):
    rows = [(1, "很长的标题在这一行没有写完需要", 14.0, True, 50.0, 10.0, 500.0, 24.0), (1, "换行", 14.0, True, 50.0, 26.0, 80.0, 40.0), (1, "正文" * 30, 10.0, False, 50.0, 60.0, 500.0, 70.0), (1, "正文" * 30, 10.0, False, 50.0, 74.0, 500.0, 84.0)]
    none = spark.createDataFrame([], PAGE_TABLE)
    out = layout.page_blocks(lines_table(spark, rows), none).orderBy("block_idx").collect()
    assert out[0]["text"] == "很长的标题在这一行没有写完需要换行" and [r["kind"] for r in out] == ["heading", "para"]


def test_inside_tables_and_order_numbers(spark):
    df = lines_table(spark, [(1, "in", 9.0, False, 10.0, 10.0, 20.0, 20.0), (1, "out", 9.0, False, 10.0, 10.0, 200.0, 20.0), (1, "3、", 9.0, False, 0.0, 0.0, 1.0, 1.0)])
    tables = spark.createDataFrame([("d", 1, 0, 5.0, 5.0, 50.0, 50.0, [["a"]])], PAGE_TABLE)
    assert [r["text"] for r in layout.inside_tables(df, tables).collect()] == ["in"]
    assert {r["text"] for r in layout.without_order_numbers(df).collect()} == {"in", "out"}
