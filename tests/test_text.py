import pytest
from pyspark.sql import functions as F

from papyra.functions import text as T


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "t string").select(column(F.col("t")).alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("given", "want"),
    [("1998 年 7 月 3 日", "1998年 7月 3日"), ("水位 12 米 ，已退", "水位 12米，已退"), ("  河  堤  ", "河 堤"), ("a<!-- x\ny -->b", "a b"), ("a　b", "a b"), ("甲 ， 乙", "甲，乙"), ("", "")],
)
def test_normalise_space(spark, given, want):
    assert one(spark, T.normalise_space, given) == want


@pytest.mark.parametrize(
    ("given", "want"),
    [("1998年7月3日 06:05河口站听全文", True), ("第 8 页 / 共 64 页", True), ("730", True), ("图在第8页上面", True), ("开放：1998年7月3日06:05到7月9日18:00", False), ("正文", False), ("2026年4月13日 18:32" + "长" * 30 + "听全文", False)],
)
def test_noise(spark, given, want):
    assert one(spark, T.is_noise, given) is want


def test_sentences(spark):
    assert one(spark, T.sentences, "水退了。桥还在！谁守夜？") == ["水退了。", "桥还在！", "谁守夜？"]
    assert one(spark, T.sentences, "No stop. here\nnext；last") == ["No stop. here", "next；", "last"]
    assert one(spark, T.sentences, " \n ") == []


def test_tokens(spark):
    assert one(spark, T.tokens, "Ab-12 河堤é") == ["ab", "12", "河", "堤"]


@pytest.mark.parametrize(("parts", "want"), [(["河水", "退了"], "河水退了"), (["DAM", "two"], "DAM two"), (["河水", "dam"], "河水dam"), ([], "")])
def test_join_lines(spark, parts, want):
    df = spark.createDataFrame([(parts,)], "p array<string>")
    assert df.select(T.join_lines(F.col("p")).alias("x")).first()["x"] == want
