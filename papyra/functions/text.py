"""Text expressions: Column in, Column out, all inside the JVM."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and limits of the corpus format.
CJK = r"一-鿿"
SENTENCE = r"[^。！？；;!?\n]*[。！？；;!?\n]+|[^。！？；;!?\n]+\z"
TOKEN = r"[a-z0-9]+|[一-鿿]"
PAGE_NUMBER = r"(?U)第\s*\d+\s*页|^\s*\d+\s*$"
META_DATE = r"(?U)\d{4}\s*年\s*\d{1,2}\s*月\s*\d{1,2}\s*日\s+\d{1,2}:\d{2}"
META_TAIL = r"(?U)(听全文|\d+\s*人)$"
META_MAX = 35
ORDER_NUMBER = r"(?U)^\d{1,3}[.、．]?$"
CITATION = r"\[(chunk_\d{6})\]"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.transform(F.array(value), body)[0]


def strip(text: Column) -> Column:
    """Without white space at both ends; any Unicode white space."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def normalise_space(text: Column) -> Column:
    """Comments to a space, wide spaces to plain ones, no space between a Latin letter or digit and a following
    ideograph or around wide punctuation, runs of blanks to one, none at the ends."""
    text = F.regexp_replace(text, r"(?s)<!--.*?-->", " ")
    text = F.replace(text, F.lit("　"), F.lit(" "))
    text = F.regexp_replace(text, rf"(?U)(?<=[0-9A-Za-z])\s+(?=[{CJK}])", "")
    text = F.regexp_replace(text, r"(?U)\s*([，。、；：？！])\s*", "$1")
    return strip(F.regexp_replace(text, r"[ \t]+", " "))


def is_noise(text: Column) -> Column:
    """Page numbers anywhere in the text, and short lines of date, time and a reading-tool tail."""
    meta = (F.length(text) <= META_MAX) & text.rlike(META_DATE) & text.rlike(META_TAIL)
    return text.rlike(PAGE_NUMBER) | meta


def sentences(text: Column) -> Column:
    """Pieces up to and including their closing marks, stripped; an ASCII full stop closes nothing."""
    return F.filter(F.transform(F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(0)), strip), lambda s: s != "")


def tokens(text: Column, segment=None) -> Column:
    """Lower-case runs of a-z and 0-9, and single ideographs; with ``segment``, a function from a lower-case text to a list of
    words, those of its words that aren't blank (in Arrow batches)."""
    if segment is None:
        return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))
    @F.pandas_udf("array<string>")
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [w for w in segment(t or "") if w.strip()])

    return cut(F.lower(text))


def is_ascii_edge(text: Column, last: bool) -> Column:
    edge = F.substring(text, -1, 1) if last else F.substring(text, 1, 1)
    return (text != "") & (F.ascii(edge) < 128)


def join_lines(parts: Column) -> Column:
    """Parts in a row, with a space where an ASCII character meets another."""
    glue = lambda s, t: F.when((s != "") & is_ascii_edge(s, True) & is_ascii_edge(t, False), F.lit(" ")).otherwise(F.lit(""))
    return F.aggregate(parts, F.lit(""), lambda s, t: F.concat(s, glue(s, t), t))


def half_even(value: Column, places: int) -> Column:
    return F.bround(value, places)
