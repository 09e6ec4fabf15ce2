"""Web pages as blocks (M2), by expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyra.functions.text import let
from papyra.operators.layout import normalise_table

# Block-level elements, and the named character references that are decoded; the ampersand comes last.
TAGS = "h[1-6]|p|li|div|nav|ul|article|footer|body"
REFERENCES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&copy;": "©", "&middot;": "·", "&amp;": "&"}
_CODE = r"^([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"


def numeric_references(text: Column) -> Column:
    """&#233; and &#xE9; as their character; numbers that stand for none stay as they are."""

    def char(piece: Column) -> Column:
        code = F.regexp_extract(piece, _CODE, 1)
        hexed = F.when(code.rlike("^[xX]"), F.lower(F.substring(code, 2, 10))).otherwise(F.lower(F.conv(code, 10, 16)))
        number = F.conv(hexed, 16, 10).cast("long")
        valid = (code != "") & number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        decoded = F.decode(F.unhex(F.lpad(hexed, 8, "0")), "UTF-32")
        return F.when(valid, F.concat(decoded, F.regexp_replace(piece, _CODE, ""))).otherwise(F.concat(F.lit("&#"), piece))

    rest = lambda p: F.transform(F.slice(p, F.lit(2), F.greatest(F.size(p) - 1, F.lit(0))), char)
    decoded = lambda t: let(F.split(t, "&#", -1), lambda p: F.concat(p[0], F.array_join(rest(p), "")))
    return let(text, lambda t: F.when(F.contains(t, F.lit("&#")), decoded(t)).otherwise(t))


def plain(fragment: Column) -> Column:
    text = F.regexp_replace(fragment, r"<[^>]*>", " ")
    for name, char in REFERENCES.items():
        if name == "&amp;":
            text = numeric_references(text)
        text = F.replace(text, F.lit(name), F.lit(char))
    return F.trim(F.regexp_replace(text, r"[ \t\r\n]+", " "))


def _mark_tables(body: Column) -> Column:
    """Each table element as one piece, its rows and cells set apart by control characters, block markup inside its cells taken out."""

    def table(piece: Column) -> Column:
        end = F.regexp_instr(piece, F.lit(r"(?i)</table\b"))
        inner = F.when(end > 0, F.substring(piece, F.lit(1), end - 1)).otherwise(piece)
        rest = F.when(end > 0, F.regexp_replace(F.substring(piece, end, F.length(piece)), r"(?i)^</table\b[^>]*>", "")).otherwise(F.lit(""))
        inner = F.regexp_replace(inner, rf"(?i)</?({TAGS})\b[^>]*>", " ")
        inner = F.regexp_replace(F.regexp_replace(inner, r"(?i)<tr\b[^>]*>", "\x03"), r"(?i)<t[dh]\b[^>]*>", "\x04")
        return F.concat(F.lit("\x01table\x02"), inner, F.lit("\x01/table\x02"), rest)

    after = lambda p: F.transform(F.slice(p, F.lit(2), F.greatest(F.size(p) - 1, F.lit(0))), table)
    split = let(F.split(body, r"(?i)<table\b[^>]*>", -1), lambda p: F.concat(p[0], F.array_join(after(p), "")))
    return F.when(body.rlike(r"(?i)<table\b"), split).otherwise(body)


def _table_rows(piece: Column) -> Column:
    cells = lambda r: F.transform(F.slice(r, F.lit(2), F.greatest(F.size(r) - 1, F.lit(0))), plain)
    return normalise_table(F.transform(F.split(piece, "\x03"), lambda r: cells(F.split(r, "\x04", -1))))


def html_blocks(pages: DataFrame) -> DataFrame:
    """Blocks of pages (page_id, html): headings with their level, tables with their rows, everything else as paragraphs, empty
    pieces left out."""
    body = F.regexp_replace(F.coalesce("html", F.lit("")), r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<title\b.*?</title\s*>|[\x01-\x04]", " ")
    body = F.regexp_replace(F.regexp_replace(body, r"(?s)<!--.*?-->", " "), r"(?i)<br\b[^>]*>", " ")
    marked = F.regexp_replace(let(body, _mark_tables), rf"(?i)<(/?)({TAGS})\b[^>]*>", "\x01$1$2\x02")
    tag = lambda p: F.when(F.contains(p, F.lit("\x02")), F.lower(F.substring_index(p, "\x02", 1))).otherwise(F.lit(""))
    none = F.array().cast("array<array<string>>")

    def piece(p: Column, i: Column) -> Column:
        table = tag(p) == "table"
        text = F.when(table, F.lit("")).otherwise(plain(F.substring_index(p, "\x02", -1)))
        return F.struct(i.alias("block_idx"), tag(p).alias("tag"), text.alias("text"), F.when(table, _table_rows(F.substring_index(p, "\x02", -1))).otherwise(none).alias("rows"))

    cut = F.transform(F.split(marked, "\x01"), piece)
    pieces = pages.select(F.col("page_id").cast("string").alias("doc"), F.explode(F.filter(cut, lambda p: (p["text"] != "") | (F.size(p["rows"]) > 0))).alias("p"))
    heading = F.col("p.tag").rlike("^h[1-6]$")
    return pieces.select(
        "doc", "p.block_idx", F.when(heading, "heading").when(F.col("p.tag") == "table", "table").otherwise("para").alias("kind"), "p.text",
        F.when(heading, F.substring("p.tag", 2, 1).cast("int")).otherwise(F.lit(1)).alias("level"), "p.rows", F.lit(1).alias("page"),
    )
