"""What the operators of this subpackage share: folds, words, Arrow passes and files in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from papyra.shared import filesystem, ship  # noqa: F401

#: A word: a run of anything but space and the characters 9 to 13. bytes.split() splits the same way.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null ids have fold -1, which is never held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts)), F.lit(-1).cast("long"))


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow`` with this package's code on the workers; what is to be sent is settled when the plan is made."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` (binary) holds about ``most`` bytes, and ``rows`` rows at most, in each; a longer row stands alone."""
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if i > start and (held + size > most or i - start >= rows):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        yield batch.slice(start, n - start)


def keep_rows(df: DataFrame, judge: Callable[[list[bytes | None]], list[bool]], most: int = 4 << 20) -> DataFrame:
    """The rows of ``df``, with all their columns, whatever their names, for whose ``text`` (UTF-8, or None) ``judge`` says True."""
    at = df.columns.index("text")
    numbered = df.toDF(*[f"c{k}" for k in range(len(df.columns))])

    def run(batches):
        for part in slices(batches, f"c{at}", most):
            yield part.filter(pa.array(judge(part.column(at).cast(pa.binary()).to_pylist()), pa.bool_()))

    return arrow_map(numbered, run, numbered.schema).toDF(*df.columns)


def deal(df: DataFrame, parts: int, number: str) -> DataFrame:
    """``df`` dealt to ``parts`` partitions by a column of whole numbers, n to partition n modulo ``parts``: neighbouring
    numbers never fall together by chance, as they may by hash."""
    return df.repartitionById(parts, F.pmod(F.col(number).cast("long"), F.lit(parts)).cast("int"))
