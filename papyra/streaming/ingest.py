"""New documents as a stream: each micro-batch is cut into blocks, cleaned, cut behind the tail marker, chunked and appended.

Chunking needs a document's blocks together and nothing else, so the stream keeps no state; a batch that is run again
replaces its own folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from papyra.operators.chunk import chunk_blocks
from papyra.operators.clean import TAIL_MARKER, clean_blocks, truncate_tail
from papyra.sources.html import html_blocks


def ingest_pages(spark: SparkSession, source: str, sink: str, checkpoint: str, schema: str = "page_id long, url string, html string", once: bool = True, marker: str = TAIL_MARKER) -> StreamingQuery:
    """Chunks of the pages (Parquet files under ``source``) under ``sink``, a folder for each batch."""
    stream = spark.readStream.schema(schema).parquet(source)

    def write(batch: DataFrame, number: int) -> None:
        chunks = chunk_blocks(truncate_tail(clean_blocks(html_blocks(batch)), marker), ids=False)
        chunks.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
