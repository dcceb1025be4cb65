"""Host links that arrive while a crawl runs.

A stream of page files becomes a growing set of distinct host links: each micro-batch is extracted and
added to a ``LinkStore`` under its number, so a batch that is run again changes nothing, and only buckets that get
new links are written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from linkframe.plans.crawls import LinkStore
from linkframe.sources.hostlinks import extract_links


def stream_links(spark: SparkSession, pages_path: str, schema, out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Starts the stream; with ``available_now`` it ends once all files have been read."""

    def add(batch: DataFrame, number: int) -> None:
        LinkStore(batch.sparkSession, out).add(f"batch-{number}", extract_links(batch))

    writer = spark.readStream.schema(schema).parquet(pages_path).writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()


def read_stream_links(spark: SparkSession, out: str) -> DataFrame:
    return LinkStore(spark, out).links()
