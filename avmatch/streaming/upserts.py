"""Structured Streaming form of the upserts: each micro-batch goes through the same merge as a batch load."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from avmatch.operators.merge import merge_latest
from avmatch.sources.keyed import KeyedTable
from avmatch.sources.tables import VersionedTable


def file_stream(spark: SparkSession, path: str, schema: str, kind: str = "parquet", files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(kind).load(path)


def start_upserts(stream: DataFrame, table: VersionedTable, schema: str, keys: Sequence[str], order: Sequence[str], checkpoint: str, fill: Sequence[str] = (), newer: str | None = None) -> StreamingQuery:
    """Merge the stream into the table until it has read all that is there. A batch that is run again after a failure
    merges the same rows once more, which changes nothing."""

    def apply(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            merged = merge_latest(table.read(schema), batch, keys, order, fill, newer)
            table.write(merged.drop("action"))

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def start_keyed_upserts(stream: DataFrame, table: KeyedTable, name: str, order: Sequence[str], checkpoint: str, fill: Sequence[str] = (), newer: str | None = None, shape: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> StreamingQuery:
    """Merge the stream, batch by batch, into the parts of the table that its keys fall into, until it has read all that is
    there. shape: what makes the table's rows of a batch. The table remembers the last batch of the stream `name`, so one
    that is run again after a failure is not merged twice."""

    def apply(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            table.upsert(shape(batch), order, fill, newer, mark={name: number})

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def page_stream(spark: SparkSession, folder: str, pattern: str = "*.html", files_per_batch: int = 1000) -> DataFrame:
    """(page_id, file_name, html, changed) of saved pages below a folder. The stream's checkpoint is the ledger of pages that
    were read: each is read once, however often the stream is started."""
    raw = spark.readStream.schema("path string, modificationTime timestamp, length long, content binary").format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_batch).load(folder)
    return raw.select(F.col("path").alias("page_id"), F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("content").cast("string").alias("html"), F.col("modificationTime").alias("changed"))
