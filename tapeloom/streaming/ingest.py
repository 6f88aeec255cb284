"""Incremental ingest: the batch cleaning steps over a file stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def file_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    fmt: str = "csv",
    pattern: str | None = None,
    files_per_batch: int | None = 16,
    **options: str,
) -> DataFrame:
    """A stream of the files in ``folder`` as they arrive; with ``files_per_batch=None`` all new ones are one batch."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.options(**options).format(fmt).load(folder)


def table_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A stream of a stored table, which is a folder of files or one file."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory():
        return file_stream(spark, path, schema, fmt)
    return file_stream(spark, place.getParent().toString(), schema, fmt, pattern=place.getName())


def ingest(
    stream: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str
) -> StreamingQuery:
    """Process all files not seen yet, once each, then stop.

    A restart with the same checkpoint goes on after the last finished batch.
    """
    return (
        transform(stream)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
