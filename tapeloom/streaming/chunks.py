"""Numbered chunks from a stream: numbers go on over batches and restarts, and no row is numbered twice.

Each micro-batch is one delivery. Its rows are numbered after all rows of earlier batches, cut into chunks of a
fixed size by that number, and written below a folder of the batch; then the batch's row count is put on record. A
batch that is run again, because the process ended between two of these steps, finds the same start, replaces its
own folder and record, and so gives the same chunks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapeloom.operators.timeline import Timeline
from tapeloom.session import staged
from tapeloom.sources.sinks import CHUNK_ROWS

RECORD = "batch long, first_row long, n_rows long"


def recorded(spark: SparkSession, records: str) -> DataFrame:
    """One row per finished batch: its number, its first row's number and its rows."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(records)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], RECORD)
    return spark.read.schema(RECORD).option("recursiveFileLookup", True).json(records)


def write_batch(
    batch: DataFrame,
    number: int,
    transform: Callable[[DataFrame], DataFrame],
    id_col: str,
    out: str,
    records: str,
    rows: int = CHUNK_ROWS,
) -> None:
    """Number, cut, write and record one batch; safe to repeat.

    Rows are in the order of ``id_col``, a whole number that is unique in its batch. ``transform`` keeps it. Only
    finished batches before this one count for the start, so a record that a broken run left for this batch does no harm.
    """
    spark = batch.sparkSession
    start = recorded(spark, records).where(F.col("batch") < number).agg(F.sum("n_rows")).first()[0] or 0
    delivery = staged(transform(batch), "delivery")
    placed = Timeline.by_id(delivery, (), id_col).annotate(position="_row").result()
    numbered = placed.select(
        *delivery.columns,
        (F.col("_row") + start).alias("row_no"),
        F.floor((F.col("_row") + start) / rows).alias("chunk_id"),
    )
    numbered.write.mode("overwrite").partitionBy("chunk_id").parquet(f"{out}/batch={number}")
    record = spark.createDataFrame([(number, start, delivery.count())], RECORD)
    record.coalesce(1).write.mode("overwrite").json(f"{records}/batch-{number}")


def ingest_chunks(
    stream: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    id_col: str,
    out: str,
    checkpoint: str,
    rows: int = CHUNK_ROWS,
) -> StreamingQuery:
    """Process all files not seen yet, batch by batch, then stop; a restart goes on with the next row number.

    Records lie in the checkpoint folder, beside Spark's own. ``read_chunks`` gives the chunks.
    """

    def write(batch: DataFrame, number: int) -> None:
        write_batch(batch, number, transform, id_col, out, f"{checkpoint}/chunk-records", rows)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_chunks(spark: SparkSession, out: str) -> DataFrame:
    """All rows with ``batch``, ``chunk_id`` and ``row_no``; a chunk that a batch left open goes on in the next one."""
    found = spark.read.parquet(out)
    numbers = {c: F.col(c).cast("long") for c in ("batch", "chunk_id")}
    part = F.concat(F.lit("part-"), F.lpad(F.col("chunk_id").cast("string"), 5, "0"))
    return found.withColumns(numbers).withColumn("part", part)
