"""Writers: numbered chunks, CSV, Parquet and plain text tables, reusable results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.operators.joins import salted_join
from tapeloom.operators.timeline import Timeline
from tapeloom.sources.csv import CSV_OPTIONS

CHUNK_ROWS = 100_000
#: Rows of a file that one task must read as a whole.
WHOLE_FILE_ROWS = 1000


def with_chunks(df: DataFrame, id_col: str, rows: int = CHUNK_ROWS) -> DataFrame:
    """Chunk number and part name by absolute row number.

    Numbers depend on the whole table only, so no start row can make a later
    run write over an earlier part.
    """
    indexed = Timeline.by_id(df, (), id_col).annotate(position="_row").result()
    chunk = F.floor(F.col("_row") / rows)
    return indexed.select(
        *df.columns,
        chunk.alias("chunk_id"),
        F.concat(F.lit("part-"), F.lpad(chunk.cast("string"), 5, "0")).alias("part"),
    )


def write_chunks(df: DataFrame, id_col: str, path: str, rows: int = CHUNK_ROWS) -> None:
    """One folder per chunk of CSV files with a header."""
    chunks = with_chunks(df, id_col, rows)
    spread = chunks.repartition("chunk_id").sortWithinPartitions("chunk_id", id_col)
    writer = spread.drop("part").write.partitionBy("chunk_id").options(**CSV_OPTIONS)
    writer.option("header", True).option("quoteAll", True).option("emptyValue", "").csv(path)


def write_csv(df: DataFrame, path: str, quote_all: bool = True, rows: int | None = None) -> None:
    """CSV with a header; every text quoted, or only where it must be.

    Files have at most ``rows`` rows, if that is given: one that holds line breaks is later read by one task.
    """
    writer = df.write.options(**CSV_OPTIONS).option("header", True).option("quoteAll", quote_all)
    (writer.option("maxRecordsPerFile", rows) if rows else writer).csv(path)


def write_symbol_files(df: DataFrame, folder: str, symbol: str = "stock_symbol", rows: int = 1_000_000) -> None:
    """CSV files whose path carries the key: one folder per symbol, files of at most ``rows`` rows in it.

    One write for any number of symbols. Symbols are dealt over the tasks with a part number, so that a symbol
    with a large share of the rows is written by many tasks and a small one ends up in few files.
    """
    counted = df.groupBy(symbol).agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("_parts"))
    part = F.pmod(F.xxhash64(*[c for c in df.columns if c != symbol]), F.col("_parts"))
    dealt = salted_join(df, counted, [symbol], "inner", F.xxhash64(*df.columns)).withColumn("_part", part)
    dealt = dealt.repartition(symbol, "_part").drop("_part", "_parts")
    writer = dealt.write.partitionBy(symbol).options(**CSV_OPTIONS).option("header", True)
    writer.option("maxRecordsPerFile", rows).csv(folder)


def create_parquet(df: DataFrame, path: str, if_not_exists: bool = False) -> DataFrame:
    """Store a query result; an existing one is an error or is kept."""
    df.write.mode("ignore" if if_not_exists else "errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def create_text(df: DataFrame, path: str) -> None:
    """Comma-separated text without a header."""
    df.write.options(**CSV_OPTIONS).option("header", False).csv(path)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a finished result lies at ``path``, on any file system Spark knows."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def materialize(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The stored result if it is complete, else build, store and read it back."""
    if not is_complete(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
