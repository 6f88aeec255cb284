"""Named tables, embedding tables, row slices and generated pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.operators.timeline import Timeline


def read_table(
    spark: SparkSession, name: str, columns: Sequence[str] | None = None, where: str | None = None
) -> DataFrame:
    """A catalog table, a temporary view or a Parquet path."""
    df = spark.read.parquet(name) if "/" in name else spark.table(name)
    if where:
        df = df.where(where)
    return df.select(*columns) if columns else df


def run_sql(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """A SQL text over catalog tables and the frames given by name as ``{name}``."""
    return spark.sql(text, **tables)


def save_embeddings(df: DataFrame, path: str, keys: Sequence[str], vector: str = "embedding") -> None:
    df.select(*keys, F.col(vector).cast("array<float>").alias(vector)).write.parquet(path)


def load_embeddings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def numbered(df: DataFrame, id_col: str, position: str = "row_idx") -> Timeline:
    """0-based row numbers of the whole table in the order of a unique id."""
    return Timeline.by_id(df, (), id_col).annotate(position=position, total="_total")


def slice_rows(df: DataFrame, id_col: str, start: int, end: int = -1) -> DataFrame:
    """Rows ``start`` (included) to ``end`` (excluded); -1 means to the last one."""
    if start < 0 or (end != -1 and end < start):
        raise ValueError(f"no such row range: {start}..{end}")
    kept = F.col("row_idx") >= start
    if end != -1:
        kept = kept & (F.col("row_idx") < end)
    return numbered(df, id_col).result().where(kept).drop("_total")


def head_percent(df: DataFrame, id_col: str, percent: float) -> DataFrame:
    """The first ``int(n·percent/100)`` rows."""
    if not 0 < percent <= 100:
        raise ValueError(f"percent must be in (0, 100], not {percent}")
    limit = F.floor(F.col("_total") * F.lit(float(percent)) / 100.0)
    return numbered(df, id_col).result().where(F.col("row_idx") < limit).drop("_total")


def take_head(df: DataFrame, order: Sequence[str], k: int = 100) -> DataFrame:
    return df.orderBy(*order).limit(k)


def synthetic_pairs(numbers: DataFrame, n: str, anchor_date: str) -> DataFrame:
    """Fake labelled pairs, one for every number in column ``n``."""

    def text(a: int, b: int):
        left = F.concat(F.lit("Text"), (F.col(n) + a).cast("string"))
        return F.concat(left, F.lit("+"), (F.col(n) + b).cast("string"))

    anchor = F.lit(anchor_date).cast("date")
    return numbers.select(
        text(0, 100).alias("concatarticles1"),
        text(200, 300).alias("concatarticles2"),
        (F.col(n) % 2).cast("string").alias("samebucket"),
        F.date_sub(anchor, F.col(n).cast("int")).cast("string").alias("date1"),
        F.date_sub(anchor, (F.col(n) + 1).cast("int")).cast("string").alias("date2"),
    )


def number_sequence(spark: SparkSession, n: int) -> DataFrame:
    """1..n as a distributed range."""
    return spark.range(1, n + 1).withColumnRenamed("id", "n")


def explode_sequence(df: DataFrame, start: str, stop: str, out: str = "n") -> DataFrame:
    """Each row once per number of its own range."""
    return df.withColumn(out, F.explode(F.sequence(F.col(start), F.col(stop))))
