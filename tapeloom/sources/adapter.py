"""The logical news and price tables, derived from the given tables.

Five order priorities stand for five symbols; documents stand for news.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tapeloom.functions.text import article_date
from tapeloom.session import staged

# The symbols that documents and vectors are dealt out to.
SYMBOLS = ["1-urgent", "2-high", "3-medium", "4-not specified", "5-low"]


_SCHEMAS: dict[tuple[str, str], StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its footer is read once per application."""
    path = f"{sf_dir}/{name}.parquet"
    known = (spark.sparkContext.applicationId, path)
    if known not in _SCHEMAS:
        _SCHEMAS[known] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[known]).parquet(path)


def texts(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table of long texts, spread over the cores if it comes in fewer splits.

    Large tables have more splits than cores and are left as they are.
    """
    df = table(spark, sf_dir, name)
    cores = spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


def symbol_of(id_col: str) -> Column:
    """Symbols in turn, independent of the day."""
    number = F.floor(F.col(id_col) / 50) % 5 + 1
    return F.element_at(F.array(*[F.lit(s) for s in SYMBOLS]), number.cast("int"))


def day_of(id_col: str) -> Column:
    """One of 50 days, 45 days apart, so that they span the price history."""
    return F.date_add(F.lit("1995-01-01").cast("date"), (F.col(id_col) % 50 * 45).cast("int"))


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per symbol; one row per (stock_symbol, date)."""
    orders = table(spark, sf_dir, "orders")
    return (
        orders.groupBy(
            F.lower("o_orderpriority").alias("stock_symbol"),
            F.col("o_orderdate").cast("date").alias("date"),
        )
        .agg(
            F.min_by("o_totalprice", "o_orderkey").alias("open"),
            F.max("o_totalprice").alias("high"),
            F.min("o_totalprice").alias("low"),
            F.max_by("o_totalprice", "o_orderkey").alias("close"),
            F.sum(F.col("o_orderkey") % 1000 + 1).cast("double").alias("volume"),
        )
        .withColumn("adj_close", F.col("close"))
    )


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily bars as a stored table, for work that reads them more than once."""
    return staged(prices(spark, sf_dir), "bars")


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw news with a text date that is sometimes not a date."""
    return news_from(table(spark, sf_dir, "documents"))


def news_from(documents: DataFrame) -> DataFrame:
    stamp = F.concat(day_of("doc_id").cast("string"), F.lit(" 00:00:00 UTC"))
    return documents.select(
        F.col("doc_id").alias("id"),
        F.when(F.col("doc_id") % 97 == 0, F.lit("unknown")).otherwise(stamp).alias("date"),
        F.col("text").alias("article_title"),
        symbol_of("doc_id").alias("stock_symbol"),
        F.col("source").alias("publisher"),
        F.col("text").alias("lsa_summary"),
    )


def dated_news(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """News whose date parses, with the date typed."""
    documents = texts(spark, sf_dir, "documents", "doc_id") if spread else table(spark, sf_dir, "documents")
    return (
        news_from(documents)
        .withColumn("date", article_date(F.col("date")))
        .where(F.col("date").isNotNull())
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings keyed by symbol and day."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        symbol_of("vec_id").alias("stock_symbol"),
        day_of("vec_id").alias("date"),
        "embedding",
        "label",
    )
