"""Delimited text in: every column a string, mapped by position, header skipped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column order of the two raw file kinds.
NEWS_COLUMNS = ["date", "article_title", "stock_symbol", "url", "publisher"]
NEWS_WIDE_COLUMNS = [
    "date",
    "article_title",
    "stock_symbol",
    "url",
    "publisher",
    "author",
    "article",
    "lsa_summary",
    "luhn_summary",
    "textrank_summary",
    "lexrank_summary",
]
PRICE_FILE_COLUMNS = ["date", "volume", "open", "high", "low", "close", "adj_close"]


#: One set of options for all writers and readers: what is written is read back unchanged.
CSV_OPTIONS = {
    "quote": '"',
    "escape": "\\",
    "charToEscapeQuoteEscaping": "\\",
    "lineSep": "\n",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_strings(
    spark: SparkSession, path: str, columns: Sequence[str], header: bool = True, multi_line: bool = False
) -> DataFrame:
    """``multi_line`` for texts that may hold line breaks: each file is then read by one task."""
    return (
        spark.read.schema(string_schema(columns))
        .option("header", header)
        .option("enforceSchema", True)
        .options(**CSV_OPTIONS, multiLine=multi_line)
        .csv(path)
    )


def read_news_csv(spark: SparkSession, path: str, wide: bool = False, multi_line: bool = False) -> DataFrame:
    return read_strings(spark, path, NEWS_WIDE_COLUMNS if wide else NEWS_COLUMNS, multi_line=multi_line)


def symbol_from_path(path: Column) -> Column:
    """The lower-case file name before ``.csv``."""
    return F.regexp_extract(F.lower(path), r"([^/]+)(?=\.csv$)", 1)


def symbol_of_file(path: Column) -> Column:
    """The symbol that a price file's path carries: a folder ``stock_symbol=...``, else the file's name."""
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    folder = F.regexp_extract(F.lower(plain), r".*/stock_symbol=([^/]*)/[^/]*$", 1)
    named = F.when(folder != "__hive_default_partition__", F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B"))))
    return F.when(folder != "", named).otherwise(symbol_from_path(plain))


def read_prices_csv(spark: SparkSession, path: str) -> DataFrame:
    """Price files below a folder; the symbol comes from their paths, and there may be many files of one symbol."""
    raw = (
        spark.read.schema(string_schema(PRICE_FILE_COLUMNS))
        .options(**CSV_OPTIONS, header=True, enforceSchema=True, recursiveFileLookup=True)
        .csv(path)
    )
    origin = F.col("_metadata.file_path")
    return raw.select(
        F.lower(origin).alias("path"),
        symbol_of_file(origin).alias("stock_symbol"),
        "date",
        "open",
        "high",
        "low",
        "close",
        "adj_close",
        "volume",
    )
