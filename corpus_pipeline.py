"""From raw documents to token digests, stage by stage; each stage's rows are stored before the next."""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tapeloom.llm import decontaminate, line_dedup, near_dedup, quality, queries  # noqa: E402
from tapeloom.llm.runtime import documents, stored  # noqa: E402

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and the documents that fail or lose too much.

    Each row is judged on its own, so repeated rows and rows without an id stay or go as their text does. A null,
    empty or blank text has fewer than 20 words and goes. An empty table stays one; other columns are kept.
    """
    return quality.clean(docs)


def frequent_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of three or more documents stay in one of them.

    Rows of one id are one document, rows without an id one for each different text. Every row stays, a null text as
    an empty one; other columns are kept.
    """
    return line_dedup.clean(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity 0.8.

    Rows of one id stay or go together. Rows without an id and texts without a word are like no other and stay.
    """
    return near_dedup.keep_one(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go.

    Rows of one id go together, and so do all rows without an id if one of them holds a passage. Null and empty texts
    hold none; without a benchmark all stay.
    """
    return decontaminate.remove(docs, documents(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token numbers and digests of the documents that are left: one row for each row, a null text as an empty one."""
    return queries.encoded(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", frequent_lines),
    ("near_dedup", near_copies),
    ("decontaminate", benchmark_passages),
    ("encode", encode),
]

#: The last stage's digests of byte-pair ids cannot be written in SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
