"""Named queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Plan:
    build: Build
    sql: str | None


PLANS: dict[str, Plan] = {}


def plan(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a query under ``name``."""

    def add(build: Build) -> Build:
        if name in PLANS:
            raise ValueError(f"query {name} is registered twice")
        PLANS[name] = Plan(build, sql)
        return build

    return add


def r6(value: Column | str) -> Column:
    """Rounded to six places, so that both engines agree on the last bits."""
    return F.round(F.col(value) if isinstance(value, str) else value, 6)


def places(df: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """A vector column as one row per element: (keys, place, value)."""
    return df.select(*keys, F.posexplode(vector).alias("place", "value")).withColumn(
        "value", r6(F.col("value").cast("double"))
    )


def millionths(value: Column) -> Column:
    """A number as text, in millionths."""
    return F.round(value.cast("double") * 1_000_000).cast("long").cast("string")


def steps(values: Column) -> Column:
    """Numbers of an array as one text, in millionths, so that every element can be compared."""
    return F.array_join(F.transform(values, millionths), ",")
