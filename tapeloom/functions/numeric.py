"""Number and column helpers: strict and lenient casts, guarded ratios, fills."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The numeric columns of a price bar, in logical order.
PRICE_COLUMNS = ["open", "high", "low", "close", "adj_close", "volume"]


def cast_prices(df: DataFrame) -> DataFrame:
    """Text to DATE and DOUBLE; a bad value fails the job (ANSI casts)."""
    return df.select(
        "stock_symbol",
        F.col("date").cast("date").alias("date"),
        *[F.col(c).cast("double").alias(c) for c in PRICE_COLUMNS],
    )


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text to DOUBLE where it is a number, null where it is not."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns})


def enforce_schema(df: DataFrame, columns: Sequence[str], drop: Sequence[str] = ("Unnamed: 0",)) -> DataFrame:
    """Drop index leftovers and cast the listed columns that are present to string."""
    kept = df.drop(*drop)
    listed = set(columns)
    return kept.select(
        *[F.col(f"`{c}`").cast("string").alias(c) if c in listed else F.col(f"`{c}`") for c in kept.columns]
    )


def normalize_symbol(symbol: Column, upper: bool = False) -> Column:
    return F.upper(F.trim(symbol)) if upper else F.lower(F.trim(symbol))


def prefix_columns(df: DataFrame, keys: Sequence[str], prefix: str = "emb_") -> DataFrame:
    """Prefix every non-key column that does not carry the prefix yet."""
    return df.select(
        *[c if c in keys or c.startswith(prefix) else F.col(f"`{c}`").alias(prefix + c) for c in df.columns]
    )


def downcast_float32(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("float") for c in columns})


def guarded_pct(change: Column, base: Column) -> Column:
    """change·100/base; null where base is zero."""
    return change * 100.0 / F.nullif(base, F.lit(0.0))


def guarded_ratio(change: Column, base: Column) -> Column:
    return change / F.nullif(base, F.lit(0.0))


def finite(value: Column) -> Column:
    """NaN and infinities become null."""
    bad = F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    return F.when(~bad, value)


def same_bucket(a: Column, b: Column) -> Column:
    """1 when equal, 0 otherwise; null counts as different."""
    return F.when(a == b, 1).otherwise(0)


def bucket_distance_class(a: Column, b: Column) -> Column:
    """0 near (at most 1 apart), 1 medium (2-3), 2 far."""
    gap = F.abs(a - b)
    return F.when(gap <= 1, 0).when(gap.between(2, 3), 1).otherwise(2)


def tercile_bin(value: Column, low: Column, high: Column) -> Column:
    """0 below ``low``, 2 above ``high``, 1 between (borders included)."""
    return F.when(value < low, 0).when(value > high, 2).otherwise(1)
