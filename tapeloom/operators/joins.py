"""Equi-joins that hold when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def salt_count(df: DataFrame) -> int:
    """Parts that a hot key is spread over: a quarter of the shuffle partitions."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)


def salted_join(
    rows: DataFrame, keyed: DataFrame, on: Sequence[str], how: str, spread: Column, salts: int | None = None
) -> DataFrame:
    """Join many rows per key to a table with one row per key.

    ``spread`` is any value that differs inside a hot key. Each key of the
    ``keyed`` side is copied ``salts`` times, so a hot key is shared by as many
    tasks. Spark still broadcasts ``keyed`` by itself when it is small.
    """
    salts = salts or salt_count(rows)
    left = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    right = keyed.withColumn("_salt", copies)
    return left.join(right, [*on, "_salt"], how).drop("_salt")


#: Keys that are sent to all rows; with more of them only those of many rows are.
FEW_KEYS = 500_000


def frequent_apart(rows: DataFrame, keyed: DataFrame, on: Sequence[str], weight: str, hot: int = 1_000_000) -> DataFrame:
    """Inner join of many rows to a stored table with one row per key, of which some own a large share of the rows.

    ``weight`` names a column that tells about how many rows a key owns. A small table goes to all rows. Of a large
    one only the heaviest keys do, as many as are still few, and those of at least ``hot`` rows; the others, which
    own few rows each, meet by a shuffle, uncopied. ``rows`` are never broadcast, however small Spark takes them to be.
    """
    if keyed.count() <= FEW_KEYS:
        return rows.join(F.broadcast(keyed), list(on))
    least = min(hot, heaviest(keyed, weight))
    heavy = keyed.where(F.col(weight) >= least)
    heavy = F.broadcast(heavy) if heavy.count() <= FEW_KEYS else heavy
    others = rows.join(heavy.select(*on), list(on), "left_anti").hint("merge").join(keyed.where(F.col(weight) < least), list(on))
    apart = rows.join(heavy, list(on))
    return apart.unionByName(others.select(*apart.columns))


#: Narrow rows, of a key and a number, that are sent to all rows.
FEW_NARROW = 2_000_000


def keyed_join(rows: DataFrame, narrow: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join of rows with long cells to a stored narrow table: long cells travel only if the table is large.

    Even then they are not sorted, as the narrow side is hashed.
    """
    few = narrow.count() <= FEW_NARROW
    return rows.join(F.broadcast(narrow) if few else narrow.hint("shuffle_hash"), list(on))


def heaviest(keyed: DataFrame, weight: str) -> int:
    """The smallest power of two that at most ``FEW_KEYS`` keys have as their weight or more."""
    counts = keyed.where(F.col(weight) >= 1).groupBy(F.floor(F.log2(weight)).alias("power")).count().collect()
    least, keys = 64, 0
    for power, n in sorted(counts, reverse=True):
        keys += n
        if keys > FEW_KEYS:
            break
        least = power
    return 2 ** int(least)


def key_intersection(
    rows: DataFrame, keyed: DataFrame, on: Sequence[str], spread: Column
) -> tuple[DataFrame, DataFrame]:
    """Both tables cut down to the keys that occur in both."""
    keys = keyed.select(*on).distinct()
    row_keys = rows.select(*on).distinct()
    return salted_join(rows, keys, on, "left_semi", spread), keyed.join(row_keys, list(on), "left_semi")


def intersection_report(
    rows: DataFrame, keyed: DataFrame, on: Sequence[str], spread: Column
) -> DataFrame:
    """Rows of both tables, and how many of them have a common key."""
    hit = F.lit(1).alias("_hit")
    found = salted_join(rows, keyed.select(*on).distinct().select("*", hit), on, "left", spread)
    matched = keyed.join(rows.select(*on).distinct().select("*", hit), list(on), "left")

    def counts(df: DataFrame, side: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count("_hit").alias("n_kept")).select(
            F.lit(side).alias("side"), "*"
        )

    return counts(found, "rows").unionByName(counts(matched, "keyed"))


def intersect_keys(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    return a.select(*on).intersect(b.select(*on))


def left_features(prices: DataFrame, daily: DataFrame, on: Sequence[str]) -> DataFrame:
    """All price rows with the day's features where there are some."""
    return prices.join(daily, list(on), "left")


def inner_features(prices: DataFrame, daily: DataFrame, on: Sequence[str]) -> DataFrame:
    return prices.join(daily, list(on))
