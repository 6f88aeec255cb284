"""Scaling, binning, outliers and token packing."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.functions.keys import random_key
from tapeloom.functions.numeric import tercile_bin
from tapeloom.functions.text import leading_tokens, pieces
from tapeloom.operators.series import scale
from tapeloom.operators.stats import limits
from tapeloom.session import staged


def minmax_pooled(df: DataFrame, columns: Sequence[str], fit_on: str = "train") -> DataFrame:
    """One min-max scaler over all symbols, fitted on ``split = 'train'`` or on all rows."""
    fitted = df.where(F.col("split") == "train") if fit_on == "train" else df
    ranges = [F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in columns]
    fit = fitted.agg(*ranges).first()
    return df.withColumns(
        {f"{c}_scaled": scale(F.col(c), F.lit(fit[c]["lo"]), F.lit(fit[c]["hi"])) for c in columns}
    )


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / population deviation over all rows; a zero deviation divides by one."""
    stats = [F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns]
    fit = df.agg(*stats).first()
    return df.withColumns(
        {f"{c}_std": (F.col(c) - F.lit(fit[c]["m"])) / F.lit(fit[c]["s"] or 1.0) for c in columns}
    )


def standardize_label(df: DataFrame, column: str, eps: float = 1e-8) -> DataFrame:
    """(y - mean) / (population deviation + eps)."""
    fit = df.agg(F.avg(column).alias("m"), F.stddev_pop(column).alias("s")).first()
    centred = F.col(column) - F.lit(fit["m"])
    return df.withColumn(f"{column}_std", centred / (F.lit(fit["s"]) + F.lit(eps)))


def tercile_bins(
    df: DataFrame, value: str, low: float = 0.25, high: float = 0.75, out: str = "bin"
) -> DataFrame:
    """0 below the low quantile, 2 above the high one, 1 between."""
    return df.withColumn(out, tercile_bin(F.col(value), *limits(df, value, low, high)))


def median_bins(df: DataFrame, value: str, out: str = "bin") -> DataFrame:
    """0 up to the median, 1 above it."""
    middle, _ = limits(df, value, 0.5, 0.5)
    return df.withColumn(out, F.when(F.col(value) <= middle, 0).otherwise(1))


# -- outliers ------------------------------------------------------------------
#: Path lengths are whole numbers of this unit, so that their sums are exact.
PATH_UNIT = 1_000_000


def path_adjustment(n: int) -> int:
    """Mean path length of an unsuccessful search among ``n`` values, in units."""
    if n <= 1:
        return 0
    return round((2.0 * (np.log(n - 1) + np.euler_gamma) - 2.0 * (n - 1) / n) * PATH_UNIT)


def grown(tree: int, values: np.ndarray, depth_limit: int, seed: int) -> list[tuple[float, float, int]]:
    """(low, high, path length) of the leaves of one tree over a sample; a leaf holds low < x <= high.

    The cut of a node lies at a share of its range that a digest of tree, node and seed draws. The root is node 1,
    the children of node k are 2k (up to the cut) and 2k + 1.
    """
    leaves = []
    todo = [(np.sort(values), -np.inf, np.inf, 0, 1)]
    while todo:
        part, low, high, depth, node = todo.pop()
        if depth >= depth_limit or len(part) <= 1 or part[0] == part[-1]:
            leaves.append((low, high, depth * PATH_UNIT + path_adjustment(len(part))))
            continue
        share = int(hashlib.md5(f"{tree}:{node}:{seed}".encode()).hexdigest()[:8], 16) / 2**32
        cut = float(part[0] + (part[-1] - part[0]) * share)
        at = int(np.searchsorted(part, cut, side="right"))
        todo.append((part[:at], low, cut, depth + 1, 2 * node))
        todo.append((part[at:], cut, high, depth + 1, 2 * node + 1))
    return leaves


def isolation_trees(sample: DataFrame, trees: int, seed: int, max_samples: int) -> DataFrame:
    """(tree, low, high, path): the leaves of all trees, each grown in a task of its own.

    ``sample`` has ``rank`` (from 0) and ``v``. Tree t takes ``max_samples`` ranks in a row, from t shares of the
    sample on, and goes on at its start; so trees share values only if there are too few.
    """
    n = sample.count()
    size, stride = min(max_samples, n), max(1, n // trees)
    depth_limit = int(np.ceil(np.log2(max(size, 2))))
    tree = F.floor(F.col("id") / size)
    drawn = sample.sparkSession.range(trees * size).select(
        tree.alias("tree"), ((tree * stride + F.col("id") % size) % n).alias("rank")
    )

    def grow(table: pa.Table) -> pa.Table:
        number = table.column("tree")[0].as_py()
        leaves = grown(number, table.column("v").to_numpy(), depth_limit, seed)
        columns = [pa.array([number] * len(leaves), pa.int64())]
        columns += [pa.array([leaf[k] for leaf in leaves], kind) for k, kind in enumerate((pa.float64(), pa.float64(), pa.int64()))]
        return pa.table(columns, ["tree", "low", "high", "path"])

    joined = drawn.join(sample, "rank").select("tree", "v")
    return joined.groupBy("tree").applyInArrow(grow, "tree long, low double, high double, path long")


def isolation_steps(leaves: Sequence[tuple[float, float, int]]) -> tuple[np.ndarray, np.ndarray]:
    """A forest over one variable as a step function: (borders, sum of the path lengths per interval)."""
    starts, ends = (np.array([leaf[k] for leaf in leaves]) for k in (0, 1))
    paths = np.array([leaf[2] for leaf in leaves], dtype=np.int64)
    borders = np.unique(ends[np.isfinite(ends)])
    change = np.zeros(len(borders) + 1, dtype=np.int64)
    np.add.at(change, np.where(np.isinf(starts), 0, np.searchsorted(borders, starts) + 1), paths)
    inner = np.isfinite(ends)
    np.subtract.at(change, np.searchsorted(borders, ends[inner]) + 1, paths[inner])
    return borders, np.cumsum(change)


def short_paths(paths: np.ndarray, counts: np.ndarray, share: float) -> np.ndarray:
    """Which intervals score above the ``1 - share`` quantile of all rows' scores.

    A score falls as the path grows, so the quantile lies between the paths at two ranks; between two different
    ones it excludes the longer path.
    """
    order = np.argsort(-paths, kind="stable")
    upto = np.cumsum(counts[order])
    place = (upto[-1] - 1) * (1.0 - share)
    low, high = (paths[order][np.searchsorted(upto, p, side="right")] for p in (np.floor(place), np.ceil(place)))
    return paths <= high if low != high else paths < low


def outlier_flag(
    df: DataFrame,
    value: str,
    key: Sequence[str],
    contamination: float = 0.05,
    trees: int = 100,
    seed: int = 42,
    max_samples: int = 256,
) -> DataFrame:
    """``is_outlier``: -1 for the ``contamination`` share hardest to keep apart, else 1; null for nulls.

    The forest is grown on ``max_samples`` values per tree, the values of the smallest digests of all rows; this
    bound is part of the method. The score is a step function of the value with at most
    ``max_samples * trees`` steps: rows are counted per step once, which gives the score limit
    and with it the ranges of values that are flagged, so the flag is one comparison.
    """
    known = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    digests = known.select(random_key(*key, seed=seed).alias("k"), F.col(value).cast("double").alias("v"))
    drawn = staged(digests.orderBy("k", "v").limit(max_samples * trees), "forest-sample")
    rank = F.row_number().over(Window.orderBy("k", "v")) - 1  # of a sample of fixed size
    sample = drawn.select(rank.cast("long").alias("rank"), "v")
    leaves = [(r["low"], r["high"], r["path"]) for r in isolation_trees(sample, trees, seed, max_samples).collect()] if drawn.head(1) else []
    if not leaves:
        return df.withColumn("is_outlier", F.lit(None).cast("int"))
    borders, paths = isolation_steps(leaves)
    after = np.nextafter(borders, np.inf)  # a value on a border belongs to the step below it
    splits = [-np.inf, *(after.tolist() or [0.0]), np.inf]
    steps = Bucketizer(splits=splits, inputCol="_v", outputCol="_step")
    counted = steps.transform(known.select(F.col(value).cast("double").alias("_v"))).groupBy("_step").count().collect()
    counts = np.zeros(len(paths), dtype=np.int64)
    for row in counted:
        counts[min(int(row["_step"]), len(paths) - 1)] += row["count"]
    high = short_paths(paths, counts, contamination)
    turns = np.flatnonzero(high[1:] != high[:-1])  # after these steps flagged and unflagged ranges change
    cuts = after[turns].tolist()
    ranges = Bucketizer(splits=[-np.inf, *(cuts or [0.0]), np.inf], inputCol="_v", outputCol="_range", handleInvalid="keep")
    placed = ranges.transform(df.withColumn("_v", F.coalesce(F.col(value).cast("double"), F.lit(float("nan")))))
    flagged = (F.col("_range") % 2 == int(not high[0])) if cuts else F.lit(bool(high[0]))
    flag = F.when(~F.isnan("_v"), F.when(flagged, -1).otherwise(1))
    return placed.withColumn("is_outlier", flag).drop("_v", "_range")


def inlier_filter(df: DataFrame) -> DataFrame:
    return df.where(F.col("is_outlier") == 1).drop("is_outlier")


# -- tokens ----------------------------------------------------------------------
PAD, UNKNOWN = 0, 1


def vocabulary(df: DataFrame, text: str, size: int = 5000) -> DataFrame:
    """The ``size`` most frequent tokens with ids from 2 on; ties by token.

    Counts combine before the shuffle and only ``size`` rows are numbered.
    """
    words = df.select(F.explode(pieces(F.col(text))).alias("token")).where(F.col("token") != "")
    top = words.groupBy("token").count().orderBy(F.desc("count"), "token").limit(size)
    rank = F.row_number().over(Window.orderBy(F.desc("count"), "token"))
    return top.select("token", (rank + 1).cast("int").alias("token_id"))


def token_pack(
    df: DataFrame, keys: Sequence[str], order: str, text: str, vocab: DataFrame, max_len: int = 32
) -> DataFrame:
    """Exactly ``max_len`` token ids and a 0/1 mask per key, cut or padded at the end.

    The texts of a key count as one text in the given order. Only the leading
    tokens of each text travel, and at most ``max_len`` per key and task.
    """
    first = leading_tokens(F.col(text), max_len)
    places = df.select(*keys, order, F.posexplode_outer(first).alias("_place", "token"))
    reading = Window.partitionBy(*keys).orderBy(F.col("token").isNull(), order, "_place")
    leading = places.withColumn("_rn", F.row_number().over(reading)).where(F.col("_rn") <= max_len)
    found = leading.join(vocab, "token", "left")
    known = F.struct(F.col("_rn"), F.coalesce("token_id", F.lit(UNKNOWN)).alias("t"))
    entry = F.when(F.col("token").isNotNull(), known)
    packed = found.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("_entries"))
    ids = F.transform("_entries", lambda e: e["t"])
    n = F.size("_entries")
    rest = F.lit(max_len) - n
    return packed.select(
        *keys,
        F.concat(ids, F.array_repeat(F.lit(PAD), rest)).alias("token_ids"),
        F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), rest)).alias("mask"),
    )
