"""Linear heads over vectors, pairs and price windows: least squares from sums that any engine can rebuild."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The weights and the matrix of sums go through the driver, so the number of features is bounded.
MAX_FEATURES = 4_000

#: Partial sums that reach the driver.
LAST_SUMS = 16


def joined(vectors: Sequence[str]) -> Column:
    """Array columns as one array of doubles."""
    return F.concat(*[F.col(v).cast("array<double>") for v in vectors])


def summed(df: DataFrame, vectors: Sequence[str], body) -> np.ndarray | None:
    """Sum of ``body(matrix)`` over all Arrow batches, a row of the matrix per row of ``df``; None without rows.

    Every task adds up its own batches, a second stage adds the tasks' sums, and the driver the last few.
    """
    rows = df.select(joined(vectors).alias("z"))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = None
        for batch in batches:
            if batch.num_rows:
                flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
                part = body(flat.reshape(batch.num_rows, -1))
                found = part if found is None else found + part
        if found is not None:
            yield pa.RecordBatch.from_arrays([pa.array([found.ravel()], pa.list_(pa.float64()))], ["s"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = None
        for batch in batches:
            for row in batch.column(0):
                part = row.values.to_numpy()
                found = part if found is None else found + part
        if found is not None:
            yield pa.RecordBatch.from_arrays([pa.array([found], pa.list_(pa.float64()))], ["s"])

    parts = rows.mapInArrow(partial, "s array<double>").repartition(LAST_SUMS).mapInArrow(total, "s array<double>")
    found = [np.array(r["s"]) for r in parts.collect()]
    return sum(found) if found else None


@dataclass(frozen=True)
class LinearFit:
    """Weights and intercept; ``gradient`` is the largest slope of the loss that is left, 0 for an exact fit."""

    weights: np.ndarray
    intercept: float
    rows: int
    gradient: float


def fit_linear(df: DataFrame, vectors: Sequence[str], label: str, reg: float = 0.0) -> LinearFit:
    """Least squares with intercept: mean squared error / 2 + ``reg`` / 2 · |weights|², from one pass of sums.

    The sums of all products of two columns are the normal equations; they are solved on the driver. Without a
    penalty the shortest of several solutions is taken. Rows without a label or with a null vector do not count.
    """
    known = df.where(F.col(label).isNotNull()).withColumn("_y", F.array(F.lit(1.0), F.col(label).cast("double")))
    for v in vectors:
        known = known.where(F.col(v).isNotNull())
    sums = summed(known, ["_y", *vectors], lambda z: z.T @ z)
    if sums is None:
        raise ValueError("no rows to fit")
    size = int(round(len(sums) ** 0.5))
    if size - 2 > MAX_FEATURES:
        raise ValueError(f"{size - 2} features, more than {MAX_FEATURES}")
    sums = sums.reshape(size, size)
    n = sums[0, 0]
    mean, mean_y = sums[0, 2:] / n, sums[0, 1] / n
    matrix = sums[2:, 2:] / n - np.outer(mean, mean) + reg * np.eye(size - 2)
    right = sums[1, 2:] / n - mean_y * mean
    weights = np.linalg.solve(matrix, right) if reg else np.linalg.lstsq(matrix, right, rcond=None)[0]
    gradient = float(np.abs(matrix @ weights - right).max(initial=0.0))
    return LinearFit(weights, float(mean_y - weights @ mean), int(n), gradient)


def predict(df: DataFrame, vectors: Sequence[str], fit: LinearFit, out: str = "prediction") -> DataFrame:
    """One matrix product per Arrow batch; a row with a null vector has no prediction."""
    weights, intercept = fit.weights, fit.intercept

    @F.pandas_udf("double")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            known = batch.notna()
            values = pd.Series(np.nan, index=batch.index)
            if known.any():
                values[known] = np.stack(batch[known].to_numpy()) @ weights + intercept
            yield values

    return df.withColumn(out, apply(joined(vectors)))


def linear_head(
    train: DataFrame, score: DataFrame, vectors: Sequence[str], label: str, reg: float = 0.0
) -> DataFrame:
    """Fit on ``train``, add ``prediction`` to ``score``."""
    return predict(score, vectors, fit_linear(train, vectors, label, reg))


def flatten_window(df: DataFrame, window: str, features: Sequence[str], out: str = "flat") -> DataFrame:
    """A window of one array per feature as one array, step after step."""
    zipped = F.arrays_zip(*[F.col(f"{window}.{f}").cast("array<double>").alias(f) for f in features])
    return df.withColumn(out, F.flatten(F.transform(zipped, lambda s: F.array(*[s[f] for f in features]))))
