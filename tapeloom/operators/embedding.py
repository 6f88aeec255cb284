"""Vector columns: text vectors, pooling, projection, attention over day bags."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from tapeloom.functions.text import exponentials, tokens
from tapeloom.functions.vectors import dot, let, total
from tapeloom.operators.models import summed
from tapeloom.operators.news import daily_mean_embedding
from tapeloom.session import staged


MAX_BROADCAST_BYTES = 256 << 20


def hashed_text_vectors(
    df: DataFrame, text: str, dim: int = 64, out: str = "embedding", key: str = "doc_id"
) -> DataFrame:
    """Default text vectors: counts of tokens per digest bucket, length one; one row per ``key``.

    Tokens are counted per (key, bucket) before the shuffle. A text without tokens is all zeros.
    """
    slot = F.pmod(F.conv(F.substring(F.md5("token"), 1, 8), 16, 10).cast("long"), F.lit(dim)).cast("int")
    words = df.select(key, F.explode_outer(tokens(F.col(text))).alias("token")).withColumn("slot", slot)
    counts = words.groupBy(key, "slot").agg(F.count("token").cast("double").alias("n"))
    entry = F.when(F.col("slot").isNotNull(), F.struct("slot", "n"))
    found = counts.groupBy(key).agg(F.map_from_entries(F.collect_list(entry)).alias("found"), F.sum(F.col("n") * F.col("n")).alias("norm"))
    value = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda k: F.coalesce(F.try_element_at("found", k), F.lit(0.0)))
    length = F.when(F.col("norm") > 0, F.sqrt("norm")).otherwise(F.lit(1.0))
    vector = F.transform(value, lambda x: (x / length).cast("float"))
    return found.select(key, vector.alias(out))


def start_matrix(dim: int, rank: int, seed: int) -> np.ndarray:
    """Numbers in [-0.5, 0.5) by digest, the same on every engine."""
    digest = [[hashlib.md5(f"{i}:{j}:{seed}".encode()).hexdigest()[:8] for j in range(rank)] for i in range(dim)]
    return np.array([[int(d, 16) / 2**32 - 0.5 for d in row] for row in digest])


def orthonormal(columns: np.ndarray) -> np.ndarray:
    """Orthonormal columns of the same space, by Gram and Schmidt; a column that adds nothing becomes zero."""
    basis: list[np.ndarray] = []
    for column in columns.T:
        v, first = column, np.linalg.norm(column)
        for q in basis:
            v = v - (v @ q) * q
        size = np.linalg.norm(v)
        basis.append(v / size if size > 1e-12 * first else np.zeros(len(v)))
    return np.array(basis).T


def range_basis(df: DataFrame, vector: str, dim: int, rank: int = 8, seed: int = 42, passes: int = 2) -> np.ndarray | None:
    """An orthonormal (dim, rank) basis that the rows' vectors lie near, by a randomised range finder.

    Each pass multiplies the (rows x dim) matrix and its transpose with the present basis, as a sum over rows in
    Spark; only (dim x rank) numbers reach the driver. Every pass turns the basis nearer to the directions that hold most.
    """
    basis = start_matrix(dim, rank, seed)
    for _ in range(passes):
        sums = summed(df, [vector], lambda z, b=basis: z.T @ (z @ b))
        if sums is None:
            return None
        basis = orthonormal(sums.reshape(dim, rank))
    return basis


def low_rank_vectors(
    df: DataFrame, text: str, dim: int = 256, rank: int = 8, out: str = "embedding", key: str = "doc_id", seed: int = 42
) -> DataFrame:
    """Text vectors in a space learned from the texts: hashed token counts on the basis of ``range_basis``."""
    hashed = staged(hashed_text_vectors(df, text, dim, "_hashed", key), "hashed-texts")
    basis = range_basis(hashed, "_hashed", dim, rank, seed)
    if basis is None:
        return hashed.select(key, F.array().cast("array<double>").alias(out))

    @F.pandas_udf("array<double>")
    def turn(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            rows = np.stack(batch.to_numpy()).astype(np.float64) @ basis if len(batch) else []
            yield pd.Series(list(rows), dtype=object)

    return hashed.select(key, turn("_hashed").alias(out))


def score_batches(
    df: DataFrame,
    text: str,
    load: Callable[[], Callable[[pd.Series], list]],
    out: str,
    out_type: str = "array<float>",
    part_rows: int = 1000,
    part_bytes: int = 4 << 20,
) -> DataFrame:
    """Run a caller's model over a text column in Arrow batches.

    ``load`` is called once per task and returns a function from a series of texts
    to one value per text; only the text crosses to Python. It must be importable on
    the executors or be a local function. The model gets parts of an Arrow batch, of at most
    ``part_rows`` texts and, unless one text is longer, ``part_bytes``: as Python strings, the
    texts of a whole batch would take several times its size.
    """
    kind = to_arrow_type(DataType.fromDDL(out_type))

    # all that it needs is local, so that it travels to executors that do not have this package
    @F.arrow_udf(out_type)
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = load()
        for batch in batches:
            ends = np.cumsum(pc.fill_null(pc.binary_length(batch), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            start = 0
            while start < len(batch):
                most = (ends[start - 1] if start else 0) + part_bytes
                fit = int(np.searchsorted(ends, most, side="right"))
                stop = max(start + 1, min(fit, start + part_rows))
                texts = batch.slice(start, stop - start).to_pandas()
                yield pa.array(list(model(texts)), kind, from_pandas=True)
                start = stop

    return df.withColumn(out, apply(F.col(text)))


def masked_mean_pool(bag: Column, mask: Column, dim: int) -> Column:
    """Sum of masked vectors over max(sum of the mask, 1e-9)."""
    zero = F.array_repeat(F.lit(0.0), dim)
    kept = F.filter(F.arrays_zip(bag.alias("v"), mask.alias("m")), lambda e: e["m"] == 1)
    summed = F.aggregate(
        kept, zero, lambda acc, e: F.zip_with(acc, e["v"], lambda x, y: x + y.cast("double"))
    )
    weight = F.greatest(F.aggregate(mask, F.lit(0.0), lambda a, m: a + m), F.lit(1e-9))
    return let(weight, lambda w: F.transform(summed, lambda x: x / w))


def project_embedding(
    df: DataFrame, vector: str, weights: dict[str, np.ndarray], out: str = "projected"
) -> DataFrame:
    """Two dense layers with a ReLU between, one matrix product per Arrow batch.

    The weights go to every executor, so their size is checked first.
    """
    size = sum(w.nbytes for w in weights.values())
    if size > MAX_BROADCAST_BYTES:
        raise ValueError(f"weights of {size} bytes are too large to broadcast")
    shared = df.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("array<double>")
    def project(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w = shared.value
        for batch in batches:
            if len(batch) == 0:
                yield pd.Series([], dtype=object)
                continue
            x = np.stack(batch.to_numpy()).astype(np.float64)
            hidden = np.maximum(x @ w["w1"] + w["b1"], 0.0)
            yield pd.Series(list(hidden @ w["w2"] + w["b2"]))

    return df.withColumn(out, project(F.col(vector)))


def symbol_queries(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Default attention query of a symbol: the mean of its vectors."""
    return daily_mean_embedding(df, vector, ("stock_symbol",)).withColumnRenamed(vector, "query")


def attention_pool(bag: Column, values: Column, mask: Column, query: Column, dim: int) -> Column:
    """softmax(query·key/√dim), masked places at -1e9, as weights of ``values``."""
    scale = float(np.sqrt(dim))
    scores = F.transform(
        F.arrays_zip(bag.alias("k"), mask.alias("m")),
        lambda e: F.when(e["m"] == 0, F.lit(-1e9)).otherwise(dot(e["k"], query) / scale),
    )

    def weigh(weights: Column) -> Column:
        summed = F.aggregate(
            F.arrays_zip(values.alias("v"), weights.alias("w")),
            F.array_repeat(F.lit(0.0), dim),
            lambda acc, e: F.zip_with(acc, e["v"], lambda x, y: x + y.cast("double") * e["w"]),
        )
        return let(total(weights), lambda every: F.transform(summed, lambda x: x / every))

    return let(let(scores, exponentials), weigh)
