"""Vector expressions over array columns; all run inside the JVM."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often it is used."""
    return F.transform(F.array(value), body)[0]


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x.cast("double"))


def squared_distance(a: Column, b: Column, shift: float = 0.0) -> Column:
    def term(x: Column, y: Column) -> Column:
        d = x.cast("double") - y.cast("double") + F.lit(shift)
        return d * d

    return total(F.zip_with(a, b, term))


def euclidean_distance(a: Column, b: Column, floor: float = 1e-7) -> Column:
    """sqrt(max(sum d², floor)): safe to differentiate at zero."""
    return F.sqrt(F.greatest(squared_distance(a, b), F.lit(floor)))


def shifted_distance(a: Column, b: Column, eps: float = 1e-6) -> Column:
    """Norm of ``a - b + eps``, element by element."""
    return F.sqrt(squared_distance(a, b, eps))


def norm(v: Column) -> Column:
    return F.sqrt(total(F.transform(v, lambda x: x.cast("double") * x.cast("double"))))


def l2_normalize(v: Column) -> Column:
    """The vector over its norm; a zero vector stays as it is."""

    def divide(size: Column) -> Column:
        divisor = F.when(size == 0, F.lit(1.0)).otherwise(size)
        return F.transform(v, lambda x: x.cast("double") / divisor)

    return let(norm(v), divide)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def contrastive_loss(label: Column, distance: Column, margin: float = 1.0, scale: float = 1.0) -> Column:
    """label·d² + (1-label)·max(0, margin-d)², times ``scale``."""
    gap = F.greatest(F.lit(margin) - distance, F.lit(0.0))
    return (label * distance * distance + (F.lit(1.0) - label) * gap * gap) * F.lit(scale)


def order_stat_target(v: Column, k: int = 5) -> Column:
    """Half the mean plus half the sum of the k-th smallest and k-th largest."""

    def combine(ordered: Column) -> Column:
        mean = total(ordered) / F.size(ordered)
        return 0.5 * mean + 0.5 * (F.element_at(ordered, k) + F.element_at(ordered, -k))

    return let(F.array_sort(F.transform(v, lambda x: x.cast("double"))), combine)


def wide_to_array(df: DataFrame, names: Sequence[str], out: str = "embedding") -> DataFrame:
    """Fold numeric-named columns into one vector; missing columns are an error."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"embedding columns missing: {missing[:5]} ({len(missing)} in all)")
    vector = F.array(*[F.col(f"`{n}`").cast("float") for n in names])
    return df.select(*[c for c in df.columns if c not in set(names)], vector.alias(out))


def array_to_wide(df: DataFrame, vector: str, width: int) -> DataFrame:
    """The inverse for exports: one column per element."""
    cells = [F.col(vector)[i].alias(str(i)) for i in range(width)]
    return df.select(*[c for c in df.columns if c != vector], *cells)
