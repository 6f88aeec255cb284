"""Seeded hash order: the same on every engine, every retry and every branch."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def random_key(*parts: str | Column, seed: int = 42) -> Column:
    """A hex digest that orders rows at random, yet always the same way."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws(":", *[c.cast("string") for c in cols], F.lit(str(seed))))


def uniform(key: Column, draw: int = 0) -> Column:
    """The ``draw``-th uniform number in [0, 1) of a digest (four fit)."""
    return F.conv(F.substring(key, 1 + 8 * draw, 8), 16, 10).cast("double") / F.lit(4294967296.0)
