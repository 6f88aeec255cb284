"""Ordered rows per group, processed in segments instead of whole groups.

A plain ``Window.partitionBy(symbol)`` puts a symbol that owns a third of all
rows into one task. A :class:`Timeline` cuts every group into segments that are
monotone in the order, runs the window per (group, segment), and carries what
crosses a border through one small summary row per segment. Frames that look a
fixed number of rows around use equal blocks plus copied border rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.session import staged

SEGMENT = "_segment"
NO_PLACE = -(1 << 62)  # the segment of rows without a date or id: sorted first, as nulls are
BLOCK = "_block"


# What stands for null in a key column, by type.
STAND_INS = {
    "string": "",
    "date": dt.date(1970, 1, 1),
    "boolean": False,
    "double": 0.0,
    "bigint": 0,
    "int": 0,
}


def null_safe_keys(df: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    """Key columns that are never null, so that a null group finds its summary.

    Each column becomes its value or a stand-in, and whether it was null; plain
    types keep sorting and hashing fast.
    """
    types, keys = dict(df.dtypes), {}
    for i, c in enumerate(columns):
        if types[c] in STAND_INS:
            keys[f"_g{i}"] = F.coalesce(F.col(c), F.lit(STAND_INS[types[c]]))
            keys[f"_g{i}_null"] = F.col(c).isNull()
        else:
            keys[f"_g{i}"] = F.struct(c)
    return keys


def hash_buckets(df: DataFrame) -> int:
    """Segments for hash-ordered rows: a few per shuffle partition."""
    return 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


@dataclass(frozen=True)
class Timeline:
    """``df`` with a segment column; ``order`` must be unique inside a group."""

    df: DataFrame
    group: tuple[str, ...]
    order: tuple[str, ...]

    # -- ways to cut ---------------------------------------------------------
    @classmethod
    def by_date(cls, df: DataFrame, group: Sequence[str], date: str, days: int = 256) -> Timeline:
        """One row per (group, date): a segment holds at most ``days`` rows."""
        segment = F.coalesce(F.floor(F.unix_date(F.col(date)) / days), F.lit(NO_PLACE))
        return cls(df.withColumn(SEGMENT, segment), tuple(group), (date,))

    @classmethod
    def by_id(cls, df: DataFrame, group: Sequence[str], id_col: str, segments: int | None = None) -> Timeline:
        """Unique integer ids, dense or far apart, cut where a sketch of them says that equal shares lie.

        The number of segments, and so of summary rows per group, is a few per shuffle
        partition at any size of the table. Rows without an id come first.
        """
        n = segments or hash_buckets(df)
        marks = F.array(*[F.lit(k / n) for k in range(1, n)])
        found = df.agg(F.percentile_approx(id_col, marks, 20 * n)).first()[0] if n > 1 else None
        splits = [-float("inf"), *(sorted({float(b) for b in found}) if found else [0.0]), float("inf")]
        number = df.withColumn("_number", F.coalesce(F.col(id_col).cast("double"), F.lit(-1.7e308)))
        cut = Bucketizer(splits=splits, inputCol="_number", outputCol=SEGMENT)
        return cls(cut.transform(number).drop("_number"), tuple(group), (id_col,))

    @classmethod
    def by_hash(
        cls, df: DataFrame, group: Sequence[str], key: str, tie: str, buckets: int | None = None
    ) -> Timeline:
        """Rows ordered by a hex digest: its leading 32 bits spread them evenly."""
        buckets = buckets or hash_buckets(df)
        head = F.conv(F.substring(key, 1, 8), 16, 10).cast("long")
        segment = F.shiftright(head * F.lit(buckets).cast("long"), 32)
        return cls(df.withColumn(SEGMENT, segment), tuple(group), (key, tie))

    @classmethod
    def by_range(cls, df: DataFrame, group: Sequence[str], order: Sequence[str]) -> Timeline:
        """Any order: Spark's range partitioning, which also splits hot groups.

        The partition number is written out with the rows, so that every later
        reader, and every retried task, sees the same cut.
        """
        keys = [F.col(c).asc_nulls_first() for c in (*group, *order)]
        ranged = df.repartitionByRange(*keys).withColumn(
            SEGMENT, F.spark_partition_id().cast("long")
        )
        return cls(staged(ranged, "ranged"), tuple(group), tuple(order))

    @classmethod
    def by_bounds(
        cls, df: DataFrame, group: Sequence[str], value: str, bounds: Sequence[float]
    ) -> Timeline:
        """Distinct numbers per group, cut at the given ascending bounds."""
        splits = [-float("inf"), *(bounds or [0.0]), float("inf")]
        number = df.withColumn("_number", F.col(value).cast("double"))
        cut = Bucketizer(splits=splits, inputCol="_number", outputCol=SEGMENT)
        return cls(cut.transform(number).drop("_number"), tuple(group), (value,))

    # -- windows -------------------------------------------------------------
    def with_columns(self, columns: dict[str, Column]) -> Timeline:
        return replace(self, df=self.df.withColumns(columns))

    def annotate(
        self,
        position: str | None = None,
        total: str | None = None,
        running: dict[str, Column] | None = None,
        last: dict[str, Column] | None = None,
        previous: dict[str, Column] | None = None,
        following: dict[str, Column] | None = None,
        totals: dict[str, tuple[str, Column]] | None = None,
    ) -> Timeline:
        """Add whole-group columns.

        position   0-based row number in the group
        total      rows in the group
        running    inclusive running sums
        last       latest non-null value up to and with this row
        previous   latest non-null value strictly before this row
        following  first non-null value strictly after this row
        totals     ``{out: (sum|min|max, value)}`` over the group
        """
        running, last, previous = running or {}, last or {}, previous or {}
        following, totals = following or {}, totals or {}
        group_keys = null_safe_keys(self.df, self.group)
        group = list(group_keys)
        keys = [*group, SEGMENT]
        source = self.df.withColumns(group_keys) if group else self.df
        at = F.struct(*self.order)

        aggs = [F.count(F.lit(1)).alias("_n")]
        for name, value in running.items():
            aggs.append(F.sum(value).alias(f"_run_{name}"))
        for name, value in {**last, **previous}.items():
            aggs.append(F.max_by(value, F.when(value.isNotNull(), at)).alias(f"_prev_{name}"))
        for name, value in following.items():
            aggs.append(F.min_by(value, F.when(value.isNotNull(), at)).alias(f"_next_{name}"))
        for name, (kind, value) in totals.items():
            aggs.append(getattr(F, kind)(value).alias(f"_tot_{name}"))

        across = Window.partitionBy(*group)
        before = across.orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
        after = across.orderBy(SEGMENT).rowsBetween(1, Window.unboundedFollowing)
        cols = []
        if position:
            cols.append(F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_c_position"))
        if total:
            cols.append(F.sum("_n").over(across).alias(total))
        for name in running:
            cols.append(F.sum(f"_run_{name}").over(before).alias(f"_c_run_{name}"))
        for name in {**last, **previous}:
            carried = F.last(f"_prev_{name}", ignorenulls=True).over(before)
            cols.append(carried.alias(f"_c_prev_{name}"))
        for name in following:
            carried = F.first(f"_next_{name}", ignorenulls=True).over(after)
            cols.append(carried.alias(f"_c_next_{name}"))
        for name, (kind, _) in totals.items():
            cols.append(getattr(F, kind)(f"_tot_{name}").over(across).alias(name))
        summary = source.groupBy(*keys).agg(*aggs).select(*keys, *cols)

        here = Window.partitionBy(*keys).orderBy(*self.order)
        upto = here.rowsBetween(Window.unboundedPreceding, 0)
        prior = here.rowsBetween(Window.unboundedPreceding, -1)
        later = here.rowsBetween(1, Window.unboundedFollowing)
        own = []
        if position:
            own.append(F.row_number().over(here).alias("_l_position"))
        for name, value in running.items():
            own.append(F.sum(value).over(upto).alias(f"_l_run_{name}"))
        for name, value in last.items():
            own.append(F.last(value, ignorenulls=True).over(upto).alias(f"_l_prev_{name}"))
        for name, value in previous.items():
            own.append(F.last(value, ignorenulls=True).over(prior).alias(f"_l_prev_{name}"))
        for name, value in following.items():
            own.append(F.first(value, ignorenulls=True).over(later).alias(f"_l_next_{name}"))
        joined = source.select("*", *own).join(summary, keys)

        out = {}
        if position:
            out[position] = F.col("_l_position") + F.col("_c_position") - 1
        for name in running:
            carried, inside = F.col(f"_c_run_{name}"), F.col(f"_l_run_{name}")
            out[name] = F.when(carried.isNull(), inside).when(inside.isNull(), carried).otherwise(
                carried + inside
            )
        for name in {**last, **previous}:
            out[name] = F.coalesce(f"_l_prev_{name}", f"_c_prev_{name}")
        for name in following:
            out[name] = F.coalesce(f"_l_next_{name}", f"_c_next_{name}")
        kept = [c for c in self.df.columns if c not in out]
        new = [value.alias(name) for name, value in out.items()]
        if total:
            new.append(F.col(total))
        new += [F.col(name) for name in totals]
        return replace(self, df=joined.select(*kept, *new))

    def around(
        self,
        before: int,
        after: int,
        make: Callable[[object], dict[str, Column]],
        position: str = "pos",
        block: int = 4096,
    ) -> DataFrame:
        """Window columns that look at most ``before``/``after`` rows away.

        Every block of ``block`` consecutive rows gets copies of the rows that
        border it, so that a block is complete on its own.
        """
        pos = F.col(position)
        first = F.floor(F.greatest(pos - after, F.lit(0)) / block)
        final = F.floor((pos + before) / block)
        spread = self.df.withColumn(BLOCK, F.explode(F.sequence(first, final)))
        window = Window.partitionBy(*self.group, BLOCK).orderBy(position)
        columns = [value.alias(name) for name, value in make(window).items()]
        return (
            spread.select("*", *columns)
            .where(F.floor(pos / block) == F.col(BLOCK))
            .drop(BLOCK, SEGMENT)
        )

    def result(self) -> DataFrame:
        return self.df.drop(SEGMENT)
