"""Counts, exact quantiles, summaries and histograms that combine before they shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.operators.joins import salted_join
from tapeloom.operators.timeline import SEGMENT, Timeline, null_safe_keys


def value_bounds(df: DataFrame, value: str) -> list[float]:
    """Cut points that split the rows about evenly, from a one-pass sketch.

    They only steer the work: results do not depend on where the cuts lie. Their
    number is fixed by the shuffle partitions.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / parts for i in range(1, parts)]
    number = df.select(F.col(value).cast("double").alias("v"))
    found = number.approxQuantile("v", shares, 0.25 / parts) if shares else []
    return sorted({b for b in found if abs(b) != float("inf")})


def value_runs(
    df: DataFrame, value: str, group: Sequence[str] = (), sums: dict[str, Column] | None = None
) -> DataFrame:
    """Distinct numbers in order with running sums.

    Columns: group, value, ``n`` and the sums per value, ``upto_<sum>`` running
    and ``all_<sum>`` over the group. Equal values collapse before any shuffle, so
    one value that fills a third of the table is one row here.
    """
    sums = {"n": F.lit(1), **(sums or {})}
    known = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    counted = known.groupBy(*group, value).agg(*[F.sum(v).alias(name) for name, v in sums.items()])
    rows = Timeline.by_bounds(counted, group, value, value_bounds(known, value)).annotate(
        running={f"upto_{name}": F.col(name) for name in sums},
        totals={f"all_{name}": ("sum", F.col(name)) for name in sums},
    )
    return rows.result()


#: Ranks are bracketed by a sketch of this accuracy; a group of no more rows is ranked as it is.
ACCURACY = 10_000


def bracket_shares(probabilities: Sequence[float]) -> list[float]:
    """For each probability a share below and one above it, whose values by the sketch bracket the exact ranks."""
    reach = 4.0 / ACCURACY
    return [share for p in probabilities for share in (max(0.0, p - reach), min(1.0, p + reach))]


def sketched(value: str, probabilities: Sequence[float]) -> list[Column]:
    """Aggregates that fit the brackets: rows with a value, and the values at the brackets' ends."""
    number = F.when(~F.isnan(F.col(value).cast("double")), F.col(value))
    marks = F.percentile_approx(number, bracket_shares(probabilities), ACCURACY)
    return [F.count(number).alias("_known"), marks.alias("_marks")]


def selected(
    rows: DataFrame, value: str, probabilities: dict[str, float], group: Sequence[str], known: Column, marks: list[Column]
) -> DataFrame:
    """Exact quantiles per group, given rows with a value, the rows of a group and its brackets' ends.

    Rows outside every bracket only count; those inside keep their value. So what is shuffled and ranked is a
    small share of the rows, equal values once, and what lies between two ends is ranked apart.
    """
    v = F.col(value)
    begun = reduce(lambda a, b: a + b, [(v >= m).cast("int") for m in marks[::2]])
    ended = reduce(lambda a, b: a + b, [(v > m).cast("int") for m in marks[1::2]])
    placed = rows.select(*group, v.alias("_v"), known.alias("_all"), begun.alias("_begun"), ended.alias("_ended"))
    inside = (F.col("_all") <= ACCURACY) | (F.col("_begun") > F.col("_ended"))
    counted = placed.groupBy(
        *group, (F.col("_begun") + F.col("_ended")).alias(SEGMENT), F.when(inside, F.col("_v")).alias("_value")
    ).agg(F.count(F.lit(1)).alias("_n"), F.max("_all").alias("_all"))
    runs = Timeline(counted, tuple(group), ("_value",)).annotate(running={"_upto": F.col("_n")}).result()

    last, kept, out = F.col("_all") - 1, {}, []
    for name, p in probabilities.items():
        rank = F.lit(float(p)) * last
        for side, at in (("lo", F.floor(rank)), ("hi", F.ceil(rank))):
            holds = (F.col("_upto") - F.col("_n") <= at) & (at < F.col("_upto"))
            kept[f"_{name}_{side}"] = F.max(F.when(holds, F.col("_value")))
    found = runs.groupBy(*group).agg(*[c.alias(n) for n, c in kept.items()], F.max("_all").alias("_all"))
    missed = F.raise_error(F.lit("a rank lies outside its bracket"))
    for name, p in probabilities.items():
        rank = F.lit(float(p)) * (F.col("_all") - 1)
        lo, hi = (F.when(F.col("_all") > 0, F.coalesce(f"_{name}_{side}", missed)) for side in ("lo", "hi"))
        out.append((lo + (hi - lo) * (rank - F.floor(rank))).alias(name))
    return found.select(*group, *out)


def with_value(df: DataFrame, value: str) -> DataFrame:
    return df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))


def constant_marks(marks: list | None, probabilities: dict[str, float]) -> list[Column]:
    return [F.lit(m) for m in marks or [None] * len(bracket_shares(list(probabilities.values())))]


def quantiles(
    df: DataFrame, value: str, probabilities: dict[str, float], group: Sequence[str] = ()
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group.

    ``probabilities`` maps output names to shares. A first scan brackets all ranks by a mergeable sketch, a second
    one counts the rows below the brackets and keeps only those inside, which alone are ranked.
    """
    rows, shares = with_value(df.select(*group, value), value), list(probabilities.values())
    if not group:
        fit = rows.agg(*sketched(value, shares)).first()
        return selected(rows, value, probabilities, (), F.lit(fit["_known"]), constant_marks(fit["_marks"], probabilities))
    keys = null_safe_keys(rows, group)
    keyed = rows.withColumns(keys)
    fit = keyed.groupBy(*keys).agg(*sketched(value, shares))
    joined = salted_join(keyed, fit, list(keys), "inner", F.col(value))
    marks = [F.col("_marks")[k] for k in range(len(bracket_shares(shares)))]
    return selected(joined, value, probabilities, group, F.col("_known"), marks)


def approx_quantiles(df: DataFrame, value: str, probabilities: dict[str, float], accuracy: int = 10_000) -> DataFrame:
    """One-pass sketch quantiles for when an approximation will do."""
    picked = F.percentile_approx(value, list(probabilities.values()), accuracy)
    found = df.agg(picked.alias("_q"))
    return found.select(*[F.col("_q")[i].alias(name) for i, name in enumerate(probabilities)])


QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def describe(df: DataFrame, value: str) -> DataFrame:
    """count, mean, sample deviation, min, quartiles, max as one row.

    The first scan gives all but the quartiles and brackets these, the second one selects them.
    """
    simple = {
        "n": F.count(value),
        "mean": F.avg(value),
        "std": F.stddev_samp(value),
        "lowest": F.min(value),
        "highest": F.max(value),
    }
    aggs = [c.alias(name) for name, c in simple.items()]
    fit = df.select(value).agg(*aggs, *sketched(value, list(QUARTILES.values()))).first()
    rows, marks = with_value(df.select(value), value), constant_marks(fit["_marks"], QUARTILES)
    quartiles = selected(rows, value, QUARTILES, (), F.lit(fit["_known"]), marks)
    kinds = dict(df.select(value).agg(*aggs).dtypes)
    return quartiles.select(*[F.lit(fit[name]).cast(kinds[name]).alias(name) for name in simple], *QUARTILES)


def limits(df: DataFrame, value: str, low: float, high: float) -> tuple[Column, Column]:
    """Two exact quantiles as constants, so that filters on them reach the scan."""
    row = quantiles(df, value, {"lo": low, "hi": high}).first()
    return (F.lit(row["lo"]), F.lit(row["hi"])) if row else (F.lit(None), F.lit(None))


def percentile_trim(df: DataFrame, value: str, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Rows whose value lies within the two quantiles, borders included."""
    lowest, highest = limits(df, value, low, high)
    return df.where((F.col(value) >= lowest) & (F.col(value) <= highest))


def histogram(df: DataFrame, value: str, bins: int, group: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins between minimum and maximum; the maximum is in the last bin."""
    known = df.where(F.col(value).isNotNull())
    span = known.groupBy(*group).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    if group:
        placed = salted_join(known, span, group, "inner", F.col(value))
    else:
        ends = span.first()
        placed = known.withColumns({"_lo": F.lit(ends["_lo"]), "_hi": F.lit(ends["_hi"])})
    width = F.nullif((F.col("_hi") - F.col("_lo")) / F.lit(bins), F.lit(0.0))
    place = F.floor((F.col(value) - F.col("_lo")) / width)
    bin_no = F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("int")
    return placed.groupBy(*group, bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)


def max_group_size(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).count().agg(F.max("count").alias("max_group_size"))


def coverage_stats(df: DataFrame, column: str, by: str = "stock_symbol") -> DataFrame:
    """Rows, rows with a value and their share, per symbol and for all (null symbol)."""
    return df.rollup(by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(column).alias("n_known"),
        (F.count(column) * 100.0 / F.count(F.lit(1))).alias("pct_known"),
    )


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()
