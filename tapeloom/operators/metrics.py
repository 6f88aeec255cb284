"""Regression and classification metrics as single aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.functions.vectors import let
from tapeloom.operators.stats import value_runs

# The threshold sweep runs 0.10, 0.15 ... 2.95.
SWEEP = [0.1 + 0.05 * i for i in range(58)]


def regression_metrics(
    df: DataFrame, prediction: str, target: str, group: Sequence[str] = ()
) -> DataFrame:
    """MSE, RMSE, MAE and R²."""
    error = F.col(prediction) - F.col(target)
    sums = df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(target).alias("_var"),
    )
    r2 = 1.0 - F.col("mse") / F.nullif(F.col("_var"), F.lit(0.0))
    return sums.select(
        *group, "n", "mse", F.sqrt("mse").alias("rmse"), "mae", r2.alias("r2")
    )


def directional_accuracy(
    df: DataFrame, prediction: str, target: str, last: str, group: Sequence[str] = ()
) -> DataFrame:
    """Share of rows whose predicted direction from ``last`` is the true one."""
    hit = F.signum(F.col(target) - F.col(last)) == F.signum(F.col(prediction) - F.col(last))
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.avg(hit.cast("double")).alias("accuracy")
    )


def roc_points(df: DataFrame, score: str, label: str) -> DataFrame:
    """Per distinct score, from high to low: the rates of calling it and all above positive."""
    down = df.select((-F.col(score)).alias("_down"), F.col(label).cast("long").alias("_label"))
    runs = value_runs(down, "_down", sums={"pos": F.col("_label"), "neg": 1 - F.col("_label")})
    return runs.select(
        (-F.col("_down")).alias("threshold"),
        (F.col("upto_neg") / F.nullif(F.col("all_neg"), F.lit(0))).alias("fpr"),
        (F.col("upto_pos") / F.nullif(F.col("all_pos"), F.lit(0))).alias("tpr"),
        "pos",
        "neg",
        "upto_pos",
        "all_pos",
        "all_neg",
    )


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Area under the curve; ties count half. Null with only one class.

    Pairs are counted as whole numbers, so the result does not depend on how the
    rows were spread; decimals hold the square of any row count.
    """
    points = roc_points(df, score, label)
    above = 2 * (F.col("upto_pos") - F.col("pos")) + F.col("pos")
    twice = F.sum(F.col("neg").cast("decimal(19,0)") * above.cast("decimal(19,0)"))
    pairs = F.max("all_pos").cast("double") * F.max("all_neg").cast("double")
    return points.agg((twice.cast("double") / (2.0 * F.nullif(pairs, F.lit(0.0)))).alias("auc"))


def youden_threshold(points: DataFrame) -> DataFrame:
    """The threshold with the greatest tpr - fpr; the highest one among equals."""
    gain = F.col("tpr") - F.col("fpr")
    best = F.max_by(F.struct("threshold", "fpr", "tpr"), F.struct(gain, "threshold"))
    return points.agg(best.alias("b")).select("b.threshold", "b.fpr", "b.tpr")


def fixed_threshold(score: Column, threshold: float = 0.5) -> Column:
    return F.when(score > threshold, 1).otherwise(0)


CELLS = [(a, p) for a in (0, 1) for p in (0, 1)]


def _cell_counts(df: DataFrame, label: str, pred: str) -> DataFrame:
    counts = [
        F.count_if((F.col(label) == a) & (F.col(pred) == p)).alias(f"c{a}{p}") for a, p in CELLS
    ]
    return df.agg(*counts)


def confusion_matrix(df: DataFrame, label: str, pred: str) -> DataFrame:
    """All four cells, also the empty ones."""
    cells = F.array(
        *[
            F.struct(F.lit(a).alias("label"), F.lit(p).alias("pred"), F.col(f"c{a}{p}").alias("n"))
            for a, p in CELLS
        ]
    )
    return _cell_counts(df, label, pred).select(F.inline(cells))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(top / F.nullif(bottom, F.lit(0)), F.lit(0.0))


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Accuracy, precision, recall, F1 and support per class; 0 where undefined."""
    c = {(a, p): F.col(f"c{a}{p}") for a, p in CELLS}
    every = c[0, 0] + c[0, 1] + c[1, 0] + c[1, 1]
    rows = []
    for k in (0, 1):
        hit, other = c[k, k], 1 - k
        precision = _ratio(hit, hit + c[other, k])
        recall = _ratio(hit, hit + c[k, other])
        f1 = _ratio(2.0 * hit, 2 * hit + c[other, k] + c[k, other])
        rows.append(
            F.struct(
                F.lit(k).alias("label"),
                precision.alias("precision"),
                recall.alias("recall"),
                f1.alias("f1"),
                (hit + c[k, other]).alias("support"),
                _ratio(c[0, 0] + c[1, 1], every).alias("accuracy"),
            )
        )
    return _cell_counts(df, label, pred).select(F.inline(F.array(*rows)))


def f1_threshold_sweep(df: DataFrame, distance: str, label: str, thresholds: Sequence[float] = SWEEP) -> DataFrame:
    """F1 of ``distance < t`` for every threshold, and the first best one marked.

    Each row is put in the interval between two thresholds; the counts of the few
    intervals then give every threshold's confusion in one pass over the data.
    """
    steps = F.array(*[F.lit(float(t)) for t in thresholds])
    reached = let(F.col(distance), lambda d: F.size(F.filter(steps, lambda t: t <= d)))
    sums = df.groupBy(reached.alias("k")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.count(F.lit(1)).alias("n")
    )
    table = sums.agg(F.collect_list(F.struct("k", "pos", "n")).alias("_cells")).select(
        "_cells", F.posexplode(steps).alias("i", "threshold")
    )

    def count(field: str, cells: Column) -> Column:
        return F.aggregate(cells, F.lit(0).cast("long"), lambda acc, e: acc + e[field])

    below = F.filter("_cells", lambda e: e["k"] <= F.col("i"))
    swept = table.select(
        "threshold",
        count("pos", below).alias("tp"),
        count("n", below).alias("called"),
        count("pos", F.col("_cells")).alias("positives"),
    ).withColumn("f1", _ratio(2.0 * F.col("tp"), F.col("called") + F.col("positives")))
    return swept.select("threshold", "tp", "called", "positives", "f1")


def best_f1(swept: DataFrame) -> DataFrame:
    """The first threshold with the greatest F1."""
    best = F.max_by(F.struct("threshold", "f1"), F.struct(F.col("f1"), -F.col("threshold")))
    return swept.agg(best.alias("b")).select("b.threshold", "b.f1")
