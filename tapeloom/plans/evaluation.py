"""Metrics and back-tests on deterministic predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapeloom.operators import backtest as bt
from tapeloom.operators import metrics as me
from tapeloom.operators.series import inverse_scale
from tapeloom.plans.features import test_samples
from tapeloom.plans.registry import plan, r6
from tapeloom.plans.sql import check_sql
from tapeloom.plans.vectors import pair_scores
from tapeloom.sources import adapter

KEYS = ["stock_symbol", "date"]
RATES = ["mse", "rmse", "mae", "r2"]
METRICS_SQL = """count(*) AS n, round(avg((p - t) * (p - t)), 6) AS mse, round(sqrt(avg((p - t) * (p - t))), 6) AS rmse,
round(avg(abs(p - t)), 6) AS mae, round(1 - avg((p - t) * (p - t)) / nullif(var_pop(t), 0), 6) AS r2"""


def rounded(df, columns):
    return df.withColumns({c: r6(c) for c in columns})


@plan(
    "regression_metrics",
    check_sql(
        "samples", body=f"SELECT {METRICS_SQL} FROM (SELECT prediction AS p, target AS t FROM samples)"
    ),
)
def regression_metrics(spark, sf_dir):
    return rounded(me.regression_metrics(test_samples(spark, sf_dir), "prediction", "target"), RATES)


@plan(
    "metrics_by_symbol",
    check_sql(
        "samples",
        body="""SELECT stock_symbol, count(*) AS n, round(avg(pow((prediction - target) * (close_max - close_min), 2)) / 1e6, 4) AS mse
FROM samples GROUP BY stock_symbol""",
    ),
)
def metrics_by_symbol(spark, sf_dir):
    low, high = F.col("close_min"), F.col("close_max")
    priced = test_samples(spark, sf_dir).withColumns(
        {c: inverse_scale(F.col(c), low, high) for c in ("prediction", "target")}
    )
    found = me.regression_metrics(priced, "prediction", "target", ("stock_symbol",))
    return found.select("stock_symbol", "n", F.round(F.col("mse") / 1e6, 4).alias("mse"))


@plan(
    "directional_accuracy",
    check_sql(
        "samples",
        body="""SELECT count(*) AS n, round(avg(CASE WHEN sign(target - last_known) = sign(prediction - last_known) THEN 1.0::DOUBLE
ELSE 0 END), 6) AS accuracy FROM samples""",
    ),
)
def directional_accuracy(spark, sf_dir):
    found = me.directional_accuracy(test_samples(spark, sf_dir), "prediction", "target", "last_known")
    return rounded(found, ["accuracy"])


@plan(
    "naive_persistence",
    check_sql(
        "samples", body=f"SELECT {METRICS_SQL} FROM (SELECT last_known AS p, target AS t FROM samples)"
    ),
)
def naive_persistence(spark, sf_dir):
    return rounded(me.regression_metrics(test_samples(spark, sf_dir), "last_known", "target"), RATES)


SHIFTED = """, shifted AS (SELECT *, sign(prediction - earlier) AS signal, {move} AS move FROM (
SELECT *, lag(prediction, 3) OVER w AS earlier, row_number() OVER w AS rn FROM samples
WINDOW w AS ({part} ORDER BY {order})) WHERE rn > 3)
"""
GLOBAL = {"part": "", "order": "stock_symbol, date"}
BY_SYMBOL = {"part": "PARTITION BY stock_symbol", "order": "date"}
SIGN, RAW = "CAST(sign(target - last_known) AS DOUBLE)", "target - last_known"
RELATIVE_SQL = """SELECT count(*) AS n, round(sum(move), 6) AS market_total, round(sum(signal * move), 6) AS strategy_total,
round(avg(CASE WHEN signal = sign(move) THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy FROM shifted"""
TOTALS = ["market_total", "strategy_total", "accuracy"]


def summary(spark, sf_dir, long_only=False, **options):
    results = bt.backtest(test_samples(spark, sf_dir), long_only=long_only, **options)
    return rounded(bt.backtest_summary(results, long_only), TOTALS)


@plan("backtest_relative", check_sql("samples", body=SHIFTED.format(move=SIGN, **GLOBAL) + RELATIVE_SQL))
def backtest_relative(spark, sf_dir):
    return summary(spark, sf_dir)


@plan(
    "backtest_relative_by_symbol",
    check_sql("samples", body=SHIFTED.format(move=SIGN, **BY_SYMBOL) + RELATIVE_SQL),
)
def backtest_relative_by_symbol(spark, sf_dir):
    return summary(spark, sf_dir, scope="symbol")


@plan(
    "backtest_long_only",
    check_sql(
        "samples",
        body=SHIFTED.format(move=SIGN, **GLOBAL)
        + """SELECT count(*) AS n, round(sum(move), 6) AS market_total,
round(sum(CASE WHEN signal > 0 THEN move ELSE 0 END), 6) AS strategy_total,
round(coalesce(avg(CASE WHEN signal > 0 THEN CASE WHEN sign(move) = 1 THEN 1.0::DOUBLE ELSE 0 END END), 0), 6) AS accuracy
FROM shifted""",
    ),
)
def backtest_long_only(spark, sf_dir):
    return summary(spark, sf_dir, long_only=True)


@plan("backtest_move", check_sql("samples", body=SHIFTED.format(move=RAW, **GLOBAL) + RELATIVE_SQL))
def backtest_move(spark, sf_dir):
    return summary(spark, sf_dir, moves="raw")


@plan(
    "cumulative_pnl",
    check_sql(
        "samples",
        body=SHIFTED.format(move=RAW, **GLOBAL)
        + """SELECT stock_symbol, date, round(sum(move) OVER w, 6) AS market_cum, round(sum(signal * move) OVER w, 6) AS strategy_cum
FROM shifted WINDOW w AS (ORDER BY stock_symbol, date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    ),
)
def cumulative_pnl(spark, sf_dir):
    curve = bt.cumulative_pnl(bt.backtest(test_samples(spark, sf_dir), moves="raw"))
    return curve.select(*KEYS, r6("market_cum").alias("market_cum"), r6("strategy_cum").alias("strategy_cum"))


def negated(spark, sf_dir):
    """Pair scores: the nearer, the more alike."""
    return pair_scores(spark, sf_dir).withColumn("score", -F.round("distance", 6))


def scored_documents(spark, sf_dir):
    """Length as a score for the quality label; has many ties."""
    labels = adapter.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    documents = adapter.table(spark, sf_dir, "documents")
    return labels.join(documents.select("doc_id", F.col("n_chars").cast("double").alias("score")), "doc_id")


AUC_SQL = """SELECT round((sum(CASE WHEN label = 1 THEN r END) - p * (p + 1) / 2.0::DOUBLE) / nullif(p * n, 0), 6) AS auc FROM (
SELECT label, (rank() OVER (ORDER BY score) + rank() OVER (ORDER BY score) + count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS r,
sum(label) OVER () AS p, sum(1 - label) OVER () AS n FROM scored) GROUP BY p, n"""
SCORED_PAIRS = ", scored AS (SELECT -round(distance, 6) AS score, label FROM pair_scores)\n"


@plan("roc_auc", check_sql("pair_scores", body=SCORED_PAIRS + AUC_SQL))
def pair_auc(spark, sf_dir):
    return rounded(me.roc_auc(negated(spark, sf_dir), "score", "label"), ["auc"])


@plan("roc_auc_documents", check_sql("doc_scores", body=AUC_SQL.replace("FROM scored", "FROM doc_scores")))
def document_auc(spark, sf_dir):
    return rounded(me.roc_auc(scored_documents(spark, sf_dir), "score", "label"), ["auc"])


CURVE = """, curve AS (SELECT score AS threshold, sum(neg) OVER w / nullif(sum(neg) OVER (), 0)::DOUBLE AS fpr,
sum(pos) OVER w / nullif(sum(pos) OVER (), 0)::DOUBLE AS tpr FROM (
SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM doc_scores GROUP BY score)
WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
"""


@plan(
    "roc_curve",
    check_sql("doc_scores", body=CURVE + "SELECT threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM curve"),
)
def roc_curve(spark, sf_dir):
    points = me.roc_points(scored_documents(spark, sf_dir), "score", "label")
    return rounded(points.select("threshold", "fpr", "tpr"), ["fpr", "tpr"])


@plan(
    "youden_threshold",
    check_sql(
        "doc_scores",
        body=CURVE
        + """SELECT threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM curve ORDER BY tpr - fpr DESC, threshold DESC LIMIT 1""",
    ),
)
def youden_threshold(spark, sf_dir):
    points = me.roc_points(scored_documents(spark, sf_dir), "score", "label")
    return rounded(me.youden_threshold(points), ["fpr", "tpr"])


PREDICTED = ", called AS (SELECT label, CASE WHEN distance < 1.0 THEN 1 ELSE 0 END AS pred FROM pair_scores)\n"


def called_pairs(spark, sf_dir):
    pred = F.when(F.col("distance") < 1.0, 1).otherwise(0)
    return pair_scores(spark, sf_dir).select("label", pred.alias("pred"))


@plan(
    "confusion_matrix",
    check_sql(
        "pair_scores",
        body=PREDICTED
        + """SELECT CAST(a AS INTEGER) AS label, CAST(b AS INTEGER) AS pred,
(SELECT count(*) FROM called WHERE label = a AND pred = b) AS n
FROM (SELECT unnest([0, 1]) AS a), (SELECT unnest([0, 1]) AS b)""",
    ),
)
def confusion_matrix(spark, sf_dir):
    return me.confusion_matrix(called_pairs(spark, sf_dir), "label", "pred")


@plan(
    "classification_report",
    check_sql(
        "pair_scores",
        body=PREDICTED
        + """, c AS (SELECT k, count(*) FILTER (label = k AND pred = k) AS hit, count(*) FILTER (label <> k AND pred = k) AS wrong,
count(*) FILTER (label = k AND pred <> k) AS missed, count(*) FILTER (label = pred) AS right_ones, count(*) AS n
FROM called, (SELECT unnest([0, 1]) AS k) GROUP BY k)
SELECT CAST(k AS INTEGER) AS label, round(coalesce(hit / nullif(hit + wrong, 0)::DOUBLE, 0), 6) AS "precision",
round(coalesce(hit / nullif(hit + missed, 0)::DOUBLE, 0), 6) AS recall,
round(coalesce(2 * hit / nullif(2 * hit + wrong + missed, 0)::DOUBLE, 0), 6) AS f1, hit + missed AS support,
round(right_ones / n::DOUBLE, 6) AS accuracy FROM c""",
    ),
)
def classification_report(spark, sf_dir):
    report = me.classification_report(called_pairs(spark, sf_dir), "label", "pred")
    return rounded(report, ["precision", "recall", "f1", "accuracy"])


SWEEP_SQL = """, swept AS (SELECT threshold, tp, called, positives, coalesce(2 * tp / nullif(called + positives, 0)::DOUBLE, 0) AS f1 FROM (
SELECT t AS threshold, sum(CASE WHEN distance < t THEN label ELSE 0 END)::BIGINT AS tp,
count(*) FILTER (distance < t) AS called, sum(label)::BIGINT AS positives
FROM pair_scores, (SELECT 0.1::DOUBLE + 0.05::DOUBLE * i AS t FROM (SELECT unnest(generate_series(0, 57)) AS i)) GROUP BY t))
"""


@plan(
    "f1_threshold_sweep",
    check_sql(
        "pair_scores",
        body=SWEEP_SQL + "SELECT round(threshold, 2) AS threshold, tp, called, positives, round(f1, 6) AS f1 FROM swept",
    ),
)
def f1_threshold_sweep(spark, sf_dir):
    swept = me.f1_threshold_sweep(pair_scores(spark, sf_dir), "distance", "label")
    return swept.withColumns({"threshold": F.round("threshold", 2), "f1": r6("f1")})


@plan(
    "best_f1_threshold",
    check_sql(
        "pair_scores",
        body=SWEEP_SQL
        + "SELECT round(threshold, 2) AS threshold, round(f1, 6) AS f1 FROM swept ORDER BY swept.f1 DESC, swept.threshold LIMIT 1",
    ),
)
def best_f1_threshold(spark, sf_dir):
    best = me.best_f1(me.f1_threshold_sweep(pair_scores(spark, sf_dir), "distance", "label"))
    return best.select(F.round("threshold", 2).alias("threshold"), r6("f1").alias("f1"))


@plan(
    "fixed_threshold",
    """SELECT vec_id, CAST(place - 1 AS INTEGER) AS place, CAST(CASE WHEN embedding[place]::DOUBLE + 0.5 > 0.5 THEN 1 ELSE 0 END AS INTEGER) AS pred
FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS place FROM embeddings)""",
)
def fixed_threshold(spark, sf_dir):
    vectors = adapter.table(spark, sf_dir, "embeddings")
    scores = vectors.select("vec_id", F.posexplode("embedding").alias("place", "value"))
    return scores.select("vec_id", "place", me.fixed_threshold(F.col("value").cast("double") + 0.5).alias("pred"))
