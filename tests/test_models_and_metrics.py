import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapeloom.functions import vectors as vec
from tapeloom.operators import backtest as bt
from tapeloom.operators import embedding as em
from tapeloom.operators import features as fe
from tapeloom.operators import metrics as me
from tapeloom.operators import models as mo
from tapeloom.operators import pairs, stats


def test_pairs_chain_all_rows(spark):
    df = spark.range(57).withColumnRenamed("id", "k")
    got = pairs.adjacent_pairs(df, ["k"], {"k": "k"}).orderBy("rn").collect()
    assert len(got) == 56
    assert all(a.k2 == b.k1 for a, b in zip(got, got[1:]))
    assert len({r.k1 for r in got} | {got[-1].k2}) == 57


def test_single_bin_gives_only_positive_pairs(spark):
    df = spark.range(40).withColumn("bin", F.lit(1))
    got = pairs.sampled_pairs(df, "id", "bin").collect()
    assert len(got) == 40 and {r.label for r in got} == {1}


def test_sampled_pairs_respect_labels(spark):
    df = spark.range(600).withColumn("bin", F.when(F.col("id") % 3 == 0, F.col("id") % 2).otherwise(5))
    got = pairs.sampled_pairs(df, "id", "bin").collect()
    assert len(got) == 600
    assert all((r.bin_1 == r.bin_2) == (r.label == 1) for r in got)
    assert 0.4 < sum(r.label for r in got) / 600 < 0.6


def test_split_sizes(spark):
    df = spark.range(101).withColumn("s", F.when(F.col("id") < 70, "a").otherwise("b"))
    assert pairs.random_split(df, ["id"]).where("split = 'test'").count() == 21
    strata = pairs.stratified_split(df, "id", "s").where("split = 'test'").groupBy("s").count()
    assert {r.s: r["count"] for r in strata.collect()} == {"a": 14, "b": 6}
    assert pairs.random_sample(df, ["id"], 1000).count() == 101


def test_quantiles_like_numpy_with_heavy_ties(spark):
    rng = random.Random(2)
    values = [7.0] * 500 + [rng.uniform(0, 10) for _ in range(333)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    shares = {"a": 0.01, "b": 0.25, "c": 0.5, "d": 0.99, "e": 0.0, "f": 1.0}
    got = stats.quantiles(df, "v", shares).first()
    assert list(got) == pytest.approx([np.quantile(values, p) for p in shares.values()])


def test_describe_and_histogram_borders(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "v double")
    row = stats.describe(df, "v").first()
    assert (row.n, row["mean"], row.lowest, row.highest, row.q50) == (11, 5.0, 0.0, 10.0, 5.0)
    counts = {r.bin: r.n for r in stats.histogram(df, "v", 5).collect()}
    assert counts == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}
    flat = spark.createDataFrame([(1.0,)] * 4, "v double")
    assert [tuple(r) for r in stats.histogram(flat, "v", 5).collect()] == [(0, 4)]


def scored(spark, rows):
    return spark.createDataFrame(rows, "score double, label int")


def test_auc_ties_and_single_class(spark):
    assert me.roc_auc(scored(spark, [(1.0, 0), (1.0, 1), (1.0, 1)]), "score", "label").first().auc == 0.5
    assert me.roc_auc(scored(spark, [(1.0, 1), (2.0, 1)]), "score", "label").first().auc is None
    assert me.roc_auc(scored(spark, [(1.0, 0), (2.0, 1)]), "score", "label").first().auc == 1.0


def test_youden_takes_the_first_best(spark):
    points = me.roc_points(scored(spark, [(4.0, 1), (3.0, 0), (2.0, 1), (1.0, 0)]), "score", "label")
    assert me.youden_threshold(points).first().threshold == 4.0


def test_report_without_calls(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "label int, pred int")
    zero, one = me.classification_report(df, "label", "pred").orderBy("label").collect()
    assert (one.precision, one.recall, one.f1, one.support) == (0.0, 0.0, 0.0, 1)
    assert (zero.precision, zero.recall, zero.accuracy) == (0.5, 1.0, 0.5)
    cells = {(r.label, r.pred): r.n for r in me.confusion_matrix(df, "label", "pred").collect()}
    assert cells == {(0, 0): 1, (0, 1): 0, (1, 0): 1, (1, 1): 0}


def test_sweep_like_a_loop(spark):
    rng = random.Random(8)
    rows = [(rng.uniform(0, 3), rng.randint(0, 1)) for _ in range(200)]
    df = spark.createDataFrame(rows, "d double, label int")
    swept = {r.threshold: r.f1 for r in me.f1_threshold_sweep(df, "d", "label").collect()}
    for t in me.SWEEP:
        tp = sum(1 for d, y in rows if d < t and y)
        wrong = sum(1 for d, y in rows if (d < t) != bool(y))
        assert swept[t] == pytest.approx(2 * tp / (2 * tp + wrong) if tp else 0.0)
    best = me.best_f1(me.f1_threshold_sweep(df, "d", "label")).first()
    assert best.threshold == min(t for t in swept if swept[t] == max(swept.values()))


def predictions(spark, n=40):
    rng = random.Random(4)
    rows = []
    for symbol in ("a", "b"):
        for i in range(n):
            day = dt.date(2020, 1, 1) + dt.timedelta(days=i)
            rows.append((symbol, day, *[round(rng.uniform(0, 1), 1) for _ in range(3)]))
    return spark.createDataFrame(
        rows, "stock_symbol string, date date, prediction double, target double, last_known double"
    ), rows


@pytest.mark.parametrize("long_only", [False, True])
def test_backtest_like_numpy(spark, long_only):
    df, rows = predictions(spark)
    p, t, k = (np.array([r[i] for r in rows]) for i in (2, 3, 4))
    signal, move = np.sign(p[3:] - p[:-3]), np.sign(t - k)[3:]
    if long_only:
        signal = np.where(signal < 0, 0, signal)
    pnl = np.where(signal == 0, 0.0, signal * move) if long_only else signal * move
    hits = signal == np.sign(move)
    accuracy = hits[signal != 0].mean() if long_only else hits.mean()
    results = bt.backtest(df, long_only=long_only)
    got = bt.backtest_summary(results, long_only).first()
    assert (got.n, got.market_total, got.strategy_total) == (77, move.sum(), pnl.sum())
    assert got.accuracy == pytest.approx(accuracy)
    curve = bt.cumulative_pnl(results).orderBy("stock_symbol", "date").collect()
    assert [r.strategy_cum for r in curve] == pytest.approx(list(np.cumsum(pnl)))
    assert bt.backtest(df, scope="symbol").count() == 74


def test_no_signal_means_zero_accuracy(spark):
    df, _ = predictions(spark)
    flat = bt.backtest(df.withColumn("prediction", F.lit(0.5)), long_only=True)
    assert bt.backtest_summary(flat, True).first().accuracy == 0.0


def test_distances_and_losses(spark):
    df = spark.createDataFrame([([1.0, 2.0], [1.0, 2.0], 1)], "a array<float>, b array<float>, y int")
    a, b, y = F.col("a"), F.col("b"), F.col("y")
    assert df.select(vec.euclidean_distance(a, b)).first()[0] == pytest.approx(np.sqrt(1e-7))
    assert df.select(vec.shifted_distance(a, b)).first()[0] == pytest.approx(np.sqrt(2) * 1e-6)
    loss = vec.contrastive_loss(F.lit(0), F.lit(0.25), scale=0.5)
    assert df.select(loss).first()[0] == pytest.approx(0.5 * 0.75**2)
    assert df.select(vec.l2_normalize(F.array(F.lit(0.0)))).first()[0] == [0.0]
    with pytest.raises(ValueError):
        vec.wide_to_array(spark.range(1), ["0", "1"])


def test_attention_ignores_padding(spark):
    schema = "bag array<array<float>>, mask array<int>, q array<double>"
    df = spark.createDataFrame([([[1.0, 0.0], [0.0, 1.0], [9.0, 9.0]], [1, 1, 0], [2.0, 0.0])], schema)
    bag, mask = F.col("bag"), F.col("mask")
    got = df.select(em.attention_pool(bag, bag, mask, F.col("q"), 2)).first()[0]
    w = np.exp(np.array([2.0, 0.0]) / np.sqrt(2))
    assert got == pytest.approx(list(w / w.sum()))
    assert df.select(em.masked_mean_pool(bag, mask, 2)).first()[0] == [0.5, 0.5]


def test_linear_head_like_least_squares(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 3))
    y = x @ [1.0, -2.0, 0.5] + 0.3 + rng.normal(scale=0.1, size=60)
    df = spark.createDataFrame(
        [(i, list(map(float, x[i, :2])), [float(x[i, 2])], float(y[i])) for i in range(60)],
        "id long, a array<double>, b array<double>, y double",
    )
    got = mo.linear_head(df, df, ["a", "b"], "y").orderBy("id").collect()
    design = np.column_stack([x, np.ones(60)])
    fitted = design @ np.linalg.lstsq(design, y, rcond=None)[0]
    assert [r.prediction for r in got] == pytest.approx(list(fitted), abs=1e-6)


def test_isolation_steps_equal_walking_the_trees():
    rng = np.random.default_rng(1)
    sample = np.concatenate([rng.normal(size=300), [40.0, -35.0]])
    leaves = [leaf for t in range(20) for leaf in fe.grown(t, sample, 8, 42)]
    borders, paths = fe.isolation_steps(leaves)
    assert len(paths) == len(borders) + 1
    for value in (-35.0, -1.2, 0.0, 0.7, 40.0):
        own = [path for low, high, path in leaves if low < value <= high]
        assert len(own) == 20 and paths[np.searchsorted(borders, value)] == sum(own)
    assert paths[-1] < paths[np.searchsorted(borders, 0.0)]


def test_short_paths_are_scores_above_the_quantile():
    rng = np.random.default_rng(2)
    for _ in range(200):
        paths, counts = rng.integers(1, 9, size=6), rng.integers(1, 5, size=6)
        rows = np.repeat(-paths.astype(float), counts)
        for share in (0.05, 0.3, 0.5):
            assert list(fe.short_paths(paths, counts, share)) == list(-paths > np.quantile(rows, 1 - share))


def test_outliers_are_the_far_values(spark):
    rng = random.Random(6)
    rows = [(i, rng.gauss(0, 1)) for i in range(950)] + [(1000 + i, 50.0 + 10 * i) for i in range(50)]
    df = spark.createDataFrame(rows, "id long, v double")
    flagged = fe.outlier_flag(df, "v", ["id"])
    bad = {r.id for r in flagged.where("is_outlier = -1").collect()}
    assert 25 <= len(bad) <= 50
    assert len([i for i in bad if i >= 1000]) >= 25
    assert fe.inlier_filter(flagged).count() == 1000 - len(bad)
    gaps = df.unionByName(spark.createDataFrame([(5000 + i, None) for i in range(20)], "id long, v double"))
    got = {r.id: r.is_outlier for r in fe.outlier_flag(gaps, "v", ["id"]).collect()}
    assert all(got[5000 + i] is None for i in range(20)) and {i for i, f in got.items() if f == -1} == bad
    assert fe.outlier_flag(df.limit(0), "v", ["id"]).count() == 0


def test_approximate_quantiles_are_near(spark):
    got = stats.approx_quantiles(spark.range(10_001), "id", {"a": 0.25, "b": 0.99}).first()
    assert abs(got.a - 2500) <= 10 and abs(got.b - 9900) <= 10


def test_text_vectors_have_length_one(spark):
    df = spark.createDataFrame([(0, "a b b"), (1, "B, a b"), (2, ""), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r.embedding for r in em.hashed_text_vectors(df, "text", 16).collect()}
    assert got[0] == got[1] and np.linalg.norm(got[0]) == pytest.approx(1.0)
    assert len(got[2]) == 16 and not any(got[2]) and got[3] == got[2]
