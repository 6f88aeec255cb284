import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tapeloom.operators import series as ts

START = dt.date(2020, 1, 1)


def frame(spark, symbols, schema="open double, close double, volume double"):
    """``symbols``: name -> list of (open, close, volume) by day."""
    rows = [
        (name, START + dt.timedelta(days=i), *bar)
        for name, bars in symbols.items()
        for i, bar in enumerate(bars)
    ]
    return spark.createDataFrame(rows, f"stock_symbol string, date date, {schema}")


def bars(n, seed=1):
    rng = random.Random(seed)
    return [(rng.uniform(5, 9), rng.uniform(5, 9), float(rng.randint(0, 50))) for _ in range(n)]


def test_return_target_like_pandas(spark):
    n = None
    opens = [1.0, n, 3.0, n, n, 6.0, 7.0, n]
    closes = [n, 2.0, n, 0.0, 5.0, n, 7.0, 8.0]
    df = frame(spark, {"a": [(o, c, 1.0) for o, c in zip(opens, closes)]})
    p = pd.DataFrame({"open": opens, "close": closes}, dtype=float)
    before, after = p.close.shift(1).ffill(), p.open.shift(-1).bfill()
    y = ((after - before) / before).replace([np.inf, -np.inf], np.nan)
    expected = [(START + dt.timedelta(days=i), v) for i, v in y.items() if not math.isnan(v)]
    got = [(r.date, r.y) for r in ts.return_target(df).orderBy("date").collect()]
    assert got == expected


def test_changes_guard_a_zero_base(spark):
    df = frame(spark, {"a": [(1.0, 0.0, 0.0), (2.0, 2.0, 5.0), (3.0, 3.0, 7.0)]})
    middle = ts.price_changes(df).orderBy("date").collect()[1]
    assert (middle.volume_delta, middle.volume_change_ratio) == (7.0, None)
    assert middle.open_lead_close_lag_diff == 3.0
    assert middle.open_lead_close_lag_change_pct is None


@pytest.mark.parametrize("n,k", [(23, 10), (10, 10), (3, 10), (100, 7)])
def test_ntile_sizes(spark, n, k):
    df = frame(spark, {"a": [(1.0, 1.0, float(i // 4)) for i in range(n)]})
    got = ts.ntile(df, "volume", "tile", k).groupBy("tile").count().orderBy("tile").collect()
    expected = [n // k + (1 if i < n % k else 0) for i in range(k)]
    assert [r["count"] for r in got] == [e for e in expected if e]


def test_decay_equals_the_recursion_across_the_split(spark):
    rng = random.Random(3)
    scores = [None] * 4 + [rng.choice([None, None, None, rng.uniform(1, 5)]) for _ in range(60)]
    scores[50:] = [None] * len(scores[50:])
    df = frame(spark, {"a": [(s,) for s in scores]}, "score double")
    alpha, current, expected = math.exp(-0.03), 3.0, []
    for s in scores:
        current = alpha * current + (1 - alpha) * 3.0 if s is None else s
        expected.append(current)
    got = [r.filled for r in ts.decay_impute(df, "score", "filled").orderBy("date").collect()]
    assert got == pytest.approx(expected, abs=1e-12)
    assert ts.ALPHA == alpha


def test_ffill_then_constant(spark):
    df = frame(spark, {"a": [(None,), ("x",), (None,)], "b": [(None,)]}, "text string")
    filled = ts.ffill(df, ["text"], {"text": F.lit("")}).orderBy("stock_symbol", "date")
    assert [r.text for r in filled.collect()] == ["", "x", "x", ""]


def test_min_length(spark):
    df = frame(spark, {"a": bars(53), "b": bars(54), "c": bars(55)})
    kept = ts.min_length_filter(df).groupBy("stock_symbol").count().orderBy("stock_symbol")
    assert [tuple(r) for r in kept.collect()] == [("b", 54), ("c", 55)]


@pytest.mark.parametrize("n", [9, 10, 264, 301])
def test_split_is_int_of_share(spark, n):
    rows = ts.chrono_split(frame(spark, {"a": bars(n)})).result()
    assert rows.where("split = 'train'").count() == int(n * 0.8)
    assert rows.where("split = 'train'").agg(F.max("pos")).first()[0] == int(n * 0.8) - 1


def test_windows_stay_inside_symbol_and_split(spark):
    sizes = {"a": 270, "b": 60, "c": 300}
    df = frame(spark, {name: bars(n, n) for name, n in sizes.items()})
    rows = ts.minmax_per_symbol(ts.chrono_split(df), ["open", "close", "volume"])
    windows = ts.sliding_sequences(rows, ["open_scaled", "close_scaled"], "close_scaled")
    got = {(r[0], r[1]): r[2] for r in windows.groupBy("stock_symbol", "split").count().collect()}
    expected = {}
    for name, n in sizes.items():
        train = int(n * 0.8)
        for split, m in (("train", train), ("test", n - train)):
            if m - 52 > 0:
                expected[name, split] = m - 52
    assert got == expected
    assert windows.where(F.size("window.close_scaled") != 50).count() == 0
    prices = [c for _, c, _ in bars(270, 270)]
    low, high = min(prices[:216]), max(prices[:216])
    first = windows.where("stock_symbol = 'a' and split = 'test'").orderBy("end_pos").first()
    assert first.end_pos == 216 + 49
    assert first.target == pytest.approx((prices[216 + 52] - low) / (high - low))
    assert first.window.close_scaled[0] == pytest.approx((prices[216] - low) / (high - low), rel=1e-6)


def test_constant_column_scales_to_zero_and_back(spark):
    df = frame(spark, {"a": [(2.0, 4.0, 1.0)] * 10})
    row = ts.minmax_per_symbol(ts.chrono_split(df), ["close"]).result().first()
    assert row.close_scaled == 0.0
    back = ts.inverse_scale(F.lit(row.close_scaled), F.lit(row.close_min), F.lit(row.close_max))
    assert spark.range(1).select(back).first()[0] == 4.0


def test_sequential_split_and_sample_numbers(spark):
    df = frame(spark, {"b": bars(7), "a": bars(6)})
    split = ts.sequential_split(df).orderBy("row_idx").collect()
    assert [r.split for r in split] == ["train"] * 10 + ["test"] * 3
    assert [r.stock_symbol for r in split] == ["a"] * 6 + ["b"] * 7
    samples = df.withColumn("end_pos", F.datediff("date", F.lit(START)))
    got = ts.sample_index(samples.select("stock_symbol", "end_pos")).orderBy("sample_id").collect()
    assert [r.offset for r in got] == [*range(6), *range(7)]
    assert [tuple(r) for r in ts.symbol_index(df).orderBy("symbol_idx").collect()] == [("a", 0), ("b", 1)]
