"""Segmented windows must equal plain windows, also with one hot group."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tapeloom.functions.keys import random_key
from tapeloom.operators.pairs import sampled_pairs
from tapeloom.operators.timeline import SEGMENT, Timeline

START = dt.date(2000, 1, 1)


@pytest.fixture(scope="module")
def hot(spark):
    """One symbol with 95 % of 2,000 rows, gaps in time and missing values."""
    rng = random.Random(5)
    rows, day = [], 0
    for i in range(2000):
        day += rng.choice([1, 1, 1, 2, 3, 40])
        symbol = "hot" if rng.random() < 0.95 else rng.choice("abc")
        value = None if rng.random() < 0.6 else float(rng.randint(0, 5))
        rows.append((i, symbol, START + dt.timedelta(days=day), value))
    return spark.createDataFrame(rows, "id long, stock_symbol string, date date, v double").cache()


def collected(df, *columns):
    return sorted(df.select("id", *columns).collect())


def plain(df, columns):
    return df.select("id", *[c.alias(n) for n, c in columns.items()])


def test_annotate_equals_whole_group_windows(hot):
    cut = Timeline.by_date(hot, ("stock_symbol",), "date", days=64)
    assert cut.df.groupBy("stock_symbol", SEGMENT).count().agg(F.max("count")).first()[0] <= 64
    got = cut.annotate(
        position="pos",
        total="n",
        running={"run": F.col("v")},
        last={"last": F.col("v")},
        previous={"prev": F.col("v")},
        following={"next": F.col("v")},
        totals={"low": ("min", F.col("v")), "all": ("sum", F.col("v"))},
    ).result()
    w = Window.partitionBy("stock_symbol").orderBy("date")
    every = Window.partitionBy("stock_symbol")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    expected = plain(
        hot,
        {
            "pos": F.row_number().over(w) - 1,
            "n": F.count("id").over(every),
            "run": F.sum("v").over(upto),
            "last": F.last("v", True).over(upto),
            "prev": F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, -1)),
            "next": F.first("v", True).over(w.rowsBetween(1, Window.unboundedFollowing)),
            "low": F.min("v").over(every),
            "all": F.sum("v").over(every),
        },
    )
    assert collected(got, *expected.columns[1:]) == collected(expected, *expected.columns[1:])


@pytest.mark.parametrize("block", [1, 7, 4096])
def test_around_equals_lag_and_lead(hot, block):
    rows = Timeline.by_date(hot, ("stock_symbol",), "date").annotate(position="pos")

    def look(w):
        return {
            "lag3": F.lag("v", 3).over(w),
            "lead2": F.lead("v", 2).over(w),
            "near": F.collect_list("id").over(w.rowsBetween(-3, 0)),
        }

    got = rows.around(3, 2, look, block=block)
    expected = plain(hot, look(Window.partitionBy("stock_symbol").orderBy("date")))
    assert got.count() == hot.count()
    assert collected(got, "lag3", "lead2", "near") == collected(expected, "lag3", "lead2", "near")


def test_range_cut_splits_ties_by_the_tie_break(hot):
    same = hot.withColumn("m", F.lit(1.0))
    rows = Timeline.by_range(same, (), ("m", "id"))
    got = rows.annotate(position="pos").result()
    assert [p for _, p in collected(got, "pos")] == list(range(2000))


def test_hash_and_id_cuts_number_all_rows(hot):
    keyed = hot.withColumn("key", random_key("id"))
    by_hash = Timeline.by_hash(keyed, (), "key", "id", buckets=16).annotate(position="pos").result()
    order = [r.id for r in by_hash.orderBy("pos").collect()]
    assert order == [r.id for r in keyed.orderBy("key", "id").collect()]
    by_id = Timeline.by_id(hot, (), "id", segments=9).annotate(position="pos", total="n").result()
    assert collected(by_id, "pos", "n") == [(i, i, 2000) for i in range(2000)]


def test_bounds_only_steer_the_work(hot):
    counted = hot.where("v is not null").groupBy("v").agg(F.count("id").alias("n"))
    for bounds in ([], [1.0, 1.5, 4.0], [100.0]):
        rows = Timeline.by_bounds(counted, (), "v", bounds)
        got = rows.annotate(running={"upto": F.col("n")}).result().orderBy("v").collect()
        assert got[-1].upto == hot.where("v is not null").count()
        assert all(a.upto < b.upto for a, b in zip(got, got[1:]))


def test_rows_without_a_date_are_kept(spark):
    rows = [(1, "a", None), (2, "a", START), (3, "a", START + dt.timedelta(days=900))]
    df = spark.createDataFrame(rows, "id long, g string, date date")
    got = Timeline.by_date(df, ("g",), "date").annotate(position="pos").result()
    assert collected(got, "pos") == [(1, 0), (2, 1), (3, 2)]


def test_rows_of_a_null_group_are_kept(spark):
    rows = [(i, None if i % 2 else "a") for i in range(20)]
    df = spark.createDataFrame(rows, "id long, g string")
    got = Timeline.by_id(df, ("g",), "id", segments=7).annotate(position="pos", total="n").result()
    assert collected(got, "pos", "n") == [(i, i // 2, 10) for i in range(20)]
    small = df.withColumn("g", F.when(F.col("g").isNotNull(), F.lit(1).cast("smallint")))
    got = Timeline.by_id(small, ("g",), "id", segments=7).annotate(position="pos").result()
    assert collected(got, "pos") == [(i, i // 2) for i in range(20)]


def test_empty_strings_and_nulls_are_different_groups(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, None)], "id long, g string")
    got = Timeline.by_id(df, ("g",), "id").annotate(position="pos", total="n").result()
    assert collected(got, "pos", "n") == [(1, 0, 2), (2, 0, 1), (3, 1, 2)]


def test_ids_far_apart_give_few_segments(spark):
    df = spark.range(4000).select((F.xxhash64("id") % (1 << 60)).alias("k"), F.lit("s").alias("g"))
    rows = Timeline.by_id(df, ("g",), "k", segments=12)
    assert rows.df.select(SEGMENT).distinct().count() <= 12
    got = rows.annotate(position="p").result().orderBy("k").collect()
    assert [r.p for r in got] == list(range(4000))


def test_partners_among_many_bins(spark):
    df = spark.range(20_000).select("id", (F.col("id") % 10_000).alias("bin"))
    pairs = sampled_pairs(df, "id", "bin")
    row = pairs.agg(
        F.count("*").alias("n"),
        F.count(F.when((F.col("bin_1") == F.col("bin_2")) != (F.col("label") == 1), 1)).alias("wrong"),
        F.avg("label").alias("share"),
    ).first()
    assert row.n == 20_000 and row.wrong == 0 and 0.48 < row.share < 0.52
