import collections
import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tapeloom.functions import numeric as num
from tapeloom.functions import text as tx
from tapeloom.operators import features as fe
from tapeloom.operators import news as nw


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column.alias("r")).first().r


@pytest.mark.parametrize(
    "raw,clean",
    [
        ("\t a\r\n\r\nb \"q\" \n", "a b 'q'"),
        (" x ", "x"),
        ("a  b", "a  b"),
        ("\n", ""),
        (None, None),
    ],
)
def test_clean_text(spark, raw, clean):
    assert one(spark, tx.clean_text(F.col("v")), raw) == clean


@pytest.mark.parametrize(
    "raw,date",
    [
        ("2020-02-29 10:00:00 UTC", dt.date(2020, 2, 29)),
        ("2021-02-29", None),
        ("2020", None),
        ("2020-1-1", None),
        ("unknown", None),
        (None, None),
    ],
)
def test_article_date(spark, raw, date):
    assert one(spark, tx.article_date(F.col("v")), raw) == date


def test_page_text(spark):
    html = '<p>A &amp;lt; b</p><script>"<p>no</p>"</script><nav><p>no</p></nav><P class="x">c\n<b>d</b></P><pre>no</pre>'
    assert one(spark, tx.page_text(F.col("v")), html) == "A &lt; b c d"
    assert one(spark, tx.page_text(F.col("v")), None) == ""
    assert one(spark, tx.page_text(F.col("v")), "no paragraphs") == ""


def test_softmax_and_score(spark):
    p = one(spark, tx.softmax(F.col("v")), [1000.0, 1000.0, 1000.0], "array<double>")
    assert p == pytest.approx([1 / 3] * 3)
    assert one(spark, tx.sentiment_score(F.col("v")), [0.2, 0.3, 0.5], "array<double>") == pytest.approx(3.6)
    assert one(spark, tx.lexicon_probabilities(F.col("v")), "Gain, gain LOSS x") == pytest.approx([0.25, 0.25, 0.5])


def test_schema_helpers(spark):
    df = spark.createDataFrame([("1", "x", 2)], "`Unnamed: 0` string, a string, b int")
    assert num.enforce_schema(df, ["b", "c"]).dtypes == [("a", "string"), ("b", "string")]
    assert num.coerce_numeric(df, ["a"]).first().a is None
    assert num.prefix_columns(df.select("a", "b"), ["a"]).columns == ["a", "emb_b"]
    with pytest.raises(Exception):
        num.cast_prices(
            df.select(F.lit("s").alias("stock_symbol"), F.lit("2020-01-01").alias("date"),
                      *[F.lit("bad").alias(c) for c in num.PRICE_COLUMNS])
        ).collect()
    assert one(spark, num.finite(F.col("v")), float("nan"), "double") is None
    assert one(spark, num.finite(F.col("v")), float("-inf"), "double") is None
    assert one(spark, num.same_bucket(F.col("v"), F.lit(1)), None, "int") == 0


def news_frame(spark, rows):
    return spark.createDataFrame(rows, "id long, date string, article_title string")


def test_groups_of_ten_and_null_titles(spark):
    day = "1999-05-05 00:00:00 UTC"
    rows = [(i, day, None if i == 3 else f"t{i:03d}") for i in range(23)]
    rows += [(100 + i, "unknown", "u") for i in range(3)] + [(200, "1999-05-06", None)]
    groups = nw.article_groups(news_frame(spark, rows))
    sizes = groups.groupBy("clean_date", "article_group").count()
    assert sorted(r["count"] for r in sizes.collect()) == [1, 3, 3, 10, 10]
    assert groups.where("id = 3").first().rn == 23  # a missing title comes last
    bars = spark.createDataFrame([(dt.date(1999, 5, 5), 7), (dt.date(1999, 5, 6), 8)], "date date, b int")
    batches = nw.title_batches(groups, bars, ["b"])
    texts = {(r.date, r.article_group): r.aggregated_article_title for r in batches.collect()}
    assert texts[dt.date(1999, 5, 6), 0] == ""
    assert texts[None, 0] == "u|u|u"
    assert texts[dt.date(1999, 5, 5), 2] == "t021|t022"
    assert nw.title_batches(groups, bars, ["b"], "inner").count() == 4


def test_days_off_the_calendar_fall_together(spark):
    rows = [(1, "1999-01-01", "a"), (2, "1999-01-02", "b"), (3, "x", "c")]
    bars = spark.createDataFrame([(dt.date(2000, 1, 1), 1)], "date date, b int")
    batches = nw.title_batches(nw.article_groups(news_frame(spark, rows)), bars, ["b"])
    assert [(r.date, r.aggregated_article_title) for r in batches.collect()] == [(None, "c|a|b")]


def test_dedup_before_and_after_rank(spark):
    rows = [(i, "1999-01-01", "same") for i in range(5)] + [(9, "1999-01-01", "other")]
    news = news_frame(spark, rows)
    assert nw.article_groups(news, "random", dedup="after_rank").count() == 6
    assert nw.article_groups(news, "random", dedup="before_rank").count() == 2
    ranks = nw.article_groups(news, "random", seed=1).select("rn").collect()
    assert sorted(r.rn for r in ranks) == [1, 2, 3, 4, 5, 6]


@pytest.mark.parametrize("n", [29, 30, 31])
def test_bag_sizes(spark, n):
    rows = [("s", dt.date(2000, 1, 1), i, [float(i), 1.0]) for i in range(n)]
    df = spark.createDataFrame(rows, "stock_symbol string, date date, id long, embedding array<float>")
    bag = nw.news_bag(df, dim=2).first()
    assert sum(bag.mask) == min(n, 30) and len(bag.bag) == len(bag.mask) == 30
    assert bag.bag[28] == [28.0, 1.0]
    assert bag.bag[29] == ([0.0, 0.0] if n == 29 else [29.0, 1.0])
    empty = nw.pad_bag(F.lit(None).cast("array<struct<v:array<float>>>"), 2, 30)
    row = spark.range(1).select(*empty).first()
    assert sum(row.mask) == 0 and row.bag == [[0.0, 0.0]] * 30


def test_daily_text_parts_make_the_whole(spark):
    rows = [("s", dt.date(2000, 1, 1), i, None if i % 4 == 0 else f"w{i}") for i in range(11)]
    df = spark.createDataFrame(rows, "stock_symbol string, date date, id long, lsa_summary string")
    whole = " ".join(f"w{i}" for i in range(11) if i % 4)
    for size in (1, 3, 1000):
        assert [r.lsa_summary for r in nw.daily_text(df, part_rows=size).collect()] == [whole]
    (kept,) = nw.daily_text(df, nulls="empty").collect()
    assert kept.lsa_summary == " ".join("" if i % 4 == 0 else f"w{i}" for i in range(11))


def test_a_day_of_many_articles_multiplies_no_rows(spark):
    day = dt.date(2000, 1, 3)
    news = spark.range(2500).select(
        F.lit("s").alias("stock_symbol"), F.lit(day).alias("date"), "id", F.concat(F.lit("w"), "id").alias("lsa_summary")
    )
    bars = spark.createDataFrame([("s", day + dt.timedelta(k)) for k in range(-2, 4)], "stock_symbol string, date date")
    rows = nw.carried_text(bars, nw.daily_text(news), "lsa_summary", "none").orderBy("date").collect()
    whole = " ".join(f"w{i}" for i in range(2500))
    assert [r.lsa_summary for r in rows] == ["none"] * 2 + [whole] * 4  # the last known text is carried on


def test_long_texts_are_dealt_out_in_lists(spark, monkeypatch):
    """No task puts out all rows of a day with a long text; rows that come twice, and nulls, are kept as they are."""
    start = dt.date(2000, 1, 1)
    news = [("s", start + dt.timedelta(20 * k), k, c * 3000) for k, c in enumerate("abc")] + [("t", start, 9, "z"), (None, start, 10, "n")]
    news = spark.createDataFrame(news, "stock_symbol string, date date, id long, lsa_summary string")
    days = [(s, start + dt.timedelta(k), k) for s in ("s", "t", None) for k in range(-2, 60)] + [("s", None, -9), ("t", start, 0)]
    days = spark.createDataFrame(days, "stock_symbol string, date date, k long")

    def last(symbol, k):
        return "none" if symbol is None or k < 0 else "z" if symbol == "t" else "abc"[min(k // 20, 2)] * 3000

    for size in (nw.TASK_BYTES, 9000):
        monkeypatch.setattr(nw, "TASK_BYTES", size)
        out = nw.carried_text(days, nw.daily_text(news), "lsa_summary", "none")
        rows = out.withColumn("_task", F.spark_partition_id()).collect()
        assert sorted((str(r.stock_symbol), r.k, r.lsa_summary) for r in rows) == sorted((str(s), k, last(s, k)) for s, _, k in map(tuple, days.collect()))
        most = max(collections.Counter(r._task for r in rows if len(r.lsa_summary) == 3000).values())
    assert most <= 15  # of 60 rows with long texts; by day they would be 20 and more


def test_long_texts_are_stored_in_small_groups(spark, monkeypatch):
    paths, taken = [], nw.staged
    monkeypatch.setattr(nw, "staged", lambda df, *a: paths.extend((out := taken(df, *a)).inputFiles()) or out)
    letters = F.concat_ws("", F.transform(F.sequence(F.lit(1), F.lit(40_000)), lambda k: F.md5(F.concat(F.col("id"), k))))
    texts = spark.range(0, 30, 1, 1).select(F.lit("s").alias("stock_symbol"), F.date_add(F.lit(dt.date(2000, 1, 1)), F.col("id").cast("int")).alias("date"), letters.alias("lsa_summary"))
    stored = nw.stored_texts(texts, "lsa_summary")
    assert {r._bytes for r in stored.select("_bytes").collect()} == {40_000 * 32}
    (path,) = paths
    groups = pq.ParquetFile(path.removeprefix("file://")).metadata
    assert max(groups.row_group(k).num_rows for k in range(groups.num_row_groups)) <= 10  # all 30 before


def test_carried_texts_are_not_shuffled(spark, monkeypatch):
    """Texts are shuffled to their parts and their days; no copy of them is on its way to the rows that carry it."""
    start = dt.date(2000, 1, 1)
    news = [(s, start + dt.timedelta(10 * k), i, f"{s}{k}{i}" * 500) for s in "ab" for k in range(3) for i in range(4)]
    news = spark.createDataFrame(news, "stock_symbol string, date date, id long, lsa_summary string")
    days = [(s, start + dt.timedelta(k), k) for s in "ab" for k in range(-1, 40)]
    days = spark.createDataFrame(days, "stock_symbol string, date date, k long")
    want = {(s, k): " ".join(f"{s}{min(k // 10, 2)}{i}" * 500 for i in range(4)) if k >= 0 else "none" for s in "ab" for k in range(-1, 40)}

    def exchanges(df):
        plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
        lines = plan.splitlines()
        return [x for k, x in enumerate(lines) if "Exchange" in x and "lsa_summary" in " ".join(lines[k + 1 : k + 3])]

    assert len(exchanges(nw.daily_text(news))) == 2
    monkeypatch.setattr(nw, "TASK_BYTES", 30_000)
    for few in (nw.FEW_CARRIED, 0):  # both ways
        monkeypatch.setattr(nw, "FEW_CARRIED", few)
        out = nw.carried_text(days, nw.daily_text(news), "lsa_summary", "none")
        rows = out.withColumn("_task", F.spark_partition_id()).collect()
        assert {(r.stock_symbol, r.k): r.lsa_summary for r in rows} == want and len(rows) == len(want)
        most = max(collections.Counter(r._task for r in rows if r.k >= 0).values())
        assert most <= 10  # of 80 rows of 6,000 letters
        assert bool(exchanges(out)) == (few == 0)


def test_token_pack(spark):
    rows = [("d1", 0, "b a a"), ("d1", 1, "...c!"), ("d2", 0, ""), ("d3", 0, "a " * 50)]
    df = spark.createDataFrame(rows, "doc string, part int, text string")
    vocab = fe.vocabulary(df, "text", 2)
    assert {r.token: r.token_id for r in vocab.collect()} == {"a": 2, "b": 3}
    packed = {r.doc: r for r in fe.token_pack(df, ["doc"], "part", "text", vocab, 5).collect()}
    assert packed["d1"].token_ids == [3, 2, 2, 1, 0] and packed["d1"].mask == [1, 1, 1, 1, 0]
    assert packed["d2"].token_ids == [0] * 5 and packed["d2"].mask == [0] * 5
    assert packed["d3"].token_ids == [2] * 5
