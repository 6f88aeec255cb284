"""Daily aggregates, summaries and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapeloom.operators import stats
from tapeloom.operators.news import daily_mean, daily_mean_embedding, daily_text, news_bag
from tapeloom.operators.series import SYMBOL, chrono_split, return_target
from tapeloom.plans.projections import gappy_prices
from tapeloom.plans.registry import places, plan, r6, steps
from tapeloom.plans.series import LENGTH_SCORES, scored_prices
from tapeloom.plans.sql import check_sql
from tapeloom.plans.vectors import LEXICON_SQL, lexicon_scores
from tapeloom.sources import adapter

KEYS = ["stock_symbol", "date"]


@plan(
    "daily_mean_sentiment",
    check_sql(
        "dated",
        body=LEXICON_SQL
        + """SELECT stock_symbol, date, round(avg(score), 6) AS score FROM scored GROUP BY stock_symbol, date""",
    ),
)
def daily_mean_sentiment(spark, sf_dir):
    return daily_mean(lexicon_scores(spark, sf_dir), "score").withColumn("score", r6("score"))


@plan(
    "daily_mean_embedding",
    check_sql(
        "elements",
        body="""SELECT stock_symbol, date, CAST(place AS INTEGER) AS place, round(avg(x), 6) AS value
FROM elements GROUP BY stock_symbol, date, place""",
    ),
)
def daily_vectors(spark, sf_dir):
    return places(daily_mean_embedding(adapter.vectors(spark, sf_dir)), KEYS, "embedding")


@plan(
    "daily_text",
    check_sql(
        "dated",
        body="""SELECT stock_symbol, date, string_agg(lsa_summary, ' ' ORDER BY id) AS lsa_summary FROM dated GROUP BY 1, 2""",
    ),
)
def daily_texts(spark, sf_dir):
    return daily_text(adapter.dated_news(spark, sf_dir))


@plan(
    "daily_text_empty",
    check_sql(
        "dated",
        body="""SELECT stock_symbol, date, string_agg(CASE WHEN id % 5 = 0 THEN '' ELSE lsa_summary END, ' ' ORDER BY id)
AS lsa_summary FROM dated GROUP BY 1, 2""",
    ),
)
def daily_texts_with_gaps(spark, sf_dir):
    """Missing texts count as empty ones; the days are put together from parts of three."""
    news = adapter.dated_news(spark, sf_dir)
    gappy = news.withColumn("lsa_summary", F.when(F.col("id") % 5 != 0, F.col("lsa_summary")))
    return daily_text(gappy, nulls="empty", part_rows=3)


@plan(
    "news_bag",
    check_sql(
        "vectors",
        body="""SELECT stock_symbol, date, item, CAST(CASE WHEN id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS mask,
coalesce(array_to_string(list_transform(embedding, lambda x: CAST(round(x::DOUBLE * 1000000) AS BIGINT)), ','),
repeat('0,', 63) || '0') AS vector
FROM (SELECT stock_symbol, date, CAST(unnest(generate_series(0, 29)) AS INTEGER) AS item
FROM (SELECT DISTINCT stock_symbol, date FROM vectors))
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY stock_symbol, date ORDER BY id) - 1 AS item FROM vectors) v
USING (stock_symbol, date, item)""",
    ),
)
def news_bags(spark, sf_dir):
    bags = news_bag(adapter.vectors(spark, sf_dir))
    items = bags.select(*KEYS, F.posexplode(F.arrays_zip("bag", "mask")).alias("item", "e"))
    return items.select(
        *KEYS,
        "item",
        F.col("e.mask").alias("mask"),
        steps(F.col("e.bag")).alias("vector"),
    )


@plan(
    "max_group_size",
    check_sql(
        "dated",
        body="SELECT max(n) AS max_group_size FROM (SELECT count(*) AS n FROM dated GROUP BY stock_symbol, date)",
    ),
)
def max_group_size(spark, sf_dir):
    return stats.max_group_size(adapter.dated_news(spark, sf_dir), KEYS)


@plan(
    "coverage_stats",
    check_sql(
        "prices",
        "dated",
        body=LENGTH_SCORES
        + """ SELECT stock_symbol, count(*) AS n_rows, count(sentiment) AS n_known,
round(count(sentiment) * 100.0::DOUBLE / count(*), 6) AS pct_known
FROM prices LEFT JOIN daily USING (stock_symbol, date) GROUP BY ROLLUP (stock_symbol)""",
    ),
)
def coverage_stats(spark, sf_dir):
    covered = stats.coverage_stats(scored_prices(spark, sf_dir), "sentiment")
    return covered.withColumn("pct_known", r6(F.col("pct_known").cast("double")))


QS = {"q01": 0.01, "q25": 0.25, "q33": 0.33, "q66": 0.66, "q75": 0.75, "q99": 0.99}


@plan(
    "quantiles",
    check_sql(
        "targets",
        body="SELECT "
        + ", ".join(f"round(quantile_cont(y, {p}), 6) AS {name}" for name, p in QS.items())
        + " FROM targets",
    ),
)
def target_quantiles(spark, sf_dir):
    found = stats.quantiles(return_target(gappy_prices(spark, sf_dir)), "y", QS)
    return found.select(*[r6(name).alias(name) for name in QS])


@plan(
    "quantiles_by_group",
    "SELECT l_returnflag, "
    + ", ".join(f"round(quantile_cont(l_extendedprice, {p}), 6) AS {name}" for name, p in QS.items())
    + " FROM lineitem GROUP BY l_returnflag",
)
def quantiles_by_group(spark, sf_dir):
    items = adapter.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice")
    found = stats.quantiles(items, "l_extendedprice", QS, ("l_returnflag",))
    return found.select("l_returnflag", *[r6(name).alias(name) for name in QS])


@plan(
    "describe",
    check_sql(
        "targets",
        body="""SELECT count(y) AS n, round(avg(y), 6) AS mean, round(stddev_samp(y), 6) AS std, round(min(y), 6) AS lowest,
round(max(y), 6) AS highest, round(quantile_cont(y, 0.25), 6) AS q25, round(quantile_cont(y, 0.5), 6) AS q50,
round(quantile_cont(y, 0.75), 6) AS q75 FROM targets""",
    ),
)
def describe_targets(spark, sf_dir):
    # The target feeds both the summary and the quantiles.
    summary = stats.describe(return_target(gappy_prices(spark, sf_dir)), "y")
    return summary.select("n", *[r6(c).alias(c) for c in summary.columns if c != "n"])


HISTOGRAM = """SELECT {keys}CAST(least(floor(({v} - lo) / nullif((hi - lo) / {n}, 0)), {n} - 1) AS INTEGER) AS bin, count(*) AS n
FROM (SELECT {keys}{v}, min({v}) OVER ({over}) AS lo, max({v}) OVER ({over}) AS hi FROM {source}) GROUP BY ALL"""


@plan("histogram", HISTOGRAM.format(keys="", v="o_totalprice", n=50, over="", source="orders"))
def price_histogram(spark, sf_dir):
    return stats.histogram(adapter.table(spark, sf_dir, "orders"), "o_totalprice", 50)


@plan(
    "histogram_by_symbol",
    check_sql(
        "prices",
        body=HISTOGRAM.format(
            keys="stock_symbol, ", v="volume", n=30, over="PARTITION BY stock_symbol", source="prices"
        ),
    ),
)
def histogram_by_symbol(spark, sf_dir):
    return stats.histogram(adapter.bars(spark, sf_dir), "volume", 30, (SYMBOL,))


@plan("value_counts", "SELECT label % 3 AS bin, count(*) AS n FROM embeddings GROUP BY 1 ORDER BY n DESC, bin")
def value_counts(spark, sf_dir):
    bins = adapter.table(spark, sf_dir, "embeddings").select((F.col("label") % 3).alias("bin"))
    return stats.value_counts(bins, "bin")


@plan(
    "distinct_symbols",
    check_sql(
        "split_prices",
        body="SELECT stock_symbol, bool_or(split = 'test') AS in_test FROM split_prices GROUP BY stock_symbol",
    ),
)
def distinct_symbols(spark, sf_dir):
    rows = chrono_split(adapter.bars(spark, sf_dir).select(*KEYS)).result()
    return rows.groupBy("stock_symbol").agg(F.bool_or(F.col("split") == "test").alias("in_test"))


@plan(
    "approx_quantiles",
    "SELECT q, (SELECT count(*) FROM orders) AS n, true AS near FROM (VALUES "
    + ", ".join(f"('{name}')" for name in QS)
    + ") AS t(q)",
)
def approx_quantiles(spark, sf_dir):
    """Each estimate's rank, counted in the table, lies within one part in the sketch's accuracy."""
    orders = adapter.table(spark, sf_dir, "orders")
    found = stats.approx_quantiles(orders, "o_totalprice", QS).first()
    value = F.col("o_totalprice")
    ranks = [
        F.struct(
            F.lit(name).alias("q"),
            F.count("*").alias("n"),
            (
                (F.count(F.when(value < found[name], 1)) <= F.count("*") * (q + 1e-3) + 1)
                & (F.count(F.when(value <= found[name], 1)) >= F.count("*") * (q - 1e-3) - 1)
            ).alias("near"),
        )
        for name, q in QS.items()
    ]
    return orders.agg(F.array(*ranks).alias("r")).select(F.explode("r").alias("e")).select("e.*")
