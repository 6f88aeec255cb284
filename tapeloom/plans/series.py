"""Windows over price series: changes, deciles, fills, splits, sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapeloom.operators import series as ts
from tapeloom.operators.features import token_pack, vocabulary
from tapeloom.operators.joins import left_features
from tapeloom.operators.news import carried_day, daily_mean, daily_mean_embedding, daily_text, stored_texts, text_of_day
from tapeloom.operators.timeline import Timeline
from tapeloom.plans.projections import gappy_prices
from tapeloom.plans.registry import millionths, plan, r6, steps
from tapeloom.plans.sql import check_sql
from tapeloom.session import staged
from tapeloom.sources import adapter

KEYS = ["stock_symbol", "date"]
PRICE_FEATURES = ["open", "close", "volume"]


@plan("volume_delta", check_sql("changes", body="SELECT stock_symbol, date, volume_delta FROM changes"))
def volume_delta(spark, sf_dir):
    return ts.price_changes(adapter.bars(spark, sf_dir)).select(*KEYS, "volume_delta")


@plan(
    "volume_change_ratio",
    check_sql(
        "changes", body="SELECT stock_symbol, date, round(volume_change_ratio, 6) AS volume_change_ratio FROM changes"
    ),
)
def volume_change_ratio(spark, sf_dir):
    changes = ts.price_changes(adapter.bars(spark, sf_dir))
    return changes.select(*KEYS, r6("volume_change_ratio").alias("volume_change_ratio"))


@plan(
    "open_lead_close_lag",
    check_sql(
        "changes",
        body="""SELECT stock_symbol, date, round(open_lead_close_lag_diff, 6) AS diff,
round(open_lead_close_lag_change_pct, 6) AS pct FROM changes""",
    ),
)
def open_lead_close_lag(spark, sf_dir):
    changes = ts.price_changes(adapter.bars(spark, sf_dir))
    return changes.select(
        *KEYS,
        r6("open_lead_close_lag_diff").alias("diff"),
        r6("open_lead_close_lag_change_pct").alias("pct"),
    )


BUCKETS = ["volume_delta_decile_bucket", "volume_change_ratio_decile_bucket"]


@plan(
    "decile_bucket",
    check_sql("deciles", body=f"SELECT stock_symbol, date, {', '.join(BUCKETS)} FROM deciles"),
)
def decile_bucket(spark, sf_dir):
    changes = ts.price_changes(adapter.prices(spark, sf_dir))
    return ts.decile_buckets(changes).select(*KEYS, *BUCKETS)


@plan(
    "decile_bucket_pooled",
    "SELECT o_orderkey, CAST(ntile(10) OVER (ORDER BY o_totalprice, o_orderkey) AS INTEGER) AS bucket FROM orders",
)
def decile_bucket_pooled(spark, sf_dir):
    orders = adapter.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    tiled = ts.ntile(orders, "o_totalprice", "bucket", 10, (), ("o_orderkey",))
    return tiled.select("o_orderkey", "bucket")


@plan(
    "return_target",
    check_sql(
        "targets",
        body="SELECT date, stock_symbol, close_t_minus_1, open_t_plus_1, round(y, 6) AS y FROM targets",
    ),
)
def return_targets(spark, sf_dir):
    return ts.return_target(gappy_prices(spark, sf_dir)).withColumn("y", r6("y"))


@plan(
    "ffill",
    check_sql(
        "gappy",
        body="""SELECT stock_symbol, date, last_value(open IGNORE NULLS) OVER w AS open,
coalesce(last_value(close IGNORE NULLS) OVER w, 0.0) AS close FROM gappy
WINDOW w AS (PARTITION BY stock_symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    ),
)
def filled_prices(spark, sf_dir):
    return ts.ffill(gappy_prices(spark, sf_dir), ["open", "close"], {"close": F.lit(0.0)})


LENGTH_SCORES = """, daily AS (SELECT stock_symbol, date, avg(length(lsa_summary) % 5 + 1) AS sentiment FROM dated GROUP BY 1, 2)"""


def scored_prices(spark, sf_dir):
    news = adapter.dated_news(spark, sf_dir).select(
        *KEYS, (F.length("lsa_summary") % 5 + 1).alias("sentiment")
    )
    prices = adapter.bars(spark, sf_dir).select(*KEYS, "close")
    return left_features(prices, daily_mean(news, "sentiment"), KEYS)


@plan(
    "decay_impute",
    check_sql(
        "prices",
        "dated",
        body=LENGTH_SCORES
        + """, p AS (SELECT stock_symbol, date, sentiment, row_number() OVER (PARTITION BY stock_symbol ORDER BY date) AS pos
FROM prices LEFT JOIN daily USING (stock_symbol, date)),
c AS (SELECT *, last_value(CASE WHEN sentiment IS NOT NULL THEN pos END IGNORE NULLS) OVER w AS seen,
last_value(sentiment IGNORE NULLS) OVER w AS v FROM p
WINDOW w AS (PARTITION BY stock_symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT stock_symbol, date, round(coalesce(sentiment, 3 + pow(exp(-0.03::DOUBLE), pos - seen) * (v - 3), 3), 6) AS sentiment FROM c""",
    ),
)
def decayed_sentiment(spark, sf_dir):
    filled = ts.decay_impute(scored_prices(spark, sf_dir), "sentiment", "filled")
    return filled.select(*KEYS, r6("filled").alias("sentiment"))


@plan(
    "horizon_label",
    check_sql(
        "prices",
        body="""SELECT * FROM (SELECT stock_symbol, date, close,
lead(close, 3) OVER (PARTITION BY stock_symbol ORDER BY date) AS label FROM prices) WHERE label IS NOT NULL""",
    ),
)
def horizon_labels(spark, sf_dir):
    return ts.horizon_label(adapter.bars(spark, sf_dir).select(*KEYS, "close"))


@plan("chrono_split", check_sql("split_prices", body="SELECT stock_symbol, date, pos, split FROM split_prices"))
def split_prices(spark, sf_dir):
    return ts.chrono_split(adapter.bars(spark, sf_dir).select(*KEYS)).result()


@plan(
    "sequential_split",
    check_sql(
        "prices",
        body="""SELECT stock_symbol, date, row_idx, CASE WHEN row_idx < floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split
FROM (SELECT stock_symbol, date, row_number() OVER (ORDER BY stock_symbol, date) - 1 AS row_idx, count(*) OVER () AS n FROM prices)""",
    ),
)
def sequentially_split(spark, sf_dir):
    return ts.sequential_split(adapter.bars(spark, sf_dir).select(*KEYS))


def scaled_rows(spark, sf_dir):
    prices = adapter.bars(spark, sf_dir).select(*KEYS, *PRICE_FEATURES)
    return ts.minmax_per_symbol(ts.chrono_split(prices), PRICE_FEATURES)


def coded(values: str) -> str:
    """SQL for a list of numbers as text, in millionths."""
    return f"array_to_string(list_transform({values}, lambda x: CAST(round(x * 1000000) AS BIGINT)), ',')"


WINDOW_SQL = """, f AS (SELECT stock_symbol, date, split, pos, CAST(open_scaled AS FLOAT)::DOUBLE AS o,
CAST(close_scaled AS FLOAT)::DOUBLE AS c, CAST(volume_scaled AS FLOAT)::DOUBLE AS v, close_scaled FROM scaled),
cut AS (SELECT stock_symbol, date, split, pos AS end_pos, row_number() OVER w - 1 AS in_part,
lead(close_scaled, 3) OVER w AS target, list(o) OVER l AS os, list(c) OVER l AS cs, list(v) OVER l AS vs
FROM f WINDOW w AS (PARTITION BY stock_symbol, split ORDER BY date),
l AS (PARTITION BY stock_symbol, split ORDER BY date ROWS BETWEEN 49 PRECEDING AND CURRENT ROW))"""


@plan(
    "sliding_sequences",
    check_sql(
        "scaled",
        body=WINDOW_SQL
        + f""" SELECT stock_symbol, date, split, end_pos, round(target, 6) AS target, CAST(len(cs) AS INTEGER) AS steps,
{coded('os')} AS open_steps, {coded('cs')} AS close_steps, {coded('vs')} AS volume_steps FROM cut WHERE in_part >= 49 AND target IS NOT NULL""",
    ),
)
def price_sequences(spark, sf_dir):
    rows = scaled_rows(spark, sf_dir)
    windows = ts.sliding_sequences(rows, [f"{c}_scaled" for c in PRICE_FEATURES], "close_scaled")
    return windows.select(
        *KEYS,
        "split",
        "end_pos",
        r6("target").alias("target"),
        F.size("window.close_scaled").alias("steps"),
        *[steps(F.col(f"window.{c}_scaled")).alias(f"{c}_steps") for c in PRICE_FEATURES],
    )


TOKENS = r"list_filter(regexp_split_to_array(lower({0}), '[^\p{{L}}]+'), lambda t: t <> '')"
VOCAB_SQL = f"""vocab AS (SELECT token, row_number() OVER (ORDER BY n DESC, token) + 1 AS token_id FROM (
SELECT token, count(*) AS n FROM (SELECT unnest({TOKENS.format('text')}) AS token FROM documents) GROUP BY token
ORDER BY n DESC, token LIMIT 5000))"""


@plan(
    "multimodal_sequences",
    check_sql(
        "scaled",
        "dated",
        body=f""", {VOCAB_SQL},
words AS (SELECT stock_symbol, date, id, unnest({TOKENS.format('lsa_summary')}) AS token,
generate_subscripts({TOKENS.format('lsa_summary')}, 1) AS place FROM dated),
led AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stock_symbol, date ORDER BY id, place) AS rn FROM words)
WHERE rn <= 32),
packed AS (SELECT stock_symbol, date, string_agg(coalesce(token_id, 1), ' ' ORDER BY rn) AS ids, count(*) AS n
FROM led LEFT JOIN vocab USING (token) GROUP BY 1, 2),
carried AS (SELECT s.*, last_value(p.date IGNORE NULLS) OVER (PARTITION BY s.stock_symbol
ORDER BY s.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS text_date
FROM scaled s LEFT JOIN (SELECT DISTINCT stock_symbol, date FROM dated) p USING (stock_symbol, date)),
joined AS (SELECT c.*, coalesce(p.ids, '') AS ids, coalesce(p.n, 0) AS n FROM carried c
LEFT JOIN packed p ON p.stock_symbol = c.stock_symbol AND p.date = c.text_date)
SELECT stock_symbol, date, split, end_pos, round(target, 6) AS target, open_steps, close_steps, volume_steps, ids, masks FROM (
SELECT stock_symbol, date, split, pos AS end_pos, lead(close_scaled, 3) OVER w AS target, row_number() OVER w - 1 AS in_part,
{', '.join(f"string_agg(CAST(round(CAST({c}_scaled AS FLOAT)::DOUBLE * 1000000) AS BIGINT), ',') OVER l AS {c}_steps" for c in PRICE_FEATURES)},
string_agg(ids, ';') OVER l AS ids, string_agg(n, ',') OVER l AS masks FROM joined
WINDOW w AS (PARTITION BY stock_symbol, split ORDER BY date),
l AS (PARTITION BY stock_symbol, split ORDER BY date ROWS BETWEEN 49 PRECEDING AND CURRENT ROW))
WHERE in_part >= 49 AND target IS NOT NULL""",
    ),
)
def multimodal_sequences(spark, sf_dir):
    news = adapter.dated_news(spark, sf_dir, spread=True)
    vocab = vocabulary(adapter.texts(spark, sf_dir, "documents", "doc_id"), "text")
    packed = token_pack(news, KEYS, "id", "lsa_summary", vocab)
    days = news.select(*KEYS).distinct().withColumn("_has", F.lit(True))
    rows = left_features(scaled_rows(spark, sf_dir).result(), days, KEYS)
    dated = ts.ffill_key(rows, F.col("_has").isNotNull(), "text_date").drop("_has")
    # ids and mask of a day as texts: padding is cut off, the mask is the number of ones
    daily = packed.select(
        "stock_symbol",
        F.col("date").alias("text_date"),
        F.array_join(F.array_remove("token_ids", 0), " ").alias("ids"),
        F.aggregate("mask", F.lit(0), lambda a, m: a + m).cast("string").alias("masks"),
    )
    whole = ts.with_daily(dated, daily, "text_date", ["ids", "masks"], {"ids": F.lit(""), "masks": F.lit("0")})
    coded_steps = {f"{c}_steps": millionths(F.col(f"{c}_scaled").cast("float")) for c in PRICE_FEATURES}
    features = [*coded_steps, "ids", "masks"]
    timeline = Timeline.by_date(whole.withColumns(coded_steps), ("stock_symbol",), "date")
    windows = ts.sliding_sequences(timeline, features, "close_scaled")
    return windows.select(
        *KEYS,
        "split",
        "end_pos",
        r6("target").alias("target"),
        *[F.array_join(f"window.{c}", ";" if c == "ids" else ",").alias(c) for c in features],
    )


@plan(
    "last_day_text_sequences",
    check_sql(
        "scaled",
        "dated",
        body=""", texts AS (SELECT stock_symbol, date, string_agg(coalesce(lsa_summary, ''), ' ' ORDER BY id) AS text
FROM dated GROUP BY 1, 2),
filled AS (SELECT s.*, coalesce(last_value(t.text IGNORE NULLS) OVER (PARTITION BY s.stock_symbol ORDER BY s.date
ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'neutral market update') AS text
FROM scaled s LEFT JOIN texts t USING (stock_symbol, date))
SELECT stock_symbol, date, split, end_pos, round(target, 6) AS target, close_steps, text FROM (
SELECT stock_symbol, date, split, pos AS end_pos, lead(close_scaled, 3) OVER w AS target, row_number() OVER w - 1 AS in_part,
string_agg(CAST(round(CAST(close_scaled AS FLOAT)::DOUBLE * 1000000) AS BIGINT), ',') OVER l AS close_steps, text FROM filled
WINDOW w AS (PARTITION BY stock_symbol, split ORDER BY date),
l AS (PARTITION BY stock_symbol, split ORDER BY date ROWS BETWEEN 49 PRECEDING AND CURRENT ROW))
WHERE in_part >= 49 AND target IS NOT NULL""",
    ),
)
def last_day_text_sequences(spark, sf_dir):
    rows = scaled_rows(spark, sf_dir)
    windows = ts.sliding_sequences(rows, ["close_scaled"], "close_scaled")
    texts = stored_texts(daily_text(adapter.dated_news(spark, sf_dir), nulls="empty"), "lsa_summary")
    dated = windows.join(carried_day(rows.df.select(*KEYS), texts), KEYS).select(
        *KEYS,
        "split",
        "end_pos",
        r6("target").alias("target"),
        steps(F.col("window.close_scaled")).alias("close_steps"),
        "_text_date",
    )
    return text_of_day(dated, texts, "lsa_summary", "neutral market update").withColumnRenamed("lsa_summary", "text")


@plan(
    "embedding_sequences",
    check_sql(
        "scaled",
        "elements",
        body=""", daily AS (SELECT stock_symbol, date, place, avg(x) AS x FROM elements GROUP BY 1, 2, 3),
vectors_of_day AS (SELECT stock_symbol, date, string_agg(CAST(round(CAST(x AS FLOAT)::DOUBLE * 1000) AS BIGINT), ',' ORDER BY place) AS v
FROM daily GROUP BY 1, 2),
filled AS (SELECT s.*, coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY s.stock_symbol ORDER BY s.date
ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), repeat('0,', 63) || '0') AS vec
FROM scaled s LEFT JOIN vectors_of_day USING (stock_symbol, date)),
parts AS (SELECT stock_symbol FROM scaled GROUP BY 1
HAVING least(count(*) FILTER (split = 'train'), count(*) FILTER (split = 'test')) > 53)
SELECT stock_symbol, date, split, end_pos, round(target, 6) AS target, close_steps, vectors FROM (
SELECT stock_symbol, date, split, pos AS end_pos, lead(close_scaled, 3) OVER w AS target, row_number() OVER w - 1 AS in_part,
string_agg(CAST(round(CAST(close_scaled AS FLOAT)::DOUBLE * 1000000) AS BIGINT), ',') OVER l AS close_steps,
string_agg(vec, ';') OVER l AS vectors FROM filled SEMI JOIN parts USING (stock_symbol)
WINDOW w AS (PARTITION BY stock_symbol, split ORDER BY date),
l AS (PARTITION BY stock_symbol, split ORDER BY date ROWS BETWEEN 49 PRECEDING AND CURRENT ROW))
WHERE in_part >= 49 AND target IS NOT NULL""",
    ),
)
def embedding_sequences(spark, sf_dir):
    """Daily mean vectors, carried forward, zeros before the first, cut into windows with scaled prices."""
    daily = daily_mean_embedding(adapter.vectors(spark, sf_dir))
    thousandths = F.transform("embedding", lambda x: F.round(x.cast("float").cast("double") * 1000).cast("long").cast("string"))
    coded_days = daily.select(
        "stock_symbol", F.col("date").alias("vector_date"), F.array_join(thousandths, ",").alias("vectors")
    )
    coded_days = staged(coded_days, "daily-vectors")
    days = coded_days.select("stock_symbol", F.col("vector_date").alias("date"), F.lit(True).alias("_has"))
    rows = left_features(ts.long_enough_parts(scaled_rows(spark, sf_dir)).result(), days, KEYS)
    dated = ts.ffill_key(rows, F.col("_has").isNotNull(), "vector_date").drop("_has")
    zeros = F.lit(",".join(["0"] * 64))
    whole = ts.with_daily(dated, coded_days, "vector_date", ["vectors"], {"vectors": zeros})
    whole = whole.withColumn("close_steps", millionths(F.col("close_scaled").cast("float")))
    timeline = Timeline.by_date(whole, ("stock_symbol",), "date")
    windows = ts.sliding_sequences(timeline, ["close_steps", "vectors"], "close_scaled")
    return windows.select(
        *KEYS,
        "split",
        "end_pos",
        r6("target").alias("target"),
        F.array_join("window.close_steps", ",").alias("close_steps"),
        F.array_join("window.vectors", ";").alias("vectors"),
    )


@plan(
    "symbol_index",
    check_sql(
        "prices",
        body="""SELECT stock_symbol, row_number() OVER (ORDER BY stock_symbol) - 1 AS symbol_idx
FROM (SELECT DISTINCT stock_symbol FROM prices)""",
    ),
)
def symbol_numbers(spark, sf_dir):
    return ts.symbol_index(adapter.bars(spark, sf_dir))


@plan(
    "sample_index",
    check_sql(
        "scaled",
        body="""SELECT stock_symbol, split, end_pos, row_number() OVER (ORDER BY stock_symbol, end_pos) - 1 AS sample_id,
row_number() OVER (PARTITION BY stock_symbol ORDER BY end_pos) - 1 AS "offset" FROM (
SELECT stock_symbol, split, pos AS end_pos, row_number() OVER w - 1 AS in_part, lead(close_scaled, 3) OVER w AS target
FROM scaled WINDOW w AS (PARTITION BY stock_symbol, split ORDER BY date)) WHERE in_part >= 49 AND target IS NOT NULL""",
    ),
)
def sample_numbers(spark, sf_dir):
    rows = scaled_rows(spark, sf_dir)
    windows = ts.sliding_sequences(rows, [], "close_scaled")
    return ts.sample_index(windows.select("stock_symbol", "split", "end_pos"))


@plan(
    "sort_symbol_date",
    check_sql("prices", body="SELECT stock_symbol, date, open, close, volume FROM prices ORDER BY stock_symbol, date"),
)
def sort_symbol_date(spark, sf_dir):
    prices = adapter.prices(spark, sf_dir).select(*KEYS, *PRICE_FEATURES)
    return prices.orderBy(*KEYS)
