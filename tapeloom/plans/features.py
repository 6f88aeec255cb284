"""Scaling, binning, splits, samples, outliers and tokens."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tapeloom.operators import features as fe
from tapeloom.operators import pairs
from tapeloom.operators import series as ts
from tapeloom.operators.stats import percentile_trim
from tapeloom.operators.subwords import learned_pieces, subword_pack
from tapeloom.plans.registry import plan, r6
from tapeloom.plans.series import TOKENS, VOCAB_SQL, scaled_rows
from tapeloom.plans.sql import check_sql
from tapeloom.session import staged
from tapeloom.sources import adapter

KEYS = ["stock_symbol", "date"]
PRICE_FEATURES = ["open", "close", "volume"]


@plan(
    "minmax_per_symbol",
    check_sql(
        "scaled",
        body="""SELECT stock_symbol, date, split, round(open_scaled, 6) AS open_scaled, round(close_scaled, 6) AS close_scaled,
round(volume_scaled, 6) AS volume_scaled FROM scaled""",
    ),
)
def minmax_per_symbol(spark, sf_dir):
    rows = scaled_rows(spark, sf_dir).result()
    return rows.select(*KEYS, "split", *[r6(f"{c}_scaled").alias(f"{c}_scaled") for c in PRICE_FEATURES])


POOLED = """, fit AS (SELECT min(close) AS lo, max(close) AS hi FROM split_prices {where})
SELECT stock_symbol, date, round((close - lo) / CASE WHEN hi = lo THEN 1 ELSE hi - lo END, 6) AS close_scaled
FROM split_prices, fit"""


def pooled(spark, sf_dir, fit_on):
    rows = ts.chrono_split(adapter.bars(spark, sf_dir).select(*KEYS, "close")).result()
    scaled = fe.minmax_pooled(rows, ["close"], fit_on)
    return scaled.select(*KEYS, r6("close_scaled").alias("close_scaled"))


@plan("minmax_pooled", check_sql("split_prices", body=POOLED.format(where="WHERE split = 'train'")))
def minmax_pooled(spark, sf_dir):
    return pooled(spark, sf_dir, "train")


@plan("minmax_pooled_all", check_sql("split_prices", body=POOLED.format(where="")))
def minmax_pooled_all(spark, sf_dir):
    return pooled(spark, sf_dir, "all")


@plan(
    "standardize",
    """SELECT l_orderkey, l_linenumber, round((l_quantity - m) / s, 6) AS l_quantity_std, round((l_tax - mt) / st, 6) AS l_tax_std
FROM lineitem, (SELECT avg(l_quantity) AS m, stddev_pop(l_quantity) AS s, avg(l_tax) AS mt, stddev_pop(l_tax) AS st FROM lineitem)""",
)
def standardize(spark, sf_dir):
    items = adapter.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    scaled = fe.standardize(items, ["l_quantity", "l_tax"])
    return scaled.select(
        "l_orderkey", "l_linenumber", *[r6(c).alias(c) for c in ("l_quantity_std", "l_tax_std")]
    )


@plan(
    "standardize_label",
    """SELECT o_orderkey, round((o_totalprice - m) / (s + 1e-8::DOUBLE), 6) AS label FROM orders,
(SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM orders)""",
)
def standardize_label(spark, sf_dir):
    orders = adapter.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return fe.standardize_label(orders, "o_totalprice").select(
        "o_orderkey", r6("o_totalprice_std").alias("label")
    )


@plan(
    "inverse_minmax",
    check_sql(
        "samples",
        body="""SELECT stock_symbol, date, round(target * (close_max - close_min) + close_min, 4) AS target_price,
round(prediction * (close_max - close_min) + close_min, 4) AS predicted_price FROM samples""",
    ),
)
def inverse_minmax(spark, sf_dir):
    samples = test_samples(spark, sf_dir)
    low, high = F.col("close_min"), F.col("close_max")
    return samples.select(
        *KEYS,
        F.round(ts.inverse_scale(F.col("target"), low, high), 4).alias("target_price"),
        F.round(ts.inverse_scale(F.col("prediction"), low, high), 4).alias("predicted_price"),
    )


def test_samples(spark, sf_dir):
    """Test windows with the close five rows earlier as the prediction."""
    windows = ts.sliding_sequences(
        scaled_rows(spark, sf_dir),
        [],
        "close_scaled",
        keep=("close_min", "close_max"),
        earlier={"prediction": 5},
    )
    return windows.where(F.col("split") == "test")


TERCILES = """SELECT o_orderkey, CAST(CASE WHEN o_totalprice < lo THEN 0 WHEN o_totalprice > hi THEN 2 ELSE 1 END AS INTEGER) AS bin
FROM orders, (SELECT quantile_cont(o_totalprice, {0}) AS lo, quantile_cont(o_totalprice, {1}) AS hi FROM orders)"""


def price_bins(spark, sf_dir, low, high):
    orders = adapter.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return fe.tercile_bins(orders, "o_totalprice", low, high).select("o_orderkey", "bin")


@plan("tercile_bins", TERCILES.format(0.25, 0.75))
def quartile_bins(spark, sf_dir):
    return price_bins(spark, sf_dir, 0.25, 0.75)


@plan("tercile_bins_third", TERCILES.format(0.33, 0.66))
def third_bins(spark, sf_dir):
    return price_bins(spark, sf_dir, 0.33, 0.66)


@plan(
    "median_bins",
    """SELECT o_orderkey, CAST(CASE WHEN o_totalprice <= m THEN 0 ELSE 1 END AS INTEGER) AS bin
FROM orders, (SELECT quantile_cont(o_totalprice, 0.5) AS m FROM orders)""",
)
def median_bins(spark, sf_dir):
    orders = adapter.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return fe.median_bins(orders, "o_totalprice").select("o_orderkey", "bin")


# The forest again: trees from digests, every value led down every tree, path lengths as whole millionths.
FOREST_SQL = """WITH RECURSIVE sample AS (
  SELECT row_number() OVER (ORDER BY k, v) - 1 AS rank, v
  FROM (SELECT md5(o_orderkey || ':42') AS k, o_totalprice AS v FROM orders ORDER BY 1, 2 LIMIT 25600)
), sizes AS (
  SELECT count(*) AS m, least(256, count(*)) AS size, greatest(1, count(*) // 100) AS stride,
         ceil(log2(greatest(least(256, count(*)), 2))) AS depth_limit FROM sample
), grow(depth, tree, node, v) AS (
  SELECT 0, t.tree, 1::BIGINT, s.v FROM range(100) t(tree), range(256) j(j), sizes, sample s
  WHERE j < size AND s.rank = (t.tree * stride + j) % m
  UNION ALL
  SELECT depth + 1, tree, node * 2 + CAST(v > cut AS INTEGER), v FROM (
    SELECT *, lo + (hi - lo) * (CAST('0x' || substr(md5(tree || ':' || node || ':42'), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE) AS cut
    FROM (SELECT *, min(v) OVER w AS lo, max(v) OVER w AS hi, count(*) OVER w AS n FROM grow WINDOW w AS (PARTITION BY tree, node))
  ), sizes WHERE depth < depth_limit AND n > 1 AND lo < hi
), nodes AS (
  SELECT *, depth < depth_limit AND n > 1 AND lo < hi AS is_cut,
         lo + (hi - lo) * (CAST('0x' || substr(md5(tree || ':' || node || ':42'), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE) AS cut,
         depth * 1000000 + CASE WHEN n > 1 THEN
           CAST(round((2 * (ln(n - 1) + 0.5772156649015329::DOUBLE) - 2 * (n - 1)::DOUBLE / n) * 1000000) AS BIGINT) ELSE 0 END AS path
  FROM (SELECT depth, tree, node, min(v) AS lo, max(v) AS hi, count(*) AS n FROM grow GROUP BY ALL), sizes
), led(v, tree, node) AS (
  SELECT v, tree, 1::BIGINT FROM (SELECT DISTINCT o_totalprice AS v FROM orders), range(100) t(tree)
  UNION ALL
  SELECT l.v, l.tree, l.node * 2 + CAST(l.v > n.cut AS INTEGER) FROM led l JOIN nodes n USING (tree, node) WHERE n.is_cut
), paths AS (
  SELECT l.v, sum(n.path) AS path FROM led l JOIN nodes n USING (tree, node) WHERE NOT n.is_cut GROUP BY l.v
), scored AS (
  SELECT o.*, path, row_number() OVER (ORDER BY path DESC) - 1 AS place, (count(*) OVER () - 1) * (1 - 0.05::DOUBLE) AS wanted
  FROM orders o JOIN paths p ON p.v = o.o_totalprice
), bounds AS (
  SELECT max(path) FILTER (place = floor(wanted)) AS low, max(path) FILTER (place = ceil(wanted)) AS high FROM scored
), flagged AS (
  SELECT o_orderkey, o_totalprice,
         CAST(CASE WHEN low <> high AND path <= high OR low = high AND path < low THEN -1 ELSE 1 END AS INTEGER) AS is_outlier
  FROM scored, bounds
) """


def flagged(spark, sf_dir):
    orders = adapter.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return fe.outlier_flag(orders, "o_totalprice", ["o_orderkey"])


@plan("outlier_flag", FOREST_SQL + "SELECT o_orderkey, is_outlier FROM flagged")
def outlier_flag(spark, sf_dir):
    return flagged(spark, sf_dir).select("o_orderkey", "is_outlier")


@plan("inlier_filter", FOREST_SQL + "SELECT o_orderkey, o_totalprice FROM flagged WHERE is_outlier = 1")
def inlier_filter(spark, sf_dir):
    return fe.inlier_filter(flagged(spark, sf_dir))


@plan(
    "trimmed_inliers",
    FOREST_SQL
    + """, inliers AS (SELECT o_orderkey, o_totalprice FROM flagged WHERE is_outlier = 1)
SELECT * FROM inliers WHERE o_totalprice >= (SELECT quantile_cont(o_totalprice, 0.01) FROM inliers)
AND o_totalprice <= (SELECT quantile_cont(o_totalprice, 0.99) FROM inliers)""",
)
def trimmed_inliers(spark, sf_dir):
    return percentile_trim(staged(fe.inlier_filter(flagged(spark, sf_dir)), "inliers"), "o_totalprice")


@plan(
    "token_vocabulary",
    f"WITH {VOCAB_SQL} SELECT token, CAST(token_id AS INTEGER) AS token_id FROM vocab",
)
def token_vocabulary(spark, sf_dir):
    return fe.vocabulary(adapter.texts(spark, sf_dir, "documents", "doc_id"), "text")


@plan(
    "token_pack",
    f"""WITH {VOCAB_SQL}, words AS (SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) - 1 AS place FROM (
SELECT doc_id, list_slice({TOKENS.format('text')}, 1, 32) AS w FROM documents))
SELECT doc_id, place, CAST(CASE WHEN token IS NULL THEN 0 ELSE coalesce(token_id, 1) END AS INTEGER) AS token_id,
CAST(CASE WHEN token IS NULL THEN 0 ELSE 1 END AS INTEGER) AS mask
FROM (SELECT doc_id, CAST(unnest(generate_series(0, 31)) AS INTEGER) AS place FROM documents)
LEFT JOIN words USING (doc_id, place) LEFT JOIN vocab USING (token)""",
)
def token_pack(spark, sf_dir):
    documents = adapter.texts(spark, sf_dir, "documents", "doc_id").select("doc_id", "text")
    vocab = fe.vocabulary(documents, "text")
    one = documents.withColumn("order", F.lit(0))
    packed = fe.token_pack(one, ["doc_id"], "order", "text", vocab)
    zipped = F.arrays_zip("token_ids", "mask")
    return packed.select("doc_id", F.posexplode(zipped).alias("place", "t")).select(
        "doc_id", "place", F.col("t.token_ids").alias("token_id"), F.col("t.mask").alias("mask")
    )


PIECES_SQL = f"""corpus AS (SELECT word, count(*) AS n FROM (SELECT unnest({TOKENS.format('text')}) AS word FROM documents) GROUP BY word),
cut AS (SELECT n, length, CASE WHEN start > 0 THEN '##' ELSE '' END || substr(word, start + 1, length) AS piece
FROM (SELECT *, unnest(range(1, least(8, length(word) - start) + 1)) AS length FROM (SELECT *, unnest(range(0, length(word))) AS start FROM corpus))),
counts AS (SELECT length, piece, sum(n) * length AS covered FROM cut GROUP BY length, piece),
chosen AS (SELECT * FROM counts WHERE length = 1 UNION ALL (SELECT * FROM counts WHERE length > 1 ORDER BY covered DESC, piece LIMIT 2000)),
pieces AS (SELECT piece, row_number() OVER (ORDER BY length > 1, covered DESC, piece) + 1 AS piece_id FROM chosen)"""


@plan("subword_vocabulary", f"WITH {PIECES_SQL} SELECT piece, CAST(piece_id AS INTEGER) AS piece_id FROM pieces")
def subword_vocabulary(spark, sf_dir):
    return learned_pieces(adapter.texts(spark, sf_dir, "documents", "doc_id"), "text")


@plan(
    "subword_pack",
    f"""WITH RECURSIVE {PIECES_SQL}, led AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM (
SELECT doc_id, list_slice({TOKENS.format('text')}, 1, 32) AS w FROM documents)),
best AS (SELECT word, start, max(length) AS length, arg_max(piece_id, length) AS piece_id FROM (
SELECT word, start, unnest(range(1, least(8, length(word) - start) + 1)) AS length
FROM (SELECT word, unnest(range(0, length(word))) AS start FROM (SELECT DISTINCT word FROM led))) c
JOIN pieces p ON p.piece = CASE WHEN start > 0 THEN '##' ELSE '' END || substr(word, start + 1, length) GROUP BY word, start),
walk(word, start, ids) AS (SELECT DISTINCT word, 0::BIGINT, []::BIGINT[] FROM led
UNION ALL SELECT w.word, w.start + b.length, list_append(w.ids, b.piece_id) FROM walk w JOIN best b ON b.word = w.word AND b.start = w.start),
texts AS (SELECT doc_id, list_slice(flatten(list(ids ORDER BY place)), 1, 32) AS ids FROM led JOIN walk w ON w.word = led.word AND w.start = length(w.word)
GROUP BY doc_id)
SELECT doc_id, place, CAST(coalesce(ids[place + 1], 0) AS INTEGER) AS token_id, CAST(CASE WHEN ids[place + 1] IS NULL THEN 0 ELSE 1 END AS INTEGER) AS mask
FROM (SELECT doc_id, CAST(unnest(generate_series(0, 31)) AS INTEGER) AS place FROM documents) LEFT JOIN texts USING (doc_id)""",
)
def subword_packed(spark, sf_dir):
    documents = adapter.texts(spark, sf_dir, "documents", "doc_id").select("doc_id", "text")
    packed = subword_pack(documents, "doc_id", "text", learned_pieces(documents, "text"))
    zipped = F.arrays_zip("token_ids", "mask")
    return packed.select("doc_id", F.posexplode(zipped).alias("place", "t")).select(
        "doc_id", "place", F.col("t.token_ids").alias("token_id"), F.col("t.mask").alias("mask")
    )


@plan(
    "random_sample_n",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_quantity, l_partkey FROM lineitem) ORDER BY md5(l_orderkey || ':' || l_linenumber || ':' || l_partkey || ':42'), l_orderkey, l_linenumber, l_partkey LIMIT 10000",
)
def random_sample_n(spark, sf_dir):
    items = adapter.table(spark, sf_dir, "lineitem")
    items = items.select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey").distinct()
    sample = pairs.random_sample(items, ["l_orderkey", "l_linenumber", "l_partkey"], 10_000)
    return sample.drop("l_partkey")


@plan("plain_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 1000")
def plain_limit(spark, sf_dir):
    orders = adapter.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy("o_totalprice", "o_orderkey").limit(1000)


@plan(
    "random_split",
    """SELECT o_orderkey, CASE WHEN rn <= ceil(n * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM (
SELECT o_orderkey, row_number() OVER (ORDER BY md5(o_orderkey || ':999'), o_orderkey) AS rn,
count(*) OVER () AS n FROM orders)""",
)
def random_split(spark, sf_dir):
    return pairs.random_split(adapter.table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"])


@plan(
    "stratified_split",
    """SELECT o_orderkey, o_orderpriority, CASE WHEN rn <= round(n * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM (
SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5(o_orderkey || ':42'), o_orderkey) AS rn,
count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders)""",
)
def stratified_split(spark, sf_dir):
    orders = adapter.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return pairs.stratified_split(orders, "o_orderkey", "o_orderpriority")


@plan(
    "union_parts",
    check_sql(
        "prices",
        body="SELECT stock_symbol, date, close FROM prices",
    ),
)
def union_parts(spark, sf_dir):
    prices = adapter.prices(spark, sf_dir).select(*KEYS, "close")
    parts = [prices.where(F.col("stock_symbol") == s) for s in adapter.SYMBOLS]
    return reduce(lambda a, b: a.unionByName(b), parts)
