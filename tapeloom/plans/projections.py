"""Projections, filters and scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapeloom.functions import numeric as num
from tapeloom.functions.text import article_date, clean_text, sentiment_score, softmax
from tapeloom.operators.series import min_length_filter, return_target
from tapeloom.operators.stats import percentile_trim
from tapeloom.operators.timeline import Timeline
from tapeloom.plans.ingest import CLEAN
from tapeloom.plans.registry import plan, r6
from tapeloom.plans.sql import check_sql
from tapeloom.sources import adapter


@plan("clean_text", f"SELECT doc_id, {CLEAN.format('text')} AS text FROM documents")
def cleaned_documents(spark, sf_dir):
    documents = adapter.texts(spark, sf_dir, "documents", "doc_id")
    return documents.select("doc_id", clean_text(F.col("text")).alias("text"))


@plan(
    "enforce_schema",
    "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents",
)
def enforce_schema(spark, sf_dir):
    documents = adapter.table(spark, sf_dir, "documents").drop("text")
    with_index = documents.withColumn("Unnamed: 0", F.col("doc_id"))
    return num.enforce_schema(with_index, ["doc_id", "lang", "source", "n_chars", "not_there"])


@plan(
    "cast_prices",
    check_sql("prices", body="SELECT stock_symbol, date, open, high, low, close, adj_close, volume FROM prices"),
)
def cast_prices(spark, sf_dir):
    text = adapter.prices(spark, sf_dir)
    return num.cast_prices(text.select(*[F.col(c).cast("string").alias(c) for c in text.columns]))


@plan(
    "coerce_numeric",
    """SELECT event_id, TRY_CAST(CASE WHEN event_id % 3 = 0 THEN event_type ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS raw
FROM events""",
)
def coerce_numeric(spark, sf_dir):
    raw = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(F.col("value").cast("string"))
    events = adapter.table(spark, sf_dir, "events").select("event_id", raw.alias("raw"))
    return num.coerce_numeric(events, ["raw"])


@plan(
    "parse_article_date",
    check_sql("news", body="SELECT id, TRY_CAST(substr(date, 1, 10) AS DATE) AS clean_date FROM news"),
)
def parse_article_date(spark, sf_dir):
    return adapter.news(spark, sf_dir).select("id", article_date(F.col("date")).alias("clean_date"))


@plan("normalize_date", "SELECT event_id, CAST(ts AS DATE) AS date FROM events")
def normalize_date(spark, sf_dir):
    return adapter.table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("date"))


@plan(
    "normalize_symbol",
    """SELECT o_orderkey, lower(trim('  ' || o_orderpriority || ' ')) AS lower_symbol,
upper(trim('  ' || o_orderpriority || ' ')) AS upper_symbol FROM orders""",
)
def normalize_symbol(spark, sf_dir):
    padded = F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" "))
    return adapter.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        num.normalize_symbol(padded).alias("lower_symbol"),
        num.normalize_symbol(padded, upper=True).alias("upper_symbol"),
    )


@plan(
    "prefix_columns",
    "SELECT doc_id, lang AS emb_lang, source AS emb_source, n_chars AS emb_n_chars FROM documents",
)
def prefix_columns(spark, sf_dir):
    documents = adapter.table(spark, sf_dir, "documents").drop("text")
    return num.prefix_columns(documents.withColumnRenamed("lang", "emb_lang"), ["doc_id"])


@plan(
    "downcast_float32",
    """SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS FLOAT) AS l_extendedprice, CAST(l_tax AS FLOAT) AS l_tax
FROM lineitem""",
)
def downcast_float32(spark, sf_dir):
    items = adapter.table(spark, sf_dir, "lineitem")
    slim = items.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_tax")
    return num.downcast_float32(slim, ["l_extendedprice", "l_tax"])


@plan(
    "fill_missing",
    """SELECT d.doc_id, coalesce(CAST(l.quality AS DOUBLE), 0.0::DOUBLE) AS quality,
CASE WHEN l.doc_id IS NULL THEN 'neutral market update' ELSE d.source END AS note
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def fill_missing(spark, sf_dir):
    documents = adapter.table(spark, sf_dir, "documents").select("doc_id", "source")
    labels = adapter.table(spark, sf_dir, "labels")
    joined = documents.join(labels, "doc_id", "left")
    note = F.when(F.col("quality").isNotNull(), F.col("source"))
    return joined.select(
        "doc_id",
        F.coalesce(F.col("quality").cast("double"), F.lit(0.0)).alias("quality"),
        F.coalesce(note, F.lit("neutral market update")).alias("note"),
    )


@plan("column_prune", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def column_prune(spark, sf_dir):
    return adapter.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")


@plan("symbol_filter", check_sql("bars", body="SELECT * FROM bars"))
def symbol_filter(spark, sf_dir):
    return adapter.prices(spark, sf_dir).where(F.col("stock_symbol") == "1-urgent")


@plan("not_null_filter", check_sql("dated", body="SELECT id, date, article_title FROM dated"))
def not_null_filter(spark, sf_dir):
    news = adapter.news(spark, sf_dir).withColumn("date", article_date(F.col("date")))
    return news.select("id", "date", "article_title").dropna(subset=["date"])


@plan(
    "finite_filter",
    """SELECT l_orderkey, l_linenumber, round(l_extendedprice / l_discount, 6) AS ratio
FROM lineitem WHERE l_discount <> 0""",
)
def finite_filter(spark, sf_dir):
    items = adapter.table(spark, sf_dir, "lineitem")
    ratio = num.finite(F.try_divide("l_extendedprice", "l_discount"))
    slim = items.select("l_orderkey", "l_linenumber", r6(ratio).alias("ratio"))
    return slim.dropna(subset=["ratio"])


@plan(
    "percentile_trim",
    check_sql(
        "targets",
        body="""SELECT stock_symbol, date, round(y, 6) AS y FROM targets
WHERE y >= (SELECT quantile_cont(y, 0.01) FROM targets) AND y <= (SELECT quantile_cont(y, 0.99) FROM targets)""",
    ),
)
def percentile_trimmed(spark, sf_dir):
    kept = percentile_trim(return_target(gappy_prices(spark, sf_dir)), "y")
    return kept.select("stock_symbol", "date", r6("y").alias("y"))


@plan(
    "price_percentile_trim",
    """SELECT o_orderkey, o_totalprice FROM orders
WHERE o_totalprice >= (SELECT quantile_cont(o_totalprice, 0.01) FROM orders)
AND o_totalprice <= (SELECT quantile_cont(o_totalprice, 0.99) FROM orders)""",
)
def price_percentile_trim(spark, sf_dir):
    orders = adapter.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return percentile_trim(orders, "o_totalprice")


def gappy_prices(spark, sf_dir):
    """Bars with missing opens and closes and some closes of zero."""
    volume = F.col("volume")
    close = F.when(volume % 11 == 0, 0.0).when(volume % 7 != 0, F.col("close"))
    return adapter.bars(spark, sf_dir).select(
        "stock_symbol", "date", F.when(volume % 13 != 0, F.col("open")).alias("open"), close.alias("close")
    )


@plan(
    "min_length_filter",
    """SELECT stock_symbol, date, spent FROM (SELECT *, count(*) OVER (PARTITION BY stock_symbol) AS n FROM (
SELECT CAST(o_custkey AS VARCHAR) AS stock_symbol, CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS spent
FROM orders GROUP BY 1, 2)) WHERE n >= 12""",
)
def long_series(spark, sf_dir):
    series = (
        adapter.table(spark, sf_dir, "orders")
        .groupBy(
            F.col("o_custkey").cast("string").alias("stock_symbol"),
            F.col("o_orderdate").cast("date").alias("date"),
        )
        .agg(F.max("o_totalprice").alias("spent"))
    )
    return min_length_filter(series, 12)


def label_neighbours(spark, sf_dir):
    """Each vector's label with the label of the next vector."""
    vectors = adapter.table(spark, sf_dir, "embeddings").select("vec_id", "label")
    rows = Timeline.by_id(vectors, (), "vec_id").annotate(position="pos")
    pairs = rows.around(0, 1, lambda w: {"next_label": F.lead("label").over(w)})
    return pairs.drop("pos")


NEIGHBOURS = """(SELECT vec_id, label, lead(label) OVER (ORDER BY vec_id) AS next_label FROM embeddings)"""


@plan(
    "same_bucket_label",
    f"SELECT vec_id, CAST(CASE WHEN label = next_label THEN 1 ELSE 0 END AS INTEGER) AS samebucket FROM {NEIGHBOURS}",
)
def same_bucket_label(spark, sf_dir):
    same = num.same_bucket(F.col("label"), F.col("next_label"))
    return label_neighbours(spark, sf_dir).select("vec_id", same.alias("samebucket"))


@plan(
    "bucket_distance_class",
    f"""SELECT vec_id, CAST(CASE WHEN abs(label - next_label) <= 1 THEN 0
WHEN abs(label - next_label) BETWEEN 2 AND 3 THEN 1 ELSE 2 END AS INTEGER) AS distance_class FROM {NEIGHBOURS}""",
)
def bucket_distance_class(spark, sf_dir):
    distance = num.bucket_distance_class(F.col("label"), F.col("next_label"))
    return label_neighbours(spark, sf_dir).select("vec_id", distance.alias("distance_class"))


@plan("pair_label_diff", f"SELECT vec_id, next_label - label AS label_diff FROM {NEIGHBOURS}")
def pair_label_diff(spark, sf_dir):
    diff = F.col("next_label") - F.col("label")
    return label_neighbours(spark, sf_dir).select("vec_id", diff.alias("label_diff"))


@plan(
    "pct_change_guarded",
    """SELECT l_orderkey, l_linenumber, round((l_tax - l_discount) * 100.0::DOUBLE / nullif(l_discount, 0), 6) AS change_pct
FROM lineitem""",
)
def pct_change_guarded(spark, sf_dir):
    items = adapter.table(spark, sf_dir, "lineitem")
    change = num.guarded_pct(F.col("l_tax") - F.col("l_discount"), F.col("l_discount"))
    return items.select("l_orderkey", "l_linenumber", r6(change).alias("change_pct"))


@plan(
    "sentiment_score",
    """SELECT vec_id, CAST(k // 3 AS INTEGER) AS item,
round((exp(v[k + 1]) + 3 * exp(v[k + 2]) + 5 * exp(v[k + 3])) / (exp(v[k + 1]) + exp(v[k + 2]) + exp(v[k + 3])), 6) AS score
FROM (SELECT vec_id, embedding::DOUBLE[] AS v, unnest(range(0, 62, 3)) AS k FROM embeddings)""",
)
def vector_sentiment(spark, sf_dir):
    """Every three elements of a vector in turn stand for the logits of one item."""
    logits = F.col("embedding").cast("array<double>")
    triples = F.transform(F.sequence(F.lit(0), F.lit(20)), lambda k: F.slice(logits, k * 3 + 1, 3))
    items = adapter.table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(triples).alias("item", "logits"))
    return items.select("vec_id", "item", r6(sentiment_score(softmax(F.col("logits")))).alias("score"))
