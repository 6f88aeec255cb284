"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapeloom.functions.text import WHITE_SPACE, article_date, clean_text, clean_text_columns, page_text
from tapeloom.functions.vectors import array_to_wide, order_stat_target, wide_to_array
from tapeloom.plans.registry import places, plan, r6
from tapeloom.plans.sql import check_sql
from tapeloom.session import scratch_path
from tapeloom.sources import adapter, csv, sinks, tables
from tapeloom.streaming.chunks import ingest_chunks, read_chunks
from tapeloom.streaming.ingest import file_stream, ingest, table_stream

# The check SQL for clean_text; chr(39) is the single quote.
CLEAN = (
    "trim(replace(trim(regexp_replace({0}, '[\\n\\r]+', ' ', 'g'), '"
    + WHITE_SPACE
    + "'), '\"', chr(39)), '"
    + WHITE_SPACE
    + "')"
)


def raw_news(spark, sf_dir):
    return adapter.news(spark, sf_dir).select(
        "date",
        clean_text(F.col("article_title")).alias("article_title"),
        "stock_symbol",
        F.concat(F.lit("news/"), F.col("id").cast("string")).alias("url"),
        "publisher",
    )


RAW_NEWS = check_sql(
    "news",
    body=f"""SELECT date, {CLEAN.format('article_title')} AS article_title, stock_symbol,
'news/' || id AS url, publisher FROM news""",
)


@plan("csv_string_scan", RAW_NEWS)
def csv_string_scan(spark, sf_dir):
    path = scratch_path(spark, "news-csv")
    sinks.write_csv(raw_news(spark, sf_dir), path)
    return csv.read_news_csv(spark, path)


@plan(
    "symbol_from_path",
    r"""SELECT page_id, regexp_extract(lower(split_part(url, '?', 1) || '.csv'), '([^/]+)\.csv$', 1) AS stock_symbol
FROM pages""",
)
def symbol_from_path(spark, sf_dir):
    path = F.concat(F.substring_index("url", "?", 1), F.lit(".csv"))
    pages = adapter.table(spark, sf_dir, "pages")
    return pages.select("page_id", csv.symbol_from_path(path).alias("stock_symbol"))


@plan(
    "price_files",
    check_sql(
        "prices",
        body="""SELECT stock_symbol, CAST(date AS VARCHAR) AS date, round(open, 6) AS open, round(high, 6) AS high,
round(low, 6) AS low, round(close, 6) AS close, round(adj_close, 6) AS adj_close, volume FROM prices""",
    ),
)
def price_files(spark, sf_dir):
    """Price files per symbol, written in one go and read again with the symbol from the path."""
    path = scratch_path(spark, "price-files")
    bars = adapter.prices(spark, sf_dir).select("stock_symbol", *csv.PRICE_FILE_COLUMNS)
    sinks.write_symbol_files(bars, path)
    back = csv.read_prices_csv(spark, path)
    numbers = [r6(F.col(c).cast("double")).alias(c) for c in ("open", "high", "low", "close", "adj_close")]
    return back.select("stock_symbol", "date", *numbers, F.col("volume").cast("double").alias("volume"))


WIDE_NEWS = ", ".join(
    CLEAN.format(f"coalesce({text}, '')") + f" AS {name}"
    for name, text in (
        ("author", "lang"),
        ("article", "text"),
        ("lsa_summary", "reverse(text)"),
        ("luhn_summary", "upper(source)"),
        ("textrank_summary", "NULL"),
        ("lexrank_summary", "'\"quoted\"  ' || source"),
    )
)


@plan(
    "wide_news_scan",
    f"""SELECT CAST(doc_id AS VARCHAR) AS url, {CLEAN.format('text')} AS article_title, {WIDE_NEWS} FROM documents""",
)
def wide_news_scan(spark, sf_dir):
    """Raw news of eleven columns, stored as CSV with line breaks and quotes, scanned and cleaned."""
    path = scratch_path(spark, "wide-news")
    documents = adapter.table(spark, sf_dir, "documents")
    raw = documents.select(
        F.lit("2020-01-01").alias("date"),
        F.col("text").alias("article_title"),
        F.lit("A").alias("stock_symbol"),
        F.col("doc_id").cast("string").alias("url"),
        F.col("source").alias("publisher"),
        F.col("lang").alias("author"),
        F.col("text").alias("article"),
        F.reverse("text").alias("lsa_summary"),
        F.upper("source").alias("luhn_summary"),
        F.lit(None).cast("string").alias("textrank_summary"),
        F.concat(F.lit('"quoted"  '), "source").alias("lexrank_summary"),
    )
    sinks.write_csv(raw, path, rows=sinks.WHOLE_FILE_ROWS)
    news = clean_text_columns(csv.read_news_csv(spark, path, wide=True, multi_line=True))
    filled = [F.coalesce(c, F.lit("")).alias(c) for c in csv.NEWS_WIDE_COLUMNS[5:]]
    return news.select("url", "article_title", *filled)


@plan("named_table", "SELECT o_orderkey, o_totalprice FROM orders")
def named_table(spark, sf_dir):
    adapter.table(spark, sf_dir, "orders").createOrReplaceTempView("tapeloom_orders")
    return tables.read_table(spark, "tapeloom_orders", ["o_orderkey", "o_totalprice"])


@plan(
    "catalog_query",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'",
)
def catalog_query(spark, sf_dir):
    return tables.run_sql(
        spark,
        "SELECT o_orderkey, o_custkey, o_totalprice FROM {orders} WHERE o_orderpriority = '1-URGENT'",
        orders=adapter.table(spark, sf_dir, "orders"),
    )


@plan(
    "synthetic_pairs",
    """SELECT 'Text' || n || '+' || (n + 100) AS concatarticles1, 'Text' || (n + 200) || '+' || (n + 300) AS concatarticles2,
CAST(n % 2 AS VARCHAR) AS samebucket, CAST(DATE '2025-01-01' - CAST(n AS INTEGER) AS VARCHAR) AS date1,
CAST(DATE '2025-01-01' - CAST(n + 1 AS INTEGER) AS VARCHAR) AS date2
FROM (SELECT doc_id + 1 AS n FROM documents)""",
)
def synthetic_pairs(spark, sf_dir):
    numbers = adapter.table(spark, sf_dir, "documents").select((F.col("doc_id") + 1).alias("n"))
    return tables.synthetic_pairs(numbers, "n", "2025-01-01")


@plan(
    "row_range_slice",
    """SELECT * FROM (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_idx FROM orders)
WHERE row_idx >= 1000 AND row_idx < 12000""",
)
def row_range_slice(spark, sf_dir):
    orders = adapter.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return tables.slice_rows(orders, "o_orderkey", 1000, 12000)


@plan(
    "percent_slice",
    """SELECT o_orderkey, o_totalprice, row_idx FROM (SELECT o_orderkey, o_totalprice,
row_number() OVER (ORDER BY o_orderkey) - 1 AS row_idx, count(*) OVER () AS n FROM orders)
WHERE row_idx < floor(n * 12.5::DOUBLE / 100)""",
)
def percent_slice(spark, sf_dir):
    orders = adapter.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return tables.head_percent(orders, "o_orderkey", 12.5)


@plan("take_head", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100")
def take_head(spark, sf_dir):
    orders = adapter.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return tables.take_head(orders, ["o_orderkey"])


ELEMENTS = """SELECT {keys}, CAST(place AS INTEGER) AS place, round(value::DOUBLE, 6) AS value FROM (
SELECT {keys}, generate_subscripts(embedding, 1) - 1 AS place, unnest(embedding) AS value FROM {source})"""


@plan("embedding_wide_to_array", ELEMENTS.format(keys="vec_id", source="embeddings"))
def embedding_wide_to_array(spark, sf_dir):
    wide = array_to_wide(
        adapter.table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding", 64
    )
    return places(wide_to_array(wide, [str(i) for i in range(64)]), ["vec_id"], "embedding")


@plan(
    "embedding_table",
    check_sql("vectors", body=ELEMENTS.format(keys="stock_symbol, date, id", source="vectors")),
)
def embedding_table(spark, sf_dir):
    path = scratch_path(spark, "embeddings")
    keys = ["stock_symbol", "date", "id"]
    tables.save_embeddings(adapter.vectors(spark, sf_dir), path, keys)
    return places(tables.load_embeddings(spark, path), keys, "embedding")


@plan(
    "page_text",
    r"""WITH body AS (SELECT page_id, regexp_replace(html,
'(?is)<script\b.*?</script>|<style\b.*?</style>|<nav\b.*?</nav>|<!--.*?-->', '', 'g') AS b FROM pages),
joined AS (SELECT page_id, regexp_replace(array_to_string(
regexp_extract_all(b, '(?is)<p(?:\s[^>]*)?>(.*?)</p>', 1), ' '), '(?s)<[^>]*>', '', 'g') AS t FROM body),
plain AS (SELECT page_id, replace(replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'),
'&quot;', '"'), '&#39;', chr(39)), '&nbsp;', ' '), '&amp;', '&') AS t FROM joined)
SELECT page_id, coalesce(regexp_replace(regexp_replace(regexp_replace(t, '\s+', ' ', 'g'), '^\s+', ''), '\s+$', ''), '')
AS article FROM plain""",
)
def page_articles(spark, sf_dir):
    return adapter.texts(spark, sf_dir, "pages", "page_id").select(
        "page_id", page_text(F.col("html")).alias("article")
    )


@plan(
    "order_stat_target",
    """SELECT vec_id, round(0.5 * avg(x) + 0.5 * (any_value(s[5]) + any_value(s[64 - 4])), 6) AS target FROM (
SELECT vec_id, unnest(embedding)::DOUBLE AS x, list_sort(embedding::DOUBLE[]) AS s FROM embeddings) GROUP BY vec_id""",
)
def order_statistics(spark, sf_dir):
    vectors = adapter.table(spark, sf_dir, "embeddings")
    return vectors.select("vec_id", r6(order_stat_target(F.col("embedding"))).alias("target"))


CLEANED_DOCS = f"SELECT doc_id, {CLEAN.format('text')} AS text, lang, source FROM documents"


@plan("stream_ingest", CLEANED_DOCS)
def stream_ingest(spark, sf_dir):
    schema = adapter.table(spark, sf_dir, "documents").schema
    stream = table_stream(spark, f"{sf_dir}/documents.parquet", schema)
    out, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    query = ingest(
        stream,
        lambda df: df.select("doc_id", clean_text(F.col("text")).alias("text"), "lang", "source"),
        out,
        checkpoint,
    )
    query.awaitTermination()
    return spark.read.parquet(out)


@plan(
    "stream_chunks",
    f"""SELECT doc_id, text, lang, source, batch, row_no, chunk_id, 'part-' || lpad(CAST(chunk_id AS VARCHAR), 5, '0') AS part FROM (
SELECT *, row_no // 70 AS chunk_id FROM (SELECT *, doc_id % 3 AS batch, row_number() OVER (ORDER BY doc_id % 3, doc_id) - 1 AS row_no
FROM ({CLEANED_DOCS})))""",
)
def stream_chunks(spark, sf_dir):
    """Documents in three deliveries, each taken in by a new start of the stream as one batch; chunk numbers go on."""
    documents = adapter.table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    folder, out, checkpoint = (scratch_path(spark, name) for name in ("deliveries", "stream-chunks", "chunk-state"))
    for delivery in range(3):
        documents.where(F.col("doc_id") % 3 == delivery).write.mode("append").parquet(folder)
        stream = file_stream(spark, folder, documents.schema, "parquet", files_per_batch=None)
        query = ingest_chunks(stream, lambda df: df.withColumn("text", clean_text(F.col("text"))), "doc_id", out, checkpoint, rows=70)
        query.awaitTermination()
    return read_chunks(spark, out)


@plan(
    "chunked_write",
    """SELECT doc_id, text, lang, chunk_id, 'part-' || lpad(CAST(chunk_id AS VARCHAR), 5, '0') AS part FROM (
SELECT *, (row_number() OVER (ORDER BY doc_id) - 1) // 70 AS chunk_id FROM documents)""",
)
def chunked_write(spark, sf_dir):
    path = scratch_path(spark, "chunks")
    documents = adapter.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    sinks.write_chunks(documents, "doc_id", path, rows=70)
    back = csv.read_strings(spark, path, ["doc_id", "text", "lang", "chunk_id"], multi_line=True)
    chunk = F.col("chunk_id").cast("long")
    part = F.concat(F.lit("part-"), F.lpad(chunk.cast("string"), 5, "0"))
    return back.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", chunk.alias("chunk_id"), part.alias("part")
    )


@plan("csv_sink", RAW_NEWS)
def csv_sink(spark, sf_dir):
    path = scratch_path(spark, "csv-sink")
    sinks.write_csv(raw_news(spark, sf_dir), path, quote_all=False)
    return csv.read_news_csv(spark, path)


@plan("ctas_parquet", check_sql("prices", body="SELECT * FROM prices WHERE stock_symbol = '1-urgent'"))
def ctas_parquet(spark, sf_dir):
    path = scratch_path(spark, "bars")
    bars = adapter.prices(spark, sf_dir).where(F.col("stock_symbol") == "1-urgent")
    sinks.create_parquet(bars, path)
    return sinks.create_parquet(bars, path, if_not_exists=True)


@plan("ctas_text", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, source FROM documents")
def ctas_text(spark, sf_dir):
    path = scratch_path(spark, "text-table")
    sinks.create_text(adapter.table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), path)
    return csv.read_strings(spark, path, ["doc_id", "lang", "source"], header=False)


@plan("materialize_or_load", check_sql("prices", body="SELECT stock_symbol, date, close FROM prices"))
def materialize_or_load(spark, sf_dir):
    path = scratch_path(spark, "kept")

    def build():
        return adapter.prices(spark, sf_dir).select("stock_symbol", "date", "close")

    sinks.materialize(spark, path, build)
    return sinks.materialize(spark, path, build)


@plan(
    "raw_to_dated_news",
    check_sql("dated", body="SELECT id, date, stock_symbol FROM dated"),
)
def raw_to_dated_news(spark, sf_dir):
    news = adapter.news(spark, sf_dir)
    dated = news.select("id", article_date(F.col("date")).alias("date"), "stock_symbol")
    return dated.where(F.col("date").isNotNull())
