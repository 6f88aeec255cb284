"""Title batches and labelled pairs: the chain from raw news to training pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapeloom.functions.numeric import same_bucket
from tapeloom.operators.news import article_groups, rank_in_day, title_batches
from tapeloom.operators.pairs import adjacent_pairs, random_order
from tapeloom.operators.series import DECILES, decile_buckets, price_changes
from tapeloom.operators.stats import distinct_keys
from tapeloom.plans.registry import plan, r6
from tapeloom.plans.sql import check_sql
from tapeloom.session import staged
from tapeloom.sources import adapter

BUCKETS = list(DECILES.values())
GAP = "open_lead_close_lag_change_pct"
BATCH_KEY = ["date", "article_group"]


def changes_of(spark, sf_dir, symbol):
    """Price and volume changes of one symbol."""
    bars = adapter.prices(spark, sf_dir).where(F.col("stock_symbol") == symbol)
    return price_changes(bars)


def labelled_batches(spark, sf_dir):
    """Title-ordered batches of ten, joined to the bars; batches off the calendar kept."""
    bars = decile_buckets(changes_of(spark, sf_dir, "1-urgent"))
    return title_batches(article_groups(adapter.news(spark, sf_dir)), bars, BUCKETS, "left")


def gap_batches(spark, sf_dir):
    """Randomly ordered batches of ten on days with a bar."""
    changes = staged(changes_of(spark, sf_dir, "2-high").select("stock_symbol", "date", GAP, *DECILES), "changes")
    bars = changes.select("stock_symbol", "date", GAP).join(decile_buckets(changes), ["stock_symbol", "date"])
    groups = article_groups(adapter.news(spark, sf_dir), by="random")
    return title_batches(groups, bars, [GAP, *BUCKETS], "inner")


@plan(
    "titles_left_join_prices",
    check_sql("title_batches", body="SELECT * FROM title_batches"),
)
def titles_left_join_prices(spark, sf_dir):
    return labelled_batches(spark, sf_dir)


@plan(
    "titles_inner_join_prices",
    check_sql(
        "gap_batches",
        body="SELECT * REPLACE (round(open_lead_close_lag_change_pct, 6) AS open_lead_close_lag_change_pct) FROM gap_batches",
    ),
)
def titles_inner_join_prices(spark, sf_dir):
    return gap_batches(spark, sf_dir).withColumn(GAP, r6(GAP))


@plan(
    "title_batches",
    check_sql(
        "title_batches",
        body="""SELECT date, article_group, volume_delta_decile_bucket, aggregated_article_title
FROM title_batches WHERE date IS NOT NULL""",
    ),
)
def dated_title_batches(spark, sf_dir):
    kept = labelled_batches(spark, sf_dir).dropna(subset=["date"])
    return kept.select("date", "article_group", "volume_delta_decile_bucket", "aggregated_article_title")


# Each batch with the next one in digest order.
CHAINED = """, chained AS (SELECT row_number() OVER w AS rn, this, lead(this) OVER w AS following
FROM {0} AS this WHERE this.date IS NOT NULL
WINDOW w AS (ORDER BY md5(this.date || ':' || this.article_group || ':42'), this.date, this.article_group))
"""
BOTH_TITLES = """rn, this.aggregated_article_title AS concatarticles1, this.date AS date1,
following.aggregated_article_title AS concatarticles2, following.date AS date2"""


def same_sql(column: str, name: str) -> str:
    return f"CAST(CASE WHEN this.{column} = following.{column} THEN 1 ELSE 0 END AS INTEGER) AS {name}"


@plan(
    "matched_pairs",
    check_sql(
        "title_batches",
        body=CHAINED.format("title_batches")
        + f"SELECT {BOTH_TITLES}, {same_sql(BUCKETS[1], 'samebucket')} FROM chained WHERE following IS NOT NULL",
    ),
)
def matched_pairs(spark, sf_dir):
    batches = labelled_batches(spark, sf_dir).dropna(subset=["date"])
    columns = {
        "aggregated_article_title": "concatarticles",
        "date": "date",
        "volume_change_ratio_decile_bucket": "_bucket",
    }
    pairs = adjacent_pairs(batches, BATCH_KEY, columns)
    label = same_bucket(F.col("_bucket1"), F.col("_bucket2"))
    return pairs.withColumn("samebucket", label).drop("_bucket1", "_bucket2")


@plan(
    "paired_gap_changes",
    check_sql(
        "gap_batches",
        body=CHAINED.format("gap_batches")
        + f"""SELECT {BOTH_TITLES}, round(this.{GAP}, 6) AS vol_diff1, round(following.{GAP}, 6) AS vol_diff2,
round(following.{GAP} - this.{GAP}, 6) AS vol_1_vs_2 FROM chained WHERE following IS NOT NULL""",
    ),
)
def paired_gap_changes(spark, sf_dir):
    columns = {"aggregated_article_title": "concatarticles", "date": "date", GAP: "vol_diff"}
    pairs = adjacent_pairs(gap_batches(spark, sf_dir), BATCH_KEY, columns)
    change = F.col("vol_diff2") - F.col("vol_diff1")
    return pairs.withColumns(
        {"vol_1_vs_2": r6(change), "vol_diff1": r6("vol_diff1"), "vol_diff2": r6("vol_diff2")}
    )


@plan(
    "paired_buckets_one_pass",
    check_sql(
        "gap_batches",
        body=CHAINED.format("gap_batches")
        + f"""SELECT {BOTH_TITLES}, this.{BUCKETS[0]} AS bucket_delta1, this.{BUCKETS[1]} AS bucket_ratio1,
following.{BUCKETS[0]} AS bucket_delta2, following.{BUCKETS[1]} AS bucket_ratio2,
{same_sql(BUCKETS[0], 'samebucket_delta')}, {same_sql(BUCKETS[1], 'samebucket_ratio')}
FROM chained WHERE following IS NOT NULL""",
    ),
)
def paired_buckets_one_pass(spark, sf_dir):
    columns = {
        "aggregated_article_title": "concatarticles",
        "date": "date",
        BUCKETS[0]: "bucket_delta",
        BUCKETS[1]: "bucket_ratio",
    }
    pairs = adjacent_pairs(gap_batches(spark, sf_dir), BATCH_KEY, columns)
    return pairs.withColumns(
        {
            "samebucket_delta": same_bucket(F.col("bucket_delta1"), F.col("bucket_delta2")),
            "samebucket_ratio": same_bucket(F.col("bucket_ratio1"), F.col("bucket_ratio2")),
        }
    )


ORDERED_DOCS = "SELECT doc_id, row_number() OVER (ORDER BY md5(doc_id || ':42'), doc_id) AS rn FROM documents"


@plan(
    "adjacent_pairs",
    f"""SELECT * FROM (SELECT rn, doc_id AS doc_id1, lead(doc_id) OVER (ORDER BY rn) AS doc_id2
FROM ({ORDERED_DOCS})) WHERE doc_id2 IS NOT NULL""",
)
def adjacent_documents(spark, sf_dir):
    documents = adapter.table(spark, sf_dir, "documents").select("doc_id")
    return adjacent_pairs(documents, ["doc_id"], {"doc_id": "doc_id"})


@plan("random_order", ORDERED_DOCS)
def random_documents(spark, sf_dir):
    documents = adapter.table(spark, sf_dir, "documents").select("doc_id")
    return random_order(documents, ["doc_id"]).df.select("doc_id", "rn")


@plan("rank_by_title", check_sql("title_groups", body="SELECT id, clean_date, article_title, rn FROM title_groups"))
def rank_by_title(spark, sf_dir):
    ranked = rank_in_day(adapter.news(spark, sf_dir).select("id", "date", "article_title"), "title")
    return ranked.select("id", "clean_date", "article_title", "rn")


@plan("rank_random_in_day", check_sql("random_groups", body="SELECT id, clean_date, rn FROM random_groups"))
def rank_random_in_day(spark, sf_dir):
    return rank_in_day(adapter.news(spark, sf_dir).select("id", "date"), "random").select("id", "clean_date", "rn")


@plan(
    "article_group",
    check_sql(
        "title_groups",
        body="SELECT clean_date, article_group, count(*) AS n FROM title_groups GROUP BY clean_date, article_group",
    ),
)
def article_group_sizes(spark, sf_dir):
    groups = article_groups(adapter.news(spark, sf_dir))
    return groups.groupBy("clean_date", "article_group").agg(F.count(F.lit(1)).alias("n"))


@plan("distinct_keys", check_sql("dated", body="SELECT DISTINCT stock_symbol, date FROM dated"))
def distinct_news_keys(spark, sf_dir):
    return distinct_keys(adapter.dated_news(spark, sf_dir), ["stock_symbol", "date"])


@plan(
    "distinct_titles_after_rank",
    check_sql("random_groups", body="SELECT DISTINCT clean_date, article_title, rn, article_group FROM random_groups"),
)
def distinct_titles_after_rank(spark, sf_dir):
    groups = article_groups(adapter.news(spark, sf_dir), by="random", dedup="after_rank")
    return groups.select("clean_date", "article_title", "rn", "article_group")


@plan(
    "distinct_titles_before_rank",
    check_sql(
        "titles",
        body="""SELECT clean_date, article_title, id, row_number() OVER w AS rn, (row_number() OVER w - 1) // 10 AS article_group
FROM (SELECT clean_date, article_title, min(id) AS id FROM titles GROUP BY ALL)
WINDOW w AS (PARTITION BY clean_date ORDER BY md5(id || ':42'), id)""",
    ),
)
def distinct_titles_before_rank(spark, sf_dir):
    groups = article_groups(adapter.news(spark, sf_dir), by="random", dedup="before_rank")
    return groups.select("clean_date", "article_title", "id", "rn", "article_group")
