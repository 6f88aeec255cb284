"""News by day: ranking, groups of ten, title batches, daily texts, padded bags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.functions.keys import random_key
from tapeloom.functions.text import article_date
from tapeloom.operators.joins import salted_join
from tapeloom.operators.series import ffill_key
from tapeloom.operators.timeline import SEGMENT, Timeline, hash_buckets
from tapeloom.session import staged

GROUP_SIZE = 10
NO_DAY = -1_000_000  # stands for "no date" so that a null day is a group of its own


def rank_in_day(news: DataFrame, by: str = "title", seed: int = 42) -> DataFrame:
    """``ROW_NUMBER`` inside the day, by title or in seeded random order.

    A day may hold any share of the rows: title order is range partitioned,
    random order is cut by its digest.
    """
    dated = news.withColumn("clean_date", article_date(F.col("date"))).withColumn(
        "_day", F.coalesce(F.unix_date("clean_date"), F.lit(NO_DAY))
    )
    if by == "title":
        ordered = dated.withColumn("_untitled", F.col("article_title").isNull())
        rows = Timeline.by_range(ordered, ("_day",), ("_untitled", "article_title", "id"))
    elif by == "random":
        rows = Timeline.by_hash(
            dated.withColumn("_key", random_key("id", seed=seed)), ("_day",), "_key", "id"
        )
    else:
        raise ValueError(f"rank by 'title' or 'random', not {by!r}")
    ranked = rows.annotate(position="rn").result()
    return ranked.withColumn("rn", F.col("rn") + 1).drop("_day", "_untitled", "_key")


def article_groups(
    news: DataFrame, by: str = "title", seed: int = 42, dedup: str = "none", size: int = GROUP_SIZE
) -> DataFrame:
    """Ranked news with ``article_group`` = (rn - 1) div size.

    ``dedup='after_rank'`` takes DISTINCT (day, title, rank) and thus removes
    nothing; ``'before_rank'`` keeps one article per (day, title).
    """
    news = news.select("id", "date", "article_title")  # whole articles need not travel
    if dedup == "before_rank":
        day = article_date(F.col("date"))
        news = (
            news.withColumn("_clean", day)
            .groupBy("_clean", "article_title")
            .agg(F.min("id").alias("id"), F.min_by("date", "id").alias("date"))
            .drop("_clean")
        )
    ranked = rank_in_day(news, by, seed)
    if dedup == "after_rank":
        ranked = ranked.select("clean_date", "article_title", "rn").distinct()
    return ranked.withColumn("article_group", F.floor((F.col("rn") - 1) / size))


def title_batches(
    groups: DataFrame, bars: DataFrame, columns: Sequence[str], how: str = "left"
) -> DataFrame:
    """One row per (price date, article group) with the titles joined by ``|``.

    Titles are gathered first (at most ten per group), so the join sees batches,
    not articles. With ``how='left'`` batches of days without a bar fall together
    by group number, under a null date.
    """
    entry = F.struct(F.col("rn"), F.col("article_title"))
    batches = groups.groupBy("clean_date", "article_group").agg(
        F.array_sort(F.collect_list(entry)).alias("_entries")
    )
    batches = batches.withColumn("_titles", F.transform("_entries", lambda e: e["article_title"]))
    side = bars.select("date", *columns).withColumnRenamed("date", "clean_date")
    joined = salted_join(
        batches.drop("_entries"),
        side.withColumn("date", F.col("clean_date")),
        ("clean_date",),
        how,
        F.col("article_group"),
    )
    out = ["date", "article_group", *columns, "aggregated_article_title"]
    if how == "inner":
        return joined.select(*out[:-1], F.array_join("_titles", "|").alias(out[-1]))
    day_entry = F.struct(F.col("clean_date"), F.col("_titles"))
    grouped = joined.groupBy("date", "article_group").agg(
        *[F.any_value(c).alias(c) for c in columns],
        F.array_sort(F.collect_list(day_entry)).alias("_days"),
    )
    titles = F.flatten(F.transform("_days", lambda d: d["_titles"]))
    return grouped.select(*out[:-1], F.array_join(titles, "|").alias(out[-1]))


def daily_mean(df: DataFrame, value: str, keys: Sequence[str] = ("stock_symbol", "date")) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(value).alias(value))


def daily_mean_embedding(
    df: DataFrame, vector: str = "embedding", keys: Sequence[str] = ("stock_symbol", "date")
) -> DataFrame:
    """Element-wise mean vector; partial sums are built before the shuffle."""
    mean = Summarizer.mean(array_to_vector(F.col(vector).cast("array<double>")))
    return df.groupBy(*keys).agg(vector_to_array(mean).alias(vector))


def daily_text(
    df: DataFrame,
    text: str = "lsa_summary",
    id_col: str = "id",
    nulls: str = "drop",
    keys: Sequence[str] = ("stock_symbol", "date"),
    part_rows: int = 1000,
) -> DataFrame:
    """The day's texts joined by blanks, in id order: one row per day, of any size.

    Texts are joined ``part_rows`` at a time first, so that a hot day is put together from
    few long parts and not from all of its rows.
    """
    if nulls not in ("drop", "empty"):
        raise ValueError(f"nulls must be 'drop' or 'empty', not {nulls!r}")
    chosen = df.where(F.col(text).isNotNull()) if nulls == "drop" else df
    slim = chosen.select(*keys, id_col, F.coalesce(F.col(text), F.lit("")).alias(text))
    # parts are cut inside of segments, so texts are shuffled twice in all: to their parts, and parts to their day
    segments = Timeline.by_id(slim, keys, id_col).df.withColumn(SEGMENT, F.col(SEGMENT).cast("int"))
    inside = Window.partitionBy(*keys, SEGMENT).orderBy(id_col)
    rows = segments.withColumn("_pos", F.row_number().over(inside) - 1)

    def joined(table: DataFrame, place: Sequence[str], by: Sequence[str]) -> DataFrame:
        entries = F.array_sort(F.collect_list(F.struct(*place, text)))
        found = table.groupBy(*by).agg(entries.alias("_entries"))
        return found.withColumn(text, F.array_join(F.transform("_entries", lambda e: e[text]), " ")).drop("_entries")

    parts = joined(rows.withColumn("_part", F.floor(F.col("_pos") / part_rows)), ["_pos"], [*keys, SEGMENT, "_part"])
    # dealt out here, or Spark would put as many long texts into one task as it takes for a good size of a shuffle
    dealt = parts.repartition(hash_buckets(df), *keys)
    return joined(dealt, [SEGMENT, "_part"], keys)


#: Bytes of text that one task puts out, or up to twice that: writers hold a hundred rows before they look.
TASK_BYTES = 32 << 20


#: How stored texts lie: long ones in pages and row groups of a few, as a reader holds one of each. Else a hundred lie in one.
FEW_IN_A_PAGE = {"parquet.page.size.row.check.min": "1", "parquet.block.size": str(8 << 20)}


def stored_texts(texts: DataFrame, text: str) -> DataFrame:
    """Daily texts stored with their sizes (``_bytes``), for what needs only their days and sizes."""
    return staged(texts.withColumn("_bytes", F.octet_length(text).cast("long")), "daily-texts", FEW_IN_A_PAGE)


def carried_day(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Every row (symbol, date, ...) with ``_text_date``, the latest day up to its own that has a text."""
    days = texts.select("stock_symbol", "date").withColumn("_has", F.lit(True))
    dated = ffill_key(rows.join(days, ["stock_symbol", "date"], "left"), F.col("_has").isNotNull(), "_text_date")
    return dated.drop("_has")


#: Rows that are sent to all texts, and how many tasks at most read the same stored texts.
FEW_CARRIED, MOST_READERS = 100_000, 256


def text_of_day(rows: DataFrame, texts: DataFrame, text: str, missing: str) -> DataFrame:
    """Rows (symbol, date, ``_text_date``, ...) with the text of that day, else ``missing``, as the last step of all.

    A text comes again for each row that carries it, so the texts stay where they are stored, and the rows, gathered
    into lists, go to them: nothing of the size of the result is shuffled. ``texts`` come from ``stored_texts``. Only
    of very many rows, with texts that are short then, lists travel with a copy of the text.
    """
    at = ["stock_symbol", "_text_date"]
    side = texts.withColumnRenamed("date", "_text_date")
    rows = staged(rows, "text-rows")
    found = (read_again if rows.count() <= FEW_CARRIED else copied_to_lists)(rows, side, at, text)
    found = found.select("stock_symbol", F.inline("_rows"), F.coalesce(text, F.lit(missing)).alias(text))
    without = rows.join(side.select(*at), at, "left_anti").withColumn(text, F.lit(missing))
    return found.unionByName(without.select(*found.columns))


def lists_of(rows: DataFrame, days: DataFrame, at: Sequence[str], size: int) -> DataFrame:
    """``rows`` of a day in lists (``_rows``), by their ``_task``: lists are worth ``size`` bytes of text or one row, and
    are dealt to tasks by the bytes ``_before`` them (``days``: ``_out`` bytes of a day, ``_before`` it)."""
    count = F.greatest(F.lit(1), F.ceil(F.col("_out") / size)).cast("long")
    number = F.pmod(F.unix_date("date"), count)
    start = F.col("_before") + F.col("_out") / count * number
    kept = [c for c in rows.columns if c not in at]
    return (
        rows.join(days, list(at))
        .withColumns({"_list": number, "_task": F.floor(start / size).cast("int")})
        .groupBy(*at, "_list", "_task")
        .agg(F.collect_list(F.struct(*kept)).alias("_rows"))
    )


def day_bytes(rows: DataFrame, side: DataFrame, at: Sequence[str], *more: Column) -> DataFrame:
    """The bytes that the rows of each day put out."""
    places = side.select(*at, "_bytes", *more)
    days = rows.groupBy(*at).agg(F.count(F.lit(1)).alias("_n")).join(places, list(at))
    return days.withColumn("_out", F.col("_n") * F.col("_bytes")).drop("_n", "_bytes")


def read_again(rows: DataFrame, side: DataFrame, at: Sequence[str], text: str) -> DataFrame:
    """Lists with their text: each part of the stored texts is read by as many tasks as its rows are worth
    ``TASK_BYTES``, and each of them puts out its share. Only numbers of tasks meet the texts by a cross join.
    """
    days = day_bytes(rows, side, at, F.spark_partition_id().alias("_part"))
    upto = F.sum("_out").over(Window.partitionBy("_part").orderBy(*at))
    days = staged(days.withColumn("_before", upto - F.col("_out")).drop("_part"), "text-days")
    most = days.agg(F.max(F.col("_before") + F.col("_out"))).first()[0] or 0
    size = max(TASK_BYTES, -(-most // MOST_READERS))
    lists = lists_of(rows, days, at, size)
    readers = 1 + most // size
    tasks = rows.sparkSession.range(0, readers, 1, readers).select(F.col("id").cast("int").alias("_task"))
    again = side.select(*at, text).hint("shuffle_replicate_nl").crossJoin(tasks)
    return again.join(F.broadcast(lists), [*at, "_task"])


def copied_to_lists(rows: DataFrame, side: DataFrame, at: Sequence[str], text: str) -> DataFrame:
    """Lists with a copy of their text each, dealt to tasks so that one puts out at most twice ``TASK_BYTES``, or one row."""
    days = Timeline.by_date(day_bytes(rows, side, at), (), "_text_date")
    days = Timeline(days.df, (), ("_text_date", "stock_symbol")).annotate(running={"_upto": F.col("_out")}).result()
    days = staged(days.withColumn("_before", F.col("_upto") - F.col("_out")).drop("_upto"), "text-days")
    tasks = 1 + (days.agg(F.max(F.col("_before") + F.col("_out"))).first()[0] or 0) // TASK_BYTES
    return lists_of(rows, days, at, TASK_BYTES).join(side.select(*at, text), list(at)).repartitionById(tasks, "_task")


def carried_text(rows: DataFrame, texts: DataFrame, text: str, missing: str) -> DataFrame:
    """Every row of ``rows`` (symbol, date, ...) with the latest daily text up to its day, else ``missing``.

    The day is carried forward and the text joined once, so that no text goes through a window.
    """
    texts = stored_texts(texts, text)
    return text_of_day(carried_day(rows, texts), texts, text, missing)


def news_bag(
    df: DataFrame,
    vector: str = "embedding",
    id_col: str = "id",
    dim: int = 64,
    size: int = 30,
    keys: Sequence[str] = ("stock_symbol", "date"),
) -> DataFrame:
    """The first ``size`` vectors of a day, zero-padded, with a 0/1 mask.

    The row-number limit is applied before the shuffle as well, so a hot day
    sends ``size`` rows per task, not all of its rows.
    """
    order = Window.partitionBy(*keys).orderBy(id_col)
    first = df.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= size)
    entry = F.struct(F.col("_rn"), F.col(vector).cast("array<float>").alias("v"))
    bags = first.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("_entries"))
    return bags.select(*keys, *pad_bag(F.col("_entries"), dim, size))


def pad_bag(entries, dim: int, size: int):
    """(bag, mask) columns of exactly ``size`` items; a null bag is all zeros."""
    found = F.coalesce(F.transform(entries, lambda e: e["v"]), F.array().cast("array<array<float>>"))
    n = F.size(found)
    zeros = F.array_repeat(F.lit(0.0).cast("float"), dim)
    bag = F.concat(found, F.array_repeat(zeros, F.lit(size) - n))
    mask = F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), F.lit(size) - n))
    return bag.alias("bag"), mask.alias("mask")


def bag_intervals(days: DataFrame, bags: DataFrame, empty: dict[str, Column], out: str) -> DataFrame:
    """Every day (symbol, date) with the bag that is valid then, and that bag's date as ``out``.

    A bag is valid from its own day, if that is in the list, until the next such day: the days in order carry the
    start of the interval they lie in, and each bag, encoded once, meets the days of its interval by that start.
    Days before the first bag have none: they get ``empty`` and take no part in the join.
    """
    columns = [c for c in bags.columns if c not in ("stock_symbol", "date")]
    starts = bags.select("stock_symbol", "date", F.lit(True).alias("_starts"))
    dated = ffill_key(days.join(starts, ["stock_symbol", "date"], "left"), F.col("_starts").isNotNull(), out).drop("_starts")
    valid = dated.join(bags.withColumnRenamed("date", out), ["stock_symbol", out])
    before = dated.where(F.col(out).isNull()).withColumns(empty)
    return valid.unionByName(before.select(*valid.columns)).select("stock_symbol", "date", out, *columns)
