"""Labelled pairs, samples and splits, all by seeded hash order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.functions.keys import random_key, uniform
from tapeloom.operators.joins import salted_join
from tapeloom.operators.timeline import Timeline

SEED = 42


def random_order(
    df: DataFrame, key: Sequence[str], seed: int = SEED, out: str = "rn", total: str | None = None
) -> Timeline:
    """1-based row numbers of the whole table in seeded random order.

    ``key`` must identify a row.
    """
    tagged = df.withColumns(
        {"_key": random_key(*key, seed=seed), "_tie": F.struct(*key)}
    )
    rows = Timeline.by_hash(tagged, (), "_key", "_tie").annotate(position="_pos", total=total)
    return rows.with_columns({out: F.col("_pos") + 1})


def adjacent_pairs(
    df: DataFrame, key: Sequence[str], columns: dict[str, str], seed: int = SEED
) -> DataFrame:
    """Each row with its successor in random order: N rows give N - 1 pairs.

    ``columns`` maps input names to stems; the output has ``<stem>1`` and ``<stem>2``.
    """
    rows = random_order(df, key, seed)
    following = F.struct(*columns)
    paired = rows.around(0, 1, lambda w: {"_next": F.lead(following).over(w)}, position="_pos")
    left = [F.col(c).alias(f"{stem}1") for c, stem in columns.items()]
    right = [F.col(f"_next.{c}").alias(f"{stem}2") for c, stem in columns.items()]
    return paired.where(F.col("_next").isNotNull()).select("rn", *left, *right)


def sampled_pairs(
    df: DataFrame, id_col: str, bin_col: str, payload: Sequence[str] = (), seed: int = SEED
) -> DataFrame:
    """Each anchor with one random partner: half from its own bin (label 1), half
    from another bin (label 0). With a single bin every label is 1.

    Bins are numbered in their order and joined with their sizes, so there may be any
    number of them. The three draws of an anchor name a (bin, number in bin); the partner
    is then found by an equi-join on that, which is spread evenly over the bin.
    """
    members = Timeline.by_id(df.select(id_col, bin_col, *payload), (bin_col,), id_col)
    members = members.annotate(position="_idx").result()
    sizes = df.groupBy(F.col(bin_col).alias("_bin")).agg(F.count("*").alias("_n"))
    sizes = Timeline.by_range(sizes, (), ("_bin",)).annotate(position="_no", total="_bins").result()

    key = random_key(id_col, seed=seed)
    tagged = df.select(id_col, bin_col, *payload).withColumns({"_key": key, "_bin": F.col(bin_col)})
    own = salted_join(tagged, sizes.select("_bin", "_no", "_bins"), ["_bin"], "inner", F.col(id_col))
    same = (uniform(F.col("_key"), 0) < 0.5) | (F.col("_bins") == 1)
    other = F.floor(uniform(F.col("_key"), 1) * (F.col("_bins") - 1))
    other = F.when(other < F.col("_no"), other).otherwise(other + 1)
    drawn = own.select(
        F.col(id_col).alias(f"{id_col}_1"),
        F.col(bin_col).alias(f"{bin_col}_1"),
        *[F.col(c).alias(f"{c}_1") for c in payload],
        F.when(same, 1).otherwise(0).alias("label"),
        F.when(same, F.col("_no")).otherwise(other).alias("_no"),
        uniform(F.col("_key"), 2).alias("_draw"),
    )
    targets = salted_join(drawn, sizes.select("_no", "_bin", "_n"), ["_no"], "inner", F.col(f"{id_col}_1"))
    anchors = targets.withColumn("_idx", F.floor(F.col("_draw") * F.col("_n"))).drop("_no", "_n", "_draw")
    partners = members.select(
        F.col(id_col).alias(f"{id_col}_2"),
        F.col(bin_col).alias("_bin"),
        F.col(bin_col).alias(f"{bin_col}_2"),
        *[F.col(c).alias(f"{c}_2") for c in payload],
        "_idx",
    )
    return anchors.join(partners, ["_bin", "_idx"]).drop("_bin", "_idx")


#: Rows that tasks may send to the one that merges their samples; beyond it a histogram of digests comes first.
MERGED_ROWS = 20_000_000


def random_sample(df: DataFrame, key: Sequence[str], n: int, seed: int = SEED) -> DataFrame:
    """``n`` random rows, or all of them if there are fewer: those of the smallest digests.

    Each task keeps the ``n`` smallest of its rows and one task merges them, in one scan. With so many tasks that
    this would be too much to merge, digests are counted by their leading bits first, and rows above the
    digest that ``n`` rows lie below are left out; the sample is the same.
    """
    tagged = df.withColumn("_key", random_key(*key, seed=seed))
    if df.rdd.getNumPartitions() * n > MERGED_ROWS:
        head = F.substring("_key", 1, 4)
        counts = tagged.groupBy(head.alias("head")).count().orderBy("head").collect()  # 65,536 rows at most
        upto, last = 0, "ffff"
        for row in counts:
            upto += row["count"]
            if upto >= n:
                last = row["head"]
                break
        tagged = tagged.where(head <= last)
    return tagged.orderBy("_key", *key).limit(n).drop("_key")


def random_split(df: DataFrame, key: Sequence[str], share: float = 0.2, seed: int = 999) -> DataFrame:
    """Exactly ceil(n·share) random rows are ``test``, the others ``train``."""
    rows = random_order(df, key, seed, total="_total")
    test = F.col("rn") <= F.ceil(F.col("_total") * F.lit(float(share)))
    split = F.when(test, "test").otherwise("train")
    return rows.result().withColumn("split", split).drop("rn", "_pos", "_key", "_tie", "_total")


def stratified_split(
    df: DataFrame, key: str, stratum: str, share: float = 0.2, seed: int = SEED
) -> DataFrame:
    """Round(n·share) random rows of every stratum are ``test``."""
    tagged = df.withColumn("_key", random_key(key, seed=seed))
    rows = Timeline.by_hash(tagged, (stratum,), "_key", key).annotate(position="_pos", total="_total")
    test = F.col("_pos") < F.round(F.col("_total") * F.lit(float(share)))
    split = F.when(test, "test").otherwise("train")
    return rows.result().withColumn("split", split).drop("_pos", "_total", "_key")
