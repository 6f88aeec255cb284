"""Documents that hold passages of a benchmark, found by spaced seeds.

A seed is the hash of the tokens under the ones of a mask, laid at one position; tokens under
the zeros may differ. Seeds of all positions of all documents are joined with those of the
benchmark. Around each hit the tokens of both sides are laid against each other, and the
hit counts if enough of them agree, so that a passage is found although words in it were
replaced. A hit inside a long item counts as well if a short stretch across it agrees, so that
a part of a passage is found too. Items too short for a seed must stand in the document word for
word. All of it is DataFrame operations; the windows of a document are never stored, a hit takes
only the tokens around it along, and a text that many items share is compared once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.runtime import quoted

#: The masks. All have the same span.
MASKS = ("1110100111", "1101110101", "1011011011")
SPAN = len(MASKS[0])

#: Production parameters: tokens looked at before and after a hit, and how many of a hundred agree.
CONTEXT, PERCENT = 10, 75

#: A hit counts too if so many tokens agree in some stretch of so many aligned tokens that covers it.
STRETCH_AGREEING, STRETCH = 13, 17

#: The benchmark's seeds are broadcast up to this many; beyond it they are joined by a shuffle.
MAX_BROADCAST_SEEDS = 1_000_000


#: Fixed value: letters of scripts that put no spaces between words.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"


def tokens(text: Column) -> Column:
    """Runs of letters and digits, lower-cased; each letter of scripts without spaces is one."""
    spaced = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), UNSPACED, " $0 ")
    plain = F.regexp_replace(spaced, r"[^\p{L}\p{N}]+", " ")
    return F.split(F.trim(plain), " ")


def seeds(words: str, at: str) -> Column:
    """The seeds of one position, one for each mask."""

    def seed(number: int, mask: str) -> Column:
        return F.xxhash64(F.lit(number), *[F.get(words, F.col(at) + k) for k, one in enumerate(mask) if one == "1"])

    return F.array(*[seed(n, mask) for n, mask in enumerate(MASKS)])


def windows(rows: DataFrame, words: str, at: str) -> DataFrame:
    """``rows`` once for each position and mask, with ``at`` and ``seed``; none if there are too few words."""
    last = F.size(words) - SPAN
    placed = rows.select("*", F.explode(F.when(last >= 0, F.sequence(F.lit(0), last))).alias(at))
    return placed.select("*", F.explode(seeds(words, at)).alias("seed"))


def passages(rows: DataFrame, words: str, sizes: list[int]) -> DataFrame:
    """``rows`` once for each run of so many tokens, with the run as ``passage`` and its ``length``."""
    placed = rows.select("*", F.explode(F.sequence(F.lit(0), F.size(words) - 1)).alias("at"))
    runs = [
        F.when(
            F.col("at") + n <= F.size(words),
            F.struct(F.array_join(F.slice(words, F.col("at") + 1, n), " ").alias("passage"), F.lit(n).alias("length")),
        )
        for n in sizes
    ]
    return placed.select("*", F.explode(F.array_compact(F.array(*runs))).alias("run")).select("*", "run.*")


def near(at: Column) -> Column:
    """The tokens that a hit at ``at`` is judged by: from ``CONTEXT`` before it, or the first, to ``CONTEXT`` after it."""
    return F.slice("words", near_start(at) + 1, F.lit(SPAN + 2 * CONTEXT))


def near_start(at: Column) -> Column:
    return F.greatest(at - CONTEXT, F.lit(0))


def found_hits(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Seeds that ``rows`` (``doc``, ``words``) and ``texts`` (``key``, ``item_words``) share: ``doc``, ``at``, ``item_at``,
    ``item_words``, ``key`` and the tokens around the hit (``near``). A document's other tokens stay behind: it may have
    very many hits, and a task holds all those of a document at once.
    """
    item_seeds = windows(texts, "item_words", "item_at").select("seed", "key", "item_at")
    count = texts.agg(F.sum(F.greatest(F.size("item_words") - SPAN + 1, F.lit(0)))).first()[0] or 0
    if count * len(MASKS) <= MAX_BROADCAST_SEEDS:
        hits = windows(rows, "words", "at").join(F.broadcast(item_seeds), "seed")
        hits = hits.select("doc", "at", "item_at", "key", near(F.col("at")).alias("near"))
        return hits.join(F.broadcast(texts), "key")
    # only hits and the rows they are in meet the tokens again; a seed tells the mask as well
    rows = rows.withColumn("row", F.xxhash64("doc", "words"))
    found = windows(rows, "words", "at").select("row", "at", "seed").join(item_seeds, "seed")
    found = found.select("row", "at", "seed", "key", "item_at").distinct()
    hits = found.join(rows, "row").select("doc", "at", "item_at", "key", near(F.col("at")).alias("near"))
    return hits.join(texts, "key")


def agreeing(first: Column, end: Column) -> Column:
    """How many of the item's tokens from ``first`` to ``end`` stand at the same distance from the hit in the document."""
    places = F.sequence(first, end - 1)
    shift = F.col("at") - F.col("item_at") - near_start(F.col("at"))
    return F.size(F.filter(places, lambda k: F.get("near", k + shift).eqNullSafe(F.get("item_words", k))))


def has_stretch() -> Column:
    """Whether ``STRETCH_AGREEING`` of the item's tokens in a stretch of ``STRETCH`` that covers the hit agree."""
    shift = F.col("at") - F.col("item_at") - near_start(F.col("at"))
    places = F.sequence(F.col("item_at") + SPAN - STRETCH, F.col("item_at") + STRETCH - 1)
    same = F.filter(places, lambda k: F.coalesce(F.get("near", k + shift) == F.get("item_words", k), F.lit(False)))
    later = F.slice(same, STRETCH_AGREEING, STRETCH)
    apart = F.zip_with(F.slice(same, 1, F.size(later)), later, lambda a, b: b - a)
    return F.exists(apart, lambda d: d < STRETCH)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row for each document and benchmark item that it holds a passage of.

    Columns: the ids, ``n_hits`` (seeds whose surroundings agree) and ``most_agreeing`` (the most
    tokens that agree around one of them). Around a hit up to ``CONTEXT`` tokens of the item on
    either side are compared; ``PERCENT`` of a hundred must agree. Where no hit of a pair passes
    that, hits count that lie in a stretch of ``STRETCH`` aligned tokens of which
    ``STRETCH_AGREEING`` agree: a verbatim run of so many tokens is found wherever it stands in
    the item and however long the item is. Items of fewer than ``SPAN`` tokens count wherever all
    their tokens stand in the document, in order and next to each other; an item of one word is
    held by each document that has the word. Items without a token are never reported. Rows of
    one document id are one document, likewise items; null ids are an id of their own. Null texts
    have no tokens. Other columns are not looked at. An empty benchmark gives no rows.
    """
    rows = docs.select(F.col(quoted(id_col)).alias("doc"), tokens(F.col(quoted(text_col))).alias("words"))
    items = benchmark.select(
        F.col(quoted(item_col)).alias("item"), tokens(F.col(quoted(item_text_col))).alias("item_words")
    ).withColumn("key", F.xxhash64("item_words"))
    items = items.where(F.get("item_words", F.lit(0)) != "").dropDuplicates(["item", "key"])
    texts = items.select("key", "item_words").dropDuplicates(["key"])  # one text may stand under many ids
    length = F.size("item_words")
    sums = items.agg(F.count("*"), F.count_if(length < SPAN), F.collect_set(F.when(length < SPAN, length))).first()
    n_items, n_short, short_sizes = sums[0], sums[1], sorted(sums[2])

    hits = found_hits(rows, texts)
    first = F.greatest(F.lit(0), F.col("item_at") - CONTEXT)
    end = F.least(F.size("item_words"), F.col("item_at") + SPAN + CONTEXT)
    compared = hits.select("*", (end - first).alias("compared"), agreeing(first, end).alias("agree"))
    around = F.col("agree") * 100 >= F.col("compared") * PERCENT
    counted = compared.select("doc", "key", "agree", around.alias("around"), (around | has_stretch()).alias("counts"))
    sums = [F.count_if("around").alias("n_around"), F.count("*").alias("n"), F.max("agree").alias("most")]
    most_around = F.max(F.when(F.col("around"), F.col("agree"))).alias("most_around")
    counted = counted.where("counts").groupBy("doc", "key").agg(*sums, most_around)
    ids = items.select("key", "item")
    counted = counted.join(F.broadcast(ids) if n_items <= MAX_BROADCAST_SEEDS else ids, "key").drop("key")
    if n_short:
        short = items.where(length < SPAN).select("item", F.array_join("item_words", " ").alias("passage"))
        short = F.broadcast(short) if n_short <= MAX_BROADCAST_SEEDS else short
        runs = passages(rows, "words", short_sizes).select("doc", "passage", "length").join(short, "passage")
        one = F.lit(1).cast("long")
        counted = counted.unionByName(
            runs.select(
                "doc", "item", one.alias("n_around"), one.alias("n"), F.col("length").alias("most"), F.col("length").alias("most_around")
            )
        )
    n_around = F.sum("n_around")
    return (
        counted.groupBy("doc", "item")
        .agg(
            F.when(n_around > 0, n_around).otherwise(F.sum("n")).alias("n_hits"),
            F.coalesce(F.max("most_around"), F.max("most")).cast("long").alias("most_agreeing"),
        )
        .select(F.col("doc").alias(id_col), F.col("item").alias(item_col), "n_hits", "most_agreeing")
    )


def remove(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that hold no passage of the benchmark; same columns. Rows without an id go
    if any row without an id holds one."""
    held = contaminated(docs, benchmark, id_col, text_col).select(F.col(quoted(id_col)).alias("_held")).distinct()
    return docs.join(held, F.col(quoted(id_col)).eqNullSafe(F.col("_held")), "left_anti")
