"""Pieces of words learned from a corpus, longest match first, and texts packed as their ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.functions.text import leading_tokens, tokens
from tapeloom.operators.features import PAD, UNKNOWN
from tapeloom.operators.joins import FEW_KEYS, frequent_apart, salted_join
from tapeloom.session import staged

#: Letters of the longest piece; the mark of a piece that goes on inside a word.
LONGEST, INNER = 8, "##"


def substrings(word: Column) -> Column:
    """All (start, length, piece) of a word, inner pieces marked."""

    def at(start: Column) -> Column:
        lengths = F.sequence(F.lit(1), F.least(F.lit(LONGEST), F.length(word) - start))
        mark = F.when(start > 0, F.lit(INNER)).otherwise(F.lit(""))
        return F.transform(
            lengths,
            lambda n: F.struct(start.alias("start"), n.alias("length"), F.concat(mark, F.substr(word, start + 1, n)).alias("piece")),
        )

    return F.flatten(F.transform(F.sequence(F.lit(0), F.length(word) - 1), at))


def learned_pieces(df: DataFrame, text: str, size: int = 2000) -> DataFrame:
    """(piece, piece_id): every single letter, and the ``size`` pieces that cover most letters; ids from 2 on.

    A piece covers its length times its count in the corpus. Words are counted first, so each distinct word is cut
    up once. Letters come first, then pieces by coverage; ties by piece.
    """
    words = df.select(F.explode(tokens(F.col(text))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    cut = words.select("n", F.explode(substrings(F.col("word"))).alias("p")).select("n", "p.length", "p.piece")
    counts = staged(cut.groupBy("length", "piece").agg((F.sum("n") * F.col("length")).alias("covered")), "pieces")
    longer = counts.where("length > 1").orderBy(F.desc("covered"), "piece").limit(size)
    kept = counts.where("length = 1").unionByName(longer)
    order = Window.orderBy(F.col("length") > 1, F.desc("covered"), "piece")  # letters and a fixed number of pieces
    return kept.select("piece", (F.row_number().over(order) + 1).cast("int").alias("piece_id"))


def longest_matches(words: DataFrame, pieces: DataFrame) -> DataFrame:
    """(word, ids) for distinct words: from its start on, always the longest piece that fits.

    All substrings of a word meet the pieces by one equi-join: pieces that are counted to be few go to all of them,
    others are copied, so that frequent pieces are spread over tasks. The substrings are many more than Spark takes
    them to be, and are never broadcast. The walk over the matches is then a fold over the word's own positions. A
    letter that is no piece is unknown.
    """
    cut = words.select("word", F.explode(substrings(F.col("word"))).alias("p")).select("word", "p.*")
    pieces = staged(pieces, "kept-pieces")
    if pieces.count() <= FEW_KEYS:
        met = cut.join(F.broadcast(pieces), "piece")
    else:
        met = salted_join(cut.hint("merge"), pieces, ["piece"], "inner", F.col("word"))
    best = met.groupBy("word", "start").agg(F.max(F.struct("length", "piece_id")).alias("best"))
    found = best.groupBy("word").agg(F.map_from_entries(F.collect_list(F.struct("start", "best"))).alias("at"))
    whole = words.join(found, "word", "left")
    state = F.struct(F.lit(0).alias("next"), F.array().cast("array<int>").alias("ids"))

    def step(acc: Column, k: Column) -> Column:
        here = F.try_element_at("at", k)
        taken = F.struct(
            (k + F.coalesce(here["length"], F.lit(1))).alias("next"),
            F.concat(acc["ids"], F.array(F.coalesce(here["piece_id"], F.lit(UNKNOWN)))).alias("ids"),
        )
        return F.when(acc["next"] == k, taken).otherwise(acc)

    walked = F.aggregate(F.sequence(F.lit(0), F.length("word") - 1), state, step, lambda acc: acc["ids"])
    return whole.select("word", walked.alias("ids"))


def subword_pack(df: DataFrame, key: str, text: str, pieces: DataFrame, max_len: int = 32) -> DataFrame:
    """Exactly ``max_len`` piece ids and a 0/1 mask per text, cut or padded at the end.

    Only the leading words of a text travel; each distinct one is matched once. ``key`` identifies a text.
    """
    led = df.select(key, F.posexplode(leading_tokens(F.col(text), max_len)).alias("place", "word"))
    led = staged(led, "leading-words")
    words = staged(led.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "distinct-words")
    matched = staged(longest_matches(words.select("word"), pieces).join(words, "word"), "matched-words")
    met = frequent_apart(led, matched, ["word"], "n")
    entries = F.array_sort(F.collect_list(F.struct("place", "ids")))
    packed = met.groupBy(key).agg(F.slice(F.flatten(F.transform(entries, lambda e: e["ids"])), 1, max_len).alias("ids"))
    whole = df.select(key).join(packed, key, "left")
    ids = F.coalesce("ids", F.array().cast("array<int>"))
    rest = F.lit(max_len) - F.size(ids)
    return whole.select(
        key,
        F.concat(ids, F.array_repeat(F.lit(PAD), rest)).alias("token_ids"),
        F.concat(F.array_repeat(F.lit(1), F.size(ids)), F.array_repeat(F.lit(0), rest)).alias("mask"),
    )
