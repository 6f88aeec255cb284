"""Multinomial naive Bayes over tokens, counted in Spark and joined by token."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.functions.text import softmax, tokens
from tapeloom.operators.joins import frequent_apart
from tapeloom.session import staged


@dataclass(frozen=True)
class TokenModel:
    """Per token its count and its log chance in each class (``logs``), and the classes' log shares."""

    table: DataFrame
    priors: tuple[float, ...]


def token_rows(df: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """(keys, token): one row per token of each text."""
    return df.select(*keys, F.explode(tokens(F.col(text))).alias("token"))


def fit_tokens(labelled: DataFrame, text: str, label: str, classes: int, smoothing: float = 1.0) -> TokenModel:
    """Counts of tokens per class (0, 1, ...), smoothed; rows without a label do not count.

    The log chance of a token in a class is ln((its count + s) / (the class's tokens + s · vocabulary)). The
    priors are the shares of the texts, a class without texts counting as half a text.
    """
    known = labelled.where(F.col(label).isNotNull())
    each = [F.count_if(F.col(label) == c).alias(f"_n{c}") for c in range(classes)]
    table = staged(token_rows(known, [label], text).groupBy("token").agg(*each), "token-counts")
    fit = table.agg(F.count(F.lit(1)).alias("v"), *[F.sum(f"_n{c}").alias(f"_n{c}") for c in range(classes)]).first()
    texts = known.agg(*[F.count_if(F.col(label) == c).alias(f"_t{c}") for c in range(classes)]).first()
    sizes = [max(float(t), 0.5) for t in texts]
    below = [float(fit[f"_n{c}"] or 0) + smoothing * float(fit["v"]) for c in range(classes)]
    logs = [F.ln((F.col(f"_n{c}") + F.lit(smoothing)) / F.lit(below[c])) for c in range(classes)]
    count = sum((F.col(f"_n{c}") for c in range(classes)), F.lit(0)).alias("count")
    return TokenModel(table.select("token", count, F.array(*logs).alias("logs")), tuple(log(s / sum(sizes)) for s in sizes))


def class_chances(df: DataFrame, key: str, text: str, model: TokenModel) -> DataFrame:
    """(key, chances): the posterior of each class per text; tokens that the model has not seen say nothing.

    Texts and model meet by token, frequent tokens apart from the others: they meet where the text is read, so that
    their logs are added up before the shuffle, and only rare tokens travel. ``key`` identifies a row.
    """
    met = frequent_apart(token_rows(df, [key], text), model.table, ["token"], "count")
    sums = [F.sum(F.col("logs")[c]).alias(f"_s{c}") for c in range(len(model.priors))]
    scored = df.select(key).join(met.groupBy(key).agg(*sums), key, "left")
    logits = F.array(*[F.coalesce(f"_s{c}", F.lit(0.0)) + F.lit(p) for c, p in enumerate(model.priors)])
    return scored.select(key, softmax(logits).alias("chances"))


def three_classes(negative: Column, positive: Column) -> Column:
    """0 negative, 2 positive, 1 neither; negative comes first."""
    return F.when(negative, 0).when(positive, 2).otherwise(1)
