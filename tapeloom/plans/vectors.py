"""Vectors: text vectors, pooling, projection, distances, losses, linear heads."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tapeloom.functions.text import lexicon_probabilities, sentiment_score
from tapeloom.functions.vectors import (
    contrastive_loss,
    euclidean_distance,
    l2_normalize,
    shifted_distance,
)
from tapeloom.operators import series as ts
from tapeloom.operators.bayes import class_chances, fit_tokens, three_classes
from tapeloom.operators.embedding import (
    attention_pool,
    hashed_text_vectors,
    low_rank_vectors,
    masked_mean_pool,
    project_embedding,
    score_batches,
    symbol_queries,
)
from tapeloom.operators.joins import keyed_join, salted_join
from tapeloom.operators.models import flatten_window, linear_head
from tapeloom.operators.news import news_bag
from tapeloom.operators.pairs import random_split
from tapeloom.operators.timeline import Timeline
from tapeloom.plans.registry import places, plan, r6
from tapeloom.plans.series import TOKENS, scaled_rows
from tapeloom.plans.sql import check_sql
from tapeloom.session import staged
from tapeloom.sources import adapter

KEYS = ["stock_symbol", "date"]
# Frequent words of the given documents, used as the two classes.
NEGATIVE, POSITIVE = ["the", "les", "der", "los"], ["and", "que", "und", "del"]

LEXICON_SQL = r""", words AS (SELECT id, stock_symbol, date,
list_filter(regexp_split_to_array(lower(coalesce(lsa_summary, '')), '[^\p{L}]+'), lambda t: t <> '') AS w FROM dated),
hits AS (SELECT id, stock_symbol, date, len(list_filter(w, lambda t: t IN ('the', 'les', 'der', 'los'))) AS neg,
len(list_filter(w, lambda t: t IN ('and', 'que', 'und', 'del'))) AS pos FROM words),
scored AS (SELECT id, stock_symbol, date, neg / (neg + pos + 1)::DOUBLE AS p_neg, 1 / (neg + pos + 1)::DOUBLE AS p_neu,
pos / (neg + pos + 1)::DOUBLE AS p_pos, (neg + 3 + 5 * pos) / (neg + pos + 1)::DOUBLE AS score FROM hits)
"""


def lexicon_scores(spark, sf_dir):
    chances = lexicon_probabilities(F.col("lsa_summary"), NEGATIVE, POSITIVE)
    news = adapter.dated_news(spark, sf_dir, spread=True)
    scored = news.select("id", *KEYS, chances.alias("p"))
    return scored.withColumn("score", sentiment_score(F.col("p")))


@plan(
    "text_class_score",
    check_sql(
        "dated",
        body=LEXICON_SQL
        + """SELECT id, round(p_neg, 6) AS p_neg, round(p_neu, 6) AS p_neu, round(p_pos, 6) AS p_pos,
round(score, 6) AS score FROM scored""",
    ),
)
def text_class_score(spark, sf_dir):
    return lexicon_scores(spark, sf_dir).select(
        "id",
        *[r6(F.col("p")[i]).alias(name) for i, name in enumerate(("p_neg", "p_neu", "p_pos"))],
        r6("score").alias("score"),
    )


@plan(
    "text_class_bayes",
    f"""WITH labelled AS (SELECT doc_id, text, CASE WHEN toxic = 1 THEN 0 WHEN quality = 1 THEN 2 ELSE 1 END AS label
FROM documents JOIN labels USING (doc_id)),
counts AS (SELECT token, count(*) FILTER (label = 0) AS n0, count(*) FILTER (label = 1) AS n1, count(*) FILTER (label = 2) AS n2
FROM (SELECT label, unnest({TOKENS.format('text')}) AS token FROM labelled) GROUP BY token),
sizes AS (SELECT count(*) AS v, sum(n0) AS a0, sum(n1) AS a1, sum(n2) AS a2 FROM counts),
logs AS (SELECT token, ln((n0 + 1) / (a0 + v)::DOUBLE) AS l0, ln((n1 + 1) / (a1 + v)::DOUBLE) AS l1, ln((n2 + 1) / (a2 + v)::DOUBLE) AS l2
FROM counts, sizes),
texts AS (SELECT greatest(count(*) FILTER (label = 0), 0.5) AS t0, greatest(count(*) FILTER (label = 1), 0.5) AS t1,
greatest(count(*) FILTER (label = 2), 0.5) AS t2 FROM labelled),
sums AS (SELECT doc_id, sum(l0) AS s0, sum(l1) AS s1, sum(l2) AS s2
FROM (SELECT doc_id, unnest({TOKENS.format('text')}) AS token FROM documents) JOIN logs USING (token) GROUP BY doc_id),
logits AS (SELECT doc_id, coalesce(s0, 0) + ln(t0::DOUBLE / (t0 + t1 + t2)) AS x0, coalesce(s1, 0) + ln(t1::DOUBLE / (t0 + t1 + t2)) AS x1,
coalesce(s2, 0) + ln(t2::DOUBLE / (t0 + t1 + t2)) AS x2 FROM documents LEFT JOIN sums USING (doc_id), texts),
raised AS (SELECT doc_id, exp(x0 - greatest(x0, x1, x2)) AS e0, exp(x1 - greatest(x0, x1, x2)) AS e1, exp(x2 - greatest(x0, x1, x2)) AS e2
FROM logits)
SELECT doc_id, round(e0 / (e0 + e1 + e2), 6) AS p_neg, round(e1 / (e0 + e1 + e2), 6) AS p_neu, round(e2 / (e0 + e1 + e2), 6) AS p_pos,
round((e0 + 3 * e1 + 5 * e2) / (e0 + e1 + e2), 6) AS score FROM raised""",
)
def text_class_bayes(spark, sf_dir):
    """Class chances learned from the labelled documents, for all documents, and their score."""
    documents = adapter.texts(spark, sf_dir, "documents", "doc_id").select("doc_id", "text")
    labels = adapter.table(spark, sf_dir, "labels")
    label = three_classes(F.col("toxic") == 1, F.col("quality") == 1)
    labelled = keyed_join(documents, staged(labels.select("doc_id", label.alias("label")), "classes"), ["doc_id"])
    found = class_chances(documents, "doc_id", "text", fit_tokens(labelled, "text", "label", 3))
    return found.select(
        "doc_id",
        *[r6(F.col("chances")[i]).alias(name) for i, name in enumerate(("p_neg", "p_neu", "p_pos"))],
        r6(sentiment_score(F.col("chances"))).alias("score"),
    )


TEXT_VECTORS = f"""counted AS (SELECT doc_id, slot, count(*) AS n FROM (SELECT doc_id,
CAST('0x' || substr(md5(token), 1, 8) AS BIGINT) % 64 AS slot FROM (
SELECT doc_id, unnest({TOKENS.format('text')}) AS token FROM documents)) GROUP BY 1, 2),
norms AS (SELECT doc_id, sqrt(sum(n * n)) AS norm FROM counted GROUP BY 1),
text_vectors AS (SELECT d.doc_id, CAST(d.place AS INTEGER) AS place,
CAST(coalesce(n / norm, 0) AS FLOAT)::DOUBLE AS value
FROM (SELECT doc_id, unnest(range(0, 64)) AS place FROM documents) d
LEFT JOIN counted c ON c.doc_id = d.doc_id AND c.slot = d.place LEFT JOIN norms r ON r.doc_id = d.doc_id)"""


@plan("text_embedding", f"WITH {TEXT_VECTORS} SELECT doc_id, place, round(value, 6) AS value FROM text_vectors")
def text_embedding(spark, sf_dir):
    documents = adapter.table(spark, sf_dir, "documents").select("doc_id", "text")
    return places(hashed_text_vectors(documents, "text"), ["doc_id"], "embedding")


def orthonormal_sql(name: str, source: str) -> str:
    """SQL for the orthonormal columns of ``source`` (j, y): table ``name`` (j, q)."""
    return f"""{name}_steps(k, basis) AS (SELECT 0::BIGINT, []::DOUBLE[][] UNION ALL
SELECT k + 1, list_append(basis, list_transform(v, lambda e: e / sqrt(list_dot_product(v, v)))) FROM (
SELECT k, basis, list_reduce(list_prepend(y, basis), lambda v, q: list_transform(v, lambda e, i: e - list_dot_product(v, q) * q[i])) AS v
FROM {name}_steps JOIN {source} ON j = k)),
{name} AS (SELECT unnest(range(0, 8)) AS j, unnest(basis) AS q FROM {name}_steps WHERE k = 8)"""


def turned_sql(name: str, basis: str) -> str:
    """SQL for the products of the rows' matrix, its transpose and a basis: table ``name`` (j, y)."""
    return f"""{name}_rows AS (SELECT j, list(list_dot_product(x, q) ORDER BY doc_id) AS d FROM hashed, {basis} GROUP BY j),
{name} AS (SELECT j, list(list_dot_product(c, d) ORDER BY place) AS y FROM {name}_rows, by_place GROUP BY j)"""


@plan(
    "text_embedding_learned",
    f"""WITH RECURSIVE {TEXT_VECTORS.replace('% 64', '% 256').replace('range(0, 64)', 'range(0, 256)')},
hashed AS (SELECT doc_id, list(value ORDER BY place) AS x FROM text_vectors GROUP BY doc_id),
by_place AS (SELECT place, list(value ORDER BY doc_id) AS c FROM text_vectors GROUP BY place),
started AS (SELECT j, list(CAST('0x' || substr(md5(i || ':' || j || ':42'), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE - 0.5::DOUBLE ORDER BY i) AS q
FROM range(256) a(i), range(8) b(j) GROUP BY j),
{turned_sql("once", "started")}, {orthonormal_sql("first_basis", "once")},
{turned_sql("twice", "first_basis")}, {orthonormal_sql("basis", "twice")}
SELECT doc_id, CAST(j AS INTEGER) AS place, round(list_dot_product(x, q), 6) AS value FROM hashed, basis""",
)
def text_embedding_learned(spark, sf_dir):
    documents = adapter.texts(spark, sf_dir, "documents", "doc_id").select("doc_id", "text")
    return places(low_rank_vectors(documents, "text"), ["doc_id"], "embedding")


@plan(
    "text_model_batches",
    """SELECT doc_id, CAST(i - 1 AS INTEGER) AS place,
CAST(length(text) - length(replace(text, 'aeiou'[i], '')) AS DOUBLE) AS value
FROM documents, (SELECT unnest(generate_series(1, 5)) AS i)""",
)
def text_model_batches(spark, sf_dir):
    documents = adapter.texts(spark, sf_dir, "documents", "doc_id").select("doc_id", "text")

    def load():
        # A stand-in model: how often each of five letters occurs in a text. It is
        # local, so that it travels to executors that do not have this package.
        return lambda texts: [[float(text.count(c)) for c in "aeiou"] for text in texts]

    scored = score_batches(documents, "text", load, "vector", "array<double>")
    return places(scored, ["doc_id"], "vector")


@plan(
    "masked_mean_pool",
    check_sql(
        "elements",
        body=""", first30 AS (SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY stock_symbol, date ORDER BY id) AS rn
FROM vectors) WHERE rn <= 30)
SELECT stock_symbol, date, CAST(place AS INTEGER) AS place, round(avg(x), 6) AS value
FROM elements SEMI JOIN first30 USING (id) GROUP BY stock_symbol, date, place""",
    ),
)
def pooled_bags(spark, sf_dir):
    bags = news_bag(adapter.vectors(spark, sf_dir))
    pooled = masked_mean_pool(F.col("bag"), F.col("mask"), 64)
    return places(bags.select(*KEYS, pooled.alias("vector")), KEYS, "vector")


def demo_weights(dim: int = 64, hidden: int = 16, out: int = 8) -> dict[str, np.ndarray]:
    """Smooth fixed weights that SQL can compute as well."""
    row, unit = np.arange(dim)[:, None], np.arange(hidden)[None, :]
    back, end = np.arange(hidden)[:, None], np.arange(out)[None, :]
    return {
        "w1": np.sin(row * 0.7 + unit * 1.3),
        "b1": np.zeros(hidden),
        "w2": np.cos(back * 0.5 + end * 0.9),
        "b2": np.full(out, 0.1),
    }


@plan(
    "project_embedding",
    check_sql(
        "elements",
        body=""", hidden AS (SELECT id, h, greatest(sum(x * sin(place * 0.7::DOUBLE + h * 1.3::DOUBLE)), 0) AS v
FROM elements, (SELECT unnest(generate_series(0, 15)) AS h) GROUP BY id, h)
SELECT id, CAST(o AS INTEGER) AS place, round(sum(v * cos(h * 0.5::DOUBLE + o * 0.9::DOUBLE)) + 0.1, 6) AS value
FROM hidden, (SELECT unnest(generate_series(0, 7)) AS o) GROUP BY id, o""",
    ),
)
def projected_vectors(spark, sf_dir):
    vectors = adapter.vectors(spark, sf_dir).select("id", "embedding")
    return places(project_embedding(vectors, "embedding", demo_weights()), ["id"], "projected")


def neighbours(spark, sf_dir):
    """Each vector with the next one and whether their labels agree."""
    vectors = adapter.vectors(spark, sf_dir).select("id", "embedding", "label")
    rows = Timeline.by_id(vectors, (), "id").annotate(position="pos")
    pairs = rows.around(0, 1, lambda w: {"next": F.lead(F.struct("embedding", "label")).over(w)})
    same = F.when(F.col("label") == F.col("next.label"), 1).otherwise(0)
    return pairs.where(F.col("next").isNotNull()).select(
        "id",
        "embedding",
        F.col("next.embedding").alias("next"),
        (F.col("next.label") - F.col("label")).alias("label_diff"),
        same.alias("label"),
    )


def pair_scores(spark, sf_dir):
    pairs = neighbours(spark, sf_dir)
    distance = euclidean_distance(F.col("embedding"), F.col("next"))
    return pairs.select("id", "label", distance.alias("distance"))


@plan(
    "euclidean_distance",
    check_sql("pair_scores", body="SELECT id, label::INTEGER AS label, round(distance, 6) AS distance FROM pair_scores"),
)
def pair_distances(spark, sf_dir):
    return pair_scores(spark, sf_dir).withColumn("distance", r6("distance"))


@plan(
    "shifted_distance",
    check_sql(
        "elements",
        body="""SELECT a.id, round(sqrt(sum((a.x - b.x + 1e-6::DOUBLE) * (a.x - b.x + 1e-6::DOUBLE))), 6) AS distance
FROM elements a JOIN elements b ON b.id = a.id + 1 AND b.place = a.place GROUP BY a.id""",
    ),
)
def shifted_distances(spark, sf_dir):
    distance = shifted_distance(F.col("embedding"), F.col("next"))
    return neighbours(spark, sf_dir).select("id", r6(distance).alias("distance"))


@plan(
    "l2_normalize",
    check_sql(
        "elements",
        body="""SELECT id, CAST(place AS INTEGER) AS place, round(x / sqrt(sum(x * x) OVER (PARTITION BY id)), 6) AS value FROM elements""",
    ),
)
def normalized_vectors(spark, sf_dir):
    unit = l2_normalize(F.col("embedding"))
    return places(adapter.vectors(spark, sf_dir).select("id", unit.alias("unit")), ["id"], "unit")


@plan(
    "contrastive_loss",
    check_sql(
        "pair_scores",
        body="""SELECT round(avg(l), 6) AS mean_loss, round(sum(l), 4) AS sum_loss, round(avg(0.5 * l), 6) AS half_mean_loss FROM (
SELECT label * distance * distance + (1 - label) * pow(greatest(1 - distance, 0), 2) AS l FROM pair_scores)""",
    ),
)
def contrastive_losses(spark, sf_dir):
    label, distance = F.col("label"), F.col("distance")
    return pair_scores(spark, sf_dir).agg(
        r6(F.avg(contrastive_loss(label, distance))).alias("mean_loss"),
        F.round(F.sum(contrastive_loss(label, distance)), 4).alias("sum_loss"),
        r6(F.avg(contrastive_loss(label, distance, scale=0.5))).alias("half_mean_loss"),
    )


@plan(
    "attention_pool",
    check_sql(
        "elements",
        body=""", queries AS (SELECT stock_symbol, place, avg(x) AS q FROM elements GROUP BY 1, 2),
first30 AS (SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY stock_symbol, date ORDER BY id) AS rn
FROM vectors) WHERE rn <= 30),
scores AS (SELECT e.id, e.stock_symbol, e.date, exp(sum(x * q) / 8.0::DOUBLE) AS w FROM elements e SEMI JOIN first30 USING (id)
JOIN queries USING (stock_symbol, place) GROUP BY 1, 2, 3)
SELECT s.stock_symbol, s.date, CAST(place AS INTEGER) AS place, round(sum(x * w) / sum(w), 6) AS value
FROM scores s JOIN elements e USING (id) GROUP BY s.stock_symbol, s.date, place""",
    ),
)
def attended_bags(spark, sf_dir):
    vectors = adapter.vectors(spark, sf_dir)
    queries = symbol_queries(vectors)
    bags = salted_join(news_bag(vectors), queries, ["stock_symbol"], "inner", F.col("date"))
    bag, mask = F.col("bag"), F.col("mask")
    pooled = attention_pool(bag, bag, mask, F.col("query"), 64)
    return places(bags.select(*KEYS, pooled.alias("vector")), KEYS, "vector")


def ridge_sql(keys: str, columns: str = "") -> str:
    """SQL that fits a penalised head on ``data`` (rn, x, y, split) and scores all its rows.

    Normal equations from products of whole columns, solved by conjugate gradients.
    """
    return f""", cells AS (SELECT rn, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM data WHERE split = 'train'),
columns AS (SELECT i, list(v ORDER BY rn) AS c, avg(v) AS m FROM cells GROUP BY i),
labels_of AS (SELECT list(y ORDER BY rn) AS ys, avg(y) AS my, count(*) AS n FROM data WHERE split = 'train'),
gram AS (SELECT list(g ORDER BY i) AS g FROM (SELECT a.i, list(list_dot_product(a.c, b.c) / n - a.m * b.m
+ CASE WHEN a.i = b.i THEN 0.01::DOUBLE ELSE 0 END ORDER BY b.i) AS g FROM columns a, columns b, labels_of GROUP BY a.i)),
right_side AS (SELECT list(list_dot_product(c, ys) / n - m * my ORDER BY i) AS b, list(m ORDER BY i) AS ms, any_value(my) AS my FROM columns, labels_of),
solve(k, w, r, p, rr, first) AS (
SELECT 0, list_transform(b, lambda v: 0::DOUBLE), b, b, list_dot_product(b, b), list_dot_product(b, b) FROM right_side
UNION ALL
SELECT k + 1, w, r, list_transform(r, lambda v, i: v + list_dot_product(r, r) / rr * p[i]), list_dot_product(r, r), first FROM (
SELECT k, list_transform(w, lambda v, i: v + a * p[i]) AS w, list_transform(r, lambda v, i: v - a * q[i]) AS r, p, rr, first FROM (
SELECT *, rr / list_dot_product(p, q) AS a FROM (
SELECT s.*, list_transform(g, lambda row: list_dot_product(row, p)) AS q FROM solve s, gram WHERE rr > first * 1e-28::DOUBLE AND k < 2000)))),
fitted AS (SELECT w, my - list_dot_product(w, ms) AS c FROM (SELECT w FROM solve ORDER BY k DESC LIMIT 1), right_side)
SELECT {keys}, split, {columns}round(list_dot_product(x, w) + c, 6) AS prediction FROM data, fitted"""


HEAD_VECTORS = """, vectors_of AS (SELECT id, embedding::DOUBLE[] AS v, label FROM vectors),
paired AS (SELECT a.id, list_concat(a.v, b.v) AS x, CAST(b.label - a.label AS DOUBLE) AS y FROM vectors_of a JOIN vectors_of b ON b.id = a.id + 1),
data AS (SELECT *, CASE WHEN rn <= ceil(n * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM (
SELECT *, row_number() OVER (ORDER BY md5(id || ':999'), id) AS rn, count(*) OVER () AS n FROM paired))"""


@plan(
    "pair_regression",
    check_sql("vectors", body=HEAD_VECTORS + ridge_sql("id", "y, ")).replace("WITH ", "WITH RECURSIVE ", 1),
)
def pair_regression(spark, sf_dir):
    pairs = neighbours(spark, sf_dir).withColumn("y", F.col("label_diff").cast("double"))
    split = staged(random_split(pairs, ["id"]), "pairs")
    scored = linear_head(
        split.where(F.col("split") == "train"), split, ["embedding", "next"], "y", reg=0.01
    )
    return scored.select("id", "split", "y", r6("prediction").alias("prediction"))


@plan(
    "sequence_forecast",
    check_sql(
        "scaled",
        body=""", data AS (SELECT * FROM (SELECT stock_symbol, date, split, close_scaled AS last_known,
lead(close_scaled, 3) OVER w AS y, lead(close_scaled, 3) OVER w AS target, row_number() OVER w - 1 AS in_part,
flatten(list([CAST(open_scaled AS FLOAT)::DOUBLE, CAST(close_scaled AS FLOAT)::DOUBLE, CAST(volume_scaled AS FLOAT)::DOUBLE]) OVER l) AS x,
row_number() OVER (ORDER BY stock_symbol, date) AS rn FROM scaled
WINDOW w AS (PARTITION BY stock_symbol, split ORDER BY date),
l AS (PARTITION BY stock_symbol, split ORDER BY date ROWS BETWEEN 49 PRECEDING AND CURRENT ROW))
WHERE in_part >= 49 AND y IS NOT NULL)"""
        + ridge_sql("stock_symbol, date", "round(target, 6) AS target, round(last_known, 6) AS last_known, "),
    ).replace("WITH ", "WITH RECURSIVE ", 1),
)
def sequence_forecast(spark, sf_dir):
    rows = scaled_rows(spark, sf_dir)
    features = ["open_scaled", "close_scaled", "volume_scaled"]
    windows = ts.sliding_sequences(rows, features, "close_scaled")
    flat = staged(flatten_window(windows, "window", features).drop("window"), "windows")
    scored = linear_head(flat.where(F.col("split") == "train"), flat, ["flat"], "target", reg=0.01)
    return scored.select(
        *KEYS, "split", r6("target").alias("target"), r6("last_known").alias("last_known"), r6("prediction").alias("prediction")
    )


@plan(
    "single_text_regression",
    f"""WITH RECURSIVE {TEXT_VECTORS}, vector_of AS (SELECT doc_id, list(value ORDER BY place) AS x FROM text_vectors GROUP BY doc_id),
data AS (SELECT *, CASE WHEN rn <= ceil(n * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM (
SELECT doc_id, x, CAST(quality AS DOUBLE) AS y, row_number() OVER (ORDER BY md5(doc_id || ':999'), doc_id) AS rn, count(*) OVER () AS n
FROM vector_of JOIN labels USING (doc_id)))"""
    + ridge_sql("doc_id", "y, "),
)
def single_text_regression(spark, sf_dir):
    labels = adapter.table(spark, sf_dir, "labels").select("doc_id", "quality")
    documents = adapter.table(spark, sf_dir, "documents").select("doc_id", "text")
    joined = hashed_text_vectors(documents, "text").join(labels, "doc_id")
    data = staged(random_split(joined.withColumn("y", F.col("quality").cast("double")), ["doc_id"]), "labelled")
    scored = linear_head(data.where(F.col("split") == "train"), data, ["embedding"], "y", reg=0.01)
    return scored.select("doc_id", "split", "y", r6("prediction").alias("prediction"))


def one_feature(rows, x: str, y: str, keys: list[str]):
    """A least-squares line fitted on the train part, for all rows: what the heads do with one feature."""
    data = staged(rows.withColumn("x", F.array(F.col(x).cast("double"))), "one-feature")
    scored = linear_head(data.where(F.col("split") == "train"), data, ["x"], y)
    return scored.select(*keys, "split", r6("prediction").alias("prediction"))


LINE = """, line AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept FROM data WHERE split = 'train')
SELECT {keys}, split, round(slope * x + intercept, 6) AS prediction FROM data, line"""


@plan(
    "pair_regression_line",
    check_sql(
        "pair_scores",
        body=""", ordered AS (SELECT *, row_number() OVER (ORDER BY md5(id || ':999'), id) AS rn, count(*) OVER () AS n FROM pair_scores),
data AS (SELECT id, distance AS x, CAST(label AS DOUBLE) AS y, CASE WHEN rn <= ceil(n * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split
FROM ordered)"""
        + LINE.format(keys="id"),
    ),
)
def pair_regression_line(spark, sf_dir):
    pairs = pair_scores(spark, sf_dir).withColumn("y", F.col("label").cast("double"))
    return one_feature(random_split(pairs, ["id"]), "distance", "y", ["id"])


@plan(
    "sequence_forecast_line",
    check_sql(
        "scaled",
        body=""", data AS (SELECT * FROM (SELECT stock_symbol, date, split, close_scaled AS x, lead(close_scaled, 3) OVER w AS y,
row_number() OVER w - 1 AS in_part FROM scaled WINDOW w AS (PARTITION BY stock_symbol, split ORDER BY date))
WHERE in_part >= 49 AND y IS NOT NULL)"""
        + LINE.format(keys="stock_symbol, date"),
    ),
)
def sequence_forecast_line(spark, sf_dir):
    windows = ts.sliding_sequences(scaled_rows(spark, sf_dir), [], "close_scaled")
    return one_feature(windows, "last_known", "target", KEYS)


@plan(
    "text_regression_line",
    """WITH labelled AS (SELECT d.doc_id, CAST(d.n_chars AS DOUBLE) AS x, CAST(l.quality AS DOUBLE) AS y
FROM documents d JOIN labels l USING (doc_id)),
ordered AS (SELECT *, row_number() OVER (ORDER BY md5(doc_id || ':999'), doc_id) AS rn, count(*) OVER () AS n FROM labelled),
data AS (SELECT *, CASE WHEN rn <= ceil(n * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM ordered)"""
    + LINE.format(keys="doc_id"),
)
def text_regression_line(spark, sf_dir):
    labels = adapter.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("y"))
    documents = adapter.table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return one_feature(random_split(documents.join(labels, "doc_id"), ["doc_id"]), "n_chars", "y", ["doc_id"])
