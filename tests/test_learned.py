"""Learned pieces, class chances, vectors, samples and tiles against plain versions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapeloom.operators import bayes, embedding, joins, pairs, stats, subwords
from tapeloom.operators import series as ts
from tapeloom.session import staged

WORDS = "an ant anthem banana band hand handy sand sandy um drum".split()


def texts(spark, n=60, seed=1):
    draw = random.Random(seed)
    rows = [(k, " ".join(draw.choice(WORDS) for _ in range(draw.randint(0, 12)))) for k in range(n)]
    return spark.createDataFrame([*rows, (n, None), (n + 1, ""), (n + 2, "!! 12")], "doc_id long, text string"), rows


def test_longest_match_like_a_loop(spark):
    df, rows = texts(spark)
    pieces = {r.piece: r.piece_id for r in subwords.learned_pieces(df, "text", 30).collect()}
    assert {c for _, t in rows for w in t.split() for c in w[:1]} <= set(pieces)
    assert sorted(pieces.values()) == list(range(2, len(pieces) + 2))

    def match(word):
        at, ids = 0, []
        while at < len(word):
            for n in range(min(8, len(word) - at), 0, -1):
                piece = ("##" if at else "") + word[at : at + n]
                if piece in pieces:
                    ids.append(pieces[piece])
                    at += n
                    break
            else:
                ids.append(1)
                at += 1
        return ids

    other = spark.createDataFrame([(1, "bandana xylophone"), (2, None), (3, "handsand " * 40)], "doc_id long, text string")
    table = spark.createDataFrame(list(pieces.items()), "piece string, piece_id int")
    got = {r.doc_id: r for r in subwords.subword_pack(other, "doc_id", "text", table).collect()}
    for key, words in ((1, ["bandana", "xylophone"]), (2, []), (3, ["handsand"] * 40)):
        want = [i for w in words for i in match(w)][:32]
        assert got[key].token_ids == want + [0] * (32 - len(want)) and sum(got[key]["mask"]) == len(want)


def test_exploded_words_are_never_broadcast(spark, monkeypatch):
    """Spark takes words and their substrings to be as small as the texts they come from."""
    df, _ = texts(spark)
    few = subwords.learned_pieces(df, "text", 30)
    for limit in (joins.FEW_KEYS, 3):
        monkeypatch.setattr(joins, "FEW_KEYS", limit)
        monkeypatch.setattr(subwords, "FEW_KEYS", limit, raising=False)
        words = staged(df.select(F.explode(F.split("text", " ")).alias("word")).distinct(), "words")
        for made in (subwords.longest_matches(words, few), subwords.subword_pack(df, "doc_id", "text", few)):
            plan = made._jdf.queryExecution().executedPlan().toString()
            assert "BuildRight" in plan and "BuildLeft" not in plan


def test_bayes_like_the_formula(spark):
    df, rows = texts(spark, 40)
    labelled = df.withColumn("label", F.when(F.col("doc_id") % 4 < 3, F.col("doc_id") % 2).cast("int"))
    model = bayes.fit_tokens(labelled, "text", "label", 3)
    got = {r.doc_id: r.chances for r in bayes.class_chances(df, "doc_id", "text", model).collect()}
    known = [(t, k % 2) for k, t in rows if k % 4 < 3] + [("", 0), ("", 1), ("", 0)][: sum(k % 4 < 3 for k in (40, 41, 42))]
    vocabulary = {w for t, _ in known for w in t.split()}
    count = {c: [w for t, y in known if y == c for w in t.split()] for c in range(3)}
    shares = [max(sum(y == c for _, y in known), 0.5) for c in range(3)]
    for key, text in rows:
        logits = []
        for c in range(3):
            each = [math.log((count[c].count(w) + 1) / (len(count[c]) + len(vocabulary))) for w in text.split() if w in vocabulary]
            logits.append(sum(each) + math.log(shares[c] / sum(shares)))
        raised = [math.exp(x - max(logits)) for x in logits]
        assert got[key] == pytest.approx([x / sum(raised) for x in raised], abs=1e-9)
    assert sum(got[40]) == pytest.approx(1.0)  # a null text: the classes' shares


def test_chances_travel_as_sums(spark, monkeypatch):
    """No row per text and token is shuffled, but for rare tokens; chances are the same with few and many tokens."""
    df, _ = texts(spark, 40)
    model = bayes.fit_tokens(df.withColumn("label", (F.col("doc_id") % 3).cast("int")), "text", "label", 3)
    found = bayes.class_chances(df, "doc_id", "text", model)
    dealt = [x for x in found._jdf.queryExecution().executedPlan().toString().splitlines() if "hashpartitioning" in x]
    assert dealt and not any("token" in x for x in dealt)
    want = {r.doc_id: pytest.approx(r.chances) for r in found.collect()}
    for limit in (0, 4):
        monkeypatch.setattr(joins, "FEW_KEYS", limit)
        assert {r.doc_id: r.chances for r in bayes.class_chances(df, "doc_id", "text", model).collect()} == want


def test_narrow_tables_meet_long_rows_where_they_are(spark, monkeypatch):
    rows = spark.range(50).selectExpr("id % 9 AS k", "id AS long_cell")
    narrow = spark.range(20).selectExpr("id % 5 AS k", "id AS n")
    want = sorted(map(tuple, rows.join(narrow, "k").collect()))
    for limit in (joins.FEW_NARROW, 3):
        monkeypatch.setattr(joins, "FEW_NARROW", limit)
        assert sorted(map(tuple, joins.keyed_join(rows, narrow, ["k"]).collect())) == want


def test_frequent_keys_are_joined_apart(spark, monkeypatch):
    rows = spark.range(1000).selectExpr("id", "CASE WHEN id % 3 > 0 THEN 0 ELSE id % 50 END AS k")
    keyed = rows.groupBy("k").count().where("k < 40").withColumnRenamed("count", "n")
    want = sorted(map(tuple, rows.join(keyed, "k").select("id", "k", "n").collect()))
    assert sorted(map(tuple, joins.frequent_apart(rows, keyed, ["k"], "n").select("id", "k", "n").collect())) == want
    monkeypatch.setattr(joins, "FEW_KEYS", 10)
    apart = joins.frequent_apart(rows, keyed, ["k"], "n", hot=100)
    assert sorted(map(tuple, apart.select("id", "k", "n").collect())) == want


def test_range_basis_is_near_the_best_one(spark):
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(300, 3)) @ rng.normal(size=(3, 20)) + 0.01 * rng.normal(size=(300, 20))
    df = spark.createDataFrame([(k, r.tolist()) for k, r in enumerate(rows)], "id long, v array<double>")
    basis = embedding.range_basis(df, "v", 20, rank=3)
    assert basis.T @ basis == pytest.approx(np.eye(3), abs=1e-9)
    left = np.linalg.norm(rows - rows @ basis @ basis.T)
    best = np.sqrt((np.linalg.svd(rows)[1][3:] ** 2).sum())
    assert left == pytest.approx(best, rel=1e-3)
    assert embedding.range_basis(df.limit(0), "v", 20) is None
    flat = embedding.orthonormal(np.array([[1.0, 2.0], [1.0, 2.0]]))
    assert flat[:, 1].tolist() == [0.0, 0.0]


def test_models_get_small_parts_of_a_batch(spark):
    """At most so many texts or bytes at once, a longer text alone; values stay with their rows."""
    rows = [(k, ("é" if k % 50 == 3 else "x") * (k % 50) if k % 9 else None) for k in range(700)] + [(700, "y" * 5000)]
    df = spark.createDataFrame(rows, "k long, text string").coalesce(1)

    def load():
        def model(texts):
            sizes = [len(t.encode()) if t else 0 for t in texts]
            return [[float(n), float(len(sizes)), float(sum(sizes))] for n in sizes]

        return model

    got = {r.k: r.v for r in embedding.score_batches(df, "text", load, "v", "array<double>", 30, 400).collect()}
    assert {k: v[0] for k, v in got.items()} == {k: len((t or "").encode()) for k, t in rows}
    assert max(v[1] for v in got.values()) == 30
    assert all(v[2] <= 400 for k, v in got.items() if k < 700) and got[700] == [5000.0, 1.0, 5000.0]


def test_samples_are_the_same_by_both_ways(spark, monkeypatch):
    df = spark.range(5000).repartition(6)
    one = {r.id for r in pairs.random_sample(df, ["id"], 70).collect()}
    monkeypatch.setattr(pairs, "MERGED_ROWS", 0)
    assert {r.id for r in pairs.random_sample(df, ["id"], 70).collect()} == one and len(one) == 70
    assert pairs.random_sample(df, ["id"], 9000).count() == 5000


def test_tiles_of_hot_values_and_hot_groups(spark):
    """Most rows have one value, most rows are one symbol; ties go by date."""
    draw, rows = random.Random(7), []
    for k in range(900):
        symbol = "a" if k < 800 else "b"
        rows.append((symbol, k, 0.0 if k % 5 else draw.gauss(0, 1), float(k % 7)))
    df = spark.createDataFrame(rows, "stock_symbol string, k int, x double, y double")
    df = df.withColumn("date", F.date_add(F.lit("2020-01-01").cast("date"), F.col("k"))).repartition(5)
    got = {(r.stock_symbol, r.date): (r.tx, r.ty) for r in ts.tiles(df, {"x": "tx", "y": "ty"}).collect()}
    want = df.selectExpr("stock_symbol", "date", *[f"ntile(10) OVER (PARTITION BY stock_symbol ORDER BY {c}, date) AS t{c}" for c in "xy"])
    assert got == {(r.stock_symbol, r.date): (r.tx, r.ty) for r in want.collect()} and len(got) == 900


def test_quantiles_of_large_groups_keep_few_rows(spark, monkeypatch):
    """Brackets of a coarse sketch, so that most rows only count; groups of all sizes, a null one among them."""
    monkeypatch.setattr(stats, "ACCURACY", 100)
    rng = np.random.default_rng(8)
    values = {"a": rng.normal(size=5000), "b": np.repeat([1.0, 2.0, 3.0], 700), None: rng.integers(0, 4, 150).astype(float), "c": rng.normal(size=3)}
    rows = [(g, float(v)) for g, vs in values.items() for v in vs] + [("a", None), ("d", None), ("a", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    shares = {"low": 0.01, "third": 0.33, "mid": 0.5, "high": 0.99, "top": 1.0, "bottom": 0.0}
    got = {r["g"]: r for r in stats.quantiles(df, "v", shares, ("g",)).collect()}
    assert set(got) == set(values)
    for g, vs in values.items():
        assert [got[g][n] for n in shares] == pytest.approx([np.quantile(vs, p) for p in shares.values()])
    pooled = stats.quantiles(df, "v", shares).first()
    every = np.concatenate(list(values.values()))
    assert [pooled[n] for n in shares] == pytest.approx([np.quantile(every, p) for p in shares.values()])
    summary = stats.describe(df.where("g = 'a'"), "v").first()
    assert (summary["lowest"], summary["q50"]) == pytest.approx((values["a"].min(), np.quantile(values["a"], 0.5)))
    assert stats.quantiles(df.limit(0), "v", shares).first()["mid"] is None
