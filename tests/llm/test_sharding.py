import random
import zlib

from helpers import table

from tapeloom.llm import sharding


def check(rows, out, shards, exact=True):
    """Every row once, gapless slots, shards in the order of places, bytes within the tolerance."""
    assert len(out) == len(rows)
    assert sorted(map(repr, ((r["doc_id"], r["text"]) for r in out))) == sorted(map(repr, rows))
    slots = {}
    for r in out:
        assert r["size"] == len((r["text"] or "").encode()) + 16 and 0 <= r["shard"] < shards
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    held = [sum(r["size"] for r in out if r["shard"] == k) for k in range(shards)]
    total, below = sum(held), 0
    for k in range(1, shards):
        below += held[k - 1]
        if exact:
            assert abs(below - k * total / shards) <= 0.01 * total / shards + 0.5
    return held


def test_bytes_are_even_and_copies_are_neighbours(spark):
    draw = random.Random(3)
    rows = [(k, "x" * int(draw.expovariate(0.05))) for k in range(20_000)]
    rows += [(30_000 + k, "the same text") for k in range(9_000)]
    out = sharding.shard(table(spark, rows), shards=7).collect()
    check(rows, out, 7)
    texts = {}
    for r in sorted(out, key=lambda r: (r["shard"], r["slot"])):
        texts.setdefault(r["text"], []).append((r["shard"], r["slot"]))
    firsts = {}
    for r in out:
        firsts[r["shard"]] = firsts.get(r["shard"], 0) + 1
    start, at = {}, 0
    for k in range(7):
        start[k], at = at, at + firsts.get(k, 0)
    for places in texts.values():
        spots = [start[s] + n for s, n in places]
        assert spots == list(range(spots[0], spots[0] + len(spots)))


def test_numbering_of_hot_texts(spark, monkeypatch):
    """Segments are cut by the digest of the text, then by that of the id, once they hold too many rows."""
    monkeypatch.setattr(sharding, "SEGMENT_ROWS", 40)
    monkeypatch.setattr(sharding, "MOST_ROWS", 80)
    rows = [(k, f"text {k}") for k in range(700)] + [(k, "hot") for k in range(700, 1100)]
    whole = sharding.shard(table(spark, rows), shards=3)
    cut = sharding.segments(whole.select(sharding.place(whole.text, whole.doc_id).alias("place")))
    assert cut[0] == 2 and cut[2].count() == 1
    out = whole.collect()
    check(rows, out, 3)
    places = {r["doc_id"]: r["place"] for r in whole.select("doc_id", sharding.place(whole.text, whole.doc_id).alias("place")).collect()}
    order = [places[r["doc_id"]] for r in sorted(out, key=lambda r: (r["shard"], r["slot"]))]
    assert order == sorted(order)


def test_awkward_tables(spark):
    rows = [(1, None), (2, ""), (None, "a"), (None, "a"), (3, "ü" * 300_000), (4, "b"), (4, "b"), (5, "b"), (None, None)]
    out = sharding.shard(table(spark, rows), shards=5).collect()
    held = check(rows, out, 5, exact=False)
    assert max(held) >= 600_016
    assert len({r["shard"] for r in out if r["doc_id"] == 4}) == 1
    clashing = sharding.shard(table(spark, rows).withColumnRenamed("n", "slot").withColumnRenamed("rest", "place"), shards=2)
    assert clashing.columns.count("slot") == 1 and {r["place"] for r in clashing.collect()} == {"r"}
    assert sharding.shard(table(spark, []), shards=4).count() == 0


def test_shards_as_files(spark, tmp_path):
    rows = [(k, f"text {k}" * (k % 9)) for k in range(400)]
    sharding.write_shards(sharding.shard(table(spark, rows), shards=4), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    check(rows, back.collect(), 4, exact=False)
    assert zlib.crc32(b"text 1") == spark.sql("SELECT crc32('text 1')").first()[0]
