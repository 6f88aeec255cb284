import random
import sys
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).resolve().parent))
from helpers import table  # noqa: E402

from tapeloom.llm import near_dedup  # noqa: E402


def sets_of(size, similarity, draw):
    """Two sets of ``size`` hashes with about this similarity."""
    both = round(2 * size * similarity / (1 + similarity))
    rest = draw.integers(0, 2**63, size=2 * size - both, dtype=np.int64).astype(np.uint64)
    return np.unique(rest[:size]), np.unique(np.concatenate([rest[:both], rest[size:]]))


def test_registers_agree_as_often_as_the_sets_are_alike():
    draw = np.random.default_rng(3)
    for size in (3, 40, 600):
        for want in (0.0, 0.5, 0.8):
            pairs = [sets_of(size, want, draw) for _ in range(50)]
            true = np.mean([len(np.intersect1d(*p)) / len(np.union1d(*p)) for p in pairs])
            a, b = (near_dedup.sketches([p[k] for p in pairs]) for k in (0, 1))
            sizes = [np.array([len(p[k]) for p in pairs], float) for k in (0, 1)]
            assert abs(near_dedup.estimates(a, b, *sizes).mean() - true) < 0.02
            assert true - 0.02 < (a == b).mean() < true + 0.05
            bands = (a == b).reshape(50, near_dedup.BANDS, near_dedup.ROWS).all(axis=2)
            if want == 0.8:
                assert bands.any(axis=1).all()


def test_registers_of_a_union_are_the_larger_ones():
    draw = np.random.default_rng(4)
    a, b = sets_of(300, 0.2, draw)
    one, two, both = near_dedup.sketches([a, b, np.union1d(a, b)])
    assert (np.maximum(one, two) == both).all()


def shingles(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def by_hand(rows, size, percent):
    sets = [(i, shingles(t, size)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [(i, len(shingles(t, size)), None if i is None else find(i), i is None or find(i) == i) for i, t in rows]


def near_rows():
    draw = random.Random(6)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(4))
    rows, number = [], 0

    def add(text):
        nonlocal number
        rows.append((number, text))
        number += 1

    for _ in range(25):
        add(" ".join(word() for _ in range(draw.randint(1, 120))))
    for _ in range(4):  # copies of one text with few or more words replaced
        base = [word() for _ in range(90)]
        for k in range(14):
            copy = list(base)
            for _ in range(k % 5):
                copy[draw.randrange(90)] = word()
            add(" ".join(copy).upper() if k == 3 else "\n ".join(copy))
    text = [word() for _ in range(150)]
    for k in range(12):  # a chain: neighbours are alike, the ends are not
        add(" ".join(text[6 * k : 6 * k + 80]))
    draw.shuffle(rows)
    rows += [(200, None), (201, ""), (202, " \n\t"), (203, "one two"), (204, "ONE  two"), (205, "x " * 30_000), (206, "X " * 40_000)]
    return rows + [rows[0], rows[0], (None, rows[0][1]), (None, None)]


def test_groups_against_brute_force(spark):
    rows = near_rows()
    got = near_dedup.near_duplicates(table(spark, rows), size=4).collect()
    have = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got), key=repr)
    assert have == sorted(by_hand(rows, 4, 80), key=repr)
    assert len({c for _, _, c, _ in have}) < len(rows) - 40  # there is something to find


def test_kept_documents_and_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "ROUNDS", 0)  # blocks alone
    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    rows = near_rows()
    kept = near_dedup.keep_one(table(spark, rows))
    want = sorted((i for i, _, _, k in by_hand(rows, 5, 80) if k), key=repr)
    assert kept.columns == table(spark, rows).columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == want


def test_no_documents(spark):
    assert near_dedup.near_duplicates(table(spark, [])).count() == 0


def test_components_of_chains_stars_and_circles(spark):
    chain = [(k, k + 1) for k in range(40)]
    star = [(100, 100 + k) for k in range(1, 30)]
    circle = [(200 + k, 200 + (k + 1) % 9) for k in range(9)]
    edges = spark.createDataFrame(chain + star + circle + [(5, 6), (6, 5)], "a long, b long")
    got = {r["node"]: r["label"] for r in near_dedup.components(edges).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), **dict.fromkeys(range(200, 209), 200)}


def test_one_component_per_id(spark):
    """Rows of one id are one document: it joins the groups of all its texts, and they stay or go together."""
    one, two, three = (" ".join(f"{c}{k}" for k in range(30)) for c in "abc")
    rows = [(3, one), (5, one), (5, two), (7, two), (8, three), (8, ""), (9, three), (9, three), (10, ""), (10, three + " d1")]
    got = near_dedup.near_duplicates(table(spark, rows)).collect()
    found = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got)
    assert {(d, c) for d, _, c, _ in found} == {(3, 3), (5, 3), (7, 3), (8, 8), (9, 8), (10, 8)}
    assert len(found) == len(rows) and all(k == (d == c) for d, _, c, k in found)
    assert sorted({(r["doc_id"], r["text"]) for r in near_dedup.keep_one(table(spark, rows)).collect()}) == [(3, one), (8, ""), (8, three)]


def test_links_of_a_group_are_closed_one_link_a_node(spark):
    """Many links inside one group, and groups that meet only through later turns."""
    draw = random.Random(4)
    edges = [(a, b) for a in range(120) for b in draw.sample(range(120), 9) if a != b]
    edges += [(1000 + k, 2000 + k // 2) for k in range(40)] + [(1000 + k, 2000 + (k + 1) // 2) for k in range(39)]
    got = {r["node"]: r["label"] for r in near_dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: 0 if n < 120 else 1000 for e in edges for n in e}


def test_small_sets_share_a_band():
    draw = np.random.default_rng(5)
    pairs = [np.sort(draw.integers(0, 2**63, size=5, dtype=np.int64).astype(np.uint64)) for _ in range(6000)]
    a, b = near_dedup.sketches(pairs), near_dedup.sketches([p[:4] for p in pairs])
    assert (a == b).reshape(6000, near_dedup.BANDS, near_dedup.ROWS).all(axis=2).any(axis=1).all()
