import random

from helpers import by_id, table

from tapeloom.llm import periodic_runs


def by_hand(words, least):
    """All maximal stretches with words q apart equal, for every q; the least q of a stretch counts."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        k = 0
        while k + q < len(words):
            end = k
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            if end > k and end - k + q >= max(least, 2 * q):
                found.setdefault((k, end - k + q), q)
            k = max(end, k + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def draws(n, seed):
    draw = random.Random(seed)
    for _ in range(n):
        letters, words, size = draw.choice([1, 2, 3, 8]), [], draw.randint(0, 90)
        while len(words) < size:
            piece = [draw.randrange(letters) for _ in range(draw.randint(1, 8))]
            words += piece * draw.choice([1, 1, 2, 5])
        yield words


def test_runs_are_those_found_by_hand():
    for words in draws(1500, 3):
        for least in (2, 5, 12):
            assert periodic_runs.runs_of(words, least) == by_hand(words, least), words


def test_stretches_hold_every_run():
    texts = [[str(w).encode() for w in words] for words in draws(800, 4)]
    for least in (2, 5, 12):
        assert periodic_runs.runs_of_texts(texts, least) == [by_hand(t, least) for t in texts]


def test_colours_of_paths_are_last_ends():
    draw = random.Random(6)
    words = [draw.randrange(2) for _ in range(300)]
    link, length, prefixes = periodic_runs.suffix_automaton(words)
    paths, last = periodic_runs.LastEnds(link), {}
    for end, state in enumerate(prefixes, 1):
        want, x = {}, state
        while x:
            if x in last:
                want.setdefault(last[x], x)
            last[x] = end
            x = link[x]
        assert dict(paths.access(state, end)) == want
    assert length[prefixes[-1]] == len(words)


def collapsed_by_hand(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def test_awkward_tables(spark):
    long = " ".join(str(k % 997) for k in range(60_000)) + " x" * 20_000
    texts = [None, "", " \n\t", "a", "a " * 12, "a " * 11, "ü  字\x0b" * 6, "a b " * 12, "x y z " * 4 + "x y z", long]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "b c " * 9), (4, "a " * 12)]
    found = by_id(periodic_runs.find_runs(table(spark, rows)).collect())
    assert sum(map(len, found.values())) == len(rows) and len(found[4]) == 2
    for k, text in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        for row in found[k]:
            assert row["n_words"] == len(words)
            runs = [tuple(r) for r in row["runs"]]
            if k == 9:
                assert runs == [(0, 60_000, 997), (60_000, 20_000, 1)]
            else:
                assert runs == by_hand(words, 12)
            assert row["collapsed"] == collapsed_by_hand(words, runs)
    assert found[7][0]["runs"][0]["period"] == 1  # a no-break space parts no words
    assert periodic_runs.find_runs(table(spark, [])).count() == 0
