import math
import random
import sys
from collections import Counter, defaultdict
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent), str(Path(__file__).resolve().parents[1])]
from helpers import by_id, table  # noqa: E402

from tapeloom.llm import decontaminate, ngram_lm, runtime, url_filter  # noqa: E402
from tapeloom.llm.queries import URL_RULES  # noqa: E402


def kneser_ney(texts, continuations=None):
    """(chance of a word after a context, count of a word, tokens, words), by dictionaries."""
    count, pairs = Counter(), Counter()
    for text in texts:
        words = [*(text or "").encode().lower().split(), "end"]
        count.update(words)
        pairs.update(zip(["begin", *words], words))
    pairs = continuations or pairs
    total, kinds, types = Counter(), defaultdict(lambda: [0, 0, 0]), Counter()
    for (h, w), n in pairs.items():
        total[h] += n
        kinds[h][min(n, 3) - 1] += 1
        types[w] += 1
    of = Counter(pairs.values())
    high = ngram_lm.discounts_of(*(of[k] for k in (1, 2, 3, 4)))
    of = Counter(types.values())
    less = ngram_lm.discounts_of(*(of[k] for k in (1, 2, 3, 4)))
    mass = sum(less[min(t, 3) - 1] * n for t, n in of.items())

    def kept(n, discounts):
        return n - discounts[min(n, 3) - 1] if n else 0

    def low(w):
        return (kept(types[w], less) + mass / (len(count) + 1)) / len(pairs)

    def chance(h, w):
        if not total[h]:
            return low(w)
        return (kept(pairs[h, w], high) + sum(d * n for d, n in zip(high, kinds[h])) * low(w)) / total[h]

    return chance, count, sum(count.values()), len(count)


def kneser_ney_of_three(texts):
    """As above with contexts of two words: the chance of a word after two others."""
    triples = Counter()
    for text in texts:
        words = [*(text or "").encode().lower().split(), "end"]
        triples.update(zip(["begin", "begin", *words], ["begin", *words], words))
    total, kinds, pairs = Counter(), defaultdict(lambda: [0, 0, 0]), Counter()
    for (g, h, w), n in triples.items():
        total[g, h] += n
        kinds[g, h][min(n, 3) - 1] += 1
        pairs[h, w] += 1
    of = Counter(triples.values())
    high = ngram_lm.discounts_of(*(of[k] for k in (1, 2, 3, 4)))
    below, count, tokens, size = kneser_ney(texts, pairs)

    def chance(g, h, w):
        if not total[g, h]:
            return below(h, w)
        n = triples[g, h, w]
        kept = n - high[min(n, 3) - 1] if n else 0
        return (kept + sum(d * k for d, k in zip(high, kinds[g, h])) * below(h, w)) / total[g, h]

    return chance, count, tokens, size


def texts():
    draw = random.Random(8)
    words = ["the"] * 12 + ["of"] * 6 + [f"w{k}" for k in range(60)]
    return [" ".join(draw.choice(words) for _ in range(draw.randint(0, 80))) for _ in range(120)]


@pytest.mark.parametrize("order", [2, 3])
def test_scores_against_brute_force(spark, monkeypatch, order):
    monkeypatch.setattr(ngram_lm, "FLUSH_TOKENS", 500)
    monkeypatch.setattr(ngram_lm, "FLUSH_TRIPLES", 700)
    corpus = texts()
    rows = [(n, t) for n, t in enumerate(corpus)]
    model = ngram_lm.train(table(spark, rows + [(500, None), (501, "")]), order=order)
    assert len(model.frequent) > 1  # "the" is spread
    if order == 3:
        of_three, count, tokens, size = kneser_ney_of_three([*corpus, None, ""])
    else:
        of_two, count, tokens, size = kneser_ney([*corpus, None, ""])
        of_three = lambda g, h, w: of_two(h, w)
    assert (model.tokens, model.words) == (tokens, size)
    for g, h in (("begin", "begin"), ("begin", b"the"), (b"the", b"the"), (b"w1", b"w3"), (b"?", b"w3")):
        assert math.isclose(sum(of_three(g, h, w) for w in count) + of_three(g, h, "?"), 1)
    asked = rows[:40] + [(900, "the unknown W3 of"), (901, None), (901, ""), (None, "of the " * 3000)]
    got = by_id(ngram_lm.score(table(spark, asked), model).collect())
    for i, text in asked:
        words = [*(text or "").encode().lower().split(), "end"]
        row = got[i][0]
        assert row["n_tokens"] == len(words) and row["n_known"] == sum(count[w] > 0 for w in words)
        base = sum(math.log10((count[w] + 1) / (tokens + size + 1)) for w in words)
        score = sum(math.log10(of_three(*n)) for n in zip(["begin", "begin", *words], ["begin", *words], words))
        assert math.isclose(row["base_score"], base, rel_tol=1e-9) and math.isclose(row["score"], score, rel_tol=1e-9)
        assert math.isclose(row["perplexity"], 10 ** (-score / len(words)), rel_tol=1e-6)
    assert len(got[901]) == 2


def test_model_of_nothing(spark):
    model = ngram_lm.train(table(spark, []))
    assert model.order == 3
    (row,) = ngram_lm.score(table(spark, [(1, "a b")]), model).collect()
    assert (row["n_tokens"], row["n_known"], row["base_score"], row["score"]) == (3, 0, 0.0, 0.0)
    assert ngram_lm.score(table(spark, []), model).count() == 0


def held_by_hand(docs, items):
    """(document, item) pairs by comparing all positions of all items with all of all documents."""
    import re

    cut = lambda t: re.sub(r"[^\w]+|_", " ", (t or "").lower()).split()
    found, c, span = set(), decontaminate.CONTEXT, decontaminate.SPAN
    for doc, text in docs:
        words = cut(text)
        for item, passage in items:
            theirs = cut(passage)
            for at in range(len(words) - span + 1):
                for q in range(len(theirs) - span + 1):
                    masks = decontaminate.MASKS
                    if not any(all(m == "0" or words[at + k] == theirs[q + k] for k, m in enumerate(x)) for x in masks):
                        continue
                    low, end = max(0, q - c), min(len(theirs), q + span + c)
                    place = [k + at - q for k in range(low, end)]
                    agree = sum(0 <= p < len(words) and words[p] == theirs[k] for p, k in zip(place, range(low, end)))
                    if 100 * agree >= decontaminate.PERCENT * (end - low):
                        found.add((doc, item))
    return found


def leak_tables(spark):
    draw = random.Random(9)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(3))
    items = [(n, " ".join(word() for _ in range(draw.randint(5, 45)))) for n in range(12)]
    items += [(50, None), (51, ""), (52, "too short"), (None, " ".join(word() for _ in range(20))), items[3], items[3]]
    docs = [(n, " ".join(word() for _ in range(60))) for n in range(20)]
    for n, (_, passage) in enumerate(items[:12]):
        words = passage.split()
        for k in range(3, len(words), 7):
            words[k] = word()
        docs.append((100 + n, f"{docs[n][1]}. {' '.join(words).upper()}, {docs[n][1]}"))
        docs.append((200 + n, f"{docs[n][1]} {' '.join(words[: len(words) // 4])}"))
    docs += [(300, None), (301, ""), (302, "few words"), (None, items[15 - 2][1]), docs[21], (303, "aaa bbb " * 9000)]
    docs.append((304, items[13][1]))
    benchmark = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, words string, at int")
    return docs, items, benchmark


def test_passages_with_replaced_words(spark, monkeypatch):
    docs, items, benchmark = leak_tables(spark)
    want = held_by_hand([d for d in docs if d[0] != 303], items)
    assert len(want) > 10 and all(d is None or d >= 100 for d, _ in want)
    ways = []
    for most in (decontaminate.MAX_BROADCAST_SEEDS, 0):  # both ways to join
        monkeypatch.setattr(decontaminate, "MAX_BROADCAST_SEEDS", most)
        got = decontaminate.contaminated(table(spark, [*docs, (docs[25][0], docs[22][1])]), benchmark).collect()
        ways.append(sorted(map(str, got)))
        got = decontaminate.contaminated(table(spark, docs), benchmark).collect()
        ways.append(sorted(map(str, got)))
        assert {(r["doc_id"], r["item_id"]) for r in got} == want and len(got) == len(want)
    assert ways[:2] == ways[2:]  # with the same numbers of hits
    gone = {d for d, _ in want}
    left = decontaminate.remove(table(spark, docs), benchmark)
    assert sorted((r["doc_id"] for r in left.collect()), key=repr) == sorted((d for d, _ in docs if d not in gone), key=repr)
    assert decontaminate.contaminated(table(spark, docs), benchmark.limit(0)).count() == 0
    assert decontaminate.contaminated(table(spark, []), benchmark).count() == 0


def test_hits_take_only_nearby_tokens_and_texts_meet_once(spark, monkeypatch):
    draw = random.Random(17)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(24)]
    items = [*[(n, " ".join(passage).upper()) for n in range(40)], (40, "one short item"), (41, "One short item!")]
    long = [word() for _ in range(3000)]
    docs = [(1, " ".join([*long, *passage, *long, *passage])), (2, " ".join(passage[:5])), (3, "x one short item")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    seen, taken = [], decontaminate.found_hits
    monkeypatch.setattr(decontaminate, "found_hits", lambda *a: seen.append(taken(*a)) or seen[-1])
    for most in (decontaminate.MAX_BROADCAST_SEEDS, 0):
        monkeypatch.setattr(decontaminate, "MAX_BROADCAST_SEEDS", most)
        rows = decontaminate.contaminated(table(spark, docs), benchmark).collect()
        got = {(r["doc_id"], r["item_id"]): (r["n_hits"], r["most_agreeing"]) for r in rows}
        assert got == {**{(1, n): (90, 24) for n in range(40)}, (3, 40): (1, 3), (3, 41): (1, 3)}
        hits = seen[-1].collect()  # two passages of 15 positions under three masks, not once for each of 40 ids
        assert len(hits) == 90 and "words" not in seen[-1].columns
        assert max(len(h["near"]) for h in hits) == decontaminate.SPAN + 2 * decontaminate.CONTEXT


def test_parts_of_long_passages(spark, monkeypatch):
    draw = random.Random(13)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(4))
    items = {n: [word() for _ in range(n)] for n in (30, 38, 48, 59, 100)}
    docs, want = [], set()

    def put(part, item=None):
        docs.append((len(docs), " ".join([word() for _ in range(40)] + part + [word() for _ in range(40)])))
        want.update({(len(docs) - 1, item)} if item else ())

    for n, words in items.items():
        for at in range(n - 12):
            put(words[at : at + 13], n)  # verbatim, at every place
        for at in range(0, n - 9, 5):
            put(words[at : at + 9])  # too short a part to count
        put([*words[5:15], word(), *words[16:19], word(), *words[20:22]], n)  # 15 of 17 tokens
    docs.append((len(docs), " ".join(items[59][:13])))  # the part alone, at the borders of item and document
    want.add((len(docs) - 1, 59))
    docs.append((len(docs), " ".join(items[59][-13:])))
    want.add((len(docs) - 1, 59))
    benchmark = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string")
    for most in (decontaminate.MAX_BROADCAST_SEEDS, 0):
        monkeypatch.setattr(decontaminate, "MAX_BROADCAST_SEEDS", most)
        got = decontaminate.contaminated(table(spark, docs), benchmark).collect()
        assert {(r["doc_id"], r["item_id"]) for r in got} == want and len(got) == len(want)
        assert all(r["most_agreeing"] >= 13 and r["n_hits"] > 0 for r in got)


def test_short_items_and_scripts_without_spaces(spark, monkeypatch):
    items = [
        (1, "Who wrote Emma?"),
        (2, "日本で一番高い山は何ですか"),  # 13 letters, no spaces
        (3, "法国的首都"),
        (4, "one two three four five six seven eight nine"),
        (5, "?!"),
        (6, None),
        (7, "Yes"),
        (8, "short one"),
        (8, "a longer row of the same item that has more than ten words"),
        (8, "short one"),
    ]
    docs = [
        (1, "They asked: who wrote EMMA, and when? Who wrote Emma"),
        (2, "who has written emma"),
        (3, "問題、日本で一番高い山は何ですか。富士山"),
        (4, "请问法国的首都在哪里"),
        (5, "法国人的首都"),
        (6, "zero one two three four five six seven eight nine ten"),
        (7, "one two three four six five seven eight nine"),
        (8, "yes"),
        (9, "eyes"),
        (10, "A short one, a longer row of the same item that has more than ten words"),
        (11, ""),
        (12, None),
        (None, "yes yes"),
    ]
    want = {(1, 1): (2, 3), (4, 3): (1, 5), (6, 4): (1, 9), (8, 7): (1, 1), (None, 7): (2, 1)}
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for most in (decontaminate.MAX_BROADCAST_SEEDS, 0):
        monkeypatch.setattr(decontaminate, "MAX_BROADCAST_SEEDS", most)
        rows = decontaminate.contaminated(table(spark, docs), benchmark).collect()
        got = {(r["doc_id"], r["item_id"]): (r["n_hits"], r["most_agreeing"]) for r in rows}
        assert len(got) == len(rows) and {k: got[k] for k in want} == want
        assert set(got) - set(want) == {(3, 2), (10, 8)} and got[3, 2][1] == got[10, 8][1] == 13
    left = decontaminate.remove(table(spark, docs), benchmark)
    assert [r["doc_id"] for r in left.orderBy("doc_id").collect()] == [2, 5, 7, 9, 11, 12]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, known int, host string, s1 int")


def test_url_rules_and_parts(spark):
    urls = {
        1: (None, "", "", None, "allow"),
        2: ("no scheme/net/", "", "", None, "allow"),
        3: ("http://A.Example.NET?x#/en/", "a.example.net", "", None, "allow"),
        4: ("http://a.example.net/en/1?x", "a.example.net", "/en/1", "example.net/en/", "allow"),
        5: ("http://example.net/de/#top", "example.net", "/de/", "net/", "block"),
        6: ("http://notexample.com/de/1", "notexample.com", "/de/1", None, "allow"),
        7: ("x://example.com/de/a://b", "example.com", "/de/a:", "example.com/de/", "block"),
        8: ("http://w.org/fr/\nq", "w.org", "/fr/\nq", "org/fr/", "allow"),
        9: ("http://internet/x", "internet", "/x", None, "allow"),
    }
    rows = [(k, v[0], None) for k, v in urls.items()]
    got = by_id(url_filter.judge_urls(pages(spark, [*rows, rows[4], (None, None, None)]), URL_RULES).collect(), "page_id")
    for k, (_, host, path, rule, verdict) in urls.items():
        want = (host, path, rule, verdict)
        if k == 7:
            want = ("example.com", "/de/a://b", "example.com/de/", "block")
        assert tuple(got[k][0][c] for c in ("host", "path", "rule", "verdict")) == want
    assert len(got[5]) == 2 and got[None][0]["verdict"] == "allow" and got[1][0]["template"] is None
    assert url_filter.judge_urls(pages(spark, []), URL_RULES).count() == 0


def test_templates_merge_like_branches_and_reject_bad_ones(spark):
    rows, n = [], 0
    for k in range(60):  # the same few labels everywhere: one branch each for good and bad
        for branch, bad in (("spam", 1), ("deals", 1), ("news", 0), ("blog", 0)):
            label = bad if k % 3 == 0 else None
            rows.append((n, f"http://site.com/{branch}/{k}", label))
            n += 1
    rows += [(n + k, f"http://other.com/{'abcdefghij'[k % 10]}x{'klmnopqrst'[k // 10]}/p", None) for k in range(100)]
    out = url_filter.judge_urls(pages(spark, rows), URL_RULES, label_col="known")
    got = {r["page_id"]: r for r in out.collect()}
    for i, url, _ in rows[:240]:
        bad = "/spam/" in url or "/deals/" in url
        assert got[i]["verdict"] == ("block" if bad else "allow")
        assert got[i]["template"] == ("site.com/deals+/{n}" if bad else "site.com/blog+/{n}")
    assert {got[i]["template"] for i, _, _ in rows[240:]} == {"other.com/**"}
    assert {got[i]["verdict"] for i, _, _ in rows[240:]} == {"allow"}


def test_templates_of_any_depth(spark, monkeypatch):
    """Urls that differ in their fourth and in their ninth segment only, half of them labelled; many hosts' tables joined apart."""
    rows = []
    for k in range(400):
        word = "casino" if k % 2 else "notes"
        rows.append((k, f"http://a.org/2024/05/{k % 28}/{word}/{k}", k % 2 if k < 200 else None))
        rows.append((1000 + k, f"http://b.org/1/2/x/y/z/u/v/w/{word}-page/{'i' * (k % 70)}", k % 2 if k < 200 else None))
    rows += [(5000 + k, f"http://c.org/{k}/{'abcdefghijklmnopqrstuvwxyz'[k % 26] * (k % 90 + 1)}", k % 5 // 4) for k in range(300)]
    out = [r.asDict() for r in url_filter.judge_urls(pages(spark, rows), [], label_col="known").orderBy("page_id").collect()]
    got = {r["page_id"]: r for r in out}
    for i, url, _ in rows[:800]:
        assert got[i]["verdict"] == ("block" if "casino" in url else "allow"), url
    assert got[1]["template"] == "a.org/{n}/{n}/{n}/casino/{n}" and got[1001]["template"].startswith("b.org/{n}/{n}/x/y/z/u/v/w/casino-page/")
    monkeypatch.setattr(runtime, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(url_filter, "HOT_CHILDREN", 20)
    again = [r.asDict() for r in url_filter.judge_urls(pages(spark, rows), [], label_col="known").orderBy("page_id").collect()]
    assert again == out


def test_many_rules_are_looked_up(spark, monkeypatch):
    rules = URL_RULES + [("block", f"site{k}.net/a/{'b' * (k % 5)}") for k in range(40)] + [("allow", "x.site3.net/")]
    urls = ["http://x.site3.net/a/bbb", "http://site4.net/a/bbbbq", "http://w.site9.net/a/b", "http://example.net/en/q", "http://net/", "http://q", None]
    rows = [(k, u, None) for k, u in enumerate(urls)]
    few = [tuple(r) for r in url_filter.judge_urls(pages(spark, rows), rules).orderBy("page_id").collect()]
    monkeypatch.setattr(url_filter, "MAX_RULES", 0)
    assert [tuple(r) for r in url_filter.judge_urls(pages(spark, rows), rules).orderBy("page_id").collect()] == few
    assert [r[3] for r in few] == ["site3.net/a/bbb", "site4.net/a/bbbb", "net/", "example.net/en/", "net/", None, None]
