import random
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))
from helpers import by_id, table  # noqa: E402

from tapeloom.llm import html_text, license_scan, line_dedup, quality, runtime  # noqa: E402

CLEAN = """The river runs past the old mill and the road turns north towards the hills.
Every spring the farmers open the gates so that water can reach the lower fields.
Some of them still remember the winter when ice closed the bridge for nine weeks.
"Nobody came to the market in those days," said one who kept sheep above the lake.
Today a bus stops there twice an hour, and the school has a garden of its own."""


def repeated_by_hand(words):
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen, marked = Counter(runs), set()
    for i, run in enumerate(runs):
        if seen[run] > 1:
            marked.update(range(i, i + 8))
    return len(marked)


def test_repeated_words_against_brute_force():
    draw = random.Random(1)
    for _ in range(800):
        words = [draw.choice([b"a", b"b", b"c"]) for _ in range(draw.randint(0, 70))]
        assert quality.repeated_words(words) == repeated_by_hand(words)


def test_base_numbers(spark):
    text = "ä #b\tc$\n\nä #b\tc$\n \nx\x85y *"
    row = quality.judged(table(spark, [(1, text)])).first()["verdict"]
    words = text.encode().split()
    assert row["n_words"] == len(words) == 8
    assert row["word_chars"] == sum(len(w.decode()) for w in words)
    assert row["n_symbols"] == 5 and row["n_dup_lines"] == 1 and row["n_repeat_words"] == 0
    assert row["base_failed"] and not row["kept"]


def test_lines():
    assert quality.line_fails("Home | News | Sport | About us") == "navigation"
    assert quality.line_fails("We use cookies, see our privacy policy.") == "boilerplate"
    assert quality.line_fails("th%%% an*** er$$$ of&&&") == "boilerplate"
    assert quality.line_fails("that that that that that that that that that") == "boilerplate"
    assert quality.line_fails("Read it") == "punctuation"
    assert quality.line_fails("BUY!! NOW!! AND!! SAVE!!") == "punctuation"
    assert all(not quality.line_fails(line) for line in CLEAN.split("\n"))
    assert not quality.line_fails("Yes.") and not quality.line_fails("«Oui»")


def test_documents_lose_lines_or_go(spark):
    menu = "Home | News | Sport | About us | Contact | Terms | Help | Log in"
    mostly_menu = "\n".join([CLEAN.split("\n")[0]] + [f"Home {n} | News {n} | Sport {n} | Page {n}" for n in range(19)])
    rows = [(1, CLEAN + "\n" + menu), (2, mostly_menu), (3, None), (4, ""), (5, CLEAN), (5, CLEAN), (None, CLEAN)]
    got = by_id(quality.judged(table(spark, rows)).collect())
    assert got[1][0]["verdict"]["kept"] and got[1][0]["verdict"]["kept_text"] == CLEAN
    assert got[1][0]["verdict"]["n_removed_lines"] == 1 and got[1][0]["rest"] == "r"
    assert not got[2][0]["verdict"]["kept"] and not got[2][0]["verdict"]["base_failed"]
    assert got[3][0]["verdict"]["base_failed"] and got[4][0]["verdict"]["n_words"] == 0
    assert len(got[5]) == 2 and len(got[None]) == 1
    kept = quality.clean(table(spark, rows))
    assert kept.columns == table(spark, rows).columns
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == ["1", "5", "5", "None"]
    assert quality.judged(table(spark, [])).count() == 0


def dedup_by_hand(rows, least=20, docs=3):
    keys = {}
    digits = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(" \t\n\x0b\x0c\r")
            key = "".join(c.lower() if "A" <= c <= "Z" else c for c in key)
            if len(key) >= least:
                keys.setdefault(key, set()).add((0, text) if i is None else (1, i))
            digits[line] = key
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [
            x
            for x in lines
            if len(keys.get(digits[x], ())) < docs or max(keys[digits[x]]) == ((0, text) if i is None else (1, i))
        ]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def test_frequent_lines_against_brute_force(spark, monkeypatch):
    a, b, c = "a line that is long enough", "SECOND line, also long Ä", "short"
    rows = [
        (1, f"{a}\n{b}\n{c}"),
        (2, f" {a.upper()}\t\n{c}\n{a}"),
        (3, f"{a}\nown line of three, long enough"),
        (4, f"{b}\r\n{b}\n"),
        (4, f"{b}\r\n{b}\n"),
        (None, f"{b}\n{a}"),
        (None, None),
        (7, ""),
        (8, f"{b}\n" * 500),
    ]
    out = line_dedup.dedup_lines(table(spark, rows)).collect()
    assert sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in out), key=repr) == dedup_by_hand(rows)
    assert line_dedup.clean(table(spark, rows)).columns == table(spark, rows).columns
    assert line_dedup.dedup_lines(table(spark, [])).count() == 0
    # many frequent lines, some of them very common: the same rows
    monkeypatch.setattr(runtime, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(line_dedup, "HOT_DOCS", 4)
    again = line_dedup.dedup_lines(table(spark, rows)).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p>";</script></head><body
class="has-sidebar"><header>Site name</header><nav><ul><li><a href="/a">Menu, one</a></li></ul></nav>
<div id="cookie-notice">We use cookies, of course, and more.</div>
<div class="content"><h1>A &amp; B</h1><p>First   paragraph,&nbsp;with <b>bold</b> text, commas, and so on.</p>
<p><b>Open paragraph, never closed<br>second line, of it<p>Third one, after it, is fine.
<ul><li><a href="#">more</a></li><li><a href="#">links</a></li></ul></div>
<div class="sidebar"><p>Sidebar text, with commas, and quite long to score well, as it could be.</p></div>
<section class="comments"><p>I, a reader, say: long, long, long comment, with commas, and commas.</p></section>
<form><p>Sign up, please</p></form><footer>&copy; someone</footer>"""


def test_article_of_a_page(spark):
    want = "A & B First paragraph, with bold text, commas, and so on. Open paragraph, never closed second line, of it Third one, after it, is fine."
    assert html_text.main_text(PAGE) == want
    assert html_text.main_text("only text, no tags") == "only text, no tags"
    assert html_text.main_text("<article><p>x<p>y</article><aside>z</aside>") == "x y"
    assert html_text.main_text("<div>" * 3000 + "deep, text") == "deep, text"
    assert html_text.main_text("<nav>menu</nav><script>x</script>") == ""
    start = time.time()
    assert html_text.main_text("<div>deep, text " * 50_000) == " ".join(["deep, text"] * 50_000)
    assert html_text.main_text("<div><span>text, </b>" * 20_000).count("text") == 20_000
    assert time.time() - start < 5
    rows = [(1, None, None), (2, "u", ""), (3, "u", PAGE), (3, "u", PAGE), (None, "u", "<p>a, b")]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, id int")
    got = by_id(html_text.extract(pages).collect(), "page_id")
    assert got[1][0]["text"] == "" and got[2][0]["n_chars"] == 0 and got[None][0]["text"] == "a, b"
    assert [r["text"] for r in got[3]] == [want, want] and got[3][0]["n_chars"] == len(want)
    assert html_text.extract(pages.limit(0)).count() == 0


def article_by_hand(html):
    import html as entities
    import re

    inside = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    blocks = [re.sub(r"<[^>]*>", "", part) for part in re.split(r"</?(?:p|h1|br)>", inside)]
    blocks = [re.sub(r"\s+", " ", entities.unescape(b)).strip() for b in blocks]
    return " ".join(b for b in blocks if b)


def test_given_pages_against_brute_force(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    want = {p["page_id"]: article_by_hand(p["html"]) for p in pages.collect()}
    assert {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()} == want


def test_licence_notices(spark):
    draw = random.Random(5)
    letters = "an er th in re on at en nd ou ti es or te of ed is it al ar st to".split()
    word = lambda: "".join(draw.choice(letters) for _ in range(draw.randint(1, 4)))
    other = [" ".join(word() for _ in range(draw.randint(5, 30))) + "." for _ in range(900)]
    docs = [(n, "\n".join(other[3 * n : 3 * n + 3])) for n in range(300)]
    docs[7] = (7, docs[7][1] + "\nReleased under the MIT License.\n" + other[1])
    docs[8] = (8, "This software is licensed under the GNU General Public License, version 2.\n" + docs[8][1])
    docs[9] = (9, "Note: all rights reserved.")
    docs += [(301, None), (302, ""), (303, "\n \n--\n"), (9, "Note: all rights reserved."), (None, "Licensed under CC BY-NC 4.0.")]
    rows = table(spark, docs)
    classifier = license_scan.train(rows)
    found = [r for r in license_scan.scan(rows, classifier).collect() if r["confirmed"]]
    got = sorted(((r["doc_id"], r["line"], r["family"]) for r in found), key=repr)
    want = [(7, 3, "MIT"), (8, 0, "GPL"), (9, 0, "proprietary"), (9, 0, "proprietary"), (None, 0, "CC-BY-NC")]
    assert got == sorted(want, key=repr)
    assert license_scan.scan(table(spark, []), classifier).count() == 0
    # notices it has not seen: held-out accuracy
    unseen = {
        "MIT": "This tool is distributed under the MIT license",
        "Apache-2.0": "The software is licensed under the Apache License, Version 2.0",
        "GPL": "The whole work is licensed under the GNU General Public License, version 3",
        "BSD": "It is released under the BSD license",
        "ISC": "This module is licensed under the ISC license",
        "AGPL": "The service is licensed under the GNU Affero General Public License, version 3 or later",
    }
    names, _ = classifier.named([license_scan.tokens(t) for t in unseen.values()])
    assert [license_scan.FAMILIES[n] for n in names] == list(unseen)
    # paragraphs of whole licences, without their beginnings and ends
    paragraphs = [(f, " ".join(t.split()[4:-3])) for f, ts in license_scan.NOTICES.items() for t in ts if len(t.split()) > 30]
    names, _ = classifier.named([license_scan.tokens(t) for _, t in paragraphs])
    right = [license_scan.FAMILIES[n] == f for n, (f, _) in zip(names, paragraphs)]
    assert len(right) > 12 and sum(right) >= 0.9 * len(right)


def scanned_by_hand(docs, classifier):
    """Each line's class from its own n-grams' weights, and its similarity from sets, one line after another."""
    import numpy as np
    import xxhash

    found, mask = set(), 2**64 - 1
    for doc, text in docs:
        for number, line in enumerate((text or "").split("\n")):
            words = "".join(c if c.isalnum() else " " for c in line.lower()).split()
            if not words:
                continue
            hashed = [xxhash.xxh3_64_intdigest(w) for w in words]
            keys = hashed + [(a * 0x9E3779B97F4A7C15 & mask) ^ b for a, b in zip(hashed, hashed[1:])]
            rows = [(k ^ k >> 29) % license_scan.FEATURES for k in keys]
            raw = classifier.weights[rows].astype(float).sum(axis=0) / len(rows) ** 0.5 + classifier.intercepts
            top = int(raw.argmax())
            if not top:
                continue
            chance = 1 / np.exp((raw - raw[top]) / classifier.temperature).sum()
            mine = set(words) | set(zip(words, words[1:]))
            near = 0.0
            for notice in license_scan.NOTICES[license_scan.FAMILIES[top]]:
                theirs = "".join(c if c.isalnum() else " " for c in notice.lower()).split()
                theirs = set(theirs) | set(zip(theirs, theirs[1:]))
                if len(mine & theirs) >= 3:
                    near = max(near, len(mine & theirs) / min(len(mine), len(theirs)))
            sure = bool(chance >= classifier.least and near >= 0.5)
            found.add((doc, number, license_scan.FAMILIES[top], round(chance, 4), round(near, 6), sure))
    return found


def test_scan_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    classifier = license_scan.train(docs.limit(0))  # notices alone: many lines get a family, few are confirmed
    more = spark.createDataFrame([(-1, "Note\nThis file is Apache-2.0 licensed, see the Apache License, Version 2.0\n" + "word " * 40_000)], "doc_id long, text string")
    rows = docs.select("doc_id", "text").unionByName(more)
    got = {(r[0], r[1], r[2], round(r[3], 4), round(r[4], 6), r[5]) for r in license_scan.scan(rows, classifier).collect()}
    want = scanned_by_hand([tuple(r) for r in rows.collect()], classifier)
    near = lambda rows: {(*r[:3], *r[4:]) for r in rows if abs(r[3] - classifier.least) > 1e-3}
    assert near(got) == near(want) and len(got) > 20 and any(r[-1] for r in got)
    chances = {r[:3]: r[3] for r in want}
    assert all(abs(r[3] - chances[r[:3]]) < 1e-3 for r in got)
