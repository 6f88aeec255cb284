import hashlib
import random
from functools import cache

from helpers import by_id

from tapeloom.llm import conversation_repair as cr

NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def by_hand(rows):
    """(cost, audit, repaired rows) over all edits, from the rows (role, text) of a conversation in order."""
    kinds, seen = [], set()
    for row in rows:
        solid = row[1].strip(" \t\n\x0b\x0c\r")
        kinds.append("b" if not solid else "d" if row in seen else " " if solid[-1] in ".!?" else "t")
        seen.add(row)

    @cache
    def best(k, state, inserts):
        found = [(0, "", ())] if k == len(rows) and state in (0, 3) else []

        def add(cost, edit, row, then):
            if then:
                c, a, r = then
                found.append((cost + c, edit + a, (row, *r) if row else r))

        if inserts < 3:
            for name in ("user", "assistant"):
                if name[0] in NEXT[state]:
                    add(5, "I", (name, ""), best(k, NEXT[state][name[0]], inserts + 1))
        if k < len(rows):
            role, text = rows[k]
            extra = 5 * (kinds[k] == "t")
            add(2, "D", None, best(k + 1, state, 0))
            if kinds[k] in " t":
                if role[:1] in NEXT[state]:
                    add(extra, "K", (role, text), best(k + 1, NEXT[state][role[:1]], 0))
                for name in ("user", "assistant"):
                    if name[0] in NEXT[state]:
                        add(1 + extra, "R", (name, text), best(k + 1, NEXT[state][name[0]], 0))
        return min(found, default=None)

    cost, audit, repaired = best(0, 0, 0)
    text = "\n".join(f"{r}:{t}" for r, t in repaired)
    return "".join(kinds), cost, audit, hashlib.sha256(text.encode()).hexdigest()


def draw_rows(draw, n):
    texts = ["Yes.", "No?", "So", "Well! ", "", " \n", "Übel", "x. "]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", " "]
    return [(draw.choice(roles), draw.choice(texts)) for _ in range(n)]


def test_signatures_share_their_ends():
    draw = random.Random(1)
    signatures = sorted({"".join(draw.choice("suaxSUAX-") for _ in range(draw.randint(0, 7))) for _ in range(400)}, key=lambda s: s[::-1])
    for signature, node in cr.solve(signatures):
        alone = cr.END
        for letter in reversed(signature):
            alone = cr.before(letter, alone)
        assert node == alone


def test_repair_by_hand_in_one_and_in_many_blocks(spark, monkeypatch):
    draw, rows, want = random.Random(2), [], {}
    for conv in range(150):
        turns = draw_rows(draw, draw.randint(1, 14))
        want[conv] = by_hand(turns)
        rows += [(conv, turn, role, text, "x", "y") for turn, (role, text) in enumerate(turns)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, block string, edits string")
    for size in (256, 3):
        monkeypatch.setattr(cr, "BLOCK_TURNS", size)
        got = {r["conv_id"]: r for r in cr.repair(table).collect()}
        assert len(got) == len(want)
        for conv, (kinds, cost, audit, digest) in want.items():
            r = got[conv]
            assert (r["cost"], r["audit"], r["repaired_sha256"]) == (cost, audit, digest)
            assert (r["blank"], r["duplicate"], r["truncated"]) == tuple(map(kinds.count, "bdt")) and r["gaps"] == 0


def test_nulls_ties_repeats_and_empty(spark, monkeypatch):
    monkeypatch.setattr(cr, "BLOCK_ROWS", 4)
    rows = [(None, 1, "user", "Hi.", 1)] * 5 + [(None, None, None, None, 1)] * 3 + [(7, 3, "user", "Hi.", 0)]
    rows += [(8, 2, "user", f"Part {k}.", 1) for k in range(30)] + [(8, None, "assistant", "Ok.", 1), (8, 9, "assistant", "Bye.", 2)]
    rows += [(9, 10**15, "user", "long " * 50_000 + "end.", 1), (9, -(10**15), "assistant", "a.", 1)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, copies int")
    got = {k: v[0] for k, v in by_id(cr.repair(table, copies_col="copies").collect(), "conv_id").items()}
    assert set(got) == {None, 7, 8, 9}
    lost, none, many, far = got[None], got[7], got[8], got[9]
    assert (lost["blank"], lost["duplicate"], lost["gaps"], lost["illegal"]) == (3, 4, 0, 7)
    assert (lost["audit"], lost["cost"]) == ("DDDDDDDD", 16)
    assert (none["cost"], none["audit"], none["gaps"], none["illegal"]) == (0, "", 0, 0)
    assert none["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
    ordered = [("assistant", "Ok.")]
    ordered += sorted((("user", f"Part {k}.") for k in range(30)), key=lambda r: hashlib.md5(f"{len(r[0])}:{r[0]}{r[1]}".encode()).hexdigest())
    kinds, cost, audit, digest = by_hand([*ordered, ("assistant", "Bye."), ("assistant", "Bye.")])
    assert (many["cost"], many["audit"], many["repaired_sha256"], many["gaps"]) == (cost, audit, digest, 6)
    assert many["illegal"] == 30 and far["gaps"] == 2 * 10**15 - 1
    turns = cr.repaired_turns(cr.edits(table, copies_col="copies")).where("conv_id = 8").orderBy("block", "place").collect()
    assert hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in turns).encode()).hexdigest() == digest
    assert cr.repair(table.limit(0)).count() == 0
