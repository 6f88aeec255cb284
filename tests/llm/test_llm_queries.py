import hashlib
import random
import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent), str(Path(__file__).resolve().parents[1])]
from oracle import compare, duck, normal_rows  # noqa: E402

import corpus_pipeline  # noqa: E402
from tapeloom.llm import decontaminate, quality  # noqa: E402
from tapeloom.llm.queries import QUERIES, SQL  # noqa: E402

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    rows = normal_rows(df.columns, [tuple(r) for r in df.collect()])
    assert rows and compare(duck(SF_DIR), SQL[name], df.columns, rows) == "ok"


def test_every_operator_has_its_query():
    assert sorted(n.split("_")[0] for n in QUERIES) == sorted(f"op{k}" for k in range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontaminate", "encode"]


def test_pipeline_against_brute_force(spark):
    """Stage by stage in plain Python on the smallest documents."""
    from test_models_and_joins import held_by_hand
    from test_near_dedup import by_hand
    from test_text_rules import dedup_by_hand

    sf_dir = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    judged = [(i, quality.judge(t or "")) for i, t in rows]
    rows = [(i, v[0]) for i, v in judged if v[-1]]
    rows = [(i, t) for i, t, _, _ in dedup_by_hand(rows)]
    kept = {i for i, _, _, k in by_hand(rows, 5, 80) if k}
    rows = [(i, t) for i, t in rows if i in kept]
    texts = dict(rows)
    held = {d for d, _ in decontaminated(rows, items, held_by_hand)}
    want = {i: hashlib.sha256(t.encode()).hexdigest() for i, t in texts.items() if i not in held}
    got = {r["doc_id"]: r["decoded_sha256"] for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert got == want and 0 < len(got) < 200


def test_pipeline_on_awkward_tables(spark, tmp_path):
    """Null and repeated ids, null, empty and very long texts, columns with names that are used inside, empty tables."""
    from helpers import table

    def prose(seed, lines):
        draw = random.Random(seed)
        word = lambda: "".join(draw.choice(["ra", "lo", "mi", "ten", "sho", "ve"]) for _ in range(draw.randint(2, 4)))
        return "\n".join(" ".join(word() for _ in range(14)).capitalize() + "." for _ in range(lines))

    clean, other, long, fourth, fifth = prose(1, 8), prose(2, 8), prose(3, 4000), prose(4, 8), prose(5, 300)
    leak = " ".join(f"question{k} answer{k}" for k in range(20)) + "."
    rows = [(1, clean), (2, clean + " And more."), (3, other), (3, other), (4, other + "\n" + leak), (5, None), (6, ""), (7, "too short")]
    rows += [(8, long), (None, fourth), (None, fifth)]
    folder = tmp_path / "tables"
    table(spark, rows).write.parquet(str(folder / "documents.parquet"))
    items = spark.createDataFrame([(1, leak), (2, None), (2, "")], "item_id long, text string")
    items.write.parquet(str(folder / "benchmark.parquet"))
    got = sorted(((r["doc_id"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, str(folder)).collect()), key=str)
    assert [i for i, _ in got] == [1, 3, 3, 8, None, None]
    texts = {i: hashlib.sha256(t.encode()).hexdigest() for i, t in ((1, clean), (3, other), (8, long))}
    assert all(texts[i] == d for i, d in got if i is not None)
    docs = table(spark, rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(0), str(folder))
        assert out.columns == docs.columns and out.count() == 0


def decontaminated(rows, items, by_hand):
    """Position by position, for documents with enough equal tokens on one diagonal with an item."""
    import re

    cut = lambda t: re.sub(r"[^\w]+|_", " ", (t or "").lower()).split()
    runs = {}
    for item in items:
        words = cut(item[1])
        for k in range(len(words) - 1):
            runs.setdefault(tuple(words[k : k + 2]), set()).add(item)
    found = set()
    for doc in rows:
        words = cut(doc[1])
        near = set()
        for k in range(len(words) - 1):
            near |= runs.get(tuple(words[k : k + 2]), set())
        for item in near:
            theirs = cut(item[1])
            place = {}
            for q, w in enumerate(theirs):
                place.setdefault(w, []).append(q)
            diagonals = {}
            for p, w in enumerate(words):
                for q in place.get(w, ()):
                    diagonals[p - q] = diagonals.get(p - q, 0) + 1
            if max(diagonals.values(), default=0) >= decontaminate.SPAN * decontaminate.PERCENT // 100:
                found |= by_hand([doc], [item])
    return found
