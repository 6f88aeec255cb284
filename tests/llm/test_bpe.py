import base64
import hashlib
import random
import sys
from pathlib import Path

import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parent))
from helpers import by_id, table  # noqa: E402

from tapeloom.llm import byte_bpe, token_counts  # noqa: E402
from tapeloom.llm.queries import BYTE_RANKS, WORD_MERGES, encoded  # noqa: E402

RANKS = Path(public_tokenizers.path(BYTE_RANKS)).read_bytes()
BITS = "a b ü 字 the ' 's 're ! 1 ² \n \t \x1c \x85 ​ ſ İ Σ 😀 <|endoftext|>".split(" ") + [" ", "  ", "　"]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, RANKS.splitlines())}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def draws(n, seed=1):
    draw = random.Random(seed)
    for k in range(n):
        text = "".join(draw.choice(BITS) for _ in range(draw.randint(0, 60)))
        yield (draw.choice(BITS) * draw.randint(1, 200) if k % 10 == 0 else "") + text


def test_windows_stitch_to_the_same_ids(library):
    bpe, draw = byte_bpe.ByteBpe(RANKS, public_tokenizers.PATTERN), random.Random(2)
    for text in draws(1500):
        want = library.encode_ordinary(text)
        assert byte_bpe.numbers(bpe.encode(text)).tolist() == want
        window, overlap = draw.choice([(10, 5), (16, 6), (40, 12)])
        windows = [
            byte_bpe.pretokenised(bpe, s, text[s : s + window])
            for s in byte_bpe.window_starts(len(text), window, overlap)
        ]
        ids = byte_bpe.stitch(bpe, windows)
        assert byte_bpe.numbers(ids).tolist() == want, (text, window, overlap)
        assert bpe.decode(ids) == text.encode()


def test_documents_of_any_length(spark, library):
    long = " ".join(draws(400, 3)) + "x" * 1500
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (4, long), (4, long), (None, long), (5, long + "!"), (None, "x")]
    args = (public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN)
    got = byte_bpe.encode_decode(table(spark, rows), *args, window=300, overlap=40).collect()
    assert len(got) == len(rows)
    want = sorted(((str(i), t or "") for i, t in rows))
    assert sorted((str(r["doc_id"]), bytes(r["decoded"]).decode()) for r in got) == want
    for row in got:
        assert byte_bpe.numbers(bytes(row["ids"])).tolist() == library.encode_ordinary(bytes(row["decoded"]).decode())
    assert byte_bpe.encode_decode(table(spark, []), *args).count() == 0


def test_runs_longer_than_windows(spark, library):
    """Letters of four bytes without a merge, pieces of many windows, and boundaries behind them."""
    bpe = byte_bpe.ByteBpe(RANKS, public_tokenizers.PATTERN)
    rows = [(1, "\U00012000" * 40_000), (2, "\U00020000" * 16_384 + " a b " * 9_000), (3, "1 " + "z" * 50_000 + " end")]
    got = byte_bpe.encode_decode(table(spark, rows), public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN).collect()
    assert sorted((r["doc_id"], bytes(r["decoded"]).decode()) for r in got) == rows
    for row in got:
        assert bytes(row["ids"]) == bpe.encode(dict(rows)[row["doc_id"]])
    for text in ("a b" + "x" * 900 + " c" * 200 + "y" * 300, "x" * 1000):
        windows = [byte_bpe.pretokenised(bpe, s, text[s : s + 40]) for s in byte_bpe.window_starts(len(text), 40, 9)]
        assert byte_bpe.numbers(byte_bpe.stitch(bpe, windows)).tolist() == library.encode_ordinary(text)


def test_digests_are_those_of_the_library(spark, library):
    got = by_id(encoded(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect())
    for doc in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        ids, (row,) = library.encode_ordinary(doc["text"] or ""), got[doc["doc_id"]]
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(packed).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256((doc["text"] or "").encode()).hexdigest()


def test_counts_are_those_of_the_library(spark):
    path = public_tokenizers.path(WORD_MERGES)
    counter, library = token_counts.MergeCounter(Path(path).read_bytes()), Tokenizer.from_file(path)
    for text in draws(2000, 4):
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), text
    long = "word " * 3000
    rows = [(1, None), (2, ""), (3, "ß b"), (3, "ß b"), (None, "x"), (4, long)]
    got = by_id(token_counts.count_tokens(table(spark, rows), path).collect())
    assert [(r["n_bytes"], r["n_tokens"]) for r in got[1] + got[2]] == [(0, 0), (0, 0)]
    assert len(got[3]) == 2 and got[3][0] == got[3][1] and got[3][0]["n_bytes"] == 4
    assert got[4][0]["n_tokens"] == 3000 and got[4][0]["over_limit"] and not got[None][0]["over_limit"]
    assert token_counts.count_tokens(table(spark, []), path).count() == 0
