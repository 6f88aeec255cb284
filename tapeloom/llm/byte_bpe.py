"""Byte-level BPE encoding and decoding over overlapping chunks.

Each text is cut into windows that overlap. Windows are pre-tokenised on their own, in
parallel and on different executors if the text has more than one, so that one very long
text does not hold up a task. A window that starts inside a pre-token gives wrong pieces
until its boundaries meet those of the window before: what follows a shared boundary is the
same in both. The seam is laid there. The merges inside a piece are those of the tiktoken
library for the rank file; a worker remembers the ids of the pieces it has met. Where two
windows share no boundary in their overlap (a run of one kind of character longer than the
overlap), the text from the last sure boundary on is pre-tokenised again together with the
next window. Decoding joins the bytes of the ids.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.runtime import arrow_map, column, quoted, shared_file

#: Code points of a window, and of the part it shares with the next one. A code point has at most four bytes, so
#: the ids of a window can be counted in two bytes.
WINDOW, OVERLAP = 16_383, 512

#: Pieces whose ids a worker remembers, beyond which the memory starts anew; longer pieces are not remembered.
REMEMBERED, LONGEST_REMEMBERED = 400_000, 64

#: A match may look this far beyond its own end; a boundary nearer to a cut is not sure.
LOOKAHEAD = 2


class ByteBpe:
    """Encoder and decoder for one rank file and one splitting pattern."""

    def __init__(self, ranks: bytes, pattern: str):
        self.ranks: dict[bytes, int] = {}
        for line in ranks.splitlines():
            if line.strip():
                token, rank = line.split()
                self.ranks[base64.b64decode(token)] = int(rank)
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.find = regex.compile(pattern).findall
        self.library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})
        self.known: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str]:
        return self.find(text)

    def encoded(self, pieces: list[str]) -> list[bytes]:
        """Per piece its ids as little-endian unsigned 32-bit integers."""
        known = self.known
        out = list(map(known.get, pieces))
        if None in out:
            if len(known) > REMEMBERED:
                known.clear()
            for k, ids in enumerate(out):
                if ids is None:
                    piece = pieces[k]
                    ids = known.get(piece)
                    if ids is None:
                        ids = little_endian(self.library.encode_ordinary(piece))
                        if len(piece) <= LONGEST_REMEMBERED:
                            known[piece] = ids
                    out[k] = ids
        return out

    def encode(self, text: str) -> bytes:
        return b"".join(self.encoded(self.find(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, numbers(ids)))


def little_endian(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def numbers(ids: bytes) -> array:
    out = array("I")
    out.frombytes(ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out


_CODERS: dict[tuple[int, str], ByteBpe] = {}


def coder(ranks: bytes, pattern: str) -> ByteBpe:
    """One coder per worker process and rank file, so that what it remembers lasts over tasks."""
    key = (hash(ranks), pattern)
    if key not in _CODERS:
        _CODERS[key] = ByteBpe(ranks, pattern)
    return _CODERS[key]


# --- windows and seams -------------------------------------------------------------------


@dataclass
class Window:
    """Part of a text with its own pieces: ``at`` has where each begins and the last one ends."""

    start: int
    text: str
    at: list[int]
    ids: list[bytes]

    @property
    def end(self) -> int:
        return self.start + len(self.text)


def window_starts(length: int, window: int, overlap: int) -> list[int]:
    """Starts of the windows; the last window reaches the end of the text."""
    return [0] if length <= window else list(range(0, length - overlap, window - overlap))


def pretokenised(bpe: ByteBpe, start: int, text: str) -> Window:
    pieces = bpe.pieces(text)
    return Window(start, text, list(accumulate(map(len, pieces), initial=start)), bpe.encoded(pieces))


def stitch(bpe: ByteBpe, windows: list[Window]) -> bytes:
    """Ids of the whole text from its windows in order.

    Where two windows share no boundary, what is not sure yet is pre-tokenised again together with the next
    window, and if that leads to no seam either, with twice as many windows, and so on: a run of any length is read
    a few times over, not once per window.
    """
    out: list[bytes] = []
    here, first = windows[0], 0  # what follows piece ``first`` of this window is sure
    at, more = 1, 1
    while at < len(windows):
        after = windows[at]
        known = set(after.at)
        limit = here.end - LOOKAHEAD
        seam = next(
            (j for j in range(bisect_left(here.at, after.start, first), len(here.at)) if here.at[j] <= limit and here.at[j] in known),
            None,
        )
        if seam is not None:
            out += here.ids[first:seam]
            here, first = after, bisect_left(after.at, here.at[seam])
            at, more = at + 1, 1
            continue
        last = max(first, bisect_right(here.at, limit) - 1)
        out += here.ids[first:last]
        sure, end = here.at[last], here.end
        parts = [here.text[sure - here.start :]]
        for window in windows[at : at + more]:
            parts.append(window.text[end - window.start :])
            end = window.end
        here, first = pretokenised(bpe, sure, "".join(parts)), 0
        at, more = at + more, 2 * more
    out += here.ids[first:]
    return b"".join(out)


# --- the operator ------------------------------------------------------------------------

_BATCH = 256


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Few rows at a time, so that what is made of them stays small too."""
    for batch in batches:
        for k in range(0, batch.num_rows, _BATCH):
            yield batch.slice(k, _BATCH)


def _packed(sizes: list[int]) -> bytes:
    """Sizes inside a window: two bytes each, as a window has fewer than 2**14 code points and four times as many bytes."""
    return array("H", sizes).tobytes()


def _ends(packed: bytes, start: int) -> list[int]:
    out = array("H")
    out.frombytes(packed)
    return list(accumulate(out, initial=start))


def encode_decode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    overlap: int = OVERLAP,
) -> DataFrame:
    """Each row's id with ``ids`` (little-endian unsigned 32-bit integers) and the ``decoded`` bytes.

    Every row gives one row, also repeated ones and those with a null id. A null or empty
    text has no ids. Other columns are not looked at, so their names cannot clash. Special
    tokens are ordinary text. A text of one window is encoded where it is read; the windows
    of longer ones are dealt out over the tasks and meet again by (id, digest of the text).
    """
    if not 2 * LOOKAHEAD < overlap < window <= WINDOW:
        raise ValueError(f"the overlap must be shorter than the window, and that at most {WINDOW:,}")
    spark = docs.sparkSession
    ranks = shared_file(spark, ranks_path)
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, ids binary, decoded binary"
    rows = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text"))
    length = F.length(F.coalesce("text", F.lit("")))

    def encode(batches):
        bpe = coder(ranks.value, pattern)
        for batch in _rows(batches):
            ids = [bpe.encode(t or "") for t in column(batch, "text")]
            yield _result(batch.column(0), ids, bpe)

    def cut(batches):
        for batch in _rows(batches):
            for key, text in zip(column(batch, "id"), column(batch, "text")):
                digest = hashlib.md5(text.encode()).digest()
                starts = window_starts(len(text), window, overlap)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([key] * len(starts), batch.schema.field(0).type),
                        pa.array([digest] * len(starts), pa.binary()),
                        pa.array(starts, pa.int32()),
                        pa.array([text[s : s + window] for s in starts], pa.string()),
                    ],
                    ["id", "digest", "start", "text"],
                )

    def pretokenise(batches):
        bpe = coder(ranks.value, pattern)
        for batch in _rows(batches):
            made = [pretokenised(bpe, s, t) for s, t in zip(column(batch, "start"), column(batch, "text"))]
            packed = {
                "lengths": [_packed([b - a for a, b in zip(w.at, w.at[1:])]) for w in made],
                "counts": [_packed([len(i) // 4 for i in w.ids]) for w in made],
                "ids": [b"".join(w.ids) for w in made],
            }
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(v, pa.binary()) for v in packed.values())], [*batch.schema.names, *packed]
            )

    def join(batches):
        bpe = coder(ranks.value, pattern)
        for batch in _rows(batches):
            for k, parts in enumerate(column(batch, "windows")):
                copies = sum(p["start"] == 0 for p in parts)
                ids = stitch(bpe, [_window(parts[i]) for i in range(0, len(parts), copies)])
                yield _result(pa.concat_arrays([batch.column(0).slice(k, 1)] * copies), [ids] * copies, bpe)

    key = f"id {id_type}, digest binary"
    windows = arrow_map(rows.where(length > window), cut, f"{key}, start int, text string")
    windows = windows.repartition("id", "digest", "start")
    windows = arrow_map(windows, pretokenise, f"{key}, start int, text string, lengths binary, counts binary, ids binary")
    whole = windows.groupBy("id", "digest").agg(
        F.sort_array(F.collect_list(F.struct("start", "text", "lengths", "counts", "ids"))).alias("windows")
    )
    long = arrow_map(whole.select("id", "windows"), join, schema)
    short = arrow_map(rows.where(length <= window), encode, schema)
    return short.unionByName(long).withColumnRenamed("id", id_col)


def _window(part: dict) -> Window:
    ends = _ends(part["counts"], 0)
    ids = [part["ids"][4 * a : 4 * b] for a, b in zip(ends, ends[1:])]
    return Window(part["start"], part["text"], _ends(part["lengths"], part["start"]), ids)


def _result(keys: pa.Array, ids: list[bytes], bpe: ByteBpe) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [keys, pa.array(ids, pa.binary()), pa.array([bpe.decode(i) for i in ids], pa.binary())],
        ["id", "ids", "decoded"],
    )
