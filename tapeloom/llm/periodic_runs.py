"""Periodic runs of words: suffix automaton, and link-cut access to its tree of suffix links.

For each appended word the path from its prefix to the root of the link tree is recoloured with the new end.
Every segment of the path that had one colour gives the last end of its longest string; if the distance of the
two ends is at most that string's length, the text between is a square, and the common suffix of both ends
carries it to the left as far as its period goes. A run is taken at its last word.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.runtime import arrow_map, column, quoted

#: Production parameter: the least words of a run (two periods at least in any case).
LEAST_WORDS = 12

#: Words that are searched for repeats together; a longer text is a group of its own.
GROUP_WORDS = 400_000

RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

#: An odd 64-bit multiplier, for rolling hashes of word numbers.
STEP = np.uint64(0x9E3779B97F4A7C15)


def suffix_automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Link and longest length of each state, and the state of each prefix; the root is 0."""
    link, length, moves, prefixes = [-1], [0], [{}], []
    last = 0
    for n, w in enumerate(words, 1):
        state = len(link)
        link.append(0)
        length.append(n)
        moves.append({})
        p = last
        while p >= 0 and w not in moves[p]:
            moves[p][w] = state
            p = link[p]
        if p >= 0:
            q = moves[p][w]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                copy = len(link)
                link.append(link[q])
                length.append(length[p] + 1)
                moves.append(moves[q].copy())
                while p >= 0 and moves[p].get(w) == q:
                    moves[p][w] = copy
                    p = link[p]
                link[q] = link[state] = copy
        prefixes.append(state)
        last = state
    return link, length, prefixes


class LastEnds:
    """The link tree as paths of one colour, each path a splay tree ordered by depth.

    The colour of a path is kept at the root of its splay tree. State 0 (the empty string) is left
    out: 0 stands for nothing.
    """

    def __init__(self, link: list[int]):
        self.up = link[:]
        self.up[0] = 0
        self.left = [0] * len(link)
        self.right = [0] * len(link)
        self.colour = [0] * len(link)

    def splay(self, x: int) -> None:
        """Make x the root of its splay tree."""
        up, left, right = self.up, self.left, self.right
        while True:
            p = up[x]
            on_left = left[p] == x
            if not p or not (on_left or right[p] == x):
                return
            g = up[p]
            p_left = left[g] == p
            if g and (p_left or right[g] == p):
                above = up[g]
                if p_left == on_left:  # first p over g, then x over p
                    if on_left:
                        c = left[g] = right[p]
                        right[p] = g
                    else:
                        c = right[g] = left[p]
                        left[p] = g
                    if c:
                        up[c] = g
                    up[g] = p
                    if on_left:
                        c = left[p] = right[x]
                        right[x] = p
                    else:
                        c = right[p] = left[x]
                        left[x] = p
                    if c:
                        up[c] = p
                    up[p] = x
                else:
                    if on_left:  # p is g's right child
                        c, d = right[x], left[x]
                        left[p], right[g], right[x], left[x] = c, d, p, g
                    else:
                        c, d = left[x], right[x]
                        right[p], left[g], left[x], right[x] = c, d, p, g
                    if c:
                        up[c] = p
                    if d:
                        up[d] = g
                    up[p] = up[g] = x
                top = g
            else:
                above = g
                if on_left:
                    c = left[p] = right[x]
                    right[x] = p
                else:
                    c = right[p] = left[x]
                    left[x] = p
                if c:
                    up[c] = p
                up[p] = x
                top = p
            up[x] = above
            if above and left[above] == top:
                left[above] = x
            elif above and right[above] == top:
                right[above] = x
            else:
                self.colour[x] = self.colour[top]

    def access(self, state: int, end: int) -> list[tuple[int, int]]:
        """Recolour the path from the root to ``state`` with ``end``.

        Returns (last end, deepest state) of each coloured segment the path had.
        """
        segments, x, lower = [], state, 0
        up, right, colour = self.up, self.right, self.colour
        while x:
            self.splay(x)
            if c := colour[x]:
                segments.append((c, x))
            if r := right[x]:
                colour[r] = c  # the rest of the segment below stays as it was
            right[x] = lower
            lower, x = x, up[x]
        colour[lower] = end
        return segments


def runs_of(words: list[int], least: int = LEAST_WORDS) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of every run, by start and period.

    A run of period q is seen at its last word: its end without the last q words is the last end of
    their longest common suffix, since a later one would make its period smaller.
    """
    link, length, prefixes = suffix_automaton(words)
    paths, found, n = LastEnds(link), [], len(words)
    for end, state in enumerate(prefixes, 1):
        for before, deepest in paths.access(state, end):
            period, common = end - before, length[deepest]
            if period <= common and common + period >= least and (end == n or words[end] != words[end - period]):
                found.append((before - common, common + period, period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which of the keys occur more than once: first by buckets, then by sorting what is left."""
    if not len(keys):
        return np.zeros(0, bool)
    bits = max(10, len(keys).bit_length() + 2)
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
    left = np.flatnonzero(np.bincount(bucket, minlength=1 << bits)[bucket] > 1)
    order = left[np.argsort(keys[left], kind="stable")]
    same = keys[order[1:]] == keys[order[:-1]]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return twice


def stretches(words: np.ndarray, starts: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Parts of the texts (first word, word past the last) that hold every run between them.

    In a run of at least ``least`` words all words lie in pieces of ``least // 2`` words that occur in it
    again, since a run equals itself one period on over max(period, length - period) words. So whatever is
    not covered by repeated pieces can be left out, again and again until all that is left is covered
    by pieces that are repeated in the same stretch. Equal hashes of unequal pieces only leave more in.
    """
    width, n = max(1, least // 2), len(words)
    if n < width:
        return []
    with np.errstate(over="ignore"):
        hashes = np.zeros(n - width + 1, np.uint64)
        for k in range(width):
            hashes = hashes * STEP + words[k : n - width + 1 + k]
        part = np.zeros(n, np.uint64)
        part[starts[(starts > 0) & (starts < n)]] = 1
        part = np.cumsum(part, dtype=np.uint64)
        at = np.flatnonzero(part[: n - width + 1] == part[width - 1 :])
        while True:
            mixed = (hashes[at] ^ (part[at] * STEP)) * STEP
            mixed ^= mixed >> np.uint64(29)
            twice = at[repeated(mixed * STEP)]
            if len(twice) == len(at):
                break
            at = twice
            edges = np.zeros(n + 1, np.int64)
            edges[at] += 1
            edges[at + width] -= 1
            covered = np.cumsum(edges[:-1]) > 0
            fresh = covered.copy()
            fresh[1:] &= ~covered[:-1] | (part[1:] != part[:-1])
            part = np.where(covered, np.cumsum(fresh), 0).astype(np.uint64)
    if not len(at):
        return []
    first = np.flatnonzero(np.r_[True, part[at[1:]] != part[at[:-1]]])
    last = np.r_[first[1:], len(at)] - 1
    spans = zip(at[first].tolist(), (at[last] + width).tolist())
    return [(a, b) for a, b in spans if b - a >= least]


def runs_of_texts(texts: list[list[bytes]], least: int) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, given as words."""
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    starts = np.cumsum([0] + [len(t) for t in texts])
    flat = np.empty(int(starts[-1]), np.uint64)
    for text, first in zip(texts, starts.tolist()):
        flat[first : first + len(text)] = np.fromiter(map(number.__getitem__, text), np.uint64, len(text))
    flat += np.uint64(1)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for a, b in stretches(flat, starts[:-1], least):
        k = int(np.searchsorted(starts, a, "right")) - 1
        shift = a - int(starts[k])
        found[k] += [(s + shift, n, p) for s, n, p in runs_of(flat[a:b].tolist(), least)]
    return found


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by spaces, each run cut down to its first period."""
    if not runs:
        return b" ".join(words)
    edges = [0] * (len(words) + 1)
    for start, n, period in runs:
        edges[start + period] += 1
        edges[start + n] -= 1
    kept, inside = [], 0
    for word, edge in zip(words, edges):
        inside += edge
        if not inside:
            kept.append(word)
    return b" ".join(kept)


def find_runs(docs: DataFrame, least: int = LEAST_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_words``, ``runs`` and the ``collapsed`` text.

    Words are what ASCII white space separates. A run is a stretch with smallest period q (words q apart are
    equal) of at least ``least`` and 2q words that no neighbour extends; ``runs`` holds (start, length, period)
    by start and period, counted in words from 0. ``collapsed`` has the words joined by one space, without
    those that lie in a run after its first q words. Every row gives one row, also repeated ones and those
    without an id; a null, empty or blank text has no words, no runs and an empty text. Other columns are
    not looked at. A text is searched in the task that reads it; memory is in proportion to its longest
    stretch of repeated pieces.
    """
    if least < 2:
        raise ValueError("a run has two words at least")
    id_type = docs.schema[id_col].dataType.simpleString()

    def find(batches):
        def done(ids, texts):
            found = runs_of_texts(texts, least)
            return pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays(ids),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([[{"start": s, "length": n, "period": p} for s, n, p in r] for r in found], RUNS),
                    pa.array([collapsed(t, r).decode() for t, r in zip(texts, found)], pa.string()),
                ],
                ["id", "n_words", "runs", "collapsed"],
            )

        for batch in batches:
            ids, texts, total = [], [], 0
            for row, text in enumerate(column(batch, "text")):
                words = (text or b"").split()
                ids.append(batch.column(0).slice(row, 1))
                texts.append(words)
                total += len(words)
                if total >= GROUP_WORDS:
                    yield done(ids, texts)
                    ids, texts, total = [], [], 0
            if texts:
                yield done(ids, texts)

    rows = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).cast("binary").alias("text"))
    kinds = f"id {id_type}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return arrow_map(rows, find, kinds).withColumnRenamed("id", id_col)
