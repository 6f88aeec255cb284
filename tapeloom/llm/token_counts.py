"""Token counts by byte-pair merging on a heap and a linked list, without emitting ids.

The symbols of a word are its bytes, the last one marked as word end. The adjacent pair of
lowest rank is joined again and again; the count is the number of symbols at the start less
the number of merges.
"""

from __future__ import annotations

import json
import unicodedata
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.runtime import arrow_map, column, quoted, shared_file

#: Words, with what adjoins them, whose count a worker remembers, beyond which the memory starts anew; longer ones
#: are not remembered, so that the memory is bounded in bytes too.
REMEMBERED, LONGEST_REMEMBERED = 800_000, 64


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + others.index(b)) for b in range(256)]


class MergeCounter:
    """Counts for a tokenizer file: byte-level BPE with a word-end mark, NFC and lower case."""

    def __init__(self, tokenizer: bytes):
        spec = json.loads(tokenizer)
        model = spec["model"]
        self._check(spec)
        self.steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        self.end = model["end_of_word_suffix"] or ""
        self.vocab = model["vocab"]
        self.rank = {tuple(m): r for r, m in enumerate(model["merges"])}
        self.find = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special)) or r"(?!)")
        self.symbol = byte_symbols()
        self.known: dict[str, int] = {}

    @staticmethod
    def _check(spec: dict) -> None:
        model, split = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        fits = (
            model["type"] == "BPE"
            and not (model.get("dropout") or model.get("unk_token") or model.get("ignore_merges"))
            and {n["type"] for n in spec["normalizer"]["normalizers"]} <= {"NFC", "Replace", "Lowercase"}
            and [p["type"] for p in split] == ["Split", "ByteLevel"]
            and split[0]["behavior"] == "Removed"
            and split[0]["invert"]
            and not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
        )
        if not fits:
            raise ValueError("the tokenizer file is not of the kind this counter follows")

    def normal(self, part: str) -> str:
        """A text without special strings as the pattern sees it, but for white space, which is
        in no word and so need not be replaced."""
        if "NFC" in self.steps and not part.isascii():
            part = unicodedata.normalize("NFC", part)
        if "Lowercase" in self.steps:
            part = part.replace("Σ", "σ").lower()  # each character on its own, without final forms
        return part

    def merges_left(self, word: str) -> int:
        """Symbols left when no adjacent pair of a word has a rank."""
        symbol, rank, vocab = self.symbol, self.rank.get, self.vocab
        symbols = [symbol[b] for b in word.encode()]
        symbols[-1] += self.end
        n = len(symbols)
        left = n
        for s in symbols:
            if s not in vocab:
                left -= 1
        heap = [(r, i) for i, pair in enumerate(zip(symbols, symbols[1:])) if (r := rank(pair)) is not None]
        if not heap:
            return left
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heapify(heap)
        while heap:
            r, i = heappop(heap)
            j = after[i]
            if j >= n or rank((symbols[i], symbols[j])) != r:
                continue  # one of the two has changed since
            symbols[i] += symbols[j]
            symbols[j] = ""
            left -= 1
            k = after[i] = after[j]
            after[j] = n
            if k < n:
                before[k] = i
                if (r := rank((symbols[i], symbols[k]))) is not None:
                    heappush(heap, (r, i))
            h = before[i]
            if h >= 0 and (r := rank((symbols[h], symbols[i]))) is not None:
                heappush(heap, (r, h))
        return left

    def count(self, text: str) -> int:
        """Tokens of a text; a special string in it is one token."""
        found = len(self.special.findall(text)) if "<|" in text or not self.special.pattern.startswith("<") else 0
        parts = self.special.split(text) if found else [text]
        return found + sum(self._plain(p) for p in parts if p)

    def _plain(self, part: str) -> int:
        """A space is in no word, so what stands between two spaces is counted, and remembered, on its own."""
        units, known = self.normal(part).split(" "), self.known
        counts = list(map(known.get, units))
        if None in counts:
            if len(known) > REMEMBERED:
                known.clear()
            for k, c in enumerate(counts):
                if c is None:
                    counts[k] = self._unit(units[k])
        return sum(counts)

    def _unit(self, unit: str) -> int:
        known = self.known
        if (c := known.get(unit)) is None:
            words = self.find(unit)
            c = self.merges_left(unit) if words == [unit] else sum(map(self._unit, words))
            if len(unit) <= LONGEST_REMEMBERED:
                known[unit] = c
        return c


_COUNTERS: dict[int, MergeCounter] = {}


def counter(tokenizer: bytes) -> MergeCounter:
    """One counter per worker process and file."""
    key = hash(tokenizer)
    if key not in _COUNTERS:
        _COUNTERS[key] = MergeCounter(tokenizer)
    return _COUNTERS[key]


def count_tokens(
    docs: DataFrame, tokenizer_path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    Every row gives one row, also repeated ones and those with a null id; a null or empty
    text has no bytes and no tokens. Other columns are not looked at.
    """
    file = shared_file(docs.sparkSession, tokenizer_path)
    id_type = docs.schema[id_col].dataType.simpleString()

    def count(batches):
        counting = counter(file.value)
        for batch in batches:
            tokens = [counting.count(t) if t else 0 for t in column(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(tokens, pa.int64())], ["id", "n_bytes", "n_tokens"]
            )

    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    rows = docs.select(F.col(quoted(id_col)).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    counted = arrow_map(rows, count, f"id {id_type}, n_bytes long, n_tokens long")
    return counted.select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
