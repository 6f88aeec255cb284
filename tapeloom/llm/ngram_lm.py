"""Interpolated modified Kneser-Ney language model, counted in Spark and scored from mapped arrays.

Words are hashed. The distinct hashes of the training text, sorted and cut into shards by
their leading bits, are the vocabulary; a word's number is its place in it. A pair of words is
one 64-bit key of two numbers, so pairs are exact; a triple is known by a 64-bit hash of its
numbers, stored as sorted hash arrays. Shard by shard the keys are counted, sorted and stored,
with the counts that Kneser-Ney needs:

* for each context how often it occurs and how many words follow it once, twice and more;
* for each pair how many words it follows, and for each word how many contexts (continuation counts).

Triples lie in the shard of their first two words, pairs in that of their first word; those
of very frequent contexts are spread, and their numbers are summed from all shards. Each
worker maps the arrays it needs and looks up the sorted keys of a batch at once.

The order is a parameter: three, or two, where pairs have plain counts and no triples are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.near_dedup import mixed
from tapeloom.llm.runtime import arrow_map, column, quoted, ship
from tapeloom.llm.shared_arrays import fresh_array, opened_array, write_array
from tapeloom.session import scratch_path

#: Production parameter: words of the longest n-gram, 2 or 3.
ORDER = 3

#: Training tokens per shard, and the bounds of the number of shards (as powers of two).
SHARD_TOKENS = 4_000_000
LEAST_BITS, MOST_BITS = 3, 22

#: Tokens that a task counts together before it sends what it has; triples take more room.
FLUSH_TOKENS, FLUSH_TRIPLES = 4_000_000, 1_500_000

#: The end of a text is a token; no word has a space, so none is spelled like it.
END = b" end of text"

#: The number of the context before the first token; no word has it.
BEGIN = 0xFFFFFFFF

#: Hash arrays are cut into so many buckets (as a power of two); inside them 32 bits of the hash are stored.
BUCKET_BITS = 14

#: An odd multiplier that tells a triple's last word from its first two.
LAST_WORD = np.uint64(0x9FB21C651E98DF25)

_DOCS_AT_ONCE = 1024


def hashed_tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of the texts, one text after another, and where each text ends."""
    words = [[*text.encode().lower().split(), END] for text in texts]  # of bytes: A-Z and ASCII white space only
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    digests = map(xxhash.xxh3_64_intdigest, chain.from_iterable(words))
    return np.fromiter(digests, dtype=np.uint64, count=int(ends[-1]) if len(ends) else 0), ends


def counted(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with their (summed) counts."""
    if counts is None:
        keys = np.sort(keys)
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
        return keys[starts], np.diff(np.append(starts, len(keys)))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    return keys[starts], np.add.reduceat(counts, starts) if len(starts) else counts[:0]


def find(where: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of keys in a sorted array, and whether they are there."""
    if not len(where):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    places = np.minimum(np.searchsorted(where, keys), len(where) - 1)
    return places, where[places] == keys


def bucket_and_rest(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each hash, and what is stored of it."""
    return (hashes >> np.uint64(32 - BUCKET_BITS) & np.uint64((1 << BUCKET_BITS) - 1)).astype(np.int64), (hashes >> np.uint64(32)).astype("<u4")


def write_hashes(folder: str, kind: str, shard: int, hashes: np.ndarray, **values: np.ndarray) -> None:
    """Sorted hash array ``kind`` of a shard, where its buckets start, and values in the same order."""
    bucket, rest = bucket_and_rest(hashes)
    order = np.argsort(bucket.astype(np.uint64) << np.uint64(32) | rest)
    starts = np.searchsorted(bucket[order], np.arange((1 << BUCKET_BITS) + 1))
    write_array(f"{folder}/{kind}-starts-{shard}", starts.astype("<u4"))
    write_array(f"{folder}/{kind}-{shard}", rest[order])
    for name, rows in values.items():
        write_array(f"{folder}/{kind}-{name}-{shard}", rows[order].astype("<u4"))


def find_hashes(folder: str, kind: str, shard: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of hashes in a stored hash array, and whether they are there. The array is mapped for this call only."""
    with opened_array(f"{folder}/{kind}-starts-{shard}", "<u4") as starts, opened_array(f"{folder}/{kind}-{shard}", "<u4") as stored:
        bucket, rest = bucket_and_rest(hashes)
        if not len(stored):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        low, end = starts[bucket].astype(np.int64), starts[bucket + 1].astype(np.int64)
        high = end.copy()
        while (going := low < high).any():
            middle = (low + high) >> 1
            less = going & (stored[np.minimum(middle, len(stored) - 1)] < rest)
            low = np.where(less, middle + 1, low)
            high = np.where(going & ~less, middle, high)
        there = (low < end) & (stored[np.minimum(low, len(stored) - 1)] == rest)
    return low, there


# --- the model's arrays ------------------------------------------------------------------


@dataclass
class Model:
    """Where the arrays are, and the few numbers that hold for all of them."""

    folder: str
    bits: int
    offsets: np.ndarray  # number of the first word of each shard; the last one is the vocabulary's size
    tokens: int
    frequent: np.ndarray  # sorted numbers of the contexts that are spread over the shards
    frequent_stats: np.ndarray = field(default_factory=lambda: np.zeros((0, 4)))
    discounts: tuple[float, ...] = (0.5, 1.0, 1.5)
    types: int = 0  # distinct pairs
    low_discounts: tuple[float, ...] = (0.5, 1.0, 1.5)
    low_mass: float = 0.0
    order: int = 2
    high_discounts: tuple[float, ...] = (0.5, 1.0, 1.5)  # of triples

    @property
    def words(self) -> int:
        return int(self.offsets[-1])

    def array(self, kind: str, shard: int, dtype: str) -> np.ndarray:
        return fresh_array(f"{self.folder}/{kind}-{shard}", dtype)

    def shard_of(self, numbers: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, numbers, side="right") - 1

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of sorted distinct hashes; -1 for words outside the vocabulary."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        cuts = np.searchsorted(hashes >> np.uint64(64 - self.bits), np.arange(1 << self.bits, dtype=np.uint64))
        cuts = np.append(cuts, len(hashes))
        for shard in np.flatnonzero(np.diff(cuts)):
            part = slice(cuts[shard], cuts[shard + 1])
            places, there = find(self.array("words", shard, "<u8"), hashes[part])
            out[part] = np.where(there, places + self.offsets[shard], -1)
        return out

    def dense(self, kind: str, dtype: str, width: int, numbers: np.ndarray) -> np.ndarray:
        """Rows of per-word values for numbers in any order; zeros for -1."""
        out = np.zeros((len(numbers), width))
        shards = np.where(numbers >= 0, self.shard_of(np.maximum(numbers, 0)), -1)
        for shard in np.unique(shards[shards >= 0]):
            mine = shards == shard
            values = self.array(kind, shard, dtype).reshape(-1, width)
            out[mine] = values[numbers[mine] - self.offsets[shard]]
        return out

    def pair_shard(self, contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
        spread = find(self.frequent, contexts)[1]
        return self.shard_of(np.where(spread, words, contexts))

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of pair keys in any order."""
        distinct, back = np.unique(keys, return_inverse=True)
        shards = self.pair_shard(*unpaired(distinct))
        out = np.zeros(len(distinct))
        for shard in np.unique(shards):
            mine = np.flatnonzero(shards == shard)
            out[mine] = find(self.array("once", shard, "<u8"), distinct[mine])[1]
            places, there = find(self.array("more", shard, "<u8"), distinct[mine])
            if there.any():
                out[mine[there]] = self.array("counts", shard, "<u8")[places[there]]
        return out[back]

    def contexts(self, numbers: np.ndarray) -> np.ndarray:
        """Per context: occurrences, and words that follow it once, twice, more often."""
        places, spread = find(self.frequent, numbers)
        out = self.dense("contexts", "<u4", 4, np.where(spread, -1, numbers))
        out[spread] = self.frequent_stats[places[spread]]
        return out

    def scores(self, texts: list[str]) -> dict[str, np.ndarray]:
        """Per text: tokens, known ones, base score and score (log10)."""
        hashes, ends = hashed_tokens(texts)
        starts = np.append(0, ends[:-1])
        distinct, back = np.unique(hashes, return_inverse=True)
        number = self.numbers(distinct)
        seen = self.dense("occurrences", "<u8", 1, number)[:, 0]
        base = np.log10((seen + 1) / (self.tokens + self.words + 1))
        low = self.low(self.dense("types", "<u4", 1, number)[:, 0])
        stats = self.contexts(np.append(number, BEGIN))
        word = number[back]
        before = np.append(len(distinct), back[:-1])
        before[starts] = len(distinct)
        context = np.append(number, BEGIN)[before]
        pair = np.zeros(len(word))
        known = (word >= 0) & (context >= 0)
        pair[known] = self.pair_counts(paired(context[known], word[known]))
        total = stats[before, 0]
        kept = np.maximum(pair - discount(pair, self.discounts), 0)
        mass = stats[before, 1:] @ np.array(self.discounts)
        with np.errstate(divide="ignore", invalid="ignore"):
            chance = np.where(total > 0, (kept + mass * low[back]) / total, low[back])
        if self.order > 2:
            first = np.append(BEGIN, context[:-1])
            first[starts] = BEGIN
            chance = self.high(first, context, word, chance)
        return {
            "n_tokens": ends - starts,
            "n_known": np.add.reduceat((seen > 0)[back].astype(np.int64), starts),
            "base_score": np.add.reduceat(base[back], starts),
            "score": np.add.reduceat(np.log10(chance), starts),
        }

    def spread_pairs(self, pairs: np.ndarray) -> np.ndarray:
        """Which contexts of two words are spread over the shards: those of two frequent words."""
        first, second = unpaired(pairs)
        return find(self.frequent, first)[1] & find(self.frequent, second)[1]

    def high(self, first: np.ndarray, second: np.ndarray, word: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Chances of words after two words, interpolated with those after one; -1 stands for words outside the vocabulary."""
        seen = np.flatnonzero((first >= 0) & (second >= 0))
        pairs, of_pair = np.unique(paired(first[seen], second[seen]), return_inverse=True)
        stats = np.zeros((len(pairs), 4))
        hashes, spread = mixed(pairs), self.spread_pairs(pairs)
        shards = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        for shard in np.unique(shards):
            mine = np.flatnonzero((shards == shard) & ~spread)
            if len(mine):
                _, there = find_hashes(self.folder, "single", shard, hashes[mine])
                stats[mine[there]] = (1, 1, 0, 0)
                places, there = find_hashes(self.folder, "several", shard, hashes[mine])
                with opened_array(f"{self.folder}/several-stats-{shard}", "<u4") as values:
                    stats[mine[there]] = values.reshape(-1, 4)[places[there]]
            mine = np.flatnonzero((shards == shard) & spread)
            if len(mine):
                with opened_array(f"{self.folder}/spread-{shard}", "<u8") as keys:
                    places, there = find(keys, pairs[mine])
                with opened_array(f"{self.folder}/spread-stats-{shard}", "<u8") as values:
                    stats[mine[there]] = values.reshape(-1, 4)[places[there]]
        known = word[seen] >= 0
        triples, example, of_triple = np.unique(
            triple_hashes(hashes[of_pair[known]], word[seen][known]), return_index=True, return_inverse=True
        )
        source = of_pair[known][example]
        counts = np.zeros(len(triples))
        shards = (np.where(spread[source], triples, hashes[source]) >> np.uint64(64 - self.bits)).astype(np.int64)
        for shard in np.unique(shards):
            mine = np.flatnonzero(shards == shard)
            counts[mine] = find_hashes(self.folder, "triple", shard, triples[mine])[1]
            places, there = find_hashes(self.folder, "triples", shard, triples[mine])
            if there.any():
                with opened_array(f"{self.folder}/triples-counts-{shard}", "<u4") as values:
                    counts[mine[there]] = values[places[there]]
        count = np.zeros(len(seen))
        count[known] = counts[of_triple]
        total = stats[of_pair, 0]
        kept = np.maximum(count - discount(count, self.high_discounts), 0)
        mass = (stats[:, 1:] @ np.array(self.high_discounts))[of_pair]
        out = lower.copy()
        with np.errstate(divide="ignore", invalid="ignore"):
            out[seen] = np.where(total > 0, (kept + mass * lower[seen]) / total, lower[seen])
        return out

    def low(self, types: np.ndarray) -> np.ndarray:
        """Chance of a word by its continuation count, interpolated with one share for each word and the unknown."""
        share = 1 / (self.words + 1)
        if not self.types:
            return np.full(len(types), share)
        kept = np.maximum(types - discount(types, self.low_discounts), 0)
        return (kept + self.low_mass * share) / self.types


def triple_hashes(pair_hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mixed(pair_hashes + words.astype(np.uint64) * LAST_WORD)


def paired(contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
    return contexts.astype(np.uint64) << np.uint64(32) | words.astype(np.uint64)


def unpaired(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)


def discount(counts: np.ndarray, discounts: tuple[float, ...]) -> np.ndarray:
    return np.array([0.0, *discounts])[np.minimum(counts, 3).astype(np.int64)]


def discounts_of(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from how many keys occur once to four times; halves where one is missing."""
    if not (n1 and n2 and n3 and n4):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.05 * (k + 1)), k + 1.0) for k, d in enumerate(found))


# --- counting ----------------------------------------------------------------------------


def _text_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[str]]:
    for whole in batches:
        for k in range(0, whole.num_rows, _DOCS_AT_ONCE):
            yield column(whole.slice(k, _DOCS_AT_ONCE), "text")


def _by_shard(shards: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """One row per shard: its keys and counts, packed."""
    order = np.argsort(shards, kind="stable")
    shards, keys, counts = shards[order], keys[order], counts[order]
    found, starts = np.unique(shards, return_index=True)
    cuts = np.append(starts, len(shards))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(found, pa.int32()),
            pa.array([squeezed(keys[a:b].astype("<u8")) for a, b in zip(cuts, cuts[1:])], pa.binary()),
            pa.array([squeezed(counts[a:b].astype("<u4")) for a, b in zip(cuts, cuts[1:])], pa.binary()),
        ],
        ["shard", "keys", "counts"],
    )


_PART = "shard int, keys binary, counts binary"


def _flushed(parts: Iterator[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct keys with counts, of about ``FLUSH_TOKENS`` tokens at a time."""
    held: list[np.ndarray] = []
    size = 0
    for part in parts:
        held.append(part)
        size += len(part)
        if size >= FLUSH_TOKENS:
            yield counted(np.concatenate(held))
            held, size = [], 0
    if size:
        yield counted(np.concatenate(held))


def _gathered(table: pa.Table) -> tuple[int, np.ndarray, np.ndarray]:
    keys = np.concatenate([restored(k.as_py(), "<u8") for k in table.column("keys")])
    counts = np.concatenate([restored(c.as_py(), "<u4") for c in table.column("counts")])
    return table.column("shard")[0].as_py(), *counted(keys, counts.astype(np.int64))


def squeezed(values: np.ndarray) -> bytes:
    """An array packed for a shuffle: first bytes of all values, then the second ones, and so on, by zstd."""
    turned = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return len(values).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(turned.tobytes(), asbytes=True)


def restored(packed: bytes, kind: str) -> np.ndarray:
    n, width = int.from_bytes(packed[:8], "little"), np.dtype(kind).itemsize
    plain = pa.Codec("zstd").decompress(packed[8:], decompressed_size=n * width, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(plain, np.uint8).reshape(width, n).T).view(kind).ravel()


def _triples(hashes: np.ndarray, pairs: np.ndarray, words: np.ndarray, counts: np.ndarray):
    """Distinct triples (hash, pair, word) with summed counts."""
    order = np.argsort(hashes)
    hashes, counts = hashes[order], counts[order]
    starts = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1]))) if len(hashes) else np.empty(0, np.int64)
    sums = np.add.reduceat(counts, starts) if len(starts) else counts[:0]
    return hashes[starts], pairs[order[starts]], words[order[starts]], sums


def _grouped_stats(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per distinct key: the sum of its counts, and how many of them are one, two and more."""
    distinct, back = np.unique(keys, return_inverse=True)
    parts = (counts, counts == 1, counts == 2, counts > 2)
    return distinct, np.stack([np.bincount(back, p, minlength=len(distinct)) for p in parts], axis=1).astype(np.int64)


def train(docs: DataFrame, text_col: str = "text", order: int = ORDER) -> Model:
    """Count the texts of ``docs`` and store the model below ``spark.checkpoint.dir``.

    Only one row per shard comes to the driver, and the numbers of the contexts that make up
    more than a quarter of a shard, so at most four or so for each shard.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = scratch_path(spark, "ngram-model")
    texts = docs.select(F.coalesce(F.col(quoted(text_col)), F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = shard_bits(size)
    often = max(1, int(size // 6) >> bits + 2)  # a quarter of a shard's tokens; few words are that frequent

    def count_words(batches):
        for keys, counts in _flushed(hashed_tokens(group)[0] for group in _text_groups(batches)):
            yield _by_shard((keys >> np.uint64(64 - bits)).astype(np.int64), keys, counts)

    def write_words(table: pa.Table) -> pa.Table:
        shard, keys, counts = _gathered(table)
        write_array(f"{folder}/words-{shard}", keys.astype("<u8"))
        write_array(f"{folder}/occurrences-{shard}", counts.astype("<u8"))
        top = np.flatnonzero(counts >= often)
        return pa.table(
            {
                "shard": pa.array([shard], pa.int32()),
                "size": pa.array([len(keys)], pa.int64()),
                "tokens": pa.array([int(counts.sum())], pa.int64()),
                "top": pa.array([top.tolist()], pa.list_(pa.int64())),
            }
        )

    words = arrow_map(texts, count_words, _PART).groupBy("shard")
    written = words.applyInArrow(write_words, "shard int, size long, tokens long, top array<long>").collect()
    sizes = np.zeros(1 << bits, dtype=np.int64)
    for row in written:
        sizes[row["shard"]] = row["size"]
    offsets = np.append(0, np.cumsum(sizes))
    tokens = sum(row["tokens"] for row in written)
    top = [offsets[row["shard"]] + place for row in written for place in row["top"]]
    if offsets[-1] >= BEGIN:
        raise ValueError(f"{offsets[-1]} different words do not fit into 32 bits")
    model = Model(folder, bits, offsets, tokens, np.array(sorted([*top, BEGIN]), dtype=np.int64), order=order)
    _write_empty(model, {row["shard"] for row in written}, {"words": "<u8", "occurrences": "<u8"}, {})

    def numbered(group: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of all words of the texts, and of the one and the two words before each."""
        hashes, ends = hashed_tokens(group)
        distinct, back = np.unique(hashes, return_inverse=True)
        word = model.numbers(distinct)[back]
        starts = np.append(0, ends[:-1])
        second = np.append(BEGIN, word[:-1])
        second[starts] = BEGIN
        first = np.append(BEGIN, second[:-1])
        first[starts] = BEGIN
        return first, second, word

    def count_pairs(batches):
        for keys, counts in _flushed(paired(*numbered(group)[1:]) for group in _text_groups(batches)):
            yield _by_shard(model.pair_shard(*unpaired(keys)), keys, counts)

    def count_triples(batches):
        def parts():
            held, size = [], 0
            for group in _text_groups(batches):
                first, second, word = numbered(group)
                held.append((paired(first, second), word.astype("<u4")))
                size += len(word)
                if size >= FLUSH_TRIPLES:
                    yield [np.concatenate(x) for x in zip(*held)]
                    held, size = [], 0
            if size:
                yield [np.concatenate(x) for x in zip(*held)]

        for pairs, words in parts():
            hashes = triple_hashes(mixed(pairs), words)
            hashes, pairs, words, counts = _triples(hashes, pairs, words, np.ones(len(words), np.int64))
            near = np.argsort(pairs)  # neighbours are alike, so that they are packed well
            hashes, pairs, words, counts = hashes[near], pairs[near], words[near], counts[near]
            home = np.where(model.spread_pairs(pairs), hashes, mixed(pairs)) >> np.uint64(64 - bits)
            order_ = np.argsort(home, kind="stable")
            found, cuts = np.unique(home[order_], return_index=True)
            cuts = np.append(cuts, len(home))
            columns = [pairs[order_].astype("<u8"), words[order_], counts[order_].astype("<u4")]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found.astype(np.int32)),
                    *[pa.array([squeezed(c[a:b]) for a, b in zip(cuts, cuts[1:])], pa.binary()) for c in columns],
                ],
                ["shard", "pairs", "words", "counts"],
            )

    def write_triples(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        pairs, words, counts = (
            np.concatenate([restored(x.as_py(), kind) for x in table.column(c)])
            for c, kind in (("pairs", "<u8"), ("words", "<u4"), ("counts", "<u4"))
        )
        hashes, pairs, words, counts = _triples(triple_hashes(mixed(pairs), words), pairs, words, counts.astype(np.int64))
        once = counts == 1
        write_hashes(folder, "triple", shard, hashes[once])
        write_hashes(folder, "triples", shard, hashes[~once], counts=counts[~once])
        spread = model.spread_pairs(pairs)
        keys, stats = _grouped_stats(mixed(pairs[~spread]), counts[~spread])
        single = stats[:, 0] == 1
        write_hashes(folder, "single", shard, keys[single])
        write_hashes(folder, "several", shard, keys[~single], stats=stats[~single])
        # a distinct triple is one more word that its last two follow
        follows, types = counted(paired(unpaired(pairs)[1], words.astype(np.int64)))
        pairs_out = _by_shard(model.pair_shard(*unpaired(follows)), follows, types)
        hot, hot_stats = _grouped_stats(pairs[spread], counts[spread])
        home = (mixed(hot) >> np.uint64(64 - bits)).astype(np.int64)
        homes = np.unique(home)
        of_counts = [int((counts == k).sum()) for k in (1, 2, 3, 4)]
        rows = pairs_out.num_rows + len(homes)
        columns = {
            "is_pair": pa.array([True] * pairs_out.num_rows + [False] * len(homes)),
            "shard": pa.array(pairs_out.column(0).to_pylist() + homes.tolist(), pa.int32()),
            "keys": pa.array(pairs_out.column(1).to_pylist() + [hot[home == h].tobytes() for h in homes], pa.binary()),
            "counts": pa.array(
                pairs_out.column(2).to_pylist() + [hot_stats[home == h].astype("<u8").tobytes() for h in homes], pa.binary()
            ),
            "source": pa.array([shard] * rows, pa.int32()),
            "of_counts": pa.array([of_counts] + [[]] * (rows - 1), pa.list_(pa.int64())),
        }
        return pa.table(columns)

    def write_spread(table: pa.Table) -> pa.Table:
        """Contexts of two frequent words: their numbers from all shards."""
        shard = table.column("shard")[0].as_py()
        keys = np.concatenate([np.frombuffer(k, "<u8") for k in table.column("keys").to_pylist()])
        stats = np.concatenate([np.frombuffer(c, "<u8").reshape(-1, 4) for c in table.column("counts").to_pylist()])
        distinct, back = np.unique(keys, return_inverse=True)
        sums = np.stack([np.bincount(back, stats[:, k], minlength=len(distinct)) for k in range(4)], axis=1)
        write_array(f"{folder}/spread-{shard}", distinct.astype("<u8"))
        write_array(f"{folder}/spread-stats-{shard}", sums.astype("<u8"))
        return pa.table({"shard": pa.array([shard], pa.int32())})

    def write_pairs(table: pa.Table) -> pa.Table:
        shard, keys, counts = _gathered(table)
        once = counts == 1
        write_array(f"{folder}/once-{shard}", keys[once].astype("<u8"))
        write_array(f"{folder}/more-{shard}", keys[~once].astype("<u8"))
        write_array(f"{folder}/counts-{shard}", counts[~once].astype("<u8"))
        context, word = unpaired(keys)
        parts = [(once, 1), (counts == 2, 2), (counts > 2, 3)]
        spread = find(model.frequent, context)[1]
        stats = np.zeros((int(sizes[shard]), 4))
        for values, where in ((counts, 0), *((mask.astype(np.int64), k) for mask, k in parts)):
            stats[:, where] = np.bincount(context[~spread] - offsets[shard], values[~spread], minlength=len(stats))
        write_array(f"{folder}/contexts-{shard}", stats.astype("<u4"))
        hot, hot_of = np.unique(context[spread], return_inverse=True)
        hot_stats = [
            np.bincount(hot_of, values[spread], minlength=len(hot)).astype(np.int64).tolist()
            for values in (counts, *(mask.astype(np.int64) for mask, _ in parts))
        ]
        follows, types = counted(word.astype(np.uint64))
        packed = _by_shard(model.shard_of(follows.astype(np.int64)), follows, types)
        out = {name: packed.column(k) for k, name in enumerate(packed.schema.names)}
        out["source"] = pa.array([shard] * packed.num_rows, pa.int32())
        first = [True] + [False] * (packed.num_rows - 1)
        of_counts = [int((counts == k).sum()) for k in (1, 2, 3, 4)]
        many = pa.list_(pa.int64())
        none: list[int] = []
        out["of_counts"] = pa.array([of_counts if f else none for f in first], many)
        for name, values in zip(("hot", "hot0", "hot1", "hot2", "hot3"), (hot.tolist(), *hot_stats)):
            out[name] = pa.array([values if f else none for f in first], many)
        out["types"] = pa.array([len(keys) if f else 0 for f in first], pa.int64())
        return pa.table(out)

    lists = ", ".join(f"{n} array<long>" for n in ("of_counts", "hot", "hot0", "hot1", "hot2", "hot3"))
    if order > 2:
        kinds = "is_pair boolean, shard int, keys binary, counts binary, source int, of_counts array<long>"
        triples = arrow_map(texts, count_triples, "shard int, pairs binary, words binary, counts binary").groupBy("shard")
        triples.applyInArrow(write_triples, kinds).write.parquet(f"{folder}/triples-out")
        found = spark.read.schema(kinds).parquet(f"{folder}/triples-out")
        sums = found.agg(*[F.sum(F.get("of_counts", F.lit(k))) for k in range(4)]).first()
        model.high_discounts = discounts_of(*(int(v or 0) for v in sums))
        hot = found.where("NOT is_pair").groupBy("shard").applyInArrow(write_spread, "shard int").collect()
        sources = {row[0] for row in found.select("source").distinct().collect()}
        for shard in set(range(1 << bits)) - sources:
            for kind, names in (("triple", ()), ("triples", ("counts",)), ("single", ()), ("several", ("stats",))):
                write_hashes(folder, kind, shard, np.empty(0, np.uint64), **{n: np.empty((0, 4)) for n in names})
        _write_empty(model, {row[0] for row in hot}, {"spread": "<u8", "spread-stats": "<u8"}, {})
        pairs = found.where("is_pair").select("shard", "keys", "counts").groupBy("shard")
    else:
        pairs = arrow_map(texts, count_pairs, _PART).groupBy("shard")
    stored_pairs = pairs.applyInArrow(write_pairs, f"{_PART}, source int, {lists}, types long")
    path = f"{folder}/followers"
    stored_pairs.write.parquet(path)
    followers = spark.read.parquet(path)
    _sum_up(model, followers)
    sources = {row[0] for row in followers.select("source").distinct().collect()}
    _write_empty(model, sources, {"once": "<u8", "more": "<u8", "counts": "<u8"}, {"contexts": 4})

    def write_types(table: pa.Table) -> pa.Table:
        shard, keys, counts = _gathered(table)
        types = np.zeros(int(sizes[shard]), "<u4")
        types[keys.astype(np.int64) - offsets[shard]] = counts
        write_array(f"{folder}/types-{shard}", types)
        row = [int((counts == k).sum()) for k in (1, 2, 3, 4)] + [int((counts > 2).sum())]
        return pa.table({f"n{k + 1}": pa.array([v], pa.int64()) for k, v in enumerate(row)})

    kinds = followers.select("shard", "keys", "counts").groupBy("shard")
    low = kinds.applyInArrow(write_types, "n1 long, n2 long, n3 long, n4 long, n5 long")
    targets = {row[0] for row in followers.select("shard").distinct().collect()}
    _write_empty(model, targets, {}, {"types": 1})
    n1, n2, n3, n4, n5 = (int(v or 0) for v in low.agg(*[F.sum(f"n{k}") for k in range(1, 6)]).first())
    model.low_discounts = discounts_of(n1, n2, n3, n4)
    model.low_mass = float(np.dot(model.low_discounts, (n1, n2, n5)))
    return model


def shard_bits(size: int) -> int:
    """Shards (as a power of two) for about ``SHARD_TOKENS`` tokens each, at six bytes a token."""
    return min(max(max(int(size // 6) // SHARD_TOKENS, 1).bit_length(), LEAST_BITS), MOST_BITS)


def _write_empty(model: Model, have: set[int], sorted_: dict[str, str], dense: dict[str, int]) -> None:
    """Files of the shards that no task has written, so that a missing file is always an error."""
    for shard in set(range(1 << model.bits)) - have:
        for kind, dtype in sorted_.items():
            write_array(f"{model.folder}/{kind}-{shard}", np.empty(0, dtype))
        for kind, width in dense.items():
            words = int(model.offsets[shard + 1] - model.offsets[shard])
            write_array(f"{model.folder}/{kind}-{shard}", np.zeros(words * width, "<u4"))


def _sum_up(model: Model, followers: DataFrame) -> None:
    """The numbers that hold for all shards: discounts, distinct pairs, very frequent contexts."""
    sums = followers.agg(*[F.sum(F.get("of_counts", F.lit(k))) for k in range(4)], F.sum("types")).first()
    model.discounts = discounts_of(*(int(v or 0) for v in sums[:4]))
    model.types = int(sums[4] or 0)
    names = [f"hot{k}" for k in range(4)]
    each = followers.select(F.explode(F.arrays_zip("hot", *names)).alias("h"))
    stats = {int(n): np.zeros(4) for n in model.frequent}
    for row in each.groupBy("h.hot").agg(*[F.sum(f"h.{n}").alias(n) for n in names]).collect():
        stats[row["hot"]] = np.array([row[n] for n in names], dtype=float)
    model.frequent_stats = np.array([stats[int(n)] for n in model.frequent])


# --- the operator ------------------------------------------------------------------------


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_tokens``, ``n_known``, ``base_score``, ``score`` and ``perplexity``.

    A token is a word or the end of the text, so a null or empty text has one token. Every
    row gives one row, also repeated ones and those with a null id; other columns are not
    looked at. ``base_score`` is the add-one unigram score.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)
    rows = docs.select(F.col(quoted(id_col)).alias("id"), F.coalesce(F.col(quoted(text_col)), F.lit("")).alias("text"))

    def score_batches(batches):
        for whole in batches:
            for k in range(0, whole.num_rows, _DOCS_AT_ONCE):
                batch = whole.slice(k, _DOCS_AT_ONCE)
                found = sent.value.scores(column(batch, "text"))
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
                arrays = [pa.array(v, t) for v, t in zip(found.values(), kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["id", *found])

    id_type = docs.schema[id_col].dataType.simpleString()
    out = arrow_map(rows, score_batches, f"id {id_type}, n_tokens long, n_known long, base_score double, score double")
    return out.select(
        F.col("id").alias(id_col),
        "n_tokens",
        "n_known",
        "base_score",
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
