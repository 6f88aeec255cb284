"""Near-duplicate groups by SetSketch registers, banding, joint likelihood and full sets.

1. Each text becomes the set of its hashed word shingles. Its sketch has ``REGISTERS``
   registers: the smallest of exponentially distributed values of the shingles, truncated to
   whole powers of ``BASE``. Registers of a union are the larger ones of both, and two sets
   agree in a register about as often as their similarity says.
2. Texts of equal sets are one node. Nodes that agree in all registers of a band share a
   bucket. ``BANDS`` bands of ``ROWS`` registers miss a pair at similarity 0.8 about 3 times
   in a million.
3. Links are looked for until no two nodes of a bucket are left that could join two groups.
   First each node is held against a few hubs of its buckets, so that a large group of
   copies costs its size and not the square of it; this is repeated with other hubs while it
   pays. In buckets whose nodes still lie in more than one group, the nodes outside the largest
   group are held against all others, in blocks; a pair is tested in the first band it shares.
   Pairs inside one group need no test, as their link changes no group.
4. A pair is dropped if the likelihood of both sketches peaks far below the threshold; the
   others are decided on their full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.runtime import BROADCAST_ROWS, arrow_map, column, quoted, sized, stored

#: Production parameters of the sketch.
BANDS, ROWS = 64, 8
REGISTERS = BANDS * ROWS
BASE, RATE, TOP = 1.125, 20.0, 255

#: A pair is given up if its estimate is this many standard errors below the threshold.
ERRORS = 6.0

#: Rounds with hubs end when at most this many pairs a row are left for blocks, or few of their pairs are links.
PAIRS_PER_ROW = 32
ROUNDS, LEAST_LINKED = 4, 0.02

#: Hubs that a node is held against in a round, of those of all its buckets.
HUBS = 6

#: Nodes of a block.
BLOCK = 1_024

#: Rows of a table of a few numbers a row, and pairs to be decided, for one task.
TASK_ROWS, TASK_PAIRS = 100_000, 4_000

_DOCS_AT_ONCE = 1024


# --- shingles ----------------------------------------------------------------------------


def mixed(x: np.ndarray) -> np.ndarray:
    """The bits of 64-bit integers well mixed."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_keys(hashed: np.ndarray, span: int) -> np.ndarray:
    """One hash for each run of ``span`` words."""
    count = max(len(hashed) - span + 1, 0)
    key = np.full(count, span, dtype=np.uint64)
    for k in range(span):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + hashed[k : count + k])
    return key


def distinct_sorted(keys: np.ndarray) -> np.ndarray:
    keys = np.sort(keys)
    return keys[np.concatenate(([True], keys[1:] != keys[:-1]))] if len(keys) else keys


def shingle_sets(texts: list[str], size: int) -> list[np.ndarray]:
    """Per text the sorted hashes of its word shingles; fewer words than ``size`` are one shingle."""
    words = [t.encode().lower().split() for t in texts]  # of bytes: A-Z and ASCII white space only
    counts = [len(w) for w in words]
    hashed = np.fromiter(
        map(xxhash.xxh3_64_intdigest, chain.from_iterable(words)), dtype=np.uint64, count=sum(counts)
    )
    keys, out, start = shingle_keys(hashed, size), [], 0
    for n in counts:
        if n >= size:
            out.append(distinct_sorted(keys[start : start + n - size + 1]))
        else:
            out.append(shingle_keys(hashed[start : start + n], n) if n else hashed[:0])
        start += n
    return out


def shingle_set(text: str, size: int) -> np.ndarray:
    return shingle_sets([text], size)[0]


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether the sets' similarity is at least ``percent`` / 100."""
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


# --- sketches ----------------------------------------------------------------------------


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """One row of registers per set; the registers of an empty set are 0.

    The values of a shingle come in rising order, value j from the j-th of ``REGISTERS``
    intervals and for a register of its own, so that work on a set ends at the interval
    that can lower none of its minima any more. Each shingle has its own order of the registers,
    of steps by odd numbers with shifts between, so that in small sets bands agree independently.
    """
    m, n = REGISTERS, len(sets)
    least = np.full(n * m, np.inf)
    elements = np.concatenate(sets) if sets else np.empty(0, dtype=np.uint64)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    first = mixed(elements + np.uint64(0x1234567887654321)) % np.uint64(m)
    more = mixed(elements ^ np.uint64(0x5851F42D4C957F2D))
    step, turn, shift = (more % np.uint64(m)) | np.uint64(1), (more >> np.uint64(20)) | np.uint64(1), more >> np.uint64(40)
    below = 0.0
    for j in range(1, m + 1):
        if not len(elements):
            break
        above = np.log1p(j / (m - j)) / RATE if j < m else np.inf
        unit = (mixed(elements + np.uint64(j * 0x2545F4914F6CDD1D & (1 << 64) - 1)) >> np.uint64(11)).astype(float) / 2**53
        value = below - np.log1p(-unit / (m - j + 1)) / RATE
        register = (first + np.uint64(j) * step) % np.uint64(m)
        register ^= register >> np.uint64(4)
        register = (register * turn + shift) % np.uint64(m)
        register ^= register >> np.uint64(5)
        place = owner * m + register.astype(np.int64)
        np.minimum.at(least, place, value)
        below = above
        if j > 16 and j % 8:
            continue
        open_sets = least.reshape(n, m).max(axis=1) > above
        going = open_sets[owner]
        if not going.all():
            elements, owner, first, step = elements[going], owner[going], first[going], step[going]
            turn, shift = turn[going], shift[going]
    with np.errstate(divide="ignore"):
        level = np.floor(1 - np.log(least.reshape(n, m)) / np.log(BASE))
    return np.clip(np.nan_to_num(level, neginf=0), 0, TOP).astype(np.uint8)


def _likelihood(larger, smaller, equal, u, similarity):
    """Log-likelihood of how many registers are larger, smaller and equal, at a similarity of two
    sets of which the first has the share ``u`` of both sizes."""

    def chance(x):
        return -np.log1p(-np.clip(x, 0, None) * (BASE - 1) / BASE) / np.log(BASE)

    v = 1 - u
    up, down, tiny = chance(u - v * similarity), chance(v - u * similarity), 1e-300
    return (
        larger * np.log(np.maximum(up, tiny))
        + smaller * np.log(np.maximum(down, tiny))
        + equal * np.log(np.maximum(1 - up - down, tiny))
    )


def estimates(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Most likely similarity of pairs of sketches of sets of known sizes, from both jointly."""
    larger, smaller = (a > b).sum(axis=1), (a < b).sum(axis=1)
    equal = a.shape[1] - larger - smaller
    u = size_a / (size_a + size_b)
    low, high = np.zeros(len(u)), np.minimum(u / (1 - u), (1 - u) / u)
    for _ in range(40):  # the likelihood has one peak
        third = (high - low) / 3
        left = _likelihood(larger, smaller, equal, u, low + third) < _likelihood(larger, smaller, equal, u, high - third)
        low, high = np.where(left, low + third, low), np.where(left, high, high - third)
    return (low + high) / 2


def likely(a: np.ndarray, b: np.ndarray, size_a, size_b, percent: int) -> np.ndarray:
    """Whether the sizes allow the similarity, and the likelihood still rises ``ERRORS`` standard
    errors below it, so that its peak lies higher."""
    slack = ERRORS * (percent * (100 - percent) / 1e4 / REGISTERS) ** 0.5
    at = max(percent / 100 - slack, 0.0)
    larger, smaller = (a > b).sum(axis=-1), (a < b).sum(axis=-1)
    equal = REGISTERS - larger - smaller
    u = size_a / (size_a + size_b)
    rises = _likelihood(larger, smaller, equal, u, at + 1e-4) >= _likelihood(larger, smaller, equal, u, at)
    return rises & (100 * np.minimum(size_a, size_b) >= percent * np.maximum(size_a, size_b))


def sketched(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """Per row: doc, digest of its set, the set's size and the registers."""
    rows = docs.select(
        F.col(quoted(id_col)).cast("long").alias("doc"), F.coalesce(quoted(text_col), F.lit("")).alias("text")
    )

    def sketch(batches):
        for whole in batches:
            for k in range(0, whole.num_rows, _DOCS_AT_ONCE):
                batch = whole.slice(k, _DOCS_AT_ONCE)
                sets = shingle_sets(column(batch, "text"), size)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array([hashlib.md5(s.tobytes()).digest() for s in sets], pa.binary()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([r.tobytes() for r in sketches(sets)], pa.binary()),
                    ],
                    ["doc", "digest", "n", "registers"],
                )

    return arrow_map(rows, sketch, "doc long, digest binary, n long, registers binary")


# --- groups of linked nodes --------------------------------------------------------------


def kept(df: DataFrame, name: str, rows: int, each: int = TASK_ROWS) -> DataFrame:
    """``df``, of at most ``rows`` rows, stored by one task for ``each`` of them."""
    return stored(df.coalesce(rows // each + 1), name)


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """(node, label) for the nodes of undirected edges (a, b); the label is the smallest node reached.

    Each turn every node keeps one edge, that to its smallest neighbour if that is smaller than itself. These
    edges are a forest, whose roots are found by going to the parent's parent again and again, with one row a
    node. Then all other edges are looked at once: those between different roots, each pair of roots once, are the
    edges of the next turn. Two turns halve the roots that still have edges at least. ``rows`` is a bound of the
    number of edges, which are counted without it.
    """
    rows = edges.count() if rows is None else rows
    rest = kept(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "links", rows)
    labels = None
    while rest.head(1):
        hint = F.broadcast if 2 * rows <= BROADCAST_ROWS else lambda df: df
        trees = rest.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
        trees = kept(trees, "trees", rows)
        while True:
            up = trees.select(F.col("node").alias("label"), F.col("label").alias("root"))
            higher = trees.join(hint(up), "label", "left").select("node", F.coalesce("root", "label").alias("label"), "root")
            higher = kept(higher, "trees", rows)
            trees = higher.select("node", "label")
            if not higher.where("root IS NOT NULL").head(1):
                break
        a, b = (trees.select(F.col("node").alias(c), F.col("label").alias(f"root_{c}")) for c in "ab")
        ends = rest.join(hint(a), "a").join(hint(b), "b", "left").withColumn("root_b", F.coalesce("root_b", "b"))
        ends = ends.where("root_a <> root_b")
        ends = ends.select(F.greatest("root_a", "root_b").alias("a"), F.least("root_a", "root_b").alias("b")).distinct()
        if labels is None:
            every = rest.select(F.explode(F.array("a", "b")).alias("node")).distinct()
            labels = every.join(hint(trees), "node", "left").select("node", F.coalesce("label", "node").alias("label"))
        else:
            moved = trees.select(F.col("node").alias("label"), F.col("label").alias("root"))
            labels = labels.join(hint(moved), "label", "left").select("node", F.coalesce("root", "label").alias("label"))
        labels = kept(labels, "labels", 2 * rows)
        rest = kept(ends, "links", rows)
    if labels is None:
        labels = rest.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels


def confirmed(pairs: DataFrame, facts: DataFrame, size: int, percent: int) -> DataFrame:
    """Those pairs (a, b) whose full sets are similar enough. ``facts`` has the nodes' sketches and
    texts; only pairs that the sketches' likelihood leaves open are decided on their texts."""
    def check(batches):
        last = ("", shingle_set("", size))
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (
                np.frombuffer(b"".join(column(batch, c)), dtype=np.uint8).reshape(-1, REGISTERS)
                for c in ("registers_a", "registers_b")
            )
            n_a, n_b = (np.array(column(batch, c), dtype=float) for c in ("n_a", "n_b"))
            found = []
            for near, one, two in zip(likely(a, b, n_a, n_b, percent), column(batch, "text_b"), column(batch, "text_a")):
                if near and one != last[0]:  # the pairs of one hub come one after another
                    last = (one, shingle_set(one, size))
                found.append(bool(near) and similar(last[1], shingle_set(two, size), percent))
            yield batch.select(["a", "b"]).filter(pa.array(found, pa.bool_()))

    def side(end: str) -> DataFrame:
        return facts.select(F.col("node").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in ("n", "registers", "text")])

    return arrow_map(pairs.join(side("a"), "a").join(side("b"), "b"), check, "a long, b long")


def bucketed(nodes: DataFrame) -> DataFrame:
    """(bucket, band, node) for every band of every node."""
    parts = F.array(*[F.substring("registers", ROWS * k + 1, ROWS) for k in range(BANDS)])
    bands = nodes.select("node", F.posexplode(parts).alias("band", "part"))
    return bands.select(F.xxhash64("band", "part").alias("bucket"), "band", "node")


def open_rows(live: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(bucket, band, node, label) of the buckets whose nodes lie in more than one group."""
    placed = live.join(sized(labels), "node", "left").select("bucket", "band", "node", F.coalesce("label", "node").alias("label"))
    several = placed.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    several = kept(several.where("low < high").select("bucket"), "several", rows)
    return kept(placed.join(sized(several), "bucket"), "open", rows)


def with_hubs(rows: DataFrame, turn: int, count: int) -> DataFrame:
    """Pairs of each node with ``HUBS`` hubs: the first of those of its buckets, in an order that all share and that
    changes with each turn. So the nodes of a group of copies meet at few hubs, with few pairs a node."""
    order = F.xxhash64("node", F.lit(turn))
    hubs = rows.groupBy("bucket").agg(F.min_by("node", order).alias("hub"), F.min_by("label", order).alias("hub_label"))
    offered = rows.join(sized(kept(hubs, "hubs", count)), "bucket").where("label <> hub_label")
    entry = F.struct(F.xxhash64("hub", F.lit(turn)).alias("order"), "hub")
    first = offered.groupBy("node").agg(F.slice(F.sort_array(F.collect_set(entry)), 1, HUBS).alias("hubs"))
    pairs = first.select("node", F.explode("hubs.hub").alias("hub"))
    return pairs.select(F.greatest("node", "hub").alias("a"), F.least("node", "hub").alias("b")).distinct()


def outnumbered(rows: DataFrame, count: int) -> DataFrame:
    """The rows of open buckets with the bucket's ``size``, its largest group ``major`` and the ``minor`` nodes outside it."""
    each = rows.groupBy("bucket", "label").agg(F.count("*").alias("c"))
    of_bucket = each.groupBy("bucket").agg(
        F.sum("c").alias("size"), F.max("c").alias("most"), F.max_by("label", F.struct("c", "label")).alias("major")
    )
    of_bucket = kept(of_bucket.select("bucket", "major", "size", (F.col("size") - F.col("most")).alias("minor")), "sizes", count)
    return kept(rows.join(sized(of_bucket), "bucket"), "outnumbered", count)


def compared(rows: DataFrame, facts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) between nodes outside the largest group of a bucket and its nodes of other groups.

    Both sides are dealt into blocks of about ``BLOCK`` nodes, and each pair of blocks is one small table for one
    call. Pairs that share several buckets are looked at in that of their first common band only. Groups that a
    link has joined count as one in the rest of the call, so it gives fewer links than it has groups.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    minor_blocks = F.ceil(F.col("minor") / BLOCK).cast("int")
    dealt = F.xxhash64("node")
    columns = ["node", "label", "bucket", "band"]
    everyone = rows.select(
        *columns, F.lit(False).alias("outside"), F.pmod(dealt, blocks).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), minor_blocks - 1)).alias("minor_block"),
    )
    outside = rows.where("label <> major").select(
        *columns, F.lit(True).alias("outside"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"),
        F.pmod(dealt, minor_blocks).cast("int").alias("minor_block"),
    )

    def compare(table: pa.Table) -> pa.Table:
        node, label, n, band = (np.array(table.column(c).to_pylist()) for c in ("node", "label", "n", "band"))
        away = np.array(table.column("outside").to_pylist())
        registers = np.frombuffer(b"".join(table.column("registers").to_pylist()), np.uint8).reshape(-1, REGISTERS)
        words = registers.view(np.uint64).reshape(-1, BANDS)  # one word a band
        texts = table.column("text").to_pylist()
        others, known, found = np.flatnonzero(~away), {}, []

        def set_of(k: int) -> np.ndarray:
            if k not in known:
                known[k] = shingle_set(texts[k], size)
            return known[k]

        for k in np.flatnonzero(away) if len(others) else ():
            same = words[others] == words[k]
            first = same.any(axis=1) & (same.argmax(axis=1) == band[k]) & (label[others] != label[k])
            near = others[first]
            near = near[likely(registers[k], registers[near], float(n[k]), n[near].astype(float), percent)] if len(near) else near
            for m in near:
                if label[m] != label[k] and similar(set_of(k), set_of(m), percent):
                    found.append((int(node[k]), int(node[m])))
                    label[label == label[m]] = label[k]
        return pa.table({c: pa.array([f[i] for f in found], pa.int64()) for i, c in enumerate("ab")})

    met = everyone.unionByName(outside).join(facts, "node")
    return met.groupBy("bucket", "block", "minor_block").applyInArrow(compare, "a long, b long").distinct()


def joined_groups(labels: DataFrame, links: DataFrame, count: int) -> DataFrame:
    """``labels`` after some more links: only the groups that these join are looked at again."""
    old = sized(labels)

    def group(end: str) -> DataFrame:
        return old.select(F.col("node").alias(end), F.col("label").alias(f"group_{end}"))

    ends = links.join(group("a"), "a", "left").join(group("b"), "b", "left")
    ends = ends.select(F.coalesce("group_a", "a").alias("a"), F.coalesce("group_b", "b").alias("b"))
    grown = components(kept(ends.where("a <> b").distinct(), "group-links", count), count)
    grown = grown.select(F.col("node").alias("label"), F.col("label").alias("new"))
    known = labels.join(sized(grown), "label", "left").select("node", F.coalesce("new", "label").alias("label"))
    added = grown.select(F.col("label").alias("node"), F.col("new").alias("label"))
    return known.unionByName(added.join(known.select("node"), "node", "left_anti"))


def groups(nodes: DataFrame, texts_of: Callable[[DataFrame], DataFrame], size: int, percent: int) -> DataFrame:
    """(node, label) of the nodes that are linked with another one; see the module's text."""
    bands = bucketed(nodes)
    shared = bands.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    live = stored(bands.join(sized(stored(shared.select("bucket"), "shared")), "bucket"), "buckets")
    size_live = live.count()
    involved = kept(live.select("node").distinct(), "involved", size_live)
    few = sized(involved)
    facts = stored(nodes.join(few, "node").join(texts_of(few), "node"), "facts")

    rows, labels = live.withColumn("label", F.col("node")), None
    for turn in range(ROUNDS):
        pairs = kept(with_hubs(rows, turn, size_live), "pairs", size_live)
        tested = pairs.count()
        new = kept(confirmed(pairs, facts, size, percent), "edges", tested, TASK_PAIRS)
        if not (linked := new.count()):
            break
        labels = components(new, linked) if labels is None else kept(joined_groups(labels, new, linked), "labels", size_live)
        rows = open_rows(rows.drop("label"), labels, size_live)  # a bucket of one group stays one
        count, work = outnumbered(rows, size_live).agg(F.count("*"), F.sum(F.expr("CASE WHEN label <> major THEN size ELSE 0 END"))).first()
        if not count or work <= PAIRS_PER_ROW * count or linked < LEAST_LINKED * tested:
            break
    new = stored(compared(outnumbered(rows, size_live), facts, size, percent), "edges")
    if linked := new.count():
        labels = components(new, linked) if labels is None else joined_groups(labels, new, linked)
    return live.select("node", F.col("node").alias("label")).limit(0) if labels is None else labels


# --- the operator ------------------------------------------------------------------------


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, ``n_shingles``, ``component_id`` and ``kept``.

    Documents are linked if the similarity of their sets of ``size``-word shingles is at least
    ``percent`` / 100; ``component_id`` is the smallest id that is reached over links, and the
    document of that id is kept. Ids are integers; rows of one id are one document, whose links
    are those of any of its rows, so that they are kept or not kept together. A text without
    words is linked with nothing. A row without an id is linked with nothing either; its
    ``component_id`` is null and it is kept. Other columns are not looked at.
    """
    rows = stored(sketched(docs, size, id_col, text_col), "sketched")
    linked = rows.where("n > 0 AND doc IS NOT NULL")
    firsts = stored(linked.groupBy("digest").agg(F.min("doc").alias("node")), "firsts")
    nodes = linked.join(firsts, "digest").where("doc = node").select("node", "n", "registers").distinct()

    def texts_of(ids: DataFrame) -> DataFrame:
        texts = docs.select(F.col(quoted(id_col)).cast("long").alias("node"), F.col(quoted(text_col)).alias("text"))
        return texts.join(ids, "node").where("text IS NOT NULL").distinct()

    labels = groups(nodes, texts_of, size, percent)

    # a document with several texts joins the groups of all of them
    several = rows.where("doc IS NOT NULL").groupBy("doc").agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
    several = sized(stored(several.where("low < high").select("doc"), "several_texts"))
    own = stored(linked.select("doc", "digest").join(several, "doc").join(firsts, "digest").select("doc", "node").distinct(), "own_texts")
    least = own.groupBy("doc").agg(F.min("node").alias("b"))
    links = stored(own.join(least, "doc").where("node <> b").select(F.col("node").alias("a"), "b").distinct(), "own_links")
    if count := links.count():
        labels = kept(joined_groups(labels, links, count), "labels", nodes.count())
    of_doc = own.join(labels, "node", "left").groupBy("doc").agg(F.min(F.coalesce("label", "node")).alias("shared"))
    of_doc = sized(stored(of_doc.select(F.col("doc").alias("of"), "shared"), "shared"))

    places = firsts.join(labels, "node", "left").select("digest", F.coalesce("label", "node").alias("component"))
    out = rows.select("doc", "digest", "n").join(
        places.withColumnRenamed("digest", "set"), F.col("digest").eqNullSafe(F.col("set")) & F.col("doc").isNotNull(), "left"
    )
    out = out.join(of_doc, F.col("doc") == F.col("of"), "left").withColumn("component", F.coalesce("shared", "component"))
    return out.select(
        F.col("doc").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc").alias("component_id"),
        F.coalesce(F.col("component") == F.col("doc"), F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without those that are near copies of a kept one; same columns.

    Rows of one id stay or go together; rows without an id and texts without a word stay, also repeated ones.
    """
    gone = near_duplicates(docs, size, percent, id_col, text_col).where("NOT kept")
    gone = gone.select(F.col(quoted(id_col)).alias("_gone")).distinct()
    return docs.join(gone, F.col(quoted(id_col)) == F.col("_gone"), "left_anti")
