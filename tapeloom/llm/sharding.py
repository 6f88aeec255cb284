"""Shards of nearly equal bytes by histogram sort.

Rows are ordered by a digest of the text, then one of the id. Probes of that order are refined: exact bytes are
counted below candidate boundaries over all partitions, until each splitter has its share within the tolerance. Only
cells that still hold a splitter are looked at again. Then the rows are exchanged once, to their shards.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.llm.runtime import packed, quoted, sized, stored

#: Production parameters: shards; a splitter may miss its share by this part of a shard's bytes.
SHARDS, TOLERANCE = 40, 0.01

#: Bytes that a row weighs beside its text.
ROW_BYTES = 16

#: Hex digits of the text's digest and, behind it, of the id's; digits by which the probes are refined.
DIGITS, STEP = 16, 2

#: Rows that are numbered together: about so many, and at most so many unless their keys are equal.
SEGMENT_ROWS, MOST_ROWS = 16_384, 65_536


def place(text: Column, key: Column) -> Column:
    """Where a row stands: equal texts side by side, inside them by id."""
    ends = [F.substring(F.md5(F.coalesce(c.cast("string"), F.lit(""))), 1, DIGITS) for c in (text, key)]
    return F.concat(*ends)


def weight(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def splitters(rows: DataFrame, shards: int, tolerance: float) -> list[str]:
    """Ascending splitters of ``rows`` (place, size); a row's shard is the number of splitters up to its place.

    A boundary is the least prefix length at which one is near enough; if there is none (a row, or rows of one text
    and id, weigh more than the tolerance), the nearest of all places. The driver holds at most 256 counts a splitter.
    """
    total = rows.agg(F.sum("size")).first()[0] or 0
    near = round(1 / tolerance)
    found: dict[int, str] = {}
    open_cells = {"": (0, list(range(1, shards)) if total else [])}  # prefix -> (bytes below, splitters inside)
    for digits in range(STEP, 2 * DIGITS + 1, STEP):
        wanted = {prefix: cell for prefix, cell in open_cells.items() if cell[1]}
        if not wanted:
            break
        inside = rows if digits == STEP else rows.where(F.substring("place", 1, digits - STEP).isin(list(wanted)))
        counted = inside.groupBy(F.substring("place", 1, digits).alias("prefix")).agg(F.sum("size").alias("size"))
        cells = sorted((r["prefix"], r["size"]) for r in counted.collect())
        open_cells = {}
        for parent, (below, targets) in wanted.items():
            children = []
            for prefix, size in cells:
                if prefix.startswith(parent):
                    children.append((prefix, below, size))
                    below += size
            edges = [(p, b) for p, b, _ in children] + [(children[-1][0] + "g", below)]  # g sorts above all digits
            for k in targets:
                miss, _, prefix = min((abs(b * shards - k * total), b, p) for p, b in edges)
                if miss * near <= total or digits == 2 * DIGITS:
                    found[k] = prefix
                else:
                    cell = max((c for c in children if c[1] * shards <= k * total), key=lambda c: c[1])
                    open_cells.setdefault(cell[0], (cell[1], []))[1].append(k)
    return [found[k] for k in sorted(found)]


def shard_of(where: Column, bounds: list[str]) -> Column:
    return reduce(lambda n, b: n + (where >= F.lit(b)).cast("int"), bounds, F.lit(0))


def segments(rows: DataFrame) -> tuple[int, DataFrame, DataFrame]:
    """How places are cut for numbering: (leading digits, cells with too many rows, texts with too many rows).

    Beyond ``MOST_ROWS`` a cell is cut by whole digests of texts, and such a text by digits of the ids.
    """
    n = rows.count()
    digits = max(0, math.ceil(math.log(n / SEGMENT_ROWS, 16))) if n else 0
    cell, text = F.substring("place", 1, digits).alias("cell"), F.substring("place", 1, DIGITS).alias("text_digest")
    many = F.col("count") > MOST_ROWS
    cells = stored(rows.groupBy(cell).count().where(many).select("cell"), "large_cells")
    texts = stored(rows.groupBy(text).count().where(many).select("text_digest"), "large_texts")
    return digits, cells, texts


def with_segment(rows: DataFrame, cut: tuple[int, DataFrame, DataFrame]) -> DataFrame:
    """A prefix of the place: rows of one prefix are numbered in one task."""
    digits, cells, texts = cut
    found = (
        rows.withColumns({"cell": F.substring("place", 1, digits), "text_digest": F.substring("place", 1, DIGITS)})
        .join(sized(cells.withColumn("is_large", F.lit(True))), "cell", "left")
        .join(sized(texts.withColumn("is_hot", F.lit(True))), "text_digest", "left")
    )
    prefix = F.when(F.col("is_hot"), F.substring("place", 1, DIGITS + digits)).when(F.col("is_large"), F.col("text_digest"))
    return found.withColumn("segment", F.coalesce(prefix, "cell")).drop("cell", "text_digest", "is_large", "is_hot")


def shard(
    docs: DataFrame,
    shards: int = SHARDS,
    tolerance: float = TOLERANCE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """All rows and columns with ``size`` (UTF-8 bytes of the text and 16), ``shard`` and ``slot``.

    The shards have nearly equal sizes: each splitter's bytes below differ from its share by at most ``tolerance``
    of a shard, or stand at the nearest place. Rows of equal texts are neighbours, and cut only where a splitter
    has to stand among them. Slots number a shard's rows from 0 in their order. A null text is an empty one; rows
    equal in id (null too) and text are never parted. An empty table has no shards. Own columns are replaced.
    """
    where = place(F.col(quoted(text_col)), F.col(quoted(id_col)))
    size = weight(F.col(quoted(text_col)))
    narrow = stored(docs.select(where.alias("place"), size.alias("size")), "places")
    bounds, cut = splitters(narrow, shards, tolerance), segments(narrow)
    own = shard_of(F.col("place"), bounds)
    counts = with_segment(narrow.withColumn("shard", own), cut).groupBy("shard", "segment").count()
    earlier = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("count").over(earlier), F.lit(0))
    offsets = sized(stored(counts.select("shard", "segment", first.alias("first")), "slot_offsets"))

    rest = [c for c in docs.columns if c not in ("size", "shard", "slot")]
    rows = docs.select(where.alias("place"), size.alias("size"), packed(rest).alias("rest"))
    dealt = with_segment(rows.withColumn("shard", own), cut)
    number = F.row_number().over(Window.partitionBy("shard", "segment").orderBy("place"))
    numbered = dealt.withColumn("number", number).join(offsets, ["shard", "segment"])
    kept = [F.col("rest").getField(c).alias(c) for c in rest]
    return numbered.select(*kept, "size", "shard", (F.col("first") + F.col("number") - 1).cast("long").alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder of Parquet files per shard; ``slot`` gives the order of its rows."""
    sharded.write.partitionBy("shard").parquet(path)
