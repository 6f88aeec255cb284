"""Lines that many documents share are dropped, except in one document that keeps them.

Lines are normalised and hashed; (hash, document) rows are counted per hash; the hashes over
the threshold go back to their documents, whose other lines are put together by position.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.runtime import arrow_map, column, met, packed, quoted, stored

SPACES = " \t\n\x0b\x0c\r"

#: Production parameters: the shortest key in code points, and the documents that make it frequent.
MIN_CHARS, MIN_DOCS = 20, 3

#: Documents from which a line is very common: there are few such lines, and their rows are not shuffled by line.
HOT_DOCS = 100_000


def line_digest(line: str, min_chars: int) -> bytes | None:
    """128-bit hash of a line's key (A-Z lower-cased, white space stripped), or None if it is short."""
    key = line.strip(SPACES)
    if len(key) < min_chars:
        return None
    return hashlib.md5(key.encode().lower()).digest()  # lower() of bytes changes A-Z only


def dedup_lines(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """All rows and columns; the text without frequent lines, ``n_lines`` before and ``n_dropped``.

    A line whose key has at least ``min_chars`` code points and is found in at least
    ``min_docs`` documents stays only in the document of the largest id that holds it, there
    as often as it occurs. Ids are integers. Rows of one id are one document for the count.
    Rows without an id are documents below every id, one for each different text. A null or empty
    text is one empty line. Own columns ``n_lines`` and ``n_dropped`` are replaced.
    """
    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    has_id = F.col(quoted(id_col)).isNotNull()
    keyed = docs.select(
        has_id.alias("has_id"),
        F.when(has_id, F.col(quoted(id_col)).cast("long")).otherwise(F.xxhash64(text)).alias("doc"),
        text.alias("text"),
        packed([c for c in docs.columns if c != text_col]).alias("rest"),
    )

    def digests(batches):
        for batch in batches:
            keys, rows = [], []
            for row, text in enumerate(column(batch, "text")):
                found = {line_digest(line, min_chars) for line in text.split("\n")} - {None}
                keys += found
                rows += [row] * len(found)
            places = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), batch.column(0).take(places), batch.column(1).take(places)],
                ["line", "has_id", "doc"],
            )

    lines = arrow_map(keyed.select("has_id", "doc", "text"), digests, "line binary, has_id boolean, doc long")
    lines = stored(lines, "lines")
    doc = F.struct("has_id", "doc")
    frequent = (
        lines.distinct()
        .groupBy("line")
        .agg(F.count("*").alias("n"), F.max(doc).alias("keeper"))
        .where(F.col("n") >= min_docs)
    )
    frequent = stored(frequent, "frequent_lines")
    dropped = met(lines, frequent, ["line"], F.col("n"), HOT_DOCS).where(doc != F.col("keeper"))
    dropped = dropped.groupBy("has_id", "doc").agg(F.collect_set("line").alias("dropped"))

    def reassemble(batches):
        for batch in batches:
            texts, n_lines, n_dropped = [], [], []
            for text, gone in zip(column(batch, "text"), column(batch, "dropped")):
                rows = text.split("\n")
                kept = rows
                if gone:
                    gone = set(gone)
                    kept = [r for r in rows if line_digest(r, min_chars) not in gone]
                texts.append("\n".join(kept))
                n_lines.append(len(rows))
                n_dropped.append(len(rows) - len(kept))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(texts, pa.string()),
                    batch.column(2),
                    pa.array(n_lines, pa.int64()),
                    pa.array(n_dropped, pa.int64()),
                ],
                ["text", "rest", "n_lines", "n_dropped"],
            )

    joined = keyed.join(dropped, ["has_id", "doc"], "left").select("text", "dropped", "rest")
    kind = joined.schema["rest"].dataType.simpleString()
    out = arrow_map(joined, reassemble, f"text string, rest {kind}, n_lines long, n_dropped long")
    added = ("n_lines", "n_dropped")
    columns = [
        F.col("text").alias(c) if c == text_col else F.col("rest").getField(c).alias(c)
        for c in docs.columns
        if c not in added
    ]
    return out.select(*columns, *added)


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits: int) -> DataFrame:
    """The documents without their frequent lines, same columns; ``n_chars`` follows the text.

    Nulls, repeated rows and ids, and empty tables as in ``dedup_lines``: every row stays.
    """
    out = dedup_lines(docs, id_col=id_col, text_col=text_col, **limits)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(quoted(text_col)).cast(docs.schema["n_chars"].dataType))
    return out.select(*map(quoted, docs.columns))
