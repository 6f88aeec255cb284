"""Line-first quality rules: failing lines go, and documents that lose too much text go too.

Each line is judged on its own by three groups of rules:

* punctuation: a short line without an end mark, or one where many words end in shouts;
* navigation: words strung together by separators, breadcrumbs or link arrows;
* boilerplate: set phrases of page furniture, words decorated with markup symbols, and words
  said over and over.

The failing lines are removed. A document is rejected if more than ``max_lost`` of its
characters (white space aside) stood in removed lines, or if it fails the base rules on its
number of words and on repeated passages.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.runtime import arrow_map, column, packed, quoted

#: Production parameters.
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
WINDOW_WORDS = 8
MAX_LOST = 0.4
SHORT_LINE_WORDS = 4
MIN_SEPARATORS = 3
STUTTER_WORDS = 8

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
END_MARKS = ".!?…:;。！？؟।\"'”’»)]"
SEPARATORS = {"|", "»", "«", "›", "‹", ">", "<", "/", "•", "·", "→", "←", "::", "-", "–", "—"}

#: Set phrases of page furniture; a line with one of them fails if it is no longer than a sentence.
BOILERPLATE = re.compile(
    r"all rights reserved|terms of (?:use|service)|privacy policy|cookie policy|uses cookies|accept cookies"
    r"|enable javascript|javascript is (?:disabled|required)|click here|read more|sign up for|log ?in to"
    r"|subscribe to our|share (?:this|on)|skip to (?:main )?content|back to top|page not found|lorem ipsum",
    re.IGNORECASE,
)
BOILERPLATE_WORDS = 30


def line_fails(line: str) -> str:
    """The group of rules that a line with a word fails, or ``""``."""
    words = line.encode().split()
    n = len(words)
    text = line.strip(SPACES)
    separators = sum(w.decode() in SEPARATORS for w in words if len(w) <= 3)
    if separators >= MIN_SEPARATORS and 4 * separators >= n:
        return "navigation"
    if n <= BOILERPLATE_WORDS and BOILERPLATE.search(text):
        return "boilerplate"
    if 2 * sum(text.count(c) for c in SYMBOLS) >= n:
        return "boilerplate"
    if n >= STUTTER_WORDS and 2 * sum(map(bytes.__eq__, words, words[1:])) >= n:
        return "boilerplate"
    if n <= SHORT_LINE_WORDS and text[-1] not in END_MARKS:
        return "punctuation"
    if n >= 3 and 2 * sum(w.endswith((b"!", b"!!")) for w in words) >= n:
        return "punctuation"
    return ""


def repeated_words(words: list[bytes], window: int = WINDOW_WORDS) -> int:
    """Words inside windows of ``window`` words that are found twice or more, first ones included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    key = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    span = 1
    while span < window:  # equal numbers stand for equal runs of ``span`` words
        step = min(span, window - span)
        pairs = key[: len(key) - step] * (int(key.max()) + 1) + key[step:]
        _, key = np.unique(pairs, return_inverse=True)
        span += step
    twice = np.bincount(key)[key] > 1
    if not twice.any():
        return 0
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    edges[:n] += twice
    edges[window : window + n] -= twice
    return int((np.cumsum(edges)[:-1] > 0).sum())


def judge(text: str) -> tuple:
    """(kept text, words, their characters, symbols, repeated lines, words in repeated windows,
    base rules failed, lines removed, share of the text lost, kept)"""
    words = text.encode().split()
    word_chars = len(text) - sum(map(text.count, SPACES))
    seen, repeats, removed, lost, lines = set(), 0, 0, 0, []
    for line in text.split("\n"):
        if not line.strip(SPACES):
            lines.append(line)
            continue
        if line in seen:
            repeats += 1
        seen.add(line)
        if line_fails(line):
            removed += 1
            lost += len(line) - sum(map(line.count, SPACES))
        else:
            lines.append(line)
    n, repeated = len(words), repeated_words(words)
    failed = n < MIN_WORDS or 100 * repeated > MAX_REPEATED_PERCENT * n
    share = lost / word_chars if word_chars else 0.0
    kept = not failed and share <= MAX_LOST
    symbols = sum(map(text.count, SYMBOLS))
    return "\n".join(lines), n, word_chars, symbols, repeats, repeated, failed, removed, share, kept


FIELDS = [
    ("kept_text", "string", pa.string()),
    ("n_words", "long", pa.int64()),
    ("word_chars", "long", pa.int64()),
    ("n_symbols", "long", pa.int64()),
    ("n_dup_lines", "long", pa.int64()),
    ("n_repeat_words", "long", pa.int64()),
    ("base_failed", "boolean", pa.bool_()),
    ("n_removed_lines", "long", pa.int64()),
    ("lost_share", "double", pa.float64()),
    ("kept", "boolean", pa.bool_()),
]


def judged(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows and columns with the struct ``verdict`` of the fields above.

    A null or empty text has no words, so it fails the base rules and is not kept. Repeated
    rows are judged alike; a null id is no hindrance. An own column named ``verdict`` is replaced.
    """
    names = [f[0] for f in FIELDS]
    kinds = pa.struct([(n, t) for n, _, t in FIELDS])
    rest = [c for c in docs.columns if c not in (text_col, "verdict")]
    rows = docs.select(F.col(quoted(text_col)).alias("text"), packed(rest).alias("rest"))

    def judge_batches(batches):
        for batch in batches:
            values = list(zip(*(judge(t or "") for t in column(batch, "text")))) or [()] * len(names)
            arrays = [pa.array(v, t) for v, (_, _, t) in zip(values, FIELDS)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.StructArray.from_arrays(arrays, fields=list(kinds))],
                ["text", "rest", "verdict"],
            )

    struct = ", ".join(f"{n}: {t}" for n, t, _ in FIELDS)
    kind = rows.schema["rest"].dataType.simpleString()
    out = arrow_map(rows, judge_batches, f"text string, rest {kind}, verdict struct<{struct}>")
    places = {c: F.col("rest").getField(c) for c in rest} | {text_col: F.col("text"), "verdict": F.col("verdict")}
    return out.select(*[places[c].alias(c) for c in docs.columns if c != "verdict"], "verdict")


def clean(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that are kept, without their failing lines; same columns as before.

    A column ``n_chars`` is set to the length of the text that is left. Every row is judged on its own, also
    repeated ones and those without an id; null, empty and blank texts have too few words and go.
    """
    kept = judged(docs, text_col).where("verdict.kept").withColumn(text_col, F.col("verdict.kept_text"))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length(quoted(text_col)).cast(docs.schema["n_chars"].dataType))
    return kept.select(*map(quoted, docs.columns))
