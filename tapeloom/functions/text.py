"""Text expressions: cleaning, dates, page text, tokens, lexicon classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.functions.vectors import let, total

# The columns that hold free text in the wide news form.
TEXT_COLUMNS = [
    "article_title",
    "article",
    "publisher",
    "author",
    "lsa_summary",
    "luhn_summary",
    "textrank_summary",
    "lexrank_summary",
]

# The named HTML entities that pages use, with their characters.
ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&nbsp;", " "),
    ("&amp;", "&"),
]

DEFAULT_NEGATIVE = ("loss", "fall", "drop", "down", "weak", "miss", "risk", "cut")
DEFAULT_POSITIVE = ("gain", "rise", "jump", "up", "strong", "beat", "growth", "record")


# All Unicode white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Remove all leading and trailing white space, not only blanks."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def clean_text(text: Column) -> Column:
    """Line breaks to one blank, trimmed, double quotes to single ones."""
    joined = strip(F.regexp_replace(text, r"[\n\r]+", " "))
    return strip(F.translate(joined, '"', "'"))


def clean_text_columns(df: DataFrame, columns: Sequence[str] = tuple(TEXT_COLUMNS)) -> DataFrame:
    """Clean those of ``columns`` that are present and hold strings."""
    types = dict(df.dtypes)
    return df.withColumns({c: clean_text(F.col(c)) for c in columns if types.get(c) == "string"})


def article_date(raw: Column) -> Column:
    """First ten characters as a strict yyyy-MM-dd date; anything else is null."""
    head = F.substring(raw, 1, 10)
    strict = F.when(head.rlike(r"^\d{4}-\d{2}-\d{2}$"), head)
    return F.to_date(F.try_to_timestamp(strict, F.lit("yyyy-MM-dd")))


def page_text(html: Column) -> Column:
    """The paragraphs of a page joined by blanks; '' where there is none."""
    body = F.regexp_replace(
        html,
        r"(?is)<script\b.*?</script>|<style\b.*?</style>|<nav\b.*?</nav>|<!--.*?-->",
        "",
    )
    paragraphs = F.regexp_extract_all(body, F.lit(r"(?is)<p(?:\s[^>]*)?>(.*?)</p>"), F.lit(1))
    text = F.regexp_replace(F.array_join(paragraphs, " "), r"(?s)<[^>]*>", "")
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.coalesce(strip(F.regexp_replace(text, r"\s+", " ")), F.lit(""))


NOT_LETTERS = r"[^\p{L}]+"


def pieces(text: Column, limit: int = -1) -> Column:
    """Lower-case letter runs in order, with an empty piece at an open end."""
    return F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_LETTERS, limit)


def tokens(text: Column) -> Column:
    """Lower-case letter runs, in order."""
    return F.filter(pieces(text), lambda t: t != "")


def leading_tokens(text: Column, n: int) -> Column:
    """The first ``n`` tokens, without splitting the rest of the text."""
    return F.slice(F.filter(pieces(text, n + 2), lambda t: t != ""), 1, n)


def lexicon_probabilities(
    text: Column,
    negative: Sequence[str] = DEFAULT_NEGATIVE,
    positive: Sequence[str] = DEFAULT_POSITIVE,
) -> Column:
    """(negative, neutral, positive) shares from word hits, one neutral hit assumed."""

    def hits(words: Column) -> Column:
        return F.array(
            F.size(F.filter(words, lambda t: t.isin(*negative))),
            F.lit(1),
            F.size(F.filter(words, lambda t: t.isin(*positive))),
        )

    def shares(counts: Column) -> Column:
        every = (counts[0] + counts[1] + counts[2]).cast("double")
        return F.transform(counts, lambda n: n / every)

    return let(let(tokens(text), hits), shares)


def sentiment_score(probabilities: Column) -> Column:
    """1·negative + 3·neutral + 5·positive."""
    return let(probabilities, lambda p: p[0] * 1.0 + p[1] * 3.0 + p[2] * 5.0)


def softmax(logits: Column) -> Column:
    """Class probabilities from logits, shifted by the maximum for stability."""

    def divide(raised: Column) -> Column:
        return let(total(raised), lambda every: F.transform(raised, lambda x: x / every))

    return let(exponentials(logits), divide)


def exponentials(scores: Column) -> Column:
    """exp(score - greatest score) per element."""
    return let(F.array_max(scores), lambda top: F.transform(scores, lambda s: F.exp(s - top)))
