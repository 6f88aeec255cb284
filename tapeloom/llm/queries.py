"""The named queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm import (
    byte_bpe,
    decontaminate,
    html_text,
    license_scan,
    line_dedup,
    near_dedup,
    ngram_lm,
    quality,
    queries_structure,
    token_counts,
    url_filter,
)
from tapeloom.llm.runtime import documents

BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"
WORD_MERGES = "word_bpe_49k.json"


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(documents(spark, sf_dir))


def encoded(docs: DataFrame) -> DataFrame:
    """Token count and digests of each row's ids and decoded bytes, as ``byte_bpe.encode_decode`` gives them."""
    done = byte_bpe.encode_decode(docs, public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN)
    return done.select(
        "doc_id",
        F.expr("length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


#: The rules that the url query judges by.
URL_RULES = [
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
]


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(documents(spark, sf_dir, "pages"), URL_RULES)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.judged(documents(spark, sf_dir).select("doc_id", "text"))
    names = [f[0] for f in quality.FIELDS if f[0] != "kept_text"]
    return rows.select("doc_id", *[F.col(f"verdict.{n}").alias(n) for n in names])


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir), size=4)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path(WORD_MERGES))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return license_scan.scan(docs, license_scan.train(docs))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(documents(spark, sf_dir, "pages"))


def op8_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    docs = documents(spark, sf_dir)
    model = ngram_lm.train(docs.where(~held_out))
    scored = ngram_lm.score(docs, model)
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_url_filter": op2_url_filter,
    "op3_quality": op3_quality,
    "op4_near_dedup": op4_near_dedup,
    "op5_token_counts": op5_token_counts,
    "op6_license_scan": op6_license_scan,
    "op7_html_text": op7_html_text,
    "op8_ngram_lm": op8_ngram_lm,
    "op9_decontaminate": op9_decontaminate,
    "op10_line_dedup": op10_line_dedup,
    **queries_structure.QUERIES,
}

SQL: dict[str, str] = dict(queries_structure.SQL)

# chr(9)..chr(13) and the space are the white space of a line's ends.
SQL["op10_line_dedup"] = """
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS place, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), frequent AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT k.*, f.keeper IS NOT NULL AND f.keeper <> k.doc_id AS gone
  FROM keyed k LEFT JOIN frequent f USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def _url_level(level: int) -> str:
    """SQL for one level of the path-template tree: from t<level - 1> to t<level>, in which ended branches stay."""

    def differ(x: str) -> str:
        b, n, b0, n0 = (f"{c}::DOUBLE" for c in (x, "n", f"{x}0", "n0"))
        gap = f"({b} * {n0} - {b0} * {n})"
        return f"{gap} * {gap} * ({n} + {n0}) > 3.8416::DOUBLE * ({b} + {b0}) * ({n} + {n0} - {b} - {b0}) * {n} * {n0}"

    return f"""
r{level} AS (
  SELECT *, coalesce(parts[{level}], '') AS seg FROM t{level - 1} WHERE NOT ended
), c{level} AS (
  SELECT host, branch, seg, sum(n) AS n, sum(bad) AS bad, sum(good) AS good FROM r{level} GROUP BY host, branch, seg
), k{level} AS (
  SELECT *, CASE WHEN kids > 50 AND n * 50 < total THEN '*' ELSE seg END AS kind
  FROM (SELECT *, sum(n) OVER w AS total, count(*) OVER w AS kids, max(seg <> '') OVER w AS deeper,
        sum(bad + good) OVER w > 0 AND sum(bad) OVER w < sum(n) OVER w AND sum(good) OVER w < sum(n) OVER w AS mixed
        FROM c{level} WINDOW w AS (PARTITION BY host, branch))
), m{level} AS (
  SELECT host, branch, kind, any_value(deeper) AS deeper, any_value(mixed) AS mixed, sum(n) AS n, sum(bad) AS bad, sum(good) AS good
  FROM k{level} GROUP BY host, branch, kind
), b{level} AS (
  SELECT *, lag(n) OVER o AS n0, lag(bad) OVER o AS bad0, lag(good) OVER o AS good0 FROM m{level}
  WINDOW o AS (PARTITION BY host, branch ORDER BY bad / n, good / n, kind)
), u{level} AS (
  SELECT *, sum(CASE WHEN n0 IS NULL OR {differ("bad")} OR {differ("good")} THEN 1 ELSE 0 END)
    OVER (PARTITION BY host, branch ORDER BY bad / n, good / n, kind ROWS UNBOUNDED PRECEDING) AS run
  FROM b{level}
), v{level} AS (
  SELECT host, branch, kind, deeper, mixed AND deeper AS goes_on,
         min(kind) OVER w || CASE WHEN count(*) OVER w > 1 THEN '+' ELSE '' END AS name FROM u{level}
  WINDOW w AS (PARTITION BY host, branch, run)
), t{level} AS (
  SELECT host, shape, parts, n, bad, good, NOT goes_on AS ended,
         branch || CASE WHEN goes_on AND name <> '' THEN '/' || name WHEN NOT goes_on AND v.deeper THEN '/**' ELSE '' END AS branch
  FROM r{level} JOIN (SELECT host, branch, seg, kind FROM k{level}) USING (host, branch, seg) JOIN v{level} v USING (host, branch, kind)
  UNION ALL SELECT * FROM t{level - 1} WHERE ended
)"""


# Five levels are more than the given urls have.
SQL["op2_url_filter"] = f"""
WITH parsed AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), rules(rule, action) AS (
  VALUES ('net/', 'block'), ('example.net/en/', 'allow'), ('example.com/de/', 'block'), ('org/fr/', 'allow')
), fits AS (
  SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS ruled
  FROM parsed LEFT JOIN rules
    ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
   AND starts_with(path, substr(rule, strpos(rule, '/')))
  GROUP BY page_id, host, path
), urls AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(path, '[0-9a-f]{{16,}}', '{{x}}', 'g'),
           '[0-9]+', '{{n}}', 'g'), '/+', '/', 'g'), '^/|/$', '', 'g') AS shape
  FROM fits
), t0 AS (
  SELECT host, shape, string_split(shape, '/') AS parts, count(*) AS n, count(*) FILTER (ruled = 'block') AS bad,
         count(*) FILTER (ruled = 'allow') AS good, false AS ended, host AS branch
  FROM urls WHERE host <> '' GROUP BY host, shape
), {", ".join(map(_url_level, range(1, 6)))}, leaves AS (
  SELECT host, shape, branch AS template,
         (sum(bad) OVER w + 0.1::DOUBLE * 5) / (sum(bad) OVER w + sum(good) OVER w + 5) AS badness
  FROM t5 WINDOW w AS (PARTITION BY host, branch)
)
SELECT page_id, host, path, rule, template, coalesce(badness, 0.1::DOUBLE) AS badness,
       coalesce(ruled, CASE WHEN badness >= 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM urls LEFT JOIN leaves USING (host, shape)
"""


def _seed(words: str, at: str) -> str:
    """SQL for the tokens under each mask at a position, as a list of strings."""
    masks = [
        f"'{n} ' || " + " || ' ' || ".join(f"{words}[{at} + {k + 1}]" for k, one in enumerate(mask) if one == "1")
        for n, mask in enumerate(decontaminate.MASKS)
    ]
    return f"[{', '.join(masks)}]"


_TOKENS = r"string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g')), ' ')"

SQL["op9_decontaminate"] = f"""
WITH docs AS (
  SELECT doc_id, {_TOKENS} AS words FROM documents
), items AS (
  SELECT DISTINCT item_id, {_TOKENS} AS item_words FROM benchmark
), doc_places AS (
  SELECT doc_id, words, unnest(range(0, len(words) - 9)) AS pos FROM docs WHERE len(words) >= 10
), doc_seeds AS (
  SELECT doc_id, pos, unnest({_seed("words", "pos")}) AS seed FROM doc_places
), item_places AS (
  SELECT item_id, item_words, unnest(range(0, len(item_words) - 9)) AS item_at FROM items WHERE len(item_words) >= 10
), item_seeds AS (
  SELECT item_id, item_at, unnest({_seed("item_words", "item_at")}) AS seed FROM item_places
), hits AS (
  SELECT doc_id, item_id, pos, item_at, words, item_words,
         greatest(0, item_at - 10) AS first, least(len(item_words), item_at + 20) AS past
  FROM doc_seeds JOIN item_seeds USING (seed) JOIN docs USING (doc_id) JOIN items USING (item_id)
), compared AS (
  SELECT doc_id, item_id, past - first AS compared,
         len(list_filter(range(first, past), lambda k: k + pos - item_at >= 0
             AND words[k + pos - item_at + 1] IS NOT DISTINCT FROM item_words[k + 1])) AS agree
  FROM hits
)
SELECT doc_id, item_id, count(*) AS n_hits, max(agree) AS most_agreeing
FROM compared WHERE agree * 100 >= compared * 75 GROUP BY doc_id, item_id
"""


_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"


def _sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in sorted(values))


SQL["op3_quality"] = rf"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t, {_WORDS.format("coalesce(text, '')")} AS words FROM documents
), runs AS (
  SELECT doc_id, place, array_to_string(words[place + 1 : place + 8], ' ') AS run
  FROM (SELECT doc_id, words, unnest(range(0, len(words) - 7)) AS place FROM docs)
), repeated AS (
  SELECT doc_id, count(DISTINCT place + k) AS n_repeat_words
  FROM (SELECT doc_id, place, unnest(range(0, 8)) AS k FROM (
    SELECT *, count(*) OVER (PARTITION BY doc_id, run) AS times FROM runs) WHERE times > 1)
  GROUP BY doc_id
), lines AS (
  SELECT doc_id, place, line, {_WORDS.format("line")} AS w
  FROM (SELECT doc_id, generate_subscripts(parts, 1) AS place, unnest(parts) AS line
        FROM (SELECT doc_id, string_split(t, chr(10)) AS parts FROM docs))
), counted AS (
  SELECT *, len(w) AS n, array_to_string(w, '') AS solid,
         len(list_filter(w, lambda x: x IN ({_sql_list(quality.SEPARATORS)}))) AS separators,
         length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g')) AS symbols,
         len(list_filter(range(1, len(w)), lambda k: w[k] = w[k + 1])) AS stutters,
         len(list_filter(w, lambda x: ends_with(x, '!'))) AS shouts,
         row_number() OVER (PARTITION BY doc_id, line ORDER BY place) > 1 AS again
  FROM lines WHERE len(w) > 0
), judged AS (
  SELECT *, (separators >= 3 AND 4 * separators >= n)
         OR (n <= 30 AND regexp_matches(line, '(?i){quality.BOILERPLATE.pattern}'))
         OR 2 * symbols >= n
         OR (n >= 8 AND 2 * stutters >= n)
         OR (n <= 4 AND right(solid, 1) NOT IN ({_sql_list(quality.END_MARKS)}))
         OR (n >= 3 AND 2 * shouts >= n) AS fails
  FROM counted
), by_doc AS (
  SELECT doc_id, count(*) FILTER (again) AS n_dup_lines, count(*) FILTER (fails) AS n_removed_lines,
         coalesce(sum(length(solid)) FILTER (fails), 0) AS lost
  FROM judged GROUP BY doc_id
), numbers AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_removed_lines, 0) AS n_removed_lines, coalesce(lost, 0) AS lost
  FROM docs LEFT JOIN by_doc USING (doc_id) LEFT JOIN repeated USING (doc_id)
), base AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         CASE WHEN word_chars > 0 THEN lost::DOUBLE / word_chars ELSE 0 END AS lost_share
  FROM numbers
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_removed_lines, lost_share,
       NOT base_failed AND lost_share <= 0.4::DOUBLE AS kept
FROM base
"""

SQL["op4_near_dedup"] = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[k + 1 : k + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 3, 1))) AS k FROM docs WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM shingles a JOIN shingles b USING (s)
  WHERE a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * common >= 80 * (p.n + q.n - common)
), reached AS (
  SELECT doc_id, doc_id AS other FROM docs
  UNION
  SELECT doc_id, y FROM reached JOIN links ON x = other
)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

# A plainer path for the given pages, whose articles are marked: blocks of the article element.
SQL["op7_html_text"] = r"""
WITH inside AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) AS a FROM pages
), plain AS (
  SELECT page_id, url, regexp_replace(regexp_replace(a, '</?(?:p|h1|br)>', ' ', 'g'), '<[^>]*>', '', 'g') AS t FROM inside
), decoded AS (
  SELECT page_id, url, replace(replace(replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'),
         '&quot;', '"'), '&#39;', chr(39)), '&copy;', '©'), '&middot;', '·'), '&amp;', '&') AS t FROM plain
), spaced AS (
  SELECT page_id, url, trim(regexp_replace(t, '\s+', ' ', 'g')) AS text FROM decoded
)
SELECT page_id, url, text, length(text) AS n_chars FROM spaced
"""
