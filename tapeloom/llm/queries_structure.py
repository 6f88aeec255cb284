"""The named queries on shards, conversations and periodic runs, and their check SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm import conversation_repair, periodic_runs, sharding
from tapeloom.llm.runtime import documents

WORD = r"[^\x20\x09-\x0D]+"


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = documents(spark, sf_dir).select("doc_id", "text", F.crc32(text).alias("text_crc32"))
    return sharding.shard(docs).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with planted faults: by a checksum, rows are dropped, emptied, cut, doubled or given to the user."""
    space = F.lit(" ")
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    named = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat_ws(":", *named)) % 20
    return turns.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"),
    )


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(damaged(documents(spark, sf_dir, "conversations")), copies_col="copies")


def made_periodic(text: Column, number: Column, words: Column) -> Column:
    """Where the number ends in 0, the words from place a on repeat the p words there; other texts as they are."""
    g, n = F.floor(number / 10), F.size(words).cast("long")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    again = F.flatten(F.array_repeat(F.slice(words, (a + 1).cast("int"), p.cast("int")), (3 + g % 8).cast("int")))
    changed = F.concat(F.slice(words, F.lit(1), a.cast("int")), F.slice(again, F.lit(1), (n - a).cast("int")))
    return F.when((number % 10 == 0) & (n > 0), F.array_join(changed, " ")).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.crc32(F.col("doc_id").cast("string"))
    split = F.when(number % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    docs = documents(spark, sf_dir).select("doc_id", "text", number.alias("number"), split.alias("words"))
    docs = docs.select("doc_id", made_periodic(F.col("text"), F.col("number"), F.col("words")).alias("text"))
    ranked = F.transform("runs", lambda r: F.struct(-r["length"], r["start"], r["period"]))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    found = periodic_runs.find_runs(docs).select("*", F.array_min(ranked).alias("best"), lines.alias("lines"))
    start, length, period = F.col("best.start"), -F.col("best.col1"), F.col("best.period")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("lines", lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op11_sharding": op11_sharding,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_periodic_runs": op13_periodic_runs,
}

SQL: dict[str, str] = {}


def _crc32_of_id(name: str) -> str:
    """SQL for the CRC-32 of a short ASCII text, bit by bit."""
    ops = f"flatten(list_transform(string_split({name}, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    return (
        f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {ops}), "
        "lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) ELSE xor(x >> 1, 3988292384 * (x & 1)) END))"
    )


# Equal pieces of six words at distance q, in a row, are a run of period q (see the module of the operator).
SQL["op13_periodic_runs"] = rf"""
WITH cut AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w, {_crc32_of_id("doc_id::VARCHAR")} AS h FROM documents
), placed AS (
  SELECT *, len(w) AS n, h // 10 AS g, (h // 10) % greatest(len(w), 1) AS a FROM cut
), docs AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 THEN
           list_transform(range(0, n), lambda i: CASE WHEN i < a THEN w[i + 1]
             ELSE w[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] END) ELSE w END AS w
  FROM placed
), pieces AS (
  SELECT doc_id, pos, array_to_string(w[pos + 1 : pos + 6], ' ') AS piece
  FROM (SELECT doc_id, w, unnest(range(0, n - 5)) AS pos FROM docs)
), pairs AS (
  SELECT a.doc_id, a.pos, b.pos - a.pos AS period
  FROM pieces a JOIN pieces b ON a.doc_id = b.doc_id AND a.piece = b.piece AND a.pos < b.pos
), spans AS (
  SELECT doc_id, period, min(pos) AS start, max(pos) - min(pos) + 6 + period AS length
  FROM (SELECT *, pos - row_number() OVER (PARTITION BY doc_id, period ORDER BY pos) AS island FROM pairs)
  GROUP BY doc_id, period, island
), runs AS (
  SELECT doc_id, start, length, min(period) AS period FROM spans
  WHERE length >= greatest(12, 2 * period) GROUP BY doc_id, start, length
), by_doc AS (
  SELECT doc_id, count(*) AS n_runs, arg_min(struct_pack(start, length, period), (-length, start, period)) AS best,
         string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY doc_id
), gone AS (
  SELECT DISTINCT doc_id, pos FROM (SELECT doc_id, unnest(range(start + period, start + length)) AS pos FROM runs)
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS words
  FROM (SELECT doc_id, generate_subscripts(w, 1) - 1 AS pos, unnest(w) AS word FROM docs) ANTI JOIN gone USING (doc_id, pos)
  GROUP BY doc_id
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period,
       1000 * best.length // best.period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(coalesce(words, '')) AS collapsed_sha256
FROM docs LEFT JOIN by_doc USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def _edited(state: int, after: int, expected: str) -> str:
    """SQL for the best way to handle a row in a grammar state, without inserts; ``rest`` holds the states' ways after it."""

    def stays(cost: int, edit: str, then: int) -> str:
        return f"CASE WHEN NOT must_go THEN {{c: {cost} + 5 * cut + rest[{then + 1}].c, a: '{edit}' || rest[{then + 1}].a}} END"

    ways = [f"{{c: 2 + rest[{state + 1}].c, a: 'D' || rest[{state + 1}].a}}", stays(1, "R", after)]
    ways.append(f"CASE WHEN i = '{expected}' THEN {stays(0, 'K', after)} END")
    if state == 0:
        ways.append(f"CASE WHEN i = 's' THEN {stays(0, 'K', 1)} END")
    return f"list_min([{', '.join(ways)}])"


def _inserted(first: int, second: int, third: int) -> str:
    one, two = (f"{{c: {5 * k} + f[{s + 1}].c, a: '{'I' * k}' || f[{s + 1}].a}}" for k, s in ((1, second), (2, third)))
    return f"list_min([f[{first + 1}], {one}, {two}])"


# A letter at a time from the end, with the best (cost, edits) of each of the four grammar states.
SQL["op12_conversation_repair"] = rf"""
WITH RECURSIVE numbered AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32_of_id("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS fault
  FROM conversations
), turns AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role, unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS again,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM numbered WHERE fault <> 0
), placed AS (
  SELECT *, row_number() OVER w AS pos, lag(role[1]) OVER w AS before,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, again) > 1 AS seen
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text), again)
), judged AS (
  SELECT *, role[1] AS i, NOT regexp_matches(text, '{WORD}') AS blank,
         seen AND regexp_matches(text, '{WORD}') AS duplicate,
         regexp_matches(text, '{WORD}') AND NOT seen
           AND NOT regexp_matches(text, '[.!?][ 	-
]*\z') AS truncated
  FROM placed
), lengths AS (
  SELECT conv_id, coalesce(max(pos), 0) AS n,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
         count(*) FILTER (before || i NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN judged j USING (conv_id) GROUP BY conv_id
), letters AS (
  SELECT conv_id, pos, i, blank OR duplicate AS must_go, truncated::INT AS cut FROM judged
), best(conv_id, pos, rest) AS (
  SELECT conv_id, n + 1, [{{c: 0, a: ''}}, {{c: 10, a: 'II'}}, {{c: 5, a: 'I'}}, {{c: 0, a: ''}}] FROM lengths
  UNION ALL
  SELECT conv_id, pos, [{_inserted(0, 2, 3)}, {_inserted(1, 2, 3)}, {_inserted(2, 3, 2)}, {_inserted(3, 2, 3)}]
  FROM (
    SELECT l.conv_id, l.pos, [{_edited(0, 2, "u")}, {_edited(1, 2, "u")}, {_edited(2, 3, "a")}, {_edited(3, 2, "u")}] AS f
    FROM best b JOIN letters l ON l.conv_id IS NOT DISTINCT FROM b.conv_id AND l.pos = b.pos - 1
  )
), found AS (
  SELECT conv_id, rest[1].c AS cost, rest[1].a AS audit FROM best WHERE pos = 1
), steps AS (
  SELECT conv_id, generate_subscripts(edits, 1) AS k, unnest(edits) AS edit
  FROM (SELECT conv_id, string_split(audit, '') AS edits FROM found WHERE audit <> '')
), aligned AS (
  SELECT *, sum((edit <> 'I')::INT) OVER w AS pos, sum((edit <> 'D')::INT) OVER w AS made
  FROM steps WINDOW w AS (PARTITION BY conv_id ORDER BY k)
), outputs AS (
  SELECT a.conv_id, a.k, a.edit, a.made, j.role, j.text,
         max((a.edit = 'K' AND a.made = 1 AND j.i = 's')::INT) OVER (PARTITION BY a.conv_id) AS system
  FROM aligned a JOIN judged j ON j.conv_id IS NOT DISTINCT FROM a.conv_id AND j.pos = greatest(a.pos, 1) WHERE a.edit <> 'D'
), joined AS (
  SELECT conv_id, string_agg(
           CASE WHEN edit = 'K' THEN role WHEN (made - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
           CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS rows
  FROM outputs GROUP BY conv_id
)
SELECT l.conv_id, gaps, blank, duplicate, truncated, illegal, cost::BIGINT AS cost, audit, sha256(coalesce(rows, '')) AS repaired_sha256
FROM lengths l JOIN found f ON f.conv_id IS NOT DISTINCT FROM l.conv_id
LEFT JOIN joined j ON j.conv_id IS NOT DISTINCT FROM l.conv_id
"""

# The checksum goes by 64 bytes at a time: a fixed start that brings the register to all ones, zeros before it, then
# the bytes; the register moves over 64 bytes by a table for each of its own bytes.
SQL["op11_sharding"] = """
WITH RECURSIVE byte_table AS (
  SELECT list(list_reduce([n, -1, -1, -1, -1, -1, -1, -1, -1], lambda x, y: xor(x >> 1, 3988292384 * (x & 1))) ORDER BY n) AS tab
  FROM range(256) r(n)
), far_table AS (
  SELECT list(list_reduce(list_prepend(b << (8 * k), list_transform(range(64), lambda z: 0::BIGINT)),
                          lambda x, y: xor(x >> 8, tab[(x & 255) + 1])) ORDER BY k, b) AS far
  FROM range(4) k(k), range(256) b(b), byte_table
), texts AS (
  SELECT doc_id, coalesce(text, '') AS text, strlen(coalesce(text, '')) + 16 AS size,
         substr(md5(coalesce(text, '')), 1, 16) || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 16) AS place
  FROM documents
), hexes AS (
  SELECT doc_id, repeat('0', (128 - (length(h) % 128)) % 128) || h AS h
  FROM (SELECT doc_id, '62F52692' || hex(encode(text)) AS h FROM texts)
), chunks AS (
  SELECT doc_id, k, substr(h, k * 128 + 1, 128) AS h FROM (SELECT doc_id, h, unnest(range(length(h) // 128)) AS k FROM hexes)
), registers AS (
  SELECT doc_id, k, list_reduce(list_prepend(0::BIGINT, list_transform(range(1, 128, 2), lambda i:
           ((strpos('0123456789ABCDEF', h[i]) - 1) * 16 + strpos('0123456789ABCDEF', h[i + 1]) - 1)::BIGINT)),
           lambda x, y: xor(x >> 8, tab[xor(x & 255, y) + 1])) AS c
  FROM chunks, byte_table
), sums AS (
  SELECT doc_id, xor(4294967295, list_reduce(list_prepend(0::BIGINT, cs), lambda x, y:
           xor(y, xor(xor(far[(x & 255) + 1], far[((x >> 8) & 255) + 257]),
                      xor(far[((x >> 16) & 255) + 513], far[((x >> 24) & 255) + 769]))))) AS crc
  FROM (SELECT doc_id, list(c ORDER BY k) AS cs FROM registers GROUP BY doc_id), far_table
), level AS (
  SELECT l, substr(place, 1, 2 * l) AS prefix, sum(size) AS size FROM texts, range(1, 17) r(l) GROUP BY ALL
), cells AS (
  SELECT *, sum(size) OVER (PARTITION BY l ORDER BY prefix) - size AS below FROM level
), edges AS (
  SELECT l, prefix, below FROM cells
  UNION ALL
  SELECT l, max(prefix) || 'g', max(below + size) FROM cells GROUP BY l
), misses AS (
  SELECT k, l, min(abs(below * 40 - k * total)) AS miss, arg_min(prefix, (abs(below * 40 - k * total), below, prefix)) AS prefix, any_value(total) AS total
  FROM edges, range(1, 40) r(k), (SELECT sum(size) AS total FROM texts) GROUP BY k, l
), bounds AS (
  SELECT k, arg_min(prefix, l) AS bound FROM misses WHERE miss * 100 <= total OR l = 16 GROUP BY k
), dealt AS (
  SELECT doc_id, size, place, (SELECT count(*) FROM bounds WHERE bound <= place)::INTEGER AS shard FROM texts
)
SELECT doc_id, size, crc AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY place) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM dealt JOIN sums USING (doc_id)
"""
