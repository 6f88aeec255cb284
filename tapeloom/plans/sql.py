"""Shared WITH parts of the check SQL."""

from __future__ import annotations

SYMBOL_LIST = "['1-urgent', '2-high', '3-medium', '4-not specified', '5-low']"

PARTS = {
    "prices": """
SELECT lower(o_orderpriority) AS stock_symbol, CAST(o_orderdate AS DATE) AS date,
       arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high, min(o_totalprice) AS low,
       arg_max(o_totalprice, o_orderkey) AS close, arg_max(o_totalprice, o_orderkey) AS adj_close,
       CAST(sum(o_orderkey % 1000 + 1) AS DOUBLE) AS volume
FROM orders GROUP BY 1, 2""",
    "news": f"""
SELECT doc_id AS id,
       CASE WHEN doc_id % 97 = 0 THEN 'unknown'
            ELSE CAST(DATE '1995-01-01' + CAST(doc_id % 50 * 45 AS INTEGER) AS VARCHAR) || ' 00:00:00 UTC' END AS date,
       text AS article_title, {SYMBOL_LIST}[CAST(doc_id // 50 % 5 + 1 AS INTEGER)] AS stock_symbol,
       source AS publisher, text AS lsa_summary
FROM documents""",
    "dated": """
SELECT id, TRY_CAST(substr(date, 1, 10) AS DATE) AS date, article_title, stock_symbol, publisher, lsa_summary
FROM news WHERE TRY_CAST(substr(date, 1, 10) AS DATE) IS NOT NULL""",
    "vectors": f"""
SELECT vec_id AS id, {SYMBOL_LIST}[CAST(vec_id // 50 % 5 + 1 AS INTEGER)] AS stock_symbol,
       DATE '1995-01-01' + CAST(vec_id % 50 * 45 AS INTEGER) AS date, embedding, label
FROM embeddings""",
    "elements": """
SELECT id, stock_symbol, date, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS place
FROM vectors""",
    "bars": """
SELECT * FROM prices WHERE stock_symbol = '1-urgent'""",
    "changes": """
SELECT *, lead(volume) OVER w - lag(volume) OVER w AS volume_delta,
       (lead(volume) OVER w - lag(volume) OVER w) / nullif(lag(volume) OVER w, 0) AS volume_change_ratio,
       lead(open) OVER w - lag(close) OVER w AS open_lead_close_lag_diff,
       (lead(open) OVER w - lag(close) OVER w) * 100.0::DOUBLE / nullif(lag(close) OVER w, 0)
           AS open_lead_close_lag_change_pct
FROM prices WINDOW w AS (PARTITION BY stock_symbol ORDER BY date)""",
    "deciles": """
SELECT *, CAST(ntile(10) OVER (PARTITION BY stock_symbol ORDER BY volume_delta, date) AS INTEGER)
           AS volume_delta_decile_bucket,
       CAST(ntile(10) OVER (PARTITION BY stock_symbol ORDER BY volume_change_ratio, date) AS INTEGER)
           AS volume_change_ratio_decile_bucket
FROM changes WHERE volume_delta IS NOT NULL AND volume_change_ratio IS NOT NULL""",
    "titles": """
SELECT id, article_title, TRY_CAST(substr(date, 1, 10) AS DATE) AS clean_date FROM news""",
    "title_groups": """
SELECT *, row_number() OVER w AS rn, (row_number() OVER w - 1) // 10 AS article_group FROM titles
WINDOW w AS (PARTITION BY clean_date ORDER BY article_title NULLS LAST, id)""",
    "random_groups": """
SELECT *, row_number() OVER w AS rn, (row_number() OVER w - 1) // 10 AS article_group FROM titles
WINDOW w AS (PARTITION BY clean_date ORDER BY md5(id || ':42'), id)""",
    "title_batches": """
SELECT bar.date, g.article_group, min(bar.volume_change_ratio_decile_bucket) AS volume_change_ratio_decile_bucket,
       min(bar.volume_delta_decile_bucket) AS volume_delta_decile_bucket,
       coalesce(string_agg(g.article_title, '|' ORDER BY g.clean_date NULLS FIRST, g.rn), '') AS aggregated_article_title
FROM title_groups g
LEFT JOIN deciles bar ON bar.date = g.clean_date AND bar.stock_symbol = '1-urgent'
GROUP BY ALL""",
    "gap_batches": """
SELECT bar.date, g.article_group, min(bar.open_lead_close_lag_change_pct) AS open_lead_close_lag_change_pct,
       min(bar.volume_delta_decile_bucket) AS volume_delta_decile_bucket,
       min(bar.volume_change_ratio_decile_bucket) AS volume_change_ratio_decile_bucket,
       coalesce(string_agg(g.article_title, '|' ORDER BY g.rn), '') AS aggregated_article_title
FROM random_groups g JOIN deciles bar ON bar.date = g.clean_date
WHERE bar.stock_symbol = '2-high' GROUP BY ALL""",
    "targets": """
SELECT date, stock_symbol, close_t_minus_1, open_t_plus_1,
       (open_t_plus_1 - close_t_minus_1) / nullif(close_t_minus_1, 0) AS y
FROM (SELECT date, stock_symbol,
             last_value(close IGNORE NULLS) OVER (PARTITION BY stock_symbol ORDER BY date
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS close_t_minus_1,
             first_value(open IGNORE NULLS) OVER (PARTITION BY stock_symbol ORDER BY date
                 ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS open_t_plus_1
      FROM gappy)
WHERE close_t_minus_1 IS NOT NULL AND open_t_plus_1 IS NOT NULL AND close_t_minus_1 <> 0""",
    "gappy": """
SELECT stock_symbol, date, CASE WHEN volume % 13 <> 0 THEN open END AS open,
       CASE WHEN volume % 11 = 0 THEN 0.0::DOUBLE WHEN volume % 7 <> 0 THEN close END AS close
FROM prices""",
    "split_prices": """
SELECT *, CASE WHEN pos < floor(total * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (PARTITION BY stock_symbol ORDER BY date) - 1 AS pos,
             count(*) OVER (PARTITION BY stock_symbol) AS total FROM prices)""",
    "scaled": """
SELECT p.*, f.close_min, f.close_max,
       (open - open_min) / CASE WHEN open_max = open_min THEN 1 ELSE open_max - open_min END AS open_scaled,
       (close - close_min) / CASE WHEN close_max = close_min THEN 1 ELSE close_max - close_min END AS close_scaled,
       (volume - volume_min) / CASE WHEN volume_max = volume_min THEN 1 ELSE volume_max - volume_min END
           AS volume_scaled
FROM split_prices p JOIN (
  SELECT stock_symbol, min(open) AS open_min, max(open) AS open_max, min(close) AS close_min,
         max(close) AS close_max, min(volume) AS volume_min, max(volume) AS volume_max
  FROM split_prices WHERE split = 'train' GROUP BY 1) f USING (stock_symbol)""",
    "samples": """
SELECT * FROM (
  SELECT stock_symbol, date, split, pos AS end_pos, close_min, close_max, close_scaled AS last_known,
         lead(close_scaled, 3) OVER w AS target, lag(close_scaled, 5) OVER w AS prediction,
         row_number() OVER w - 1 AS in_part
  FROM scaled WINDOW w AS (PARTITION BY stock_symbol, split ORDER BY date))
WHERE in_part >= 49 AND target IS NOT NULL AND split = 'test'""",
    "pair_scores": """
SELECT a.id, sqrt(greatest(sum((a.x - b.x) * (a.x - b.x)), 1e-7::DOUBLE)) AS distance,
       CASE WHEN any_value(a.label) = any_value(b.label) THEN 1 ELSE 0 END AS label
FROM elements a JOIN elements b ON b.id = a.id + 1 AND b.place = a.place GROUP BY a.id""",
    "doc_scores": """
SELECT l.doc_id, CAST(d.n_chars AS DOUBLE) AS score, l.quality AS label
FROM labels l JOIN documents d ON l.doc_id = d.doc_id""",
}

NEEDS = {
    "dated": ["news"],
    "elements": ["vectors"],
    "bars": ["prices"],
    "changes": ["prices"],
    "deciles": ["changes"],
    "titles": ["news"],
    "title_groups": ["titles"],
    "random_groups": ["titles"],
    "title_batches": ["title_groups", "deciles"],
    "gap_batches": ["random_groups", "deciles"],
    "gappy": ["prices"],
    "targets": ["gappy"],
    "split_prices": ["prices"],
    "scaled": ["split_prices"],
    "samples": ["scaled"],
    "pair_scores": ["elements"],
}


def check_sql(*needed: str, body: str) -> str:
    """``body`` behind the WITH parts it needs, in order."""
    order: list[str] = []

    def visit(name: str) -> None:
        for before in NEEDS.get(name, []):
            visit(before)
        if name not in order:
            order.append(name)

    for name in needed:
        visit(name)
    parts = ",\n".join(f"{name} AS ({PARTS[name]})" for name in order)
    return f"WITH {parts}\n{body}" if parts else body
