"""Small tables with what is awkward: nulls, empty and long texts, repeated rows, names that clash."""

CLASHING = "doc long, id long, rest string, digest string, node long, label int, words string, n long, shard int"


def table(spark, rows, id_type="long"):
    """(doc_id, text) rows with further columns whose names the operators use inside."""
    wide = [(i, t, 1, None, "r", "d", 2, 3, "w", 4, 5) for i, t in rows]
    return spark.createDataFrame(wide, f"doc_id {id_type}, text string, {CLASHING}")


def by_id(rows, key="doc_id"):
    out = {}
    for row in rows:
        out.setdefault(row[key], []).append(row)
    return out
