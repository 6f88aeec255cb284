"""URL verdicts by rules and, where no rule fits, by the purity of path templates.

Urls are counted by host and path shape (runs of digits and long hexadecimal words become
placeholders). Each host has a tree of path segments. Level by level from the root, the rare
children of a node with very many become one wildcard, and sorted siblings whose shares of
bad and good urls do not differ by a two-proportion test are merged into one branch, whose
children are then merged in turn. The tree goes on below a branch as long as it has labelled
urls that are not all of it and of one kind, however deep; else what is below the branch is
one wildcard. A path from root to leaf is a template. Its purity is the share of bad among its labelled urls,
smoothed by a prior; templates that are too impure are rejected. Labels are the rules' verdicts
and, if given, a column of the caller's.

All of it is DataFrame operations; beyond the first count it runs on one row per shape.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.llm.runtime import met, quoted, sized, stored

#: Production parameters.
MANY_CHILDREN = 50  # beyond it, children under 1 / MANY_CHILDREN of the urls are one wildcard
CRITICAL = 3.8416  # 1.96 squared: siblings differ at the 5 % level
PRIOR, WEIGHT = 0.1, 5.0  # share of bad urls expected, and how many labels that is worth
REJECT = 0.5

#: Up to so many rules are conditions of the query; more are joined by host and path.
MAX_RULES = 1_000

#: Children from which a branch is joined apart.
HOT_CHILDREN = 100_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: list[str]) -> Column:
    """The longest rule ``host/path`` whose host is the url's or a parent of it and whose path starts the url's."""
    out = F.lit(None).cast("string")
    for rule in sorted(set(rules), key=lambda r: (len(r), r)):
        domain, slash, rest = rule.partition("/")
        fits = (host == domain) | F.endswith(host, F.lit(f".{domain}"))
        out = F.when(fits & F.startswith(path, F.lit(slash + rest)), F.lit(rule)).otherwise(out)
    return out


def with_rule(urls: DataFrame, rules: list[str]) -> DataFrame:
    """``urls`` (host, path, ...) with the ``rule`` that fits, or null.

    Many rules are looked up: each different host and path meets them by every parent of the host and by
    the beginnings of the path that are as long as some rule's.
    """
    if len(rules) <= MAX_RULES:
        return urls.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules))
    cut = [(r.partition("/")[0], "".join(r.partition("/")[1:]), r) for r in sorted(set(rules))]
    table = urls.sparkSession.createDataFrame(cut, "domain string, start string, rule string")
    table = sized(table, len(cut))
    lengths = F.array(*[F.lit(n) for n in sorted({len(start) for _, start, _ in cut})])
    names = F.split("host", "[.]")
    parents = F.transform(F.sequence(F.lit(1), F.size(names)), lambda k: F.array_join(F.slice(names, k, F.size(names)), "."))
    places = stored(urls.select("host", "path").where("host <> ''").distinct(), "places")
    tried = places.select("host", "path", F.explode(parents).alias("domain"))
    fitting = F.filter(lengths, lambda n: n <= F.length("path"))
    tried = tried.select("*", F.explode(fitting).alias("n")).withColumn("start", F.expr("substring(path, 1, n)"))
    found = tried.join(table, ["domain", "start"]).groupBy("host", "path")
    best = found.agg(F.max(F.struct(F.length("rule").alias("n"), "rule"))["rule"].alias("rule"))
    return urls.join(best, ["host", "path"], "left")


def shape(path: Column) -> Column:
    """The path with placeholders for what varies, without empty segments."""
    out = F.regexp_replace(path, "[0-9a-f]{16,}", "{x}")
    out = F.regexp_replace(F.regexp_replace(out, "[0-9]+", "{n}"), "/+", "/")
    return F.regexp_replace(out, "^/|/$", "")


def differ(x: str) -> Column:
    """Whether the share of ``x`` differs between a row and the one before it (b, n; b0, n0)."""
    b, n, b0, n0 = (F.col(c).cast("double") for c in (x, "n", f"{x}0", "n0"))
    gap = b * n0 - b0 * n
    return gap * gap * (n + n0) > F.lit(CRITICAL) * (b + b0) * (n + n0 - b - b0) * n * n0


def next_level(tree: DataFrame, level: int) -> DataFrame:
    """``tree`` (host, parts, n, bad, good, branch) one level deeper: ``next`` is the branch of this level, or null where
    the branch ends here, and ``ends`` what it is then called."""
    above, sums = ["host", "branch"], [F.sum(c).alias(c) for c in ("n", "bad", "good")]
    rows = tree.withColumn("segment", F.coalesce(F.get("parts", F.lit(level - 1)), F.lit("")))
    children = stored(rows.groupBy(*above, "segment").agg(*sums), "children")
    totals = children.groupBy(*above).agg(
        F.sum("n").alias("total"),
        F.count("*").alias("kids"),
        F.max(F.col("segment") != "").alias("deeper"),
        ((F.sum("bad") + F.sum("good") > 0) & (F.sum("bad") < F.sum("n")) & (F.sum("good") < F.sum("n"))).alias("mixed"),
    )
    totals = stored(totals, "totals")
    rare = (F.col("kids") > MANY_CHILDREN) & (F.col("n") * MANY_CHILDREN < F.col("total"))
    kind = F.when(rare, F.lit("*")).otherwise(F.col("segment"))
    placed = met(children, totals, above, F.col("kids"), HOT_CHILDREN).withColumn("kind", kind)
    kinds = placed.groupBy(*above, "kind").agg(
        *sums, F.count("*").alias("held"), F.any_value("deeper").alias("deeper"), F.any_value("mixed").alias("mixed")
    )  # few per node by now
    order = Window.partitionBy(*above).orderBy(F.col("bad") / F.col("n"), F.col("good") / F.col("n"), "kind")
    before = kinds.select("*", *[F.lag(c).over(order).alias(f"{c}0") for c in ("n", "bad", "good")])
    starts = F.when(F.col("n0").isNull() | differ("bad") | differ("good"), 1).otherwise(0)
    run = before.withColumn("run", F.sum(starts).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    same = Window.partitionBy(*above, "run")
    first, size = F.min("kind").over(same), F.count("*").over(same)
    name = F.concat(first, F.when(size > 1, F.lit("+")).otherwise(F.lit("")))
    goes_on = F.col("mixed") & F.col("deeper")
    named = run.select(
        *above,
        "kind",
        "held",
        F.when(goes_on, F.concat("branch", F.when(name != "", F.concat(F.lit("/"), name)).otherwise(F.lit("")))).alias("next"),
        F.concat("branch", F.when(F.col("deeper"), F.lit("/**")).otherwise(F.lit(""))).alias("ends"),
    )
    named = stored(named, "branches")
    kinds_of = placed.select(*above, "segment", "kind")
    where = met(kinds_of, named, [*above, "kind"], F.col("held"), HOT_CHILDREN).select(*above, "segment", "next", "ends")
    return stored(rows.join(where, [*above, "segment"]).drop("segment"), "templates")


def templates(counts: DataFrame) -> DataFrame:
    """Per host and shape: its template with the template's purity.

    ``counts`` has host, shape and the numbers of urls ``n``, ``bad`` and ``good``. One round a level, as deep as the
    longest path below a branch that labels do not decide as a whole.
    """
    tree = counts.select("host", "shape", F.split("shape", "/").alias("parts"), "n", "bad", "good", F.col("host").alias("branch"))
    ended, level = [], 0
    while True:
        level += 1
        deeper = next_level(tree, level)
        ended.append(deeper.where("next IS NULL").select("host", "shape", "bad", "good", F.col("ends").alias("template")))
        tree = deeper.where("next IS NOT NULL").select("host", "shape", "parts", "n", "bad", "good", F.col("next").alias("branch"))
        if not tree.head(1):
            break
    leaves = reduce(DataFrame.unionByName, ended)
    labelled = leaves.groupBy("host", "template").agg(
        F.sum("bad").alias("t_bad"), F.sum("good").alias("t_good"), F.count("*").alias("held")
    )
    purity = (F.col("t_bad") + PRIOR * WEIGHT) / (F.col("t_bad") + F.col("t_good") + WEIGHT)
    labelled = stored(labelled.select("host", "template", "held", purity.alias("badness")), "purities")
    found = met(leaves.select("host", "shape", "template"), labelled, ["host", "template"], F.col("held"), HOT_CHILDREN)
    return found.select("host", "shape", "template", "badness")


def judge_urls(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
    label_col: str | None = None,
) -> DataFrame:
    """Per row: id, host, path, ``rule`` that fits (or null), ``verdict``, ``template`` and ``badness``.

    ``rules`` are (allow or block, ``host/path``). ``label_col`` may name a column with 1 for
    urls known as bad and 0 for good ones. Every row gives one row, also repeated ones and
    those with a null id. A url that is null or without ``://`` has an empty host and path,
    no template and badness ``PRIOR``; it is allowed unless a rule fits. Other columns are not
    looked at.
    """
    verdict_of = dict((r, v) for v, r in rules)
    urls = pages.select(
        F.col(quoted(id_col)).alias("id"),
        host_of(F.col(quoted(url_col))).alias("host"),
        path_of(F.col(quoted(url_col))).alias("path"),
        (F.col(quoted(label_col)).cast("int") if label_col else F.lit(None).cast("int")).alias("label"),
    )
    urls = with_rule(urls, list(verdict_of))
    blocked = F.col("rule").isin([r for r, v in verdict_of.items() if v == "block"])
    urls = urls.select(
        "id",
        "host",
        "path",
        "rule",
        F.when(F.col("rule").isNotNull(), F.when(blocked, "block").otherwise("allow")).alias("ruled"),
        F.when(F.col("rule").isNotNull(), blocked.cast("int")).otherwise(F.col("label")).alias("label"),
        shape(F.col("path")).alias("shape"),
    )
    counts = urls.where("host <> ''").groupBy("host", "shape").agg(
        F.count("*").alias("n"),
        F.count(F.when(F.col("label") == 1, 1)).alias("bad"),
        F.count(F.when(F.col("label") == 0, 1)).alias("good"),
    )
    judged = urls.join(templates(stored(counts, "shapes")), ["host", "shape"], "left")
    badness = F.coalesce("badness", F.lit(PRIOR))
    return judged.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        "rule",
        F.coalesce("ruled", F.when(badness >= REJECT, "block").otherwise("allow")).alias("verdict"),
        "template",
        badness.alias("badness"),
    )
