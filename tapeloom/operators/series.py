"""Per-symbol time series: changes, deciles, targets, fills, splits, windows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.functions.numeric import finite, guarded_pct, guarded_ratio
from tapeloom.operators.timeline import SEGMENT, Timeline
from tapeloom.session import staged

SYMBOL, DATE = "stock_symbol", "date"
ALPHA = math.exp(-0.03)
NEUTRAL = 3.0
LOOKBACK, HORIZON, TRAIN_SHARE = 50, 3, 0.8


def price_timeline(df: DataFrame, position: str = "pos", total: str | None = None) -> Timeline:
    return Timeline.by_date(df, (SYMBOL,), DATE).annotate(position=position, total=total)


def price_changes(df: DataFrame) -> DataFrame:
    """Volume and open/close changes between the neighbours of each bar."""

    def changes(window) -> dict[str, Column]:
        lag_volume, lag_close = F.lag("volume").over(window), F.lag("close").over(window)
        delta = F.lead("volume").over(window) - lag_volume
        gap = F.lead("open").over(window) - lag_close
        return {
            "volume_delta": delta,
            "volume_change_ratio": guarded_ratio(delta, lag_volume),
            "open_lead_close_lag_diff": gap,
            "open_lead_close_lag_change_pct": guarded_pct(gap, lag_close),
        }

    return price_timeline(df).around(1, 1, changes).drop("pos")


def ntile_column(position: Column, total: Column, n: int) -> Column:
    """The 1-based tile of a 0-based position; the first tiles take the remainder."""
    size, extra = F.floor(total / n), total % n
    wide = extra * (size + 1)
    return (
        F.when(position < wide, F.floor(position / (size + 1)))
        .otherwise(extra + F.floor((position - wide) / F.nullif(size, F.lit(0))))
        .cast("int")
        + 1
    )


def tiles(
    df: DataFrame, metrics: dict[str, str], n: int = 10, group: Sequence[str] = (SYMBOL,), tie: Sequence[str] = (DATE,)
) -> DataFrame:
    """``NTILE(n)`` by several metrics at once: the key columns and one tile per metric (metric -> name).

    Rows become narrow (key, metric, value) rows, which are stored, since they are read for the bounds and for the
    ranks. The bounds come from one sketch and are shared by all groups; a value that several bounds fall on is cut
    by the tie as well, so neither a hot group nor a hot value is one task. Group and tie identify a row.
    """
    keys = list(dict.fromkeys([*group, *tie]))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [k / parts for k in range(1, parts)] or [0.5]
    rows = staged(df.select(*keys, *[F.col(m).cast("double").alias(m) for m in metrics]), "ranked")

    kind = dict(rows.dtypes)[tie[0]]
    number = F.unix_date(tie[0]) if kind == "date" else F.col(tie[0])
    cut_by_tie = kind in ("date", "int", "bigint", "double", "float")
    values = {m: F.col(m) for m in metrics} | ({"_tie": number.cast("double")} if cut_by_tie else {})
    marks = [F.percentile_approx(v, shares, 20 * parts).alias(name) for name, v in values.items()]
    fit = rows.agg(*marks).first().asDict()
    found = {name: [b for b in fit[name] or [] if abs(b) != float("inf")] for name in values}

    def bucket(table: DataFrame, column: str, bounds: Sequence[float]) -> DataFrame:
        splits = [-float("inf"), *(sorted(set(bounds)) or [0.0]), float("inf")]
        cut = Bucketizer(splits=splits, inputCol=column, outputCol=f"{column}_cut", handleInvalid="keep")
        return cut.transform(table)

    if cut_by_tie:
        rows = bucket(rows.withColumn("_tie", F.coalesce(number.cast("double"), F.lit(-1.7e308))), "_tie", found["_tie"])
    entries, wide = [], F.lit(float(parts + 1))
    for k, m in enumerate(metrics):
        rows = bucket(rows, m, found[m])
        hot = sorted({b for b in found[m] if found[m].count(b) > 1})
        inside = F.when(F.col(m).isin(hot), F.col("_tie_cut")).otherwise(wide) if hot and cut_by_tie else wide
        segment = (F.col(f"{m}_cut") * (wide + 1) + inside).cast("long")
        entries.append(F.struct(F.lit(k).alias("metric"), F.col(m).alias("value"), segment.alias("segment")))
    narrow = rows.select(*keys, F.explode(F.array(*entries)).alias("_e"))
    narrow = narrow.select(*keys, F.col("_e.metric").alias("_metric"), F.col("_e.value").alias("_value"), F.col("_e.segment").alias(SEGMENT))
    order = ("_value", *[c for c in tie if c not in group])
    ranked = Timeline(narrow, (*group, "_metric"), order).annotate(position="_pos", total="_total").result()
    tile = ntile_column(F.col("_pos"), F.col("_total"), n)
    picked = [F.max(F.when(F.col("_metric") == k, tile)).alias(out) for k, out in enumerate(metrics.values())]
    return ranked.groupBy(*keys).agg(*picked)


def ntile(
    df: DataFrame, metric: str, out: str, n: int = 10, group: Sequence[str] = (SYMBOL,), tie: Sequence[str] = (DATE,)
) -> DataFrame:
    """``NTILE(n)`` by a metric: the key columns (group and tie) and the tile."""
    return tiles(df, {metric: out}, n, group, tie)


DECILES = {
    "volume_delta": "volume_delta_decile_bucket",
    "volume_change_ratio": "volume_change_ratio_decile_bucket",
}


def decile_buckets(df: DataFrame, group: Sequence[str] = (SYMBOL,)) -> DataFrame:
    """Deciles of both volume changes over the bars that have them: symbol, date and the two tiles."""
    known = df.where(F.col("volume_delta").isNotNull() & F.col("volume_change_ratio").isNotNull())
    return tiles(known, DECILES, 10, group, (DATE,) if group else (DATE, SYMBOL))


def return_target(df: DataFrame) -> DataFrame:
    """(next open - previous close) / previous close, nearest known values used."""
    rows = Timeline.by_date(df, (SYMBOL,), DATE).annotate(
        previous={"close_t_minus_1": F.col("close")}, following={"open_t_plus_1": F.col("open")}
    )
    before, after = F.col("close_t_minus_1"), F.col("open_t_plus_1")
    y = finite(guarded_ratio(after - before, before))
    return (
        rows.result()
        .select(DATE, SYMBOL, "close_t_minus_1", "open_t_plus_1", y.alias("y"))
        .dropna()
    )


def ffill(df: DataFrame, columns: Sequence[str], fill: dict[str, Column] | None = None) -> DataFrame:
    """Carry the last known value forward per symbol, then a constant."""
    fill = fill or {}
    rows = Timeline.by_date(df, (SYMBOL,), DATE).annotate(last={c: F.col(c) for c in columns})
    constants = {c: F.coalesce(F.col(c), value) for c, value in fill.items()}
    return rows.result().withColumns(constants) if constants else rows.result()


def ffill_key(df: DataFrame, present: Column, out: str) -> DataFrame:
    """The latest date, up to each row, on which ``present`` held.

    Carrying the date and joining the payload once is lighter than carrying
    vectors or texts through a window.
    """
    seen = F.when(present, F.col(DATE))
    return Timeline.by_date(df, (SYMBOL,), DATE).annotate(last={out: seen}).result()


def decay_impute(
    df: DataFrame, value: str, out: str, alpha: float = ALPHA, neutral: float = NEUTRAL
) -> DataFrame:
    """Known value, or a decay towards neutral: neutral + alpha^k·(last - neutral).

    ``k`` counts rows since the last known value, so the recursion of the test
    part continues from the train part by itself.
    """
    rows = Timeline.by_date(df, (SYMBOL,), DATE).annotate(position="_pos")
    known = F.when(F.col(value).isNotNull(), F.struct(F.col("_pos").alias("at"), F.col(value).alias("v")))
    rows = rows.annotate(last={"_known": known})
    steps = F.col("_pos") - F.col("_known.at")
    faded = F.lit(neutral) + F.pow(F.lit(alpha), steps) * (F.col("_known.v") - F.lit(neutral))
    return (
        rows.result()
        .withColumn(out, F.coalesce(F.col(value), faded, F.lit(neutral)))
        .drop("_pos", "_known")
    )


def horizon_label(df: DataFrame, horizon: int = HORIZON, column: str = "close", out: str = "label") -> DataFrame:
    """The value ``horizon`` rows ahead; rows without one are dropped."""
    moved = price_timeline(df).around(
        0, horizon, lambda w: {out: F.lead(column, horizon).over(w)}
    )
    return moved.drop("pos").where(F.col(out).isNotNull())


def min_length_filter(df: DataFrame, min_rows: int = LOOKBACK + HORIZON + 1) -> DataFrame:
    """Rows of symbols with at least ``min_rows`` rows."""
    rows = Timeline.by_date(df, (SYMBOL,), DATE).annotate(total="_total")
    return rows.result().where(F.col("_total") >= min_rows).drop("_total")


def split_point(total: Column, share: float = TRAIN_SHARE) -> Column:
    return F.floor(total * F.lit(float(share)))


def chrono_split(df: DataFrame, share: float = TRAIN_SHARE) -> Timeline:
    """Per symbol, the first ``int(n·share)`` rows are ``train``, the rest ``test``.

    Adds ``pos`` (row number in the symbol) and ``split``; stays a Timeline.
    """
    rows = price_timeline(df, total="_total")
    train = F.col("pos") < split_point(F.col("_total"), share)
    rows = rows.with_columns({"split": F.when(train, "train").otherwise("test")})
    return Timeline(rows.df.drop("_total"), rows.group, rows.order)


def sequential_split(df: DataFrame, share: float = TRAIN_SHARE, order: Sequence[str] = (SYMBOL, DATE)) -> DataFrame:
    """One split of the whole table at ``int(n·share)`` rows in the given order."""
    rows = Timeline.by_range(df, (), order).annotate(position="row_idx", total="_total")
    train = F.col("row_idx") < split_point(F.col("_total"), share)
    return rows.result().withColumn("split", F.when(train, "train").otherwise("test")).drop("_total")


def minmax_per_symbol(rows: Timeline, columns: Sequence[str], fit_on: str = "train") -> Timeline:
    """Scale by the train range of the symbol; a zero range divides by one."""
    fits = (F.col("split") == "train") if fit_on == "train" else F.lit(True)
    totals = {}
    for c in columns:
        totals[f"{c}_min"] = ("min", F.when(fits, F.col(c)))
        totals[f"{c}_max"] = ("max", F.when(fits, F.col(c)))
    fitted = rows.annotate(totals=totals)
    return fitted.with_columns(
        {f"{c}_scaled": scale(F.col(c), F.col(f"{c}_min"), F.col(f"{c}_max")) for c in columns}
    )


def scale(value: Column, low: Column, high: Column) -> Column:
    return (value - low) / F.when(high == low, F.lit(1.0)).otherwise(high - low)


def inverse_scale(value: Column, low: Column, high: Column) -> Column:
    return value * F.when(high == low, F.lit(1.0)).otherwise(high - low) + low


#: Rows of a block, of which windows are slices.
BLOCK_ROWS = 1024


def sliding_sequences(
    rows: Timeline,
    features: Sequence[str],
    target: str,
    lookback: int = LOOKBACK,
    horizon: int = HORIZON,
    keep: Sequence[str] = (),
    earlier: dict[str, int] | None = None,
) -> DataFrame:
    """Windows of ``lookback`` rows with the target ``horizon`` rows after the last.

    Windows stay inside one (symbol, split); n - lookback - horizon + 1 per part. ``rows`` must carry ``pos`` and
    ``split``. ``keep`` columns come from the last row of the window, ``earlier`` names target values some rows
    before it. ``window`` has one array per feature: rows are gathered once into blocks of arrays, with copies of
    the bordering rows, and a window is a slice of its block. So what belongs to a row (a day's text, say) is put
    to it before, once. Without ``features`` no arrays are built.
    """
    order = [c for c in rows.order if c not in rows.group]
    kept = list(dict.fromkeys([*rows.group, *order, "split", *keep]))
    if not features:
        return window_targets(rows, target, lookback, horizon, kept, earlier or {})
    inner = [c for c in kept if c not in rows.group]
    names = list(dict.fromkeys(["pos", target, *inner]))
    taken = rows.df.select(
        *rows.group, *[F.col(c).alias(f"_c{k}") for k, c in enumerate(names)], *[as_float(rows.df, f).alias(f"_f{k}") for k, f in enumerate(features)]
    )
    pos, places = F.col("_c0"), {c: f"_c{k}" for k, c in enumerate(names)}
    first = F.floor(F.greatest(pos - horizon, F.lit(0)) / BLOCK_ROWS)
    spread = taken.withColumn("_block", F.explode(F.sequence(first, F.floor((pos + lookback - 1) / BLOCK_ROWS))))
    columns = [c for c in taken.columns if c not in rows.group]
    blocks = spread.groupBy(*rows.group, "_block").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("_rows"))
    arrays = blocks.select(*rows.group, "_block", *[F.col(f"_rows.{c}").alias(c) for c in columns])

    offset = F.col("_block") * BLOCK_ROWS - F.col("_c0")[0]  # where the block's own rows start
    own = F.greatest(offset, F.lit(lookback - 1))
    past = F.least(offset + BLOCK_ROWS, F.size("_c0") - horizon)
    ends = F.when(own < past, F.sequence(own.cast("int"), (past - 1).cast("int"))).otherwise(F.array().cast("array<int>"))
    at = F.col("_end")

    def value(column: str, shift: int = 0) -> Column:
        return F.get(places[column], at + shift)

    windows = arrays.withColumn("_end", F.explode(ends)).where(
        (value("split", 1 - lookback) == value("split")) & (value("split", horizon) == value("split")) & value(target, horizon).isNotNull()
    )
    window = F.struct(*[F.slice(f"_f{k}", at - (lookback - 2), F.lit(lookback)).alias(f) for k, f in enumerate(features)])
    return windows.select(
        *rows.group,
        *[value(c).alias(c) for c in inner],
        value("pos").alias("end_pos"),
        value(target, horizon).alias("target"),
        value(target).alias("last_known"),
        *[value(target, -back).alias(name) for name, back in (earlier or {}).items()],
        window.alias("window"),
    )


def window_targets(
    rows: Timeline, target: str, lookback: int, horizon: int, kept: Sequence[str], earlier: dict[str, int]
) -> DataFrame:
    """What ``sliding_sequences`` gives beside the windows."""
    slim = rows.df.select(*dict.fromkeys([*rows.group, *rows.order, SEGMENT, "split", "pos", target, *kept]))

    def cut(window) -> dict[str, Column]:
        columns = {
            "_from": F.lag("split", lookback - 1).over(window),
            "target": F.lead(target, horizon).over(window),
            "_to": F.lead("split", horizon).over(window),
            "last_known": F.col(target),
        }
        return columns | {name: F.lag(target, back).over(window) for name, back in earlier.items()}

    cuts = Timeline(slim, rows.group, rows.order).around(lookback - 1, horizon, cut)
    whole = (
        (F.col("_from") == F.col("split"))
        & (F.col("_to") == F.col("split"))
        & F.col("target").isNotNull()
    )
    return cuts.where(whole).select(*kept, F.col("pos").alias("end_pos"), "target", "last_known", *earlier)


def with_daily(rows: DataFrame, daily: DataFrame, day: str, columns: Sequence[str], fill: dict[str, Column]) -> DataFrame:
    """Rows that carry a ``day``, with that day's ``columns``: what is long meets each row once, before any window.

    ``daily`` has one row per (symbol, ``day``); rows without one get ``fill``, and take no part in the join.
    """
    found = rows.where(F.col(day).isNotNull()).join(daily.select(SYMBOL, day, *columns), [SYMBOL, day], "left")
    without = rows.where(F.col(day).isNull()).withColumns({c: fill[c] for c in columns})
    filled = found.withColumns({c: F.coalesce(F.col(c), fill[c]) for c in columns})
    return filled.unionByName(without.select(*filled.columns))


def as_float(df: DataFrame, name: str) -> Column:
    """Numbers as float32 under their own name; texts, arrays and dates as they are."""
    value = F.col(name)
    return value if dict(df.dtypes)[name].startswith(("array", "date", "string")) else value.cast("float").alias(name)


def long_enough_parts(rows: Timeline, lookback: int = LOOKBACK, horizon: int = HORIZON) -> Timeline:
    """Without the symbols of which the train or the test part has at most ``lookback + horizon`` rows."""
    sizes = rows.annotate(
        totals={
            "_train": ("sum", F.when(F.col("split") == "train", 1).otherwise(0)),
            "_test": ("sum", F.when(F.col("split") == "test", 1).otherwise(0)),
        }
    )
    kept = sizes.df.where(F.least("_train", "_test") > lookback + horizon).drop("_train", "_test")
    return Timeline(kept, rows.group, rows.order)


def symbol_index(df: DataFrame) -> DataFrame:
    """0-based number of each symbol in sorted order, one row per symbol."""
    symbols = df.select(SYMBOL).distinct()
    numbered = Timeline.by_range(symbols, (), (SYMBOL,)).annotate(position="symbol_idx")
    return numbered.result()


def sample_index(windows: DataFrame, order: Sequence[str] = (SYMBOL, "end_pos")) -> DataFrame:
    """Global sample number and the number inside its symbol."""
    rows = Timeline.by_range(windows, (), order).annotate(position="sample_id")
    within = Timeline(rows.df, (SYMBOL,), rows.order).annotate(position="offset")
    return within.result()
