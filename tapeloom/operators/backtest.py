"""Back-tests on predictions: compare each prediction with the one made H rows before."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.operators.series import DATE, HORIZON, SYMBOL
from tapeloom.operators.timeline import Timeline


def prediction_timeline(df: DataFrame, scope: str = "global") -> Timeline:
    """``global`` numbers all samples in (symbol, date) order, so that the shift
    crosses symbol borders; ``symbol`` keeps every symbol apart."""
    if scope == "global":
        return Timeline.by_range(df, (), (SYMBOL, DATE)).annotate(position="pos")
    if scope == "symbol":
        return Timeline.by_date(df, (SYMBOL,), DATE).annotate(position="pos")
    raise ValueError(f"scope must be 'global' or 'symbol', not {scope!r}")


def backtest(
    df: DataFrame,
    horizon: int = HORIZON,
    scope: str = "global",
    long_only: bool = False,
    moves: str = "sign",
    risk_free: float = 0.0,
) -> DataFrame:
    """Per sample: signal, market and strategy result. The first ``horizon`` samples drop out.

    ``df`` has stock_symbol, date, prediction, target, last_known.
    ``moves='sign'`` counts directions, ``'raw'`` price differences.
    """
    rows = prediction_timeline(df, scope)
    shifted = rows.around(
        horizon, 0, lambda w: {"earlier": F.lag("prediction", horizon).over(w)}
    ).where(F.col("pos") >= horizon)
    raw_move = F.col("target") - F.col("last_known")
    move = F.signum(raw_move) if moves == "sign" else raw_move
    signal = F.signum(F.col("prediction") - F.col("earlier"))
    if long_only:
        signal = F.when(signal < 0, F.lit(0.0)).otherwise(signal)
    traded = shifted.withColumns({"signal": signal, "market_pnl": move})
    earned = F.col("signal") * F.col("market_pnl")
    if long_only:
        earned = F.when(F.col("signal") == 0, F.lit(float(risk_free))).otherwise(earned)
    return traded.withColumn("strategy_pnl", earned).drop("earlier")


def backtest_summary(results: DataFrame, long_only: bool = False) -> DataFrame:
    """Totals and the share of right directions (of active signals if long only)."""
    hit = (F.col("signal") == F.signum("market_pnl")).cast("double")
    if long_only:
        hit = F.when(F.col("signal") != 0, hit)
    return results.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("market_pnl").alias("market_total"),
        F.sum("strategy_pnl").alias("strategy_total"),
        F.coalesce(F.avg(hit), F.lit(0.0)).alias("accuracy"),
    )


def cumulative_pnl(results: DataFrame) -> DataFrame:
    """Running sums of market and strategy results in (symbol, date) order."""
    rows = Timeline.by_range(results, (), (SYMBOL, DATE)).annotate(
        running={"market_cum": F.col("market_pnl"), "strategy_cum": F.col("strategy_pnl")}
    )
    return rows.result()
