"""Buy/sell pressure and large-trade analytics per tumbling window.

* side: is_buyer_maker = true is a market sell, else a buy
* large trade: notional strictly above the threshold (default 10000)
* buy_volume_ratio HALF_UP(buy/total, 4), 0.5 when total = 0
* average_trade_size HALF_UP(total/trades, 8), 0 when no trades
* large_trade_volume_ratio HALF_UP(large/total, 4), 0 when total = 0
* volume_trend BULLISH if ratio > 0.6, BEARISH if ratio < 0.4, else NEUTRAL
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.functions.numeric import halfup_div_sql
from candela.operators.partials import (
    LARGE_TRADE_THRESHOLD,
    interval_label,
    rollup_many,
    trade_partials,
)
from candela.schemas import VOLUME_COLUMNS, VOLUME_INTERVALS

# Fixed values of the reference: ratio default 0.5 when there is no volume,
# trend cut-offs 0.6 (BULLISH, strict >) and 0.4 (BEARISH, strict <).
NO_VOLUME_RATIO = "0.5"
BULLISH_ABOVE = "0.6"
BEARISH_BELOW = "0.4"


def volume_trend(ratio: F.Column) -> F.Column:
    return (
        F.when(ratio > F.lit(BULLISH_ABOVE).cast("decimal(38,4)"), F.lit("BULLISH"))
        .when(ratio < F.lit(BEARISH_BELOW).cast("decimal(38,4)"), F.lit("BEARISH"))
        .otherwise(F.lit("NEUTRAL"))
    )


def volume_columns(partials: DataFrame) -> list[F.Column]:
    """Volume-analytics measures over trade partials (without symbol / interval / window)."""
    total = F.col("volume")
    ratio = F.expr(
        f"CASE WHEN volume > 0 THEN {halfup_div_sql('buy_volume', 'volume', 4, 16, 16)} "
        f"ELSE CAST('{NO_VOLUME_RATIO}' AS DECIMAL(38,4)) END"
    )
    del partials
    return [
        total.alias("total_volume"),
        F.col("buy_volume"), F.col("sell_volume"),
        F.col("trade_count").alias("total_trades"),
        F.col("buy_trades"), F.col("sell_trades"), F.col("large_trades"), F.col("large_trade_volume"),
        F.col("large_trade_threshold"),
        ratio.alias("buy_volume_ratio"),
        F.expr(f"CASE WHEN trade_count > 0 THEN {halfup_div_sql('volume', 'trade_count', 8, 16, 0)} "
               "ELSE CAST(0 AS DECIMAL(38,8)) END").alias("average_trade_size"),
        F.expr(f"CASE WHEN volume > 0 THEN {halfup_div_sql('large_trade_volume', 'volume', 4, 16, 16)} "
               "ELSE CAST(0 AS DECIMAL(38,4)) END").alias("large_trade_volume_ratio"),
    ]


def finish_volume(partials: DataFrame, label: str | None = None) -> DataFrame:
    label_col = F.lit(label) if label else F.col("_interval")
    out = partials.select(
        "symbol", label_col.alias("interval"), "window_start", "window_end", *volume_columns(partials)
    )
    return out.withColumn("volume_trend", volume_trend(F.col("buy_volume_ratio"))).select(*VOLUME_COLUMNS)


def volume_analytics(
    trades: DataFrame,
    interval: str = "1 minute",
    label: str | None = None,
    time_col: str = "trade_time",
    large_threshold: str = LARGE_TRADE_THRESHOLD,
) -> DataFrame:
    p = trade_partials(trades, interval, time_col=time_col, large_threshold=large_threshold)
    return finish_volume(p, label or interval_label(interval))


def volume_multi(
    trades: DataFrame,
    intervals: list[tuple[str, str]] = VOLUME_INTERVALS,
    method: str = "rollup",
    time_col: str = "trade_time",
    large_threshold: str = LARGE_TRADE_THRESHOLD,
) -> DataFrame:
    if method == "direct":
        parts = [volume_analytics(trades, iv, lab, time_col, large_threshold) for lab, iv in intervals]
    else:
        base = trade_partials(trades, intervals[0][1], time_col=time_col, large_threshold=large_threshold)
        return finish_volume(rollup_many(base, intervals))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
