"""OHLCV bars over tumbling windows.

Semantics of each measure, per (symbol, window), trades ordered by
(trade_time, trade_id):

* open   first non-zero price (the reference re-takes open while it is 0); 0 if none
* close  last price
* high   max(0, prices); low min(999999999, prices)
* volume sum of price*quantity (quote notional); trade_count
* mean_notional HALF_UP(volume / trade_count, 8)   (the reference's "vwap" field)
* vwap   HALF_UP(volume / sum(quantity), 8), NULL when sum(quantity) = 0
* price_change close - open; price_change_pct 0 if open = 0 else HALF_UP(change/open, 4) * 100
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.functions.numeric import dec_lit_sql, from_units_sql, halfup_div_sql, halfup_units_sql, units_sql
from candela.operators.partials import interval_label, rollup_many, trade_partials
from candela.schemas import BAR_COLUMNS, PRICE_INTERVALS


def price_change_pct_units_sql(close: str = "close", open_: str = "open") -> str:
    """priceChangePercent in 1e-4 units: HALF_UP((close-open)/open, 4) * 100; 0 when open = 0."""
    q = halfup_units_sql(units_sql(f"{close} - {open_}", 8), units_sql(open_, 8), 4)
    return f"CASE WHEN {open_} = 0 THEN {dec_lit_sql(0)} ELSE CAST({q} * {dec_lit_sql(100)} AS DECIMAL(38,0)) END"


def price_change_pct_units(close: str = "close", open_: str = "open") -> F.Column:
    return F.expr(price_change_pct_units_sql(close, open_))


def bar_columns(partials: DataFrame) -> list[F.Column]:
    """Bar measures over trade partials (without symbol / interval / window)."""
    del partials
    return [
        F.col("open"), F.col("high"), F.col("low"), F.col("close"), F.col("volume"), F.col("trade_count"),
        F.expr(halfup_div_sql("volume", "trade_count", 8, 16, 0)).alias("mean_notional"),
        F.expr(f"CASE WHEN base_volume > 0 THEN {halfup_div_sql('volume', 'base_volume', 8, 16, 8)} END").alias("vwap"),
        F.expr("close - open").alias("price_change"),
        F.expr(from_units_sql(price_change_pct_units_sql(), 4)).alias("price_change_pct"),
        F.col("base_volume"),
    ]


def finish_bars(partials: DataFrame, label: str | None = None) -> DataFrame:
    label_col = F.lit(label) if label else F.col("_interval")
    out = partials.select(
        "symbol", label_col.alias("interval"), "window_start", "window_end", *bar_columns(partials)
    )
    return out.select(*BAR_COLUMNS, "base_volume")


def bars(
    trades: DataFrame,
    interval: str = "1 minute",
    label: str | None = None,
    time_col: str = "trade_time",
    order_key: str | None = None,
) -> DataFrame:
    """Final bars for one window length, computed directly from trades."""
    p = trade_partials(trades, interval, time_col=time_col, order_key=order_key)
    return finish_bars(p, label or interval_label(interval))


def bars_multi(
    trades: DataFrame,
    intervals: list[tuple[str, str]] = PRICE_INTERVALS,
    method: str = "rollup",
    time_col: str = "trade_time",
    order_key: str | None = None,
) -> DataFrame:
    """Bars for several window lengths, one ``interval`` column.

    ``method="rollup"`` aggregates trades once at the finest window, then expands
    each fine partial to every target window and rolls all levels up in a single
    aggregation (one shuffle of trades, one of partials); ``"direct"`` aggregates
    trades once per window length (the reference's topology).
    """
    if method == "direct":
        parts = [bars(trades, iv, lab, time_col, order_key) for lab, iv in intervals]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
    base = trade_partials(trades, intervals[0][1], time_col=time_col, order_key=order_key)
    return finish_bars(rollup_many(base, intervals))


def market_bars(
    trades: DataFrame,
    interval: str = "1 minute",
    label: str | None = None,
    time_col: str = "trade_time",
    order_key: str | None = None,
) -> DataFrame:
    """Bar and volume-analytics columns of the same (symbol, window) in one row, one aggregation."""
    from candela.operators.volume import volume_columns, volume_trend

    p = trade_partials(trades, interval, time_col=time_col, order_key=order_key)
    out = p.select(
        "symbol", F.lit(label or interval_label(interval)).alias("interval"), "window_start", "window_end",
        *bar_columns(p), *volume_columns(p),
    )
    return out.withColumn("volume_trend", volume_trend(F.col("buy_volume_ratio")))


def bar_change(bars_df: DataFrame) -> DataFrame:
    """P4/P5 as standalone projections over any bar table."""
    return bars_df.select(
        "symbol", "interval", "window_start", "open", "close",
        F.expr("close - open").alias("price_change"),
        F.expr(from_units_sql(price_change_pct_units_sql(), 4)).alias("price_change_pct"),
    )
