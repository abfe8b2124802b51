"""Per (symbol, tumbling window) trade partials shared by bars and volume analytics.

One ``groupBy(symbol, window)`` computes every additive or order-keyed measure
that bars (A1-A8) and volume analytics (A9-A11) need. Catalyst drops the
aggregates a caller does not select, and the aggregation runs partial (map-side)
then final, so a hot symbol or a hot window is combined before the shuffle.

Coarser windows are rolled up from finer partials (W3): sums add, open is the
first non-zero child open, close the last child close, high/low the extremes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.functions.numeric import UNIT
from candela.functions.timecols import packed_order_key

# Fixed values of the reference aggregators: initial high 0, initial low 999999999,
# large-trade notional threshold 10000 (strict >).
HIGH_FLOOR = "0"
LOW_CEILING = "999999999"
LARGE_TRADE_THRESHOLD = "10000"

_LABELS = {
    "30 seconds": "30s", "1 minute": "1m", "5 minutes": "5m", "15 minutes": "15m",
    "1 hour": "1h", "1 day": "1d",
}


def interval_label(interval: str) -> str:
    return _LABELS.get(interval, interval.replace(" ", ""))


def _dec(value: str, typ: str = "decimal(18,8)") -> Column:
    return F.lit(value).cast(typ)


def with_order_key(trades: DataFrame, time_col: str = "trade_time", order_key: str | None = None) -> DataFrame:
    """Adds ``_ok``: the total order of trades (time, trade_id) packed in one decimal.

    ``order_key`` names an existing sortable column instead (e.g. arrival offset).
    """
    if order_key is not None:
        return trades.withColumn("_ok", F.col(order_key).cast(UNIT))
    ts_type = trades.schema[time_col].dataType
    return trades.withColumn("_ok", packed_order_key(F.col(time_col), ts_type, F.col("trade_id")))


def trade_partials(
    trades: DataFrame,
    interval: str = "1 minute",
    time_col: str = "trade_time",
    order_key: str | None = None,
    large_threshold: str = LARGE_TRADE_THRESHOLD,
    keep_order: bool = False,
) -> DataFrame:
    """One row per (symbol, window). ``keep_order`` adds the order keys of open and close, so that partials of
    parts of one window (micro-batches, ticks) can be merged."""
    t = with_order_key(trades, time_col, order_key)
    t = t.select(
        "symbol", F.window(F.col(time_col), interval).alias("_w"), "price", "quantity", "_ok",
        F.expr("price * quantity").alias("_n"), F.col("is_buyer_maker").alias("_sell"),
    ).select("*", F.expr(f"_n > CAST('{large_threshold}' AS DECIMAL(38,16))").alias("_large"))
    zero = "CAST(0 AS DECIMAL(38,16))"
    aggs = {
        "_open_nz": "min_by(price, CASE WHEN price <> 0 THEN _ok END)",
        "close": "max_by(price, _ok)",
        "_first_ok": "min(CASE WHEN price <> 0 THEN _ok END)",
        "_last_ok": "max(_ok)",
        "_max": "max(price)",
        "_min": "min(price)",
        "volume": "sum(_n)",
        "base_volume": "sum(quantity)",
        "trade_count": "count(1)",
        "buy_volume": f"coalesce(sum(CASE WHEN NOT _sell THEN _n END), {zero})",
        "sell_volume": f"coalesce(sum(CASE WHEN _sell THEN _n END), {zero})",
        "buy_trades": "count_if(NOT _sell)",
        "sell_trades": "count_if(_sell)",
        "large_trades": "count_if(_large)",
        "large_trade_volume": f"coalesce(sum(CASE WHEN _large THEN _n END), {zero})",
    }
    return (
        t.groupBy("symbol", "_w")
        .agg(*[F.expr(e).alias(n) for n, e in aggs.items()])
        .select(
            "symbol",
            F.lit(interval).alias("_interval"),
            F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"),
            F.expr("coalesce(_open_nz, CAST(0 AS DECIMAL(18,8)))").alias("open"),
            F.expr(f"greatest(_max, CAST('{HIGH_FLOOR}' AS DECIMAL(18,8)))").alias("high"),
            F.expr(f"least(_min, CAST('{LOW_CEILING}' AS DECIMAL(18,8)))").alias("low"),
            "close", "volume",
            F.expr("CAST(base_volume AS DECIMAL(38,8))").alias("base_volume"),
            "trade_count", "buy_volume", "sell_volume",
            "buy_trades", "sell_trades", "large_trades", "large_trade_volume",
            F.expr(f"CAST('{large_threshold}' AS DECIMAL(38,8))").alias("large_trade_threshold"),
            *(["_first_ok", "_last_ok"] if keep_order else []),
        )
    )


def merge_partials(partials: DataFrame) -> DataFrame:
    """Partials (``keep_order``) of parts of the same windows as one row per window, in any grouping of the parts."""
    sums = ["volume", "base_volume", "trade_count", "buy_volume", "sell_volume", "buy_trades", "sell_trades",
            "large_trades", "large_trade_volume"]
    merged = partials.groupBy("symbol", "_interval", "window_start", "window_end").agg(
        F.min_by("open", "_first_ok").alias("_open"), F.max_by("close", "_last_ok").alias("close"),
        F.max("high").alias("high"), F.min("low").alias("low"), *[F.sum(c).alias(c) for c in sums],
        F.max("large_trade_threshold").alias("large_trade_threshold"),
        F.min("_first_ok").alias("_first_ok"), F.max("_last_ok").alias("_last_ok"),
    )
    merged = merged.withColumn("open", F.coalesce("_open", _dec("0")))
    return merged.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in partials.schema.fields])


def expand_windows(partials: DataFrame, intervals: list[tuple[str, str]]) -> DataFrame:
    """Each fine partial row once per target window: columns ``_label`` and ``_w`` (start, end).

    One ``window()`` per projection (Spark resolves a single time window per
    Project), then one Generate emits a row per target: the Expand of a
    grouping-sets aggregation, so every coarser level rolls up in one shuffle.
    """
    p = partials
    targets = []
    for i, (label, iv) in enumerate(intervals):
        p = p.withColumn(f"_w{i}", F.window("window_start", iv))
        targets.append(F.struct(F.lit(label).alias("_label"), F.col(f"_w{i}").alias("_w")))
    return p.select("*", F.inline(F.array(*targets))).drop(*[f"_w{i}" for i in range(len(intervals))])


def rollup_many(partials: DataFrame, intervals: list[tuple[str, str]]) -> DataFrame:
    """Partials for several coarser windows in one aggregation, labelled by ``_interval``."""
    return _rollup(expand_windows(partials, intervals), ["_label"])


def rollup_partials(partials: DataFrame, interval: str) -> DataFrame:
    """Partials at a coarser epoch-aligned window from finer partials."""
    p = partials.withColumn("_w", F.window("window_start", interval)).withColumn("_label", F.lit(interval))
    return _rollup(p, ["_label"])


def _rollup(p: DataFrame, extra_keys: list[str]) -> DataFrame:
    return (
        p.groupBy("symbol", *extra_keys, "_w")
        .agg(
            F.min_by("open", F.when(F.col("open") != 0, F.col("window_start"))).alias("_open_nz"),
            F.max_by("close", "window_start").alias("close"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.sum("volume").alias("volume"),
            F.sum("base_volume").alias("base_volume"),
            F.sum("trade_count").alias("trade_count"),
            F.sum("buy_volume").alias("buy_volume"),
            F.sum("sell_volume").alias("sell_volume"),
            F.sum("buy_trades").alias("buy_trades"),
            F.sum("sell_trades").alias("sell_trades"),
            F.sum("large_trades").alias("large_trades"),
            F.sum("large_trade_volume").alias("large_trade_volume"),
            F.max("large_trade_threshold").alias("large_trade_threshold"),
        )
        .select(
            "symbol",
            F.col("_label").alias("_interval"),
            F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"),
            F.coalesce(F.col("_open_nz"), _dec("0")).alias("open"),
            "high", "low", "close",
            F.col("volume").cast("decimal(38,16)").alias("volume"),
            F.col("base_volume").cast("decimal(38,8)").alias("base_volume"),
            "trade_count",
            F.col("buy_volume").cast("decimal(38,16)").alias("buy_volume"),
            F.col("sell_volume").cast("decimal(38,16)").alias("sell_volume"),
            "buy_trades", "sell_trades", "large_trades",
            F.col("large_trade_volume").cast("decimal(38,16)").alias("large_trade_volume"),
            "large_trade_threshold",
        )
    )
