"""Dashboard views re-expressed as batch queries over stored outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The all-symbol alert channel and the per-symbol channel prefix.
ALL_ALERTS_CHANNEL = "/topic/alerts"
SYMBOL_ALERTS_PREFIX = "/topic/alerts/"


def alert_channels(alerts: DataFrame) -> DataFrame:
    """Every alert once on the all-symbol channel and once on its symbol's channel."""
    channels = F.array(F.lit(ALL_ALERTS_CHANNEL), F.concat(F.lit(SYMBOL_ALERTS_PREFIX), F.col("symbol")))
    return alerts.select(F.explode(channels).alias("channel"), *alerts.columns)


# Fixed values of the page: 30-second buckets, 10-minute trailing window,
# 60-second feed staleness limit, RSI zone cut-offs 70 / 30.
BUCKET = "30 seconds"
TRAILING_MINUTES = 10
STALE_AFTER_SECONDS = 60
RSI_HIGH = "70"
RSI_LOW = "30"


def trade_projection(trades: DataFrame) -> DataFrame:
    """P1 notional = price * quantity; P3 side: a maker buyer is a market sell."""
    return trades.select(
        "symbol", "trade_id", "trade_time", "price", "quantity",
        (F.col("price") * F.col("quantity")).alias("notional"),
        F.when(F.col("is_buyer_maker"), F.lit("sell")).otherwise(F.lit("buy")).alias("side"),
    )


def valid_trades(trades: DataFrame) -> DataFrame:
    """F2 + F3: a usable price (> 0) and a usable volume point (quantity > 0, notional > 0)."""
    p = trade_projection(trades)
    return p.filter((F.col("price") > 0) & (F.col("quantity") > 0) & (F.col("notional") > 0))


def buysell_buckets(trades: DataFrame, bucket: str = BUCKET) -> DataFrame:
    """Notional per (symbol, side, 30-second bucket) of valid volume points, by trade time."""
    v = valid_trades(trades)
    return (
        v.groupBy("symbol", "side", F.window("trade_time", bucket).alias("_w"))
        .agg(F.sum("notional").alias("volume"), F.count(F.lit(1)).alias("trade_count"))
        .select("symbol", "side", F.col("_w.start").alias("bucket_start"), "volume", "trade_count")
    )


def _as_of(df: DataFrame, time_col: str):
    """Scalar subquery: the latest event time of the input (the clock of a replayed feed)."""
    return df.select(F.max(time_col)).scalar()


def trailing_window(df: DataFrame, time_col: str = "trade_time", minutes: int = TRAILING_MINUTES,
                    as_of=None) -> DataFrame:
    """rows newer than as_of - 10 minutes (strict); as_of defaults to the latest row time."""
    as_of = _as_of(df, time_col) if as_of is None else as_of
    return df.filter(F.col(time_col) > as_of - F.expr(f"INTERVAL {int(minutes)} MINUTES"))


def symbol_series(df: DataFrame, symbol: str) -> DataFrame:
    """one symbol's rows (pushed to the scan when df reads stored data)."""
    return df.filter(F.col("symbol") == F.lit(symbol))


def feed_health(trades: DataFrame, time_col: str = "trade_time", as_of=None,
                stale_after_seconds: int = STALE_AFTER_SECONDS) -> DataFrame:
    """A14 per symbol: message count, last message time, healthy = last within 60 s of as_of (strict)."""
    as_of = _as_of(trades, time_col) if as_of is None else as_of
    agg = trades.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("message_count"), F.max(time_col).alias("last_message_time")
    )
    healthy = F.col("last_message_time") > as_of - F.expr(f"INTERVAL {int(stale_after_seconds)} SECONDS")
    return agg.select(
        "symbol", "message_count", "last_message_time",
        healthy.alias("healthy"),
        F.when(healthy, F.lit("UP")).otherwise(F.lit("DOWN")).alias("status"),
    )


def feed_health_overall(trades: DataFrame, stale: str = "60 SECONDS", as_of: Column | None = None) -> DataFrame:
    """A14 for the whole feed: one row. Healthy while the newest message is less than ``stale`` old (strict).

    ``as_of`` defaults to the newest message, for replays; pass ``current_timestamp()`` on a live table.
    """
    return health_status(feed_counts(trades), as_of if as_of is not None else F.col("last_message_time"), stale)


def feed_counts(trades: DataFrame) -> DataFrame:
    """One row: messages of the whole feed and the newest one's time."""
    return trades.agg(F.count(F.lit(1)).alias("message_count"), F.max("trade_time").alias("last_message_time"))


def health_status(h: DataFrame, now: Column, stale: str = "60 SECONDS") -> DataFrame:
    """Adds ``healthy`` and ``status`` at the clock ``now``."""
    healthy = F.coalesce(F.col("last_message_time") > now - F.expr(f"INTERVAL {stale}"), F.lit(False))
    return h.withColumn("healthy", healthy).withColumn("status", F.when(healthy, "UP").otherwise("DOWN"))


def rsi_zone(trends_df: DataFrame) -> DataFrame:
    """Overbought above 70, oversold below 30, else neutral; NULL before RSI is available."""
    r = F.col("rsi")
    zone = (
        F.when(r > F.lit(RSI_HIGH).cast("decimal(38,8)"), F.lit("overbought"))
        .when(r < F.lit(RSI_LOW).cast("decimal(38,8)"), F.lit("oversold"))
        .when(r.isNotNull(), F.lit("neutral"))
    )
    return trends_df.select("symbol", "window_start", "rsi", zone.alias("rsi_zone"))


SNAPSHOT_FIELDS = ("window_end", "close", "price_change_pct", "volume", "rsi", "trend_direction", "trend_strength")


def snapshot_columns(newest: DataFrame) -> DataFrame:
    """A13 + P13 of the newest rows."""
    change = F.when(F.col("price_change_pct") >= 0, F.lit("up")).otherwise(F.lit("down")).alias("change_class")
    return newest.select("symbol", "interval", *SNAPSHOT_FIELDS, change)


def latest_snapshot(market: DataFrame) -> DataFrame:
    """A13 + P13: per symbol and interval, the newest bar and indicators; ``change_class`` up when pct >= 0.

    ``market`` holds one row per (symbol, window) with bar and volume columns
    (``market_bars``). Every indicator looks back at most 30 bars and its gates
    use min(n, 30), so the newest row depends only on the symbol's last 30 bars:
    those are kept first (a top-k that Spark limits map-side, before the shuffle),
    then the trend window runs on that tail only.
    """
    from pyspark.sql import Window

    from candela.operators.trends import HISTORY, trends

    newest = Window.partitionBy("symbol", "interval").orderBy(F.col("window_start").desc())
    tail = market.withColumn("_rk", F.row_number().over(newest)).filter(F.col("_rk") <= HISTORY).drop("_rk")
    t = trends(tail, interval=None, extra=[c for c in tail.columns if c not in ("symbol", "window_start")])
    fields = list(SNAPSHOT_FIELDS)
    last = t.groupBy("symbol", "interval").agg(F.max_by(F.struct(*fields), "window_start").alias("_s"))
    return snapshot_columns(last.select("symbol", "interval", *[F.col(f"_s.{f}").alias(f) for f in fields]))
