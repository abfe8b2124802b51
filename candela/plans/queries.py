"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` over the driver tables.

Each query reads the given parquet tables (or data Spark derives from them),
runs the library operators and publishes decimals as DOUBLE
(``candela.plans.publish``) so the result compares with the DuckDB oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.operators.alerts import all_alerts, latest_alerts, price_alerts, trend_alerts, volume_alerts
from candela.functions.format import human_number
from candela.operators import views
from candela.operators.bars import bar_change, bars, bars_multi, finish_bars, market_bars
from candela.operators.catalog import stream_catalog
from candela.operators.changelog import (
    alerts_changelog,
    bars_changelog,
    bars_changelog_ticks,
    market_rows,
    price_history,
    strict_late_filter,
    trends_changelog,
    volume_changelog,
)
from candela.operators.partials import merge_partials
from candela.operators.views import alert_channels
from candela.operators.trends import trends
from candela.operators.volume import volume_analytics, volume_multi
from candela.plans.publish import publish
from candela.session import scratch_path
from candela.sources.adapter import load_trades, read_table
from candela.functions.timecols import epoch_micros
from candela.sources.decode import decode_trades, quarantine, quarantined
from candela.sources.io import (
    from_records,
    publish_records,
    read_messages,
    read_records,
    read_series,
    store_series,
    subscribe,
    to_records,
    write_records,
)
from candela.sources.wire import replay_messages, to_wire
from candela.streaming.batches import newest_rows, read_carried, read_output, replay_in_parts, start_steps
from candela.streaming.health import feed_status_stream
from candela.streaming.steps import changelog_step, decode_step, market_step, strict_bars_step, trailing_step
from candela.streaming.pipeline import (
    bars_stream,
    latest_offset,
    market_stream,
    messages_stream,
    newest_updates,
    run_to_table,
    run_updates_to_table,
    trades_stream_from_events,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ALL_BAR_INTERVALS = [("1m", "1 minute"), ("5m", "5 minutes"), ("15m", "15 minutes"), ("1h", "1 hour"), ("1d", "1 day")]


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


def _bars_query(label: str, interval: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return publish(bars(load_trades(spark, sf_dir), interval, label))

    return q


for _lab, _iv in ALL_BAR_INTERVALS:
    register(f"bars_{_lab}")(_bars_query(_lab, _iv))


@register("bars_all")
def q_bars_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1m / 5m / 15m price windows (one trade aggregation, one roll-up; ``method="direct"``
    reproduces the reference's one aggregation per window, same rows)."""
    return publish(bars_multi(load_trades(spark, sf_dir), method="rollup"))


@register("bars_rollup")
def q_bars_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1m partials once, rolled up to 5m, 15m, 1h and 1 day."""
    return publish(bars_multi(load_trades(spark, sf_dir), ALL_BAR_INTERVALS, method="rollup"))


def _volume_query(label: str, interval: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return publish(volume_analytics(load_trades(spark, sf_dir), interval, label))

    return q


for _lab, _iv in [("1m", "1 minute"), ("5m", "5 minutes"), ("1h", "1 hour")]:
    register(f"volume_{_lab}")(_volume_query(_lab, _iv))


@register("volume_all")
def q_volume_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish(volume_multi(load_trades(spark, sf_dir)))


# ---------------------------------------------------------------- trends

TREND_VIEWS = {
    "trend_sma": ["sma5", "sma15", "sma30"],
    "trend_ema": ["ema5", "ema15"],
    "trend_rsi": ["rsi"],
    "trend_momentum": ["momentum"],
    "trend_direction": ["trend_direction", "trend_strength"],
    "trends": ["current_price", "sma5", "sma15", "sma30", "ema5", "ema15", "rsi", "momentum",
               "trend_direction", "trend_strength"],
}


def trends_1m(spark: SparkSession, sf_dir: str, strategy: str = "direct") -> DataFrame:
    return trends(bars(load_trades(spark, sf_dir), "1 minute", "1m"), strategy=strategy)


def _round_ema(df: DataFrame) -> DataFrame:
    for c in ("ema5", "ema15"):
        if c in df.columns:
            df = df.withColumn(c, F.round(c, 6))
    return df


def _trend_query(cols: list[str]) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = trends_1m(spark, sf_dir)
        return _round_ema(publish(t.select("symbol", "window_start", "timestamp", *cols)))

    return q


for _name, _cols in TREND_VIEWS.items():
    register(_name)(_trend_query(_cols))


# ---------------------------------------------------------------- alerts

def publish_alerts(df: DataFrame) -> DataFrame:
    """Alert metadata as ``k=v;k=v`` sorted by key (MAP hashing differs between engines)."""
    text = "array_join(array_sort(transform(map_entries(metadata), e -> concat(e.key, '=', e.value))), ';')"
    return df.withColumn("metadata", F.expr(text))


def market_trends_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars, volume analytics and trend indicators of each (symbol, minute) in one row."""
    m = market_bars(load_trades(spark, sf_dir), "1 minute", "1m")
    extra = [c for c in m.columns if c not in ("symbol", "window_start")]
    return trends(m, extra=extra)


@register("alerts_price")
def q_alerts_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish_alerts(price_alerts(bars(load_trades(spark, sf_dir), "1 minute", "1m")))


@register("alerts_trend")
def q_alerts_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish_alerts(trend_alerts(trends_1m(spark, sf_dir)))


@register("alerts_volume")
def q_alerts_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish_alerts(volume_alerts(volume_analytics(load_trades(spark, sf_dir), "1 minute", "1m")))


@register("alerts_all")
def q_alerts_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish_alerts(all_alerts(market_trends_1m(spark, sf_dir)))


@register("alerts_top20")
def q_alerts_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish_alerts(latest_alerts(all_alerts(market_trends_1m(spark, sf_dir)), 20))


@register("alert_channels")
def q_alert_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish_alerts(alert_channels(all_alerts(market_trends_1m(spark, sf_dir))))


# ---------------------------------------------------------------- views

SERIES_SYMBOL = "purchase"


@register("trade_projection")
def q_trade_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish(views.trade_projection(load_trades(spark, sf_dir)))


@register("valid_trades")
def q_valid_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish(views.valid_trades(load_trades(spark, sf_dir)))


@register("buysell_30s")
def q_buysell_30s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish(views.buysell_buckets(load_trades(spark, sf_dir)))


@register("bar_change")
def q_bar_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish(bar_change(bars(load_trades(spark, sf_dir), "1 hour", "1h")))


@register("bars_vwap")
def q_bars_vwap(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bars(load_trades(spark, sf_dir), "1 hour", "1h")
    return publish(b.select("symbol", "window_start", "volume", "base_volume", "vwap", "mean_notional"))


@register("latest_snapshot")
def q_latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish(views.latest_snapshot(market_bars(load_trades(spark, sf_dir), "1 minute", "1m")))


@register("feed_health")
def q_feed_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.feed_health(load_trades(spark, sf_dir))


@register("feed_health_overall")
def q_feed_health_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.feed_health_overall(load_trades(spark, sf_dir))


@register("feed_health_as_of")
def q_feed_health_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A14 at given clocks: just before and just after the feed has been silent for 60 s."""
    clocks = views.feed_counts(load_trades(spark, sf_dir)).withColumn(
        "after_us", F.explode(F.array(*[F.lit(us) for us in (0, 59_999_999, 60_000_000, 3_600_000_000)]))
    )
    after = F.make_dt_interval(secs=F.col("after_us").cast("decimal(18,6)") / F.lit(1_000_000))
    return views.health_status(clocks, F.col("last_message_time") + after)


@register("trailing_window")
def q_trailing_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = views.trade_projection(load_trades(spark, sf_dir))
    return publish(views.trailing_window(t).select("symbol", "trade_id", "trade_time", "price", "notional"))


@register("symbol_series")
def q_symbol_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bars(views.symbol_series(load_trades(spark, sf_dir), SERIES_SYMBOL), "1 minute", "1m")
    return publish(b.select("symbol", "window_start", "open", "high", "low", "close", "volume", "trade_count"))


@register("symbol_series_stored")
def q_symbol_series_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5 from a stored layout: one symbol's folder is read, the others are not."""
    path = scratch_path(spark, "series")
    store_series(load_trades(spark, sf_dir).select("symbol", "trade_time", "trade_id", "price", "quantity", "is_buyer_maker"), path)
    b = bars(read_series(spark, path, SERIES_SYMBOL), "1 minute", "1m")
    return publish(b.select("symbol", "window_start", "open", "high", "low", "close", "volume", "trade_count"))


@register("rsi_zone")
def q_rsi_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish(views.rsi_zone(trends_1m(spark, sf_dir)))


@register("format_volume")
def q_format_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bars(load_trades(spark, sf_dir), "1 hour", "1h")
    return publish(b.select("symbol", "window_start", "volume", human_number(F.col("volume")).alias("volume_text")))


@register("stream_catalog")
def q_stream_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_catalog(load_trades(spark, sf_dir))


# ---------------------------------------------------------------- sources and sinks

def publish_trades(df: DataFrame) -> DataFrame:
    """Decoded trades with instants published as epoch milliseconds (zone-free)."""
    out = df.withColumn("event_time_ms", F.unix_millis("event_time")).withColumn(
        "trade_time_ms", F.unix_millis("trade_time")
    )
    return publish(out.drop("event_time", "trade_time"))


@register("decode_trades")
def q_decode_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs = replay_messages(read_table(spark, sf_dir, "events"))
    return publish_trades(decode_trades(msgs, keep=["seq"]))


@register("quarantine_trades")
def q_quarantine_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs = replay_messages(read_table(spark, sf_dir, "events"))
    return quarantine(msgs, keep=["seq"]).select("seq", "reason")


@register("sink_records")
def q_sink_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars as keyed JSON records, written and read back."""
    b = bars(load_trades(spark, sf_dir), "1 minute", "1m")
    path = scratch_path(spark, "records")
    write_records(to_records(b), path)
    return publish(from_records(read_records(spark, path, schema="key string, value string"), b.schema))


PUBLISHED = {
    "sink_prices": lambda spark, sf_dir: bars_multi(load_trades(spark, sf_dir)),
    "sink_volume": lambda spark, sf_dir: volume_multi(load_trades(spark, sf_dir)),
    "sink_trends": lambda spark, sf_dir: trends_1m(spark, sf_dir).select("symbol", "window_start", "timestamp", *TREND_VIEWS["trends"]),
    "sink_alerts": lambda spark, sf_dir: all_alerts(market_trends_1m(spark, sf_dir)),
}


def _sink_query(name: str) -> Query:
    """A dataset as keyed JSON records, a folder per symbol, read back."""

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = PUBLISHED[name](spark, sf_dir)
        path = scratch_path(spark, name)
        records = to_records(df)
        publish_records(records, F.get_json_object("value", "$.symbol"), path)
        back = from_records(subscribe(spark, path), df.schema, keep_key=False)
        return publish_alerts(back) if name == "sink_alerts" else _round_ema(publish(back))

    return q


for _name in PUBLISHED:
    register(_name)(_sink_query(_name))


@register("sink_trades")
def q_sink_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades published in wire form, a folder per symbol, read back and decoded."""
    t = load_trades(spark, sf_dir)
    path = scratch_path(spark, "published-trades")
    publish_records(t.select(F.col("symbol").alias("key"), to_wire(t).alias("value")), F.col("key"), path)
    return publish_trades(decode_trades(subscribe(spark, path)))


@register("source_roundtrip")
def q_source_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish the replay feed as JSON lines to the shared checkpoint folder, read it back, decode."""
    path = scratch_path(spark, "raw-trades")
    replay_messages(read_table(spark, sf_dir, "events")).select("value").write.mode("overwrite").text(path)
    return publish_trades(decode_trades(read_messages(spark, path)))


@register("stream_decode")
def q_stream_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1-S5 on a stream: text messages from files, decoded as they come."""
    path = scratch_path(spark, "raw-trades")
    replay_messages(read_table(spark, sf_dir, "events")).select("value").write.text(path)
    trades = decode_trades(messages_stream(spark, path))
    return publish_trades(spark.read.parquet(run_to_table(trades, "stream-decode")))


@register("stream_from_latest")
def q_stream_from_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that starts at the latest offsets reads what comes after its start only."""
    path = scratch_path(spark, "raw-trades")
    messages = replay_messages(read_table(spark, sf_dir, "events"))
    half = messages.agg(F.expr("max(seq) div 2").alias("half")).first().half or 0
    messages.filter(F.col("seq") <= half).select("value").write.text(path)
    start = latest_offset(spark, path)
    messages.filter(F.col("seq") > half).select("value").write.mode("append").text(path)
    trades = decode_trades(messages_stream(spark, path, after=start))
    return publish_trades(spark.read.parquet(run_to_table(trades, "stream-latest")))


# ---------------------------------------------------------------- changelog, lateness, history

@register("bars_changelog")
def q_bars_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish(bars_changelog(load_trades(spark, sf_dir), "1 hour", "1h").drop("_ok"))


@register("volume_changelog")
def q_volume_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish(volume_changelog(load_trades(spark, sf_dir), "1 hour", "1h"))


@register("trends_changelog")
def q_trends_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_ema(publish(trends_changelog(load_trades(spark, sf_dir), block_rows=1000)))


@register("alerts_changelog")
def q_alerts_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1-L8 over every emission of 1-minute windows."""
    return publish_alerts(alerts_changelog(load_trades(spark, sf_dir)))


@register("bars_strict")
def q_bars_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 after W5: daily bars of the trades that a no-grace window accepts."""
    return publish(bars(strict_late_filter(load_trades(spark, sf_dir), "1 day"), "1 day", "1d"))


@register("volume_strict")
def q_volume_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 after W5."""
    return publish(volume_analytics(strict_late_filter(load_trades(spark, sf_dir), "1 day"), "1 day", "1d"))


@register("trends_mixed")
def q_trends_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """trends over rows of all intervals use the 1-minute ones only."""
    t = trends(bars_multi(load_trades(spark, sf_dir)))
    return _round_ema(publish(t.select("symbol", "window_start", "timestamp", *TREND_VIEWS["trends"])))


@register("alerts_mixed")
def q_alerts_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """price alerts over rows of all intervals use the 1-minute ones only."""
    return publish_alerts(price_alerts(bars_multi(load_trades(spark, sf_dir))))


@register("bars_changelog_1s")
def q_bars_changelog_1s(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W4 at the reference's commit interval: a window's last state in each second that changed it."""
    return publish(bars_changelog_ticks(load_trades(spark, sf_dir), "1 hour", "1 second", "1h").drop("tick_start"))


@register("bars_changelog_10m")
def q_bars_changelog_10m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same at a tick that several trades share."""
    return publish(bars_changelog_ticks(load_trades(spark, sf_dir), "1 hour", "10 minutes", "1h").drop("tick_start"))


@register("strict_late_filter")
def q_strict_late_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = strict_late_filter(load_trades(spark, sf_dir), "1 day")
    return publish(kept.select("part", "arrival_seq", "trade_id", "symbol", "trade_time", "window_start", "window_end"))


@register("price_history")
def q_price_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish(price_history(bars(load_trades(spark, sf_dir), "1 minute", "1m")))


# ---------------------------------------------------------------- streaming

def _publish_stream(df: DataFrame) -> DataFrame:
    """Stream outputs carry TIMESTAMP instants: publish them as epoch microseconds (zone-free)."""
    for f in df.schema.fields:
        if f.dataType.typeName() == "timestamp":
            df = df.withColumn(f"{f.name}_us", F.unix_micros(f.name)).drop(f.name)
    return publish(df)


def _cores(spark: SparkSession) -> int | None:
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001
        return None


def _replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as a file stream, as it lies."""
    return trades_stream_from_events(spark, f"{sf_dir.rstrip('/')}/events.parquet")


@register("stream_bars_1m")
def q_stream_bars_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final 1-minute bars from a file stream (append, watermark 0), replayed to completion."""
    path = run_to_table(bars_stream(_replay(spark, sf_dir)), "stream-bars", state_partitions=_cores(spark))
    return _publish_stream(spark.read.parquet(path))


@register("stream_bars_updates")
def q_stream_bars_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W4 on a stream: update mode emits the current state of every window touched by a
    micro-batch; the newest emission of each window is its final state, open ones included."""
    path = run_updates_to_table(bars_stream(_replay(spark, sf_dir)), "stream-bar-updates",
                                state_partitions=_cores(spark))
    return _publish_stream(newest_updates(spark.read.parquet(path)))


def _market_tables(spark: SparkSession, sf_dir: str, name: str, **step) -> str:
    """Final 1-minute bars of the replay through ``market_step``; the folder of its tables."""
    path = scratch_path(spark, name)
    start_steps(market_stream(_replay(spark, sf_dir)), market_step(**step), path, state_partitions=_cores(spark)).awaitTermination()
    return path


@register("stream_trends")
def q_stream_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars -> indicators, the last 29 bars of each symbol carried from micro-batch to micro-batch."""
    rows = read_output(spark, _market_tables(spark, sf_dir, "stream-trends"), "market")
    return _round_ema(_publish_stream(rows.select("symbol", "window_start", "timestamp", *TREND_VIEWS["trends"])))


@register("stream_alerts")
def q_stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eight rules from one stream of 1-minute partials: one scan, one trade aggregation."""
    path = _market_tables(spark, sf_dir, "stream-alerts", top=20)
    return _publish_stream(publish_alerts(read_output(spark, path, "alerts")))


@register("stream_alerts_top20")
def q_stream_alerts_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L10 on a stream: the 20 newest alerts of each symbol, merged batch by batch."""
    path = _market_tables(spark, sf_dir, "stream-top", top=20)
    return _publish_stream(publish_alerts(read_carried(spark, path, "top_alerts")))


@register("stream_alert_channels")
def q_stream_alert_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9 on a stream: a folder per channel, of all symbols and of each."""
    path = _market_tables(spark, sf_dir, "stream-channels", top=20, channels=True)
    return _publish_stream(publish_alerts(read_output(spark, path, "channels").drop("route")))


@register("stream_latest_snapshot")
def q_stream_latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A13 on a stream: the newest bar and indicators of each symbol, replaced as bars close."""
    path = _market_tables(spark, sf_dir, "stream-snapshot", snapshot=True)
    return _publish_stream(views.snapshot_columns(read_carried(spark, path, "snapshot")))


@register("stream_price_history")
def q_stream_price_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W6 on a stream."""
    path = _market_tables(spark, sf_dir, "stream-history", history=True, indicators=False)
    return _publish_stream(read_output(spark, path, "history"))


# ---------------------------------------------------------------- streams in trade or arrival order, stopped and started between parts

def _by_time(trades: DataFrame) -> F.Column:
    return epoch_micros(F.col("trade_time"), trades.schema["trade_time"].dataType)


@register("stream_bars_strict")
def q_stream_bars_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W5 on a stream: no-grace lateness by source partition in arrival order, then daily bars."""
    path = replay_in_parts(load_trades(spark, sf_dir), F.col("arrival_seq"), strict_bars_step("1 day"), "stream-strict")
    return publish(finish_bars(merge_partials(read_output(spark, path, "partials")), "1d"))


@register("stream_strict_late_filter")
def q_stream_strict_late_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W5 on a stream: the rows kept."""
    path = replay_in_parts(load_trades(spark, sf_dir), F.col("arrival_seq"), strict_bars_step("1 day"), "stream-kept")
    kept = read_output(spark, path, "kept")
    return publish(kept.select("part", "arrival_seq", "trade_id", "symbol", "trade_time", "window_start", "window_end"))


@register("stream_bars_changelog")
def q_stream_bars_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W4 on a stream: the bar after every trade."""
    trades = load_trades(spark, sf_dir)
    path = replay_in_parts(trades, _by_time(trades), changelog_step("1 hour", with_trends=False), "stream-changelog")
    rows = market_rows(read_output(spark, path, "emissions"), "1h")
    return publish(rows.select(*bars_changelog(trades, "1 hour", "1h").drop("_ok").columns))


@register("stream_bars_changelog_10m")
def q_stream_bars_changelog_10m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coalescing on a stream; of a tick that two micro-batches share the later row holds."""
    trades = load_trades(spark, sf_dir)
    step = changelog_step("1 hour", tick_micros=600_000_000, with_trends=False)
    path = replay_in_parts(trades, _by_time(trades), step, "stream-ticks")
    rows = newest_rows(read_output(spark, path, "ticks"), ["symbol", "window_start", "tick"], "_ok")
    return publish(market_rows(rows, "1h").select(*bars_changelog(trades, "1 hour", "1h").drop("_ok").columns))


@register("stream_trends_changelog")
def q_stream_trends_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T8 on a stream: indicators after every trade."""
    trades = load_trades(spark, sf_dir)
    path = replay_in_parts(trades, _by_time(trades), changelog_step(), "stream-trade-trends")
    rows = read_output(spark, path, "market")
    return _round_ema(publish(rows.select("symbol", "window_start", "timestamp", "trade_id", *TREND_VIEWS["trends"])))


@register("stream_alerts_changelog")
def q_stream_alerts_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1-L8 on a stream at every emission."""
    trades = load_trades(spark, sf_dir)
    path = replay_in_parts(trades, _by_time(trades), changelog_step(), "stream-trade-alerts")
    return publish_alerts(all_alerts(read_output(spark, path, "market")))


@register("stream_trailing_window")
def q_stream_trailing_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4 on a stream: the rows of the last ten minutes, older ones evicted."""
    trades = views.trade_projection(load_trades(spark, sf_dir))
    path = replay_in_parts(trades, _by_time(trades), trailing_step(), "stream-trailing")
    return publish(read_carried(spark, path, "buffer").select("symbol", "trade_id", "trade_time", "price", "notional"))


@register("stream_quarantine")
def q_stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 on a stream: dead letters, written by the job that writes the trades."""
    messages = replay_messages(read_table(spark, sf_dir, "events")).select("seq", "value")
    path = replay_in_parts(messages, F.col("seq"), decode_step(keep=["seq"]), "stream-letters")
    return quarantined(read_output(spark, path, "messages").filter("outcome = 'dead_letter'"), ["seq"]).select("seq", "reason")


@register("stream_feed_status")
def q_stream_feed_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A14 on a stream: UP and DOWN of each symbol, DOWN by a timer 60 s after its last message."""
    path = run_to_table(feed_status_stream(_replay(spark, sf_dir)), "stream-status", state_partitions=_cores(spark))
    return _publish_stream(spark.read.parquet(path))
