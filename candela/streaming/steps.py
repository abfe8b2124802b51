"""Stateful stream operators as steps over micro-batches.

Each function returns a step for ``start_steps``. The step runs the batch
operators on a micro-batch and on what the batches before it carried, so that
any cutting of the input into micro-batches gives the rows of one batch run
(the feed in arrival order for W5, in trade order per symbol for W4 and T8).

What is carried is bounded by keys, never by rows:

* ``strict_bars_step``  a clock (largest event time) for each source partition
* ``changelog_step``    open windows, and the last 29 emissions of each symbol
* ``market_step``       the last 29 final bars of each symbol; the newest ``top`` alerts
                        of each symbol; the newest bar of each (symbol, interval)
* ``trailing_step``     rows of the trailing window
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.functions.timecols import epoch_micros
from candela.operators import views
from candela.operators.alerts import all_alerts, latest_alerts
from candela.operators.changelog import (
    bucket_of_key,
    carried_windows,
    coalesced,
    market_rows,
    price_history,
    running_partials,
    strict_late_filter,
)
from candela.operators.partials import interval_label, trade_partials
from candela.operators.trends import HISTORY, trends
from candela.sources.decode import classified
from candela.streaming.batches import BatchTables, Step, newest_rows


def _newest_per(rows: DataFrame, keys: list[str], order: str, n: int) -> DataFrame:
    """The ``n`` last rows of each key: a top-k that Spark limits before the shuffle."""
    last = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return rows.withColumn("_rk", F.row_number().over(last)).filter(F.col("_rk") <= n).drop("_rk")


def strict_bars_step(interval: str = "1 minute", partition_col: str = "part", time_col: str = "trade_time",
                     arrival_cols: tuple[str, ...] = ("arrival_seq", "trade_id")) -> Step:
    """W5 before W1/W2: drops rows that a no-grace window would, then aggregates the kept ones.

    Outputs ``kept`` (the rows, with their window) and ``partials`` (mergeable:
    ``partials.merge_partials`` over all batches gives the windows). Carried:
    ``clock``. A kept row is the only kind that can move its partition's clock on, so
    the clock follows from the kept rows alone.
    """

    def step(batch: DataFrame, tables: BatchTables) -> None:
        part = batch.schema[partition_col].dataType.simpleString()
        clock = tables.carried("clock", f"`{partition_col}` {part}, stream_us bigint")
        kept = strict_late_filter(batch, interval, time_col, partition_col, arrival_cols, carried=clock)
        kept = tables.write("kept", kept)
        tables.write("partials", trade_partials(kept, interval, time_col=time_col, keep_order=True))
        now = kept.select(partition_col, epoch_micros(F.col(time_col), kept.schema[time_col].dataType).alias("stream_us"))
        tables.carry("clock", clock.unionByName(now).groupBy(partition_col).agg(F.max("stream_us").alias("stream_us")))

    return step


def changelog_step(interval: str = "1 minute", time_col: str = "trade_time", bucket_micros: int = 1_000_000,
                   index_bucket_micros: int = 60_000_000, block_rows: int = 100_000, retain: str = "1 hour",
                   tick_micros: int | None = None, with_trends: bool = True) -> Step:
    """W4, T8 and L1-L8 at the as-coded cadence: one row per trade, in trade order of each symbol.

    Outputs: ``emissions`` (running window state), with ``tick_micros`` also ``ticks``
    (the last state of each tick, see ``coalesced``: a tick that two micro-batches share has a row in
    either, the later one holds), and ``market`` (bar, volume and trend columns of
    each emission; ``all_alerts`` reads it). Carried: ``windows``, those that began within ``retain``
    of the newest of their symbol, and ``tail``, the emissions that indicators look back at.
    """

    known: list[T.StructType] = []

    def step(batch: DataFrame, tables: BatchTables) -> None:
        if not known:
            known.append(running_partials(batch, interval, time_col, bucket_micros).schema)
        schema = known[0]
        windows = tables.carried("windows", schema)
        emissions = running_partials(batch, interval, time_col, bucket_micros, carried=carried_windows(windows))
        emissions = tables.write("emissions", emissions)
        if tick_micros:
            tables.write("ticks", coalesced(emissions, tick_micros))
        if with_trends:
            tail = tables.carried("tail", schema)
            both = tail.withColumn("_past", F.lit(True)).unionByName(emissions.withColumn("_past", F.lit(False)))
            # bar and volume columns are derived after the windows, which so move and sort the running values alone
            state = [c for c in both.columns if c not in ("symbol", "window_start")]
            found = trends(both, order_col="_ok", timestamp_col="window_end", strategy="blocked", block_rows=block_rows,
                           extra=state, bucket=bucket_of_key(index_bucket_micros), interval=None)
            found = found.filter(~F.col("_past"))
            indicators = [c for c in found.columns if c not in both.columns]
            rows = market_rows(found, interval_label(interval), indicators)
            own = [c for c in rows.columns if c not in ("symbol", "window_start", "_ok", *indicators)]
            tables.write("market", rows.select("symbol", "window_start", "timestamp", *own, *[c for c in indicators if c != "timestamp"]))
            tables.carry("tail", _newest_per(tail.unionByName(emissions), ["symbol"], "_ok", HISTORY - 1))
        every = windows.unionByName(emissions)
        newest = every.groupBy(F.struct("symbol").alias("_of")).agg(F.max("window_start").alias("_newest"))
        open_ = every.withColumn("_of", F.struct("symbol")).join(newest, "_of")
        open_ = open_.filter(F.col("window_start") > F.col("_newest") - F.expr(f"INTERVAL {retain}")).select(*schema.fieldNames())
        tables.carry("windows", newest_rows(open_, ["symbol", "window_start"], "_ok").select(*schema.fieldNames()))

    return step


def market_step(top: int | None = None, snapshot: bool = False, history: bool = False, channels: bool = False,
                indicators: bool = True, block_rows: int = 100_000) -> Step:
    """T7, L9, L10, A13 and W6 over final bars (``market_stream`` in append mode, bars in order of their windows).

    Outputs ``bars``, with ``indicators`` ``market`` (bars with indicators, which alerts and the snapshot need), with ``top`` also ``alerts``, with
    ``channels`` those alerts routed to a folder per channel (S9), with ``history`` also ``history`` (W6). Carried: ``tail``; with ``top`` the ``top`` newest
    alerts of each symbol; with ``snapshot`` the newest row of each (symbol, interval).
    """

    if (top or snapshot) and not indicators:
        raise ValueError("alerts and the snapshot read indicators")

    def step(batch: DataFrame, tables: BatchTables) -> None:
        bars = tables.write("bars", batch)
        tail = tables.carried("tail", bars.schema)
        both = tail.withColumn("_past", F.lit(True)).unionByName(bars.withColumn("_past", F.lit(False)))
        if indicators:
            extra = [c for c in both.columns if c not in ("symbol", "window_start")]
            rows = trends(both, strategy="blocked", block_rows=block_rows, extra=extra, interval=None)
            rows = tables.write("market", rows.filter(~F.col("_past")).drop("_past"))
        if history:
            past = price_history(both, extra=["_past"], strategy="blocked", block_rows=block_rows)
            tables.write("history", past.filter(~F.col("_past")).drop("_past"))
        if top:
            alerts = tables.write("alerts", all_alerts(rows))
            before = tables.carried("top_alerts", alerts.schema)
            tables.carry("top_alerts", latest_alerts(before.unionByName(alerts), top))
            if channels:
                routed = views.alert_channels(alerts)
                tables.write("channels", routed.withColumn("route", F.col("channel")), partition_by=["route"])
        if snapshot:
            before = tables.carried("snapshot", rows.schema)
            newest = newest_rows(before.unionByName(rows), ["symbol", "interval"], "window_start")
            tables.carry("snapshot", newest)
        tables.carry("tail", _newest_per(tail.unionByName(bars), ["symbol", "interval"], "window_start", HISTORY - 1))

    return step


def trailing_step(time_col: str = "trade_time", minutes: int = views.TRAILING_MINUTES) -> Step:
    """carries ``buffer``, the rows newer than the newest row's time less ``minutes`` (strict); older ones leave it."""

    def step(batch: DataFrame, tables: BatchTables) -> None:
        rows = tables.carried("buffer", batch.schema).unionByName(batch)
        tables.carry("buffer", views.trailing_window(rows, time_col, minutes))

    return step


def decode_step(value_col: str = "value", keep: list[str] | None = None) -> Step:
    """Each message parsed once, trades and dead letters written by one job as two partitions of ``messages``.

    ``decode.trades_of`` and ``decode.quarantined`` read them. Since both are in one folder of
    the batch, a repeated batch replaces both or none.
    """

    def step(batch: DataFrame, tables: BatchTables) -> None:
        rows = classified(batch, value_col, list(keep or []))
        outcome = F.when(F.col("reason").isNull(), "trade").otherwise("dead_letter")
        tables.write("messages", rows.withColumn("outcome", outcome), partition_by=["outcome"])

    return step
