"""Structured Streaming form of the pipelines.

* Sources: a file directory (parquet / JSON lines) or Kafka (``candela.sources.io``).
  Stream event time must be TIMESTAMP; ``events.ts`` (TIMESTAMP_NTZ) is converted
  zone-free with ``timestamp_micros(epoch micros)``.
* Bars and volume analytics are the batch operators unchanged: a watermarked
  ``groupBy(symbol, window)`` emits final rows in ``append`` mode (the watermark
  ``delay`` plays the reference's grace period, default 0) or every update in
  ``update`` mode (changelog, W4).
* Trends need per-symbol state across micro-batches: ``transformWithStateInPandas``
  with a ``StatefulProcessor`` whose value state is the last 30 closes (RocksDB
  state store). Each batch sorts a key's new windows and computes their
  indicators together, over integer units.
* Alerts: the batch rule columns, applied per stream and unioned.
* Sinks: checkpointed ``writeStream`` (file sinks are exactly-once), trigger
  ``processingTime="1 second"`` like the reference's commit interval, or
  ``availableNow`` for replay. Checkpoints live under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from candela.functions.indicators import indicator_columns
from candela.functions.timecols import epoch_micros
from candela.operators.alerts import price_alert_columns, trend_alert_columns, volume_alert_columns
from candela.operators.bars import finish_bars, market_bars
from candela.operators.partials import interval_label, trade_partials
from candela.operators.trends import HISTORY
from candela.operators.volume import finish_volume
from candela.session import scratch_path, ship_package
from candela.sources.adapter import trades_from_events

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

TREND_STREAM_SCHEMA = (
    "symbol string, window_start timestamp, timestamp timestamp, current_price decimal(18,8), "
    "sma5 decimal(38,8), sma15 decimal(38,8), sma30 decimal(38,8), ema5 double, ema15 double, "
    "rsi decimal(38,8), momentum decimal(38,8), trend_direction string, trend_strength string"
)


def stage_replay(df: DataFrame, name: str, files: int = 1, order_col: str = "ts") -> str:
    """Writes a batch table as a parquet folder under the checkpoint root, for a file stream to replay.

    Rows are range-partitioned and sorted by ``order_col`` so each file covers a
    time range (several files give several micro-batches with ``maxFilesPerTrigger``).
    """
    path = scratch_path(df.sparkSession, name)
    df.repartitionByRange(files, order_col).sortWithinPartitions(order_col).write.parquet(path)
    return path


def trades_stream_from_events(spark: SparkSession, events_dir: str, max_files_per_trigger: int | None = None
                              ) -> DataFrame:
    """Streaming trades from ``events`` parquet, a folder of files or one file, event time as TIMESTAMP."""
    table = spark.read.parquet(events_dir)
    schema = table.schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    folder, _, name = events_dir.rstrip("/").rpartition("/")
    if any(f.endswith(f"/{name}") for f in table.inputFiles()):
        # a file source reads folders: the one file of this name in its folder
        reader, events_dir = reader.option("pathGlobFilter", name), folder
    ev = reader.parquet(events_dir)
    t = trades_from_events(ev)
    inst = F.timestamp_micros(epoch_micros(F.col("trade_time"), schema["ts"].dataType))
    return t.withColumn("trade_time", inst).withColumn("event_time", inst)


def bars_stream(trades: DataFrame, interval: str = "1 minute", delay: str = "0 seconds",
                time_col: str = "trade_time") -> DataFrame:
    t = trades.withWatermark(time_col, delay)
    return finish_bars(trade_partials(t, interval, time_col=time_col), interval_label(interval))


def volume_stream(trades: DataFrame, interval: str = "1 minute", delay: str = "0 seconds",
                  time_col: str = "trade_time") -> DataFrame:
    t = trades.withWatermark(time_col, delay)
    return finish_volume(trade_partials(t, interval, time_col=time_col), interval_label(interval))


def market_stream(trades: DataFrame, interval: str = "1 minute", delay: str = "0 seconds",
                  time_col: str = "trade_time") -> DataFrame:
    """Bar and volume columns of the same window in one row, from one stateful aggregation."""
    return market_bars(trades.withWatermark(time_col, delay), interval, interval_label(interval), time_col=time_col)


def latest_offset(spark: SparkSession, path: str) -> datetime | None:
    """Where a stream of ``path`` starts that wants new messages only: the time of its newest file; None without files."""
    system = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(spark._jvm.org.apache.hadoop.fs.Path(path)):
        return None
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.max("modificationTime")).first()[0]


def messages_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                    after: datetime | None = None) -> DataFrame:
    """Text messages (column ``value``) from a folder that gets new files; the offline twin of a topic.

    All files are read by default (earliest offsets); with ``after`` only later ones (``latest_offset``: latest offsets).
    Restarts go on from their checkpoint and must give the same ``after``.
    """
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    messages = reader.text(path)
    if after is not None:
        messages = messages.filter(F.col("_metadata.file_modification_time") > F.lit(after))
    return messages


def newest_updates(updates: DataFrame) -> DataFrame:
    """The last emission of each (symbol, interval, window) of an update-mode table (``batch_id`` orders them)."""
    keys = ["symbol", "interval", "window_start"]
    rest = [c for c in updates.columns if c not in (*keys, "batch_id")]
    last = updates.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("_last"))
    return last.select(*keys, "_last.*")


class TrendProcessor(StatefulProcessor):
    """Per-symbol state: the last 30 closes (exact decimal text), oldest first. Other columns pass through."""

    def __init__(self, extra: list[str]):
        self.extra = extra

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.history = handle.getValueState("history", "closes array<string>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True).sort_values("window_start", kind="stable")
        hist: list[Decimal] = []
        if self.history.exists():
            hist = [Decimal(x) for x in self.history.get()[0]]
        closes = hist + [Decimal(c) for c in batch["close"]]
        self.history.update(([str(x) for x in closes[-HISTORY:]],))
        found = pd.DataFrame(indicator_columns(closes, len(hist)), index=batch.index)
        found = found.assign(symbol=batch["symbol"], window_start=batch["window_start"], timestamp=batch["window_end"])
        for name in self.extra:
            found[name] = batch[name]
        yield found[[c.split()[0] for c in TREND_STREAM_SCHEMA.split(", ")] + self.extra]

    def close(self) -> None:
        pass


def trends_stream(bars: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """T7 over a stream of final 1-minute bars (append mode); ``extra`` columns of the bars pass through."""
    ship_package(bars.sparkSession)
    names = list(extra or [])
    schema = ", ".join([TREND_STREAM_SCHEMA, *(f"`{n}` {bars.schema[n].dataType.simpleString()}" for n in names)])
    return (
        bars.select(*dict.fromkeys(["symbol", "window_start", "window_end", "close", *names]))
        .groupBy("symbol")
        .transformWithStateInPandas(TrendProcessor(names), schema, "append", "None")
    )


def alerts_stream(bars_1m: DataFrame, volume_1m: DataFrame, trends: DataFrame) -> DataFrame:
    """The three alert streams, unioned (no dedupe)."""
    from candela.operators.alerts import emit

    return (
        emit(bars_1m, price_alert_columns())
        .unionByName(emit(trends, trend_alert_columns()))
        .unionByName(emit(volume_1m, volume_alert_columns()))
    )


class _StartSettings:
    """Settings that a new query reads when it starts (it keeps a copy of the session's), put back at once.

    The number of state partitions is fixed in the checkpoint from then on.
    """

    def __init__(self, spark: SparkSession, state_partitions: int | None):
        self.spark = spark
        self.new = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}
        if state_partitions:
            self.new["spark.sql.shuffle.partitions"] = str(state_partitions)

    def __enter__(self):
        self.old = {k: self.spark.conf.get(k, None) for k in self.new}
        for k, v in self.new.items():
            self.spark.conf.set(k, v)

    def __exit__(self, *exc):
        for k, v in self.old.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)


def start_table(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", available_now: bool = True,
                processing_time: str = "1 second", state_partitions: int | None = None) -> StreamingQuery:
    """Starts a streaming DataFrame into a checkpointed file sink and returns its query.

    Called again with the same ``path`` and ``checkpoint`` it goes on where it
    stopped: files that were read are not read again, state is kept, and the
    sink's own log keeps a repeated batch from adding rows twice (W7).
    """
    writer = df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    with _StartSettings(df.sparkSession, state_partitions):
        return writer.start()


def start_updates(df: DataFrame, path: str, checkpoint: str, available_now: bool = True,
                  processing_time: str = "1 second", state_partitions: int | None = None) -> StreamingQuery:
    """Starts a streaming DataFrame in ``update`` mode (changelog, W4) into a parquet table.

    File sinks accept only ``append``; here ``foreachBatch`` writes each
    micro-batch to its own ``batch_id=<n>`` folder with overwrite, so a batch
    replayed after a failure replaces itself instead of adding duplicates (W7).
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = df.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint).outputMode("update")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    with _StartSettings(df.sparkSession, state_partitions):
        return writer.start()


def run_to_table(df: DataFrame, name: str, fmt: str = "parquet", state_partitions: int | None = None) -> str:
    """Replays a streaming DataFrame to its end into a fresh table under the checkpoint root; returns the path.

    ``state_partitions`` sizes the state (default: the session's shuffle
    partitions); size it to the stream's parallelism, not to batch volume.
    """
    out = scratch_path(df.sparkSession, name)
    start_table(df, f"{out}/data", f"{out}/checkpoint", fmt, state_partitions=state_partitions).awaitTermination()
    return f"{out}/data"


def run_updates_to_table(df: DataFrame, name: str, state_partitions: int | None = None) -> str:
    """``run_to_table`` in update mode; ``newest_updates`` gives the last state of each window."""
    out = scratch_path(df.sparkSession, name)
    start_updates(df, f"{out}/data", f"{out}/checkpoint", state_partitions=state_partitions).awaitTermination()
    return f"{out}/data"
