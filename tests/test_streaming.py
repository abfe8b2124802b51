from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.functions.timecols import epoch_micros

from candela.operators.bars import bars
from candela.operators.trends import trends
from candela.session import scratch_path
from candela.sources.adapter import read_table
from candela.streaming.pipeline import (
    bars_stream,
    run_to_table,
    stage_replay,
    trades_stream_from_events,
    trends_stream,
)

SF = "/root/testdata/sf0.001"


def _staged_in_batches(spark, parts: int = 3) -> str:
    """Events split by time into ``parts`` files written one after another (increasing mtimes)."""
    ev = read_table(spark, SF, "events")
    path = scratch_path(spark, "events-batches")
    bounds = ev.selectExpr("percentile_approx(event_id, array(0.33, 0.66)) AS q").first().q
    cuts = [-1, *bounds, 10**18]
    for i in range(parts):
        chunk = ev.filter((F.col("event_id") > cuts[i]) & (F.col("event_id") <= cuts[i + 1]))
        chunk.coalesce(1).write.mode("append").parquet(path)
    return path


def _as_batch(df):
    return df.select(*[F.unix_micros(c).alias(c) if t == "timestamp" else F.col(c) for c, t in df.dtypes])


def test_stream_bars_equal_batch_closed_windows(spark):
    src = _staged_in_batches(spark)
    out = run_to_table(bars_stream(trades_stream_from_events(spark, src, max_files_per_trigger=1)), "t-bars")
    got = _as_batch(spark.read.parquet(out))
    ev = read_table(spark, SF, "events")
    max_ts = ev.agg(F.max("ts")).first()[0]
    from candela.sources.adapter import trades_from_events

    want = bars(trades_from_events(ev)).filter(F.col("window_end") <= F.lit(max_ts))
    want = want.select(*[
        (epoch_micros(F.col(c), T.TimestampNTZType()) if t == "timestamp_ntz" else F.col(c)).alias(c)
        for c, t in want.dtypes
    ])
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_stream_trends_state_across_batches_and_restart(spark):
    src = _staged_in_batches(spark)
    out_dir = scratch_path(spark, "t-trends")
    def start():
        q = (
            trends_stream(bars_stream(trades_stream_from_events(spark, src, max_files_per_trigger=1)))
            .writeStream.format("parquet").option("path", f"{out_dir}/data")
            .option("checkpointLocation", f"{out_dir}/ckpt").outputMode("append").trigger(availableNow=True).start()
        )
        q.awaitTermination()
    start()
    first = spark.read.parquet(f"{out_dir}/data").count()
    start()  # restart from the checkpoint: no new input, no duplicate output
    got = spark.read.parquet(f"{out_dir}/data")
    assert got.count() == first
    ev = read_table(spark, SF, "events")
    from candela.sources.adapter import trades_from_events

    batch = trends(bars(trades_from_events(ev)))
    max_ts = ev.agg(F.max("ts")).first()[0]
    batch = batch.filter(F.col("timestamp") <= F.lit(max_ts))
    assert got.count() == batch.count()
    g = got.select("symbol", F.unix_micros("window_start").alias("w"), "sma15", "rsi", "trend_direction",
                   F.round("ema15", 6).alias("e"))
    b = batch.select("symbol", F.unix_micros(F.col("window_start").cast("timestamp")).alias("w"), "sma15", "rsi",
                     "trend_direction", F.round("ema15", 6).alias("e"))
    assert g.exceptAll(b).count() == 0


def test_stage_replay_roundtrip(spark):
    ev = read_table(spark, SF, "events")
    path = stage_replay(ev, "t-replay", files=3)
    assert spark.read.parquet(path).count() == ev.count()
    assert len(spark.read.parquet(path).inputFiles()) == 3


def test_update_mode_last_update_is_final_bar(spark):
    from pyspark.sql import Window

    from candela.streaming.pipeline import run_updates_to_table
    from candela.sources.adapter import trades_from_events

    src = _staged_in_batches(spark)
    path = run_updates_to_table(bars_stream(trades_stream_from_events(spark, src, max_files_per_trigger=1)), "t-upd")
    upd = spark.read.parquet(path)
    assert upd.select("batch_id").distinct().count() >= 2
    w = Window.partitionBy("symbol", "window_start").orderBy(F.desc("batch_id"))
    last = upd.withColumn("_rk", F.row_number().over(w)).filter("_rk = 1").drop("_rk", "batch_id")
    last = last.select(*[F.unix_micros(c).alias(c) if t == "timestamp" else F.col(c) for c, t in last.dtypes])
    want = bars(trades_from_events(read_table(spark, SF, "events")))
    want = want.select(*[
        (epoch_micros(F.col(c), T.TimestampNTZType()) if t == "timestamp_ntz" else F.col(c)).alias(c)
        for c, t in want.dtypes
    ])
    assert last.count() == want.count()
    assert last.exceptAll(want).count() == 0


def test_stream_resumes_with_new_files(spark):
    """Stop after some files, add files, start again: the union equals the batch result, without duplicates."""
    from candela.sources.adapter import trades_from_events
    from candela.streaming.pipeline import start_table

    ev = read_table(spark, SF, "events")
    src, out = scratch_path(spark, "resume-in"), scratch_path(spark, "resume-out")
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass")}

    def start():
        rows = bars_stream(trades_stream_from_events(spark, src, max_files_per_trigger=1))
        q = start_table(rows, f"{out}/data", f"{out}/checkpoint", state_partitions=2)
        q.awaitTermination()

    middle = ev.selectExpr("percentile_approx(event_id, 0.5) AS q").first().q
    ev.filter(F.col("event_id") <= middle).coalesce(1).write.mode("append").parquet(src)
    start()
    first = spark.read.parquet(f"{out}/data").count()
    ev.filter(F.col("event_id") > middle).coalesce(1).write.mode("append").parquet(src)
    start()
    assert before == {k: spark.conf.get(k, None) for k in before}
    got = spark.read.parquet(f"{out}/data")
    max_ts = ev.agg(F.max("ts")).first()[0]
    want = bars(trades_from_events(ev)).filter(F.col("window_end") <= F.lit(max_ts))
    assert 0 < first < got.count() == want.count()
    key = lambda df: sorted((r.symbol, str(r.window_start), r.close, r.volume, r.trade_count) for r in df.collect())
    assert key(got) == key(want)


def test_running_stream_returns_its_query(spark):
    from candela.streaming.pipeline import start_table

    src, out = _staged_in_batches(spark, 1), scratch_path(spark, "live")
    q = start_table(bars_stream(trades_stream_from_events(spark, src)), f"{out}/data", f"{out}/checkpoint", available_now=False)
    try:
        assert q.isActive
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(f"{out}/data").count() > 0


def test_alert_stream_has_one_scan_and_one_aggregation(spark):
    from candela.operators.alerts import all_alerts
    from candela.streaming.pipeline import market_stream

    src = _staged_in_batches(spark, 1)
    market = market_stream(trades_stream_from_events(spark, src))
    rows = all_alerts(trends_stream(market, [c for c in market.columns if c not in ("symbol", "window_start")]))
    plan = rows._jdf.queryExecution().analyzed().toString()
    assert plan.count("StreamingRelation") == 1 and plan.count("Aggregate [") == 1


def test_columns_equal_the_fold():
    import random
    from decimal import Decimal

    from candela.functions.indicators import indicator_columns, indicators

    rng = random.Random(5)
    for kind in range(6):
        closes = [Decimal(rng.randint(0, 3) if kind == 0 else 5 if kind == 1 else rng.randint(1, 10**12)).scaleb(-rng.randint(0, 8)) for _ in range(70)]
        for past in (0, 7, 30):
            got = indicator_columns(closes[: past + 40], past)
            for i in range(40):
                want = indicators(closes[max(0, past + i - 29) : past + i + 1])
                for name, value in want.items():
                    have = got[name][i]
                    if name.startswith("ema") and value is not None:
                        assert abs(have - value) <= 1e-9 * max(1.0, abs(value))
                    else:
                        assert have == value, (kind, past, i, name)
