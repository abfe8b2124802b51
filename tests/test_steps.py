"""Streams with carried tables: any cutting into micro-batches, restarts and repeated batches give the batch rows."""

from __future__ import annotations

import random
from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.functions.timecols import epoch_micros
from candela.operators import views
from candela.operators.alerts import latest_alerts
from candela.operators.bars import bars, finish_bars
from candela.operators.changelog import (
    bars_changelog,
    bars_changelog_ticks,
    coalesced,
    market_rows,
    price_history,
    running_partials,
    strict_late_filter,
    trends_changelog,
    volume_changelog,
)
from candela.operators.partials import merge_partials, trade_partials
from candela.operators.trends import trends
from candela.operators.volume import volume_analytics
from candela.session import scratch_path
from candela.sources.adapter import load_trades, read_table
from candela.sources.decode import decode_trades, quarantine, quarantined, trades_of
from candela.sources.io import read_series, store_series
from candela.sources.wire import replay_messages
from candela.streaming import steps
from candela.streaming.batches import (
    KEPT_VERSIONS,
    BatchTables,
    batch_ids,
    newest_rows,
    read_carried,
    read_output,
    replay_in_parts,
)
from candela.streaming.health import feed_status_stream
from candela.streaming.pipeline import run_to_table
from candela.streaming.steps import changelog_step, decode_step, market_step, strict_bars_step, trailing_step
from tests.conftest import T0, at, trade, trades_df

SF = "/root/testdata/sf0.001"


def same(a, b) -> None:
    b = b.select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def micros(df, column: str = "trade_time"):
    return epoch_micros(F.col(column), df.schema[column].dataType)


def plain(df):
    return df.select(*[F.col(c) if not isinstance(t.dataType, T.DecimalType) else F.col(c).cast("string").alias(c)
                       for c, t in zip(df.columns, df.schema.fields)])


# ---------------------------------------------------------------- W5

@pytest.mark.parametrize("parts", [1, 4])
def test_strict_lateness_on_a_stream(spark, parts):
    trades = load_trades(spark, SF)
    path = replay_in_parts(trades, F.col("arrival_seq"), strict_bars_step("1 hour"), "t-strict", parts)
    want = strict_late_filter(trades, "1 hour")
    assert 0 < want.count() < trades.count()
    same(read_output(spark, path, "kept"), want)
    same(finish_bars(merge_partials(read_output(spark, path, "partials")), "1h"), bars(want, "1 hour", "1h"))


def test_clock_is_kept_for_null_partitions(spark):
    rows = [(T0 + timedelta(minutes=m), i, part) for i, (m, part) in enumerate([(0, None), (5, None), (1, None), (1, 7), (3, None), (9, 7), (2, 7)])]
    df = spark.createDataFrame(rows, "trade_time timestamp_ntz, trade_id long, part long")
    df = df.select("*", F.lit("A").alias("symbol"), F.col("trade_id").alias("arrival_seq"), F.lit(1).cast("decimal(18,8)").alias("price"),
                   F.lit(1).cast("decimal(18,8)").alias("quantity"), F.lit(True).alias("is_buyer_maker"))
    path = replay_in_parts(df, F.col("trade_id"), strict_bars_step(), "t-null-part", 3)
    kept = {r.trade_id for r in read_output(spark, path, "kept").collect()}
    assert kept == {r.trade_id for r in strict_late_filter(df).collect()} == {0, 1, 3, 5}


# ---------------------------------------------------------------- W4, T8

def test_changelog_with_restarts(spark):
    parts, trades = 3, load_trades(spark, SF)
    path = replay_in_parts(trades, micros(trades), changelog_step(block_rows=64), "t-changelog", parts)
    emissions = read_output(spark, path, "emissions")
    want = bars_changelog(trades)
    same(plain(market_rows(emissions, "1m").select(*want.columns)), plain(want))
    volume = volume_changelog(trades)
    same(plain(market_rows(emissions, "1m").select(*volume.columns)), plain(volume))
    want = trends_changelog(trades, block_rows=64)
    got = read_output(spark, path, "market").select(*want.columns)
    same(plain(got.drop("ema5", "ema15")), plain(want.drop("ema5", "ema15")))
    assert read_carried(spark, path, "tail").groupBy("symbol").count().agg(F.max("count")).first()[0] <= 29


def test_changelog_derives_bar_columns_after_the_windows(spark, monkeypatch):
    met = []
    monkeypatch.setattr(steps, "trends", lambda rows, **options: met.append((rows.columns, options["extra"])) or trends(rows, **options))
    rows = [trade(trade_id=i, t=at(7 * i), price=str(100 + i % 5)) for i in range(1, 80)]
    df = trades_df(spark, rows)
    path = replay_in_parts(df, F.col("trade_id"), changelog_step(block_rows=40, retain="3 minutes"), "t-derived", 3)
    assert len(met) == 3 and all("vwap" not in columns and "vwap" not in extra for columns, extra in met)
    emissions, market = read_output(spark, path, "emissions"), read_output(spark, path, "market")
    want = market_rows(emissions, "1m")
    assert set(market.columns) == {*want.columns, "timestamp", "current_price", "sma5", "sma15", "sma30", "ema5", "ema15", "rsi",
                                   "momentum", "trend_direction", "trend_strength"} - {"_ok"}
    same(market.select(*(c for c in want.columns if c != "_ok")), want.drop("_ok"))
    last = newest_rows(emissions, ["symbol", "window_start"], "_ok")
    newest = last.agg(F.max("window_start")).first()[0]
    same(read_carried(spark, path, "windows"), last.filter(F.col("window_start") > F.lit(newest) - F.expr("INTERVAL 3 minutes")))


def test_sums_keep_all_sixteen_digits_across_batches(spark):
    rng = random.Random(4)
    rows = [trade(trade_id=i, t=at(i), price=str(Decimal(rng.randint(1, 10**9)).scaleb(-8)), qty=str(Decimal(rng.randint(1, 10**9)).scaleb(-8)))
            for i in range(1, 40)]
    df = trades_df(spark, rows)
    total = sum(r[4] * r[5] for r in rows)
    path = replay_in_parts(df, F.col("trade_id"), changelog_step("1 hour", with_trends=False), "t-digits", 2)
    last = read_output(spark, path, "emissions").orderBy(F.desc("_ok")).first()
    assert last.volume == total == running_partials(df, "1 hour").orderBy(F.desc("_ok")).first().volume


def test_unknown_quantities_leave_sums_as_the_final_bar_has_them(spark):
    rows = [trade(trade_id=1, t=at(1)), trade(trade_id=2, t=at(2))]
    df = trades_df(spark, rows).withColumn("quantity", F.when(F.col("trade_id") == 2, F.col("quantity")))
    first, last = volume_changelog(df).orderBy("trade_id").collect()
    assert first.buy_volume == first.sell_volume == first.large_trade_volume == 0
    final = volume_analytics(df).first()
    assert (last.buy_volume, last.sell_volume, last.total_volume) == (final.buy_volume, final.sell_volume, final.total_volume)


def test_repeated_batch_changes_nothing(spark):
    """A batch that Spark runs again (after a failure between its writes and its commit) replaces what it wrote."""
    trades = load_trades(spark, SF).cache()
    middle = trades.select(micros(trades).alias("us")).selectExpr("percentile_approx(us, 0.5) AS q").first().q
    halves = [trades.filter(micros(trades) <= middle), trades.filter(micros(trades) > middle)]
    once, twice = scratch_path(spark, "t-once"), scratch_path(spark, "t-twice")
    step = changelog_step("15 minutes", with_trends=False)
    for i, half in enumerate(halves):
        step(half, BatchTables(spark, once, i))
        for _ in range(2):
            step(half, BatchTables(spark, twice, i))
    same(plain(read_output(spark, twice, "emissions")), plain(read_output(spark, once, "emissions")))
    same(plain(read_carried(spark, twice, "windows")), plain(read_carried(spark, once, "windows")))
    trades.unpersist()


def test_old_versions_are_dropped(spark):
    rows = spark.range(3).withColumn("name", F.lit("x"))
    path = scratch_path(spark, "t-versions")
    for i in range(5):
        tables = BatchTables(spark, path, i)
        before = tables.carried("t", rows.schema).count()
        assert before == (3 if i else 0)
        tables.carry("t", rows)
    assert batch_ids(spark, f"{path}/t") == list(range(5 - KEPT_VERSIONS, 5))


# ---------------------------------------------------------------- coalescing

def test_ticks_are_the_last_emission_of_each(spark):
    trades = load_trades(spark, SF)
    for tick, size in (("1 second", 10**6), ("10 minutes", 6 * 10**8)):
        want = market_rows(coalesced(running_partials(trades, "1 hour"), size), "1h")
        got = bars_changelog_ticks(trades, "1 hour", tick, "1h").drop("tick_start")
        same(plain(got), plain(want.select(*got.columns)))
    last = newest_rows(got, ["symbol", "window_start"], "trade_id").drop("trade_id")
    final = bars(trades, "1 hour", "1h")
    same(plain(last.select(*final.columns)), plain(final))


def test_coalescing_combines_trades_before_the_shuffle(spark):
    plan = bars_changelog_ticks(load_trades(spark, SF), "1 hour", "10 minutes")._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Python" not in plan


def test_partials_merge_in_any_grouping(spark):
    trades = load_trades(spark, SF)
    whole = trade_partials(trades, "1 hour", keep_order=True)
    parts = [trade_partials(trades.filter(F.col("trade_id") % 3 == i), "1 hour", keep_order=True) for i in range(3)]
    left = merge_partials(merge_partials(parts[2].unionByName(parts[0])).unionByName(parts[1]))
    same(plain(left), plain(whole))
    assert left.schema == whole.schema or [f.dataType for f in left.schema] == [f.dataType for f in whole.schema]


# ---------------------------------------------------------------- final bars: T7, W6, L10, A13, S9

def test_two_million_rows_of_one_symbol_in_one_batch(spark):
    """Blocks of 100,000 rows and their halo are all that a task holds, and no Python worker holds any."""
    n, first = 2_000_100, 100
    base = spark.range(n).select(
        F.lit("HOT").alias("symbol"), F.lit("1m").alias("interval"),
        F.timestamp_seconds(F.col("id") * 60).alias("window_start"), F.timestamp_seconds(F.col("id") * 60 + 60).alias("window_end"),
        (F.lit(100) + F.pmod(F.xxhash64("id"), F.lit(10_000)) / F.lit(100)).cast("decimal(18,8)").alias("close"), "id",
    )
    path = scratch_path(spark, "t-hot")
    step = market_step(history=True, indicators=False)
    step(base.filter(F.col("id") < first).drop("id"), BatchTables(spark, path, 0))
    step(base.filter(F.col("id") >= first).drop("id"), BatchTables(spark, path, 1))

    def digest(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()

    history = read_output(spark, path, "history")
    assert digest(history) == digest(price_history(base.drop("id")).select(*history.columns))
    plan = price_history(base, strategy="blocked")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "_blk" in plan


@pytest.mark.parametrize("cut", [7, 400])
def test_indicators_go_on_from_the_carried_bars(spark, cut):
    b = bars(load_trades(spark, SF))
    ranked = b.withColumn("n", F.expr("row_number() OVER (PARTITION BY symbol ORDER BY window_start)"))
    path = scratch_path(spark, "t-tail")
    step = market_step(block_rows=64)
    step(ranked.filter(F.col("n") <= cut).drop("n"), BatchTables(spark, path, 0))
    step(ranked.filter(F.col("n") > cut).drop("n"), BatchTables(spark, path, 1))
    want = trends(b).drop("ema5", "ema15")
    same(plain(read_output(spark, path, "market").select(*want.columns)), plain(want))


def test_blocked_history_equals_direct(spark):
    b = bars(load_trades(spark, SF))
    same(price_history(b, strategy="blocked", block_rows=31), price_history(b))


def test_newest_alerts_have_defined_ties(spark):
    rows = [("A", "T", "HIGH", f"m{i % 3}", T0, {"k": str(i)}) for i in range(30)]
    df = spark.createDataFrame(rows, "symbol string, alert_type string, severity string, message string, timestamp timestamp_ntz, metadata map<string,string>")
    top = [sorted(map(str, latest_alerts(df.repartition(n), 20).collect())) for n in (1, 5)]
    halves = latest_alerts(df.filter("message = 'm1'"), 20).unionByName(latest_alerts(df.filter("message <> 'm1'"), 20))
    assert top[0] == top[1] == sorted(map(str, latest_alerts(halves, 20).collect())) and len(top[0]) == 20


# ---------------------------------------------------------------- F4, S4, S9/F5

def test_trailing_buffer_is_evicted(spark):
    trades = views.trade_projection(load_trades(spark, SF))
    path = replay_in_parts(trades, micros(trades), trailing_step(minutes=300), "t-trailing", 4)
    want = views.trailing_window(trades, minutes=300)
    same(read_carried(spark, path, "buffer"), want)
    sizes = [spark.read.parquet(f"{path}/buffer/batch_id={i}").count() for i in batch_ids(spark, f"{path}/buffer")]
    assert 0 < want.count() < trades.count() / 20 and max(sizes) < trades.count() / 20


def test_trades_and_dead_letters_add_up(spark):
    messages = replay_messages(read_table(spark, SF, "events")).select("seq", "value")
    path = replay_in_parts(messages, F.col("seq"), decode_step(keep=["seq"]), "t-letters", 2)
    rows = read_output(spark, path, "messages")
    assert rows.count() == messages.count()
    same(trades_of(rows.filter("outcome = 'trade'"), ["seq"]), decode_trades(messages, keep=["seq"]))
    same(quarantined(rows.filter("outcome = 'dead_letter'"), ["seq"]), quarantine(messages, keep=["seq"]))
    before = rows.count()
    decode_step(keep=["seq"])(messages.filter(F.col("seq") < 10), BatchTables(spark, path, 99))
    decode_step(keep=["seq"])(messages.filter(F.col("seq") < 10), BatchTables(spark, path, 99))  # a repeat
    assert read_output(spark, path, "messages").count() == before + 10


def test_stored_series_reads_one_folder(spark):
    trades = load_trades(spark, SF)
    path = scratch_path(spark, "t-series")
    store_series(trades, path)
    one = read_series(spark, path, "purchase")
    same(one.select(*trades.columns), trades.filter(F.col("symbol") == "purchase"))
    scan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(" in scan and "purchase" in scan
    read = {r.f for r in one.select(F.input_file_name().alias("f")).distinct().collect()}
    assert read and all("route=purchase" in f for f in read)
    since = trades.selectExpr("min(trade_time) + INTERVAL 1 DAY AS t").first().t
    later = read_series(spark, path, "purchase", since=since)
    assert "GreaterThanOrEqual(trade_time" in later._jdf.queryExecution().executedPlan().toString()
    assert later.count() == trades.filter((F.col("symbol") == "purchase") & (F.col("trade_time") >= F.lit(since))).count()


# ---------------------------------------------------------------- A14

def test_feed_goes_down_in_silence_and_up_again(spark):
    """A falls silent for five minutes while B goes on: DOWN after 60 s without any row of A, UP with its next one."""
    rows = {("A", s) for s in (0, 30, 59, 400)} | {("B", s) for s in range(0, 420, 20)}
    df = spark.createDataFrame([(sym, T0 + timedelta(seconds=s)) for sym, s in sorted(rows)], "symbol string, time timestamp")
    source = scratch_path(spark, "t-feed")
    for low, high in ((0, 100), (100, 200), (200, 300), (300, 500)):
        part = df.filter((F.col("time") >= F.lit(T0 + timedelta(seconds=low))) & (F.col("time") < F.lit(T0 + timedelta(seconds=high))))
        part.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(source)
    path = run_to_table(feed_status_stream(stream, time_col="time"), "t-status")
    found = sorted((r.symbol, (r.at - T0).total_seconds(), r.status, r.message_count) for r in spark.read.parquet(path).collect())
    assert found == [("A", 0, "UP", 1), ("A", 119, "DOWN", 3), ("A", 400, "UP", 4), ("B", 0, "UP", 1)]
