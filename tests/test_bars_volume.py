from decimal import Decimal

from pyspark.sql import functions as F

from candela.operators.bars import bars, bars_multi
from candela.operators.changelog import bars_changelog
from candela.operators.volume import volume_analytics
from candela.sources.adapter import load_trades

from .conftest import at, trade, trades_df

SF = "/root/testdata/sf0.001"


def test_window_boundary_is_half_open(spark):
    df = trades_df(spark, [trade(trade_id=1, t=at(59.999), price="1"), trade(trade_id=2, t=at(60), price="2")])
    rows = bars(df).orderBy("window_start").collect()
    assert [r.trade_count for r in rows] == [1, 1]
    assert rows[0].close == Decimal("1") and rows[1].open == Decimal("2")


def test_open_retaken_while_zero_and_pct_guard(spark):
    df = trades_df(spark, [
        trade(trade_id=1, t=at(1), price="0"), trade(trade_id=2, t=at(2), price="10"),
        trade(trade_id=3, t=at(3), price="12"),
    ])
    r = bars(df).first()
    assert r.open == Decimal("10") and r.close == Decimal("12")
    assert r.price_change_pct == Decimal("20.0000")
    only_zero = trades_df(spark, [trade(trade_id=1, t=at(1), price="0"), trade(trade_id=2, t=at(2), price="5")])
    r0 = bars(only_zero.filter(F.col("trade_id") == 1)).first()
    assert r0.open == 0 and r0.price_change_pct == 0


def test_open_close_by_time_then_id_not_input_order(spark):
    rows = [trade(trade_id=i, t=at(10), price=str(p)) for i, p in [(3, 30), (1, 10), (2, 20)]]
    r = bars(trades_df(spark, rows)).first()
    assert (r.open, r.close) == (Decimal("10"), Decimal("30"))


def test_large_trade_threshold_is_strict(spark):
    df = trades_df(spark, [
        trade(trade_id=1, t=at(1), price="9999.99", qty="1"),
        trade(trade_id=2, t=at(2), price="10000", qty="1"),
        trade(trade_id=3, t=at(3), price="10000.01", qty="1"),
    ])
    r = volume_analytics(df).first()
    assert r.large_trades == 1 and r.large_trade_volume == Decimal("10000.01")


def test_ratio_cutoffs_strict(spark):
    # buy share 0.6 -> NEUTRAL, 0.6001 -> BULLISH, 0.4 -> NEUTRAL, 0.3999 -> BEARISH; no volume -> 0.5
    cases = {"a": ("6000", "4000"), "b": ("6001", "3999"), "c": ("4000", "6000"), "d": ("3999", "6001"),
             "e": ("0", "0")}
    rows = []
    for k, (buy, sell) in cases.items():
        rows.append(trade(symbol=k, trade_id=1, t=at(1), price="1", qty=buy, maker=False))
        rows.append(trade(symbol=k, trade_id=2, t=at(2), price="1", qty=sell, maker=True))
    got = {r.symbol: (r.buy_volume_ratio, r.volume_trend) for r in volume_analytics(trades_df(spark, rows)).collect()}
    assert got["a"] == (Decimal("0.6000"), "NEUTRAL")
    assert got["b"] == (Decimal("0.6001"), "BULLISH")
    assert got["c"] == (Decimal("0.4000"), "NEUTRAL")
    assert got["d"] == (Decimal("0.3999"), "BEARISH")
    assert got["e"] == (Decimal("0.5000"), "NEUTRAL")


def test_bar_properties_on_events(spark):
    t = load_trades(spark, SF)
    b = bars(t, "1 hour")
    bad = b.filter((F.col("low") > F.col("open")) | (F.col("low") > F.col("close"))
                   | (F.col("high") < F.col("open")) | (F.col("high") < F.col("close")))
    assert bad.count() == 0
    v = volume_analytics(t, "1 hour")
    assert v.filter(F.col("buy_volume") + F.col("sell_volume") != F.col("total_volume")).count() == 0
    assert v.filter(F.col("buy_trades") + F.col("sell_trades") != F.col("total_trades")).count() == 0


def test_rollup_equals_direct(spark):
    t = load_trades(spark, SF)
    ivs = [("1m", "1 minute"), ("15m", "15 minutes"), ("1h", "1 hour"), ("1d", "1 day")]
    a = bars_multi(t, ivs, method="rollup")
    b = bars_multi(t, ivs, method="direct")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_last_changelog_row_is_final_bar(spark):
    t = load_trades(spark, SF)
    cl = bars_changelog(t, "1 hour", "1h", bucket_micros=60_000_000)
    last = cl.withColumn("_rk", F.row_number().over(
        __import__("pyspark.sql", fromlist=["Window"]).Window.partitionBy("symbol", "window_start").orderBy(F.desc("_ok"))
    )).filter("_rk = 1").drop("_rk", "_ok", "trade_id")
    final = bars(t, "1 hour", "1h")
    assert last.exceptAll(final).count() == 0 and final.exceptAll(last).count() == 0


def test_final_bars_ignore_input_order(spark):
    t = load_trades(spark, SF)
    shuffled = t.repartition(7, F.rand(3))
    assert bars(t).exceptAll(bars(shuffled)).count() == 0
