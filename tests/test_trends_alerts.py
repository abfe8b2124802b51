import random
from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from candela.functions.indicators import indicators
from candela.operators.alerts import all_alerts, latest_alerts, price_alerts, trend_alerts
from candela.operators.bars import bars, market_bars
from candela.operators.changelog import price_history
from candela.operators.trends import trends
from candela.sources.adapter import load_trades

from .conftest import T0

SF = "/root/testdata/sf0.001"


def closes_df(spark, closes, symbol="S"):
    rows = [(symbol, T0 + timedelta(minutes=i), T0 + timedelta(minutes=i + 1), Decimal(c)) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "symbol string, window_start timestamp, window_end timestamp, close decimal(18,8)")


@pytest.mark.parametrize("n", [4, 5, 9, 10, 14, 15, 29, 30, 31])
def test_indicator_gates(spark, n):
    rows = trends(closes_df(spark, [str(100 + i % 7) for i in range(n)])).orderBy("window_start").collect()
    last = rows[-1]
    assert (last.sma5 is not None) == (n >= 5)
    assert (last.ema5 is not None) == (n >= 5)
    assert (last.momentum is not None) == (n >= 10)
    assert (last.sma15 is not None) == (n >= 15)
    assert (last.rsi is not None) == (n >= 15)
    assert (last.sma30 is not None) == (n >= 30)


@pytest.mark.parametrize("closes,rsi,direction", [
    (["50"] * 31, Decimal("100"), "NEUTRAL"),
    ([str(10 + i) for i in range(31)], Decimal("100"), "BULLISH"),
    ([str(100 - i) for i in range(31)], Decimal("0"), "BEARISH"),
])
def test_flat_up_down(spark, closes, rsi, direction):
    last = trends(closes_df(spark, closes)).orderBy(F.desc("window_start")).first()
    assert last.rsi == rsi and last.trend_direction == direction
    assert last.trend_strength == "STRONG"


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_batch_trends_equal_exact_fold(spark, seed):
    rnd = random.Random(seed)
    closes = [f"{rnd.uniform(1, 500):.2f}" if rnd.random() > 0.1 else "0.01" for _ in range(80)]
    got = trends(closes_df(spark, closes)).orderBy("window_start").collect()
    hist = []
    for row, c in zip(got, closes):
        hist = (hist + [Decimal(c)])[-30:]
        want = indicators(hist)
        for k in ("sma5", "sma15", "sma30", "rsi", "momentum", "trend_direction", "trend_strength"):
            w = want[k]
            g = getattr(row, k)
            assert (g is None and w is None) or g == w, (k, g, w)
        for k in ("ema5", "ema15"):
            w, g = want[k], getattr(row, k)
            assert (g is None and w is None) or abs(g - w) < 1e-9 * max(1.0, abs(w))


def test_blocked_strategy_equals_direct(spark):
    b = bars(load_trades(spark, SF))
    d = trends(b)
    k = trends(b, strategy="blocked", block_rows=37)
    assert d.exceptAll(k).count() == 0 and k.exceptAll(d).count() == 0


def test_price_history_bounded(spark):
    h = price_history(closes_df(spark, [str(i + 1) for i in range(40)])).orderBy("window_start").collect()
    assert [r.history_size for r in h][:3] == [1, 2, 3] and h[-1].history_size == 30
    assert h[-1].oldest_price == Decimal("11") and h[-1].newest_price == Decimal("40")


def test_spike_thresholds(spark):
    # pct 2.00 (no alert), 2.01 MEDIUM, 5.00 MEDIUM, 5.01 HIGH, -5.01 HIGH
    rows = []
    for i, pct in enumerate(["2.00", "2.01", "5.00", "5.01", "-5.01"]):
        close = Decimal(100) + Decimal(pct)
        rows.append((f"S{i}", T0, T0 + timedelta(minutes=1), Decimal(100), close, Decimal(pct)))
    df = spark.createDataFrame(rows, "symbol string, window_start timestamp, window_end timestamp, open decimal(18,8),"
                                     " close decimal(18,8), price_change_pct decimal(38,4)")
    got = {r.symbol: (r.severity, r.message) for r in price_alerts(df).collect()}
    assert "S0" not in got
    assert got["S1"] == ("MEDIUM", "S1 price changed by 2.01% in 1 minute")
    assert got["S2"][0] == "MEDIUM" and got["S3"][0] == "HIGH" and got["S4"][0] == "HIGH"
    assert got["S4"][1] == "S4 price changed by -5.01% in 1 minute"


def test_exclusive_alert_pairs_and_top20(spark):
    t = load_trades(spark, SF)
    m = market_bars(t)
    mt = trends(m, extra=[c for c in m.columns if c not in ("symbol", "window_start")])
    a = all_alerts(mt)
    pairs = [("GOLDEN_CROSS", "DEATH_CROSS"), ("OVERBOUGHT", "OVERSOLD"), ("HEAVY_BUYING", "HEAVY_SELLING")]
    per_row = a.groupBy("symbol", "timestamp").agg(F.collect_set("alert_type").alias("types")).collect()
    for r in per_row:
        for x, y in pairs:
            assert not (x in r.types and y in r.types)
    top = latest_alerts(a, 20)
    assert top.groupBy("symbol").count().filter("count > 20").count() == 0
    assert trend_alerts(trends(bars(t))).count() == a.filter(
        F.col("alert_type").isin("GOLDEN_CROSS", "DEATH_CROSS", "OVERBOUGHT", "OVERSOLD")).count()
