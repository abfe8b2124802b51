"""NULL keys and values in running scans, F1 on mixed intervals, publishing and wire text."""

from decimal import Decimal

from pyspark.sql import functions as F

from candela.operators.alerts import price_alerts
from candela.operators.bars import bars, bars_multi
from candela.operators.changelog import bars_changelog, price_history, strict_late_filter, trends_changelog
from candela.operators.trends import trends
from candela.operators.views import latest_snapshot
from candela.operators.bars import market_bars
from candela.plans.publish import publish
from candela.sources.decode import decode_trades
from candela.sources.wire import to_wire

from .conftest import at, trade, trades_df


def _with(rows):
    out = []
    for symbol, i, second, price, qty in rows:
        r = list(trade(symbol, i, at(second), price, "1"))
        r[5] = None if qty is None else Decimal(qty)
        out.append(tuple(r))
    return out


def test_running_sum_survives_null_quantity(spark):
    t = trades_df(spark, _with([("A", 1, 0, "20", "1"), ("A", 2, 5, "11", "1"), ("A", 3, 20, "7", None)]))
    final = bars(t).collect()[0]
    rows = sorted(bars_changelog(t).collect(), key=lambda r: r.trade_id)
    for name in ("volume", "base_volume", "trade_count", "open", "high", "low", "close"):
        assert rows[-1][name] == final[name], name
    assert rows[-1].volume == Decimal(31)


def test_null_symbol_keeps_its_changelog_rows(spark):
    t = trades_df(spark, _with([("A", 1, 0, "20", "1"), (None, 2, 5, "11", "1"), (None, 3, 9, "12", "2"), ("A", 4, 30, "5", "1")]))
    assert bars_changelog(t).count() == 4 and trends_changelog(t, block_rows=50).count() == 4
    final = {r.symbol: r.volume for r in bars(t).collect()}
    last = {r.symbol: r.volume for r in sorted(bars_changelog(t).collect(), key=lambda r: r.trade_id)}
    assert final == last == {"A": Decimal(25), None: Decimal(35)}


def test_null_part_is_a_source_of_its_own(spark):
    t = trades_df(spark, _with([("A", 1, 10, "1", "1"), ("A", 2, 120, "1", "1"), ("A", 3, 20, "1", "1")]))
    t = t.withColumn("arrival_seq", F.col("trade_id")).withColumn("part", F.lit(None).cast("bigint"))
    assert sorted(r.trade_id for r in strict_late_filter(t).collect()) == [1, 2]
    alone = t.withColumn("part", F.when(F.col("trade_id") == 3, F.lit(None)).otherwise(F.lit(1)).cast("bigint"))
    assert strict_late_filter(alone).count() == 3


def _minutes(spark, n):
    return trades_df(spark, _with([("A", i, 60 * i, str(100 + (i * 7) % 13), "1") for i in range(n)]))


def test_only_minute_rows_feed_trends_and_alerts(spark):
    t = _minutes(spark, 40)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(trends(bars_multi(t))) == key(trends(bars(t)))
    assert key(price_alerts(bars_multi(t))) == key(price_alerts(bars(t)))
    assert trends(bars_multi(t), interval=None).count() == bars_multi(t).count()
    sizes = {(r.window_start, r.history_size) for r in price_history(bars_multi(t)).collect()}
    assert {(r.window_start, r.history_size) for r in price_history(bars(t)).collect()} <= sizes


def test_snapshot_has_all_it_needs(spark):
    row = latest_snapshot(market_bars(_minutes(spark, 40), label="1m")).collect()[0]
    assert row.rsi == [r.rsi for r in sorted(trends(bars(_minutes(spark, 40))).collect(), key=lambda r: r.timestamp)][-1]


def test_published_at_full_scale(spark):
    df = spark.createDataFrame([(Decimal("0.0000000012345"),)], "notional decimal(38,16)")
    assert publish(df).first().notional == 1.2345e-9


def test_wire_text_escapes_everything(spark):
    names = ["tab\there", 'quote" back\\slash', "new\nline \u0001 é😀", "plain"]
    t = trades_df(spark, [trade(n, i, at(i)) for i, n in enumerate(names)])
    sent = t.select(to_wire(t).alias("value"))
    assert sorted(r.symbol for r in decode_trades(sent).collect()) == sorted(names)
