from decimal import Decimal

from pyspark.sql import functions as F

from candela.operators.changelog import strict_late_filter
from candela.sources.decode import decode_trades, quarantine
from candela.sources.io import from_records, to_records
from candela.sources.synthetic import synthetic_trades

from .conftest import at, trade, trades_df

FLAT = '{"e":"trade","E":1704067200100,"s":"BTCUSDT","t":7,"p":"42000.10","q":"0.5","b":1,"a":2,"T":1704067200000,"m":true}'
CASES = {
    "flat": FLAT,
    "enveloped": '{"stream":"btcusdt@trade","data":' + FLAT + "}",
    "numbers": FLAT.replace('"p":"42000.10"', '"p":42000.10').replace('"q":"0.5"', '"q":0.5'),
    "extra_M": FLAT[:-1] + ',"M":true}',
    "no_E": FLAT.replace('"E":1704067200100,', ""),
    "no_p": FLAT.replace('"p":"42000.10",', ""),
    "m_null": FLAT.replace('"m":true', '"m":null'),
    "other_event": FLAT.replace('"e":"trade"', '"e":"aggTrade"'),
    "envelope_no_data": '{"stream":"btcusdt@trade"}',
    "garbage": "not json at all",
    "empty": "",
    "json_array": "[1, 2]",
    "json_scalar": "42",
    "stream_in_symbol": FLAT.replace('"s":"BTCUSDT"', '"s":"BTC\\"stream\\":"'),
}


def test_decode_cases(spark):
    msgs = spark.createDataFrame([(k, v) for k, v in CASES.items()], "case string, value string")
    ok = {r.case: r for r in decode_trades(msgs, keep=["case"]).collect()}
    bad = {r.case: r.reason for r in quarantine(msgs, keep=["case"]).collect()}
    assert set(ok) == {"flat", "enveloped", "numbers", "extra_M", "no_E", "stream_in_symbol"}
    assert bad == {"no_p": "missing_p", "m_null": "missing_m", "other_event": "not_trade",
                   "envelope_no_data": "envelope_without_data", "garbage": "not_json", "empty": "not_json",
                   "json_array": "not_json", "json_scalar": "not_json"}
    f = ok["flat"]
    assert f.price == Decimal("42000.10") and f.quantity == Decimal("0.5") and f.is_buyer_maker is True
    assert ok["numbers"].price == f.price and ok["enveloped"].trade_id == 7
    assert ok["no_E"].event_time is None and ok["stream_in_symbol"].symbol == 'BTC"stream":'
    assert f.trade_time is not None


def test_records_round_trip(spark):
    df = trades_df(spark, [trade(trade_id=1, t=at(1), price="1.5", qty="2"), trade(trade_id=2, t=at(2), price="3")])
    rec = to_records(df)
    assert rec.columns == ["key", "value"]
    back = from_records(rec, df.schema).drop("key")
    assert back.exceptAll(df).count() == 0


def test_synthetic_band(spark):
    s = synthetic_trades(spark.range(3000), id_col="id", time_col="id").collect()
    for r in s:
        base = {"BTCUSDT": 45000, "ETHUSDT": 2500, "BNBUSDT": 400}[r.symbol]
        assert abs(r.price - base) <= Decimal(base) * Decimal("0.0005") + Decimal("0.005")
        assert Decimal(10) <= r.quantity < Decimal(60)


def test_strict_late_filter_fixture(spark):
    # arrivals (minutes): 0:10, 2:00, 0:20, then 0:30, 5:00, then 9:00 -> keeps 0:10, 2:00, 5:00, 9:00
    arrivals = [10, 120, 20, 30, 300, 540]
    rows = [trade(trade_id=i, t=at(sec)) for i, sec in enumerate(arrivals)]
    df = trades_df(spark, rows).withColumn("arrival_seq", F.col("trade_id")).withColumn("part", F.lit(0))
    kept = strict_late_filter(df, "1 minute", bucket_rows=2).orderBy("arrival_seq").collect()
    assert [r.trade_id for r in kept] == [0, 1, 4, 5]
