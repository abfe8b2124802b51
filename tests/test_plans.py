"""Plan shapes behind the scale claims (read from the executed physical plan)."""

from candela.operators.alerts import all_alerts
from candela.operators.bars import bars, bars_multi, market_bars
from candela.operators.trends import trends
from candela.operators.views import latest_snapshot, symbol_series
from candela.schemas import PRICE_INTERVALS
from candela.sources.adapter import trades_from_events

EVENTS = "/root/testdata/sf0.01/events.parquet"


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def _count(plan: str, token: str) -> int:
    return plan.count(token)


def _trades(spark):
    return trades_from_events(spark.read.parquet(EVENTS))


def test_bars_one_exchange_hash_aggregate_pruned_scan(spark):
    p = _plan(bars(_trades(spark)))
    assert _count(p, "Exchange hashpartitioning") == 1
    assert "SortAggregate" not in p and "HashAggregate" in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double,props:string>" in p


def test_rollup_scans_trades_once(spark):
    p = _plan(bars_multi(_trades(spark), PRICE_INTERVALS, method="rollup"))
    assert _count(p, "FileScan") == 1
    assert _count(p, "Exchange hashpartitioning") == 2


def test_trends_add_one_exchange_after_bars(spark):
    p = _plan(trends(bars(_trades(spark))))
    assert _count(p, "Exchange hashpartitioning") == 2  # bars (symbol, window) + trends (symbol)


def test_alerts_all_one_aggregation_one_window(spark):
    m = market_bars(_trades(spark))
    t = trends(m, extra=[c for c in m.columns if c not in ("symbol", "window_start")])
    p = _plan(all_alerts(t))
    assert _count(p, "FileScan") == 1
    assert _count(p, "Exchange hashpartitioning") == 2
    assert "Generate" in p


def test_latest_snapshot_trends_only_the_tail(spark):
    p = _plan(latest_snapshot(market_bars(_trades(spark))))
    assert "WindowGroupLimit" in p  # last 30 bars per symbol, limited before the shuffle
    assert _count(p, "Exchange hashpartitioning") == 2


def test_symbol_filter_reaches_the_scan(spark):
    p = _plan(bars(symbol_series(_trades(spark), "purchase")))
    scan = [line for line in p.splitlines() if "FileScan" in line][0]
    assert "EqualTo(event_type,purchase)" in scan


def test_no_python_in_batch_plans(spark):
    m = market_bars(_trades(spark))
    t = trends(m, extra=[c for c in m.columns if c not in ("symbol", "window_start")])
    p = _plan(all_alerts(t))
    assert "Python" not in p and "ArrowEval" not in p and "BatchEval" not in p


def test_top20_needs_no_new_exchange(spark):
    from candela.operators.alerts import latest_alerts

    m = market_bars(_trades(spark))
    t = trends(m, extra=[c for c in m.columns if c not in ("symbol", "window_start")])
    p = _plan(latest_alerts(all_alerts(t), 20))
    assert "WindowGroupLimit" in p
    # alerts keep the trend window's partitioning by symbol: still only the two exchanges
    assert _count(p, "Exchange hashpartitioning") == 2


def test_decode_parses_once_and_filters_after_the_parse(spark):
    from candela.sources.decode import decode_trades
    from candela.sources.wire import replay_messages

    msgs = replay_messages(spark.read.parquet(EVENTS))
    p = _plan(decode_trades(msgs, keep=["seq"]))
    # top-level lower/upper parses + the envelope's inner object (lower/upper): four from_json in all
    assert _count(p, "from_json(") == 4
    lines = p.splitlines()
    gen = next(i for i, line in enumerate(lines) if "Generate" in line)
    flt = next(i for i, line in enumerate(lines) if "Filter" in line and "reason" in line)
    assert flt < gen  # the filter on reason sits above the Generate (printed first), not pushed into the parse


def test_registered_queries_have_the_operators_own_exchanges(spark):
    import __spark_entry__ as entry

    for name, n in {"bars_1m": 1, "bars_all": 2, "trends": 2, "alerts_all": 2, "stream_catalog": 1}.items():
        p = _plan(entry.queries()[name](spark, "/root/testdata/sf0.01"))
        assert _count(p, "Exchange hashpartitioning") == n, name
        assert "REPARTITION" not in p, name
        assert _count(p, "FileScan") == 1, name
