"""Independent DuckDB SQL for every registered query.

Written from the operator definitions (module docstrings of
``candela.operators``), not from the DataFrame plans. Exact decimals are
carried as HUGEINT integer units (notional sums as DECIMAL, published from their exact text); HALF_UP divisions use the integer recipe
``sign * ((2|n| + |d|) // (2|d|))``; decimals are published as
``units / 10^s`` in DOUBLE, the same single division the Spark side does.
"""

from __future__ import annotations

from decimal import Decimal

TRADES = """trades AS (
  SELECT 'trade' AS event_type, event_type AS symbol, event_id AS trade_id, ts AS trade_time,
         CAST(value AS DECIMAL(38,8)) AS price,
         CAST(json_extract_string(props, '$.k') AS DECIMAL(18,0)) AS quantity,
         (user_id % 2 = 0) AS is_buyer_maker,
         event_id + 13 * (event_id % 5) AS arrival_seq,
         user_id % 3 AS part
  FROM events)"""


def u8(x: str) -> str:
    """Decimal to integer 1e-8 units."""
    return f"CAST(({x}) * 100000000 AS HUGEINT)"


def d(q: str, scale: int = 8) -> str:
    """Integer units to DOUBLE."""
    return f"(CAST(({q}) AS DOUBLE) / {10**scale})"


def exact(x: str) -> str:
    """The DOUBLE nearest to an exact decimal of any scale: its text, parsed."""
    return f"CAST(CAST(({x}) AS VARCHAR) AS DOUBLE)"


def halfup(n: str, den: str) -> str:
    """HALF_UP(n / den) on integers."""
    return (
        f"(CASE WHEN ({den}) = 0 THEN NULL ELSE "
        f"(CASE WHEN (({n}) < 0) <> (({den}) < 0) THEN -1 ELSE 1 END) * "
        f"((2 * abs({n}) + abs({den})) // (2 * abs({den}))) END)"
    )


LABELS = {"1m": "1 minute", "5m": "5 minutes", "15m": "15 minutes", "1h": "1 hour", "1d": "1 day", "30s": "30 seconds"}


def bar_cte(iv: str, name: str = "bars", source: str = "trades") -> str:
    return f"""{name}_raw AS (
  SELECT symbol, time_bucket(INTERVAL '{iv}', trade_time) AS window_start,
         arg_min(price, (trade_time, trade_id)) FILTER (WHERE price <> 0) AS open_nz,
         arg_max(price, (trade_time, trade_id)) AS close,
         max(price) AS max_p, min(price) AS min_p,
         sum(price * quantity) AS volume, sum(quantity) AS base_volume, count(*) AS trade_count
  FROM {source} GROUP BY 1, 2),
{name} AS (
  SELECT symbol, window_start, window_start + INTERVAL '{iv}' AS window_end,
         COALESCE(open_nz, 0) AS open, greatest(max_p, 0) AS high, least(min_p, 999999999) AS low,
         close, volume, base_volume, trade_count
  FROM {name}_raw)"""


def bar_select(label: str, name: str = "bars") -> str:
    pct = halfup(f"{u8('close - open')} * 10000", u8("open"))
    return f"""SELECT symbol, '{label}' AS interval, window_start, window_end,
  {d(u8('open'))} AS open, {d(u8('high'))} AS high, {d(u8('low'))} AS low, {d(u8('close'))} AS close,
  {exact('volume')} AS volume, trade_count,
  {d(halfup(u8('volume'), 'trade_count'))} AS mean_notional,
  CASE WHEN base_volume > 0 THEN {d(halfup(u8('volume') + ' * 100000000', u8('base_volume')))} END AS vwap,
  {d(u8('close - open'))} AS price_change,
  CASE WHEN open = 0 THEN 0.0 ELSE {d(pct + ' * 100', 4)} END AS price_change_pct,
  {d(u8('base_volume'))} AS base_volume
FROM {name}"""


def bars_sql(label: str) -> str:
    return f"WITH {TRADES},\n{bar_cte(LABELS[label])}\n{bar_select(label)}"


def bars_all_sql(labels=("1m", "5m", "15m")) -> str:
    ctes = ",\n".join(bar_cte(LABELS[lab], f"b{lab}") for lab in labels)
    body = "\nUNION ALL\n".join(bar_select(lab, f"b{lab}") for lab in labels)
    return f"WITH {TRADES},\n{ctes}\n{body}"


def volume_cte(iv: str, name: str = "vol", threshold: str = "10000", source: str = "trades") -> str:
    return f"""{name} AS (
  SELECT symbol, time_bucket(INTERVAL '{iv}', trade_time) AS window_start,
         time_bucket(INTERVAL '{iv}', trade_time) + INTERVAL '{iv}' AS window_end,
         sum(price * quantity) AS total_volume,
         COALESCE(sum(price * quantity) FILTER (WHERE NOT is_buyer_maker), 0) AS buy_volume,
         COALESCE(sum(price * quantity) FILTER (WHERE is_buyer_maker), 0) AS sell_volume,
         count(*) AS total_trades,
         count(*) FILTER (WHERE NOT is_buyer_maker) AS buy_trades,
         count(*) FILTER (WHERE is_buyer_maker) AS sell_trades,
         count(*) FILTER (WHERE price * quantity > {threshold}) AS large_trades,
         COALESCE(sum(price * quantity) FILTER (WHERE price * quantity > {threshold}), 0) AS large_trade_volume
  FROM {source} GROUP BY 1, 2, 3),
{name}_m AS (
  SELECT *,
    CASE WHEN total_volume > 0 THEN {halfup(u8('buy_volume') + ' * 10000', u8('total_volume'))} ELSE 5000 END AS ratio_u,
    CASE WHEN total_trades > 0 THEN {halfup(u8('total_volume'), 'total_trades')} ELSE 0 END AS avg_u,
    CASE WHEN total_volume > 0 THEN {halfup(u8('large_trade_volume') + ' * 10000', u8('total_volume'))} ELSE 0 END AS large_u
  FROM {name})"""


def volume_select(label: str, name: str = "vol", threshold: str = "10000") -> str:
    return f"""SELECT symbol, '{label}' AS interval, window_start, window_end,
  {exact('total_volume')} AS total_volume, {exact('buy_volume')} AS buy_volume, {exact('sell_volume')} AS sell_volume,
  total_trades, buy_trades, sell_trades, large_trades, {exact('large_trade_volume')} AS large_trade_volume,
  CAST({threshold} AS DOUBLE) AS large_trade_threshold,
  {d('ratio_u', 4)} AS buy_volume_ratio, {d('avg_u')} AS average_trade_size,
  {d('large_u', 4)} AS large_trade_volume_ratio,
  CASE WHEN ratio_u > 6000 THEN 'BULLISH' WHEN ratio_u < 4000 THEN 'BEARISH' ELSE 'NEUTRAL' END AS volume_trend
FROM {name}_m"""


def volume_sql(label: str) -> str:
    return f"WITH {TRADES},\n{volume_cte(LABELS[label])}\n{volume_select(label)}"


def volume_all_sql(labels=("1m", "5m", "1h")) -> str:
    ctes = ",\n".join(volume_cte(LABELS[lab], f"v{lab}") for lab in labels)
    body = "\nUNION ALL\n".join(volume_select(lab, f"v{lab}") for lab in labels)
    return f"WITH {TRADES},\n{ctes}\n{body}"




# ---------------------------------------------------------------- trends

# 2 / (k + 1) rounded to eight digits.
EMA_ALPHA = {5: Decimal("0.33333333"), 15: Decimal("0.12500000")}


def ema_weight_literals(k: int) -> list[str]:
    """What a close j rows back weighs after k - 1 steps of ema + (close - ema) * a, begun with the oldest close."""
    a = EMA_ALPHA[k]
    weights = [a * (1 - a) ** j if j < k - 1 else (1 - a) ** j for j in range(k)]
    return [f"CAST('{float(w)!r}' AS DOUBLE)" for w in weights]


def trends_cte(source: str = "bars", order: str = "window_start", name: str = "tr") -> str:
    """Indicator columns over ``source`` (symbol, window_start, window_end, close) per symbol by ``order``."""
    win = f"PARTITION BY symbol ORDER BY {order}"
    ema = {}
    for k in (5, 15):
        terms = [f"{w} * lag(cd, {j}) OVER ({win})" for j, w in enumerate(ema_weight_literals(k))]
        ema[k] = " + ".join(terms)
    return f"""{name}_a AS (
  SELECT *, {u8('close')} AS cu, CAST({u8('close')} AS DOUBLE) / 100000000 AS cd FROM {source}),
{name}_b AS (
  SELECT *,
    row_number() OVER ({win}) AS n,
    sum(cu) OVER ({win} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS s5,
    sum(cu) OVER ({win} ROWS BETWEEN 14 PRECEDING AND CURRENT ROW) AS s15,
    sum(cu) OVER ({win} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS s30,
    {ema[5]} AS e5,
    {ema[15]} AS e15,
    cu - lag(cu, 9) OVER ({win}) AS mom_raw,
    cu - lag(cu, 1) OVER ({win}) AS dlt
  FROM {name}_a),
{name}_c AS (
  SELECT *,
    sum(CASE WHEN dlt > 0 THEN dlt ELSE 0 END) OVER ({win} ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS gain,
    sum(CASE WHEN dlt < 0 THEN -dlt ELSE 0 END) OVER ({win} ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS loss
  FROM {name}_b),
{name}_d AS (
  SELECT *,
    CASE WHEN n >= 5 THEN {halfup('s5', '5')} END AS sma5_u,
    CASE WHEN n >= 15 THEN {halfup('s15', '15')} END AS sma15_u,
    CASE WHEN n >= 30 THEN {halfup('s30', '30')} END AS sma30_u,
    CASE WHEN n >= 5 THEN e5 END AS ema5,
    CASE WHEN n >= 15 THEN e15 END AS ema15,
    CASE WHEN n >= 10 THEN mom_raw END AS mom_u,
    {halfup('gain', '14')} AS g_u, {halfup('loss', '14')} AS l_u
  FROM {name}_c),
{name}_e AS (
  SELECT *,
    CASE WHEN n < 15 THEN NULL WHEN l_u = 0 THEN 10000000000
         ELSE 10000000000 - {halfup('CAST(10000000000 AS HUGEINT) * 100000000', '100000000 + ' + halfup('g_u * 100000000', 'l_u'))} END AS rsi_u
  FROM {name}_d),
{name} AS (
  SELECT *,
    CASE WHEN sma5_u IS NULL OR sma15_u IS NULL THEN 'NEUTRAL'
         WHEN sma5_u > sma15_u AND cu > sma15_u THEN 'BULLISH'
         WHEN sma5_u < sma15_u AND cu < sma15_u THEN 'BEARISH' ELSE 'NEUTRAL' END AS trend_direction,
    CASE WHEN sma5_u IS NULL OR sma15_u IS NULL THEN 'WEAK'
         WHEN mom_u IS NULL OR rsi_u IS NULL THEN NULL
         WHEN abs({halfup('mom_u * 10000', 'cu')}) > 500 OR rsi_u > 7000000000 OR rsi_u < 3000000000 THEN 'STRONG'
         WHEN abs({halfup('mom_u * 10000', 'cu')}) > 200 THEN 'MODERATE' ELSE 'WEAK' END AS trend_strength
  FROM {name}_e)"""


TREND_OUT = {
    "trend_sma": ["sma5", "sma15", "sma30"],
    "trend_ema": ["ema5", "ema15"],
    "trend_rsi": ["rsi"],
    "trend_momentum": ["momentum"],
    "trend_direction": ["trend_direction", "trend_strength"],
    "trends": ["current_price", "sma5", "sma15", "sma30", "ema5", "ema15", "rsi", "momentum",
               "trend_direction", "trend_strength"],
}

TREND_EXPR = {
    "current_price": d("cu"),
    "sma5": d("sma5_u"), "sma15": d("sma15_u"), "sma30": d("sma30_u"),
    "ema5": "round(ema5, 6)", "ema15": "round(ema15, 6)",
    "rsi": d("rsi_u"), "momentum": d("mom_u"),
    "trend_direction": "trend_direction", "trend_strength": "trend_strength",
}


def trend_select(cols: list[str], name: str = "tr") -> str:
    sel = ", ".join(f"{TREND_EXPR[c]} AS {c}" for c in cols)
    return f"SELECT symbol, window_start, window_end AS timestamp, {sel} FROM {name}"


def trends_sql(query: str) -> str:
    return f"WITH {TRADES},\n{bar_cte('1 minute')},\n{trends_cte()}\n{trend_select(TREND_OUT[query])}"


def _add_trends(q: dict[str, str]) -> None:
    for name in TREND_OUT:
        q[name] = trends_sql(name)




# ---------------------------------------------------------------- alerts

def text_units(u: str, scale: int) -> str:
    """Integer units as plain decimal text with ``scale`` fraction digits."""
    step = "0." + "0" * (scale - 1) + "1"
    return f"CAST(CAST(({u}) AS DECIMAL(38,0)) * {step} AS VARCHAR)"


def fmt2(u: str, scale: int) -> str:
    """HALF_UP to two decimals, as text, of a value in 1e-scale units."""
    r = halfup(u, str(10 ** (scale - 2))) if scale > 2 else u
    return text_units(r, 2)


def text16(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(38,16)) AS VARCHAR)"


def market_ctes() -> str:
    """1-minute bars + volume measures + trend indicators per (symbol, minute) as CTE ``mk``."""
    return f"""{TRADES},
{bar_cte('1 minute')},
{volume_cte('1 minute')},
{trends_cte()},
mk AS (
  SELECT tr.*, v.total_volume, v.buy_volume, v.sell_volume, v.ratio_u, v.large_u, v.large_trade_volume,
         CASE WHEN tr.open = 0 THEN 0 ELSE {halfup(u8('tr.close - tr.open') + ' * 10000', u8('tr.open'))} * 100 END AS pct_u
  FROM tr JOIN vol_m v ON v.symbol = tr.symbol AND v.window_start = tr.window_start)"""


def price_alert_sql() -> str:
    return f"""SELECT symbol, 'PRICE_SPIKE' AS alert_type,
  CASE WHEN abs(pct_u) > 50000 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
  symbol || ' price changed by ' || {fmt2('pct_u', 4)} || '% in 1 minute' AS message,
  window_end AS timestamp,
  'currentPrice=' || CAST(close AS VARCHAR) || ';priceChange=' || {text_units('pct_u', 4)} AS metadata
FROM mk WHERE abs(pct_u) > 20000"""


def trend_alert_sql() -> str:
    sma_meta = f"'sma15=' || {text_units('sma15_u', 8)} || ';sma5=' || {text_units('sma5_u', 8)}"
    rsi_meta = f"'rsi=' || {text_units('rsi_u', 8)}"
    have = "sma5_u IS NOT NULL AND sma15_u IS NOT NULL"
    spread = "COALESCE(ema5 - ema15, 0.0)"
    return f"""SELECT symbol, 'GOLDEN_CROSS' AS alert_type, 'HIGH' AS severity,
  symbol || ': Golden cross detected - potential bullish reversal' AS message, window_end AS timestamp, {sma_meta} AS metadata
FROM mk WHERE {have} AND sma5_u - sma15_u > 0 AND {spread} <= 0
UNION ALL
SELECT symbol, 'DEATH_CROSS', 'HIGH', symbol || ': Death cross detected - potential bearish reversal', window_end, {sma_meta}
FROM mk WHERE {have} AND sma5_u - sma15_u < 0 AND {spread} >= 0
UNION ALL
SELECT symbol, 'OVERBOUGHT', 'MEDIUM', symbol || ': RSI ' || {fmt2('rsi_u', 8)} || ' - Overbought condition', window_end, {rsi_meta}
FROM mk WHERE rsi_u > 7000000000
UNION ALL
SELECT symbol, 'OVERSOLD', 'MEDIUM', symbol || ': RSI ' || {fmt2('rsi_u', 8)} || ' - Oversold condition', window_end, {rsi_meta}
FROM mk WHERE rsi_u < 3000000000"""


def volume_alert_sql() -> str:
    bs_meta = f"'buyVolume=' || {text16('buy_volume')} || ';sellVolume=' || {text16('sell_volume')}"
    return f"""SELECT symbol, 'WHALE_ACTIVITY' AS alert_type, 'HIGH' AS severity,
  symbol || ': Large trades account for ' || {text_units('large_u', 2)} || '% of volume' AS message,
  window_end AS timestamp,
  'largeTradeVolume=' || {text16('large_trade_volume')} || ';totalVolume=' || {text16('total_volume')} AS metadata
FROM mk WHERE large_u > 5000
UNION ALL
SELECT symbol, 'HEAVY_BUYING', 'MEDIUM', symbol || ': Heavy buying pressure - ' || {text_units('ratio_u', 2)} || '% buy volume',
  window_end, {bs_meta}
FROM mk WHERE ratio_u > 7000
UNION ALL
SELECT symbol, 'HEAVY_SELLING', 'MEDIUM', symbol || ': Heavy selling pressure - ' || {text_units('10000 - ratio_u', 2)} || '% sell volume',
  window_end, {bs_meta}
FROM mk WHERE ratio_u < 3000"""


def alerts_sql(kind: str) -> str:
    parts = {"alerts_price": [price_alert_sql()], "alerts_trend": [trend_alert_sql()],
             "alerts_volume": [volume_alert_sql()],
             "alerts_all": [price_alert_sql(), trend_alert_sql(), volume_alert_sql()]}[kind]
    return f"WITH {market_ctes()}\n" + "\nUNION ALL\n".join(parts)


def alerts_top20_sql() -> str:
    body = "\nUNION ALL\n".join([price_alert_sql(), trend_alert_sql(), volume_alert_sql()])
    return f"""WITH {market_ctes()},
al AS ({body})
SELECT symbol, alert_type, severity, message, timestamp, metadata FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC, alert_type) AS rk FROM al)
WHERE rk <= 20"""


def alert_channels_sql() -> str:
    body = "\nUNION ALL\n".join([price_alert_sql(), trend_alert_sql(), volume_alert_sql()])
    return f"""WITH {market_ctes()},
al AS ({body})
SELECT '/topic/alerts' AS channel, * FROM al
UNION ALL
SELECT '/topic/alerts/' || symbol AS channel, * FROM al"""


def _add_alerts(q: dict[str, str]) -> None:
    for k in ("alerts_price", "alerts_trend", "alerts_volume", "alerts_all"):
        q[k] = alerts_sql(k)
    q["alerts_top20"] = alerts_top20_sql()
    q["alert_channels"] = alert_channels_sql()




# ---------------------------------------------------------------- views

PROJ = f"""proj AS (
  SELECT symbol, trade_id, trade_time, price, quantity, price * quantity AS notional,
         CASE WHEN is_buyer_maker THEN 'sell' ELSE 'buy' END AS side
  FROM trades)"""

PROJ_SELECT = (f"SELECT symbol, trade_id, trade_time, {d(u8('price'))} AS price, {d(u8('quantity'))} AS quantity, "
               f"{exact('notional')} AS notional, side FROM proj")


def views_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    w = f"WITH {TRADES},\n{PROJ}\n"
    q["trade_projection"] = w + PROJ_SELECT
    q["valid_trades"] = w + PROJ_SELECT + " WHERE price > 0 AND quantity > 0 AND notional > 0"
    q["buysell_30s"] = w + f"""SELECT symbol, side, time_bucket(INTERVAL '30 seconds', trade_time) AS bucket_start,
  {exact('sum(notional)')} AS volume, count(*) AS trade_count
FROM proj WHERE price > 0 AND quantity > 0 AND notional > 0 GROUP BY 1, 2, 3"""
    pct = halfup(f"{u8('close - open')} * 10000", u8("open"))
    q["bar_change"] = f"""WITH {TRADES},
{bar_cte('1 hour')}
SELECT symbol, '1h' AS interval, window_start, {d(u8('open'))} AS open, {d(u8('close'))} AS close,
  {d(u8('close - open'))} AS price_change,
  CASE WHEN open = 0 THEN 0.0 ELSE {d(pct + ' * 100', 4)} END AS price_change_pct
FROM bars"""
    q["bars_vwap"] = f"""WITH {TRADES},
{bar_cte('1 hour')}
SELECT symbol, window_start, {exact('volume')} AS volume, {d(u8('base_volume'))} AS base_volume,
  CASE WHEN base_volume > 0 THEN {d(halfup(u8('volume') + ' * 100000000', u8('base_volume')))} END AS vwap,
  {d(halfup(u8('volume'), 'trade_count'))} AS mean_notional
FROM bars"""
    q["latest_snapshot"] = f"""WITH {market_ctes()},
last AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY window_start DESC) AS rk FROM mk)
SELECT symbol, '1m' AS interval, window_end, {d(u8('close'))} AS close, {d('pct_u', 4)} AS price_change_pct,
  {exact('volume')} AS volume, {d('rsi_u')} AS rsi, trend_direction, trend_strength,
  CASE WHEN pct_u >= 0 THEN 'up' ELSE 'down' END AS change_class
FROM last WHERE rk = 1"""
    q["feed_health"] = f"""WITH {TRADES},
h AS (SELECT symbol, count(*) AS message_count, max(trade_time) AS last_message_time FROM trades GROUP BY 1)
SELECT symbol, message_count, last_message_time,
  last_message_time > (SELECT max(trade_time) FROM trades) - INTERVAL '60 seconds' AS healthy,
  CASE WHEN last_message_time > (SELECT max(trade_time) FROM trades) - INTERVAL '60 seconds' THEN 'UP' ELSE 'DOWN' END AS status
FROM h"""
    q["feed_health_overall"] = f"""WITH {TRADES}
SELECT count(*) AS message_count, max(trade_time) AS last_message_time, true AS healthy, 'UP' AS status FROM trades"""
    q["feed_health_as_of"] = f"""WITH {TRADES},
h AS (SELECT count(*) AS message_count, max(trade_time) AS last_message_time FROM trades),
c AS (SELECT CAST(unnest([0, 59999999, 60000000, 3600000000]) AS BIGINT) AS after_us)
SELECT message_count, last_message_time, after_us, after_us < 60000000 AS healthy,
  CASE WHEN after_us < 60000000 THEN 'UP' ELSE 'DOWN' END AS status FROM h, c"""
    q["trailing_window"] = w + f"""SELECT symbol, trade_id, trade_time, {d(u8('price'))} AS price, {exact('notional')} AS notional
FROM proj WHERE trade_time > (SELECT max(trade_time) FROM trades) - INTERVAL '10 minutes'"""
    q["symbol_series"] = f"""WITH {TRADES},
{bar_cte('1 minute')}
SELECT symbol, window_start, {d(u8('open'))} AS open, {d(u8('high'))} AS high, {d(u8('low'))} AS low,
  {d(u8('close'))} AS close, {exact('volume')} AS volume, trade_count
FROM bars WHERE symbol = 'purchase'"""
    q["rsi_zone"] = f"""WITH {TRADES},
{bar_cte('1 minute')},
{trends_cte()}
SELECT symbol, window_start, {d('rsi_u')} AS rsi,
  CASE WHEN rsi_u > 7000000000 THEN 'overbought' WHEN rsi_u < 3000000000 THEN 'oversold'
       WHEN rsi_u IS NOT NULL THEN 'neutral' END AS rsi_zone
FROM tr"""
    fmt = []
    for div, suffix in ((10**9, "B"), (10**6, "M"), (10**3, "K")):
        r = halfup(f"{u8('volume')} * 100", str(div * 10**8))
        fmt.append(f"WHEN volume >= {div} THEN {text_units(r, 2)} || '{suffix}'")
    plain = text_units(halfup(f"{u8('volume')} * 100", str(10**8)), 2)
    q["format_volume"] = f"""WITH {TRADES},
{bar_cte('1 hour')}
SELECT symbol, window_start, {exact('volume')} AS volume,
  CASE {' '.join(fmt)} ELSE {plain} END AS volume_text
FROM bars"""
    q["stream_catalog"] = f"""WITH {TRADES},
s AS (SELECT DISTINCT symbol FROM trades)
SELECT 'prices' AS dataset, symbol, iv AS interval FROM s, (VALUES ('1m'), ('5m'), ('15m')) t(iv)
UNION ALL SELECT 'volume', symbol, iv FROM s, (VALUES ('1m'), ('5m'), ('1h')) t(iv)
UNION ALL SELECT 'trends', symbol, 'current' FROM s
UNION ALL SELECT 'alerts', symbol, iv FROM s, (VALUES ('all'), ('symbol-specific')) t(iv)"""
    return q




# ---------------------------------------------------------------- decode, sinks, synthetic

WIRE = """wire AS (
  SELECT event_id AS i, *, epoch_us(ts) // 1000 AS ms,
    CASE WHEN event_id % 50 = 0 AND (event_id // 50) % 4 IN (0, 1) THEN 'not_json'
         WHEN event_id % 50 = 0 AND (event_id // 50) % 4 = 2 THEN 'envelope_without_data'
         WHEN event_id % 11 = 3 THEN 'not_trade'
         WHEN event_id % 50 = 0 AND (event_id // 50) % 4 = 3 THEN 'missing_p'
         WHEN event_id % 50 = 17 THEN 'missing_m' END AS reason
  FROM events)"""


def decoded_select(with_seq: bool) -> str:
    price = d(u8("CAST(value AS DECIMAL(38,8))"))
    qty = d(u8("CAST(json_extract_string(props, '$.k') AS DECIMAL(18,0))"))
    seq = "i AS seq, " if with_seq else ""
    return f"""SELECT {seq}'trade' AS event_type,
  CASE WHEN i % 97 = 5 THEN event_type || '"stream":' ELSE event_type END AS symbol,
  i AS trade_id, {price} AS price, {qty} AS quantity, i * 2 AS buyer_order_id, i * 2 + 1 AS seller_order_id,
  user_id % 2 = 0 AS is_buyer_maker,
  CASE WHEN i % 13 = 0 THEN NULL ELSE ms + 5 END AS event_time_ms, ms AS trade_time_ms
FROM wire WHERE reason IS NULL"""


def io_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["decode_trades"] = f"WITH {WIRE}\n{decoded_select(True)}"
    q["source_roundtrip"] = f"WITH {WIRE}\n{decoded_select(False)}"
    q["quarantine_trades"] = f"WITH {WIRE}\nSELECT i AS seq, reason FROM wire WHERE reason IS NOT NULL"
    q["sink_records"] = (f"WITH {TRADES},\n{bar_cte('1 minute')}\n"
                         f"SELECT symbol || '-1m' AS key, * EXCLUDE (symbol), symbol FROM ({bar_select('1m')})")
    q["stream_decode"] = q["source_roundtrip"]
    q["stream_from_latest"] = f"{q['source_roundtrip']} AND i > (SELECT max(event_id) // 2 FROM events)"
    price, qty = d(u8("CAST(value AS DECIMAL(38,8))")), d(u8("CAST(json_extract_string(props, '$.k') AS DECIMAL(18,0))"))
    q["sink_trades"] = f"""SELECT 'trade' AS event_type, event_type AS symbol, event_id AS trade_id, {price} AS price,
  {qty} AS quantity, CAST(NULL AS BIGINT) AS buyer_order_id, CAST(NULL AS BIGINT) AS seller_order_id,
  user_id % 2 = 0 AS is_buyer_maker, epoch_us(ts) // 1000 AS event_time_ms, epoch_us(ts) // 1000 AS trade_time_ms FROM events"""
    return q




# ---------------------------------------------------------------- changelog, lateness, history

def changelog_cte(iv: str, name: str = "cl") -> str:
    win = (f"PARTITION BY symbol, time_bucket(INTERVAL '{iv}', trade_time) ORDER BY trade_time, trade_id "
           "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW")
    return f"""{name} AS (
  SELECT symbol, trade_id, trade_time, time_bucket(INTERVAL '{iv}', trade_time) AS window_start,
    time_bucket(INTERVAL '{iv}', trade_time) + INTERVAL '{iv}' AS window_end,
    COALESCE(first(CASE WHEN price <> 0 THEN price END IGNORE NULLS) OVER ({win}), 0) AS open,
    greatest(max(price) OVER ({win}), 0) AS high, least(min(price) OVER ({win}), 999999999) AS low,
    price AS close,
    sum(price * quantity) OVER ({win}) AS volume, sum(quantity) OVER ({win}) AS base_volume,
    count(*) OVER ({win}) AS trade_count,
    COALESCE(sum(CASE WHEN NOT is_buyer_maker THEN price * quantity END) OVER ({win}), 0) AS buy_volume,
    COALESCE(sum(CASE WHEN is_buyer_maker THEN price * quantity END) OVER ({win}), 0) AS sell_volume,
    sum(CASE WHEN NOT is_buyer_maker THEN 1 ELSE 0 END) OVER ({win}) AS buy_trades,
    sum(CASE WHEN is_buyer_maker THEN 1 ELSE 0 END) OVER ({win}) AS sell_trades,
    sum(CASE WHEN price * quantity > 10000 THEN 1 ELSE 0 END) OVER ({win}) AS large_trades,
    sum(CASE WHEN price * quantity > 10000 THEN price * quantity ELSE 0 END) OVER ({win}) AS large_trade_volume
  FROM trades)"""


def changelog_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    pct = halfup(f"{u8('close - open')} * 10000", u8("open"))
    q["bars_changelog"] = f"""WITH {TRADES},
{changelog_cte('1 hour')}
SELECT symbol, '1h' AS interval, window_start, window_end, trade_id,
  {d(u8('open'))} AS open, {d(u8('high'))} AS high, {d(u8('low'))} AS low, {d(u8('close'))} AS close,
  {exact('volume')} AS volume, trade_count,
  {d(halfup(u8('volume'), 'trade_count'))} AS mean_notional,
  CASE WHEN base_volume > 0 THEN {d(halfup(u8('volume') + ' * 100000000', u8('base_volume')))} END AS vwap,
  {d(u8('close - open'))} AS price_change,
  CASE WHEN open = 0 THEN 0.0 ELSE {d(pct + ' * 100', 4)} END AS price_change_pct,
  {d(u8('base_volume'))} AS base_volume
FROM cl"""
    for name, tick in (("1s", "1 second"), ("10m", "10 minutes")):
        thinned = f"""cl AS (
  SELECT * FROM emissions
  QUALIFY row_number() OVER (PARTITION BY symbol, window_start, time_bucket(INTERVAL '{tick}', trade_time)
                             ORDER BY trade_time DESC, trade_id DESC) = 1)"""
        every = changelog_cte("1 hour")
        q[f"bars_changelog_{name}"] = q["bars_changelog"].replace(every, f"{changelog_cte('1 hour', 'emissions')},\n{thinned}")
    ratio = f"CASE WHEN volume > 0 THEN {halfup(u8('buy_volume') + ' * 10000', u8('volume'))} ELSE 5000 END"
    q["volume_changelog"] = f"""WITH {TRADES},
{changelog_cte('1 hour')},
m AS (SELECT *, {ratio} AS ratio_u,
  CASE WHEN volume > 0 THEN {halfup(u8('large_trade_volume') + ' * 10000', u8('volume'))} ELSE 0 END AS large_u FROM cl)
SELECT symbol, '1h' AS interval, window_start, window_end, trade_id,
  {exact('volume')} AS total_volume, {exact('buy_volume')} AS buy_volume, {exact('sell_volume')} AS sell_volume,
  trade_count AS total_trades, CAST(buy_trades AS BIGINT) AS buy_trades, CAST(sell_trades AS BIGINT) AS sell_trades,
  CAST(large_trades AS BIGINT) AS large_trades, {exact('large_trade_volume')} AS large_trade_volume,
  CAST(10000 AS DOUBLE) AS large_trade_threshold,
  {d('ratio_u', 4)} AS buy_volume_ratio, {d(halfup(u8('volume'), 'trade_count'))} AS average_trade_size,
  {d('large_u', 4)} AS large_trade_volume_ratio,
  CASE WHEN ratio_u > 6000 THEN 'BULLISH' WHEN ratio_u < 4000 THEN 'BEARISH' ELSE 'NEUTRAL' END AS volume_trend
FROM m"""
    cols = ", ".join(f"{TREND_EXPR[c]} AS {c}" for c in TREND_OUT["trends"])
    q["trends_changelog"] = f"""WITH {TRADES},
{changelog_cte('1 minute')},
{trends_cte(source='cl', order='trade_time, trade_id')}
SELECT symbol, window_start, window_end AS timestamp, trade_id, {cols} FROM tr"""
    q["alerts_changelog"] = f"""WITH {TRADES},
{changelog_cte('1 minute')},
{trends_cte(source='cl', order='trade_time, trade_id')},
mk AS (
  SELECT *, volume AS total_volume, {ratio} AS ratio_u,
    CASE WHEN volume > 0 THEN {halfup(u8('large_trade_volume') + ' * 10000', u8('volume'))} ELSE 0 END AS large_u,
    CASE WHEN open = 0 THEN 0 ELSE {pct} * 100 END AS pct_u FROM tr)
""" + "\nUNION ALL\n".join([price_alert_sql(), trend_alert_sql(), volume_alert_sql()])
    kept = """kept AS (
  SELECT * EXCLUDE (stream_time) FROM (
    SELECT *, max(trade_time) OVER (PARTITION BY part ORDER BY arrival_seq, trade_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stream_time FROM trades)
  WHERE time_bucket(INTERVAL '1 day', trade_time) + INTERVAL '1 day' > stream_time)"""
    q["bars_strict"] = f"WITH {TRADES},\n{kept},\n{bar_cte('1 day', source='kept')}\n{bar_select('1d')}"
    q["volume_strict"] = f"WITH {TRADES},\n{kept},\n{volume_cte('1 day', source='kept')}\n{volume_select('1d')}"
    q["strict_late_filter"] = f"""WITH {TRADES},
r AS (SELECT *, time_bucket(INTERVAL '1 day', trade_time) AS window_start,
  max(trade_time) OVER (PARTITION BY part ORDER BY arrival_seq, trade_id
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stream_time FROM trades)
SELECT part, arrival_seq, trade_id, symbol, trade_time, window_start, window_start + INTERVAL '1 day' AS window_end
FROM r WHERE window_start + INTERVAL '1 day' > stream_time"""
    q["price_history"] = f"""WITH {TRADES},
{bar_cte('1 minute')}
SELECT symbol, window_start,
  count(*) OVER (PARTITION BY symbol ORDER BY window_start ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS history_size,
  {d(u8('first_value(close) OVER (PARTITION BY symbol ORDER BY window_start ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)'))} AS oldest_price,
  {d(u8('close'))} AS newest_price
FROM bars"""
    return q




# ---------------------------------------------------------------- streaming (closed windows only)

def stream_sql() -> dict[str, str]:
    """A final-mode stream with a 0 s watermark emits the windows that end at or before the latest event."""
    q: dict[str, str] = {}
    closed = "window_end <= (SELECT max(ts) FROM events)"
    q["stream_bars_1m"] = (
        f"SELECT * EXCLUDE (window_start, window_end), epoch_us(window_start) AS window_start_us, "
        f"epoch_us(window_end) AS window_end_us FROM ({bars_sql('1m')}) WHERE {closed}"
    )
    q["stream_bars_updates"] = (
        f"SELECT * EXCLUDE (window_start, window_end), epoch_us(window_start) AS window_start_us, "
        f"epoch_us(window_end) AS window_end_us FROM ({bars_sql('1m')})"
    )
    q["stream_trends"] = (
        f"SELECT * EXCLUDE (window_start, timestamp), epoch_us(window_start) AS window_start_us, "
        f"epoch_us(timestamp) AS timestamp_us FROM ({trends_sql('trends')}) "
        f"WHERE timestamp <= (SELECT max(ts) FROM events)"
    )
    q["stream_alerts"] = (
        f"SELECT * EXCLUDE (timestamp), epoch_us(timestamp) AS timestamp_us FROM ({alerts_sql('alerts_all')}) "
        f"WHERE timestamp <= (SELECT max(ts) FROM events)"
    )
    # the windows that the watermark has closed, of views that depend on all of them
    open_events = "FROM events"
    closed_events = ("FROM (SELECT * FROM events WHERE time_bucket(INTERVAL '1 minute', ts) + INTERVAL '1 minute' "
                     "<= (SELECT max(ts) FROM events))")
    top = alerts_top20_sql().replace(open_events, closed_events)
    q["stream_alerts_top20"] = f"SELECT * EXCLUDE (timestamp), epoch_us(timestamp) AS timestamp_us FROM ({top})"
    channels = alert_channels_sql().replace(open_events, closed_events)
    q["stream_alert_channels"] = f"SELECT * EXCLUDE (timestamp), epoch_us(timestamp) AS timestamp_us FROM ({channels})"
    snapshot = views_sql()["latest_snapshot"].replace(open_events, closed_events)
    q["stream_latest_snapshot"] = f"SELECT * EXCLUDE (window_end), epoch_us(window_end) AS window_end_us FROM ({snapshot})"
    history = changelog_sql()["price_history"].replace(open_events, closed_events)
    q["stream_price_history"] = f"SELECT * EXCLUDE (window_start), epoch_us(window_start) AS window_start_us FROM ({history})"
    q["stream_feed_status"] = """WITH t AS (
  SELECT event_type AS symbol, epoch_us(ts) AS us, count(*) AS n FROM events GROUP BY ALL),
g AS (
  SELECT symbol, us, sum(n) OVER w AS total, lag(us) OVER w AS before, lead(us) OVER w AS after FROM t
  WINDOW w AS (PARTITION BY symbol ORDER BY us))
SELECT symbol, 'UP' AS status, us AS at_us, CAST(total AS BIGINT) AS message_count, us AS last_message_time_us
FROM g WHERE before IS NULL OR us - before >= 60000000
UNION ALL
SELECT symbol, 'DOWN', us + 60000000, CAST(total AS BIGINT), us
FROM g WHERE coalesce(after, (SELECT max(us) FROM t)) - us >= 60000000"""
    return q


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    for lab in ("1m", "5m", "15m", "1h", "1d"):
        q[f"bars_{lab}"] = bars_sql(lab)
    q["bars_all"] = bars_all_sql()
    q["bars_rollup"] = bars_all_sql(("1m", "5m", "15m", "1h", "1d"))
    for lab in ("1m", "5m", "1h"):
        q[f"volume_{lab}"] = volume_sql(lab)
    q["volume_all"] = volume_all_sql()
    _add_trends(q)
    _add_alerts(q)
    q.update(views_sql())
    q.update(io_sql())
    q.update(changelog_sql())
    q.update(stream_sql())
    # streams that end with the rows of a batch run
    for name in ("bars_strict", "strict_late_filter", "bars_changelog", "bars_changelog_10m", "trends_changelog", "alerts_changelog", "trailing_window"):
        q[f"stream_{name}"] = q[name]
    q["stream_quarantine"] = q["quarantine_trades"]
    q["symbol_series_stored"] = q["symbol_series"]
    q["sink_prices"], q["sink_volume"] = q["bars_all"], q["volume_all"]
    q["sink_trends"], q["sink_alerts"] = q["trends"], q["alerts_all"]
    q["trends_mixed"], q["alerts_mixed"] = q["trends"], q["alerts_price"]
    return q
