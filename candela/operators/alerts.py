"""Alert rules (L1-L10): 0..n alert rows per input row.

Rules (thresholds are fields of ``AlertRules``; comparisons strict as listed):

* PRICE_SPIKE   |price_change_pct| > 2 on a 1-minute bar; HIGH if > 5 else MEDIUM
* GOLDEN_CROSS  sma5 - sma15 > 0 and (ema5 - ema15, or 0 when an EMA is missing) <= 0; HIGH
* DEATH_CROSS   sma5 - sma15 < 0 and that EMA spread >= 0; HIGH
* OVERBOUGHT    rsi > 70; MEDIUM.   OVERSOLD rsi < 30 (otherwise); MEDIUM
* WHALE_ACTIVITY large_trade_volume_ratio > 0.5; HIGH
* HEAVY_BUYING  buy_volume_ratio > 0.7; MEDIUM.  HEAVY_SELLING buy_volume_ratio < 0.3 (otherwise); MEDIUM

Each rule is a struct-or-NULL column; ``emit`` turns a row into its alerts
with ``inline(filter(array(...), a -> a IS NOT NULL))`` (a Generate, no shuffle).
Alert ``timestamp`` is the end of the window the alert is about.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class AlertRules:
    # Fixed values of the reference rules.
    spike_pct: str = "2"
    spike_high_pct: str = "5"
    rsi_overbought: str = "70"
    rsi_oversold: str = "30"
    whale_ratio: str = "0.5"
    heavy_buying_ratio: str = "0.7"
    heavy_selling_ratio: str = "0.3"


DEFAULT_RULES = AlertRules()


def _d(v: str) -> str:
    return f"CAST('{v}' AS DECIMAL(38,8))"


def _fixed2(x: str) -> str:
    """Java ``%.2f`` of a decimal: HALF_UP to two digits (Spark's decimal ``round`` is HALF_UP)."""
    return f"CAST(CAST(round({x}, 2) AS DECIMAL(38,2)) AS STRING)"


def _alert(cond: str, kind: str, severity: str, message: str, ts: str, meta: list[tuple[str, str]]) -> str:
    """One rule as SQL text: a struct when ``cond`` holds, else NULL."""
    kv = ", ".join(f"'{k}', CAST({v} AS STRING)" for k, v in meta)
    return (
        f"CASE WHEN {cond} THEN named_struct('alert_type', '{kind}', 'severity', {severity}, "
        f"'message', {message}, 'timestamp', {ts}, 'metadata', map({kv})) END"
    )


def price_alert_columns(rules: AlertRules = DEFAULT_RULES, ts: str = "window_end") -> list[str]:
    pct = "price_change_pct"
    return [
        _alert(
            f"abs({pct}) > {_d(rules.spike_pct)}", "PRICE_SPIKE",
            f"CASE WHEN abs({pct}) > {_d(rules.spike_high_pct)} THEN 'HIGH' ELSE 'MEDIUM' END",
            f"format_string('%s price changed by %s%% in 1 minute', symbol, {_fixed2(pct)})",
            ts, [("priceChange", pct), ("currentPrice", "close")],
        )
    ]


def trend_alert_columns(rules: AlertRules = DEFAULT_RULES, ts: str = "timestamp") -> list[str]:
    have = "sma5 IS NOT NULL AND sma15 IS NOT NULL"
    spread = "(CASE WHEN ema5 IS NOT NULL AND ema15 IS NOT NULL THEN ema5 - ema15 ELSE CAST(0 AS DOUBLE) END)"
    sma_meta = [("sma5", "sma5"), ("sma15", "sma15")]
    over = f"rsi > {_d(rules.rsi_overbought)}"
    return [
        _alert(f"{have} AND sma5 - sma15 > 0 AND {spread} <= 0", "GOLDEN_CROSS", "'HIGH'",
               "format_string('%s: Golden cross detected - potential bullish reversal', symbol)", ts, sma_meta),
        _alert(f"{have} AND sma5 - sma15 < 0 AND {spread} >= 0", "DEATH_CROSS", "'HIGH'",
               "format_string('%s: Death cross detected - potential bearish reversal', symbol)", ts, sma_meta),
        _alert(over, "OVERBOUGHT", "'MEDIUM'",
               f"format_string('%s: RSI %s - Overbought condition', symbol, {_fixed2('rsi')})", ts, [("rsi", "rsi")]),
        _alert(f"NOT ({over}) AND rsi < {_d(rules.rsi_oversold)}", "OVERSOLD", "'MEDIUM'",
               f"format_string('%s: RSI %s - Oversold condition', symbol, {_fixed2('rsi')})", ts, [("rsi", "rsi")]),
    ]


def volume_alert_columns(rules: AlertRules = DEFAULT_RULES, ts: str = "window_end") -> list[str]:
    hundred = "CAST(100 AS DECIMAL(3,0))"
    bs_meta = [("buyVolume", "buy_volume"), ("sellVolume", "sell_volume")]
    buying = f"buy_volume_ratio > {_d(rules.heavy_buying_ratio)}"
    return [
        _alert(f"large_trade_volume_ratio IS NOT NULL AND large_trade_volume_ratio > {_d(rules.whale_ratio)}",
               "WHALE_ACTIVITY", "'HIGH'",
               f"format_string('%s: Large trades account for %s%% of volume', symbol, "
               f"{_fixed2(f'large_trade_volume_ratio * {hundred}')})",
               ts, [("largeTradeVolume", "large_trade_volume"), ("totalVolume", "total_volume")]),
        _alert(buying, "HEAVY_BUYING", "'MEDIUM'",
               f"format_string('%s: Heavy buying pressure - %s%% buy volume', symbol, "
               f"{_fixed2(f'buy_volume_ratio * {hundred}')})", ts, bs_meta),
        _alert(f"NOT ({buying}) AND buy_volume_ratio < {_d(rules.heavy_selling_ratio)}", "HEAVY_SELLING", "'MEDIUM'",
               f"format_string('%s: Heavy selling pressure - %s%% sell volume', symbol, "
               f"{_fixed2(f'(CAST(1 AS DECIMAL(1,0)) - buy_volume_ratio) * {hundred}')})", ts, bs_meta),
    ]


def emit(df: DataFrame, alerts: list[str]) -> DataFrame:
    """All alerts of every row: one Generate over the non-null rule results.

    ``symbol`` passes through the Generate from the input row, so the input's
    partitioning by symbol (e.g. after the trend window) still holds for the
    alerts and a per-symbol step after them (top-k) needs no new exchange.
    """
    return df.select("symbol", F.expr(f"inline(filter(array({', '.join(alerts)}), a -> a IS NOT NULL))"))


def minute_rows(df: DataFrame, interval: str = "1m") -> DataFrame:
    """only 1-minute rows raise alerts, where the input names intervals."""
    return df.filter(F.col("interval") == interval) if "interval" in df.columns else df


def price_alerts(bars_1m: DataFrame, rules: AlertRules = DEFAULT_RULES) -> DataFrame:
    return emit(minute_rows(bars_1m), price_alert_columns(rules))


def trend_alerts(trends_df: DataFrame, rules: AlertRules = DEFAULT_RULES) -> DataFrame:
    return emit(trends_df, trend_alert_columns(rules))


def volume_alerts(volume_1m: DataFrame, rules: AlertRules = DEFAULT_RULES) -> DataFrame:
    return emit(minute_rows(volume_1m), volume_alert_columns(rules))


def all_alerts(market_trends: DataFrame, rules: AlertRules = DEFAULT_RULES) -> DataFrame:
    """L9 in one pass over rows that carry bar, volume and trend columns of the same 1-minute window.

    The bag union of the three alert streams (no dedupe) equals one Generate
    over all eight rules, since every rule reads one row.
    """
    cols = (
        price_alert_columns(rules, ts="window_end")
        + trend_alert_columns(rules, ts="window_end")
        + volume_alert_columns(rules, ts="window_end")
    )
    return emit(minute_rows(market_trends), cols)


def latest_alerts(alerts: DataFrame, n: int = 20, per: str = "symbol") -> DataFrame:
    """The ``n`` newest alerts per symbol. Planned as a WindowGroupLimit.

    Ties by alert type, severity, message and metadata: alerts that agree in all are equal rows.
    """
    w = Window.partitionBy(per).orderBy(
        F.col("timestamp").desc(), "alert_type", "severity", "message", F.to_json("metadata"))
    return alerts.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= n).drop("_rk")
