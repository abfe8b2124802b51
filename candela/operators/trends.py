"""Trend indicators over a per-symbol sequence of bar closes.

For each bar, with n = number of bars so far for the symbol (history capped
at 30, which no indicator reaches past):

* sma_k   HALF_UP(sum of the last k closes / k, 8), when n >= k (k = 5, 15, 30)
* ema_k   fold over the last k closes seeded with the oldest one,
          ema = (p - ema) * a + ema, a = HALF_UP(2 / (k + 1), 8); when n >= k (k = 5, 15).
          The fold is a fixed linear combination of lag(close, j), j < k, so it is
          evaluated as one weighted sum (DOUBLE)
* rsi     simple-average RSI over the last 14 changes: avg gain / avg loss each
          HALF_UP(sum / 14, 8); loss 0 -> 100; rs = HALF_UP(gain / loss, 8);
          rsi = 100 - HALF_UP(100 / (1 + rs), 8); when n >= 15
* momentum close - close nine bars earlier, when n >= 10
* direction BULLISH if sma5 > sma15 and close > sma15, BEARISH if both <, else NEUTRAL;
          NEUTRAL when sma5 or sma15 is missing
* strength m = |HALF_UP(momentum / close, 4)| * 100; STRONG if m > 5 or rsi > 70 or rsi < 30,
          MODERATE if m > 2, else WEAK; WEAK when sma5 or sma15 is missing

Two physical strategies, same result:

* ``direct``: ``Window.partitionBy(symbol).orderBy(order)``. One Exchange and one
  Sort after the bars. Over final 1-minute bars a symbol has at most one row per
  minute (525,600 per year), however many trades it has, so a task stays small.
* ``blocked``: for inputs whose rows per symbol grow with the trades (changelog
  emissions), rows get a dense per-symbol index (two-level prefix count), are cut
  into blocks of ``block_rows`` and each block is given the 29 preceding rows as a
  halo. Every window frame then runs per (symbol, block): bounded tasks, exact.
"""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.functions.numeric import dec_lit_sql, from_units_sql, halfup_units_sql, units_sql
from candela.functions.timecols import epoch_micros
from candela.plans.ordered import dense_index, with_halo

# Fixed values of the reference indicators.
SMA_PERIODS = (5, 15, 30)
EMA_PERIODS = (5, 15)
RSI_PERIOD = 14
MOMENTUM_LAG = 9
HISTORY = 30
RSI_OVERBOUGHT = 70
RSI_OVERSOLD = 30
STRONG_MOMENTUM_PCT = 5
MODERATE_MOMENTUM_PCT = 2

UNITS_8 = 10**8


def ema_alpha(k: int) -> Decimal:
    return (Decimal(2) / Decimal(k + 1)).quantize(Decimal("0.00000001"), rounding=ROUND_HALF_UP)


def ema_weights(k: int) -> list[float]:
    """Weights of lag(close, j), j = 0..k-1, of the seeded k-step fold (exact, then to float)."""
    a = ema_alpha(k)
    b = Decimal(1) - a
    ws = [a * b**j for j in range(k - 1)] + [b ** (k - 1)]
    return [float(w) for w in ws]


def _indicator_columns(win: str) -> list[Column]:
    """Raw per-row window aggregates (integer units / doubles) over the window spec text ``win``."""
    def frame(k: int) -> str:
        return f"{win} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW"

    cols = [F.expr(f"row_number() OVER ({win})").alias("_n")]
    for k in SMA_PERIODS:
        cols.append(F.expr(f"sum(_cu) OVER ({frame(k)})").alias(f"_s{k}"))
    for k in EMA_PERIODS:
        terms = [f"CAST('{wt!r}' AS DOUBLE) * lag(_cd, {j}) OVER ({win})" for j, wt in enumerate(ema_weights(k))]
        cols.append(F.expr(" + ".join(terms)).alias(f"_e{k}"))
    cols.append(F.expr(f"lag(_cu, {MOMENTUM_LAG}) OVER ({win})").alias("_lag_mom"))
    cols.append(F.expr(f"_cu - lag(_cu, 1) OVER ({win})").alias("_dlt"))
    return cols


def _rsi_columns(win: str) -> list[Column]:
    frame = f"{win} ROWS BETWEEN {RSI_PERIOD - 1} PRECEDING AND CURRENT ROW"
    zero = dec_lit_sql(0)
    return [
        F.expr(f"sum(greatest(_dlt, {zero})) OVER ({frame})").alias("_gain"),
        F.expr(f"sum(greatest(-_dlt, {zero})) OVER ({frame})").alias("_loss"),
    ]


def _finish(df: DataFrame, order_col: str, timestamp_col: str, extra: list[str]) -> DataFrame:
    """Rounds and classifies the raw window aggregates.

    Staged projections keep each HALF_UP step on column references, so the
    generated code stays small enough for whole-stage codegen.
    """
    s1 = df.select(
        "symbol", "window_start", F.col(timestamp_col).alias("timestamp"), *extra,
        F.col("close").alias("current_price"), "_n", "_cu",
        *[F.expr(f"CASE WHEN _n >= {k} THEN {halfup_units_sql(f'_s{k}', dec_lit_sql(k))} END").alias(f"_sma{k}")
          for k in SMA_PERIODS],
        *[F.expr(f"CASE WHEN _n >= {k} THEN _e{k} END").alias(f"ema{k}") for k in EMA_PERIODS],
        F.expr(halfup_units_sql("_gain", dec_lit_sql(RSI_PERIOD))).alias("_g"),
        F.expr(halfup_units_sql("_loss", dec_lit_sql(RSI_PERIOD))).alias("_l"),
        F.expr(f"CASE WHEN _n >= {MOMENTUM_LAG + 1} THEN _cu - _lag_mom END").alias("_mom"),
    )
    s2 = s1.select(
        "*",
        F.expr(halfup_units_sql("_g", "_l", 8)).alias("_rs"),
        F.expr(f"abs({halfup_units_sql('_mom', '_cu', 4)})").alias("_m"),
    )
    hundred = dec_lit_sql(100 * UNITS_8)
    s3 = s2.select(
        "*",
        F.expr(
            f"CASE WHEN _n < {RSI_PERIOD + 1} THEN NULL WHEN _l = 0 THEN {hundred} "
            f"ELSE {hundred} - {halfup_units_sql(dec_lit_sql(100 * UNITS_8 * UNITS_8), f'{dec_lit_sql(UNITS_8)} + _rs')} END"
        ).alias("_rsi"),
    )
    have = "_sma5 IS NOT NULL AND _sma15 IS NOT NULL"
    direction = (
        f"CASE WHEN NOT ({have}) THEN 'NEUTRAL' "
        "WHEN _sma5 > _sma15 AND _cu > _sma15 THEN 'BULLISH' "
        "WHEN _sma5 < _sma15 AND _cu < _sma15 THEN 'BEARISH' ELSE 'NEUTRAL' END"
    )
    strength = (
        f"CASE WHEN NOT ({have}) THEN 'WEAK' "
        "WHEN _mom IS NULL OR _rsi IS NULL THEN CAST(NULL AS STRING) "
        f"WHEN _m > {STRONG_MOMENTUM_PCT * 100} OR _rsi > {RSI_OVERBOUGHT * UNITS_8} "
        f"OR _rsi < {RSI_OVERSOLD * UNITS_8} THEN 'STRONG' "
        f"WHEN _m > {MODERATE_MOMENTUM_PCT * 100} THEN 'MODERATE' ELSE 'WEAK' END"
    )
    return s3.select(
        "symbol", "window_start", "timestamp", *extra, "current_price",
        *[F.expr(from_units_sql(f"_sma{k}", 8)).alias(f"sma{k}") for k in SMA_PERIODS],
        *[f"ema{k}" for k in EMA_PERIODS],
        F.expr(from_units_sql("_rsi", 8)).alias("rsi"),
        F.expr(from_units_sql("_mom", 8)).alias("momentum"),
        F.expr(direction).alias("trend_direction"),
        F.expr(strength).alias("trend_strength"),
    )


def trends(
    bars_df: DataFrame,
    order_col: str = "window_start",
    timestamp_col: str = "window_end",
    strategy: str = "direct",
    block_rows: int = 100_000,
    extra: list[str] | None = None,
    bucket: Column | None = None,
    interval: str | None = "1m",
) -> DataFrame:
    """Trend rows, one per input bar (T7). ``bars_df`` needs symbol, close and the order column.

    Only bars of ``interval`` count (F1), where the input names intervals; with
    None every interval is a sequence of its own.

    ``bucket`` (blocked strategy): a monotone coarsening of the order column used to
    number rows; defaults to the UTC day of a timestamp order column.
    """
    extra = list(extra or [])
    named = "interval" in bars_df.columns
    if named and interval is not None:
        bars_df = bars_df.filter(F.col("interval") == interval)
    keys = ["symbol", "interval"] if named and interval is None else ["symbol"]
    key_sql = ", ".join(keys)
    keep = list(dict.fromkeys([*keys, order_col, "window_start", timestamp_col, "close", *extra]))
    base = bars_df.select(
        *keep,
        F.expr(units_sql("close", 8)).alias("_cu"),
        F.expr(f"CAST({units_sql('close', 8)} AS DOUBLE) / CAST('{UNITS_8}' AS DOUBLE)").alias("_cd"),
    )
    if strategy == "direct":
        win = f"PARTITION BY {key_sql} ORDER BY `{order_col}`"
        raw = base.select("*", *_indicator_columns(win))
        raw = raw.select("*", *_rsi_columns(win))
    elif strategy == "blocked":
        if bucket is None:
            dtype = base.schema[order_col].dataType
            if not isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
                raise ValueError("blocked strategy needs a bucket for a non-timestamp order column")
            bucket = F.floor(epoch_micros(F.col(order_col), dtype) / F.lit(86_400_000_000))
        idx = dense_index(base, keys, order_col, bucket)
        halo = with_halo(idx, HISTORY - 1, block_rows)
        win = f"PARTITION BY {key_sql}, _blk ORDER BY _idx"
        raw = halo.select("*", *_indicator_columns(win))
        raw = raw.select("*", *_rsi_columns(win))
        # rank within the symbol, not within the block: n = global index + 1
        raw = raw.filter(~F.col("_halo")).withColumn("_n", F.col("_idx") + 1)
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return _finish(raw, order_col, timestamp_col, extra)
