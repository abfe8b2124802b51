"""Trend indicators of one symbol's bounded close history, in exact decimal arithmetic.

``indicator_columns`` serves the streaming trend operator (per-key state holds the
last 30 closes): all rows of a batch at once, over integer units, with the batch
operator's EMA weights. ``indicators`` is the fold of one history, the tests'
independent check of both. Definitions: see ``candela.operators.trends``.
"""

from __future__ import annotations

from decimal import Decimal
from fractions import Fraction

import numpy as np

from candela.operators.trends import (
    EMA_PERIODS,
    HISTORY,
    MODERATE_MOMENTUM_PCT,
    MOMENTUM_LAG,
    RSI_OVERBOUGHT,
    RSI_OVERSOLD,
    RSI_PERIOD,
    SMA_PERIODS,
    STRONG_MOMENTUM_PCT,
    ema_alpha,
    ema_weights,
)

UNITS = 10**8


def half_up(x: Fraction, scale: int) -> Decimal:
    """Exact HALF_UP rounding of a rational to ``scale`` fraction digits."""
    m = abs(x) * 10**scale
    q = (m.numerator * 2 + m.denominator) // (2 * m.denominator)
    q = -q if x < 0 else q
    return Decimal(q).scaleb(-scale)


def _sma(h: list[Decimal], k: int) -> Decimal:
    return half_up(Fraction(sum(h[-k:], Decimal(0))) / k, 8)


def _ema(h: list[Decimal], k: int) -> float:
    a = Fraction(ema_alpha(k))
    window = [Fraction(p) for p in h[-k:]]
    e = window[0]
    for p in window[1:]:
        e = e + (p - e) * a
    return float(e)


def _rsi(h: list[Decimal]) -> Decimal:
    deltas = [h[i] - h[i - 1] for i in range(len(h) - RSI_PERIOD, len(h))]
    gain = half_up(Fraction(sum((d for d in deltas if d > 0), Decimal(0))) / RSI_PERIOD, 8)
    loss = half_up(Fraction(sum((-d for d in deltas if d < 0), Decimal(0))) / RSI_PERIOD, 8)
    if loss == 0:
        return Decimal(100).quantize(Decimal("0.00000001"))
    rs = half_up(Fraction(gain) / Fraction(loss), 8)
    return Decimal(100) - half_up(Fraction(100) / (1 + Fraction(rs)), 8)


def indicators(history: list[Decimal]) -> dict:
    """Indicators after the newest close was appended (``history`` oldest first, <= 30 entries)."""
    h = history[-HISTORY:]
    n = len(h)
    cur = h[-1]
    out: dict = {"current_price": cur}
    for k in SMA_PERIODS:
        out[f"sma{k}"] = _sma(h, k) if n >= k else None
    for k in EMA_PERIODS:
        out[f"ema{k}"] = _ema(h, k) if n >= k else None
    out["rsi"] = _rsi(h) if n >= RSI_PERIOD + 1 else None
    out["momentum"] = cur - h[-(MOMENTUM_LAG + 1)] if n >= MOMENTUM_LAG + 1 else None
    s5, s15 = out["sma5"], out["sma15"]
    if s5 is None or s15 is None:
        out["trend_direction"], out["trend_strength"] = "NEUTRAL", "WEAK"
        return out
    if s5 > s15 and cur > s15:
        out["trend_direction"] = "BULLISH"
    elif s5 < s15 and cur < s15:
        out["trend_direction"] = "BEARISH"
    else:
        out["trend_direction"] = "NEUTRAL"
    mom, rsi = out["momentum"], out["rsi"]
    if mom is None or rsi is None:
        out["trend_strength"] = None
        return out
    m = abs(half_up(Fraction(mom) / Fraction(cur), 4)) * 100 if cur != 0 else None
    if (m is not None and m > STRONG_MOMENTUM_PCT) or rsi > RSI_OVERBOUGHT or rsi < RSI_OVERSOLD:
        out["trend_strength"] = "STRONG"
    elif m is not None and m > MODERATE_MOMENTUM_PCT:
        out["trend_strength"] = "MODERATE"
    else:
        out["trend_strength"] = "WEAK"
    return out


def _half_up_units(num: np.ndarray, den) -> np.ndarray:
    """HALF_UP(num / den) of integers of any size (object arrays), ``den`` positive."""
    q = (2 * abs(num) + den) // (2 * den)
    return np.where(num < 0, -q, q)


def _decimals(units: np.ndarray, known: np.ndarray) -> list[Decimal | None]:
    return [Decimal(int(u)).scaleb(-8) if k else None for u, k in zip(units, known)]


def indicator_columns(closes: list[Decimal], past: int) -> dict[str, list]:
    """Indicator columns of ``closes[past:]``; the ``past`` closes before them (at most 30) are the history."""
    u = np.array([int(c.scaleb(8)) for c in closes], dtype=object)
    n = len(u)
    at = np.arange(n)
    total = np.concatenate((np.zeros(1, dtype=object), np.cumsum(u)))

    def window_sum(sums: np.ndarray, k: int) -> np.ndarray:
        return sums[1:] - sums[np.maximum(at + 1 - k, 0)]

    def lagged(x: np.ndarray, j: int) -> np.ndarray:
        return x[np.maximum(at - j, 0)]

    sma = {k: _half_up_units(window_sum(total, k), k) for k in SMA_PERIODS}
    double = np.array([float(x) for x in u]) / float(UNITS)
    ema = {}
    for k in EMA_PERIODS:
        terms = [w * lagged(double, j) for j, w in enumerate(ema_weights(k))]
        ema[k] = terms[0]
        for term in terms[1:]:
            ema[k] = ema[k] + term
    momentum = u - lagged(u, MOMENTUM_LAG)
    delta = u - lagged(u, 1)
    zero = np.zeros(1, dtype=object)
    up, down = (np.concatenate((zero, np.cumsum(np.where(s > 0, s, 0)))) for s in (delta, -delta))
    gain, loss = (_half_up_units(window_sum(s, RSI_PERIOD), RSI_PERIOD) for s in (up, down))
    divisor = np.where(loss == 0, 1, loss)
    rs = _half_up_units(gain * UNITS, divisor)
    rsi = np.where(loss == 0, 100 * UNITS, 100 * UNITS - _half_up_units(np.full(n, 100 * UNITS * UNITS, dtype=object), UNITS + rs))
    share = np.where(u == 0, 0, _half_up_units(abs(momentum) * 10**4, np.where(u == 0, 1, abs(u))))
    warm = at + 1 >= 15
    bullish = (sma[5] > sma[15]) & (u > sma[15])
    bearish = (sma[5] < sma[15]) & (u < sma[15])
    direction = np.where(warm & bullish.astype(bool), "BULLISH", np.where(warm & bearish.astype(bool), "BEARISH", "NEUTRAL"))
    strong = (share > STRONG_MOMENTUM_PCT * 100) | (rsi > RSI_OVERBOUGHT * UNITS) | (rsi < RSI_OVERSOLD * UNITS)
    moderate = share > MODERATE_MOMENTUM_PCT * 100
    strength = np.where(warm & strong.astype(bool), "STRONG", np.where(warm & moderate.astype(bool), "MODERATE", "WEAK"))
    new = slice(past, None)
    out: dict[str, list] = {"current_price": closes[past:]}
    for k in SMA_PERIODS:
        out[f"sma{k}"] = _decimals(sma[k], at + 1 >= k)[new]
    for k in EMA_PERIODS:
        out[f"ema{k}"] = [float(e) if i + 1 >= k else None for i, e in enumerate(ema[k])][new]
    out["rsi"] = _decimals(rsi, at >= RSI_PERIOD)[new]
    out["momentum"] = _decimals(momentum, at >= MOMENTUM_LAG)[new]
    out["trend_direction"], out["trend_strength"] = direction[new].tolist(), strength[new].tolist()
    return out
