"""Synthetic trades (S10): a deterministic price band per symbol, one trade per input row.

The reference fabricates test trades from random numbers (BTCUSDT around
45000, ETHUSDT around 2500, BNBUSDT around 400, +-0.05 %, volumes 10-60).
Here the "random" draw is an arithmetic hash of a row id, so any engine can
reproduce it:

    r  = (id * 7919) % 10000          (0..9999)
    r2 = (id * 104729) % 10000
    symbol   = SYMBOLS[id % 3]
    price    = HALF_UP(base * (1 + (r - 5000) / 10^7), 2)
    quantity = 10 + r2 / 200          (10 .. 59.995)
    is_buyer_maker = id % 2 = 1

Driven by a table's rows (ids and times), so the generated volume grows with it;
``spark.range`` or the ``rate`` stream source can drive it the same way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.functions.numeric import from_units, halfup_units, lit_int
from candela.schemas import TRADE_COLUMNS

# Symbols and base prices of the page's synthetic points.
SYMBOLS = ["BTCUSDT", "ETHUSDT", "BNBUSDT"]
BASE_PRICES = [45000, 2500, 400]


def _pick(i: Column, values: list) -> Column:
    expr = None
    for k, v in enumerate(values):
        expr = F.when(i % len(values) == k, F.lit(v)) if expr is None else expr.when(i % len(values) == k, F.lit(v))
    return expr


def synthetic_trades(rows: DataFrame, id_col: str = "id", time_col: str = "ts") -> DataFrame:
    i = F.col(id_col).cast("bigint")
    r = (i * 7919) % 10000
    r2 = (i * 104729) % 10000
    base = _pick(i, BASE_PRICES).cast("bigint")
    # price in 1e-8 units: base*1e8 + base*(r-5000)*10, then HALF_UP to 2 decimals
    price_u8 = (base * lit_int(10**8) + base * (r - 5000) * lit_int(10)).cast("decimal(38,0)")
    price = from_units(halfup_units(price_u8, lit_int(10**6)), 2).cast("decimal(18,8)")
    qty = from_units((lit_int(10_000) + r2 * 5).cast("decimal(38,0)"), 3).cast("decimal(18,8)")
    out = rows.select(
        F.lit("trade").alias("event_type"),
        F.col(time_col).alias("event_time"),
        _pick(i, SYMBOLS).alias("symbol"),
        i.alias("trade_id"),
        price.alias("price"),
        qty.alias("quantity"),
        F.lit(None).cast("bigint").alias("buyer_order_id"),
        F.lit(None).cast("bigint").alias("seller_order_id"),
        F.col(time_col).alias("trade_time"),
        ((i % 2) == 1).alias("is_buyer_maker"),
    )
    return out.select(*TRADE_COLUMNS)
