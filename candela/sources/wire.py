"""Trades to the exchange wire format (the publish side, S6/S7), and a replay feed derived from ``events``.

``to_wire`` writes the flat JSON object of a trade. ``replay_messages`` turns every
``events`` row into a wire message so decode and quarantine run over data that
grows with the table. Variation is a fixed arithmetic function of ``event_id``
(reproducible in any engine):

* id % 4 = 1     wrapped in a combined-stream envelope
* id % 7 = 0     p and q as JSON numbers (otherwise strings)
* id % 3 = 0     an extra key ``M`` (ignored)
* id % 13 = 0    no ``E``
* id % 11 = 3    event type ``aggTrade`` (not a trade)
* id % 97 = 5    symbol text ends with ``"stream":`` (must not be taken for an envelope)
* id % 50 = 17   ``m`` is null
* id % 50 = 0    corrupted, by (id / 50) % 4: 0 garbage text, 1 empty string,
                 2 envelope without data, 3 no ``p``
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.functions.timecols import epoch_micros


def _q(s: Column) -> Column:
    """JSON string literal of a text column: the value in the object that ``to_json`` writes."""
    return F.when(s.isNotNull(), F.regexp_extract(F.to_json(F.struct(s.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1))


def _kv(key: str, value: Column) -> Column:
    return F.concat(F.lit(f'"{key}":'), value)


def _obj(parts: list[Column]) -> Column:
    # concat_ws skips NULL parts: absent keys simply do not appear
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def to_wire(trades: DataFrame, numbers: Column | None = None) -> Column:
    """Flat wire JSON of each trade row (epoch-ms times; p/q as strings unless ``numbers``)."""
    tt = trades.schema["trade_time"].dataType
    et = trades.schema["event_time"].dataType
    t_ms = F.floor(epoch_micros(F.col("trade_time"), tt) / 1000).cast("bigint")
    e_ms = F.floor(epoch_micros(F.col("event_time"), et) / 1000).cast("bigint")
    num = numbers if numbers is not None else F.lit(False)
    p_txt = F.col("price").cast("string")
    q_txt = F.col("quantity").cast("string")
    return _obj([
        _kv("e", _q(F.col("event_type"))),
        F.when(e_ms.isNotNull(), _kv("E", e_ms.cast("string"))),
        _kv("s", _q(F.col("symbol"))),
        _kv("t", F.col("trade_id").cast("string")),
        _kv("p", F.when(num, p_txt).otherwise(_q(p_txt))),
        _kv("q", F.when(num, q_txt).otherwise(_q(q_txt))),
        F.when(F.col("buyer_order_id").isNotNull(), _kv("b", F.col("buyer_order_id").cast("string"))),
        F.when(F.col("seller_order_id").isNotNull(), _kv("a", F.col("seller_order_id").cast("string"))),
        _kv("T", t_ms.cast("string")),
        _kv("m", F.coalesce(F.col("is_buyer_maker").cast("string"), F.lit("null"))),
    ])


def replay_messages(events: DataFrame) -> DataFrame:
    """(seq, value) wire messages, one per ``events`` row (see module docstring)."""
    i = F.col("event_id")
    ms = F.floor(epoch_micros(F.col("ts"), events.schema["ts"].dataType) / 1000).cast("bigint")
    sym = F.when(i % 97 == 5, F.concat(F.col("event_type"), F.lit('"stream":'))).otherwise(F.col("event_type"))
    trades = events.select(
        i.alias("seq"),
        i,
        F.when(i % 11 == 3, F.lit("aggTrade")).otherwise(F.lit("trade")).alias("event_type"),
        F.when(i % 13 == 0, F.lit(None).cast("bigint")).otherwise(ms + 5).alias("_e_ms"),
        sym.alias("symbol"),
        i.alias("trade_id"),
        F.col("value").cast("decimal(18,8)").alias("price"),
        F.get_json_object("props", "$.k").try_cast("decimal(18,8)").alias("quantity"),
        (i * 2).alias("buyer_order_id"),
        (i * 2 + 1).alias("seller_order_id"),
        ms.alias("_t_ms"),
        F.when(i % 50 == 17, F.lit(None).cast("boolean")).otherwise((F.col("user_id") % 2) == 0).alias("is_buyer_maker"),
    )
    num = i % 7 == 0
    p_txt = F.col("price").cast("string")
    q_txt = F.col("quantity").cast("string")
    flat = _obj([
        _kv("e", _q(F.col("event_type"))),
        F.when(F.col("_e_ms").isNotNull(), _kv("E", F.col("_e_ms").cast("string"))),
        _kv("s", _q(F.col("symbol"))),
        _kv("t", F.col("trade_id").cast("string")),
        F.when(~((i % 50 == 0) & ((F.floor(i / 50) % 4) == 3)),
               _kv("p", F.when(num, p_txt).otherwise(_q(p_txt)))),
        _kv("q", F.when(num, q_txt).otherwise(_q(q_txt))),
        _kv("b", F.col("buyer_order_id").cast("string")),
        _kv("a", F.col("seller_order_id").cast("string")),
        _kv("T", F.col("_t_ms").cast("string")),
        _kv("m", F.coalesce(F.col("is_buyer_maker").cast("string"), F.lit("null"))),
        F.when(i % 3 == 0, _kv("M", F.lit("true"))),
    ])
    stream = F.concat(F.lower(F.col("symbol")), F.lit("@trade"))
    wrapped = F.when(i % 4 == 1, _obj([_kv("stream", _q(stream)), _kv("data", flat)])).otherwise(flat)
    kind = F.floor(i / 50) % 4
    corrupt = (
        F.when(kind == 0, F.concat(F.lit("{trade "), i.cast("string")))
        .when(kind == 1, F.lit(""))
        .when(kind == 2, _obj([_kv("stream", _q(stream))]))
    )
    value = F.when((i % 50 == 0) & (kind != 3), corrupt).otherwise(wrapped)
    return trades.select("seq", value.alias("value"))
