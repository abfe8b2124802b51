"""Decode exchange trade messages.

Wire form: a JSON object ``{"e":"trade","E":ms,"s":sym,"t":id,"p":price,"q":qty,"b":id,"a":id,"T":ms,"m":bool}``
(``p``/``q`` as JSON string or number, unknown keys ignored), either flat or wrapped
in a combined-stream envelope ``{"stream":name,"data":{...}}``.

* Keys differ only in case (e/E, t/T), so the message is parsed with two
  case-disjoint struct schemas; exact decimals, a bad field becomes NULL.
* The envelope is recognised by structure (a top-level ``stream`` key), not by a
  substring test, so a symbol text containing ``"stream":`` is not misread.
* Only ``e == "trade"`` is a trade. Everything that is not a usable trade goes to
  quarantine with a ``reason`` instead of being dropped silently:
  not_json, envelope_without_data, not_trade, missing_<field> (s, t, p, q, T, m).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.schemas import TRADE_COLUMNS

LOWER_FIELDS = "e string, s string, t bigint, p decimal(18,8), q decimal(18,8), b bigint, a bigint, m boolean"
UPPER_FIELDS = "E bigint, T bigint"
# top level: the lower-case trade fields plus the envelope keys; a JSON object under
# a STRING field is returned as its raw text, so ``data`` needs no second scan of the message.
TOP_FIELDS = "stream string, data string, " + LOWER_FIELDS
REQUIRED = [("s", "symbol"), ("t", "trade_id"), ("p", "price"), ("q", "quantity"), ("T", "trade_time"),
            ("m", "is_buyer_maker")]
LOWER_NAMES = ["e", "s", "t", "p", "q", "b", "a", "m"]


def classified(messages: DataFrame, value_col: str, keep: list[str]) -> DataFrame:
    """One row per message: decoded fields (``f_<key>``) and ``reason`` (NULL for a valid trade).

    Each message is parsed once per case-disjoint schema, the inner object of an
    envelope once more. The result passes through a Generate so that a later
    filter on ``reason`` is evaluated on the parsed row instead of being pushed
    (and the parsing inlined) below it.
    """
    v = F.col(value_col).cast("string")
    df = messages.select(
        *keep, v.alias("_v"),
        F.json_object_keys(v).alias("_keys"),
        F.from_json(v, TOP_FIELDS).alias("_j"),
        F.from_json(v, UPPER_FIELDS).alias("_u"),
    )
    env = F.coalesce(F.array_contains(F.col("_keys"), "stream"), F.lit(False))
    data = F.col("_j")["data"]
    df = df.select(
        *keep, "_v", "_keys", "_j", "_u", env.alias("_env"),
        F.when(env, F.from_json(data, LOWER_FIELDS)).alias("_dj"),
        F.when(env, F.from_json(data, UPPER_FIELDS)).alias("_du"),
        F.when(env, F.json_object_keys(data)).alias("_dkeys"),
    )
    e = F.col("_env")
    fields: dict[str, Column] = {k: F.when(e, F.col("_dj")[k]).otherwise(F.col("_j")[k]) for k in LOWER_NAMES}
    for k in ("E", "T"):
        fields[k] = F.when(e, F.col("_du")[k]).otherwise(F.col("_u")[k])
    reason = (
        F.when(F.col("_keys").isNull(), F.lit("not_json"))
        .when(e & data.isNull(), F.lit("envelope_without_data"))
        .when(e & F.col("_dkeys").isNull(), F.lit("not_json"))
        .when(F.coalesce(fields["e"] != F.lit("trade"), F.lit(True)), F.lit("not_trade"))
    )
    for wire, _ in REQUIRED:
        reason = reason.when(fields[wire].isNull(), F.lit(f"missing_{wire}"))
    row = F.struct(
        *[F.col(k) for k in keep], F.col("_v").alias("_message"),
        *[fields[k].alias(f"f_{k}") for k in LOWER_NAMES],
        fields["E"].alias("f_event_ms"), fields["T"].alias("f_trade_ms"),
        reason.alias("reason"),
    )
    return df.select(F.inline(F.array(row)))


def decode_trades(messages: DataFrame, value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Valid trades (TRADE_COLUMNS, plus ``keep`` passthrough columns such as Kafka offsets)."""
    keep = list(keep or [])
    return trades_of(classified(messages, value_col, keep), keep)


def trades_of(rows: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The valid trades among classified messages."""
    keep = list(keep or [])
    return rows.filter(F.col("reason").isNull()).select(
        *keep,
        F.col("f_e").alias("event_type"),
        F.timestamp_millis(F.col("f_event_ms")).alias("event_time"),
        F.col("f_s").alias("symbol"),
        F.col("f_t").alias("trade_id"),
        F.col("f_p").alias("price"),
        F.col("f_q").alias("quantity"),
        F.col("f_b").alias("buyer_order_id"),
        F.col("f_a").alias("seller_order_id"),
        F.timestamp_millis(F.col("f_trade_ms")).alias("trade_time"),
        F.col("f_m").alias("is_buyer_maker"),
    ).select(*keep, *TRADE_COLUMNS)


def quarantine(messages: DataFrame, value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Messages that are not usable trades, with the first failing check as ``reason``."""
    keep = list(keep or [])
    return quarantined(classified(messages, value_col, keep), keep)


def quarantined(rows: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The others, with the first failing check as ``reason``."""
    return rows.filter(F.col("reason").isNotNull()).select(*(keep or []), F.col("_message").alias("message"), "reason")
