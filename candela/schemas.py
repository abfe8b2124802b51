"""Column layouts of the data model (trades in; bars, volume analytics, trends, alerts out)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

PRICE = "decimal(18,8)"
QTY = "decimal(18,8)"

TRADE_SCHEMA = T.StructType(
    [
        T.StructField("event_type", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("trade_id", T.LongType()),
        T.StructField("price", T.DecimalType(18, 8)),
        T.StructField("quantity", T.DecimalType(18, 8)),
        T.StructField("buyer_order_id", T.LongType()),
        T.StructField("seller_order_id", T.LongType()),
        T.StructField("trade_time", T.TimestampType()),
        T.StructField("is_buyer_maker", T.BooleanType()),
    ]
)
TRADE_COLUMNS = [f.name for f in TRADE_SCHEMA.fields]

BAR_COLUMNS = [
    "symbol", "interval", "window_start", "window_end", "open", "high", "low", "close",
    "volume", "trade_count", "mean_notional", "vwap", "price_change", "price_change_pct",
]

VOLUME_COLUMNS = [
    "symbol", "interval", "window_start", "window_end", "total_volume", "buy_volume", "sell_volume",
    "total_trades", "buy_trades", "sell_trades", "large_trades", "large_trade_volume",
    "large_trade_threshold", "buy_volume_ratio", "average_trade_size", "large_trade_volume_ratio",
    "volume_trend",
]

TREND_COLUMNS = [
    "symbol", "timestamp", "current_price", "sma5", "sma15", "sma30", "ema5", "ema15", "rsi",
    "momentum", "trend_direction", "trend_strength",
]

ALERT_COLUMNS = ["symbol", "alert_type", "severity", "message", "timestamp", "metadata"]

# Interval labels and window lengths used by the two aggregation pipelines (fixed values).
PRICE_INTERVALS = [("1m", "1 minute"), ("5m", "5 minutes"), ("15m", "15 minutes")]
VOLUME_INTERVALS = [("1m", "1 minute"), ("5m", "5 minutes"), ("1h", "1 hour")]


def time_type(df: DataFrame, column: str) -> T.DataType:
    return df.schema[column].dataType
