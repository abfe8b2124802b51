"""Which (dataset, symbol, interval) streams exist, from the symbols that traded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.schemas import PRICE_INTERVALS, VOLUME_INTERVALS

# Dataset names and the pseudo-intervals of the trend and alert streams.
TREND_INTERVAL = "current"
ALERT_INTERVALS = ("all", "symbol-specific")


def stream_catalog(trades: DataFrame) -> DataFrame:
    """Every (dataset, interval) exists for every symbol that traded: one distinct, then a Generate of the fixed pairs."""
    pairs = (
        [("prices", label) for label, _ in PRICE_INTERVALS]
        + [("volume", label) for label, _ in VOLUME_INTERVALS]
        + [("trends", TREND_INTERVAL)]
        + [("alerts", name) for name in ALERT_INTERVALS]
    )
    listed = F.array(*[F.struct(F.lit(d).alias("dataset"), F.lit(i).alias("interval")) for d, i in pairs])
    out = trades.select("symbol").distinct().select("symbol", F.inline(listed))
    return out.select("dataset", "symbol", "interval")
