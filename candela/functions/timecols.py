"""Time helpers that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.functions.numeric import UNIT


def epoch_micros(col: Column, dtype: T.DataType) -> Column:
    """Microseconds since 1970-01-01 00:00 of a TIMESTAMP or TIMESTAMP_NTZ column.

    For TIMESTAMP_NTZ the wall-clock fields are read directly, so the result is
    the same in every session time zone (a cast to TIMESTAMP would not be).
    """
    if isinstance(dtype, T.TimestampNTZType):
        days = F.date_diff(col.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
        secs = F.extract(F.lit("SECOND"), col)  # decimal(8,6): seconds with micros
        return (
            days * F.lit(86_400_000_000)
            + F.hour(col).cast("bigint") * F.lit(3_600_000_000)
            + F.minute(col).cast("bigint") * F.lit(60_000_000)
            + (secs * F.lit(1_000_000)).cast("bigint")
        )
    return F.unix_micros(col.cast("timestamp"))


def packed_order_key(ts: Column, ts_type: T.DataType, tie: Column) -> Column:
    """One sortable DECIMAL(38,0) for (time, tie) with 0 <= tie < 10^18.

    A single fixed-width key keeps ``min_by``/``max_by`` in HashAggregate; a
    struct key would force SortAggregate.
    """
    micros = epoch_micros(ts, ts_type).cast("decimal(20,0)")
    return (micros * F.lit("1000000000000000000").cast("decimal(19,0)") + tie.cast("decimal(19,0)")).cast(UNIT)
