"""Publishing form of results for engine-independent comparison.

Library outputs keep exact DECIMAL columns. Registered queries publish each
decimal as the DOUBLE nearest to it, at the field's own scale. Up to
``DIVIDED_SCALE`` digits that is one IEEE division of integer units (an exactly
representable integer); finer fields are converted from the exact decimal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.functions.numeric import decimal_to_double

DIVIDED_SCALE = 8


def publish(df: DataFrame, scales: dict[str, int] | None = None) -> DataFrame:
    scales = scales or {}
    cols = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.DecimalType):
            scale = scales.get(field.name, field.dataType.scale)
            exact = scale > DIVIDED_SCALE
            column = F.col(f"`{field.name}`").cast("double") if exact else decimal_to_double(field.name, scale)
            cols.append(column.alias(field.name))
        else:
            cols.append(F.col(f"`{field.name}`"))
    return df.select(*cols)
