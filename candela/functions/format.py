"""Text formatting with exact HALF_UP rounding (Spark's ``format_string('%.2f')`` rejects decimals)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from candela.functions.numeric import halfup_units, lit_int, units


def fixed2(x: Column) -> Column:
    """A decimal as text with two fraction digits, HALF_UP (Java ``%.2f`` on BigDecimal)."""
    return F.round(x, 2).cast("decimal(38,2)").cast("string")


def decimal_text(x: Column) -> Column:
    """Plain decimal text at the column's scale."""
    return x.cast("string")


# Fixed values of the page's number format: thresholds and suffixes.
_SCALES = [(10**9, "B"), (10**6, "M"), (10**3, "K")]


def human_number(x: Column, scale: int = 16) -> Column:
    """B / M / K with two decimals, HALF_UP on the exact decimal (page format, P12).

    ``x`` is a non-negative decimal with at most ``scale`` fraction digits.
    """
    xu = units(x, scale)
    expr = None
    for div, suffix in _SCALES:
        q = halfup_units(xu, lit_int(div * 10**scale), 2)
        txt = F.concat(_units2_text(q), F.lit(suffix))
        cond = x >= F.lit(div)
        expr = F.when(cond, txt) if expr is None else expr.when(cond, txt)
    plain = _units2_text(halfup_units(xu, lit_int(10**scale), 2))
    return expr.otherwise(plain)


def _units2_text(q: Column) -> Column:
    return (q.cast("decimal(36,0)") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(38,2)").cast("string")
