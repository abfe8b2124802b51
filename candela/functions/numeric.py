"""Exact HALF_UP decimal arithmetic in Spark expressions.

Spark types ``decimal / decimal`` with at most 6 fraction digits once the
declared precision is wide, so ``round(a / b, s)`` can round twice. Here every
quotient is taken on integer units held in ``DECIMAL(38,0)`` (a type with no
scale to lose) and rounded once:

    q = sign(n*d) * floor((2*|n|*10^e + |d|) / (2*|d|))

The floor is computed as ``(a - a % b) / b`` on decimals, which is exact and
raises on overflow under ANSI mode; ``div`` is avoided because it wraps
silently past 2^63.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT = "decimal(38,0)"


def lit_int(value: int) -> Column:
    return F.lit(str(int(value))).cast(UNIT)


def pow10(scale: int) -> Column:
    """10^scale as a narrow DECIMAL(scale+1, 0) literal, so products keep their scale."""
    return F.lit(str(10**scale)).cast(f"decimal({scale + 1},0)")


def units(x: Column | str, scale: int) -> Column:
    """``x * 10^scale`` as an integer DECIMAL(38,0); exact when x has <= scale fraction digits."""
    col = F.col(x) if isinstance(x, str) else x
    return (col * pow10(scale)).cast(UNIT)


def floor_div(a: Column, b: Column) -> Column:
    """floor(a / b) for a >= 0, b > 0, both integer DECIMAL(38,0)."""
    return ((a - (a % b)) / b).cast(UNIT)


def halfup_units(num: Column, den: Column, exp10: int = 0) -> Column:
    """HALF_UP(num * 10^exp10 / den) for integer-unit operands; NULL when den = 0."""
    n = num.cast(UNIT)
    d = den.cast(UNIT)
    an = F.abs(n) * lit_int(2 * 10**exp10) if exp10 >= 0 else F.abs(n) * lit_int(2)
    ad = F.abs(d) if exp10 >= 0 else F.abs(d) * lit_int(10 ** (-exp10))
    q = floor_div(an + ad, ad * lit_int(2))
    neg = (n < 0) != (d < 0)
    return F.when(d == 0, F.lit(None).cast(UNIT)).when(neg, -q).otherwise(q).cast(UNIT)


def from_units(q: Column, scale: int) -> Column:
    """Integer units back to DECIMAL(38, scale)."""
    if scale == 0:
        return q.cast(UNIT)
    step = F.lit("0." + "0" * (scale - 1) + "1").cast(f"decimal({scale},{scale})")
    # decimal(37-s,0) * decimal(s,s) -> decimal(38,s): no precision adjustment, exact.
    return (q.cast(f"decimal({37 - scale},0)") * step).cast(f"decimal(38,{scale})")


def halfup_div(num: Column | str, den: Column | str, scale: int, num_scale: int, den_scale: int) -> Column:
    """HALF_UP(num / den) at ``scale`` fraction digits, as DECIMAL(38, scale).

    ``num_scale`` / ``den_scale`` are the fraction digits of the inputs (their
    declared decimal scales); both are converted to integer units first.
    """
    if isinstance(num, str) and isinstance(den, str):
        return F.expr(halfup_div_sql(num, den, scale, num_scale, den_scale))
    q = halfup_units(units(num, num_scale), units(den, den_scale), scale + den_scale - num_scale)
    return from_units(q, scale)


def units_to_double(q: Column, scale: int) -> Column:
    """Integer units to DOUBLE with one IEEE division (bit-identical across engines while |q| < 2^53)."""
    return q.cast("double") / F.lit(float(10**scale))


def decimal_to_double(x: Column | str, scale: int) -> Column:
    """Publish an exact decimal as DOUBLE through integer units (see ``units_to_double``)."""
    if isinstance(x, str):
        return F.expr(f"CAST({units_sql(f'`{x}`', scale)} AS DOUBLE) / CAST('{10**scale}' AS DOUBLE)")
    return units_to_double(units(x, scale), scale)


def halfup_round(x: Column, scale: int) -> Column:
    """HALF_UP rounding of a decimal column (Spark's decimal ``round`` is HALF_UP)."""
    return F.round(x, scale)


# ---------------------------------------------------------------- SQL-text forms
#
# The same arithmetic as SQL text over column names / SQL fragments. Building a
# large expression from Column objects costs one JVM round trip per node; one
# ``F.expr`` of the text costs a single parse. Callers compose the ``*_sql``
# strings and wrap the final text with ``F.expr``.

def dec_lit_sql(value: int, precision: int = 38) -> str:
    return f"CAST('{int(value)}' AS DECIMAL({precision},0))"


def units_sql(x: str, scale: int) -> str:
    return f"CAST(({x}) * CAST('{10**scale}' AS DECIMAL({scale + 1},0)) AS {UNIT})"


def halfup_units_sql(num: str, den: str, exp10: int = 0) -> str:
    n = f"CAST(({num}) AS {UNIT})"
    d = f"CAST(({den}) AS {UNIT})"
    if exp10 >= 0:
        an, ad = f"(abs({n}) * {dec_lit_sql(2 * 10**exp10)})", f"abs({d})"
    else:
        an, ad = f"(abs({n}) * {dec_lit_sql(2)})", f"(abs({d}) * {dec_lit_sql(10 ** (-exp10))})"
    a = f"({an} + {ad})"
    b = f"({ad} * {dec_lit_sql(2)})"
    q = f"CAST((({a} - ({a} % {b})) / {b}) AS {UNIT})"
    return (f"CAST(CASE WHEN {d} = 0 THEN NULL WHEN ({n} < 0) <> ({d} < 0) THEN -{q} ELSE {q} END AS {UNIT})")


def from_units_sql(q: str, scale: int) -> str:
    if scale == 0:
        return f"CAST(({q}) AS {UNIT})"
    step = "0." + "0" * (scale - 1) + "1"
    return f"CAST(CAST(({q}) AS DECIMAL({37 - scale},0)) * CAST('{step}' AS DECIMAL({scale},{scale})) AS DECIMAL(38,{scale}))"


def halfup_div_sql(num: str, den: str, scale: int, num_scale: int, den_scale: int) -> str:
    q = halfup_units_sql(units_sql(num, num_scale), units_sql(den, den_scale), scale + den_scale - num_scale)
    return from_units_sql(q, scale)


def sql(text: str) -> Column:
    return F.expr(text)
