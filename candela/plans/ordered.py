"""Ordered, per-key sequential computations without one task per key.

``Window.partitionBy(key).orderBy(o)`` sends every row of a key to one task. When
a key can hold a large share of all rows (a hot symbol's trade-level changelog,
a source partition's arrival stream) the plans here split it by a *bucket*: a
deterministic, monotone non-decreasing function of the order column (a time
bucket, an offset range). Everything is deterministic expressions, so a lost
executor recomputes exactly the same rows.

* ``dense_index``: 0-based rank of each row within its key. Per (key, bucket)
  counts form a small table whose exclusive prefix sum per key is the bucket's
  offset; one join adds it back (AQE broadcasts the table only when its measured
  size allows, otherwise the join shuffles on (key, bucket), which is also the
  distribution the within-bucket ``row_number`` needs).
* ``with_halo``: cuts the index into blocks of ``block_rows`` and copies the last
  ``halo`` rows of each block into the next, so any frame reaching ``halo`` rows
  back can be evaluated per (key, block).
* ``running``: running aggregates (sum, max, min, first non-null) in order, as a
  two-level scan: per-bucket totals, an exclusive prefix over the bucket rows,
  and a within-bucket running aggregate combined with that prefix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _bucketed(df: DataFrame, keys: list[str], bucket: Column) -> DataFrame:
    """Adds ``_bkt``, ``_key`` (the keys as a struct) and ``_kb`` (keys and bucket).

    Structs with NULL fields are equal to each other, so rows with a NULL key or
    order column meet their totals in a plain equi-join instead of vanishing.
    """
    b = df.withColumn("_bkt", bucket).withColumn("_key", F.struct(*keys))
    return b.withColumn("_kb", F.struct(*keys, "_bkt"))


def dense_index(df: DataFrame, keys: list[str], order_col: str, bucket: Column, out: str = "_idx") -> DataFrame:
    """Adds ``out``: 0-based position of each row within ``keys`` by ``order_col`` (unique per key).

    ``bucket`` must be monotone non-decreasing in ``order_col`` within a key.
    """
    b = _bucketed(df, keys, bucket)
    before = Window.partitionBy("_key").orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        b.groupBy("_kb", "_key", "_bkt")
        .agg(F.count(F.lit(1)).alias("_cnt"))
        .select("_kb", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    )
    within = Window.partitionBy("_kb").orderBy(order_col)
    return (
        b.join(offsets, "_kb", "inner")
        .withColumn(out, F.col("_off") + F.row_number().over(within) - 1)
        .drop("_kb", "_key", "_bkt", "_off")
    )


def with_halo(df: DataFrame, halo: int, block_rows: int, idx: str = "_idx") -> DataFrame:
    """Adds ``_blk`` and ``_halo``; rows in the last ``halo`` positions of a block are copied to the next.

    One Generate emits the row once, or twice for a halo row, so the input is
    evaluated a single time (a union of two filtered copies would evaluate it twice).
    """
    if block_rows <= halo:
        raise ValueError("block_rows must exceed the halo")
    blk = (F.col(idx) / F.lit(block_rows)).cast("bigint")
    own = F.struct(blk.alias("_blk"), F.lit(False).alias("_halo"))
    copy = F.struct((blk + 1).alias("_blk"), F.lit(True).alias("_halo"))
    tail = (F.col(idx) % block_rows) >= block_rows - halo
    copies = F.when(tail, F.array(own, copy)).otherwise(F.array(own))
    return df.select("*", F.inline(copies))


# Combiners of a prefix value p and a within-bucket running value x.
_COMBINE = {
    "sum": lambda p, x: F.coalesce(p + x, x, p),
    "max": lambda p, x: F.greatest(p, x),
    "min": lambda p, x: F.least(p, x),
    "first": lambda p, x: F.coalesce(p, x),
}


def _combined(kind: str, before: str, value: str, types: T.StructType) -> Column:
    """A prefix value and a later one together. A sum of two DECIMAL(38, s) would lose digits of s: 37 hold the terms."""
    p, x = F.col(before), F.col(value)
    dtype = types[value].dataType
    if kind == "sum" and isinstance(dtype, T.DecimalType) and dtype.precision == 38 and dtype.scale:
        narrow = f"decimal(37,{dtype.scale})"
        p, x = p.cast(narrow), x.cast(narrow)
    return _COMBINE[kind](p, x)


def _agg(kind: str, c: Column, frame: Window | None = None) -> Column:
    if kind == "first":
        fn = F.first(c, ignorenulls=True)
    else:
        fn = {"sum": F.sum, "max": F.max, "min": F.min}[kind](c)
    return fn.over(frame) if frame is not None else fn


def running(
    df: DataFrame,
    keys: list[str],
    order_col: str | list[str],
    bucket: Column,
    aggs: dict[str, tuple[str, Column]],
    carried: DataFrame | None = None,
) -> DataFrame:
    """Adds running aggregates ``name -> (kind, column)`` over rows ordered by ``order_col`` per ``keys``.

    ``carried`` (``keys`` and a column per name, a row per key) holds the values of
    rows that came before all of ``df``: a stream's earlier micro-batches.

    kinds: sum, max, min, first (first non-null value in order). The frame runs
    from the first row of the key through the current row. ``bucket`` as in
    ``dense_index``; each task holds one (key, bucket).
    """
    order = [order_col] if isinstance(order_col, str) else list(order_col)
    ord_key = F.col(order[0]) if len(order) == 1 else F.struct(*[F.col(c) for c in order])
    b = _bucketed(df, keys, bucket).select("*", *[c.alias(f"_v_{name}") for name, (_, c) in aggs.items()])

    def total(kind: str, v: Column) -> Column:
        # a groupBy ``first`` is not order-aware: take the value of the least order key
        if kind == "first":
            return F.min_by(v, F.when(v.isNotNull(), ord_key))
        return _agg(kind, v)

    totals = b.groupBy("_kb", "_key", "_bkt").agg(*[total(k, F.col(f"_v_{n}")).alias(f"_t_{n}") for n, (k, _) in aggs.items()])
    before = Window.partitionBy("_key").orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    prefix = totals.select(
        "_kb", "_key", *[_agg(k, F.col(f"_t_{n}"), before).alias(f"_p_{n}") for n, (k, _) in aggs.items()]
    )
    if carried is not None:
        past = carried.select(F.struct(*keys).alias("_key"), *[F.col(n).alias(f"_c_{n}") for n in aggs])
        prefix = prefix.join(past, "_key", "left")
        types = prefix.schema
        prefix = prefix.select("_kb", "_key", *[
            _combined(kind, f"_c_{n}", f"_p_{n}", types).alias(f"_p_{n}") for n, (kind, _) in aggs.items()
        ])
    prefix = prefix.drop("_key")
    within = Window.partitionBy("_kb").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = b.join(prefix, "_kb", "inner")
    out = joined.select("*", *[_agg(k, F.col(f"_v_{n}"), within).alias(f"_w_{n}") for n, (k, _) in aggs.items()])
    types = out.schema
    kept = [F.col(f"`{c}`") for c in df.columns if c not in aggs]
    return out.select(*kept, *[_combined(kind, f"_p_{n}", f"_w_{n}", types).alias(n) for n, (kind, _) in aggs.items()])
