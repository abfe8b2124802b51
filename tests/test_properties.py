"""Randomised properties: exact rounding, skew-safe running scans."""

from decimal import ROUND_HALF_UP, Decimal, localcontext

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from candela.functions.numeric import halfup_div
from candela.plans.ordered import dense_index, running

decimals = st.decimals(min_value=Decimal("-1e9"), max_value=Decimal("1e9"), places=8, allow_nan=False,
                       allow_infinity=False)
positive = st.decimals(min_value=Decimal("0.00000001"), max_value=Decimal("1e6"), places=8, allow_nan=False,
                       allow_infinity=False)


@settings(max_examples=1, deadline=None)
@given(st.lists(st.tuples(decimals, positive, st.sampled_from([0, 2, 4, 8])), min_size=40, max_size=60))
def test_halfup_matches_python_decimal(spark, cases):
    rows = [(n, d, s) for n, d, s in cases]
    df = spark.createDataFrame(rows, "n decimal(38,16), d decimal(38,16), s int")
    got = {}
    for s in (0, 2, 4, 8):
        part = df.filter(F.col("s") == s).select("n", "d", halfup_div("n", "d", s, 16, 16).alias("q")).collect()
        for r in part:
            got[(r.n, r.d, s)] = r.q
    for n, d, s in rows:
        with localcontext() as ctx:
            ctx.prec = 80
            exact = (n / d).quantize(Decimal(1).scaleb(-s), rounding=ROUND_HALF_UP)
        key = (n.quantize(Decimal("1e-16")), d.quantize(Decimal("1e-16")), s)
        assert got[key] == exact, (n, d, s)


def test_running_on_a_hot_key_equals_a_window(spark):
    # one key holds most rows; tiny buckets split it across many tasks
    df = spark.range(0, 5000).select(
        F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string")))
        .alias("k"),
        F.col("id").alias("o"),
        ((F.col("id") * 7919) % 1000 - 500).alias("v"),
    )
    bucket = F.floor(F.col("o") / 37)
    got = running(df, ["k"], "o", bucket, {
        "s": ("sum", F.col("v")), "mx": ("max", F.col("v")), "mn": ("min", F.col("v")),
        "f": ("first", F.when(F.col("v") > 400, F.col("v"))),
    }).select("k", "o", "s", "mx", "mn", "f")
    w = Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select(
        "k", "o", F.sum("v").over(w).alias("s"), F.max("v").over(w).alias("mx"), F.min("v").over(w).alias("mn"),
        F.first(F.when(F.col("v") > 400, F.col("v")), ignorenulls=True).over(w).alias("f"),
    )
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    idx = dense_index(df, ["k"], "o", bucket).select("k", "o", "_idx")
    rn = df.select("k", "o", (F.row_number().over(Window.partitionBy("k").orderBy("o")) - 1).alias("_idx"))
    assert idx.exceptAll(rn).count() == 0
