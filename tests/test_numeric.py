from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from candela.functions.format import fixed2, human_number
from candela.functions.numeric import halfup_div

CASES = [
    # (num, den, scale) including quotients ending in 5 at scales 4 and 8, both signs
    ("1", "8", 2),
    ("-1", "8", 2),
    ("0.00012345", "1", 4),
    ("-0.00012345", "1", 4),
    ("0.000000125", "1", 8),
    ("-0.000000125", "1", 8),
    ("1", "3", 8),
    ("2", "3", 8),
    ("-2", "3", 8),
    ("0.1234495", "1", 4),
    ("123456789.12345678", "7", 8),
]


@pytest.mark.parametrize("num,den,scale", CASES)
def test_halfup_div_matches_bigdecimal(spark, num, den, scale):
    df = spark.createDataFrame([(Decimal(num), Decimal(den))], "n decimal(38,16), d decimal(38,16)")
    got = df.select(halfup_div(F.col("n"), F.col("d"), scale, 16, 16).alias("q")).first().q
    want = (Decimal(num) / Decimal(den)).quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP)
    assert got == want


def test_single_rounding_not_double(spark):
    # 0.1234495 -> HALF_UP at 4 is 0.1234; rounding at 6 first would give 0.1235
    df = spark.createDataFrame([(Decimal("0.1234495"), Decimal("1"))], "n decimal(38,16), d decimal(38,16)")
    assert df.select(halfup_div(F.col("n"), F.col("d"), 4, 16, 16).alias("q")).first().q == Decimal("0.1234")


def test_fixed2_half_up(spark):
    df = spark.createDataFrame([(Decimal("1.2350"),), (Decimal("-1.2350"),), (Decimal("2.0049"),)], "x decimal(38,4)")
    assert [r.t for r in df.select(fixed2(F.col("x")).alias("t")).collect()] == ["1.24", "-1.24", "2.00"]


def test_human_number(spark):
    vals = ["999.995", "1000", "1234567.891", "999999999.999", "1000000000", "12.344"]
    df = spark.createDataFrame([(Decimal(v),) for v in vals], "x decimal(38,16)")
    got = [r.t for r in df.select(human_number(F.col("x")).alias("t")).collect()]
    assert got == ["1000.00", "1.00K", "1.23M", "1000.00M", "1.00B", "12.34"]
