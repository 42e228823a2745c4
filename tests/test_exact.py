"""Exact unit sums: equal to DECIMAL sums, order independent, signed."""

from decimal import Decimal

from pyspark.sql import functions as F

from sparklab.functions.exact import money_sum, round_units, units, units_sum


def test_units_sum_matches_decimal(spark):
    vals = [12345.67, -0.01, 0.07, 99999.99, -42.5, 0.0, 1e-2] * 50
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(7)
    got = df.agg(money_sum(units("x"), 2).alias("s")).first().s
    exact = sum(Decimal(str(v)) for v in vals)
    assert got == float(exact)


def test_units_sum_large_values(spark):
    df = spark.range(1000).select(((F.col("id") + 1) * F.lit(1 << 39)).alias("x"))
    got = df.agg(units_sum(F.col("x")).alias("s")).first().s
    assert got == sum((i + 1) * (1 << 39) for i in range(1000))


def test_round_units_half_away_from_zero(spark):
    df = spark.createDataFrame([(12350,), (-12350,), (12349,)], "t long")
    out = [r.r for r in df.select(round_units(F.col("t").cast("decimal(38,0)"), 4, 2).alias("r")).collect()]
    assert out == [1.24, -1.24, 1.23]
