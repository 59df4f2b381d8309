"""Rounding against decimal arithmetic in Python."""

from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from authledger.functions import exact

FEW = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def rounded(value: Decimal, digits: int) -> float:
    return float(value.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


@FEW
@given(st.lists(st.integers(0, 10**9), min_size=1, max_size=40))
def test_mean_amount(spark, cents):
    df = spark.createDataFrame([(c / 100,) for c in cents], "x double")
    got = df.agg(exact.double(exact.mean_amount(F.col("x"), 2))).first()[0]
    assert got == rounded(Decimal(sum(cents)) / 100 / len(cents), 2)


@FEW
@given(st.lists(st.integers(0, 10000), min_size=1, max_size=40))
def test_rates(spark, points):
    df = spark.createDataFrame([(p / 10000,) for p in points], "x double")
    mean, complement = df.agg(
        exact.double(exact.mean_rate(F.col("x"), 4)), exact.double(exact.complement_of_mean_rate(F.col("x"), 4))
    ).first()
    share = Decimal(sum(points)) / 10000 / len(points)
    assert (mean, complement) == (rounded(share, 4), rounded(1 - share, 4))


def test_half_up_is_symmetric(spark):
    df = spark.createDataFrame([(v,) for v in (5, 4, -5, -4, 15, 25, -25)], "v bigint")
    assert [r[0] for r in df.select(exact.half_up(F.col("v"), 10)).collect()] == [1, 0, -1, 0, 2, 3, -3]


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("junk", [float("nan"), float("inf"), float("-inf"), 1e30])
def test_numbers_that_do_not_fit_fail_in_any_mode(spark, ansi, junk):
    df = spark.createDataFrame([(10.0,), (None,), (junk,)], "x double")
    for measure in (exact.mean_amount, exact.mean_cents, exact.mean_rate):
        with pytest.raises(Exception, match="out of range"):
            df.agg(measure(F.col("x"), 2)).collect()
    assert df.filter("x = 10 OR x IS NULL").agg(exact.double(exact.mean_amount(F.col("x"), 2))).first()[0] == 10.0


def test_sums_do_not_wrap(spark, ansi):
    df = spark.range(300).select(F.lit(4.5e16).alias("x"))
    assert df.agg(exact.double(exact.total_cents(F.col("x")))).first()[0] == 300 * 4.5e16
    signs = spark.createDataFrame([(-4.5e16,), (0.01,), (4.5e16,), (-0.03,)], "x double")
    assert signs.agg(exact.double(exact.total_cents(F.col("x")))).first()[0] == -0.02
    wide = spark.createDataFrame([(9e18,)] * 3, "x double").select(F.col("x").cast("bigint").alias("x"))
    assert int(wide.agg(exact.whole_sum(F.col("x"))).first()[0]) == 27 * 10**18


def test_large_amounts_take_part(spark):
    df = spark.createDataFrame([(10.0,), (2e12,), (4e18,)], "x double")
    total = Decimal(10) + 2 * 10**12 + 4 * 10**18
    assert df.agg(exact.double(exact.mean_amount(F.col("x"), 2))).first()[0] == rounded(total / 3, 2)
    counts = spark.createDataFrame([(10**13,)], "n bigint").select(exact.count_of(F.col("n")))
    assert counts.first()[0] == 10**13


def test_sub_cent_amounts_are_kept(spark):
    df = spark.createDataFrame([(0.0049,), (0.0051,), (0.005,)], "x double")
    assert df.agg(exact.double(exact.mean_amount(F.col("x"), 4))).first()[0] == 0.005


def test_mean_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert df.agg(exact.mean_amount(F.col("x"), 2), exact.mean_rate(F.col("x"), 4)).first() == (None, None)
