"""Every ladder at its cut values, one unit to each side, and for NULL."""

import pytest
from pyspark.sql import functions as F

from authledger.functions import tiers


def labels(spark, ladder, *rows):
    kinds = ", ".join(f"c{i} double" for i in range(len(rows[0])))
    df = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], f"n int, {kinds}")
    columns = [F.col(f"c{i}") for i in range(len(rows[0]))]
    return [r.label for r in df.select("n", ladder(*columns).alias("label")).orderBy("n").collect()]


LADDERS = {
    tiers.risk_tier: [
        (0.7, "HIGH"), (0.6999, "MEDIUM"), (0.7001, "HIGH"), (0.4, "MEDIUM"), (0.3999, "LOW"), (0.0, "LOW"), (None, "LOW"),
    ],
    tiers.payer_tier: [
        (0.8, "TIER_1_BEST"), (0.7999, "TIER_2_GOOD"), (0.75, "TIER_2_GOOD"), (0.7499, "TIER_3_AVERAGE"),
        (0.7, "TIER_3_AVERAGE"), (0.6999, "TIER_4_POOR"), (None, "TIER_4_POOR"),
    ],
    tiers.compliance_status: [
        (0.35, "WATCH_LIST"), (0.3501, "NON_COMPLIANT_HIGH_DENIAL"), (0.3499, "WATCH_LIST"), (0.25, "COMPLIANT"),
        (0.2501, "WATCH_LIST"), (None, "COMPLIANT"),
    ],
    tiers.financial_risk_level: [
        (0.35, "CRITICAL"), (0.3499, "HIGH"), (0.25, "HIGH"), (0.2499, "MEDIUM"), (0.2, "MEDIUM"), (0.1999, "LOW"),
        (None, "LOW"),
    ],
}


@pytest.mark.parametrize("ladder", LADDERS, ids=lambda f: f.__name__)
def test_ladder(spark, ladder):
    values, expected = zip(*LADDERS[ladder])
    assert labels(spark, ladder, *[(v,) for v in values]) == list(expected)


def test_recommended_action(spark):
    rows = [(0.7, 2000.0), (0.7, 2000.01), (0.7, None), (0.6999, 9999.0), (0.4, None), (0.3999, 9999.0)]
    assert labels(spark, tiers.recommended_action, *rows) == [
        "APPEAL_RECOMMENDED",
        "IMMEDIATE_APPEAL_RECOMMENDED",
        "APPEAL_RECOMMENDED",
        "MONITOR",
        "MONITOR",
        "NO_ACTION",
    ]


def test_check_status(spark):
    assert labels(spark, tiers.check_status, (9.0, 10.0), (10.0, 10.0), (11.0, 10.0)) == ["FAIL", "PASS", "PASS"]


def test_uninsured_is_false_for_an_unknown_payer(spark):
    df = spark.createDataFrame([("NO_INSURANCE",), ("X",), (None,)], "payer string")
    assert [r[0] for r in df.select(tiers.is_uninsured(F.col("payer"))).collect()] == [True, False, False]
