"""Classification ladders. A NULL input falls through to the last label."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def risk_tier(score: Column) -> Column:
    return F.when(score >= 0.7, "HIGH").when(score >= 0.4, "MEDIUM").otherwise("LOW")


def payer_tier(approval_rate: Column) -> Column:
    return (
        F.when(approval_rate >= 0.80, "TIER_1_BEST")
        .when(approval_rate >= 0.75, "TIER_2_GOOD")
        .when(approval_rate >= 0.70, "TIER_3_AVERAGE")
        .otherwise("TIER_4_POOR")
    )


def is_uninsured(payer_name: Column) -> Column:
    """False, not NULL, for an unknown payer."""
    return payer_name.eqNullSafe("NO_INSURANCE")


def compliance_status(denial_rate: Column) -> Column:
    """The cut values themselves still belong to the milder label."""
    return (
        F.when(denial_rate > 0.35, "NON_COMPLIANT_HIGH_DENIAL")
        .when(denial_rate > 0.25, "WATCH_LIST")
        .otherwise("COMPLIANT")
    )


def financial_risk_level(denial_rate: Column) -> Column:
    """The cut values belong to the more severe label."""
    return (
        F.when(denial_rate >= 0.35, "CRITICAL")
        .when(denial_rate >= 0.25, "HIGH")
        .when(denial_rate >= 0.20, "MEDIUM")
        .otherwise("LOW")
    )


def recommended_action(score: Column, avg_charge: Column) -> Column:
    return (
        F.when((score >= 0.7) & (avg_charge > 2000), "IMMEDIATE_APPEAL_RECOMMENDED")
        .when(score >= 0.7, "APPEAL_RECOMMENDED")
        .when(score >= 0.4, "MONITOR")
        .otherwise("NO_ACTION")
    )


def check_status(row_count: Column, minimum: Column) -> Column:
    return F.when(row_count >= minimum, "PASS").otherwise("FAIL")
