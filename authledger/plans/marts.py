"""Marts on top of the staging models."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from authledger import schemas
from authledger.functions.exact import (
    cents,
    count_of,
    double,
    half_up,
    mean_cents,
    mean_rate,
    points,
    ratio,
    total_cents,
)
from authledger.functions.tiers import compliance_status, financial_risk_level, recommended_action
from authledger.plans.staging import stamp

TARGET_APPROVAL = 0.80
MONEY = "decimal(16,2)"


def pa_by_payer(scores: DataFrame) -> DataFrame:
    """Request counts and risk per payer."""
    tier = F.col("risk_tier")
    return (
        scores.filter(F.col("payer_name").isNotNull())
        .groupBy("payer_name")
        .agg(
            F.count("service_request_id").alias("total_pa_requests"),
            F.count_if(tier == "HIGH").alias("high_risk_pa_count"),
            F.count_if(tier == "MEDIUM").alias("medium_risk_pa_count"),
            F.count_if(tier == "LOW").alias("low_risk_pa_count"),
            double(mean_rate(F.col("pa_risk_score"), 4)).alias("avg_pa_risk_score"),
            double(F.round(total_cents(F.col("revenue_at_risk")), 2)).alias("total_pa_revenue_at_risk"),
        )
    )


def mart_pa_compliance_scorecard(
    performance: DataFrame, scores: DataFrame, as_of: datetime | None = None
) -> DataFrame:
    """Compliance per payer.

    The requests are aggregated per payer before the join: the join then meets
    one row per payer on both sides instead of every request.
    """
    counts = [
        "total_pa_requests", "high_risk_pa_count", "medium_risk_pa_count", "low_risk_pa_count",
    ]
    return (
        performance.join(pa_by_payer(scores), "payer_name", "left")
        .select(
            "payer_name",
            "payer_tier",
            "unique_patients",
            "total_claims",
            "total_approved",
            "avg_approval_rate",
            "avg_denial_rate",
            "avg_payment_amount",
            "avg_submitted_charge",
            "total_revenue_at_risk",
            *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
            "avg_pa_risk_score",
            "total_pa_revenue_at_risk",
            compliance_status(F.col("avg_denial_rate")).alias("cms_compliance_status"),
            stamp(as_of).alias("mart_updated_at"),
        )
        .orderBy(F.col("total_pa_revenue_at_risk").desc_nulls_first(), "payer_name")
    )


def mart_revenue_at_risk(rates: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Exposure per claim type and payer, and what an approval rate of 80 % would recover."""
    denied = F.col("total_claims") - F.col("total_approved")
    at_risk = denied.cast("decimal(20,0)") * F.col("avg_submitted_charge").cast(MONEY)
    gap = (F.lit(int(TARGET_APPROVAL * 10000)) - points(F.col("approval_rate"))).cast("decimal(5,0)")
    recovered = (
        gap
        * F.col("total_claims").cast("decimal(15,0)")
        * F.col("avg_payment_amount").cast(MONEY)
        / F.lit(10000).cast("decimal(5,0)")
    )
    recovery = F.when(F.col("approval_rate") < TARGET_APPROVAL, F.round(recovered, 2)).otherwise(0)
    return rates.select(
        "ar_claim_type",
        "ar_payer_name",
        "total_patients",
        "total_claims",
        "total_approved",
        denied.alias("total_denied"),
        "approval_rate",
        "denial_rate",
        "avg_payment_amount",
        "avg_submitted_charge",
        "charge_to_payment_ratio",
        double(F.round(at_risk, 2)).alias("revenue_at_risk"),
        double(recovery).alias("recovery_potential_at_80pct"),
        financial_risk_level(F.col("denial_rate")).alias("financial_risk_level"),
        stamp(as_of).alias("mart_updated_at"),
    ).orderBy(F.col("revenue_at_risk").desc_nulls_first(), "ar_payer_name", "ar_claim_type")


def payer_summary(rates: DataFrame) -> DataFrame:
    """Rates rolled up to the payer; here the approval rate is approved / claims."""
    claims, approved = F.sum("total_claims"), F.sum("total_approved")
    return rates.groupBy(F.col("ar_payer_name").alias("payer_name")).agg(
        claims.alias("total_claims"),
        approved.alias("total_approved"),
        double(ratio(count_of(approved), count_of(claims), 4)).alias("overall_approval_rate"),
        double(mean_cents(F.col("avg_payment_amount"), 2)).alias("avg_payment"),
        double(mean_cents(F.col("avg_submitted_charge"), 2)).alias("avg_charge"),
        double(mean_rate(F.col("charge_to_payment_ratio"), 4)).alias("avg_charge_ratio"),
        F.count_distinct("ar_claim_type").alias("claim_types_covered"),
    )


def _market(summary: DataFrame) -> DataFrame:
    """Rank and market totals per distinct approval rate.

    A rate is a share rounded to four digits, so this has at most 10,002 rows
    (0.0000 .. 1.0000 and NULL) for any number of payers: the windows without
    partitions below and the broadcast of the result are bounded by that.
    """
    rate_points = points(F.col("overall_approval_rate"))
    per_rate = summary.groupBy("overall_approval_rate").agg(
        F.count("*").alias("payers"),
        F.sum(cents(F.col("avg_charge"))).alias("charge_cents"),
        F.count("avg_charge").alias("charged"),
    )
    better = Window.orderBy(F.col("overall_approval_rate").desc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    market = Window.partitionBy()
    return per_rate.select(
        "overall_approval_rate",
        (F.coalesce(F.sum("payers").over(better), F.lit(0)) + 1).alias("approval_rate_rank"),
        F.sum("payers").over(market).alias("total_payers"),
        F.sum(rate_points * F.col("payers")).over(market).alias("market_points"),
        F.sum(F.when(rate_points.isNotNull(), F.col("payers"))).over(market).alias("rated"),
        F.sum("charge_cents").over(market).alias("market_cents"),
        F.sum("charged").over(market).alias("market_charged"),
    )


def _minus_mean(units: str, total: str, n: str, scale: int):
    """value - total / n in units of 10^-scale, rounded at that digit."""
    difference = (F.col(units).cast("decimal(18,0)") * F.col(n).cast("decimal(10,0)") - F.col(total)).cast(
        "decimal(24,0)"
    )
    rounded = ratio(difference, count_of(F.col(n)), 0)
    return rounded.cast("bigint") / 10**scale


def mart_payer_benchmarks(rates: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Payers against the market mean, ranked by approval rate.

    Payers with one rate share a rank and leave a gap; a payer without a rate
    ranks first, as NULL sorts first in a descending order there.
    """
    summary = payer_summary(rates)
    return (
        summary.join(
            F.broadcast(_market(summary).withColumnRenamed("overall_approval_rate", "market_rate")),
            F.col("overall_approval_rate").eqNullSafe(F.col("market_rate")),
        )
        .withColumn("rate_points", points(F.col("overall_approval_rate")))
        .withColumn("avg_cents", cents(F.col("avg_charge")))
        .select(
            "payer_name",
            "total_claims",
            "total_approved",
            "overall_approval_rate",
            "avg_payment",
            "avg_charge",
            "avg_charge_ratio",
            "claim_types_covered",
            _minus_mean("rate_points", "market_points", "rated", 4).alias("vs_market_approval_rate"),
            _minus_mean("avg_cents", "market_cents", "market_charged", 2).alias("vs_market_avg_charge"),
            "approval_rate_rank",
            "total_payers",
            stamp(as_of).alias("mart_updated_at"),
        )
        .orderBy("approval_rate_rank", "payer_name")
    )


def mart_high_risk_pa_requests(scores: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """HIGH and MEDIUM requests with urgency and advice, in no order; ``urgent_first`` orders them."""
    score, charge = F.col("pa_risk_score"), F.col("avg_submitted_charge")
    urgency = half_up(points(score) * F.coalesce(cents(charge), F.lit(0)), 100_000) / 10000
    return scores.filter(F.col("risk_tier").isin("HIGH", "MEDIUM")).select(
        *schemas.columns("pa_risk_scores"),
        "is_uninsured",
        urgency.alias("priority_score"),
        recommended_action(score, charge).alias("recommended_action"),
        stamp(as_of).alias("mart_updated_at"),
    )


def urgent_first() -> list[Column]:
    """Order of the high-risk mart: it is stored in ranges of these keys, and sorted when read."""
    return [F.desc("priority_score"), F.col("service_request_id")]
