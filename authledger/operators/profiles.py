"""Per-patient payment, claim and coverage facts, and the profile that joins them.

An id of '' stands for a reference nobody could read. It would pool strangers
into one patient, so it is no patient here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from authledger.functions.exact import count_of, double, mean_amount, ratio


def known_patient(column: str = "patient_id") -> Column:
    return F.nullif(F.col(column), F.lit(""))


def _text(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def eob_by_patient(explanations: DataFrame) -> DataFrame:
    """Adjudicated explanations per patient; one is approved when something was paid."""
    adjudicated = explanations.select(
        known_patient().alias("patient_id"), "payment_amount"
    ).filter(F.col("payment_amount").isNotNull() & F.col("patient_id").isNotNull())
    counted = adjudicated.groupBy("patient_id").agg(
        F.count("*").alias("total_claims"),
        F.count_if(F.col("payment_amount") > 0).alias("approved_claims"),
        double(mean_amount(F.col("payment_amount"), 2)).alias("avg_payment"),
    )
    share = ratio(count_of(F.col("approved_claims")), count_of(F.col("total_claims")), 4)
    return counted.select(
        "patient_id", "total_claims", "approved_claims", double(share).alias("approval_rate"), "avg_payment"
    )


def claims_by_patient(claims: DataFrame) -> DataFrame:
    """Typed claims per patient: type of the earliest (created, claim_id), mean charge."""
    typed = claims.select(
        known_patient().alias("patient_id"), "claim_type", "total_submitted_charge", "created", "claim_id"
    ).filter(F.col("claim_type").isNotNull() & F.col("patient_id").isNotNull())
    return typed.groupBy("patient_id").agg(
        F.min_by("claim_type", F.struct(_text("created"), _text("claim_id"))).alias("primary_claim_type"),
        double(mean_amount(F.col("total_submitted_charge"), 2)).alias("avg_charge"),
    )


def coverage_current(coverages: DataFrame) -> DataFrame:
    """Payer and type of the latest (coverage_start, coverage_id); the payer may be NULL."""
    known = coverages.select(
        known_patient().alias("patient_id"), "payer_name", "coverage_type", "coverage_start", "coverage_id"
    ).filter(F.col("patient_id").isNotNull())
    latest = F.max_by(
        F.struct("payer_name", "coverage_type"), F.struct(_text("coverage_start"), _text("coverage_id"))
    )
    return (
        known.groupBy("patient_id")
        .agg(latest.alias("latest"))
        .select("patient_id", "latest.payer_name", "latest.coverage_type")
    )


def patient_profile(claims: DataFrame, explanations: DataFrame, coverages: DataFrame) -> DataFrame:
    """One row per patient with typed claims and adjudicated explanations.

    The three inputs are aggregated on the patient before they are joined, so each
    is shuffled once, as partial aggregates, and the joins reuse that partitioning.
    """
    return joined_profile(claims_by_patient(claims), eob_by_patient(explanations), coverage_current(coverages))


def joined_profile(claims: DataFrame, explanations: DataFrame, coverage: DataFrame) -> DataFrame:
    """The profile out of the three aggregates per patient."""
    return (
        claims.join(explanations, "patient_id")
        .join(coverage, "patient_id", "left")
        .select(
            "patient_id",
            "primary_claim_type",
            "avg_charge",
            "total_claims",
            "approved_claims",
            "approval_rate",
            "avg_payment",
            "payer_name",
            "coverage_type",
        )
    )


def with_payer(profile: DataFrame) -> DataFrame:
    return profile.filter(F.col("payer_name").isNotNull())
