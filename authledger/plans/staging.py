"""Staging models: gold columns plus one derived column and a load stamp each."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from authledger import schemas
from authledger.functions.exact import double, ratio
from authledger.functions.tiers import is_uninsured, payer_tier

MONEY = "decimal(18,2)"


def stamp(as_of: datetime | None) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(as_of)


def stg_approval_rates(rates: DataFrame, as_of: datetime | None = None) -> DataFrame:
    charge = F.col("avg_submitted_charge").cast(MONEY)
    payment = F.col("avg_payment_amount").cast(MONEY)
    return rates.filter(F.col("ar_claim_type").isNotNull()).select(
        *schemas.columns("procedure_approval_rates"),
        double(F.when(payment > 0, ratio(charge, payment, 4))).alias("charge_to_payment_ratio"),
        stamp(as_of).alias("dbt_loaded_at"),
    )


def stg_payer_performance(performance: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return performance.filter(F.col("payer_name").isNotNull()).select(
        *schemas.columns("payer_performance"),
        payer_tier(F.col("avg_approval_rate")).alias("payer_tier"),
        stamp(as_of).alias("dbt_loaded_at"),
    )


def stg_pa_risk_scores(scores: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return scores.filter(F.col("service_request_id").isNotNull()).select(
        *schemas.columns("pa_risk_scores"),
        is_uninsured(F.col("payer_name")).alias("is_uninsured"),
        stamp(as_of).alias("dbt_loaded_at"),
    )
