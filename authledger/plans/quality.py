"""Row-count checks of the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from authledger.functions.tiers import check_status

# Minimum rows per silver and gold table.
MINIMUM_ROWS = {
    "patients": 4000,
    "claims": 400000,
    "explanations": 400000,
    "coverages": 400000,
    "encounters": 200000,
    "conditions": 150000,
    "prior_auth": 400000,
    "pa_risk_scores": 400000,
    "procedure_approval_rates": 10,
    "payer_performance": 5,
}
# Ours: a mart is checked like the table it is built from.
MART_MINIMUM_ROWS = {
    "mart_pa_compliance_scorecard": 5,
    "mart_revenue_at_risk": 10,
    "mart_payer_benchmarks": 5,
    "mart_high_risk_pa_requests": 1,
}


class QualityError(Exception):
    """At least one table is below its minimum."""


def quality_report(spark: SparkSession, counts: DataFrame, minimums: dict[str, int]) -> DataFrame:
    """(table_name, row_count, minimum_rows, status) of every counted table with a minimum."""
    limits = spark.createDataFrame(list(minimums.items()), "table_name string, minimum_rows bigint")
    return counts.join(limits, "table_name").select(
        "table_name",
        "row_count",
        "minimum_rows",
        check_status(F.col("row_count"), F.col("minimum_rows")).alias("status"),
    )


def quality_failures(report: DataFrame) -> DataFrame:
    return report.filter(F.col("status") == "FAIL").select(
        "table_name",
        F.format_string("%s: %d < %d", "table_name", "row_count", "minimum_rows").alias("message"),
    )


def assert_quality(report: DataFrame) -> None:
    """Raise with the message of every failing table; a report has one row per table."""
    messages = [row["message"] for row in quality_failures(report).orderBy("table_name").collect()]
    if messages:
        raise QualityError("; ".join(messages))
