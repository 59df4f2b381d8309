"""Serving views and the figures read from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from authledger.functions.exact import cents, count_of, double, mean_rate, points, ratio, total_cents
from authledger.operators.skew import top_k

EXPLORER_LIMIT = 5000
HISTOGRAM_BINS = 20
EXPLORER_COLUMNS = [
    "service_request_id",
    "patient_id",
    "payer_name",
    "claim_type",
    "coverage_type",
    "pa_risk_score",
    "risk_tier",
    "historical_approval_rate",
    "historical_denial_rate",
    "avg_submitted_charge",
    "revenue_at_risk",
]


def _millions(money: str) -> Column:
    return double(F.round(total_cents(F.col(money)), 2)) / 1e6


# --- views ------------------------------------------------------------------


def _points(rate: str) -> str:
    """SQL text of a rate in 1/10000."""
    return f"CAST(rint({rate} * 10000) AS BIGINT)"


# What can be read through a view: its columns as SQL text, so that the same list makes a
# DataFrame and a view in the catalog. Rates are in percent; ``denial_pct`` of the benchmarks is
# 100 - ``approval_pct``, the claim-weighted rate, not the patient mean of the performance
# table (our choice).
VIEW_COLUMNS = {
    "vw_pa_compliance_scorecard": [
        "payer_name", "payer_tier", "unique_patients", "total_claims", "total_approved", "avg_approval_rate",
        "avg_denial_rate", "avg_payment_amount", "avg_submitted_charge", "total_revenue_at_risk", "total_pa_requests",
        "high_risk_pa_count", "medium_risk_pa_count", "low_risk_pa_count", "avg_pa_risk_score",
        "total_pa_revenue_at_risk", "cms_compliance_status",
    ],
    "vw_revenue_at_risk": [
        "ar_payer_name AS payer_name", "ar_claim_type AS claim_type", "total_claims", "avg_submitted_charge",
        f"{_points('approval_rate')} / 100 AS approval_pct", f"{_points('denial_rate')} / 100 AS denial_pct",
        "revenue_at_risk", "financial_risk_level",
    ],
    "vw_payer_benchmarks": [
        "approval_rate_rank AS approval_rank", "payer_name",
        f"{_points('overall_approval_rate')} / 100 AS approval_pct",
        f"(10000 - {_points('overall_approval_rate')}) / 100 AS denial_pct",
        "vs_market_approval_rate", "total_claims", "total_revenue_at_risk",
    ],
}
# The stored tables that a view reads; the second one adds a column by payer.
VIEW_TABLES = {
    "vw_pa_compliance_scorecard": ("mart_pa_compliance_scorecard", None),
    "vw_revenue_at_risk": ("mart_revenue_at_risk", None),
    "vw_payer_benchmarks": ("mart_payer_benchmarks", ("payer_performance", "total_revenue_at_risk")),
}


def view_pa_compliance_scorecard(scorecard: DataFrame) -> DataFrame:
    return scorecard.selectExpr(*VIEW_COLUMNS["vw_pa_compliance_scorecard"])


def view_revenue_at_risk(revenue: DataFrame) -> DataFrame:
    return revenue.selectExpr(*VIEW_COLUMNS["vw_revenue_at_risk"])


def view_payer_benchmarks(benchmarks: DataFrame, performance: DataFrame) -> DataFrame:
    at_risk = performance.select("payer_name", "total_revenue_at_risk")
    return benchmarks.join(at_risk, "payer_name", "left").selectExpr(*VIEW_COLUMNS["vw_payer_benchmarks"])


def publish_views(spark: SparkSession, database: str) -> None:
    """Create or replace the views in the catalog, over the tables registered in ``database``.

    Replacing is one change of the catalog entry: a reader gets the old or the new view. Views
    belong to the catalog, not to the session that made them.
    """
    for view, (mart, added) in VIEW_TABLES.items():
        source = f"{database}.{mart}"
        if added:
            table, column = added
            source += f" LEFT JOIN (SELECT payer_name, {column} FROM {database}.{table}) USING (payer_name)"
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{view} AS SELECT {', '.join(VIEW_COLUMNS[view])} FROM {source}")


# --- compliance scorecard ---------------------------------------------------


def scorecard_kpis(view: DataFrame) -> DataFrame:
    return view.agg(
        F.sum("total_pa_requests").alias("total_pa_requests"),
        F.sum("high_risk_pa_count").alias("high_risk_pas"),
        _millions("total_pa_revenue_at_risk").alias("revenue_at_risk_millions"),
        F.count_if(F.col("cms_compliance_status") == "NON_COMPLIANT_HIGH_DENIAL").alias("non_compliant_payers"),
    )


def scorecard_bars(view: DataFrame) -> DataFrame:
    return view.select("payer_name", "total_pa_revenue_at_risk", "cms_compliance_status").orderBy(
        "total_pa_revenue_at_risk", "payer_name"
    )


def tier_distribution(view: DataFrame) -> DataFrame:
    tiers = {"HIGH": "high_risk_pa_count", "MEDIUM": "medium_risk_pa_count", "LOW": "low_risk_pa_count"}
    totals = view.agg(*[F.sum(c).alias(tier) for tier, c in tiers.items()])
    return totals.unpivot([], list(tiers), "risk_tier", "count")


def scorecard_detail(view: DataFrame) -> DataFrame:
    return view.select(
        "payer_name",
        "cms_compliance_status",
        "total_pa_requests",
        "high_risk_pa_count",
        "avg_pa_risk_score",
        "total_pa_revenue_at_risk",
        "avg_denial_rate",
    )


# --- revenue at risk --------------------------------------------------------


def _mean_percent(pct: str) -> Column:
    """Mean of a percentage with two digits, to four digits."""
    return ratio(total_cents(F.col(pct)), count_of(F.count(pct)), 4)


def revenue_kpis(view: DataFrame) -> DataFrame:
    return view.agg(
        _millions("revenue_at_risk").alias("revenue_at_risk_millions"),
        F.count_if(F.col("financial_risk_level") == "CRITICAL").alias("critical_combinations"),
        double(_mean_percent("denial_pct")).alias("avg_denial_pct"),
    )


def revenue_treemap(view: DataFrame) -> DataFrame:
    """Root, payer and claim-type nodes: revenue, and denial weighted by revenue."""
    revenue = cents(F.col("revenue_at_risk")).cast("decimal(20,0)")
    weighted = F.sum(cents(F.col("denial_pct")).cast("decimal(6,0)") * revenue).cast("decimal(26,0)")
    total = F.sum(revenue).cast("decimal(22,0)")
    return (
        view.rollup("payer_name", "claim_type")
        .agg(
            F.grouping_id().alias("level"),
            double(total / F.lit(100).cast("decimal(3,0)")).alias("revenue_at_risk"),
            double(ratio(weighted, total * F.lit(100).cast("decimal(3,0)"), 4)).alias("denial_pct"),
        )
        .select(
            F.when(F.col("level") == 3, "total").when(F.col("level") == 1, "payer").otherwise("claim_type").alias("node"),
            "payer_name",
            "claim_type",
            "revenue_at_risk",
            "denial_pct",
        )
    )


def revenue_scatter(view: DataFrame) -> DataFrame:
    return view.select(
        "payer_name", "claim_type", "denial_pct", "revenue_at_risk", "financial_risk_level", "total_claims"
    )


# --- payer benchmarks -------------------------------------------------------


def market_flag(view: DataFrame) -> DataFrame:
    """Payers at or above the mean approval percentage of all payers."""
    hundredths = cents(F.col("approval_pct"))
    market = view.agg(F.struct(F.sum(hundredths).alias("total"), F.count(hundredths).alias("n"))).scalar()
    total, n = F.col("market.total"), F.col("market.n")
    mean = ratio(total.cast("decimal(20,0)"), n.cast("decimal(12,0)") * 100, 4)
    return (
        view.select("payer_name", "approval_pct")
        .withColumn("market", market)
        .select(
            "payer_name",
            "approval_pct",
            double(mean).alias("market_avg_pct"),
            (hundredths * n >= total).alias("at_or_above_market"),
        )
    )


def revenue_by_payer(view: DataFrame) -> DataFrame:
    return view.select("payer_name", "total_revenue_at_risk", "approval_pct").orderBy(
        F.col("total_revenue_at_risk").desc_nulls_first(), "payer_name"
    )


def payer_ranking(view: DataFrame) -> DataFrame:
    return view.select(
        "approval_rank",
        "payer_name",
        "approval_pct",
        "denial_pct",
        "vs_market_approval_rate",
        "total_claims",
        "total_revenue_at_risk",
    )


# --- explorer ---------------------------------------------------------------


def flagged_requests(scores: DataFrame) -> DataFrame:
    return scores.filter(F.col("risk_tier").isin("HIGH", "MEDIUM")).select(*EXPLORER_COLUMNS)


def explorer_top_requests(scores: DataFrame, limit: int = EXPLORER_LIMIT) -> DataFrame:
    """The riskiest HIGH and MEDIUM requests; the id breaks ties of the score."""
    return top_k(flagged_requests(scores), limit, "pa_risk_score", "service_request_id")


def explorer_filter(
    scores: DataFrame,
    payers: list[str | None] = (),
    tiers: list[str] = ("HIGH",),
    claim_types: list[str] = (),
    pre_limit: bool = True,
) -> DataFrame:
    """Requests that pass every non-empty filter; None among the choices means unknown.

    The filters see only the top requests, as on the page; ``pre_limit=False``
    filters all flagged requests instead.
    """
    shown = explorer_top_requests(scores) if pre_limit else flagged_requests(scores)
    for column, wanted in (("payer_name", payers), ("risk_tier", tiers), ("claim_type", claim_types)):
        if wanted:
            chosen = F.coalesce(F.col(column).isin([w for w in wanted if w is not None]), F.lit(False))
            shown = shown.filter(chosen | F.col(column).isNull() if None in wanted else chosen)
    return shown


def explorer_options(shown: DataFrame) -> DataFrame:
    """Choices of the payer filter (an unknown payer is one) and the claim-type filter."""
    pairs = F.array(
        F.struct(F.lit("payer").alias("filter"), F.col("payer_name").alias("choice")),
        F.struct(F.lit("claim_type").alias("filter"), F.col("claim_type").alias("choice")),
    )
    return (
        shown.select(F.inline(pairs))
        .filter((F.col("filter") == "payer") | F.col("choice").isNotNull())
        .distinct()
    )


def explorer_kpis(shown: DataFrame) -> DataFrame:
    return shown.agg(
        F.count("*").alias("requests_shown"),
        double(mean_rate(F.col("pa_risk_score"), 4)).alias("avg_risk_score"),
        _millions("revenue_at_risk").alias("revenue_at_risk_millions"),
    )


def explorer_score_histogram(shown: DataFrame) -> DataFrame:
    """Requests per tier and score bin of width 0.05; a score of 1 falls into the last bin."""
    width = 10000 // HISTOGRAM_BINS
    bin_no = F.least(F.call_function("div", points(F.col("pa_risk_score")), F.lit(width)), F.lit(HISTOGRAM_BINS - 1))
    return (
        shown.groupBy("risk_tier", bin_no.cast("int").alias("bin"))
        .agg(F.count("*").alias("requests"))
        .select("risk_tier", (F.col("bin") / HISTOGRAM_BINS).alias("bin_start"), "requests")
    )


def explorer_detail(shown: DataFrame) -> DataFrame:
    return shown.select(
        "service_request_id",
        "payer_name",
        "claim_type",
        "risk_tier",
        "pa_risk_score",
        "historical_denial_rate",
        "avg_submitted_charge",
        "revenue_at_risk",
    )
