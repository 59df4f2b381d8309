from datetime import datetime

import pytest
from pyspark.sql import functions as F

from authledger.plans import marts, quality, serving, staging
from test_scoring import frame

AS_OF = datetime(2026, 1, 1)


@pytest.fixture(scope="module")
def performance(spark):
    return frame(
        spark, "payer_performance",
        {"payer_name": "A", "avg_approval_rate": 0.8, "avg_denial_rate": 0.2, "total_claims": 10, "total_approved": 8},
        {"payer_name": "B", "avg_approval_rate": 0.64, "avg_denial_rate": 0.36, "total_claims": 10, "total_approved": 6},
        {"payer_name": None},
    )


@pytest.fixture(scope="module")
def scores(spark):
    return frame(
        spark, "pa_risk_scores",
        {"service_request_id": "1", "payer_name": "B", "pa_risk_score": 0.9, "risk_tier": "HIGH",
         "avg_submitted_charge": 2000.01, "revenue_at_risk": 1800.01, "claim_type": "x"},
        {"service_request_id": "2", "payer_name": "B", "pa_risk_score": 0.4, "risk_tier": "MEDIUM",
         "avg_submitted_charge": None, "revenue_at_risk": 0.0},
        {"service_request_id": "3", "payer_name": None, "pa_risk_score": 0.5, "risk_tier": "MEDIUM",
         "avg_submitted_charge": 10.0, "revenue_at_risk": 5.0, "claim_type": "y"},
        {"service_request_id": "4", "payer_name": "NO_INSURANCE", "pa_risk_score": 0.1, "risk_tier": "LOW",
         "revenue_at_risk": 1.0},
        {"service_request_id": None, "risk_tier": "HIGH"},
    )


@pytest.fixture(scope="module")
def rates(spark):
    def row(payer, kind, claims, approved, charge=100.0, payment=50.0):
        share = approved / claims if claims else 0.0
        return {
            "ar_payer_name": payer, "ar_claim_type": kind, "total_claims": claims, "total_approved": approved,
            "approval_rate": share, "denial_rate": round(1 - share, 4), "avg_submitted_charge": charge,
            "avg_payment_amount": payment,
        }

    return frame(
        spark, "procedure_approval_rates",
        row("A", "x", 10, 8), row("B", "x", 6, 3, 300.0, 0.0), row("B", "y", 4, 2, 200.0, 40.0),
        row("C", "x", 10, 5), row("Z", "x", 0, 0, None, None), row("Q", None, 1, 1),
    )


def test_staging_stamps_and_filters(performance, scores, rates):
    assert staging.stg_payer_performance(performance, AS_OF).count() == 2
    assert staging.stg_pa_risk_scores(scores, AS_OF).count() == 4
    staged = staging.stg_approval_rates(rates, AS_OF)
    assert staged.count() == 5
    assert {r.dbt_loaded_at for r in staged.collect()} == {AS_OF}
    ratios = {(r.ar_payer_name, r.ar_claim_type): r.charge_to_payment_ratio for r in staged.collect()}
    assert ratios["A", "x"] == 2.0
    assert ratios["B", "x"] is None  # nothing was paid
    assert ratios["Z", "x"] is None


def test_scorecard_keeps_payers_without_requests(performance, scores):
    card = marts.mart_pa_compliance_scorecard(
        staging.stg_payer_performance(performance), staging.stg_pa_risk_scores(scores), AS_OF
    ).collect()
    assert [r.payer_name for r in card] == ["A", "B"]  # unknown revenue first
    a, b = card
    assert (a.total_pa_requests, a.high_risk_pa_count, a.avg_pa_risk_score, a.total_pa_revenue_at_risk) == (0, 0, None, None)
    assert (b.total_pa_requests, b.high_risk_pa_count, b.medium_risk_pa_count, b.low_risk_pa_count) == (2, 1, 1, 0)
    assert (b.avg_pa_risk_score, b.total_pa_revenue_at_risk) == (0.65, 1800.01)
    assert (a.cms_compliance_status, b.cms_compliance_status) == ("COMPLIANT", "NON_COMPLIANT_HIGH_DENIAL")
    assert (a.payer_tier, a.mart_updated_at) == ("TIER_1_BEST", AS_OF)


def test_revenue(rates):
    rows = {
        (r.ar_payer_name, r.ar_claim_type): r
        for r in marts.mart_revenue_at_risk(staging.stg_approval_rates(rates)).collect()
    }
    a, c = rows["A", "x"], rows["C", "x"]
    assert (a.total_denied, a.revenue_at_risk, a.recovery_potential_at_80pct, a.financial_risk_level) == (2, 200.0, 0.0, "MEDIUM")
    assert (c.total_denied, c.revenue_at_risk, c.recovery_potential_at_80pct, c.financial_risk_level) == (5, 500.0, 150.0, "CRITICAL")
    assert rows["Z", "x"].revenue_at_risk is None


def test_benchmarks_share_ranks_and_put_unknown_rates_first(rates):
    rows = marts.mart_payer_benchmarks(staging.stg_approval_rates(rates)).collect()
    assert [(r.payer_name, r.approval_rate_rank) for r in rows] == [("Z", 1), ("A", 2), ("B", 3), ("C", 3)]
    assert {r.total_payers for r in rows} == {4}
    by_payer = {r.payer_name: r for r in rows}
    assert by_payer["Z"].vs_market_approval_rate is None
    assert [by_payer[p].vs_market_approval_rate for p in "ABC"] == [0.2, -0.1, -0.1]
    assert [by_payer[p].vs_market_avg_charge for p in "ABC"] == [-50.0, 100.0, -50.0]
    assert (by_payer["B"].claim_types_covered, by_payer["B"].overall_approval_rate) == (2, 0.5)


def test_ranks_equal_a_window_over_all_payers(spark):
    """The rank over distinct rates against the plain window."""
    rates = spark.range(500).select(
        F.lit("x").alias("ar_claim_type"), F.concat(F.lit("p"), "id").alias("ar_payer_name"),
        F.lit(1).cast("bigint").alias("total_patients"), (F.col("id") % 37).alias("total_claims"),
        (F.col("id") % 37 - F.col("id") % 5 * (F.col("id") % 37 >= 4).cast("int")).alias("total_approved"),
        F.lit(0.5).alias("approval_rate"), F.lit(0.5).alias("denial_rate"),
        F.lit(1.0).alias("avg_payment_amount"), (F.col("id") / 100).alias("avg_submitted_charge"),
        F.lit(1.0).alias("charge_to_payment_ratio"),
    )
    got = marts.mart_payer_benchmarks(rates).select("payer_name", "approval_rate_rank", "total_payers")
    marts.payer_summary(rates).createOrReplaceTempView("summary")
    want = spark.sql(
        "SELECT payer_name, CAST(rank() OVER (ORDER BY overall_approval_rate DESC NULLS FIRST) AS BIGINT), count(*) OVER () FROM summary"
    )
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_high_risk_requests(scores):
    rows = marts.mart_high_risk_pa_requests(staging.stg_pa_risk_scores(scores), AS_OF).orderBy(*marts.urgent_first()).collect()
    assert [(r.service_request_id, r.priority_score, r.recommended_action) for r in rows] == [
        ("1", 1.8, "IMMEDIATE_APPEAL_RECOMMENDED"),
        ("3", 0.005, "MONITOR"),
        ("2", 0.0, "MONITOR"),
    ]


def test_explorer_filters(scores):
    def ids(**filters):
        return sorted(r.service_request_id for r in serving.explorer_filter(scores.filter("service_request_id IS NOT NULL"), **filters).collect())

    assert ids() == ["1"]
    assert ids(tiers=[]) == ["1", "2", "3"]
    assert ids(tiers=[], payers=["B"]) == ["1", "2"]
    assert ids(tiers=["MEDIUM"], claim_types=["y"], pre_limit=False) == ["3"]
    options = serving.explorer_options(serving.flagged_requests(scores))
    assert {(r["filter"], r.choice) for r in options.collect()} == {
        ("payer", None), ("payer", "B"), ("claim_type", "x"), ("claim_type", "y")}


def test_filters_see_only_the_top_requests(spark):
    rows = [
        {"service_request_id": str(i), "payer_name": "B" if i else "A", "pa_risk_score": 0.9 if i else 0.8, "risk_tier": "HIGH"}
        for i in range(6)
    ]
    scores = frame(spark, "pa_risk_scores", *rows)
    top = serving.explorer_top_requests(scores, limit=5)
    assert top.filter("payer_name = 'A'").count() == 0
    assert serving.explorer_filter(scores, payers=["A"], pre_limit=False).count() == 1


def test_histogram_puts_certainty_into_the_last_bin(spark):
    rows = [{"service_request_id": str(s), "pa_risk_score": s, "risk_tier": "HIGH"} for s in (0.7, 0.7499, 0.75, 0.95, 1.0)]
    bins = serving.explorer_score_histogram(frame(spark, "pa_risk_scores", *rows)).collect()
    assert {(r.bin_start, r.requests) for r in bins} == {(0.7, 2), (0.75, 1), (0.95, 2)}


def test_treemap_without_revenue_has_no_weighted_rate(spark):
    view = spark.createDataFrame(
        [("A", "x", 0.0, 30.0), ("B", "x", 10.0, 20.0), ("B", "y", 30.0, 40.0)],
        "payer_name string, claim_type string, revenue_at_risk double, denial_pct double",
    )
    nodes = {(r.node, r.payer_name, r.claim_type): (r.revenue_at_risk, r.denial_pct) for r in serving.revenue_treemap(view).collect()}
    assert nodes["payer", "A", None] == (0.0, None)
    assert nodes["payer", "B", None] == (40.0, 35.0)
    assert nodes["total", None, None] == (40.0, 35.0)
    assert len(nodes) == 6


def test_quality_gate(spark):
    counts = spark.createDataFrame([("small", 9), ("enough", 10), ("unchecked", 1)], "table_name string, row_count bigint")
    report = quality.quality_report(spark, counts, {"small": 10, "enough": 10})
    assert {(r.table_name, r.row_count, r.status) for r in report.collect()} == {("small", 9, "FAIL"), ("enough", 10, "PASS")}
    assert [tuple(r) for r in quality.quality_failures(report).collect()] == [("small", "small: 9 < 10")]
    with pytest.raises(quality.QualityError, match="small: 9 < 10"):
        quality.assert_quality(report)
    quality.assert_quality(report.filter("status = 'PASS'"))


def test_explorer_filter_takes_the_unknown_payer(spark):
    import __spark_entry__ as entry
    from authledger.plans import serving

    scores = entry.Model(spark, "/root/testdata/sf0.001").scores
    unknown = serving.explorer_filter(scores, payers=[None], tiers=[])
    assert unknown.count() == 47
    assert unknown.filter("payer_name IS NOT NULL").isEmpty()
