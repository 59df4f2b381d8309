"""The batch jobs: bundles -> silver -> gold -> marts -> quality gate.

Every step ends in tables on shared storage and starts from them, so a lost
executor costs the recomputation of its tasks and a failed job restarts at its
own step.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from authledger.operators import profiles, scoring, silver
from authledger.plans import marts, quality, serving, staging
from authledger.session import scratch_dir
from authledger import schemas
from authledger.sources import bundles
from authledger.sources.tables import (
    count_stored,
    create_database,
    read_table,
    register_table,
    write_clustered,
    write_table,
)

PROFILE = "patient_profile"
HIGH_RISK = "mart_high_risk_pa_requests"


def build_silver(spark: SparkSession, bundle_dir: str, silver_dir: str) -> DataFrame:
    """Parse all bundles once; returns the distribution of resource types.

    The parsed rows are staged once, partitioned by target table, and each table
    is written from its own partition. Unreadable and empty files go to ``quarantine``,
    amounts that are no number to ``unusable_amounts``.
    """
    bundles.assert_arrived(spark, bundle_dir)
    stage = scratch_dir(spark, "resources")
    files = bundles.read_bundles(spark, bundle_dir)
    stage_rows(silver.staged_rows(bundles.resources_and_rejects(files)), stage)
    staged = spark.read.parquet(stage)

    for table in silver.PROJECTIONS:
        mine = staged.filter(F.col("target") == table)
        write_table(silver.silver_table(mine, table), silver_dir, table)
    rejected = staged.filter(F.col("target") == "quarantine").select(
        "file_path", F.col("rejected_text").alias("value")
    )
    empty = bundles.empty_files(bundles.bundle_inventory(spark, bundle_dir))
    write_table(rejected.unionByName(empty), silver_dir, "quarantine")
    amounts = silver.unusable_amounts(staged.filter(F.col("target").isin(*silver.AMOUNT_TEXT)))
    write_table(amounts, silver_dir, "unusable_amounts")
    return bundles.type_distribution(staged.filter(F.col("target") != "quarantine"))


def stage_rows(rows: DataFrame, path: str) -> None:
    """Parsed rows in one folder per target, in files bounded by bytes.

    The rebalance gathers the rows of a target; Spark then cuts a large target into
    pieces of the advisory size and merges small ones, whatever the number of tasks was.
    """
    rows.hint("rebalance", "target").write.partitionBy("target").parquet(path)


def build_gold(spark: SparkSession, silver_dir: str, gold_dir: str) -> None:
    """Aggregates per patient, profile and gold tables, each stored and read back by the next step.

    Every step can be counted from its files, and a failed job goes on from the last one.
    """
    steps = {
        "claims_by_patient": profiles.claims_by_patient(read_table(spark, silver_dir, "claims")),
        "eob_by_patient": profiles.eob_by_patient(read_table(spark, silver_dir, "explanations")),
        "coverage_current": profiles.coverage_current(read_table(spark, silver_dir, "coverages")),
    }
    for name, df in steps.items():
        write_table(df, gold_dir, name)
    stored = [spark.read.schema(df.schema).parquet(f"{gold_dir}/{name}") for name, df in steps.items()]
    profile = profiles.joined_profile(*stored)
    write_table(profile, gold_dir, PROFILE)
    insured = profiles.with_payer(spark.read.schema(profile.schema).parquet(f"{gold_dir}/{PROFILE}"))
    write_table(scoring.procedure_approval_rates(insured), gold_dir, "procedure_approval_rates")
    write_table(scoring.payer_performance(insured), gold_dir, "payer_performance")
    requests = read_table(spark, silver_dir, "prior_auth")
    write_table(scoring.pa_risk_scores(requests, insured), gold_dir, "pa_risk_scores")


def mart_tables(
    rates: DataFrame, performance: DataFrame, scores: DataFrame, as_of: datetime | None = None
) -> dict[str, DataFrame]:
    """The four marts from the three gold tables."""
    staged_rates = staging.stg_approval_rates(rates, as_of)
    staged_performance = staging.stg_payer_performance(performance, as_of)
    staged_scores = staging.stg_pa_risk_scores(scores, as_of)
    return {
        "mart_pa_compliance_scorecard": marts.mart_pa_compliance_scorecard(
            staged_performance, staged_scores, as_of
        ),
        "mart_revenue_at_risk": marts.mart_revenue_at_risk(staged_rates, as_of),
        "mart_payer_benchmarks": marts.mart_payer_benchmarks(staged_rates, as_of),
        "mart_high_risk_pa_requests": marts.mart_high_risk_pa_requests(staged_scores, as_of),
    }


def build_marts(spark: SparkSession, gold_dir: str, mart_dir: str, as_of: datetime | None = None) -> None:
    """The marts; the one that holds requests is stored in ranges of its order."""
    gold = [
        read_table(spark, gold_dir, t)
        for t in ("procedure_approval_rates", "payer_performance", "pa_risk_scores")
    ]
    for name, df in mart_tables(*gold, as_of=as_of or datetime.now()).items():
        if name == HIGH_RISK:
            write_clustered(df, mart_dir, name, *marts.urgent_first())
        else:
            write_table(df, mart_dir, name)


def publish(spark: SparkSession, silver_dir: str, gold_dir: str, mart_dir: str, database: str) -> None:
    """Register all stored tables in ``database`` and the serving views over them.

    Tables keep their entries and views are replaced, so that what reads them by name goes
    on reading while a new run is published. A run that shall not be seen by others takes a
    database of its own.
    """
    create_database(spark, database, f"{mart_dir}/_{database}")
    roots = {silver_dir: silver.PROJECTIONS, gold_dir: schemas.GOLD, mart_dir: quality.MART_MINIMUM_ROWS}
    for root, names in roots.items():
        for name in names:
            register_table(spark, root, name, database)
    serving.publish_views(spark, database)


def check_quality(
    spark: SparkSession,
    silver_dir: str,
    gold_dir: str,
    mart_dir: str,
    report_dir: str,
    minimums: dict[str, int] | None = None,
) -> None:
    """Write the report, then raise if a table is too small: the report is kept either way."""
    report = quality_report(spark, silver_dir, gold_dir, mart_dir, minimums)
    report.write.mode("overwrite").parquet(report_dir)
    quality.assert_quality(spark.read.parquet(report_dir))


def quality_report(
    spark: SparkSession, silver_dir: str, gold_dir: str, mart_dir: str, minimums: dict[str, int] | None = None
) -> DataFrame:
    """The checked tables, counted from the footers of their files."""
    minimums = minimums or {**quality.MINIMUM_ROWS, **quality.MART_MINIMUM_ROWS}
    roots = {**dict.fromkeys(silver.PROJECTIONS, silver_dir), **dict.fromkeys(quality.MART_MINIMUM_ROWS, mart_dir)}
    counts = count_stored(spark, {name: roots.get(name, gold_dir) for name in minimums})
    return quality.quality_report(spark, counts, minimums)


def step_counts(spark: SparkSession, silver_dir: str, gold_dir: str) -> DataFrame:
    """Rows after every step of scoring, from the footers of what the steps have stored.

    Accumulators (``observe``) may count a task twice after an executor is lost; files hold
    each row once.
    """
    stored = ("eob_by_patient", "claims_by_patient", "coverage_current", PROFILE, *schemas.GOLD)
    roots = {"coverages": silver_dir, "prior_auth": silver_dir, **dict.fromkeys(stored, gold_dir)}
    return count_stored(spark, roots, {"patient_profile_with_payer": (PROFILE, "payer_name")})
