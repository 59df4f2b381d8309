"""The batch jobs from bundle files to the quality gate."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from authledger import schemas
from authledger.operators import silver
from authledger.plans import jobs, quality
from authledger.sources import sample_tables, tables
from authledger.sources.tables import read_table


@pytest.fixture(scope="module")
def roots(spark, sample, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    paths = {name: f"{root}/{name}" for name in ("bundles", "silver", "gold", "marts", "report")}
    sample_tables.write_bundle_files(sample_tables.pages(spark, sample), paths["bundles"])
    (root / "bundles" / "broken.json").write_text('{"entry": [')
    (root / "bundles" / "empty.json").write_text("")
    (root / "bundles" / "other.json").write_text(json.dumps({"entry": [{"resource": {"resourceType": "Observation"}}]}))
    paths["distribution"] = jobs.build_silver(spark, paths["bundles"], paths["silver"]).collect()
    jobs.build_gold(spark, paths["silver"], paths["gold"])
    jobs.build_marts(spark, paths["gold"], paths["marts"], datetime(2026, 1, 1))
    return paths


def same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


@pytest.mark.parametrize("table", silver.PROJECTIONS)
def test_silver_round_trip(spark, sample, roots, table):
    stored = read_table(spark, roots["silver"], table)
    assert same(stored, sample_tables.SILVER[table](spark, sample))


def test_distribution_and_quarantine(spark, roots):
    counts = {r.resource_type: r["count"] for r in roots["distribution"]}
    assert (counts["Claim"], counts["Coverage"], counts["Observation"]) == (1500, 1500, 1)
    held = spark.read.parquet(f"{roots['silver']}/quarantine").collect()
    assert {r.file_path.rsplit("/", 1)[1]: r.value for r in held} == {"broken.json": '{"entry": [', "empty.json": ""}


def test_staged_files_are_bounded_by_bytes(spark, sample, tmp_path):
    """A target far larger than the others is cut, small ones get one file, whatever the tasks are."""
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 100 < 97, "claims").when(F.col("id") % 100 < 99, "patients").otherwise("other").alias("target"),
        F.sha2(F.col("id").cast("string"), 256).alias("r"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "500k")
    try:
        jobs.stage_rows(rows.repartition(40), str(tmp_path / "staged"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    sizes = {}
    for file in (tmp_path / "staged").glob("target=*/*.parquet"):
        sizes.setdefault(file.parent.name, []).append(file.stat().st_size)
    assert {name: len(found) for name, found in sizes.items() if name != "target=claims"} == {"target=patients": 1, "target=other": 1}
    assert 4 <= len(sizes["target=claims"]) <= 12
    assert max(map(max, sizes.values())) < 1_000_000
    assert spark.read.parquet(str(tmp_path / "staged")).count() == 60_000


def test_gold_equals_the_queries(spark, sample, roots):
    for table in schemas.GOLD:
        assert same(read_table(spark, roots["gold"], table), registry.queries()[table](spark, sample))


def test_requests_are_neither_lost_nor_doubled(spark, roots):
    scores = read_table(spark, roots["gold"], "pa_risk_scores")
    tiers = {r.risk_tier: r["count"] for r in scores.groupBy("risk_tier").count().collect()}
    assert tiers == {"HIGH": 17, "MEDIUM": 411, "LOW": 1072}
    assert scores.filter("historical_approval_rate IS NULL").count() == 47


def test_marts_equal_the_queries(spark, sample, roots):
    for name in quality.MART_MINIMUM_ROWS:
        stored = spark.read.parquet(f"{roots['marts']}/{name}")
        assert stored.first().mart_updated_at == datetime(2026, 1, 1)
        assert same(stored.drop("mart_updated_at"), registry.queries()[name](spark, sample))


def publish(spark, roots, database):
    jobs.publish(spark, roots["silver"], roots["gold"], roots["marts"], database)


def test_published_views_outlive_the_session(spark, roots):
    publish(spark, roots, "serving_a")
    other = spark.newSession()
    assert other.table("serving_a.vw_pa_compliance_scorecard").count() == 6
    assert other.table("serving_a.vw_revenue_at_risk").count() == 18
    assert "mart_updated_at" not in other.table("serving_a.vw_pa_compliance_scorecard").columns
    assert other.table("serving_a.vw_payer_benchmarks").columns[0] == "approval_rank"
    # A second run replaces what the names stand for.
    publish(spark, roots, "serving_a")
    assert other.table("serving_a.vw_revenue_at_risk").count() == 18


def test_catalog_knows_every_table_and_new_years(spark, roots, tmp_path):
    publish(spark, roots, "serving_b")
    for name in (*silver.PROJECTIONS, *schemas.GOLD):
        assert sorted(spark.table(f"serving_b.{name}").columns) == sorted(schemas.columns(name))
        assert spark.table(f"serving_b.{name}").count() == read_table(spark, folder(roots, name), name).count()
        assert tables.partition_column(spark, "serving_b", name) == schemas.PARTITION_COLUMNS.get(name)
    claims = read_table(spark, roots["silver"], "claims")
    tables.write_table(claims.filter("claim_year < 1995"), str(tmp_path), "claims")
    tables.create_database(spark, "years", str(tmp_path / "db"))
    tables.register_table(spark, str(tmp_path), "claims", "years")
    before = spark.table("years.claims").count()
    tables.overwrite_years(claims.filter("claim_year = 1996"), str(tmp_path), "claims")
    tables.register_table(spark, str(tmp_path), "claims", "years")
    assert spark.table("years.claims").count() == before + claims.filter("claim_year = 1996").count()


def folder(roots, name):
    return roots["silver" if name in silver.PROJECTIONS else "gold"]


def failing(df):
    """The same columns, from a job that dies in one of its tasks."""
    return df.withColumns({c: F.when(F.rand() < 2, F.raise_error(F.lit("task lost")).cast(df.schema[c].dataType)) for c in df.columns[:1]})


@pytest.mark.parametrize("table", ["patients", "claims"])
def test_failed_job_leaves_the_old_table(spark, roots, tmp_path, table):
    rows = read_table(spark, roots["silver"], table)
    root = str(tmp_path)
    tables.write_table(rows, root, table)
    for write in [tables.write_table] + [tables.overwrite_years] * (table in schemas.PARTITION_COLUMNS):
        with pytest.raises(Exception, match="task lost"):
            write(failing(rows), root, table)
        assert same(read_table(spark, root, table), rows)
        assert [p.name for p in tmp_path.iterdir()] == [table]
    # A table can be replaced by what is computed from it.
    tables.write_table(read_table(spark, root, table).limit(5), root, table)
    assert read_table(spark, root, table).count() == 5


def test_only_new_years_are_replaced(spark, roots, tmp_path):
    claims = read_table(spark, roots["silver"], "claims")
    tables.write_table(claims, str(tmp_path), "claims")
    changed = claims.filter("claim_year = 1996").withColumn("status", F.lit("changed"))
    tables.overwrite_years(changed, str(tmp_path), "claims")
    assert same(read_table(spark, str(tmp_path), "claims"), claims.filter("claim_year <> 1996").unionByName(changed))


def test_steps_are_counted_from_their_files(spark, sample, roots):
    counts = {r.table_name: r.row_count for r in jobs.step_counts(spark, roots["silver"], roots["gold"]).collect()}
    profile = registry.Model(spark, sample).profile
    assert counts["patient_profile"] == profile.count()
    assert counts["patient_profile_with_payer"] == profile.filter("payer_name IS NOT NULL").count()
    assert counts["coverages"] == counts["prior_auth"] == counts["pa_risk_scores"] == 1500


def test_gate_keeps_the_report(spark, roots):
    arguments = (spark, roots["silver"], roots["gold"], roots["marts"], roots["report"])
    with pytest.raises(quality.QualityError, match="claims: 1500 < 400000"):
        jobs.check_quality(*arguments)
    report = spark.read.parquet(roots["report"])
    assert report.count() == 14
    assert report.filter("status = 'PASS'").count() == 6
    jobs.check_quality(*arguments, minimums={"claims": 1500, "payer_performance": 6})


def test_years_are_folders(spark, roots):
    stored = spark.read.parquet(f"{roots['silver']}/claims").filter("claim_year = 1997")
    assert "claim_year" in stored.columns
    assert "PartitionFilters: [isnotnull(claim_year" in stored._jdf.queryExecution().toString()
