"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from authledger import schemas
from authledger.operators import scoring, silver, skew
from authledger.plans import serving
from authledger.sources import bundles, sample_tables, tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def query_plan(spark, sample, name):
    return plan(registry.queries()[name](spark, sample))


@pytest.fixture
def no_broadcast(spark):
    """Plans as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_query_runs_python_or_multiplies_rows(spark, sample, shared_lake):
    """The corpus queries run Python by design and are left out."""
    for name in set(registry.queries()) - set(registry.corpus_queries()[0]):
        text = plan(registry.queries()[name](spark, sample))
        for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
            assert operator not in text, (name, operator)


def test_only_bounded_tables_are_broadcast(spark, sample, no_broadcast):
    """Without the size check nothing but the hot keys and the distinct rates is broadcast."""
    assert "Broadcast" not in query_plan(spark, sample, "patient_profile")
    # No key is hot in the sample; with a lower bar some are, and their list is a local table.
    assert "Broadcast" not in query_plan(spark, sample, "pa_risk_scores")
    requests = sample_tables.prior_auth(spark, sample)
    insured = registry.Model(spark, sample).insured
    salted = plan(scoring.pa_risk_scores(requests, insured, hot_rows=3))
    sources = re.findall(r"BroadcastExchange.*\n[\s:|+-]*LocalTableScan", salted)
    assert salted.count("BroadcastExchange") == len(sources) == 2
    assert skew.hot_keys(requests, "patient_id", 3).count() < skew.HOT_KEYS
    assert query_plan(spark, sample, "mart_payer_benchmarks").count("BroadcastExchange") == 1


def test_requests_are_scanned_once_for_the_salted_join(spark, sample):
    requests = sample_tables.prior_auth(spark, sample)
    lookup = spark.createDataFrame([("P1", 1)], "patient_id string, v int")
    for hot_rows in (3, 2_000_000):
        joined = plan(skew.salted_left_join(requests, lookup, "patient_id", "service_request_id", hot_rows))
        assert joined.count("FileScan parquet") == 1


def test_stored_tables_are_counted_from_footers(spark, tmp_path):
    spark.range(100).selectExpr("id", "IF(id % 4 = 0, NULL, id) AS v").write.parquet(str(tmp_path / "t"))
    with tables._footers(spark):
        assert "PushedAggregation: [COUNT(*)]" in plan(tables.count_plan(spark, str(tmp_path), "t"))
        assert "PushedAggregation: [COUNT(v)]" in plan(tables.count_plan(spark, str(tmp_path), "t", "v"))
    assert "BatchScan" not in plan(spark.read.parquet(str(tmp_path / "t")))
    counted = tables.count_stored(spark, {"t": str(tmp_path)}, {"with_v": ("t", "v")}).collect()
    assert {r.table_name: r.row_count for r in counted} == {"t": 100, "with_v": 75}


def test_profile_shuffles_each_input_once(spark, sample, no_broadcast):
    tables = sample_tables.silver(spark, sample)
    claims = plan(registry.profiles.claims_by_patient(tables["claims"]))
    assert claims.count("Exchange hashpartitioning(patient_id") == 1
    assert "partial_min_by" in claims
    profile = query_plan(spark, sample, "patient_profile")
    assert profile.count("Exchange hashpartitioning(patient_id") == 3


def test_scan_reads_only_what_is_needed(spark, sample):
    text = query_plan(spark, sample, "coverage_current")
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in text
    conditions = plan(sample_tables.conditions(spark, sample))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)" in conditions


def test_bundles_are_parsed_once_without_a_shuffle(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"entry": []}')
    files = bundles.read_bundles(spark, str(tmp_path))
    for df in (
        bundles.resources(files),
        bundles.quarantine(files),
        silver.silver_table(bundles.resources(files), "claims"),
        silver.staged_rows(bundles.resources_and_rejects(files)),
    ):
        text = plan(df)
        assert "Exchange" not in text
        # Once for all files; the others stand inside the second look at odd files.
        assert text.count('from_json(StructField(document,StructType(StructField(entry,ArrayType(StructType(StructField(resource,StructType') == 1


@pytest.mark.parametrize("table", schemas.TABLE_FIELDS)
def test_parser_converts_only_what_a_table_reads(spark, tmp_path, table):
    (tmp_path / "a.json").write_text('{"entry": []}')
    text = plan(silver.silver_from_bundles(bundles.read_bundles(spark, str(tmp_path)), table))
    # "code" is a part of other fields as well.
    parsed = set(re.findall(r"StructField\((\w+),", text)) & set(schemas.RESOURCE_FIELDS) - {"code"}
    assert parsed == set(schemas.resource_fields([table])) - {"code"}
    assert text.count("Generate") == 1 and "Exchange" not in text


def test_top_k_takes_no_lanes_and_limits_only_ties(spark, sample):
    scores = registry.Model(spark, sample).stored_scores
    text = plan(serving.explorer_top_requests(scores, 100))
    # The rows above the cut, and those at it, are told apart in the scan.
    pushed = re.findall(r"PushedFilters: \[[^\n]*(GreaterThan|EqualTo)\(pa_risk_score", text)
    assert sorted(pushed) == ["EqualTo", "GreaterThan"]
    assert text.count("TakeOrderedAndProject") == 1 and "Window" not in text
    assert "TakeOrderedAndProject" not in plan(serving.explorer_top_requests(scores, 1_000_000))


def test_clustered_table_is_read_in_order_without_a_sort(spark, tmp_path):
    rows = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    tables.write_clustered(rows.repartition(5), str(tmp_path), "t", F.desc("k"), F.col("v"))
    read = tables.read_positions(spark, str(tmp_path), "t")
    assert "rangepartitioning" not in plan(read)
    got = [(r.k, r.v) for r in read.orderBy("position").collect()]
    assert got == sorted(got, key=lambda p: (-p[0], p[1])) and len(got) == 1000
    assert sorted(r.position for r in read.collect()) == list(range(1, 1001))


def test_requests_are_aggregated_before_the_scorecard_join(spark, sample, no_broadcast):
    text = query_plan(spark, sample, "mart_pa_compliance_scorecard")
    join = text.index("SortMergeJoin [payer_name")
    assert text.index("partial_count(service_request_id") > join
    assert "HashAggregate" not in text[:join]


def test_year_tables_are_rebalanced(spark, sample):
    claims = sample_tables.claims(spark, sample).hint("rebalance", "claim_year")
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(claims)
