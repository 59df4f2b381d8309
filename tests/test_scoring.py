import pytest
from pyspark.sql import functions as F

from authledger import schemas
from authledger.operators import profiles, scoring, skew
from authledger.sources import sample_tables


def frame(spark, table, *rows):
    """Rows given as dicts; missing columns are NULL."""
    names = schemas.columns(table)
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schemas.struct(table))


@pytest.fixture(scope="module")
def claims(spark):
    return frame(
        spark, "claims",
        {"patient_id": "a", "claim_id": "2", "created": "2020", "claim_type": "late", "total_submitted_charge": 10.0},
        {"patient_id": "a", "claim_id": "1", "created": "2019", "claim_type": "early", "total_submitted_charge": 20.01},
        {"patient_id": "a", "claim_id": "0", "created": "2018", "claim_type": None, "total_submitted_charge": 999.0},
        {"patient_id": "b", "claim_id": "3", "created": "2019", "claim_type": "x", "total_submitted_charge": None},
        {"patient_id": "no eob", "claim_id": "4", "claim_type": "x", "total_submitted_charge": 1.0},
        {"patient_id": "no payer", "claim_id": "5", "claim_type": "x", "total_submitted_charge": 1.0},
        {"patient_id": "", "claim_id": "6", "claim_type": "x", "total_submitted_charge": 1.0},
        {"patient_id": None, "claim_id": "7", "claim_type": "x", "total_submitted_charge": 1.0},
    )


@pytest.fixture(scope="module")
def explanations(spark):
    pay = [("a", 5.0), ("a", 0.0), ("a", None), ("a", 0.5), ("b", 0.0), ("no claim", 1.0), ("no payer", 1.0), ("", 1.0)]
    return frame(spark, "explanations", *[{"patient_id": p, "payment_amount": x} for p, x in pay])


@pytest.fixture(scope="module")
def coverages(spark):
    return frame(
        spark, "coverages",
        {"patient_id": "a", "coverage_id": "1", "coverage_start": "2020", "payer_name": "OLD"},
        {"patient_id": "a", "coverage_id": "2", "coverage_start": "2021", "payer_name": "NEW", "coverage_type": "t"},
        {"patient_id": "b", "coverage_id": "3", "payer_name": "P"},
        {"patient_id": "no payer", "coverage_id": "4", "coverage_start": "2020", "payer_name": "P"},
        {"patient_id": "no payer", "coverage_id": "5", "coverage_start": "2021", "payer_name": None},
        {"patient_id": "", "coverage_id": "6", "payer_name": "P"},
    )


@pytest.fixture(scope="module")
def profile(claims, explanations, coverages):
    return profiles.patient_profile(claims, explanations, coverages)


def test_profile(profile):
    rows = {r.patient_id: r for r in profile.collect()}
    assert set(rows) == {"a", "b", "no payer"}
    a = rows["a"]
    assert (a.primary_claim_type, a.avg_charge, a.total_claims, a.approved_claims) == ("early", 15.01, 3, 2)
    assert (a.approval_rate, a.avg_payment, a.payer_name, a.coverage_type) == (0.6667, 1.83, "NEW", "t")
    assert rows["b"].avg_charge is None
    assert rows["no payer"].payer_name is None


def test_scores_keep_every_request(spark, profile):
    people = ["a", "b", "no payer", "stranger", "", None, "a"]
    requests = frame(
        spark, "prior_auth", *[{"service_request_id": str(i), "patient_id": p} for i, p in enumerate(people)]
    )
    scores = scoring.pa_risk_scores(requests, profiles.with_payer(profile))
    assert scores.columns == schemas.columns("pa_risk_scores")
    rows = {r.service_request_id: r for r in scores.collect()}
    assert [rows[str(i)].patient_id for i in range(7)] == people
    assert [rows[str(i)].pa_risk_score for i in range(7)] == [0.3333, 1.0, 0.5, 0.5, 0.5, 0.5, 0.3333]
    assert [rows[str(i)].risk_tier for i in range(4)] == ["LOW", "HIGH", "MEDIUM", "MEDIUM"]
    assert rows["0"].revenue_at_risk == 5.0  # 15.01 x 0.3333 = 5.002833
    assert rows["1"].revenue_at_risk == 0.0
    assert rows["3"].historical_denial_rate is None


def test_payer_measures(profile):
    performance = {r.payer_name: r for r in scoring.payer_performance(profiles.with_payer(profile)).collect()}
    new = performance["NEW"]
    assert (new.avg_approval_rate, new.avg_denial_rate, new.total_revenue_at_risk) == (0.6667, 0.3333, 5.0)
    assert performance["P"].total_revenue_at_risk is None


def skewed(spark, n=4000):
    """One key with most rows, exact copies among them, keyless rows and a long tail."""
    return spark.range(n).select(
        F.when(F.col("id") % 10 < 6, "hot").when(F.col("id") % 10 < 7, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string"))).alias("key"),
        F.when(F.col("id") % 20 == 0, "copy").otherwise(F.col("id").cast("string")).alias("rid"),
    )


def test_salted_join_equals_a_plain_join(spark):
    rows = skewed(spark)
    keys = ["hot"] + [f"k{i}" for i in range(0, 97, 2)] + ["absent"]
    lookup = spark.createDataFrame([(k, f"v-{k}") for k in keys], "key string, v string")
    salted = skew.salted_left_join(rows, lookup, "key", "rid", hot_rows=50)
    plain = rows.join(lookup, "key", "left")
    assert salted.columns == plain.columns
    assert salted.exceptAll(plain).isEmpty() and plain.exceptAll(salted).isEmpty()


def test_hot_keys_are_spread(spark):
    hot = {r.key: r.salts for r in skew.hot_keys(skewed(spark), "key", 50).collect()}
    assert hot == {"hot": 48}


def test_no_hot_key_is_missed_or_made_up(spark):
    """The sketch only names candidates: what is returned is counted."""
    rows = spark.range(30_000).select(F.concat(F.lit("k"), (F.sqrt("id")).cast("int").cast("string")).alias("key"))
    sizes = {r.key: r["count"] for r in rows.groupBy("key").count().collect()}
    found = {r.key: r.salts for r in skew.hot_keys(rows, "key", 200).collect()}
    assert found == {key: -(-n // 200) for key, n in sizes.items() if n > 200}
    assert skew.hot_keys(rows.limit(0), "key").count() == 0


def test_scores_do_not_depend_on_salting(spark, sample):
    tables = sample_tables.silver(spark, sample)
    insured = profiles.with_payer(
        profiles.patient_profile(tables["claims"], tables["explanations"], tables["coverages"])
    )
    plain = scoring.pa_risk_scores(tables["prior_auth"], insured)
    salted = scoring.pa_risk_scores(tables["prior_auth"], insured, hot_rows=3)
    assert plain.exceptAll(salted).isEmpty() and salted.exceptAll(plain).isEmpty()


@pytest.mark.parametrize("k", [0, 1, 7, 50, 100, 1200, 3000, 3999, 4000, 5000])
def test_top_k_equals_sort_and_limit(spark, k):
    """Scores with many ties, one of them held by most rows, and rows without a score."""
    rows = skewed(spark).repartition(9).withColumn(
        "score", F.when(F.col("key") == "hot", 0.5).when(F.col("key").isNotNull(), F.abs(F.hash("rid")) % 40 / 10.0)
    ).withColumn("id", F.concat("rid", F.lit("-"), F.monotonically_increasing_id().cast("string")))
    rows = spark.createDataFrame(rows.collect(), rows.schema)
    want = rows.orderBy(F.desc_nulls_last("score"), "id").limit(k).collect()
    assert skew.top_k(rows, k, "score", "id").collect() == want


def test_ordered_sorts_totally(spark):
    rows = skewed(spark).repartition(9)
    got = [(r.key, r.rid) for r in skew.ordered(rows, F.col("key").asc_nulls_first(), F.col("rid")).collect()]
    assert got == sorted(got, key=lambda p: (p[0] is not None, p[0] or "", p[1]))


def test_results_do_not_depend_on_partitions(spark, sample):
    tables = sample_tables.silver(spark, sample)

    def scores(partitions):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        claims = tables["claims"].repartition(partitions, F.rand(partitions))
        insured = profiles.with_payer(
            profiles.patient_profile(claims, tables["explanations"].repartition(partitions), tables["coverages"])
        )
        return sorted(map(tuple, scoring.payer_performance(insured).collect()))

    try:
        assert scores(1) == scores(3) == scores(11)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
