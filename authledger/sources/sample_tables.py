"""Order-entry tables mapped onto the prior-authorization domain.

The engine has no input of its own, so tests, bench and registered queries map a
TPC-H-like set of tables onto the silver tables (``silver``) and onto bundle
documents (``bundles``). All mappings are row by row or foreign-key joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from authledger import schemas

# The mapping rules of the sample domain.
CLAIM_TYPES = ["professional", "institutional", "pharmacy"]
UNINSURED_SEGMENT = "MACHINERY"


# Declared, so that defining a query reads no file.
SCHEMAS = {
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "part": "p_partkey bigint, p_type string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def iso(timestamp: Column) -> Column:
    return F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def tagged(tag: str, key: str) -> Column:
    return F.concat(F.lit(tag), F.col(key).cast("string"))


def claim_type(orderkey: Column) -> Column:
    kind = F.when(orderkey % 3 == 0, CLAIM_TYPES[0]).when(orderkey % 3 == 1, CLAIM_TYPES[1])
    return kind.otherwise(CLAIM_TYPES[2])


def payer_name(custkey: Column, orderkey: Column, segment: Column) -> Column:
    insured = (
        F.when(orderkey % 10 == 9, "SECONDARY")
        .when(segment == UNINSURED_SEGMENT, "NO_INSURANCE")
        .otherwise(segment)
    )
    return F.when(custkey % 40 != 0, insured)


def denied(segment: Column, status: Column, priority: Column, orderkey: Column) -> Column:
    pending = status == "P"
    return (
        F.when(segment == "AUTOMOBILE", pending & (priority < "3"))
        .when(segment == "FURNITURE", (pending & (priority < "4")) | (orderkey % 25 == 1))
        .when(segment == "BUILDING", pending & (priority < "5"))
        .when(segment == "HOUSEHOLD", pending)
        .when(segment == "MACHINERY", pending | (priority < "2"))
        .otherwise(False)
    )


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_orderpriority",
        tagged("P", "o_custkey").alias("patient_id"),
        iso(F.col("o_orderdate")).alias("created"),
        F.year("o_orderdate").alias("year"),
        F.floor(F.col("o_totalprice") / 100).cast("double").alias("charge"),
        F.floor(F.col("o_totalprice") / 125).cast("double").alias("allowed"),
    )


def _orders_with_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    segment, orderkey = F.col("c_mktsegment"), F.col("o_orderkey")
    refused = denied(segment, F.col("o_orderstatus"), F.col("o_orderpriority"), orderkey)
    return (
        _orders(spark, sf_dir)
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .withColumn("payer_name", payer_name(F.col("o_custkey"), orderkey, segment))
        .withColumn(
            "paid", F.when(orderkey % 50 != 0, F.when(refused, 0.0).otherwise(F.col("allowed")))
        )
    )


def _shaped(df: DataFrame, table_name: str) -> DataFrame:
    """The stored column list; what the mapping does not know is NULL."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.struct(table_name)
        ]
    )


def _patients(customers: DataFrame, nations: DataFrame) -> DataFrame:
    return customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        "*",
        tagged("P", "c_custkey").alias("patient_id"),
        F.col("n_name").alias("state"),
        F.col("c_mktsegment").alias("marital_status"),
    )


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return _shaped(_patients(table(spark, sf_dir, "customer"), nations), "patients")


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shaped(
        _orders(spark, sf_dir).select(
            tagged("C", "o_orderkey").alias("claim_id"),
            F.col("o_orderstatus").alias("status"),
            "created",
            F.col("year").alias("claim_year"),
            "patient_id",
            F.col("charge").alias("total_submitted_charge"),
            claim_type(F.col("o_orderkey")).alias("claim_type"),
            F.col("o_orderpriority").alias("primary_diagnosis_code"),
        ),
        "claims",
    )


def explanations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shaped(
        _orders_with_segment(spark, sf_dir).select(
            tagged("E", "o_orderkey").alias("eob_id"),
            "created",
            F.col("year").alias("eob_year"),
            "patient_id",
            tagged("C", "o_orderkey").alias("claim_id"),
            F.col("paid").alias("payment_amount"),
        ),
        "explanations",
    )


def coverages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shaped(
        _orders_with_segment(spark, sf_dir).select(
            F.concat(tagged("E", "o_orderkey"), F.lit("_coverage")).alias("coverage_id"),
            "patient_id",
            "payer_name",
            F.col("created").alias("coverage_start"),
            F.col("c_mktsegment").alias("coverage_type"),
        ),
        "coverages",
    )


def prior_auth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shaped(
        _orders(spark, sf_dir).select(
            F.concat(tagged("E", "o_orderkey"), F.lit("_referral")).alias("service_request_id"),
            F.col("o_orderstatus").alias("status"),
            "patient_id",
            F.col("o_orderpriority").alias("procedure_code"),
            F.col("created").alias("authored_on"),
            F.col("year").alias("auth_year"),
        ),
        "prior_auth",
    )


def encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shaped(
        table(spark, sf_dir, "events").select(
            tagged("V", "event_id").alias("encounter_id"),
            F.year("ts").alias("encounter_year"),
            tagged("P", "user_id").alias("patient_id"),
            F.col("event_type").alias("encounter_class"),
            iso(F.col("ts")).alias("encounter_start"),
        ),
        "encounters",
    )


def conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    joined = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey"), "left"
    )
    return _shaped(
        joined.select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("condition_id"),
            tagged("P", "o_custkey").alias("patient_id"),
            F.col("p_type").alias("icd10_code"),
            iso(F.col("l_shipdate")).alias("onset_date"),
            F.col("l_linestatus").alias("clinical_status"),
        ),
        "conditions",
    )


SILVER = {
    "patients": patients,
    "claims": claims,
    "explanations": explanations,
    "coverages": coverages,
    "prior_auth": prior_auth,
    "encounters": encounters,
    "conditions": conditions,
}


def silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: build(spark, sf_dir) for name, build in SILVER.items()}


# --- bundle documents -------------------------------------------------------


def _json(resource_type: str, rid: str | Column, **fields: Column) -> Column:
    """JSON object of a resource; NULL fields are left out."""
    rid = F.col(rid) if isinstance(rid, str) else rid
    return F.to_json(
        F.struct(
            F.lit(resource_type).alias("resourceType"),
            rid.alias("id"),
            *[value.alias(name) for name, value in fields.items()],
        )
    )


def _text(value: Column) -> Column:
    return F.struct(value.alias("text"))


def _concept(code: Column) -> Column:
    return F.struct(F.array(F.struct(code.alias("code"))).alias("coding"))


def _reference(value: Column) -> Column:
    return F.struct(value.alias("reference"))


def _patient_reference(column: str = "patient_id") -> Column:
    return _reference(F.concat(F.lit("urn:uuid:"), F.col(column)))


def _patient_resource() -> Column:
    return _json(
        "Patient",
        "patient_id",
        address=F.array(F.struct("state")),
        maritalStatus=_text(F.col("marital_status")),
    )


def _claim_resource() -> Column:
    return _json(
        "Claim",
        tagged("C", "o_orderkey"),
        status=F.col("o_orderstatus"),
        created=F.col("created"),
        patient=_reference(F.concat(F.lit("Patient/"), F.col("patient_id"))),
        total=F.struct(F.col("charge").alias("value")),
        type=_concept(claim_type(F.col("o_orderkey"))),
        diagnosis=F.array(F.struct(_concept(F.col("o_orderpriority")).alias("diagnosisCodeableConcept"))),
    )


def _explanation_resource() -> Column:
    coverage = _json(
        "Coverage",
        F.lit("coverage"),
        beneficiary=_patient_reference(),
        payor=F.array(F.struct(F.col("payer_name").alias("display"))),
        period=F.struct(F.col("created").alias("start")),
        type=_text(F.col("c_mktsegment")),
    )
    referral = _json(
        "ServiceRequest",
        F.lit("referral"),
        status=F.col("o_orderstatus"),
        subject=_patient_reference(),
        code=_concept(F.col("o_orderpriority")),
        authoredOn=F.col("created"),
    )
    explanation = _json(
        "ExplanationOfBenefit",
        tagged("E", "o_orderkey"),
        created=F.col("created"),
        patient=_patient_reference(),
        claim=_reference(F.concat(F.lit("Claim/"), tagged("C", "o_orderkey"))),
        payment=F.struct(F.struct(F.col("paid").alias("value")).alias("amount")),
    )
    # The contained list is put in front of the closing brace of the object.
    body = F.substring(explanation, F.lit(1), F.length(explanation) - 1)
    return F.concat(body, F.lit(',"contained":['), coverage, F.lit(","), referral, F.lit("]}"))


def _encounter_resource() -> Column:
    return _json(
        "Encounter",
        "encounter_id",
        subject=_patient_reference(),
        **{"class": F.struct(F.col("encounter_class").alias("code"))},
        period=F.struct(F.col("encounter_start").alias("start")),
    )


def _condition_resource() -> Column:
    return _json(
        "Condition",
        "condition_id",
        subject=_patient_reference(),
        code=_concept(F.col("icd10_code")),
        onsetDateTime=F.col("onset_date"),
        clinicalStatus=_concept(F.col("clinical_status")),
    )


def document(bundle_id: Column, resources: Column) -> Column:
    """Bundle text around an array of resource texts."""
    listed = F.array_join(
        F.transform(resources, lambda r: F.concat(F.lit('{"resource":'), r, F.lit("}"))), ","
    )
    return F.concat(
        F.lit('{"resourceType":"Bundle","id":"'), bundle_id, F.lit('","entry":['), listed, F.lit("]}")
    )


def patient_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name, value): a document for each patient."""
    return patients(spark, sf_dir).select(
        F.col("patient_id").alias("name"),
        document(F.col("patient_id"), F.array(_patient_resource())).alias("value"),
    )


def order_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name, value): claim and explanation of benefits, the latter with two contained resources."""
    key = tagged("O", "o_orderkey")
    return _orders_with_segment(spark, sf_dir).select(
        key.alias("name"), document(key, F.array(_claim_resource(), _explanation_resource())).alias("value")
    )


def encounter_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("encounter_id")
    return encounters(spark, sf_dir).select(
        key.alias("name"), document(key, F.array(_encounter_resource())).alias("value")
    )


def condition_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("condition_id")
    return conditions(spark, sf_dir).select(
        key.alias("name"), document(key, F.array(_condition_resource())).alias("value")
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name, value) of all bundles, one for each patient, order, encounter and condition."""
    parts = [build(spark, sf_dir) for build in (patient_bundles, order_bundles, encounter_bundles, condition_bundles)]
    return reduce(DataFrame.unionByName, parts)


def resource_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(resource) JSON text of all patients, claims, explanations (with two contained
    resources each), encounters and conditions."""
    orders = _orders_with_segment(spark, sf_dir)
    parts = [
        patients(spark, sf_dir).select(_patient_resource().alias("resource")),
        orders.select(F.explode(F.array(_claim_resource(), _explanation_resource())).alias("resource")),
        encounters(spark, sf_dir).select(_encounter_resource().alias("resource")),
        conditions(spark, sf_dir).select(_condition_resource().alias("resource")),
    ]
    return reduce(DataFrame.unionByName, parts)


def named_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name, value): bundles of up to 128 resources, all kinds mixed.

    The rows are dealt out evenly, and the page is taken from the row number inside the
    task, so that no value in the data can make a page larger.
    """
    dealt = resource_texts(spark, sf_dir).hint("rebalance")
    page = F.shiftright(F.monotonically_increasing_id(), 7).alias("page")
    filled = dealt.select(page, "resource").groupBy("page").agg(F.collect_list("resource").alias("resources"))
    name = F.concat(F.lit("page-"), F.col("page").cast("string"))
    return filled.select(name.alias("name"), document(name, F.col("resources")).alias("value"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return named_pages(spark, sf_dir).select("value")


def write_bundle_files(files: DataFrame, path: str) -> None:
    """One file per document; with a column ``name``, in a folder ``name=...`` each."""
    writer = files.select(*[c for c in ("name", "value") if c in files.columns]).write.option("maxRecordsPerFile", 1)
    if "name" in files.columns:
        writer = writer.partitionBy("name")
    writer.mode("append").text(path)


def write_empty_file(spark: SparkSession, path: str) -> None:
    """A file of length 0: what the text writer leaves of no rows."""
    spark.createDataFrame([], "value string").write.mode("append").text(path)
