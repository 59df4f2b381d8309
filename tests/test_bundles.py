import json

import pytest
from pyspark.sql import functions as F

from authledger import schemas
from authledger.operators.silver import PROJECTIONS, silver_from_bundles, silver_table, staged_rows, unusable_amounts
from authledger.sources import bundles


def bundle(*resources):
    return json.dumps({"resourceType": "Bundle", "entry": [{"resource": r} for r in resources]})


PATIENT = {"resourceType": "Patient", "id": "p"}
GOOD = bundle(PATIENT)

UNREADABLE = {
    "syntax": '{"entry": [',
    "empty": "",
    "blank": "  ",
    "json null": "null",
    "number": "5",
    "top level array": f"[{GOOD}]",
    "text after the document": GOOD + " trailing",
    "two documents": GOOD + GOOD,
    "single quotes": "{'entry': []}",
    "entry object": '{"entry": {"resource": {}}}',
    "entry null": '{"entry": null}',
    "entry element text": '{"entry": [{"resource": {"resourceType": "Patient"}}, "s"]}',
    "entry element null": '{"entry": [null]}',
    "entry element list": '{"entry": [[]]}',
    "resource text": bundle(PATIENT, "s"),
    "resource number": bundle(PATIENT, 7),
    "resource list": bundle(PATIENT, [1]),
    "contained object": bundle(PATIENT, {"resourceType": "Claim", "contained": {"id": "x"}}),
    "contained text": bundle({"resourceType": "Claim", "contained": "abc"}),
    "contained null": bundle({"resourceType": "Claim", "contained": None}),
    "contained number": bundle({"resourceType": "Claim", "contained": 0}),
    "contained child text": bundle({"resourceType": "Claim", "contained": [{"id": "a"}, "s"]}),
    "contained child null": bundle({"resourceType": "Claim", "contained": [None]}),
    "contained object without type": bundle({"contained": {"id": "x"}}),
}

# name -> (text, expected (type, id, contained) rows)
READABLE = {
    "plain": (GOOD, [("Patient", "p", False)]),
    "no entry": ("{}", []),
    "empty entry": ('{"entry": []}', []),
    "line breaks around": (f"\n {GOOD} \n", [("Patient", "p", False)]),
    "entry without resource": ('{"entry": [{}, {"fullUrl": "x"}]}', []),
    "empty resources": (bundle(PATIENT, {}, None, "", 0, False, []), [("Patient", "p", False)]),
    "missing type": (bundle({"id": "a", "foo": 1}), [("", "a", False)]),
    "unknown type": (bundle({"resourceType": "Observation", "id": "o"}), [("Observation", "o", False)]),
    "number id": (bundle({"resourceType": "Patient", "id": 5}), [("Patient", "5", False)]),
    "contained": (
        bundle({"resourceType": "Claim", "id": "c", "contained": [{"resourceType": "Coverage", "id": "v"}]}),
        [("Claim", "c", False), ("Coverage", "c_v", True)],
    ),
    "contained without id": (
        bundle({"resourceType": "Patient", "id": "c", "contained": [{"resourceType": "Coverage"}]}),
        [("Patient", "c", False), ("Coverage", None, True)],
    ),
    "parent without id": (
        bundle({"resourceType": "Patient", "contained": [{"resourceType": "Coverage", "id": "v"}]}),
        [("Patient", None, False), ("Coverage", "unknown_v", True)],
    ),
    "contained without type": (
        bundle({"resourceType": "Patient", "id": "c", "contained": [{"id": "v"}, {}]}),
        [("Patient", "c", False), ("", "c_v", True), ("", None, True)],
    ),
    "contained in contained": (
        bundle({"resourceType": "Claim", "id": "c", "contained": [
            {"resourceType": "Coverage", "id": "v", "contained": [{"resourceType": "Patient", "id": "x"}]}]}),
        [("Claim", "c", False), ("Coverage", "c_v", True)],
    ),
    "contained empty": (bundle({"resourceType": "Claim", "id": "c", "contained": []}), [("Claim", "c", False)]),
    "contained empty object": (bundle({"resourceType": "Claim", "id": "c", "contained": {}}), [("Claim", "c", False)]),
    "null elsewhere": (
        bundle({"resourceType": "Claim", "id": "c", "note": {"entry": None}, "status": None}),
        [("Claim", "c", False)],
    ),
    "field of another shape": (
        bundle({"resourceType": "Claim", "id": "c", "patient": "text", "diagnosis": {"a": 1}, "period": []}),
        [("Claim", "c", False)],
    ),
}


@pytest.fixture(scope="module")
def files(spark):
    rows = list(UNREADABLE.items()) + [(name, text) for name, (text, _) in READABLE.items()]
    return spark.createDataFrame(rows, "file_path string, value string")


def test_quarantine_holds_the_unreadable_files_whole(files):
    held = {r.file_path: r.value for r in bundles.quarantine(files).collect()}
    assert held == UNREADABLE


def test_rows_of_readable_files(files):
    found = {name: [] for name in READABLE}
    for r in bundles.resources(files).collect():
        found[r.file_path].append((r.resource_type, r.resource_id, r.is_contained))
    assert found == {name: rows for name, (_, rows) in READABLE.items()}


def test_one_pass_gives_both(files):
    both = bundles.resources_and_rejects(files)
    assert both.filter("rejected_text IS NOT NULL").count() == len(UNREADABLE)
    assert both.filter("rejected_text IS NULL").count() == bundles.resources(files).count()
    targets = {r.target for r in staged_rows(both).select("target").distinct().collect()}
    assert targets == {"quarantine", "patients", "claims", "coverages", "other"}


def test_distribution_counts_missing_types(files):
    counts = {r.resource_type: r["count"] for r in bundles.type_distribution(bundles.resources(files)).collect()}
    assert counts[""] == 3
    assert counts["Observation"] == 1


def test_files_are_read_whole(spark, tmp_path):
    (tmp_path / "a.json").write_text(GOOD.replace(", ", ",\n"))
    (tmp_path / "b.json").write_text("")
    path = str(tmp_path)
    assert [r.resource_id for r in bundles.resources(bundles.read_bundles(spark, path)).collect()] == ["p"]
    assert bundles.assert_arrived(spark, path) == 1


def test_inventory_holds_empty_files_and_odd_names(spark, tmp_path):
    (tmp_path / "deep er" / "name=x y").mkdir(parents=True)
    (tmp_path / "a b.json").write_text(GOOD)
    (tmp_path / "deep er" / "é.json").write_text("")
    (tmp_path / "deep er" / "name=x y" / "c.json").write_text("")
    (tmp_path / "_SUCCESS").write_text("")
    inventory = bundles.bundle_inventory(spark, str(tmp_path))
    found = {r.file_path.rsplit("/", 1)[1]: (r.length, r.modified is None) for r in inventory.collect()}
    assert found == {"a%20b.json": (len(GOOD), False), "é.json": (0, True), "c.json": (0, True)}
    assert tuple(bundles.arrival_report(inventory).first()) == (3, len(GOOD), 2)
    assert {r.value for r in bundles.empty_files(inventory).collect()} == {""}
    read = bundles.read_bundles(spark, str(tmp_path)).join(inventory, "file_path")
    assert [(r.value, r.length) for r in read.collect()] == [(GOOD, len(GOOD))]


@pytest.mark.parametrize("table", schemas.TABLE_FIELDS)
def test_pruned_parse_gives_the_same_rows(files, table):
    resource_type = PROJECTIONS[table][0]
    whole = silver_table(bundles.resources(files), table)
    pruned = silver_from_bundles(files, table)
    assert pruned.schema == whole.schema
    assert sorted(map(repr, pruned.collect())) == sorted(map(repr, whole.collect()))
    types = {r.resource_type for r in bundles.resources(files, [table], [resource_type]).collect()}
    assert types <= {resource_type}


def test_arrival_check_raises_on_an_empty_folder(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no bundle file"):
        bundles.assert_arrived(spark, str(tmp_path))
    (tmp_path / "empty.json").write_text("")
    with pytest.raises(FileNotFoundError, match="1 are empty"):
        bundles.assert_arrived(spark, str(tmp_path))


def one(spark, table, resource):
    files = spark.createDataFrame([("f", bundle(resource))], "file_path string, value string")
    return silver_table(bundles.resources(files), table).first()


@pytest.mark.parametrize(
    ("reference", "expected"),
    [("Patient/x", "x"), ("urn:uuid:x", "x"), ("Other?x", ""), (None, None)],
)
def test_patient_reference(spark, reference, expected):
    resource = {"resourceType": "Claim", "id": "c", "patient": {"reference": reference} if reference else {}}
    assert one(spark, "claims", resource).patient_id == expected


def test_claim_reference_takes_no_urn(spark):
    eob = {"resourceType": "ExplanationOfBenefit", "id": "e", "claim": {"reference": "urn:uuid:x"}}
    assert one(spark, "explanations", eob).claim_id == ""


@pytest.mark.parametrize(("value", "expected"), [(1.10, 1.1), ("2.5", 2.5), ("abc", None), (None, None), ({}, None)])
def test_amounts(spark, value, expected):
    claim = {"resourceType": "Claim", "id": "c", "total": {"value": value}}
    assert one(spark, "claims", claim).total_submitted_charge == expected


def test_amounts_that_are_no_number_are_listed(spark):
    claims = [{"resourceType": "Claim", "id": str(i), "total": {"value": v}} for i, v in enumerate([1, "Infinity", "NaN", "x", None])]
    eob = {"resourceType": "ExplanationOfBenefit", "id": "e", "payment": {"amount": {"value": "-Infinity"}}}
    files = spark.createDataFrame([("f", bundle(*claims, eob))], "file_path string, value string")
    rows = bundles.resources(files)
    assert [r.total_submitted_charge for r in silver_table(rows, "claims").collect()] == [1.0, None, None, None, None]
    listed = {tuple(r) for r in unusable_amounts(rows).collect()}
    assert listed == {("claims", "1", "Infinity"), ("claims", "2", "NaN"), ("claims", "3", "x"), ("explanations", "e", "-Infinity")}


@pytest.mark.parametrize(
    ("created", "year"),
    [
        ("2019-12-31T23:30:00-05:00", 2020),
        ("2020-01-01T00:30:00+02:00", 2019),
        ("2019-05", 2019),
        ("2019", 2019),
        ("soon", None),
        (None, None),
    ],
)
def test_years_are_utc(spark, created, year):
    assert one(spark, "claims", {"resourceType": "Claim", "id": "c", "created": created}).claim_year == year


def test_nested_columns(spark):
    eob = one(spark, "explanations", {
        "resourceType": "ExplanationOfBenefit", "id": "e", "outcome": "complete",
        "payment": {"amount": {"value": 12.5}}, "total": [{"amount": 1}],
        "insurance": [{"preAuthRef": ["A1", "A2"], "coverage": {"reference": "#coverage"}}, {}],
    })
    assert (eob.payment_amount, eob.prior_auth_ref, eob.coverage_ref) == (12.5, "A1", "#coverage")
    encounter = one(spark, "encounters", {
        "resourceType": "Encounter", "id": "v", "class": {"code": "AMB"}, "type": [{"text": "visit"}],
        "period": {"start": "2021-01-01", "end": "2021-01-02"}, "serviceProvider": {"display": "clinic"},
    })
    assert (encounter.encounter_class, encounter.encounter_type, encounter.provider_name) == ("AMB", "visit", "clinic")
    patient = one(spark, "patients", {
        "resourceType": "Patient", "id": "p", "birthDate": "1970-01-01", "gender": "other",
        "address": [{"state": "TX", "city": "A", "postalCode": "1"}, {"state": "NY"}], "maritalStatus": {"text": "M"},
    })
    assert tuple(patient) == ("p", "1970-01-01", "other", "TX", "A", "1", "M")
    request = one(spark, "prior_auth", {
        "resourceType": "ServiceRequest", "id": "s", "intent": "order", "authoredOn": "2022-02-02",
        "code": {"coding": [{"code": "99"}], "text": "scan"}, "requester": {"reference": "Practitioner/d"},
        "reasonCode": [{"coding": [{"code": "R1"}], "text": "pain"}],
    })
    assert (request.procedure_code, request.procedure_description, request.auth_year) == ("99", "scan", 2022)
    assert (request.reason_code, request.reason_description, request.requester_ref) == ("R1", "pain", "Practitioner/d")


def test_parts_of_another_shape_are_null(spark):
    patient = one(spark, "patients", {"resourceType": "Patient", "id": "p", "gender": "x", "address": {"state": "TX"}})
    assert (patient.state, patient.gender) == (None, "x")
    claim = one(spark, "claims", {
        "resourceType": "Claim", "id": "c", "status": "active", "diagnosis": "none", "type": "t", "total": 5})
    assert (claim.primary_diagnosis_code, claim.claim_type, claim.total_submitted_charge) == (None, None, None)
    assert claim.status == "active"


def test_packed_bundles_are_read_like_files(spark, tmp_path):
    path = str(tmp_path / "packed")
    written = {"a": GOOD, "b": "", "c": '{"entry":\n [', "d": GOOD + "\n"}
    bundles.pack_bundles(spark.createDataFrame([*list(written.items())[:3]], "name string, value string"), path)
    bundles.pack_bundles(spark.createDataFrame([("d", written["d"])], "name string, value string"), path)
    files = bundles.read_bundles(spark, path, packed=True)
    assert {r.file_path: r.value for r in files.collect()} == {k: v for k, v in written.items() if v}
    inventory = bundles.bundle_inventory(spark, path, packed=True)
    assert {r.file_path: r.length for r in inventory.collect()} == {k: len(v) for k, v in written.items()}
    assert tuple(bundles.arrival_report(inventory).first()) == (4, sum(map(len, written.values())), 1)
    assert [r.file_path for r in bundles.empty_files(inventory).collect()] == ["b"]
    assert [r.file_path for r in bundles.quarantine(files).collect()] == ["c"]


def test_packed_files_do_not_grow_with_the_number_of_bundles(spark, tmp_path):
    def data_files(n):
        path = tmp_path / f"packed-{n}"
        names = spark.range(0, n, 1, 2).select(F.col("id").cast("string").alias("name"), F.lit(GOOD).alias("value"))
        bundles.pack_bundles(names, str(path))
        assert bundles.read_bundles(spark, str(path), packed=True).count() == n
        return len(list(path.glob("*.parquet")))

    assert data_files(20) == data_files(2000) == 2


def test_registered_pages_are_packed(spark, sample):
    import __spark_entry__ as registry

    m = registry.Model(spark, sample)
    pages = m.files.count()
    assert len(m.files.inputFiles()) < pages / 4
    names = {r.file_path.split("-")[0] for r in m.files.select("file_path").collect()}
    assert names == {"page"}


def test_entries_name_their_file(spark, sample):
    import __spark_entry__ as registry

    rows = registry.queries()["bundle_entries"](spark, sample)
    assert rows.columns == ["file_path", "resource_type", "resource_id"]
    found = {(r.file_path[0], r.resource_type) for r in rows.collect() if r.file_path[0] in "PO"}
    assert found == {("P", "Patient"), ("O", "Claim"), ("O", "ExplanationOfBenefit")}


def test_contained_name_their_file(spark, sample):
    import __spark_entry__ as registry

    rows = registry.queries()["bundle_contained"](spark, sample)
    assert rows.columns == ["file_path", "resource_type", "resource_id"]
    assert {(r.file_path[0], r.resource_type) for r in rows.collect()} == {("O", "Coverage"), ("O", "ServiceRequest")}
