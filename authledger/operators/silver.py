"""Typed tables out of parsed bundle resources, one per resource type."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from authledger.functions.references import (
    CLAIM_REFERENCE,
    ORGANIZATION_REFERENCE,
    PATIENT_REFERENCE,
    PRACTITIONER_REFERENCE,
    number_of,
    referenced_id,
    year_of,
)
from authledger.sources import bundles

Columns = Callable[[Column, Column], dict[str, Column]]


def first(array: Column) -> Column:
    return F.get(array, F.lit(0))


def first_code(concept: Column) -> Column:
    return first(concept["coding"])["code"]


def patient_of(link: Column) -> Column:
    return referenced_id(link["reference"], PATIENT_REFERENCE)


def _patients(r: Column, rid: Column) -> dict[str, Column]:
    return {
        "patient_id": rid,
        "birth_date": r["birthDate"],
        "gender": r["gender"],
        "state": F.get_json_object(r["address"], "$[0].state"),
        "city": F.get_json_object(r["address"], "$[0].city"),
        "postal_code": F.get_json_object(r["address"], "$[0].postalCode"),
        "marital_status": r["maritalStatus"]["text"],
    }


def _claims(r: Column, rid: Column) -> dict[str, Column]:
    diagnosis = first(r["diagnosis"])["diagnosisCodeableConcept"]
    return {
        "claim_id": rid,
        "status": r["status"],
        "created": r["created"],
        "claim_year": year_of(r["created"]),
        "patient_id": patient_of(r["patient"]),
        "provider_id": referenced_id(r["provider"]["reference"], PRACTITIONER_REFERENCE),
        "payer_id": referenced_id(r["insurer"]["reference"], ORGANIZATION_REFERENCE),
        "total_submitted_charge": number_of(AMOUNT_TEXT["claims"](r)),
        "claim_type": F.get_json_object(r["type"], "$.coding[0].code"),
        "primary_diagnosis_code": first_code(diagnosis),
        "primary_diagnosis_desc": diagnosis["text"],
    }


def _explanations(r: Column, rid: Column) -> dict[str, Column]:
    insurance = first(r["insurance"])
    return {
        "eob_id": rid,
        "status": r["status"],
        "outcome": r["outcome"],
        "created": r["created"],
        "eob_year": year_of(r["created"]),
        "patient_id": patient_of(r["patient"]),
        "claim_id": referenced_id(r["claim"]["reference"], CLAIM_REFERENCE),
        "payment_amount": number_of(AMOUNT_TEXT["explanations"](r)),
        "prior_auth_ref": first(insurance["preAuthRef"]),
        "coverage_ref": insurance["coverage"]["reference"],
    }


def _coverages(r: Column, rid: Column) -> dict[str, Column]:
    return {
        "coverage_id": rid,
        "status": r["status"],
        "patient_id": patient_of(r["beneficiary"]),
        "payer_name": first(r["payor"])["display"],
        "coverage_start": r["period"]["start"],
        "coverage_end": r["period"]["end"],
        "coverage_type": F.get_json_object(r["type"], "$.text"),
    }


def _prior_auth(r: Column, rid: Column) -> dict[str, Column]:
    reason = first(r["reasonCode"])
    return {
        "service_request_id": rid,
        "status": r["status"],
        "intent": r["intent"],
        "patient_id": patient_of(r["subject"]),
        "procedure_code": first_code(r["code"]),
        "procedure_description": r["code"]["text"],
        "authored_on": r["authoredOn"],
        "auth_year": year_of(r["authoredOn"]),
        "reason_code": first_code(reason),
        "reason_description": reason["text"],
        "requester_ref": r["requester"]["reference"],
    }


def _encounters(r: Column, rid: Column) -> dict[str, Column]:
    return {
        "encounter_id": rid,
        "status": r["status"],
        "encounter_year": year_of(r["period"]["start"]),
        "patient_id": patient_of(r["subject"]),
        "encounter_class": r["class"]["code"],
        "encounter_type": F.get_json_object(r["type"], "$[0].text"),
        "encounter_start": r["period"]["start"],
        "encounter_end": r["period"]["end"],
        "provider_name": r["serviceProvider"]["display"],
    }


def _conditions(r: Column, rid: Column) -> dict[str, Column]:
    return {
        "condition_id": rid,
        "patient_id": patient_of(r["subject"]),
        "icd10_code": first_code(r["code"]),
        "condition_description": r["code"]["text"],
        "onset_date": r["onsetDateTime"],
        "abatement_date": r["abatementDateTime"],
        "clinical_status": first_code(r["clinicalStatus"]),
    }


# Amounts as they stand in a resource.
AMOUNT_TEXT: dict[str, Callable[[Column], Column]] = {
    "claims": lambda r: F.get_json_object(r["total"], "$.value"),
    "explanations": lambda r: r["payment"]["amount"]["value"],
}


# Table -> resource type and its columns.
PROJECTIONS: dict[str, tuple[str, Columns]] = {
    "patients": ("Patient", _patients),
    "claims": ("Claim", _claims),
    "explanations": ("ExplanationOfBenefit", _explanations),
    "coverages": ("Coverage", _coverages),
    "prior_auth": ("ServiceRequest", _prior_auth),
    "encounters": ("Encounter", _encounters),
    "conditions": ("Condition", _conditions),
}


def silver_table(resource_rows: DataFrame, table: str) -> DataFrame:
    """One typed table out of (resource_type, resource_id, r) rows."""
    resource_type, columns = PROJECTIONS[table]
    named = columns(F.col("r"), F.col("resource_id"))
    return resource_rows.filter(F.col("resource_type") == resource_type).select(
        *[column.alias(name) for name, column in named.items()]
    )


def unusable_amounts(resource_rows: DataFrame) -> DataFrame:
    """(table_name, resource_id, amount) of amounts that are there but are no finite number.

    They are NULL in the typed tables; this is what was found in their place.
    """
    parts = []
    for table, text in AMOUNT_TEXT.items():
        amount = text(F.col("r"))
        parts.append(
            resource_rows.filter((F.col("resource_type") == PROJECTIONS[table][0]) & amount.isNotNull() & number_of(amount).isNull())
            .select(F.lit(table).alias("table_name"), "resource_id", amount.alias("amount"))
        )
    return reduce(DataFrame.unionByName, parts)


def silver_from_bundles(files: DataFrame, table: str) -> DataFrame:
    """One typed table straight from bundle files; the parser converts only what it reads."""
    resource_type, _ = PROJECTIONS[table]
    return silver_table(bundles.resources(files, [table], [resource_type]), table)


def staged_rows(resource_rows: DataFrame) -> DataFrame:
    """Resource rows labelled with the table they go to.

    Written once, partitioned by ``target``, this lets seven tables be built from
    a single parse of the bundles, and what is written is the parts that the
    tables read, not the JSON.
    """
    target = F.when(F.col("rejected_text").isNotNull(), "quarantine")
    for table, (resource_type, _) in PROJECTIONS.items():
        target = target.when(F.col("resource_type") == resource_type, table)
    return resource_rows.withColumn("target", target.otherwise("other")).withColumn(
        "r", F.when(F.col("target") != "other", F.col("r"))
    )
