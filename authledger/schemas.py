"""Column lists of the stored tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql.types import StructType

# Names, order and types of the stored columns are the data contract.
SILVER = {
    "patients": (
        "patient_id string, birth_date string, gender string, state string, city string, "
        "postal_code string, marital_status string"
    ),
    "claims": (
        "claim_id string, status string, created string, claim_year int, patient_id string, "
        "provider_id string, payer_id string, total_submitted_charge double, claim_type string, "
        "primary_diagnosis_code string, primary_diagnosis_desc string"
    ),
    "explanations": (
        "eob_id string, status string, outcome string, created string, eob_year int, "
        "patient_id string, claim_id string, payment_amount double, prior_auth_ref string, "
        "coverage_ref string"
    ),
    "coverages": (
        "coverage_id string, status string, patient_id string, payer_name string, "
        "coverage_start string, coverage_end string, coverage_type string"
    ),
    "prior_auth": (
        "service_request_id string, status string, intent string, patient_id string, "
        "procedure_code string, procedure_description string, authored_on string, auth_year int, "
        "reason_code string, reason_description string, requester_ref string"
    ),
    "encounters": (
        "encounter_id string, status string, encounter_year int, patient_id string, "
        "encounter_class string, encounter_type string, encounter_start string, "
        "encounter_end string, provider_name string"
    ),
    "conditions": (
        "condition_id string, patient_id string, icd10_code string, condition_description string, "
        "onset_date string, abatement_date string, clinical_status string"
    ),
}

# The parts of a bundle resource that the silver tables read. Fields whose shape
# depends on the resource type (address, total, type) are kept as JSON text.
_REFERENCE = "struct<reference: string>"
_CONCEPT = "struct<coding: array<struct<code: string>>, text: string>"
RESOURCE_FIELDS = {
    "resourceType": "string",
    "id": "string",
    "status": "string",
    "intent": "string",
    "outcome": "string",
    "birthDate": "string",
    "gender": "string",
    "created": "string",
    "authoredOn": "string",
    "onsetDateTime": "string",
    "abatementDateTime": "string",
    "address": "string",
    "total": "string",
    "type": "string",
    "patient": _REFERENCE,
    "subject": _REFERENCE,
    "beneficiary": _REFERENCE,
    "provider": _REFERENCE,
    "insurer": _REFERENCE,
    "requester": _REFERENCE,
    "claim": _REFERENCE,
    "serviceProvider": "struct<display: string>",
    "payor": "array<struct<display: string>>",
    "maritalStatus": "struct<text: string>",
    "class": "struct<code: string>",
    "code": _CONCEPT,
    "clinicalStatus": _CONCEPT,
    "reasonCode": f"array<{_CONCEPT}>",
    "period": "struct<start: string, end: string>",
    "payment": "struct<amount: struct<value: string>>",
    "diagnosis": f"array<struct<diagnosisCodeableConcept: {_CONCEPT}>>",
    "insurance": f"array<struct<preAuthRef: array<string>, coverage: {_REFERENCE}>>",
}
# What each silver table reads of a resource besides its type and id.
TABLE_FIELDS = {
    "patients": ("birthDate", "gender", "address", "maritalStatus"),
    "claims": ("status", "created", "patient", "provider", "insurer", "total", "type", "diagnosis"),
    "explanations": ("status", "outcome", "created", "patient", "claim", "payment", "insurance"),
    "coverages": ("status", "beneficiary", "payor", "period", "type"),
    "prior_auth": ("status", "intent", "subject", "code", "authoredOn", "reasonCode", "requester"),
    "encounters": ("status", "period", "subject", "class", "type", "serviceProvider"),
    "conditions": ("subject", "code", "onsetDateTime", "abatementDateTime", "clinicalStatus"),
}


def resource_fields(tables: Iterable[str]) -> list[str]:
    """Fields of a resource that these tables read, in the declared order; type and id always."""
    wanted = {"resourceType", "id"}.union(*[TABLE_FIELDS[table] for table in tables])
    return [name for name in RESOURCE_FIELDS if name in wanted]


def resource_type(fields: Iterable[str]) -> str:
    """DDL of the members of a parsed resource with these fields."""
    return ", ".join(f"{name}: {RESOURCE_FIELDS[name]}" for name in fields)


GOLD = {
    "procedure_approval_rates": (
        "ar_claim_type string, ar_payer_name string, total_patients bigint, total_claims bigint, "
        "total_approved bigint, approval_rate double, denial_rate double, "
        "avg_payment_amount double, avg_submitted_charge double"
    ),
    "payer_performance": (
        "payer_name string, unique_patients bigint, total_claims bigint, total_approved bigint, "
        "avg_approval_rate double, avg_denial_rate double, avg_payment_amount double, "
        "avg_submitted_charge double, total_revenue_at_risk double"
    ),
    "pa_risk_scores": (
        "service_request_id string, patient_id string, status string, authored_on string, "
        "payer_name string, coverage_type string, claim_type string, "
        "historical_approval_rate double, historical_denial_rate double, "
        "avg_submitted_charge double, pa_risk_score double, risk_tier string, "
        "revenue_at_risk double"
    ),
}

DECLARED = {**SILVER, **GOLD}

PARTITION_COLUMNS = {
    "claims": "claim_year",
    "explanations": "eob_year",
    "prior_auth": "auth_year",
    "encounters": "encounter_year",
}


def struct(table: str) -> StructType:
    return StructType.fromDDL(DECLARED[table])


def columns(table: str) -> list[str]:
    return struct(table).fieldNames()
