"""Reading ids, years and numbers out of resource text fields."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The reference formats that are understood.
PATIENT_REFERENCE = r"(?:Patient/|urn:uuid:)(.+)"
PRACTITIONER_REFERENCE = r"Practitioner/(.+)"
ORGANIZATION_REFERENCE = r"Organization/(.+)"
CLAIM_REFERENCE = r"Claim/(.+)"


def referenced_id(reference: Column, pattern: str) -> Column:
    """Id behind a reference: '' when the format is another one, NULL when absent."""
    return F.regexp_extract(reference, pattern, 1)


def year_of(text: Column) -> Column:
    """Year in the session zone (UTC); NULL for text that is no date."""
    return F.year(F.try_to_timestamp(text))


def number_of(text: Column) -> Column:
    """Double, or NULL for text that is no number; an infinity is none."""
    number = text.try_cast("double")
    return F.when(F.abs(number) < float("inf"), number)
