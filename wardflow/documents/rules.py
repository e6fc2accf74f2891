"""Conformance rules of the resource documents.

A rule names what must hold. Its condition is a column over the document's own paths; where it
evaluates to null (an absent optional field) the rule counts as met.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from wardflow import codes
from wardflow.documents.flatten import at, is_malformed, open_documents, value
from wardflow.sinks.files import write_apart

SKIP = "skip"
FAIL = "fail"
NONE = "none"


@dataclass(frozen=True)
class Rule:
    name: str
    paths: tuple[str, ...]
    holds: Callable[..., Column]


def is_type(resource: str) -> Rule:
    return Rule("resourceType", ("resourceType",), lambda v: v.eqNullSafe(resource))


def required(path: str) -> Rule:
    return Rule(f"{path} required", (path,), lambda v: F.coalesce(v != "", F.lit(False)))


def one_of(path: str, allowed: Sequence[str]) -> Rule:
    return Rule(f"{path} code", (path,), lambda v: v.isin(*allowed))


def refers_to(path: str, kind: str) -> Rule:
    return Rule(f"{path} reference", (path,), lambda v: v.rlike(f"^{kind}/[^/]+$"))


def is_date(path: str) -> Rule:
    return Rule(f"{path} date", (path,), lambda v: v.isNull() | v.try_cast("date").isNotNull())


def is_time(path: str) -> Rule:
    return Rule(
        f"{path} timestamp", (path,), lambda v: v.isNull() | v.try_cast("timestamp").isNotNull()
    )


def in_order(start: str, end: str) -> Rule:
    return Rule(
        f"{start} before {end}",
        (start, end),
        lambda a, b: a.try_cast("timestamp") <= b.try_cast("timestamp"),
    )


def displays(code: str, display: str, table: dict[str, str]) -> Rule:
    """Code and display text must belong together."""
    pairs = [f"{c}|{d}" for c, d in table.items()]
    return Rule(
        f"{code} display",
        (code, display),
        lambda c, d: F.concat(c, F.lit("|"), F.coalesce(d, F.lit(""))).isin(*pairs),
    )


def only_when(path: str, status: str, allowed: Sequence[str]) -> Rule:
    """A field that may only be there under certain statuses."""
    return Rule(
        f"{path} allowed", (path, status), lambda v, s: v.isNull() | F.coalesce(s.isin(*allowed), F.lit(False))
    )


_capital = {status: status.capitalize() for status in codes.CLINICAL_STATUSES}
_verified = {status: status.capitalize() for status in codes.VERIFICATION_STATUSES}

RULES: dict[str, tuple[Rule, ...]] = {
    "Organization": (
        is_type("Organization"),
        required("id"),
        required("name"),
    ),
    "Endpoint": (
        is_type("Endpoint"),
        required("id"),
        required("status"),
        one_of("status", codes.ENDPOINT_STATUSES),
        required("connectionType.code"),
        required("payloadType[0].coding[0].code"),
        required("address"),
        refers_to("managingOrganization.reference", "Organization"),
        is_date("period.start"),
        is_date("period.end"),
        in_order("period.start", "period.end"),
    ),
    "Practitioner": (
        is_type("Practitioner"),
        required("id"),
        one_of("gender", codes.GENDERS),
        is_date("birthDate"),
        displays(
            "qualification[0].code.coding[0].code",
            "qualification[0].code.coding[0].display",
            codes.QUALIFICATIONS,
        ),
        refers_to("qualification[0].issuer.reference", "Organization"),
        in_order("qualification[0].period.start", "qualification[0].period.end"),
    ),
    "PractitionerRole": (
        is_type("PractitionerRole"),
        required("id"),
        displays("code[0].coding[0].code", "code[0].coding[0].display", codes.ROLES),
        displays(
            "specialty[0].coding[0].code", "specialty[0].coding[0].display", codes.SPECIALTIES
        ),
        refers_to("organization.reference", "Organization"),
        in_order("period.start", "period.end"),
    ),
    "Patient": (
        is_type("Patient"),
        required("id"),
        one_of("gender", codes.GENDERS),
        is_date("birthDate"),
        displays(
            "maritalStatus.coding[0].code",
            "maritalStatus.coding[0].display",
            codes.MARITAL_STATUSES,
        ),
        displays(
            "communication[0].language.coding[0].code",
            "communication[0].language.coding[0].display",
            codes.LANGUAGES,
        ),
        refers_to("managingOrganization.reference", "Organization"),
        refers_to("generalPractitioner[0].reference", "Practitioner"),
        in_order("contact[0].period.start", "contact[0].period.end"),
    ),
    "Appointment": (
        is_type("Appointment"),
        required("id"),
        required("status"),
        one_of("status", codes.APPOINTMENT_STATUSES),
        required("participant[0].status"),
        one_of("participant[0].status", codes.PARTICIPANT_STATUSES),
        one_of("participant[1].status", codes.PARTICIPANT_STATUSES),
        refers_to("participant[0].actor.reference", "Patient"),
        refers_to("participant[1].actor.reference", "Practitioner"),
        is_time("start"),
        is_time("end"),
        is_time("created"),
    ),
    "Condition": (
        is_type("Condition"),
        required("id"),
        displays("clinicalStatus.coding[0].code", "clinicalStatus.coding[0].display", _capital),
        displays(
            "verificationStatus.coding[0].code", "verificationStatus.coding[0].display", _verified
        ),
        displays(
            "category[0].coding[0].code",
            "category[0].coding[0].display",
            codes.CONDITION_CATEGORIES,
        ),
        displays("severity.coding[0].code", "severity.coding[0].display", codes.SEVERITIES),
        required("subject.reference"),
        refers_to("subject.reference", "Patient"),
        is_time("onsetDateTime"),
        is_time("recordedDate"),
        only_when("abatementDateTime", "clinicalStatus.coding[0].code", codes.ABATED_STATUSES),
    ),
}

# What happens to a resource type's bad documents.
POLICIES = {
    "Patient": SKIP,
    "Appointment": SKIP,
    "Practitioner": FAIL,
    "Endpoint": FAIL,
    "Organization": FAIL,
    "Condition": NONE,
    "PractitionerRole": NONE,
}


def with_errors(docs: DataFrame, rules: Sequence[Rule], body: str = "resource_json") -> DataFrame:
    """The documents plus ``errors``, the names of the rules they break. One parse per document."""
    paths = [value(p, "string", p) for rule in rules for p in rule.paths]
    opened = open_documents(docs, paths, body, strict=False)
    broken = [
        F.when(~F.coalesce(rule.holds(*[at(p) for p in rule.paths]), F.lit(True)), F.lit(rule.name))
        for rule in rules
    ]
    malformed = F.when(is_malformed(body), F.lit("malformed"))
    errors = F.filter(F.array(malformed, *broken), lambda name: name.isNotNull())
    return opened.withColumn("errors", errors).drop("_doc")


def validate(
    docs: DataFrame, rules: Sequence[Rule], policy: str = SKIP, body: str = "resource_json"
) -> tuple[DataFrame, DataFrame]:
    """Valid documents, and rejected ones with their ``errors``.

    ``skip`` drops the rejected from the valid; ``fail`` makes the job fail at the first bad
    document it meets; ``none`` lets everything through.
    """
    checked = with_errors(docs, rules, body)
    good = F.size("errors") == 0
    rejected = checked.filter(~good)
    if policy == NONE:
        return docs, rejected
    if policy == FAIL:
        good = F.when(good, F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("invalid document: "), F.to_json("errors"))).cast("boolean")
        )
    elif policy != SKIP:
        raise ValueError(f"no such policy: {policy}")
    return checked.filter(good).drop("errors"), rejected


def write_checked(
    docs: DataFrame, rules: Sequence[Rule], path: str, body: str = "resource_json"
) -> dict[str, int]:
    """Check documents and write both kinds in one pass, returning how many there are of each.

    They go to ``outcome=valid`` and ``outcome=rejected`` below ``path``, with their ``errors``.
    """
    seen = Observation()
    checked = with_errors(docs, rules, body)
    valid = F.size("errors") == 0
    counted = checked.withColumn("outcome", F.when(valid, "valid").otherwise("rejected")).observe(
        seen,
        F.count_if(F.col("outcome") == "valid").alias("valid"),
        F.count_if(F.col("outcome") == "rejected").alias("rejected"),
    )
    write_apart(counted, "outcome", path, "append")
    return seen.get


def require_rows(df: DataFrame, what: str = "data") -> DataFrame:
    """The frame itself, unless it is empty."""
    if df.isEmpty():
        raise ValueError(f"no {what} to process")
    return df
