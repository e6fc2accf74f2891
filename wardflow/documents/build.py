"""Resource documents from the practice register.

Every builder is one projection: practices in, ``id`` and ``resource_json`` out. What a source
system would supply per document (names, chosen codes, dates) comes in as ``inputs``, a mapping
from the names in ``INPUTS`` to columns of the same frame. Patients, appointments and conditions
come several per practice: their builders take the rows of ``numbered_copies``, joined with
whatever the inputs need. Fields whose value is null are left out.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow import codes
from wardflow.documents.parts import (
    coded_as,
    coding,
    concept,
    contact_point,
    listed,
    narrative,
    period,
    practice_address,
    record,
    reference,
)
from wardflow.functions.numbers import wrapped
from wardflow.functions.text import (
    as_column,
    capitalized,
    default_to,
    email_of,
    lookup,
    padded_id,
    patient_key,
    practitioner_key,
    site_of,
    slug,
    squashed,
)
from wardflow.functions.times import day_text, iso_text
from wardflow.operators.ordinals import fan_out

Inputs = Mapping[str, Column | str]

INPUTS: dict[str, tuple[str, ...]] = {
    "Organization": ("family", "given", "phone"),
    "Endpoint": ("status", "start", "end", "phone"),
    "Practitioner": (
        "active", "family", "given", "prefix", "suffix", "gender", "birth_date", "qualification",
        "certificate", "start", "end", "phone",
    ),
    "PractitionerRole": ("role", "specialty", "practitioner", "practitioner_name", "start", "end"),
    "Patient": (
        "family", "given", "prefix", "phone", "email", "gender", "birth_date", "marital",
        "multiple_birth", "relationship", "contact_family", "contact_given", "contact_prefix",
        "contact_phone", "contact_gender", "start", "end", "language", "preferred",
        "practitioner_number",
    ),
    "Appointment": (
        "practitioner_number", "patient_type", "practitioner_type", "participant_status", "status",
        "description", "start", "end", "created",
    ),
    "Condition": (
        "clinical", "verification", "category", "severity", "condition", "onset", "recorded",
        "abated",
    ),
}


def _inputs(resource: str, given: Inputs) -> dict[str, Column]:
    absent = [name for name in INPUTS[resource] if name not in given]
    if absent:
        raise ValueError(f"{resource} also needs: {', '.join(absent)}")
    return {name: as_column(given[name]) for name in INPUTS[resource]}


def _documents(source: DataFrame, key: Column, fields: dict[str, Column]) -> DataFrame:
    body = F.to_json(record(**fields))
    return source.select(key.alias("id"), body.alias("resource_json"))


def _code() -> Column:
    return F.col("PracticeCode").cast("string")


def _name() -> Column:
    return F.col("GPPracticeName")


def _identifier(kind: tuple[str, str], system: Column | str, value: Column, use: str = "official") -> Column:
    code, display = kind
    return listed(
        record(
            use=use,
            type=concept(codes.IDENTIFIER_TYPE, code, display, display),
            system=system,
            value=value,
        )
    )


RECORD_NUMBER = ("MR", "Medical Record Number")
PROVIDER_NUMBER = ("PRN", "Provider number")


def build_organization(practices: DataFrame, inputs: Inputs) -> DataFrame:
    given = _inputs("Organization", inputs)
    telecom = listed(
        contact_point("email", email_of(squashed(_name())), "work"),
        contact_point("phone", default_to("TelephoneNumber", given["phone"]), "work"),
    )
    contact = record(
        purpose=concept(codes.CONTACT_PURPOSE, "ADMIN", "Administrative", "Administrative Contact"),
        name=record(family=given["family"], given=listed(given["given"])),
        telecom=telecom,
        address=practice_address("AddressLine1", "AddressLine2", "AddressLine3"),
    )
    return _documents(
        practices,
        _code(),
        {
            "resourceType": F.lit("Organization"),
            "id": _code(),
            "text": narrative("Practice: ", _name()),
            "identifier": _identifier(RECORD_NUMBER, site_of(squashed(_name())), _code()),
            "active": F.lit(True),
            "type": listed(
                concept(
                    codes.ORGANIZATION_TYPE, "prov", "Healthcare Provider", "Healthcare Provider"
                )
            ),
            "name": _name(),
            "alias": listed("NHS Scotland"),
            "contact": listed(contact),
        },
    )


def build_endpoint(practices: DataFrame, inputs: Inputs) -> DataFrame:
    given = _inputs("Endpoint", inputs)
    key = slug(_name())
    return _documents(
        practices,
        key,
        {
            "resourceType": F.lit("Endpoint"),
            "id": key,
            "text": narrative("Electronic access of ", _name()),
            "identifier": _identifier(
                RECORD_NUMBER, site_of(key), F.concat(F.lit("ENDPOINT-"), _code())
            ),
            "status": given["status"],
            "connectionType": record(
                system=codes.CONNECTION_TYPE, code="hl7-fhir-rest", display="HL7 FHIR"
            ),
            "name": _name(),
            "managingOrganization": reference("Organization", _code(), _name()),
            "contact": listed(
                contact_point("phone", default_to("TelephoneNumber", given["phone"]), "work"),
                contact_point("email", email_of(key), "work"),
            ),
            "period": period(given["start"], given["end"]),
            "address": email_of(key),
            "header": listed(_name()),
            "payloadType": listed(concept(codes.PAYLOAD_TYPE, "any", "Any", codes.PAYLOAD_NOTE)),
        },
    )


def build_practitioner(practices: DataFrame, inputs: Inputs, number: Column | None = None) -> DataFrame:
    """One practitioner per practice; ``number`` makes the ids those that other documents refer to."""
    given = _inputs("Practitioner", inputs)
    key = practitioner_key("PracticeCode", number)
    certificate = record(
        use="official", system=codes.QUALIFICATION_ID, value=given["certificate"]
    )
    qualification = record(
        identifier=listed(certificate),
        code=coded_as(codes.DEGREE, given["qualification"], codes.QUALIFICATIONS, with_text=True),
        period=period(given["start"], given["end"]),
        issuer=reference("Organization", _code(), _name()),
    )
    name = record(
        family=given["family"],
        given=listed(given["given"]),
        prefix=listed(given["prefix"]),
        suffix=listed(given["suffix"]),
    )
    return _documents(
        practices,
        key,
        {
            "resourceType": F.lit("Practitioner"),
            "text": narrative("Member of staff at ", _name()),
            "id": key,
            "identifier": _identifier(
                PROVIDER_NUMBER,
                site_of(slug(_name(), keep_dash=True), "https"),
                F.concat(F.lit("PR-"), _code()),
            ),
            "active": given["active"],
            "name": listed(name),
            "telecom": listed(
                contact_point("phone", default_to("TelephoneNumber", given["phone"]), "work"),
                contact_point("email", email_of(squashed(_name())), "work"),
            ),
            "gender": given["gender"],
            "birthDate": day_text(given["birth_date"]),
            "address": listed(practice_address("AddressLine1", "AddressLine2", "AddressLine3")),
            "qualification": listed(qualification),
            "communication": listed(concept(codes.LANGUAGE, "en", "English")),
        },
    )


def build_practitioner_role(practices: DataFrame, inputs: Inputs) -> DataFrame:
    given = _inputs("PractitionerRole", inputs)
    site = slug(_name(), keep_dash=True)
    return _documents(
        practices,
        _code(),
        {
            "resourceType": F.lit("PractitionerRole"),
            "text": narrative(
                lookup(given["specialty"], codes.SPECIALTIES), " post at ", _name(),
            ),
            "id": _code(),
            "identifier": _identifier(
                PROVIDER_NUMBER, site_of(site), F.concat(F.lit("ROLE-"), _code())
            ),
            "active": F.lit(True),
            "period": period(given["start"], given["end"]),
            "practitioner": reference(
                "Practitioner", given["practitioner"], given["practitioner_name"]
            ),
            "organization": reference("Organization", _code(), _name()),
            "code": listed(
                coded_as(codes.PRACTITIONER_ROLE, given["role"], codes.ROLES, with_text=True)
            ),
            "specialty": listed(
                coded_as(codes.SNOMED, given["specialty"], codes.SPECIALTIES, with_text=True)
            ),
            "endpoint": listed(
                reference("Endpoint", site, F.concat(_name(), F.lit(" Endpoint")))
            ),
        },
    )


def share_per_practice(practices: DataFrame, total: Column | int) -> Column:
    """Equal whole share of ``total`` for each practice; the practices are only counted here."""
    wanted = total if isinstance(total, Column) else F.lit(total)
    return F.floor(wanted / practices.agg(F.count("*")).scalar())


def numbered_copies(practices: DataFrame, each: Column | int, ordinal: str = "ordinal") -> DataFrame:
    """``each`` rows per practice with ``n`` (from 1) and ``counter`` (running over all practices).

    The counter is arithmetic on the practice's place in the register, so the copies are never
    sorted or numbered together.
    """
    share = each if isinstance(each, Column) else F.lit(each)
    copies = fan_out(practices.withColumn("_each", share.cast("long")), F.col("_each"), "n")
    return copies.withColumn(
        "counter", (F.col(ordinal) - 1) * F.col("_each") + F.col("n")
    ).drop("_each")


def patient_ids(practices: DataFrame, per_practice: int = 100) -> DataFrame:
    """The ids of the patients of each practice."""
    return fan_out(practices, per_practice, "n").select(
        patient_key("PracticeCode", "n").alias("patient_id")
    )


def build_patient(rows: DataFrame, inputs: Inputs) -> DataFrame:
    """Patients; their numbers run over the practices and start again after 100."""
    given = _inputs("Patient", inputs)
    number = wrapped("counter")
    key = patient_key("PracticeCode", number)
    practice = default_to("GPPracticeName", codes.DEFAULT_PRACTICE)
    contact = record(
        relationship=listed(
            coded_as(codes.RELATIONSHIP, given["relationship"], codes.RELATIONSHIPS)
        ),
        name=record(
            family=given["contact_family"],
            given=listed(given["contact_given"]),
            prefix=listed(given["contact_prefix"]),
        ),
        telecom=listed(contact_point("phone", given["contact_phone"], "mobile")),
        address=practice_address("AddressLine2", "AddressLine3"),
        gender=given["contact_gender"],
        organization=reference("Organization", _code(), practice),
        period=period(given["start"], given["end"]),
    )
    number_type = concept(codes.IDENTIFIER_TYPE, *RECORD_NUMBER)
    return _documents(
        rows,
        key,
        {
            "resourceType": F.lit("Patient"),
            "id": key,
            "text": narrative("Patient record"),
            "identifier": listed(
                record(
                    use="usual",
                    type=number_type,
                    system=codes.PATIENT_ID,
                    value=padded_id("MRN-", number, 2),
                )
            ),
            "active": F.lit(True),
            "name": listed(
                record(
                    use="official",
                    family=given["family"],
                    given=listed(given["given"]),
                    prefix=listed(given["prefix"]),
                )
            ),
            "telecom": listed(
                contact_point("phone", given["phone"], "home"),
                contact_point("email", given["email"], "work"),
            ),
            "gender": given["gender"],
            "birthDate": day_text(given["birth_date"]),
            "address": listed(practice_address("AddressLine2", "AddressLine3", use="home")),
            "maritalStatus": coded_as(
                codes.MARITAL, given["marital"], codes.MARITAL_STATUSES, with_text=True
            ),
            "multipleBirthBoolean": given["multiple_birth"],
            "contact": listed(contact),
            "communication": listed(
                record(
                    language=coded_as(
                        codes.LANGUAGE, given["language"], codes.LANGUAGES, with_text=True
                    ),
                    preferred=given["preferred"],
                )
            ),
            "generalPractitioner": listed(
                reference(
                    "Practitioner",
                    practitioner_key("PracticeCode", given["practitioner_number"]),
                    F.concat(F.lit("Practitioner from "), practice),
                )
            ),
            "managingOrganization": reference("Organization", _code(), practice),
        },
    )


def build_appointment(rows: DataFrame, inputs: Inputs) -> DataFrame:
    """Appointments, numbered over all practices."""
    given = _inputs("Appointment", inputs)
    key = padded_id("A", "counter", 5)
    patient = patient_key("PracticeCode", wrapped("counter"))
    practitioner = practitioner_key("PracticeCode", given["practitioner_number"])

    def participant(kind: str, who: Column, type_code: Column) -> Column:
        system = F.when(type_code.isin(*codes.PARTICIPANT_TYPES), codes.PARTICIPANT).otherwise(
            codes.PARTICIPATION
        )
        display = lookup(type_code, {**codes.PARTICIPATION_TYPES, **codes.PARTICIPANT_TYPES})
        return record(
            type=listed(concept(system, type_code, display)),
            actor=reference(kind, who, F.concat(F.lit(kind + " "), who)),
            required="required",
            status=given["participant_status"],
        )

    return _documents(
        rows,
        key,
        {
            "resourceType": F.lit("Appointment"),
            "id": key,
            "text": narrative("Booking of patient ", patient),
            "identifier": listed(record(use="official", system=codes.APPOINTMENT_ID, value=key)),
            "status": given["status"],
            "description": given["description"],
            "start": iso_text(given["start"]),
            "end": iso_text(given["end"]),
            "created": iso_text(given["created"]),
            "minutesDuration": F.lit(30),
            "participant": listed(
                participant("Patient", patient, given["patient_type"]),
                participant("Practitioner", practitioner, given["practitioner_type"]),
            ),
        },
    )


def build_condition(rows: DataFrame, inputs: Inputs) -> DataFrame:
    """Conditions; an end date only where the status says it has ended."""
    given = _inputs("Condition", inputs)
    key = padded_id("C", "counter", 5)
    patient = patient_key("PracticeCode", wrapped("counter"))
    ended = given["clinical"].isin(*codes.ABATED_STATUSES)
    return _documents(
        rows,
        key,
        {
            "resourceType": F.lit("Condition"),
            "id": key,
            "text": narrative("Finding about patient ", patient),
            "clinicalStatus": concept(
                codes.CLINICAL, given["clinical"], capitalized(given["clinical"])
            ),
            "verificationStatus": record(
                coding=coding(
                    codes.VERIFICATION, given["verification"], capitalized(given["verification"])
                )
            ),
            "category": listed(
                coded_as(codes.CONDITION_CATEGORY, given["category"], codes.CONDITION_CATEGORIES)
            ),
            "severity": coded_as(codes.SNOMED, given["severity"], codes.SEVERITIES),
            "code": coded_as(codes.SNOMED, given["condition"], codes.CONDITION_CODES),
            "subject": reference(
                "Patient", patient, F.concat(F.lit("Patient "), patient)
            ),
            "onsetDateTime": day_text(given["onset"]),
            "recordedDate": iso_text(given["recorded"]),
            "note": listed(record(text=codes.CONDITION_NOTE)),
            "abatementDateTime": F.when(ended, day_text(given["abated"])),
        },
    )


BUILDERS = {
    "Organization": build_organization,
    "Endpoint": build_endpoint,
    "Practitioner": build_practitioner,
    "PractitionerRole": build_practitioner_role,
    "Patient": build_patient,
    "Appointment": build_appointment,
    "Condition": build_condition,
}
