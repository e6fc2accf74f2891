"""Flatten specs of the six loaded resources.

Fixed values: target names, types, order and source paths of the tables.
"""

from __future__ import annotations

from wardflow.documents.flatten import Target, glued, joined, subtree, tail, value

APPOINTMENT = (
    value("id", "string", "id"),
    value("resourceType", "string", "resourceType"),
    value("created", "timestamp", "created"),
    value("start_time", "timestamp", "start"),
    value("end_time", "timestamp", "end"),
    value("description", "string", "description"),
    value("minutesDuration", "int", "minutesDuration"),
    value("status", "string", "status"),
    tail("patient_id", "participant[0].actor.reference"),
    tail("practitioner_id", "participant[1].actor.reference"),
    # The names are those of the table; Pract_type describes the patient's entry.
    value("Pract_type", "string", "participant[0].type[0].coding[0].display"),
    value("callback_type", "string", "participant[1].type[0].coding[0].display"),
    subtree("participant", "participant"),
    subtree("raw_data"),
)

CONDITION = (
    value("id", "string", "id"),
    value("resourceType", "string", "resourceType"),
    value("recorded_date", "timestamp", "recordedDate"),
    value("onset_date", "timestamp", "onsetDateTime"),
    value("clinical_status", "string", "clinicalStatus.coding[0].code"),
    value("verification_status", "string", "verificationStatus.coding[0].code"),
    value("condition_code", "string", "code.coding[0].code"),
    value("condition_display", "string", "code.coding[0].display"),
    value("severity_code", "string", "severity.coding[0].code"),
    value("severity_display", "string", "severity.coding[0].display"),
    value("category", "string", "category[0].coding[0].code"),
    tail("patient_id", "subject.reference"),
    value("meta_lastUpdated", "timestamp", "meta.lastUpdated"),
    subtree("raw_data"),
)

ENDPOINT = (
    value("id", "string", "id"),
    value("web_address", "string", "address"),
    value("phone", "string", "contact[0].value"),
    value("organization_name", "string", "header[0]"),
    tail("practice_code", "managingOrganization.reference"),
    value("start_date", "date", "period.start"),
    value("end_date", "date", "period.end"),
    subtree("raw_data"),
)

ORGANIZATION = (
    value("id", "string", "id"),
    value("organization_name", "string", "name"),
    joined("address", "contact[0].address.line"),
    value("city", "string", "contact[0].address.city"),
    value("state", "string", "contact[0].address.state"),
    value("country", "string", "contact[0].address.country"),
    value("postal_code", "string", "contact[0].address.postalCode"),
    glued("admin_contact_name", "contact[0].name.given[0]", "contact[0].name.family"),
    value("phone_number", "string", "contact[0].telecom[1].value"),
    value("website", "string", "identifier[0].system"),
    subtree("raw_data"),
)

PATIENT = (
    value("id", "string", "id"),
    glued("patient_name", "name[0].prefix[0]", "name[0].given[0]", "name[0].family"),
    value("date_of_birth", "date", "birthDate"),
    value("phone_number", "string", "telecom[0].value"),
    value("email", "string", "telecom[1].value"),
    value("marital_status", "string", "maritalStatus.coding[0].display"),
    value("multiple_birth", "boolean", "multipleBirthBoolean"),
    value("organization_name", "string", "managingOrganization.display"),
    tail("gp_code", "managingOrganization.reference"),
    tail("general_practitioner", "generalPractitioner[0].reference"),
    glued("emergency_contact_name", "contact[0].name.given[0]", "contact[0].name.family"),
    value(
        "emergency_contact_relationship", "string", "contact[0].relationship[0].coding[0].display"
    ),
    value("emergency_contact_number", "string", "contact[0].telecom[0].value"),
    glued(
        "emergency_contact_address",
        "contact[0].address.line[]",
        "contact[0].address.city",
        "contact[0].address.state",
        "contact[0].address.country",
        "contact[0].address.postalCode",
        by=", ",
    ),
    value("communication_language", "string", "communication[0].language.coding[0].display"),
    subtree("raw_data"),
)

PRACTITIONER = (
    value("id", "string", "id"),
    glued("practitioner_name", "name[0].given[0]", "name[0].family"),
    value("date_of_birth", "date", "birthDate"),
    value("gender", "string", "gender"),
    value("communication_language", "string", "communication[0].coding[0].display"),
    glued(
        "address",
        "address[0].line[]",
        "address[0].city",
        "address[0].state",
        "address[0].country",
        "address[0].postalCode",
        by=", ",
    ),
    value("city", "string", "address[0].city"),
    value("state", "string", "address[0].state"),
    value("country", "string", "address[0].country"),
    value("postal_code", "string", "address[0].postalCode"),
    value("website_address", "string", "identifier[0].system"),
    value("qualification", "string", "qualification[0].code.coding[0].display"),
    value("certification_number", "string", "qualification[0].identifier[0].value"),
    value("organization_name", "string", "qualification[0].issuer.display"),
    tail("gp_code", "qualification[0].issuer.reference"),
    value("phone", "string", "telecom[0].value"),
    value("email", "string", "telecom[1].value"),
    subtree("raw_data"),
)

SPECS: dict[str, tuple[Target, ...]] = {
    "Appointment": APPOINTMENT,
    "Condition": CONDITION,
    "Endpoint": ENDPOINT,
    "Organization": ORGANIZATION,
    "Patient": PATIENT,
    "Practitioner": PRACTITIONER,
}
