from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from wardflow import codes
from wardflow.documents import build
from wardflow.documents.flatten import flatten, flatten_or_reject, schema_of, value
from wardflow.documents.rules import (
    FAIL,
    NONE,
    POLICIES,
    RULES,
    SKIP,
    require_rows,
    validate,
    write_checked,
)
from wardflow.documents.specs import SPECS
from wardflow.operators.merge import empty_like
from wardflow.plans import jobs
from wardflow.schemas import PRACTICE

APPOINTMENT = {
    "resourceType": "Appointment",
    "id": "A00007",
    "status": "booked",
    "description": "Annual review",
    "start": "2025-03-01T09:00:00.500000+00:00",
    "end": "2025-03-01T09:30:00+01:00",
    "created": "2025-02-01",
    "minutesDuration": 30,
    "participant": [
        {
            "type": [{"coding": [{"code": "ATND", "display": "Attender"}]}],
            "actor": {"reference": "Patient/P7-01"},
            "status": "accepted",
        },
        {
            "type": [{"coding": [{"code": "CON", "display": "Consultant"}]}],
            "actor": {"reference": "Practitioner/7-practitioner2"},
            "status": "accepted",
        },
    ],
}

PATIENT = {
    "resourceType": "Patient",
    "id": "P7-01",
    "name": [{"family": "Doe", "given": ["Jo", "Ann"], "prefix": ["Dr."]}],
    "telecom": [{"value": "123"}, {"value": "jo@example.com"}],
    "gender": "other",
    "birthDate": "1980-05-06",
    "maritalStatus": {"coding": [{"code": "S", "display": "Never Married"}]},
    "multipleBirthBoolean": True,
    "managingOrganization": {"reference": "Organization/7", "display": "Seven"},
    "generalPractitioner": [{"reference": "Practitioner/7-practitioner1"}],
    "communication": [{"language": {"coding": [{"code": "de", "display": "German"}]}}],
    "contact": [
        {
            "relationship": [{"coding": [{"code": "N", "display": "Next-of-Kin"}]}],
            "name": {"family": "Roe", "given": ["Al"]},
            "telecom": [{"value": "456"}],
            "address": {
                "line": ["1 Road", None, "Town"], "city": "Town", "state": "S", "country": "UK",
                "postalCode": "AB1",
            },
            "period": {"start": "2020-01-01", "end": "2021-01-01"},
        }
    ],
}


def docs_of(spark, *bodies):
    texts = [(b if isinstance(b, str) else json.dumps(b),) for b in bodies]
    return spark.createDataFrame(texts, "raw_data string")


def test_appointment(spark):
    row = flatten(docs_of(spark, APPOINTMENT), SPECS["Appointment"]).first()
    assert (row.id, row.patient_id, row.practitioner_id) == ("A00007", "P7-01", "7-practitioner2")
    assert (row.Pract_type, row.callback_type, row.minutesDuration) == ("Attender", "Consultant", 30)
    assert row.start_time.isoformat() == "2025-03-01T09:00:00.500000"
    assert row.end_time.isoformat() == "2025-03-01T08:30:00"
    assert row.created.isoformat() == "2025-02-01T00:00:00"
    assert row.raw_data.toPython() == APPOINTMENT
    assert row.participant.toPython() == APPOINTMENT["participant"]


def test_patient(spark):
    row = flatten(docs_of(spark, PATIENT), SPECS["Patient"]).drop("raw_data").first().asDict()
    assert row.pop("date_of_birth").isoformat() == "1980-05-06"
    assert row == {
        "id": "P7-01",
        "patient_name": "Dr. Jo Doe",
        "phone_number": "123",
        "email": "jo@example.com",
        "marital_status": "Never Married",
        "multiple_birth": True,
        "organization_name": "Seven",
        "gp_code": "7",
        "general_practitioner": "7-practitioner1",
        "emergency_contact_name": "Al Roe",
        "emergency_contact_relationship": "Next-of-Kin",
        "emergency_contact_number": "456",
        "emergency_contact_address": "1 Road, Town, Town, S, UK, AB1",
        "communication_language": "German",
    }


def test_absent_parts_are_null(spark):
    row = flatten(docs_of(spark, {"id": "P1", "name": [{"family": "Doe"}], "contact": []}), SPECS["Patient"]).first()
    assert row.id == "P1"
    assert row.patient_name is None
    assert row.emergency_contact_address is None
    condition = flatten(docs_of(spark, {"id": "C1", "recordedDate": "2025-01-22T17:23:22.563961"}), SPECS["Condition"]).first()
    assert condition.meta_lastUpdated is None
    assert condition.recorded_date.isoformat() == "2025-01-22T17:23:22.563961"


def test_strict_loads_fail_on_bad_values_and_bad_text(spark):
    for bad in ({**PATIENT, "birthDate": "soon"}, '{"id": '):
        with pytest.raises(Exception, match="CAST|MALFORMED|Malformed"):
            flatten(docs_of(spark, bad), SPECS["Patient"]).collect()


def test_lenient_loads_reject_bad_documents(spark):
    docs = docs_of(spark, PATIENT, {**PATIENT, "birthDate": "soon"}, '{"id": ', {"id": 5, "birthDate": None})
    rows, rejects = flatten_or_reject(docs, SPECS["Patient"])
    assert sorted(r.id for r in rows.collect()) == ["5", "P7-01"]
    assert sorted(r.bad_columns for r in rejects.collect()) == [["date_of_birth"], ["raw_data"]]
    lenient = flatten(docs, SPECS["Patient"], strict=False)
    assert lenient.count() == 4


def test_whole_numbers_may_be_written_with_a_point(spark):
    spec = (value("n", "int", "n"), value("b", "boolean", "b"))
    found = flatten(docs_of(spark, '{"n": 30.0, "b": "true"}', '{"n": "7", "b": false}'), spec)
    assert [tuple(r) for r in found.collect()] == [(30, True), (7, False)]


def test_documents_given_as_variant(spark):
    docs = docs_of(spark, PATIENT).select(F.parse_json("raw_data").alias("raw_data"))
    assert flatten(docs, SPECS["Patient"][:2]).first().patient_name == "Dr. Jo Doe"


def test_schema_covers_only_the_paths():
    found = schema_of((value("a", "int", "x.y[0].z"), value("b", "string", "x.w")))
    assert found.simpleString() == "struct<x:struct<y:array<struct<z:string>>,w:string>>"


def test_documents_are_parsed_once_below_filters(spark):
    docs = docs_of(spark, PATIENT)
    found = flatten(docs, SPECS["Patient"][:-1]).filter("gp_code = '7' and email like '%@%'")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    assert found.count() == 1


PRACTICES = [
    (10002, "Mill-Lane Surgery, North", "Mill House", "", "Northtown", None, "Cluster 4", "N1 1AA", "0123"),
    (10003, "Second", None, "2 Street", "Town", "City", "Cluster 5", "N2", None),
]


@pytest.fixture
def practices(spark):
    return spark.createDataFrame(PRACTICES, PRACTICE).withColumn(
        "ordinal", F.col("PracticeCode") - 10001
    )


def bodies(df):
    return {r.id: json.loads(r.resource_json) for r in df.collect()}


def test_organization_document(practices):
    made = bodies(build.build_organization(
        practices, {"family": F.lit("Doe"), "given": F.lit("Jo"), "phone": F.lit("none")}
    ))
    first = made["10002"]
    assert first["identifier"][0]["system"] == "http://mill-lanesurgery,north.com"
    assert first["contact"][0]["telecom"][0]["value"] == "mill-lanesurgery,north@nhs.scot.co.uk"
    assert first["contact"][0]["address"]["line"] == ["Mill House", "Northtown"]
    assert first["contact"][0]["address"]["city"] == "Northtown"
    assert first["text"]["div"].endswith("Practice: Mill-Lane Surgery, North</div>")
    assert made["10003"]["contact"][0]["telecom"][1]["value"] == "none"
    assert made["10003"]["contact"][0]["address"]["city"] == "City"


def condition_inputs(status):
    day = F.lit("2024-01-01").cast("date")
    return {
        "clinical": F.lit(status), "verification": F.lit("confirmed"),
        "category": F.lit("encounter-diagnosis"), "severity": F.lit("24484000"),
        "condition": F.lit("25064002"), "onset": day, "recorded": day.cast("timestamp"), "abated": day,
    }


def test_conditions_end_only_when_their_status_says_so(practices):
    rows = build.numbered_copies(practices, 3)
    active = bodies(build.build_condition(rows, condition_inputs("active")))
    assert sorted(active) == [f"C{n:05d}" for n in range(1, 7)]
    assert "abatementDateTime" not in active["C00001"]
    assert active["C00004"]["subject"]["reference"] == "Patient/P10003-04"
    ended = bodies(build.build_condition(rows, condition_inputs("remission")))
    assert ended["C00001"]["abatementDateTime"] == "2024-01-01"
    assert ended["C00001"]["clinicalStatus"]["coding"][0]["display"] == "Remission"


def test_counters_run_over_practices_and_wrap(practices):
    rows = build.numbered_copies(practices, build.share_per_practice(practices, 240))
    assert rows.count() == 240
    assert rows.filter("PracticeCode = 10003").agg(F.min("counter")).first()[0] == 121
    ids = build.patient_ids(practices).orderBy("patient_id").collect()
    assert len(ids) == 200
    assert {"P10002-01", "P10003-100"} <= {r.patient_id for r in ids}


def test_missing_inputs_are_named(practices):
    with pytest.raises(ValueError, match="phone"):
        build.build_organization(practices, {"family": F.lit("x"), "given": F.lit("y")})


def with_ids(spark, *documents):
    return spark.createDataFrame(
        [(d.get("id"), json.dumps(d)) for d in documents], "id string, resource_json string"
    )


def test_validation_policies(spark):
    wrong_status = {**APPOINTMENT, "id": "A2", "status": "lost"}
    wrong_type = {**APPOINTMENT, "id": "A3", "resourceType": "Patient"}
    docs = with_ids(spark, APPOINTMENT, wrong_status, wrong_type)
    valid, rejected = validate(docs, RULES["Appointment"], SKIP)
    assert [r.id for r in valid.collect()] == ["A00007"]
    assert {r.id: r.errors for r in rejected.collect()} == {"A2": ["status code"], "A3": ["resourceType"]}
    assert validate(docs, RULES["Appointment"], NONE)[0].count() == 3
    with pytest.raises(Exception, match="invalid document"):
        validate(docs, RULES["Appointment"], FAIL)[0].collect()
    good = with_ids(spark, APPOINTMENT)
    assert validate(good, RULES["Appointment"], FAIL)[0].count() == 1
    assert valid.columns == docs.columns
    with pytest.raises(ValueError, match="no such policy"):
        validate(docs, RULES["Appointment"], "perhaps")


def test_checked_documents_are_written_in_one_pass(spark, tmp_path):
    docs = with_ids(spark, APPOINTMENT, {**APPOINTMENT, "id": "A2", "status": "lost"})
    path = str(tmp_path / "checked")
    assert write_checked(docs, RULES["Appointment"], path) == {"valid": 1, "rejected": 1}
    back = {r.id: (r.outcome, r.errors) for r in spark.read.parquet(path).collect()}
    assert back == {"A00007": ("valid", []), "A2": ("rejected", ["status code"])}


def errors_of(spark, resource, document):
    _, rejected = validate(with_ids(spark, document), RULES[resource], SKIP)
    found = rejected.first()
    return found.errors if found else []


def test_rules(spark):
    endpoint = {
        "resourceType": "Endpoint", "id": "e", "status": "error",
        "managingOrganization": {"reference": "Organization/1"},
        "period": {"start": "2021-01-01", "end": "2026-01-01"},
        "connectionType": {"code": "x"}, "payloadType": [{"coding": [{"code": "any"}]}], "address": "a@b",
    }
    assert errors_of(spark, "Endpoint", endpoint) == ["status code"]
    bare = {"resourceType": "Endpoint", "id": "e"}
    assert errors_of(spark, "Endpoint", bare) == [
        "status required", "connectionType.code required", "payloadType[0].coding[0].code required",
        "address required",
    ]
    assert errors_of(spark, "Appointment", {"resourceType": "Appointment", "id": "a"}) == [
        "status required", "participant[0].status required",
    ]
    assert errors_of(spark, "Condition", {"resourceType": "Condition", "id": "c"}) == [
        "subject.reference required",
    ]
    endpoint.update(status="active", period={"start": "2027-01-01", "end": "2026-01-01"})
    assert errors_of(spark, "Endpoint", endpoint) == ["period.start before period.end"]
    condition = {
        "resourceType": "Condition", "id": "C1",
        "clinicalStatus": {"coding": [{"code": "active", "display": "Remission"}]},
        "verificationStatus": {"coding": [{"code": "provisional", "display": "Unconfirmed"}]},
        "subject": {"reference": "Organization/P1"},
        "abatementDateTime": "2024-09-09",
    }
    assert errors_of(spark, "Condition", condition) == [
        "clinicalStatus.coding[0].code display",
        "verificationStatus.coding[0].code display",
        "subject.reference reference",
        "abatementDateTime allowed",
    ]
    assert errors_of(spark, "Patient", PATIENT) == []
    assert errors_of(spark, "Patient", {**PATIENT, "id": "", "birthDate": "1980-13-01"}) == [
        "id required", "birthDate date",
    ]


def test_empty_input_is_an_error(spark):
    with pytest.raises(ValueError, match="no data"):
        require_rows(empty_like(spark.range(1)))


def test_register_to_table(spark, practices, tmp_path):
    """Build, check, store, load, and skip what is stored already."""
    store = str(tmp_path / "store")
    inputs = {"family": F.lit("Doe"), "given": F.lit("Jo"), "phone": F.lit("none")}
    rejected = jobs.produce_resources(practices, "Organization", inputs, store)
    assert rejected.count() == 0
    loaded = jobs.load_resource(spark, store, "Organization")
    assert sorted(r.id for r in loaded.collect()) == ["10002", "10003"]
    done = str(tmp_path / "done")
    spark.createDataFrame([("10002",)], "id string").write.parquet(done)
    for _ in range(2):
        jobs.produce_resources(practices, "Organization", inputs, store, done=done)
        found = jobs.load_resource(spark, store, "Organization")
        assert sorted(r.id for r in found.collect()) == ["10002", "10003"]
        assert sorted(r.id for r in spark.read.parquet(done).collect()) == ["10002", "10003"]
    changed = {**inputs, "family": F.lit("Poe")}
    jobs.produce_resources(practices, "Organization", changed, store)
    loaded = jobs.load_resource(spark, store, "Organization")
    assert loaded.count() == 2
    held = [p.read_text() for p in (tmp_path / "store" / "Organization").rglob("part-*.txt")]
    assert held and all("Poe" in text and "Doe" not in text for text in held)
    tables = jobs.create_processed({"organization": (loaded, ["id"])}, str(tmp_path / "processed"))
    assert jobs.refresh(tables["organization"], loaded)
    assert jobs.refresh(tables["organization"], loaded)
    assert tables["organization"].read().count() == 2
    row = tables["organization"].read().filter("id = '10002'").first()
    assert row.address == "Mill House, Northtown"
    assert row.raw_data.toPython()["resourceType"] == "Organization"


def test_rejects_of_a_load_are_kept(spark, tmp_path):
    folder = tmp_path / "store" / "Patient"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text(json.dumps(PATIENT) + "\n" + json.dumps({**PATIENT, "birthDate": "x"}))
    rows = jobs.load_good_resources(spark, str(tmp_path / "store"), "Patient", str(tmp_path / "rejects"))
    assert rows.count() == 1
    assert spark.read.parquet(str(tmp_path / "rejects")).first().bad_columns == ["date_of_birth"]


def test_every_resource_has_its_parts():
    assert set(SPECS) < set(build.BUILDERS) == set(RULES) == set(POLICIES) == set(build.INPUTS)
    assert set(codes.ABATED_STATUSES) < set(codes.CLINICAL_STATUSES)
