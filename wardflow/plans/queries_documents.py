"""Documents built from the test tables, checked and flattened again.

The SQL next to each query computes the flat columns straight from the tables, so building and
flattening must undo each other.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from wardflow import codes
from wardflow.documents import build, specs
from wardflow.documents.flatten import flatten
from wardflow.documents.rules import RULES, SKIP, validate, with_errors
from wardflow.operators.ordinals import with_ordinal
from wardflow.plans import standins as d
from wardflow.plans.catalog import query
from wardflow.plans.standins import sql_pick, with_tables

BODY = "resource_json"


def _flat(docs, spec):
    """Flattened rows with the document reduced to its type, and instants without a zone."""
    rows = flatten(docs, spec, body=BODY)
    rows = rows.withColumn("raw_type", F.variant_get("raw_data", "$.resourceType", "string"))
    instants = [n for n, t in rows.dtypes if t == "timestamp"]
    return rows.drop("raw_data").withColumns({n: F.col(n).cast("timestamp_ntz") for n in instants})


def _code():
    return F.col("PracticeCode")


def _start():
    return F.date_add(F.lit("2020-01-01").cast("date"), (_code() % 1000).cast("int"))


def _end():
    return F.date_add(F.lit("2024-06-30").cast("date"), (_code() % 500).cast("int"))


def practice_inputs(dates: bool = True):
    """Names and dates that differ from practice to practice."""
    names = {
        "family": F.concat(F.lit("Family"), _code()),
        "given": F.concat(F.lit("Given"), _code() % 7),
        "phone": F.lit("0000"),
    }
    return {**names, "start": _start(), "end": _end()} if dates else names


def endpoint_inputs():
    return {**practice_inputs(), "status": d.pick(codes.ENDPOINT_STATUSES, _code())}


_START_SQL = "date '2020-01-01' + cast(\"PracticeCode\" % 1000 as integer)"
_END_SQL = "date '2024-06-30' + cast(\"PracticeCode\" % 500 as integer)"
_SQUASHED_SQL = "lower(replace(\"GPPracticeName\", ' ', ''))"
_SLUG_SQL = f"regexp_replace({_SQUASHED_SQL}, '[^a-z0-9]', '', 'g')"
_CITY_SQL = "coalesce(nullif(\"AddressLine4\", ''), \"AddressLine3\")"


def _lines_sql(*lines: str) -> str:
    listed = ", ".join(f'"{line}"' for line in lines)
    return f"array_to_string(list_filter([{listed}], lambda x: x <> ''), ', ')"


_THREE_LINES = _lines_sql("AddressLine1", "AddressLine2", "AddressLine3")
_TWO_LINES = _lines_sql("AddressLine2", "AddressLine3")


def _full_address_sql(lines: str) -> str:
    return f"{lines} || ', ' || {_CITY_SQL} || ', ' || \"GPCluster\" || ', United Kingdom, ' || \"Postcode\""


@query(
    "flatten_organization",
    with_tables(
        "practices",
        body=f"""
        select cast("PracticeCode" as varchar) as id, "GPPracticeName" as organization_name,
          {_THREE_LINES} as address, {_CITY_SQL} as city, "GPCluster" as state,
          'United Kingdom' as country, "Postcode" as postal_code,
          'Given' || ("PracticeCode" % 7) || ' Family' || "PracticeCode" as admin_contact_name,
          coalesce("TelephoneNumber", '0000') as phone_number,
          'http://' || {_SQUASHED_SQL} || '.com' as website, 'Organization' as raw_type
        from practices""",
    ),
)
def flatten_organization(spark, sf_dir):
    docs = build.build_organization(d.practices(spark, sf_dir), practice_inputs())
    return _flat(docs, specs.ORGANIZATION)


@query(
    "flatten_endpoint",
    with_tables(
        "practices",
        body=f"""
        select {_SLUG_SQL} as id, {_SLUG_SQL} || '@nhs.scot.co.uk' as web_address,
          coalesce("TelephoneNumber", '0000') as phone, "GPPracticeName" as organization_name,
          cast("PracticeCode" as varchar) as practice_code, {_START_SQL} as start_date,
          {_END_SQL} as end_date, 'Endpoint' as raw_type
        from practices""",
    ),
)
def flatten_endpoint(spark, sf_dir):
    docs = build.build_endpoint(d.practices(spark, sf_dir), endpoint_inputs())
    return _flat(docs, specs.ENDPOINT)


_DEGREES = tuple(codes.QUALIFICATIONS)

def practitioner_inputs():
    return {
        **practice_inputs(),
        "active": _code() % 2 == 0,
        "prefix": F.lit("Dr."),
        "suffix": F.lit("MD"),
        "gender": d.pick(codes.GENDERS, _code()),
        "birth_date": F.date_sub(_start(), 14000),
        "qualification": d.pick(_DEGREES, _code()),
        "certificate": F.concat(F.lit("QUAL-"), _code() + 10000),
    }


@query(
    "flatten_practitioner",
    with_tables(
        "practices",
        body=f"""
        select "PracticeCode" || '-practitioner' as id,
          'Given' || ("PracticeCode" % 7) || ' Family' || "PracticeCode" as practitioner_name,
          {_START_SQL} - 14000 as date_of_birth, {sql_pick(codes.GENDERS, '"PracticeCode"')} as gender,
          'English' as communication_language, {_full_address_sql(_THREE_LINES)} as address,
          {_CITY_SQL} as city, "GPCluster" as state, 'United Kingdom' as country,
          "Postcode" as postal_code,
          'https://' || regexp_replace({_SQUASHED_SQL}, '[^a-z0-9-]', '', 'g') || '.com' as website_address,
          {sql_pick(tuple(codes.QUALIFICATIONS.values()), '"PracticeCode"')} as qualification,
          'QUAL-' || ("PracticeCode" + 10000) as certification_number,
          "GPPracticeName" as organization_name, cast("PracticeCode" as varchar) as gp_code,
          coalesce("TelephoneNumber", '0000') as phone, {_SQUASHED_SQL} || '@nhs.scot.co.uk' as email,
          'Practitioner' as raw_type
        from practices""",
    ),
)
def flatten_practitioner(spark, sf_dir):
    docs = build.build_practitioner(d.practices(spark, sf_dir), practitioner_inputs())
    return _flat(docs, specs.PRACTITIONER)


_ROLES = tuple(codes.ROLES)
_SPECIALTIES = tuple(codes.SPECIALTIES)


@query(
    "build_practitioner_role",
    with_tables(
        "practices",
        body=f"""
        select cast("PracticeCode" as varchar) as id, 'ROLE-' || "PracticeCode" as role_number,
          {sql_pick(tuple(codes.ROLES.values()), '"PracticeCode"')} as role,
          {sql_pick(tuple(codes.SPECIALTIES.values()), '"PracticeCode"')} as specialty,
          'Organization/' || "PracticeCode" as organization,
          'Endpoint/' || regexp_replace({_SQUASHED_SQL}, '[^a-z0-9-]', '', 'g') as endpoint,
          strftime({_START_SQL}, '%Y-%m-%d') as start_text, 'Practitioner/' || "PracticeCode" || '-p' as practitioner,
          '<div xmlns="http://www.w3.org/1999/xhtml">' || {sql_pick(tuple(codes.SPECIALTIES.values()), '"PracticeCode"')}
            || ' post at ' || "GPPracticeName" || '</div>' as narrative
        from practices""",
    ),
)
def build_practitioner_role(spark, sf_dir):
    from wardflow.documents.flatten import value

    docs = build.build_practitioner_role(
        d.practices(spark, sf_dir),
        {
            "role": d.pick(_ROLES, _code()),
            "specialty": d.pick(_SPECIALTIES, _code()),
            "practitioner": F.concat(_code(), F.lit("-p")),
            "practitioner_name": F.concat(F.lit("Name "), _code()),
            "start": _start(),
            "end": _end(),
        },
    )
    return flatten(
        docs,
        (
            value("id", "string", "id"),
            value("role_number", "string", "identifier[0].value"),
            value("role", "string", "code[0].coding[0].display"),
            value("specialty", "string", "specialty[0].text"),
            value("organization", "string", "organization.reference"),
            value("endpoint", "string", "endpoint[0].reference"),
            value("start_text", "string", "period.start"),
            value("practitioner", "string", "practitioner.reference"),
            value("narrative", "string", "text.div"),
        ),
        body=BODY,
    )


def copies(spark, sf_dir, name: str, key: str):
    """Numbered copies of the practices, one for every row of the named table by its place, with that row.

    The share is rounded up, so the last practices may have fewer copies, and no row is left out. Both sides
    grow with the table. Spark takes the copies for as small as the practices they come from, so the hint
    keeps them from being collected and broadcast.
    """
    named = with_ordinal(d.table(spark, sf_dir, name), [key], "place")
    practices = d.table(spark, sf_dir, "supplier").agg(F.count("*")).scalar()
    total = d.table(spark, sf_dir, name).agg(F.count("*")).scalar()
    rows = build.numbered_copies(d.register(spark, sf_dir), F.ceil(total / practices))
    return rows.hint("merge").join(named, F.col("counter") == F.col("place"))


def copies_sql(name: str, key: str) -> str:
    return f"""placed as (select *, row_number() over (order by {key}) as place from {name}),
        share as (select (count(*) + s.n - 1) // s.n as each from {name}, (select count(*) as n from supplier) s
          group by s.n),
        copies as (
          select register.*, placed.*, place as counter, (place - 1) % 100 + 1 as number
          from placed, share join register on ordinal = (place - 1) // each + 1)"""


def _from_copies(name: str, key: str, body: str) -> str:
    return with_tables("register", body=f", {copies_sql(name, key)} {body}")


_LANGUAGES = tuple(codes.LANGUAGES)
_MARITAL = tuple(codes.MARITAL_STATUSES)
_RELATIONS = tuple(codes.RELATIONSHIPS)
_PREFIXES = ("Mr.", "Ms.", "Dr.")

def _patient_inputs():
    return {
        # Customers in debt come without a prefix, which leaves their full name null.
        "prefix": F.when(F.col("c_acctbal") >= 0, d.pick(_PREFIXES, F.col("c_custkey"))),
        "family": F.col("c_name"),
        "given": F.concat(F.lit("G"), F.col("c_custkey") % 11),
        "phone": F.concat(F.lit("555-"), F.col("c_custkey")),
        "email": F.concat(F.lower("c_mktsegment"), F.lit("."), F.col("c_custkey"), F.lit("@gmail.com")),
        "gender": d.pick(codes.GENDERS, F.col("c_custkey")),
        "birth_date": F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_custkey") % 20000).cast("int")),
        "marital": d.pick(_MARITAL, F.col("c_custkey")),
        "multiple_birth": F.col("c_custkey") % 3 == 0,
        "relationship": d.pick(_RELATIONS, F.col("c_custkey")),
        "contact_family": F.concat(F.lit("CF"), F.col("c_custkey") % 13),
        "contact_given": F.concat(F.lit("CG"), F.col("c_custkey") % 17),
        "contact_prefix": F.lit("Mr."),
        "contact_phone": F.concat(F.lit("777-"), F.col("c_custkey")),
        "contact_gender": F.lit("other"),
        "start": _start(),
        "end": _end(),
        "language": d.pick(_LANGUAGES, F.col("c_custkey")),
        "preferred": F.col("c_custkey") % 2 == 0,
        "practitioner_number": F.col("c_custkey") % 10 + 1,
    }


def patients(spark, sf_dir, rows=None, **planted):
    rows = copies(spark, sf_dir, "customer", "c_custkey") if rows is None else rows
    return build.build_patient(rows, {**_patient_inputs(), **planted})


@query(
    "flatten_patient",
    _from_copies(
        "customer",
        "c_custkey",
        f"""
        select 'P' || "PracticeCode" || '-' || format('{{:02d}}', number) as id,
          case when c_acctbal >= 0 then {sql_pick(_PREFIXES, "c_custkey")} || ' G' || (c_custkey % 11)
            || ' ' || c_name end as patient_name,
          date '1950-01-01' + cast(c_custkey % 20000 as integer) as date_of_birth,
          '555-' || c_custkey as phone_number,
          lower(c_mktsegment) || '.' || c_custkey || '@gmail.com' as email,
          {sql_pick(tuple(codes.MARITAL_STATUSES.values()), "c_custkey")} as marital_status,
          c_custkey % 3 = 0 as multiple_birth, "GPPracticeName" as organization_name,
          cast("PracticeCode" as varchar) as gp_code,
          "PracticeCode" || '-practitioner' || (c_custkey % 10 + 1) as general_practitioner,
          'CG' || (c_custkey % 17) || ' CF' || (c_custkey % 13) as emergency_contact_name,
          {sql_pick(tuple(codes.RELATIONSHIPS.values()), "c_custkey")} as emergency_contact_relationship,
          '777-' || c_custkey as emergency_contact_number,
          {_full_address_sql(_TWO_LINES)} as emergency_contact_address,
          {sql_pick(tuple(codes.LANGUAGES.values()), "c_custkey")} as communication_language,
          'Patient' as raw_type
        from copies""",
    ),
)
def flatten_patient(spark, sf_dir):
    return _flat(patients(spark, sf_dir), specs.PATIENT)


_TYPES = tuple(codes.PARTICIPATION_TYPES) + tuple(codes.PARTICIPANT_TYPES)
_TYPE_NAMES = tuple(codes.PARTICIPATION_TYPES.values()) + tuple(codes.PARTICIPANT_TYPES.values())

def _appointment_inputs():
    return {
        "practitioner_number": F.col("o_custkey") % 10 + 1,
        "patient_type": d.pick(_TYPES, F.col("o_orderkey")),
        "practitioner_type": d.pick(_TYPES, F.col("o_custkey")),
        "participant_status": d.pick(codes.PARTICIPANT_STATUSES, F.col("o_orderkey")),
        "status": d.pick(codes.APPOINTMENT_STATUSES, F.col("o_orderkey")),
        "description": F.concat(F.lit("About "), F.col("o_orderpriority")),
        "start": F.col("o_orderdate") + F.expr("INTERVAL '9' HOUR"),
        "end": F.col("o_orderdate") + F.expr("INTERVAL '9:30' HOUR TO MINUTE"),
        "created": F.col("o_orderdate"),
    }


def appointments(spark, sf_dir, rows=None, **planted):
    rows = copies(spark, sf_dir, "orders", "o_orderkey") if rows is None else rows
    return build.build_appointment(rows, {**_appointment_inputs(), **planted})


_PATIENT_KEY_SQL = "'P' || \"PracticeCode\" || '-' || format('{:02d}', number)"
_PRACTITIONER_KEY_SQL = "\"PracticeCode\" || '-practitioner' || (o_custkey % 10 + 1)"


@query(
    "flatten_appointment",
    _from_copies(
        "orders",
        "o_orderkey",
        f"""
        select 'A' || format('{{:05d}}', counter) as id, 'Appointment' as "resourceType",
          o_orderdate as created, o_orderdate + interval '540 minutes' as start_time,
          o_orderdate + interval '570 minutes' as end_time, 'About ' || o_orderpriority as description,
          cast(30 as integer) as "minutesDuration",
          {sql_pick(codes.APPOINTMENT_STATUSES, "o_orderkey")} as status,
          {_PATIENT_KEY_SQL} as patient_id, {_PRACTITIONER_KEY_SQL} as practitioner_id,
          {sql_pick(_TYPE_NAMES, "o_orderkey")} as "Pract_type",
          {sql_pick(_TYPE_NAMES, "o_custkey")} as callback_type,
          'Practitioner ' || {_PRACTITIONER_KEY_SQL} as second_actor, 'Appointment' as raw_type
        from copies""",
    ),
)
def flatten_appointment(spark, sf_dir):
    rows = _flat(appointments(spark, sf_dir), specs.APPOINTMENT)
    actor = F.variant_get("participant", "$[1].actor.display", "string")
    return rows.withColumn("second_actor", actor).drop("participant")


_CATEGORIES = tuple(codes.CONDITION_CATEGORIES)
_SEVERITIES = tuple(codes.SEVERITIES)
_CONDITIONS = tuple(codes.CONDITION_CODES)

def _condition_inputs():
    return {
        "clinical": d.pick(codes.CLINICAL_STATUSES, F.col("event_id")),
        "verification": d.pick(codes.VERIFICATION_STATUSES, F.col("event_id")),
        "category": d.pick(_CATEGORIES, F.col("event_id")),
        "severity": d.pick(_SEVERITIES, F.col("event_id")),
        "condition": d.pick(_CONDITIONS, F.col("event_id")),
        "onset": F.to_date("ts"),
        "recorded": F.col("ts"),
        "abated": F.date_add(F.to_date("ts"), 30),
    }


def conditions(spark, sf_dir, rows=None, **planted):
    rows = copies(spark, sf_dir, "events", "event_id") if rows is None else rows
    return build.build_condition(rows, {**_condition_inputs(), **planted})


@query(
    "flatten_condition",
    _from_copies(
        "events",
        "event_id",
        f"""
        select 'C' || format('{{:05d}}', counter) as id, 'Condition' as "resourceType",
          ts as recorded_date, cast(cast(ts as date) as timestamp) as onset_date,
          {sql_pick(codes.CLINICAL_STATUSES, "event_id")} as clinical_status,
          {sql_pick(codes.VERIFICATION_STATUSES, "event_id")} as verification_status,
          {sql_pick(_CONDITIONS, "event_id")} as condition_code,
          {sql_pick(tuple(codes.CONDITION_CODES.values()), "event_id")} as condition_display,
          {sql_pick(_SEVERITIES, "event_id")} as severity_code,
          {sql_pick(tuple(codes.SEVERITIES.values()), "event_id")} as severity_display,
          {sql_pick(_CATEGORIES, "event_id")} as category, {_PATIENT_KEY_SQL} as patient_id,
          cast(null as timestamp) as "meta_lastUpdated",
          case when {sql_pick(codes.CLINICAL_STATUSES, "event_id")} in ('inactive', 'resolved', 'remission')
            then strftime(cast(ts as date) + 30, '%Y-%m-%d') end as abated,
          'Condition' as raw_type
        from copies""",
    ),
)
def flatten_condition(spark, sf_dir):
    docs = conditions(spark, sf_dir)
    rows = flatten(docs, specs.CONDITION, body=BODY)
    rows = rows.withColumns(
        {
            "abated": F.variant_get("raw_data", "$.abatementDateTime", "string"),
            "raw_type": F.variant_get("raw_data", "$.resourceType", "string"),
            **{
                n: F.col(n).cast("timestamp_ntz")
                for n in ("recorded_date", "onset_date", "meta_lastUpdated")
            },
        }
    )
    return rows.drop("raw_data")


# Faults planted for the checks: a gender and a status outside their lists, and periods that end
# before they start.
_BAD_GENDERS = codes.GENDERS + ("n/a",)
_BAD_STATUSES = codes.APPOINTMENT_STATUSES + ("lost",)
_BAD_PARTICIPANT = codes.PARTICIPANT_STATUSES + ("perhaps",)


def _faultypatients(spark, sf_dir):
    base = F.lit("2024-06-30").cast("date")
    return patients(
        spark,
        sf_dir,
        gender=d.pick(_BAD_GENDERS, F.col("c_custkey")),
        start=F.date_add(base, (F.col("c_custkey") % 300).cast("int")),
        end=F.date_add(base, ((F.col("c_custkey") * 7) % 300).cast("int")),
        birth_date=F.when(F.col("c_acctbal") >= 0, _patient_inputs()["birth_date"]),
    )


_GENDER_FAULT = f"{sql_pick(_BAD_GENDERS, 'c_custkey')} = 'n/a'"
_PERIOD_FAULT = "c_custkey % 300 > (c_custkey * 7) % 300"


@query(
    "validate_resources",
    _from_copies(
        "customer",
        "c_custkey",
        f"""
        select {_PATIENT_KEY_SQL} as id, '555-' || c_custkey as phone from copies
        where not ({_GENDER_FAULT} or {_PERIOD_FAULT})""",
    ),
)
def validate_resources(spark, sf_dir):
    valid, _ = validate(_faultypatients(spark, sf_dir), RULES["Patient"], SKIP)
    phone = F.get_json_object("resource_json", "$.telecom[0].value")
    return valid.select("id", phone.alias("phone"))


@query(
    "rejected_resources",
    _from_copies(
        "customer",
        "c_custkey",
        f"""
        select {_PATIENT_KEY_SQL} as id, '555-' || c_custkey as phone,
          array_to_string(list_filter([
            case when {_GENDER_FAULT} then 'gender code' end,
            case when {_PERIOD_FAULT} then 'contact[0].period.start before contact[0].period.end' end],
            lambda x: x is not null), '; ') as errors
        from copies where {_GENDER_FAULT} or {_PERIOD_FAULT}""",
    ),
)
def rejected_resources(spark, sf_dir):
    _, rejected = validate(_faultypatients(spark, sf_dir), RULES["Patient"], SKIP)
    phone = F.get_json_object("resource_json", "$.telecom[0].value")
    return rejected.select(
        "id", phone.alias("phone"), F.array_join("errors", "; ").alias("errors")
    )


@query(
    "reject_reasons",
    _from_copies(
        "orders",
        "o_orderkey",
        f"""
        , faults as (
          select {sql_pick(_BAD_STATUSES, "o_orderkey")} = 'lost' as lost,
            {sql_pick(_BAD_PARTICIPANT, "o_orderkey")} = 'perhaps' as perhaps from copies)
        select * from (
          select 'status code' as error, count(*) filter (where lost) as document_count from faults
          union all
          select 'participant[0].status code', count(*) filter (where perhaps) from faults
          union all
          select 'participant[1].status code', count(*) filter (where perhaps) from faults)
        where document_count > 0""",
    ),
)
def reject_reasons(spark, sf_dir):
    docs = appointments(
        spark,
        sf_dir,
        status=d.pick(_BAD_STATUSES, F.col("o_orderkey")),
        participant_status=d.pick(_BAD_PARTICIPANT, F.col("o_orderkey")),
    )
    errors = with_errors(docs, RULES["Appointment"]).select(F.explode("errors").alias("error"))
    return errors.groupBy("error").agg(F.count("*").alias("document_count"))
