import hashlib
import json

import pytest
from pyspark.sql import functions as F

from carebasin import schemas
from carebasin.operators import clinical as ops
from carebasin.operators.documents import explode_entries, flatten, json_schema, of_type
from carebasin.plans import clinical
from carebasin.sources.readers import inline_table, read_bundles
from carebasin.sources.writers import stage

PATIENT = {
    "resourceType": "Patient", "id": "p1", "identifier": [{"value": "MRN1"}],
    "name": [{"family": "Doe", "given": ["Jane", "Q"]}], "gender": "female",
    "birthDate": "1950-01-01",
    "address": [{"line": ["1 Main St"], "city": "Town", "state": "NY", "postalCode": "00501"}],
    "extension": [{"url": "race", "valueString": "White"}],
}
ORGANIZATION = {"resourceType": "Organization", "id": "g1", "name": "General Hospital"}
PRACTITIONER = {
    "resourceType": "Practitioner", "id": "r1", "identifier": [{"value": "1000000001"}],
    "name": [{"family": "Who", "given": ["Ann"], "prefix": ["Dr."]}], "gender": "female",
    "qualification": [{"code": {"coding": [{"system": "s", "code": "08"}]}}],
}
ENCOUNTER = {
    "resourceType": "Encounter", "id": "e1", "status": "finished", "class": {"code": "EMER"},
    "subject": {"reference": "Patient/p1"},
    "period": {"start": "2024-06-15T10:30:00+05:30", "end": "2024-06-15T08:00:00Z"},
    "reasonCode": [{"coding": [{"code": "I10"}]}],
    "extension": [{"url": "totalCost", "valueMoney": {"value": 120, "currency": "USD"}}],
}
CONDITIONS = [
    {"resourceType": "Condition", "id": "c1", "clinicalStatus": {"coding": [{"code": "active"}]},
     "code": {"coding": [{"code": "I10", "display": "Hypertension"}]},
     "subject": {"reference": "Patient/p1"}, "encounter": {"reference": "Encounter/e1"},
     "onsetDateTime": "2024-01-02"},
    {"resourceType": "Condition", "id": "c2", "clinicalStatus": {"coding": [{"code": "resolved"}]},
     "code": {"coding": [{"code": "Z99", "display": "Other"}, {"code": "77", "display": "SN"}]},
     "onsetDateTime": "2024-01-02", "abatementDateTime": "2024-03-01"},
    {"resourceType": "Condition", "id": "c3"},
]
OBSERVATIONS = [
    {"resourceType": "Observation", "id": f"o{i}", "status": "final",
     "category": [{"coding": [{"code": "laboratory"}]}],
     "code": {"coding": [{"code": "2339-0", "display": "Glucose"}]},
     "effectiveDateTime": "2024-06-15T10:00:00Z", "valueQuantity": {"value": 5 + i, "unit": "mg"},
     "referenceRange": [{"low": {"value": 1}, "high": {"value": 9.5}}],
     **({"interpretation": [{"coding": [{"code": code}]}]} if code else {})}
    for i, code in enumerate(["H", "L", "N", None])
]
MEDICATIONS = [
    {"resourceType": "MedicationRequest", "id": f"m{i}", "status": "active",
     "medicationCodeableConcept": {"coding": [{"code": code, "display": name}]},
     "requester": {"reference": "Practitioner/r1"}, "authoredOn": "2024-02-03",
     "dosageInstruction": [{"text": "daily", "doseAndRate": [{"doseQuantity": {"value": 1.5, "unit": "tab"}}]}]}
    for i, (code, name) in enumerate([("860975", "METFORMIN 500"), ("1", "Aspirin"), ("2", None)])
]
OTHERS = [
    {"resourceType": "Procedure", "id": "t1", "status": "completed",
     "code": {"coding": [{"code": "99213", "display": "Visit"}]},
     "performedDateTime": "2024-06-15T10:00:00Z", "extension": [{"valueMoney": {"value": 9.25}}]},
    {"resourceType": "AllergyIntolerance", "id": "a1", "clinicalStatus": {"coding": [{"code": "active"}]},
     "category": ["food"], "code": {"coding": [{"display": "Peanut"}]},
     "patient": {"reference": "Patient/p1"},
     "reaction": [{"manifestation": [{"coding": [{"display": "Rash"}]}], "severity": "mild"}]},
    {"resourceType": "Immunization", "id": "i1", "status": "completed",
     "vaccineCode": {"coding": [{"code": "140", "display": "Flu"}]},
     "patient": {"reference": "Patient/p1"}, "occurrenceDateTime": "2023-10-01", "lotNumber": "L1"},
]
FIRST = [PATIENT, ORGANIZATION, PRACTITIONER, ENCOUNTER, *CONDITIONS]
SECOND = [{**PRACTITIONER, "id": "r2"}, *OBSERVATIONS, *MEDICATIONS, *OTHERS]


def write_bundles(folder, *entries):
    for number, resources in enumerate(entries):
        place = folder / f"day={number}"
        place.mkdir(parents=True)
        bundle = {
            "resourceType": "Bundle", "id": f"b{number}", "type": "collection",
            "timestamp": "2024-06-15T00:00:00Z", "entry": [{"resource": r} for r in resources],
        }
        (place / f"bundle{number}.json").write_text(json.dumps(bundle, indent=2))
    return str(folder)


@pytest.fixture(scope="module")
def resources(spark, tmp_path_factory):
    folder = write_bundles(tmp_path_factory.mktemp("bundles"), FIRST, SECOND, [])
    return explode_entries(read_bundles(spark, folder)).cache()


def rows_by(frame, key):
    return {r[key]: r for r in frame.collect()}


def test_one_row_per_entry(resources):
    assert resources.count() == len(FIRST) + len(SECOND)
    assert resources.where("bundle_id = 'b0'").count() == len(FIRST)
    assert resources.columns == ["bundle_id", "bundle_timestamp", "resource", "resource_type"]
    assert of_type(resources, "Patient").count() == 1
    assert resources.where("resource_type IS NULL").count() == 0


def test_line_delimited_bundles(spark, tmp_path):
    bundle = {"id": "b", "timestamp": "t", "entry": [{"resource": PATIENT}, {"resource": ENCOUNTER}]}
    (tmp_path / "all.json").write_text("\n".join(json.dumps({**bundle, "id": f"b{i}"}) for i in range(3)))
    exploded = explode_entries(read_bundles(spark, str(tmp_path), one_per_line=True))
    assert exploded.count() == 6


def test_parse_schema_covers_the_paths_only():
    assert json_schema(schemas.ALLERGY).simpleString() == (
        "struct<id:string,clinicalStatus:struct<coding:array<struct<code:string>>>,"
        "code:struct<coding:array<struct<display:string>>>,patient:struct<reference:string>,"
        "reaction:array<struct<manifestation:array<struct<coding:array<struct<display:string>>>>,"
        "severity:string>>>"
    )


def test_the_text_is_parsed_once(resources):
    plan = clinical.flatten_patients(resources)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_patient(resources):
    row = clinical.flatten_patients(resources).first()
    assert (row.patient_id, row.mrn, row.family_name, row.given_name) == ("p1", "MRN1", "Doe", "Jane")
    assert (row.city, row.state, row.postal_code, row.address_line) == ("Town", "NY", "00501", "1 Main St")
    assert (row.race, row.ethnicity) == ("White", None)


def test_patient_table_is_aged_then_masked(resources):
    as_of = F.to_date(F.lit("2024-06-15"))
    row = clinical.build_patients(resources, as_of).first()
    assert (str(row.birth_date_parsed), row.age, row.age_group) == ("1950-01-01", 74, "65+")
    assert all(len(row[c]) == 64 for c in schemas.PERSONAL_COLUMNS)
    assert (row.gender, row.city) == ("female", "Town")


def test_practitioners(resources):
    table = clinical.build_practitioners(resources)
    assert [(r.npi, r.practitioner_id, r.specialty_code) for r in table.collect()] == [
        ("1000000001", "r1", "08")
    ]
    profile = clinical.flatten_practitioner_profiles(resources).first()
    assert (profile.prefix, profile.last_name, profile.gender) == ("Dr.", "Who", "female")


def test_encounter(resources):
    row = clinical.build_encounters(resources).first()
    assert (row.encounter_class, row.is_emergency, row.total_cost) == ("EMER", True, 120.0)
    assert (row.encounter_duration_hours, row.visit_year, row.visit_month) == (3.0, 2024, 6)
    assert row.reason_icd10 == "I10" and len(row.encounter_key) == 64


def test_conditions(resources):
    rows = rows_by(clinical.build_conditions(resources), "condition_id")
    assert (rows["c1"].icd10_category, rows["c1"].is_chronic, rows["c1"].is_resolved) == (
        "Cardiovascular", True, False
    )
    assert (rows["c1"].snomed_code, rows["c2"].snomed_code) == (None, "77")
    assert (rows["c2"].icd10_description, rows["c2"].is_chronic, rows["c2"].is_resolved) == (None, False, True)
    assert rows["c3"].is_chronic is None and rows["c3"].icd10_code is None


def test_conditions_with_a_landed_lookup(spark, resources):
    lookup = inline_table(
        spark, [("Z99", "Dependence", "Other"), ("Z99", "Dependence", "Other")],
        {"code": "string", "description": "string", "category": "string"},
    )
    rows = rows_by(clinical.build_conditions(resources, lookup), "condition_id")
    assert len(rows) == 3
    assert (rows["c2"].icd10_description, rows["c1"].icd10_description) == ("Dependence", None)


def test_observations(resources):
    rows = rows_by(clinical.build_observations(resources), "observation_id")
    assert [rows[f"o{i}"].is_abnormal for i in range(4)] == [True, True, False, False]
    assert (rows["o0"].category, rows["o0"].value, rows["o0"].ref_high) == ("laboratory", 5.0, 9.5)


def test_loinc_enrichment(resources):
    enriched = ops.enrich_loinc(clinical.flatten_observations(resources), "loinc_code")
    assert enriched.first().loinc_display_enriched == "Glucose in Blood"
    assert enriched.first().loinc_category == "laboratory"


def test_medications(resources):
    rows = rows_by(clinical.build_medications(resources), "medication_request_id")
    assert [rows[f"m{i}"].is_chronic_med for i in range(3)] == [True, False, None]
    assert (rows["m0"].drug_class, rows["m1"].drug_class) == ("Antidiabetic", None)
    assert (rows["m0"].dose_value, rows["m0"].dose_unit, rows["m0"].dosage_text) == (1.5, "tab", "daily")


def test_other_resources(resources):
    assert clinical.build_procedures(resources).first().procedure_cost == 9.25
    allergy = clinical.build_allergies(resources).first()
    assert (allergy.substance, allergy.reaction, allergy.severity, allergy.patient_ref) == (
        "Peanut", "Rash", "mild", "Patient/p1"
    )
    shot = clinical.build_immunizations(resources).first()
    assert (shot.cvx_code, shot.lot_number, shot.occurrence_datetime.year) == ("140", "L1", 2023)


def test_small_lookups_are_broadcast(resources):
    plan = clinical.build_conditions(resources)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_broken_text_gives_nulls(spark):
    frame = spark.createDataFrame([("{not json",), (None,)], "resource string")
    rows = flatten(frame, schemas.ALLERGY).collect()
    assert [r.allergy_id for r in rows] == [None, None]


def test_clinical_job(spark, tmp_path):
    landing = write_bundles(tmp_path / "fhir", FIRST, SECOND)
    lake = str(tmp_path / "lake")
    clinical.run(spark, landing, lake)
    clinical.run(spark, landing, lake)
    from carebasin.sources.readers import open_lake

    tables = open_lake(spark, clinical=lake)
    counts = {name: df.count() for name, df in tables.items()}
    assert counts == {
        "dim_patient_ehr": 1, "dim_provider_ehr": 1, "fact_encounters": 1, "fact_conditions": 3,
        "fact_observations": 4, "fact_medications": 3, "fact_procedures": 1, "fact_allergies": 1,
        "fact_immunizations": 1,
    }
    for name, df in tables.items():
        assert df.schema == schemas.WAREHOUSE[name]
    chronic = {r.medication_request_id: r.is_chronic_med for r in tables["fact_medications"].collect()}
    assert chronic == {"m0": True, "m1": False, "m2": None}


def test_staged_resources_are_read_by_several_tasks(spark):
    # some MB that do not compress
    note = lambda k: "".join(hashlib.sha256(f"{k}-{j}".encode()).hexdigest() for j in range(12))
    rows = [("b", "t", '{"resourceType": "Observation", "id": "%d", "note": "%s"}' % (k, note(k)), "Observation") for k in range(8000)]
    rows += [("b", "t", '{"resourceType": "Patient", "id": "1"}', "Patient")]
    frame = spark.createDataFrame(rows, "bundle_id string, bundle_timestamp string, resource string, resource_type string")
    staged = stage(frame, "resources", ["resource_type"], spread=clinical.FILES)
    one_type = staged.where("resource_type = 'Observation'")
    per_task = one_type.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(per_task) >= 2 and max(r["count"] for r in per_task) < 8000
    assert sorted(map(tuple, staged.collect())) == sorted(rows)
