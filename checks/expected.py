"""What the fourteen tables must hold, as SQL for the checking engine.

The claims tables are computed from the raw claim records, the clinical tables
straight from the events, without any JSON.
"""

from __future__ import annotations

from carebasin import schemas
from checks import standins

AS_OF = "DATE '2024-06-30'"


def typed(entity: str) -> str:
    """Typed and renamed columns of a raw entity."""
    forms = {
        "string": "{}",
        "date": "CAST(try_strptime({}, '%Y%m%d') AS DATE)",
        "int": "CAST(trunc(TRY_CAST({} AS DOUBLE)) AS INTEGER)",
        "flag": "CAST(TRY_CAST({} AS INTEGER) AS BOOLEAN)",
        "amount": "TRY_CAST({} AS DECIMAL(12,2))",
        "price": "CAST(TRY_CAST({} AS DECIMAL(10,2)) AS DECIMAL(12,2))",
    }
    cells = [f"{forms[c.kind].format(c.raw)} AS {c.clean}" for c in schemas.RAW_ENTITIES[entity]]
    return f"SELECT {', '.join(cells)} FROM ({standins.raw_sql(entity)}) r"


def columns(entity: str) -> list[str]:
    return [c.clean for c in schemas.RAW_ENTITIES[entity]]


def first_by(key: str, source: str, names: list[str]) -> str:
    order = ", ".join(f"{n} NULLS FIRST" for n in names if n != key)
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {key} ORDER BY {order}) AS rn FROM {source}) z WHERE rn = 1"
    )


def age_of(birth: str) -> str:
    return f"CAST(trunc(date_diff('day', {birth}, {AS_OF}) / CAST(365.25 AS DOUBLE)) AS INTEGER)"


AGE_GROUP = """CASE WHEN age < 18 THEN '0-17' WHEN age < 35 THEN '18-34'
    WHEN age < 50 THEN '35-49' WHEN age < 65 THEN '50-64' ELSE '65+' END"""

_FLAGS = [c for c in columns("beneficiary_summary") if c.startswith("chronic_")]

DIM_PATIENT = f"""
WITH typed AS ({typed('beneficiary_summary')}),
one AS ({first_by('patient_id', 'typed', columns('beneficiary_summary'))}),
known AS (
  SELECT * REPLACE ({', '.join(f'coalesce({c}, false) AS {c}' for c in _FLAGS)}),
    CASE gender_code WHEN 1 THEN 'Male' WHEN 2 THEN 'Female' ELSE 'Unknown' END AS gender_label,
    CASE race_code WHEN 1 THEN 'White' WHEN 2 THEN 'Black' WHEN 3 THEN 'Other' WHEN 4 THEN 'Asian'
      WHEN 5 THEN 'Hispanic' WHEN 6 THEN 'North American Native' ELSE 'Unknown' END AS race_label,
    death_date IS NOT NULL AS is_deceased,
    birth_date IS NULL AS missing_birth_date_flag,
    {age_of('birth_date')} AS age
  FROM one),
scored AS (SELECT *, {AGE_GROUP} AS age_group,
    {' + '.join(f'CAST({c} AS INTEGER)' for c in _FLAGS)} AS risk_score FROM known)
SELECT *, CASE WHEN risk_score <= 2 THEN 'Low' WHEN risk_score <= 5 THEN 'Medium' ELSE 'High' END
    AS risk_tier, risk_score >= 3 AS is_chronic, sha256(patient_id) AS patient_key
FROM scored
"""

DIM_PROVIDER = f"""
WITH typed AS ({typed('providers')}),
one AS ({first_by('provider_id', 'typed', columns('providers'))})
SELECT *, sha256(provider_id) AS provider_key FROM one
"""


def _fact(source: str, names: list[str], key: str, surrogate: str, day: str, amount: str,
          filled: list[str], extra: str = "") -> str:
    missing = (
        ", payment_amount IS NULL AS is_payment_missing" if "payment_amount" in names else ""
    )
    fill = ", ".join(f"CAST(coalesce({c}, 0) AS DECIMAL(12,2)) AS {c}" for c in filled)
    return f"""
WITH typed AS ({source}),
filled AS (SELECT * REPLACE ({fill}){missing} FROM typed),
one AS ({first_by(key, 'filled', names)}),
cut AS (SELECT quantile_disc({amount}, 0.99) AS threshold FROM one)
SELECT one.* REPLACE (CAST(greatest({amount}, 0) AS DECIMAL(12,2)) AS {amount}),
  {amount} < 0 AS is_negative_{amount},
  greatest({amount}, 0) > (SELECT threshold FROM cut) AS is_high_cost,
  CAST(year({day}) AS INTEGER) AS year, CAST(quarter({day}) AS INTEGER) AS quarter,
  CAST(month({day}) AS INTEGER) AS month, CAST(weekofyear({day}) AS INTEGER) AS week_of_year,
  CAST(strftime({day}, '%Y%m%d') AS INTEGER) AS date_key,
  sha256({key}) AS {surrogate}{extra}
FROM one
"""


_IN, _OUT = columns("inpatient_claims"), columns("outpatient_claims")

FACT_CLAIMS = _fact(
    f"SELECT *, 'inpatient' AS claim_type FROM ({typed('inpatient_claims')}) i UNION ALL BY NAME "
    f"SELECT *, 'outpatient' AS claim_type FROM ({typed('outpatient_claims')}) o",
    _IN + ["claim_type"] + [c for c in _OUT if c not in _IN],
    "claim_id", "claim_key", "admit_date", "payment_amount",
    ["payment_amount", "deductible_amount", "coinsurance_amount", "per_diem_amount",
     "submitted_amount", "allowed_amount"],
    ", CAST(date_diff('day', admit_date, discharge_date) AS INTEGER) AS length_of_stay",
)
FACT_CARRIER = _fact(
    f"""SELECT *, CASE claim_status_code WHEN 'A' THEN 'Assigned' WHEN 'N' THEN 'Non-assigned'
        ELSE 'Unknown' END AS claim_status FROM ({typed('carrier_claims')}) c""",
    columns("carrier_claims"),
    "claim_id", "claim_key", "service_date", "payment_amount",
    ["payment_amount", "deductible_amount", "coinsurance_amount"],
)
FACT_PRESCRIPTIONS = _fact(
    typed("prescription_drug_events"), columns("prescription_drug_events"),
    "prescription_id", "prescription_key", "service_date", "total_cost",
    ["patient_pay_amount", "total_cost", "plan_pay_amount"],
)

# -- clinical -------------------------------------------------------------------

_UTC = "date_trunc('second', ts) - CASE WHEN event_id % 5 = 0 THEN INTERVAL 330 MINUTE ELSE INTERVAL 0 MINUTE END"
_DAY = "date_trunc('day', ts)"
_PATIENT_REF = "'Patient/p' || user_id"
_ENCOUNTER_REF = "'Encounter/e' || event_id"


def _item(pairs: list[tuple[str, ...]], index: str, part: int) -> str:
    items = ", ".join(f"'{p[part]}'" for p in pairs)
    return f"([{items}])[(({index}) % {len(pairs)} + 1)::INT]"


def _case(code: str, rows: list[tuple], part: int) -> str:
    return f"CASE {code} " + " ".join(f"WHEN '{r[0]}' THEN '{r[part]}'" for r in rows) + " END"


def _in(code: str, values) -> str:
    return f"{code} IN ({', '.join(repr(v) for v in values)})"


FLAT_PATIENT = """
SELECT 'p' || user_id AS patient_id, 'MRN' || user_id AS mrn,
  'Family ' || user_id % 40 AS family_name, 'Given' AS given_name,
  CASE user_id % 4 WHEN 0 THEN 'male' WHEN 1 THEN 'female' WHEN 2 THEN 'other' END AS gender,
  CASE WHEN user_id % 17 = 2 THEN '1990-02-30'
    ELSE strftime(DATE '1935-01-01' + (user_id * 131 % 30000)::INT, '%Y-%m-%d') END AS birth_date,
  user_id || ' Main St' AS address_line, 'City ' || user_id % 9 AS city, 'ST' AS state,
  lpad(user_id::VARCHAR, 5, '0') AS postal_code, 'Race ' || user_id % 5 AS race,
  CASE WHEN user_id % 9 <> 0 THEN 'Group ' || user_id % 2 END AS ethnicity
FROM events
"""
DIM_PATIENT_EHR = f"""
WITH aged AS (
  SELECT *, CAST(try_strptime(birth_date, '%Y-%m-%d') AS DATE) AS birth_date_parsed,
    {age_of("CAST(try_strptime(birth_date, '%Y-%m-%d') AS DATE)")} AS age
  FROM ({FLAT_PATIENT}) f)
SELECT * REPLACE (sha256(family_name) AS family_name, sha256(given_name) AS given_name,
    sha256(birth_date) AS birth_date, sha256(address_line) AS address_line, sha256(mrn) AS mrn),
  {AGE_GROUP} AS age_group, sha256(patient_id) AS patient_key
FROM aged
"""

FLAT_PRACTITIONER = """
SELECT 'r' || event_id % 500 AS practitioner_id, (1000000000 + event_id % 300)::VARCHAR AS npi,
  'Doc ' || event_id % 500 AS family_name, 'Ann' AS given_name,
  lpad((event_id % 300 % 22)::VARCHAR, 2, '0') AS specialty_code
FROM events
"""
FLAT_PRACTITIONER_PROFILE = f"""
SELECT practitioner_id AS provider_id, family_name AS last_name, given_name AS first_name,
  'Dr.' AS prefix, 'female' AS gender, npi, specialty_code
FROM ({FLAT_PRACTITIONER}) f
"""
DIM_PROVIDER_EHR = f"""
SELECT * EXCLUDE (rn), sha256(practitioner_id) AS provider_key FROM (
  SELECT *, row_number() OVER (PARTITION BY npi
    ORDER BY practitioner_id, family_name, given_name, specialty_code) AS rn
  FROM ({FLAT_PRACTITIONER}) f) z
WHERE rn = 1
"""

_MOMENT = "strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN event_id % 5 = 0 THEN '+05:30' ELSE 'Z' END"
_END = "ts + to_hours((event_id % 50)::INT) + INTERVAL 15 MINUTE"


def encounters(start: str, end: str) -> str:
    return f"""
SELECT 'e' || event_id AS encounter_id, 'finished' AS status,
  CASE event_type WHEN 'error' THEN 'EMER' WHEN 'purchase' THEN 'IMP' WHEN 'click' THEN 'AMB'
    WHEN 'view' THEN 'AMB' END AS encounter_class,
  {_PATIENT_REF} AS patient_ref, {start} AS period_start, {end} AS period_end,
  {_item(standins.CONDITIONS, 'event_id', 0)} AS reason_icd10,
  CASE WHEN event_id % 23 <> 0 THEN value END AS total_cost
FROM events
"""


FLAT_ENCOUNTER = encounters(_MOMENT, _MOMENT.replace("(ts,", f"({_END},"))
FACT_ENCOUNTERS = f"""
SELECT *, (floor(epoch(period_end)) - floor(epoch(period_start))) / 3600 AS encounter_duration_hours,
  encounter_class = 'EMER' AS is_emergency, CAST(year(period_start) AS INTEGER) AS visit_year,
  CAST(month(period_start) AS INTEGER) AS visit_month, sha256(encounter_id) AS encounter_key
FROM ({encounters(_UTC, _UTC.replace("'second', ts", f"'second', {_END}"))}) f
"""


def conditions(onset: str, abatement: str) -> str:
    index = "event_id + j * 5"
    return f"""
SELECT 'c' || j || '-' || event_id AS condition_id,
  CASE WHEN event_id % 3 = j THEN 'resolved' ELSE 'active' END AS clinical_status,
  {_item(standins.CONDITIONS, index, 0)} AS icd10_code,
  {_item(standins.CONDITIONS, index, 1)} AS icd10_display,
  CASE WHEN event_id % 4 <> j THEN 'S' || ({index}) END AS snomed_code,
  CASE WHEN event_id % 4 <> j THEN 'Snomed' END AS snomed_display,
  {_PATIENT_REF} AS patient_ref, {_ENCOUNTER_REF} AS encounter_ref,
  {onset} AS onset_datetime, CASE WHEN event_id % 3 = j THEN {abatement} END AS abatement_datetime
FROM events, (VALUES (0), (1)) t(j)
"""


FLAT_CONDITION = conditions("strftime(ts, '%Y-%m-%d')", _MOMENT)


def condition_facts(description: str, category: str) -> str:
    return f"""
SELECT *, {description} AS icd10_description, {category} AS icd10_category,
  abatement_datetime IS NOT NULL AS is_resolved,
  {_in('icd10_code', schemas.CHRONIC_CONDITIONS)} AS is_chronic,
  sha256(condition_id) AS condition_key
FROM ({conditions(_DAY, _UTC)}) f
"""


FACT_CONDITIONS = condition_facts(
    _case("icd10_code", schemas.ICD10_CODES, 1), _case("icd10_code", schemas.ICD10_CODES, 2)
)


def observations(moment: str) -> str:
    index = "event_id + j * 3"
    return f"""
SELECT 'o' || j || '-' || event_id AS observation_id, 'final' AS status,
  CASE j WHEN 2 THEN 'vital-signs' ELSE 'laboratory' END AS category,
  {_item(standins.TESTS, index, 0)} AS loinc_code,
  CASE WHEN event_id % 10 <> j THEN {_item(standins.TESTS, index, 1)} END AS loinc_display,
  {_PATIENT_REF} AS patient_ref, {_ENCOUNTER_REF} AS encounter_ref,
  {moment} AS effective_datetime, value + j AS value,
  CASE WHEN event_id % 6 <> j THEN 'mg/dL' END AS unit,
  1.5::DOUBLE AS ref_low, 99::DOUBLE AS ref_high,
  CASE event_type WHEN 'signup' THEN NULL WHEN 'error' THEN 'H' WHEN 'view' THEN 'L' ELSE 'N' END
    AS interpretation_code
FROM events, (VALUES (0), (1), (2)) t(j)
"""


FLAT_OBSERVATION = observations(_MOMENT)
FACT_OBSERVATIONS = f"""
SELECT *, coalesce(interpretation_code IN ('H', 'L'), false) AS is_abnormal,
  sha256(observation_id) AS observation_key
FROM ({observations(_UTC)}) f
"""


def medications(day: str) -> str:
    index = "event_id + j * 7"
    return f"""
SELECT 'm' || j || '-' || event_id AS medication_request_id,
  CASE WHEN event_id % 2 = 0 THEN 'active' ELSE 'completed' END AS status,
  {_item(standins.DRUGS, index, 0)} AS rxnorm_code,
  CASE WHEN event_id % 13 <> j THEN {_item(standins.DRUGS, index, 1)} END AS drug_name,
  {_PATIENT_REF} AS patient_ref, {_ENCOUNTER_REF} AS encounter_ref,
  'Practitioner/r' || event_id % 500 AS provider_ref, {day} AS authored_on,
  'Take daily' AS dosage_text, (event_id % 4 + j)::DOUBLE / 2 AS dose_value, 'tablet' AS dose_unit
FROM events, (VALUES (0), (1)) t(j)
"""


FLAT_MEDICATION = medications("strftime(ts, '%Y-%m-%d')")
FACT_MEDICATIONS = f"""
SELECT *, {_case('rxnorm_code', schemas.RXNORM_CODES, 1)} AS drug_name_enriched,
  {_case('rxnorm_code', schemas.RXNORM_CODES, 2)} AS drug_class,
  regexp_matches(lower(drug_name), '{"|".join(schemas.CHRONIC_MEDICATIONS)}') AS is_chronic_med,
  sha256(medication_request_id) AS medication_key
FROM ({medications(_DAY)}) f
"""


def procedures(moment: str) -> str:
    return f"""
SELECT 't' || event_id AS procedure_id,
  CASE WHEN event_id % 8 = 0 THEN 'stopped' ELSE 'completed' END AS status,
  '99' || lpad((event_id % 50)::VARCHAR, 3, '0') AS cpt_code, 'Procedure' AS cpt_display,
  {_PATIENT_REF} AS patient_ref, {_ENCOUNTER_REF} AS encounter_ref,
  {moment} AS performed_datetime, value AS procedure_cost
FROM events
"""


FLAT_PROCEDURE = procedures(_MOMENT)
FACT_PROCEDURES = f"SELECT *, sha256(procedure_id) AS procedure_key FROM ({procedures(_UTC)}) f"

FLAT_ALLERGY = f"""
SELECT 'a' || event_id AS allergy_id, 'active' AS clinical_status,
  CASE event_id % 3 WHEN 0 THEN 'Peanut' ELSE 'Pollen' END AS substance,
  {_PATIENT_REF} AS patient_ref,
  CASE WHEN event_id % 10 > 0 THEN 'Rash' END AS reaction,
  CASE WHEN event_id % 10 > 0 THEN
    CASE event_id % 3 WHEN 0 THEN 'mild' WHEN 1 THEN 'moderate' ELSE 'severe' END END AS severity
FROM events
"""
FACT_ALLERGIES = f"SELECT *, sha256(allergy_id) AS allergy_key FROM ({FLAT_ALLERGY}) f"


def immunizations(day: str) -> str:
    return f"""
SELECT 'i' || j || '-' || event_id AS immunization_id,
  CASE WHEN event_id % 19 = j THEN 'not-done' ELSE 'completed' END AS status,
  (event_id % 9 + j * 100)::VARCHAR AS cvx_code, 'Vaccine' AS vaccine_name,
  {_PATIENT_REF} AS patient_ref, {day} AS occurrence_datetime,
  'LOT' || event_id % 1000 AS lot_number
FROM events, (VALUES (0), (1)) t(j)
"""


FLAT_IMMUNIZATION = immunizations("strftime(ts, '%Y-%m-%d')")
FACT_IMMUNIZATIONS = (
    f"SELECT *, sha256(immunization_id) AS immunization_key FROM ({immunizations(_DAY)}) f"
)

TABLE_SQL = {
    "dim_patient_cms": DIM_PATIENT,
    "dim_provider_cms": DIM_PROVIDER,
    "fact_claims": FACT_CLAIMS,
    "fact_carrier_claims": FACT_CARRIER,
    "fact_prescriptions": FACT_PRESCRIPTIONS,
    "dim_patient_ehr": DIM_PATIENT_EHR,
    "dim_provider_ehr": DIM_PROVIDER_EHR,
    "fact_encounters": FACT_ENCOUNTERS,
    "fact_conditions": FACT_CONDITIONS,
    "fact_observations": FACT_OBSERVATIONS,
    "fact_medications": FACT_MEDICATIONS,
    "fact_procedures": FACT_PROCEDURES,
    "fact_allergies": FACT_ALLERGIES,
    "fact_immunizations": FACT_IMMUNIZATIONS,
}


def plain(sql: str, date: str = "", moment: str = "", flag: str = "", amount: str = "") -> str:
    """Dates and times as text, flags as 0/1, decimals as doubles."""
    forms = (
        (date, "strftime({0}, '%Y-%m-%d') AS {0}"),
        (moment, "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}"),
        (flag, "CAST({0} AS INTEGER) AS {0}"),
        (amount, "CAST({0} AS DOUBLE) AS {0}"),
    )
    cells = [form.format(name) for names, form in forms for name in names.split()]
    return f"SELECT * REPLACE ({', '.join(cells)}) FROM ({sql}) p" if cells else sql


KINDS = {
    "dim_patient_cms": {
        "date": "birth_date death_date",
        "flag": " ".join(_FLAGS) + " is_deceased missing_birth_date_flag is_chronic",
    },
    "fact_claims": {
        "date": "admit_date discharge_date",
        "flag": "is_payment_missing is_negative_payment_amount is_high_cost",
        "amount": "payment_amount deductible_amount coinsurance_amount per_diem_amount"
        " submitted_amount allowed_amount",
    },
    "fact_carrier_claims": {
        "date": "service_date service_end_date",
        "flag": "is_payment_missing is_negative_payment_amount is_high_cost",
        "amount": "payment_amount deductible_amount coinsurance_amount",
    },
    "fact_prescriptions": {
        "date": "service_date",
        "flag": "is_negative_total_cost is_high_cost",
        "amount": "patient_pay_amount total_cost plan_pay_amount",
    },
    "dim_patient_ehr": {"date": "birth_date_parsed"},
    "fact_encounters": {"moment": "period_start period_end", "flag": "is_emergency"},
    "fact_conditions": {
        "moment": "onset_datetime abatement_datetime",
        "flag": "is_resolved is_chronic",
    },
    "fact_observations": {"moment": "effective_datetime", "flag": "is_abnormal"},
    "fact_medications": {"moment": "authored_on", "flag": "is_chronic_med"},
    "fact_procedures": {"moment": "performed_datetime"},
    "fact_immunizations": {"moment": "occurrence_datetime"},
}


def table_sql(name: str) -> str:
    return plain(TABLE_SQL[name], **KINDS.get(name, {}))
