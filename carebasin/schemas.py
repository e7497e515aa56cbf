"""Fixed layouts: raw claim files, clinical documents, clean tables, lookups.

Everything here is a value that the data itself prescribes (column names,
types, paths, codes). Layouts are kept as text tables and turned into Spark
schemas below.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "money": T.DecimalType(12, 2),
}


class RawColumn(NamedTuple):
    raw: str
    clean: str
    kind: str


class Leaf(NamedTuple):
    name: str
    path: tuple[str, ...]
    kind: str


def _cells(text: str) -> list[list[str]]:
    return [line.split() for line in text.strip().splitlines()]


def _layout(text: str) -> tuple[RawColumn, ...]:
    return tuple(RawColumn(*cells) for cells in _cells(text))


def _leaves(text: str) -> tuple[Leaf, ...]:
    return tuple(Leaf(name, tuple(path.split(".")), kind) for name, path, kind in _cells(text))


def _table(text: str) -> T.StructType:
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in _cells(text)])


def raw_schema(layout: tuple[RawColumn, ...]) -> T.StructType:
    """All raw columns as text, so codes keep their leading zeros."""
    return T.StructType([T.StructField(c.raw, T.StringType()) for c in layout])


# ---------------------------------------------------------------------------
# Raw claim files (raw column, clean column, clean type).
# "amount" is decimal(12,2), "price" decimal(10,2), "flag" 0/1 text.
# ---------------------------------------------------------------------------

BENEFICIARY = _layout("""
DESYNPUF_ID              patient_id              string
BENE_BIRTH_DT            birth_date              date
BENE_DEATH_DT            death_date              date
BENE_SEX_IDENT_CD        gender_code             int
BENE_RACE_CD             race_code               int
BENE_STATE_CD            state_code              string
BENE_COUNTY_CD           county_code             string
PLAN_TYPE                plan_type               int
SP_DIABETES              chronic_diabetes        flag
SP_CHRNKIDN              chronic_kidney          flag
SP_CNCR                  chronic_cancer          flag
SP_COPD                  chronic_copd            flag
SP_DEPRESSN              chronic_depression      flag
SP_ISCHMCHT              chronic_ischemic_heart  flag
SP_OSTEOPRS              chronic_osteoporosis    flag
SP_RA_OA                 chronic_ra_oa           flag
SP_STRKETIA              chronic_stroke          flag
BENE_HI_CVRAGE_TOT_MONS  coverage_months         int
""")

PROVIDER = _layout("""
PROVIDER_ID             provider_id               string
NPI                     npi                       string
PRVDR_SPCLTY            specialty_code            string
PRVDR_STATE_CD          state_code                string
ORG_NAME                org_name                  string
PRVDR_FIRST_NAME        first_name                string
PRVDR_LAST_NAME         last_name                 string
PRVDR_GRP_PRTCPTN_FLAG  group_participation_flag  string
""")

INPATIENT = _layout("""
CLM_ID                          claim_id            string
DESYNPUF_ID                     patient_id          string
PROVIDER_ID                     provider_id         string
CLM_FROM_DT                     admit_date          date
CLM_THRU_DT                     discharge_date      date
AT_PHYSN_NPI                    attending_npi       string
OP_PHYSN_NPI                    operating_npi       string
ICD_DGNS_CD1                    diag_code_1         string
ICD_DGNS_CD2                    diag_code_2         string
ICD_DGNS_CD3                    diag_code_3         string
ICD_DGNS_CD4                    diag_code_4         string
ICD_DGNS_CD5                    diag_code_5         string
ICD_DGNS_CD6                    diag_code_6         string
ICD_DGNS_CD7                    diag_code_7         string
ICD_DGNS_CD8                    diag_code_8         string
ICD_DGNS_CD9                    diag_code_9         string
ICD_DGNS_CD10                   diag_code_10        string
ICD_PRCDR_CD1                   procedure_code_1    string
ICD_PRCDR_CD2                   procedure_code_2    string
ICD_PRCDR_CD3                   procedure_code_3    string
ICD_PRCDR_CD4                   procedure_code_4    string
ICD_PRCDR_CD5                   procedure_code_5    string
ICD_PRCDR_CD6                   procedure_code_6    string
CLM_DRG_CD                      drg_code            string
CLM_PMT_AMT                     payment_amount      amount
CLM_PASS_THRU_PER_DIEM_AMT      per_diem_amount     amount
NCH_BENE_IP_DDCTBL_AMT          deductible_amount   amount
NCH_BENE_PTA_COINSRNC_LBLTY_AM  coinsurance_amount  amount
CLM_UTLZTN_DAY_CNT              utilization_days    int
""")

OUTPATIENT = _layout("""
CLM_ID                       claim_id          string
DESYNPUF_ID                  patient_id        string
PROVIDER_ID                  provider_id       string
CLM_FROM_DT                  admit_date        date
CLM_THRU_DT                  discharge_date    date
AT_PHYSN_NPI                 attending_npi     string
ICD_DGNS_CD1                 diag_code_1       string
ICD_DGNS_CD2                 diag_code_2       string
ICD_DGNS_CD3                 diag_code_3       string
ICD_DGNS_CD4                 diag_code_4       string
ICD_DGNS_CD5                 diag_code_5       string
ICD_DGNS_CD6                 diag_code_6       string
ICD_DGNS_CD7                 diag_code_7       string
ICD_DGNS_CD8                 diag_code_8       string
ICD_DGNS_CD9                 diag_code_9       string
ICD_DGNS_CD10                diag_code_10      string
HCPCS_CD1                    hcpcs_code_1      string
HCPCS_CD2                    hcpcs_code_2      string
HCPCS_CD3                    hcpcs_code_3      string
HCPCS_CD4                    hcpcs_code_4      string
HCPCS_CD5                    hcpcs_code_5      string
CLM_PMT_AMT                  payment_amount    amount
NCH_CARR_CLM_SBMTD_CHRG_AMT  submitted_amount  amount
NCH_CARR_CLM_ALWD_AMT        allowed_amount    amount
""")

CARRIER = _layout("""
CLM_ID                    claim_id            string
DESYNPUF_ID               patient_id          string
CLM_FROM_DT               service_date        date
CLM_THRU_DT               service_end_date    date
PRF_PHYSN_NPI             performing_npi      string
ICD_DGNS_CD1              diag_code_1         string
ICD_DGNS_CD2              diag_code_2         string
ICD_DGNS_CD3              diag_code_3         string
ICD_DGNS_CD4              diag_code_4         string
ICD_DGNS_CD5              diag_code_5         string
ICD_DGNS_CD6              diag_code_6         string
ICD_DGNS_CD7              diag_code_7         string
ICD_DGNS_CD8              diag_code_8         string
HCPCS_CD                  hcpcs_code          string
LINE_NCH_PMT_AMT          payment_amount      amount
LINE_BENE_PTB_DDCTBL_AMT  deductible_amount   amount
LINE_COINSRNC_AMT         coinsurance_amount  amount
LINE_SRVC_CNT             service_count       int
LINE_PRCSG_IND_CD         claim_status_code   string
""")

PRESCRIPTION = _layout("""
PDE_ID          prescription_id     string
DESYNPUF_ID     patient_id          string
SRVC_DT         service_date        date
PROD_SRVC_ID    drug_code           string
GNN             generic_name        string
BNN             brand_name          string
DAYS_SUPLY_NUM  days_supply         int
QTY_DSPNSD_NUM  quantity_dispensed  int
PTNT_PAY_AMT    patient_pay_amount  price
TOT_RX_CST_AMT  total_cost          price
PLAN_PAY_AMT    plan_pay_amount     price
""")

DIAGNOSIS = _layout("""
DGNS_CD        code         string
DGNS_DESC      description  string
DGNS_CATEGORY  category     string
CODE_SYSTEM    code_system  string
""")

# File-name stem of each raw entity in the landing zone.
RAW_ENTITIES = {
    "beneficiary_summary": BENEFICIARY,
    "providers": PROVIDER,
    "inpatient_claims": INPATIENT,
    "outpatient_claims": OUTPATIENT,
    "carrier_claims": CARRIER,
    "prescription_drug_events": PRESCRIPTION,
    "diagnosis_codes": DIAGNOSIS,
}

CHRONIC_FLAGS = tuple(c.clean for c in BENEFICIARY if c.kind == "flag")

# Amounts whose NULLs are filled with 0.00.
FILLED_AMOUNTS = (
    "payment_amount",
    "deductible_amount",
    "coinsurance_amount",
    "per_diem_amount",
    "submitted_amount",
    "allowed_amount",
    "patient_pay_amount",
    "total_cost",
    "plan_pay_amount",
)

# ---------------------------------------------------------------------------
# Labels of coded columns.
# ---------------------------------------------------------------------------

GENDER_LABELS = {1: "Male", 2: "Female"}
RACE_LABELS = {
    1: "White",
    2: "Black",
    3: "Other",
    4: "Asian",
    5: "Hispanic",
    6: "North American Native",
}
CLAIM_STATUS_LABELS = {"A": "Assigned", "N": "Non-assigned"}

# ---------------------------------------------------------------------------
# Clinical resources (output column, path in the JSON, type).
# A number in a path is a position in an array.
# ---------------------------------------------------------------------------

PATIENT = _leaves("""
patient_id    id                       string
mrn           identifier.0.value       string
family_name   name.0.family            string
given_name    name.0.given.0           string
gender        gender                   string
birth_date    birthDate                string
address_line  address.0.line.0         string
city          address.0.city           string
state         address.0.state          string
postal_code   address.0.postalCode     string
race          extension.0.valueString  string
ethnicity     extension.1.valueString  string
""")

PRACTITIONER = _leaves("""
practitioner_id  id                                   string
npi              identifier.0.value                   string
family_name      name.0.family                        string
given_name       name.0.given.0                       string
specialty_code   qualification.0.code.coding.0.code   string
""")

PRACTITIONER_PROFILE = _leaves("""
provider_id     id                                   string
last_name       name.0.family                        string
first_name      name.0.given.0                       string
prefix          name.0.prefix.0                      string
gender          gender                               string
npi             identifier.0.value                   string
specialty_code  qualification.0.code.coding.0.code   string
""")

ENCOUNTER = _leaves("""
encounter_id     id                            string
status           status                        string
encounter_class  class.code                    string
patient_ref      subject.reference             string
period_start     period.start                  string
period_end       period.end                    string
reason_icd10     reasonCode.0.coding.0.code    string
total_cost       extension.0.valueMoney.value  double
""")

CONDITION = _leaves("""
condition_id        id                            string
clinical_status     clinicalStatus.coding.0.code  string
icd10_code          code.coding.0.code            string
icd10_display       code.coding.0.display         string
snomed_code         code.coding.1.code            string
snomed_display      code.coding.1.display         string
patient_ref         subject.reference             string
encounter_ref       encounter.reference           string
onset_datetime      onsetDateTime                 string
abatement_datetime  abatementDateTime             string
""")

OBSERVATION = _leaves("""
observation_id       id                              string
status               status                          string
category             category.0.coding.0.code        string
loinc_code           code.coding.0.code              string
loinc_display        code.coding.0.display           string
patient_ref          subject.reference               string
encounter_ref        encounter.reference             string
effective_datetime   effectiveDateTime               string
value                valueQuantity.value             double
unit                 valueQuantity.unit              string
ref_low              referenceRange.0.low.value      double
ref_high             referenceRange.0.high.value     double
interpretation_code  interpretation.0.coding.0.code  string
""")

MEDICATION_REQUEST = _leaves("""
medication_request_id  id                                                   string
status                 status                                               string
rxnorm_code            medicationCodeableConcept.coding.0.code              string
drug_name              medicationCodeableConcept.coding.0.display           string
patient_ref            subject.reference                                    string
encounter_ref          encounter.reference                                  string
provider_ref           requester.reference                                  string
authored_on            authoredOn                                           string
dosage_text            dosageInstruction.0.text                             string
dose_value             dosageInstruction.0.doseAndRate.0.doseQuantity.value double
dose_unit              dosageInstruction.0.doseAndRate.0.doseQuantity.unit  string
""")

PROCEDURE = _leaves("""
procedure_id        id                            string
status              status                        string
cpt_code            code.coding.0.code            string
cpt_display         code.coding.0.display         string
patient_ref         subject.reference             string
encounter_ref       encounter.reference           string
performed_datetime  performedDateTime             string
procedure_cost      extension.0.valueMoney.value  double
""")

ALLERGY = _leaves("""
allergy_id       id                                           string
clinical_status  clinicalStatus.coding.0.code                 string
substance        code.coding.0.display                        string
patient_ref      patient.reference                            string
reaction         reaction.0.manifestation.0.coding.0.display  string
severity         reaction.0.severity                          string
""")

IMMUNIZATION = _leaves("""
immunization_id      id                            string
status               status                        string
cvx_code             vaccineCode.coding.0.code     string
vaccine_name         vaccineCode.coding.0.display  string
patient_ref          patient.reference             string
occurrence_datetime  occurrenceDateTime            string
lot_number           lotNumber                     string
""")

BUNDLE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        # Declaring the resource as text keeps its raw JSON, whatever its type.
        T.StructField(
            "entry",
            T.ArrayType(T.StructType([T.StructField("resource", T.StringType())])),
        ),
    ]
)

STAGED_RESOURCES = _table("""
bundle_id         string
bundle_timestamp  string
resource          string
resource_type     string
""")

# Personal columns of the clinical patient table.
PERSONAL_COLUMNS = ("family_name", "given_name", "birth_date", "address_line", "mrn")

# Interpretation codes of abnormal results, emergency class.
ABNORMAL_CODES = ("H", "L")
EMERGENCY_CLASS = "EMER"

# Chronic ICD-10 codes and medication name parts.
CHRONIC_CONDITIONS = (
    "E11.9", "I10", "E78.5", "I25.10", "J44.1",
    "N18.3", "F32.9", "I50.9", "M06.9", "I63.9",
)
CHRONIC_MEDICATIONS = (
    "metformin", "lisinopril", "atorvastatin", "amlodipine",
    "furosemide", "warfarin", "levothyroxine", "omeprazole",
)

# ---------------------------------------------------------------------------
# Code lookups (code, description or name, category or class).
# ---------------------------------------------------------------------------

ICD10_CODES = [
    ("E11.9", "Type 2 diabetes mellitus without complications", "Endocrine"),
    ("I10", "Essential (primary) hypertension", "Cardiovascular"),
    ("E78.5", "Hyperlipidemia, unspecified", "Endocrine"),
    ("I25.10", "Atherosclerotic heart disease of native coronary artery", "Cardiovascular"),
    ("J44.1", "COPD with acute exacerbation", "Respiratory"),
    ("N18.3", "Chronic kidney disease, stage 3", "Renal"),
    ("F32.9", "Major depressive disorder, single episode", "Mental Health"),
    ("I50.9", "Heart failure, unspecified", "Cardiovascular"),
    ("M06.9", "Rheumatoid arthritis, unspecified", "Musculoskeletal"),
    ("I63.9", "Cerebral infarction, unspecified", "Neurological"),
]

LOINC_CODES = [
    ("2339-0", "Glucose in Blood", "laboratory"),
    ("4548-4", "Hemoglobin A1c", "laboratory"),
    ("2160-0", "Creatinine in Serum", "laboratory"),
    ("8310-5", "Body temperature", "vital-signs"),
    ("8867-4", "Heart rate", "vital-signs"),
    ("55284-4", "Blood pressure systolic", "vital-signs"),
    ("29463-7", "Body weight", "vital-signs"),
    ("39156-5", "Body mass index", "vital-signs"),
]

RXNORM_CODES = [
    ("860975", "metformin hydrochloride", "Antidiabetic"),
    ("314076", "lisinopril", "ACE Inhibitor"),
    ("617310", "atorvastatin", "Statin"),
    ("197361", "amlodipine", "Calcium Channel Blocker"),
    ("197381", "furosemide", "Loop Diuretic"),
    ("855332", "warfarin sodium", "Anticoagulant"),
    ("966571", "levothyroxine sodium", "Thyroid"),
    ("310429", "gabapentin", "Anticonvulsant"),
]

# ---------------------------------------------------------------------------
# Warehouse tables. Money columns stay decimal, so that sums
# are exact.
# ---------------------------------------------------------------------------

WAREHOUSE = {
    "dim_patient_cms": _table("""
        patient_key              string
        patient_id               string
        birth_date               date
        death_date               date
        gender_code              int
        race_code                int
        state_code               string
        county_code              string
        plan_type                int
        chronic_diabetes         boolean
        chronic_kidney           boolean
        chronic_cancer           boolean
        chronic_copd             boolean
        chronic_depression       boolean
        chronic_ischemic_heart   boolean
        chronic_osteoporosis     boolean
        chronic_ra_oa            boolean
        chronic_stroke           boolean
        coverage_months          int
        gender_label             string
        race_label               string
        is_deceased              boolean
        missing_birth_date_flag  boolean
        age                      int
        age_group                string
        risk_score               int
        risk_tier                string
        is_chronic               boolean
    """),
    "dim_provider_cms": _table("""
        provider_key              string
        provider_id               string
        npi                       string
        specialty_code            string
        state_code                string
        org_name                  string
        first_name                string
        last_name                 string
        group_participation_flag  string
    """),
    "fact_claims": _table("""
        claim_key           string
        claim_id            string
        patient_id          string
        provider_id         string
        claim_type          string
        admit_date          date
        discharge_date      date
        length_of_stay      int
        payment_amount      money
        deductible_amount   money
        coinsurance_amount  money
        per_diem_amount     money
        submitted_amount    money
        allowed_amount      money
        drg_code            string
        diag_code_1         string
        diag_code_2         string
        diag_code_3         string
        diag_code_4         string
        diag_code_5         string
        is_high_cost        boolean
        is_payment_missing  boolean
        year                int
        quarter             int
        month               int
        week_of_year        int
        date_key            int
    """),
    "fact_carrier_claims": _table("""
        claim_key           string
        claim_id            string
        patient_id          string
        performing_npi      string
        service_date        date
        service_end_date    date
        payment_amount      money
        deductible_amount   money
        coinsurance_amount  money
        hcpcs_code          string
        claim_status_code   string
        claim_status        string
        is_high_cost        boolean
        is_payment_missing  boolean
        year                int
        quarter             int
        month               int
        week_of_year        int
        date_key            int
    """),
    "fact_prescriptions": _table("""
        prescription_key    string
        prescription_id     string
        patient_id          string
        drug_code           string
        generic_name        string
        brand_name          string
        service_date        date
        days_supply         int
        quantity_dispensed  int
        patient_pay_amount  money
        total_cost          money
        plan_pay_amount     money
        is_high_cost        boolean
        year                int
        quarter             int
        month               int
        week_of_year        int
        date_key            int
    """),
    "dim_patient_ehr": _table("""
        patient_key        string
        patient_id         string
        mrn                string
        family_name        string
        given_name         string
        gender             string
        birth_date         string
        address_line       string
        city               string
        state              string
        postal_code        string
        race               string
        ethnicity          string
        birth_date_parsed  date
        age                int
        age_group          string
    """),
    "dim_provider_ehr": _table("""
        provider_key     string
        practitioner_id  string
        npi              string
        family_name      string
        given_name       string
        specialty_code   string
    """),
    "fact_encounters": _table("""
        encounter_key             string
        encounter_id              string
        status                    string
        encounter_class           string
        patient_ref               string
        period_start              timestamp
        period_end                timestamp
        reason_icd10              string
        total_cost                double
        encounter_duration_hours  double
        is_emergency              boolean
        visit_year                int
        visit_month               int
    """),
    "fact_conditions": _table("""
        condition_key       string
        condition_id        string
        clinical_status     string
        icd10_code          string
        icd10_display       string
        snomed_code         string
        snomed_display      string
        patient_ref         string
        encounter_ref       string
        onset_datetime      timestamp
        abatement_datetime  timestamp
        icd10_description   string
        icd10_category      string
        is_resolved         boolean
        is_chronic          boolean
    """),
    "fact_observations": _table("""
        observation_key      string
        observation_id       string
        status               string
        category             string
        loinc_code           string
        loinc_display        string
        patient_ref          string
        encounter_ref        string
        effective_datetime   timestamp
        value                double
        unit                 string
        ref_low              double
        ref_high             double
        interpretation_code  string
        is_abnormal          boolean
    """),
    "fact_medications": _table("""
        medication_key         string
        medication_request_id  string
        status                 string
        rxnorm_code            string
        drug_name              string
        patient_ref            string
        encounter_ref          string
        provider_ref           string
        authored_on            timestamp
        dosage_text            string
        dose_value             double
        dose_unit              string
        drug_name_enriched     string
        drug_class             string
        is_chronic_med         boolean
    """),
    "fact_procedures": _table("""
        procedure_key       string
        procedure_id        string
        status              string
        cpt_code            string
        cpt_display         string
        patient_ref         string
        encounter_ref       string
        performed_datetime  timestamp
        procedure_cost      double
    """),
    "fact_allergies": _table("""
        allergy_key      string
        allergy_id       string
        clinical_status  string
        substance        string
        patient_ref      string
        reaction         string
        severity         string
    """),
    "fact_immunizations": _table("""
        immunization_key     string
        immunization_id      string
        status               string
        cvx_code             string
        vaccine_name         string
        patient_ref          string
        occurrence_datetime  timestamp
        lot_number           string
    """),
}

# Clean prefix and partition columns of each table.
CLAIMS_LAKE = {
    "dim_patient_cms": ("dim_patient", ("risk_tier",)),
    "dim_provider_cms": ("dim_provider", ("state_code",)),
    "fact_claims": ("fact_claims", ("year", "claim_type")),
    "fact_carrier_claims": ("fact_carrier_claims", ("year", "month")),
    "fact_prescriptions": ("fact_prescriptions", ("year", "month")),
}
CLINICAL_LAKE = {
    "dim_patient_ehr": ("dim_patient", ("gender",)),
    "dim_provider_ehr": ("dim_provider", ("specialty_code",)),
    "fact_encounters": ("fact_encounters", ("visit_year", "visit_month")),
    "fact_conditions": ("fact_conditions", ("is_chronic",)),
    "fact_observations": ("fact_observations", ("category",)),
    "fact_medications": ("fact_medications", ("is_chronic_med",)),
    "fact_procedures": ("fact_procedures", ("status",)),
    "fact_allergies": ("fact_allergies", ("severity",)),
    "fact_immunizations": ("fact_immunizations", ("status",)),
}

# Surrogate key of each table, and the business key that it follows from.
SURROGATES = {
    "dim_patient_cms": ("patient_key", "patient_id"),
    "dim_provider_cms": ("provider_key", "provider_id"),
    "fact_claims": ("claim_key", "claim_id"),
    "fact_carrier_claims": ("claim_key", "claim_id"),
    "fact_prescriptions": ("prescription_key", "prescription_id"),
    "dim_patient_ehr": ("patient_key", "patient_id"),
    "dim_provider_ehr": ("provider_key", "practitioner_id"),
    "fact_encounters": ("encounter_key", "encounter_id"),
    "fact_conditions": ("condition_key", "condition_id"),
    "fact_observations": ("observation_key", "observation_id"),
    "fact_medications": ("medication_key", "medication_request_id"),
    "fact_procedures": ("procedure_key", "procedure_id"),
    "fact_allergies": ("allergy_key", "allergy_id"),
    "fact_immunizations": ("immunization_key", "immunization_id"),
}
# The resource type that a clinical table is made from row by row (providers are deduplicated),
# and how many folders it has: partition columns of a few codes. Visits by month have many.
ROW_BY_ROW = {
    "dim_patient_ehr": "Patient",
    "fact_conditions": "Condition",
    "fact_observations": "Observation",
    "fact_medications": "MedicationRequest",
    "fact_procedures": "Procedure",
    "fact_allergies": "AllergyIntolerance",
    "fact_immunizations": "Immunization",
}
FEW_FOLDERS = 4
