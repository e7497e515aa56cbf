"""Raw claim files and clinical bundles derived from the given tables.

The given tables hold no health data, so each raw record is computed from a row
of them: customers stand for beneficiaries, suppliers for providers, orders for
inpatient claims, order lines for outpatient and carrier claims and
prescriptions, events for clinical bundles. The raw claim records are defined
by SQL that both engines read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carebasin import schemas

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of a table up to which it may be one row group, or a few: one split of Spark's default size.
SMALL = 128 << 20


def spread(frame: DataFrame) -> DataFrame:
    """A small table's rows dealt to all cores. A task reads whole row groups, and a raw
    record or bundle takes far longer to derive than its row to read."""
    size = int(str(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return frame.repartition(frame.sparkSession.sparkContext.defaultParallelism) if size <= SMALL else frame


def _id(column: str, width: int) -> str:
    return f"lpad(cast({column} AS string), {width}, '0')"


def _day(expression: str) -> str:
    return f"replace(cast({expression} AS string), '-', '')"


def _cents(column: str) -> str:
    return f"cast(cast({column} AS decimal(12,2)) AS string)"


def _below(column: str, bound: str) -> str:
    """An amount under the bound (in cents), from the column's last digits."""
    cents = f"cast(round({column} * 100) AS bigint) % ({bound})"
    return f"cast(cast(cast({cents} AS decimal(12,0)) * 0.01 AS decimal(12,2)) AS string)"


def _codes(key: str, names: list[str], stem: str) -> str:
    """Several code columns; later ones are NULL more often."""
    return ",\n".join(
        f"CASE WHEN {key} % {len(names)} >= {i} THEN "
        f"'{stem}' || {_id(f'{key} * {i + 3} % 20', 3)} END AS {name}"
        for i, name in enumerate(names)
    )


def _flags() -> str:
    names = [c.raw for c in schemas.BENEFICIARY if c.kind == "flag"]
    return ",\n".join(
        f"CASE WHEN c_custkey % 31 = {i} THEN NULL "
        f"WHEN c_custkey * {2 * i + 3} % 7 < {i % 4 + 1} THEN '1' ELSE '0' END AS {name}"
        for i, name in enumerate(names)
    )


_DIAGNOSES = [f"ICD_DGNS_CD{i}" for i in range(1, 11)]
_PROCEDURES = [f"ICD_PRCDR_CD{i}" for i in range(1, 7)]
_SERVICES = [f"HCPCS_CD{i}" for i in range(1, 6)]

# Some records land twice ("copy"), some dates and amounts are unusable.
RAW_SQL = {
    "beneficiary_summary": f"""
        SELECT {_id('c_custkey', 16)} AS DESYNPUF_ID,
          CASE WHEN c_custkey % 50 = 7 THEN '19600230' WHEN c_custkey % 41 = 3 THEN ''
            ELSE {_day("date '1930-01-01' + cast(c_custkey * 37 % 32000 AS int)")}
          END AS BENE_BIRTH_DT,
          CASE WHEN c_custkey % 12 = 0
            THEN {_day("date '2010-01-01' + cast(c_custkey % 3000 AS int)")} ELSE ''
          END AS BENE_DEATH_DT,
          CASE WHEN c_custkey % 97 <> 0 THEN cast(c_nationkey % 3 AS string) END
            AS BENE_SEX_IDENT_CD,
          cast(c_nationkey % 8 AS string) AS BENE_RACE_CD,
          {_id('c_nationkey + 1', 2)} AS BENE_STATE_CD,
          {_id('(c_custkey + copy * 5) % 999 + 1', 3)} AS BENE_COUNTY_CD,
          cast(10 + c_custkey % 4 AS string) AS PLAN_TYPE,
          {_flags()},
          cast(c_custkey % 13 AS string) AS BENE_HI_CVRAGE_TOT_MONS
        FROM (SELECT *, 0 AS copy FROM {{customer}} UNION ALL
              SELECT *, 1 AS copy FROM {{customer}} WHERE c_custkey % 10 = 0) landed
    """,
    "providers": f"""
        SELECT {_id('s_suppkey', 8)} AS PROVIDER_ID,
          cast(1000000000 + s_suppkey * 7 + copy AS string) AS NPI,
          {_id('s_suppkey % 22 + 1', 2)} AS PRVDR_SPCLTY,
          {_id('s_nationkey + 1', 2)} AS PRVDR_STATE_CD,
          s_name AS ORG_NAME,
          CASE WHEN s_suppkey % 9 <> 4 THEN 'First' || cast(s_suppkey % 30 AS string) END
            AS PRVDR_FIRST_NAME,
          'Last' || cast(s_suppkey % 70 AS string) AS PRVDR_LAST_NAME,
          CASE WHEN s_acctbal < 0 THEN 'N' ELSE 'Y' END AS PRVDR_GRP_PRTCPTN_FLAG
        FROM (SELECT *, 0 AS copy FROM {{supplier}} UNION ALL
              SELECT *, 1 AS copy FROM {{supplier}} WHERE s_suppkey % 5 = 0) landed
    """,
    "inpatient_claims": f"""
        SELECT {_id('o_orderkey', 12)} AS CLM_ID,
          {_id('o_custkey', 16)} AS DESYNPUF_ID,
          {_id('o_orderkey % 100', 8)} AS PROVIDER_ID,
          {_day('cast(o_orderdate AS date)')} AS CLM_FROM_DT,
          CASE WHEN o_orderkey % 70 = 9 THEN '2001-13-45' ELSE
            {_day('cast(o_orderdate AS date) + cast(o_orderkey % 14 + 1 AS int)')}
          END AS CLM_THRU_DT,
          cast(1000000000 + o_orderkey AS string) AS AT_PHYSN_NPI,
          CASE WHEN o_orderkey % 3 = 0 THEN cast(2000000000 + o_orderkey AS string) END
            AS OP_PHYSN_NPI,
          {_codes('o_orderkey', _DIAGNOSES, 'D')},
          {_codes('o_orderkey', _PROCEDURES, '00')},
          {_id('o_orderkey % 999', 3)} AS CLM_DRG_CD,
          CASE WHEN o_orderkey % 60 = 1 THEN NULL
            WHEN o_orderkey % 45 = 2 THEN '-' || {_cents('o_totalprice')}
            WHEN o_orderkey % 30 = 3 THEN {_cents('o_totalprice')} || '7'
            ELSE {_below('(o_totalprice + copy)', '40000 + o_orderkey % 7 * o_orderkey % 7 * 700000')} END AS CLM_PMT_AMT,
          '12.' || {_id('o_orderkey % 100', 2)} AS CLM_PASS_THRU_PER_DIEM_AMT,
          CASE WHEN o_orderkey % 5 > 0 THEN cast(o_orderkey % 1600 AS string) END
            AS NCH_BENE_IP_DDCTBL_AMT,
          CASE WHEN o_orderkey % 11 = 0 THEN 'n/a' ELSE cast(o_orderkey % 500 AS string) END
            AS NCH_BENE_PTA_COINSRNC_LBLTY_AM,
          cast(o_orderkey % 14 + 1 AS string) AS CLM_UTLZTN_DAY_CNT
        FROM (SELECT *, 0 AS copy FROM {{orders}} UNION ALL
              SELECT *, 1 AS copy FROM {{orders}} WHERE o_orderkey % 8 = 0) landed
    """,
    # Order lines repeat their (order, line) key, so claims repeat by themselves.
    "outpatient_claims": f"""
        SELECT 'L' || {_id('l_orderkey * 10 + l_linenumber', 12)} AS CLM_ID,
          {_id('l_partkey', 16)} AS DESYNPUF_ID,
          {_id('l_suppkey', 8)} AS PROVIDER_ID,
          {_day('cast(l_shipdate AS date)')} AS CLM_FROM_DT,
          {_day('cast(l_shipdate AS date)')} AS CLM_THRU_DT,
          cast(1000000000 + l_suppkey AS string) AS AT_PHYSN_NPI,
          {_codes('l_orderkey', _DIAGNOSES, 'E')},
          {_codes('l_orderkey', _SERVICES, '99')},
          {_below('l_extendedprice', '300000')} AS CLM_PMT_AMT,
          {_cents('l_extendedprice')} AS NCH_CARR_CLM_SBMTD_CHRG_AMT,
          CASE WHEN l_discount > 0.01 THEN {_below('l_extendedprice', '200000')} END
            AS NCH_CARR_CLM_ALWD_AMT
        FROM {{lineitem}}
    """,
    "carrier_claims": f"""
        SELECT {_id('l_orderkey * 10 + l_linenumber', 12)} AS CLM_ID,
          {_id('l_suppkey', 16)} AS DESYNPUF_ID,
          {_day('cast(l_shipdate AS date)')} AS CLM_FROM_DT,
          {_day('cast(l_shipdate AS date) + cast(l_linenumber AS int)')} AS CLM_THRU_DT,
          cast(1000000000 + l_partkey AS string) AS PRF_PHYSN_NPI,
          {_codes('l_orderkey', _DIAGNOSES[:8], 'C')},
          '9' || {_id('l_partkey % 1000', 4)} AS HCPCS_CD,
          CASE WHEN l_quantity > 1 THEN {_below('l_extendedprice', '190000')} END AS LINE_NCH_PMT_AMT,
          cast(l_orderkey % 200 AS string) AS LINE_BENE_PTB_DDCTBL_AMT,
          CASE WHEN l_linenumber > 1 THEN {_below('l_extendedprice', '40000')} END
            AS LINE_COINSRNC_AMT,
          cast(l_linenumber AS string) AS LINE_SRVC_CNT,
          l_returnflag AS LINE_PRCSG_IND_CD
        FROM {{lineitem}}
    """,
    "prescription_drug_events": f"""
        SELECT {_id('l_orderkey * 10 + l_linenumber', 12)} AS PDE_ID,
          {_id('l_suppkey', 16)} AS DESYNPUF_ID,
          {_day('cast(l_shipdate AS date)')} AS SRVC_DT,
          {_id('l_partkey * 31', 11)} AS PROD_SRVC_ID,
          CASE WHEN p_size > 1 THEN p_name END AS GNN,
          p_brand AS BNN,
          cast(l_linenumber * 7 AS string) AS DAYS_SUPLY_NUM,
          cast(cast(l_quantity AS int) AS string) AS QTY_DSPNSD_NUM,
          {_below('l_extendedprice', '11000')} AS PTNT_PAY_AMT,
          CASE WHEN l_partkey % 80 = 5 THEN NULL ELSE {_below('l_extendedprice', '80000')} END
            AS TOT_RX_CST_AMT,
          {_below('l_extendedprice', '60000')} AS PLAN_PAY_AMT
        FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey
    """,
    "diagnosis_codes": """
        SELECT DISTINCT 'D' || lpad(cast(p_size % 20 AS string), 3, '0') AS DGNS_CD,
          'Diagnosis ' || cast(p_size % 20 AS string) AS DGNS_DESC,
          'Group ' || cast(p_size % 4 AS string) AS DGNS_CATEGORY, 'ICD10' AS CODE_SYSTEM
        FROM {part}
    """,
}


def raw(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """The raw records of one entity."""
    text = RAW_SQL[entity]
    used = {t: spread(given(spark, sf_dir, t)) for t in TABLES if f"{{{t}}}" in text}
    return spark.sql(text, **used)


def raw_sql(entity: str) -> str:
    """The same records for the checking engine."""
    return RAW_SQL[entity].format(**{t: t for t in TABLES})


# -- clinical bundles: fifteen resources per event ------------------------------

EXTRA_CONDITIONS = [("Z00.0", "General examination"), ("R05", "Cough")]
CONDITIONS = [(c, d) for c, d, _ in schemas.ICD10_CODES] + EXTRA_CONDITIONS
TESTS = [(c, d) for c, d, _ in schemas.LOINC_CODES] + [("718-7", "Hemoglobin")]
DRUGS = [
    ("860975", "Metformin 500 MG"), ("314076", "Lisinopril 10 MG"),
    ("617310", "ATORVASTATIN 20 MG"), ("197361", "amlodipine 5 MG"),
    ("197381", "Furosemide 40 MG"), ("855332", "Warfarin sodium 5 MG"),
    ("966571", "Levothyroxine 50 MCG"), ("310429", "Gabapentin 300 MG"),
    ("402014", "Omeprazole 20 MG"), ("198440", "Acetaminophen 500 MG"),
]


def _pick(pairs: list[tuple[str, str]], index: str, part: int) -> str:
    items = ", ".join(f"'{p[part]}'" for p in pairs)
    return f"element_at(array({items}), cast(({index}) % {len(pairs)} + 1 AS int))"


def _resource(kind: str, **fields: str) -> str:
    cells = "".join(f", '{name.rstrip('_')}', {value}" for name, value in fields.items())
    return f"to_json(named_struct('resourceType', '{kind}'{cells}))"


def _struct(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{n}', {v}" for n, v in fields.items()) + ")"


def _coding(*pairs: tuple[str, str]) -> str:
    rows = ", ".join(_struct(code=code, display=display) for code, display in pairs)
    return _struct(coding=f"array({rows})")


def _ref(kind: str, key: str) -> str:
    return _struct(reference=f"'{kind}/' || {key}")


_PATIENT_ID = "'p' || cast(user_id AS string)"
_ENCOUNTER_ID = "'e' || cast(event_id AS string)"
_SUBJECT = _ref("Patient", _PATIENT_ID)
_VISIT = _ref("Encounter", _ENCOUNTER_ID)
_OFFSET = "CASE WHEN event_id % 5 = 0 THEN '+05:30' ELSE 'Z' END"
_DAY_TEXT = "date_format(ts, 'yyyy-MM-dd')"


def _moment(expression: str) -> str:
    return f"date_format({expression}, \"yyyy-MM-dd'T'HH:mm:ss\") || {_OFFSET}"


def _condition(j: int) -> str:
    i = f"event_id + {j * 5}"
    code = _struct(code=_pick(CONDITIONS, i, 0), display=_pick(CONDITIONS, i, 1))
    snomed = _struct(code=f"'S' || cast({i} AS string)", display="'Snomed'")
    status = f"CASE WHEN event_id % 3 = {j} THEN 'resolved' ELSE 'active' END"
    return _resource(
        "Condition",
        id=f"'c{j}-' || cast(event_id AS string)",
        clinicalStatus=_coding((status, "''")),
        code=_struct(
            coding=f"CASE WHEN event_id % 4 = {j} THEN array({code}) ELSE array({code}, {snomed}) END"
        ),
        subject=_SUBJECT,
        encounter=_VISIT,
        onsetDateTime=_DAY_TEXT,
        abatementDateTime=f"CASE WHEN event_id % 3 = {j} THEN {_moment('ts')} END",
    )


def _observation(j: int) -> str:
    i = f"event_id + {j * 3}"
    category = "'vital-signs'" if j == 2 else "'laboratory'"
    code = "CASE event_type WHEN 'error' THEN 'H' WHEN 'view' THEN 'L' ELSE 'N' END"
    return _resource(
        "Observation",
        id=f"'o{j}-' || cast(event_id AS string)",
        status="'final'",
        category=f"array({_coding((category, chr(39) * 2))})",
        code=_coding((_pick(TESTS, i, 0), f"CASE WHEN event_id % 10 <> {j} THEN {_pick(TESTS, i, 1)} END")),
        subject=_SUBJECT,
        encounter=_VISIT,
        effectiveDateTime=_moment("ts"),
        valueQuantity=_struct(
            value=f"value + {j}", unit=f"CASE WHEN event_id % 6 <> {j} THEN 'mg/dL' END"
        ),
        referenceRange=f"array({_struct(low=_struct(value='1.5'), high=_struct(value='99'))})",
        interpretation=f"CASE WHEN event_type <> 'signup' THEN array({_coding((code, chr(39) * 2))}) END",
    )


def _medication(j: int) -> str:
    i = f"event_id + {j * 7}"
    name = f"CASE WHEN event_id % 13 <> {j} THEN {_pick(DRUGS, i, 1)} END"
    dose = _struct(
        doseQuantity=_struct(value=f"cast(event_id % 4 + {j} AS double) / 2", unit="'tablet'")
    )
    return _resource(
        "MedicationRequest",
        id=f"'m{j}-' || cast(event_id AS string)",
        status="CASE WHEN event_id % 2 = 0 THEN 'active' ELSE 'completed' END",
        medicationCodeableConcept=_coding((_pick(DRUGS, i, 0), name)),
        subject=_SUBJECT,
        encounter=_VISIT,
        requester=_ref("Practitioner", "'r' || cast(event_id % 500 AS string)"),
        authoredOn=_DAY_TEXT,
        dosageInstruction=f"array({_struct(text=chr(39) + 'Take daily' + chr(39), doseAndRate=f'array({dose})')})",
    )


def _immunization(j: int) -> str:
    return _resource(
        "Immunization",
        id=f"'i{j}-' || cast(event_id AS string)",
        status=f"CASE WHEN event_id % 19 = {j} THEN 'not-done' ELSE 'completed' END",
        vaccineCode=_coding((f"cast(event_id % 9 + {j * 100} AS string)", "'Vaccine'")),
        patient=_SUBJECT,
        occurrenceDateTime=_DAY_TEXT,
        lotNumber="'LOT' || cast(event_id % 1000 AS string)",
    )


def _patient() -> str:
    race = _struct(url="'race'", valueString="'Race ' || cast(user_id % 5 AS string)")
    ethnicity = _struct(url="'ethnicity'", valueString="'Group ' || cast(user_id % 2 AS string)")
    birth = "date_format(date '1935-01-01' + cast(user_id * 131 % 30000 AS int), 'yyyy-MM-dd')"
    address = _struct(
        line="array(cast(user_id AS string) || ' Main St')", city="'City ' || cast(user_id % 9 AS string)",
        state="'ST'", postalCode="lpad(cast(user_id AS string), 5, '0')",
    )
    name = _struct(family="'Family ' || cast(user_id % 40 AS string)", given="array('Given', 'Middle')")
    return _resource(
        "Patient",
        id=_PATIENT_ID,
        identifier=f"array({_struct(value=chr(39) + 'MRN' + chr(39) + ' || cast(user_id AS string)')})",
        name=f"array({name})",
        gender="CASE user_id % 4 WHEN 0 THEN 'male' WHEN 1 THEN 'female' WHEN 2 THEN 'other' END",
        birthDate=f"CASE WHEN user_id % 17 = 2 THEN '1990-02-30' ELSE {birth} END",
        address=f"array({address})",
        extension=f"CASE WHEN user_id % 9 = 0 THEN array({race}) ELSE array({race}, {ethnicity}) END",
    )


def _practitioner() -> str:
    name = _struct(
        family="'Doc ' || cast(event_id % 500 AS string)", given="array('Ann')", prefix="array('Dr.')"
    )
    code = _struct(system="'s'", code="lpad(cast(event_id % 300 % 22 AS string), 2, '0')")
    return _resource(
        "Practitioner",
        id="'r' || cast(event_id % 500 AS string)",
        identifier=f"array({_struct(value='cast(1000000000 + event_id % 300 AS string)')})",
        name=f"array({name})",
        gender="'female'",
        qualification=f"array({_struct(code=_struct(coding=f'array({code})'))})",
    )


def _money(value: str) -> str:
    return f"array({_struct(url=chr(39) + 'cost' + chr(39), valueMoney=_struct(value=value))})"


_CLASS = (
    "CASE event_type WHEN 'error' THEN 'EMER' WHEN 'purchase' THEN 'IMP' "
    "WHEN 'click' THEN 'AMB' WHEN 'view' THEN 'AMB' END"
)
_REACTION = _struct(
    manifestation=f"array({_coding((chr(39) * 2, chr(39) + 'Rash' + chr(39)))})",
    severity="CASE event_id % 3 WHEN 0 THEN 'mild' WHEN 1 THEN 'moderate' ELSE 'severe' END",
)

RESOURCES = [
    _patient(),
    _resource("Organization", id="'org'", name="'General Hospital'"),
    _practitioner(),
    _resource(
        "Encounter",
        id=_ENCOUNTER_ID,
        status="'finished'",
        class_=_struct(code=_CLASS),
        subject=_SUBJECT,
        period=_struct(
            start=_moment("ts"), end=_moment("ts + make_dt_interval(0, cast(event_id % 50 AS int), 15)")
        ),
        reasonCode=f"array({_coding((_pick(CONDITIONS, 'event_id', 0), chr(39) * 2))})",
        extension=_money("CASE WHEN event_id % 23 <> 0 THEN value END"),
    ),
    _condition(0), _condition(1),
    _observation(0), _observation(1), _observation(2),
    _medication(0), _medication(1),
    _resource(
        "Procedure",
        id="'t' || cast(event_id AS string)",
        status="CASE WHEN event_id % 8 = 0 THEN 'stopped' ELSE 'completed' END",
        code=_coding(("'99' || lpad(cast(event_id % 50 AS string), 3, '0')", "'Procedure'")),
        subject=_SUBJECT,
        encounter=_VISIT,
        performedDateTime=_moment("ts"),
        extension=_money("value"),
    ),
    _resource(
        "AllergyIntolerance",
        id="'a' || cast(event_id AS string)",
        clinicalStatus=_coding(("'active'", "''")),
        category="array('food')",
        code=_coding(("'x'", "CASE event_id % 3 WHEN 0 THEN 'Peanut' ELSE 'Pollen' END")),
        patient=_SUBJECT,
        reaction=f"CASE WHEN event_id % 10 > 0 THEN array({_REACTION}) END",
    ),
    _immunization(0), _immunization(1),
]


#: Files that a task puts together: it holds their whole text.
FILES_PER_TASK = 16


def bundles(spark: SparkSession, sf_dir: str, per_file: int | None = None) -> DataFrame:
    """One bundle per event, in the shape that the bundle scan gives.

    With ``per_file`` a column ``file`` numbers files of so many bundles at most, and the rows of a
    file are in one task: events are dealt by it, as their bundles are hundreds of times their size.
    """
    events = given(spark, sf_dir, "events")
    if per_file is None:
        events = spread(events)
    else:
        file = F.floor(F.monotonically_increasing_id() / F.lit(per_file))
        tasks = max(-(-events.count() // (per_file * FILES_PER_TASK)), spark.sparkContext.defaultParallelism)
        events = events.withColumn("file", file).repartition(tasks, "file")
    entries = ", ".join(f"named_struct('resource', {r})" for r in RESOURCES)
    return spark.sql(
        f"""SELECT 'b' || cast(event_id AS string) AS id, {_moment('ts')} AS timestamp,
            array({entries}) AS entry{", file" if per_file else ""} FROM {{events}}""",
        events=events,
    )


def bundle_text(frame: DataFrame) -> DataFrame:
    """Bundles as JSON text, one document per row."""
    wrapped = F.transform("entry", lambda e: F.concat(F.lit('{"resource":'), e["resource"], F.lit("}")))
    return frame.select(
        F.concat(
            F.lit('{"resourceType":"Bundle","id":"'), "id",
            F.lit('","type":"collection","timestamp":"'), "timestamp",
            F.lit('","entry":['), F.array_join(wrapped, ","), F.lit("]}"),
        ).alias("value"),
        *[c for c in frame.columns if c not in ("id", "timestamp", "entry")],
    )
