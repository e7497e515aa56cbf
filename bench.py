"""Time the headline queries and print one JSON line.

Each query is run to a discarded full result, the whole jobs and the feeds once
and the others twice (the better run counts). The jobs come first and read raw
files that are landed before the clock; nothing of theirs is staged beforehand.
The tables that the marts read are written between, off the clock.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from carebasin import schemas
from carebasin.session import build_session
from checks import QUERIES, tables

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))

JOBS = ["claims_job", "clinical_job", "stream_file_load"]
BUILDS = [
    "dim_patient_cms", "dim_provider_cms", "fact_claims", "fact_carrier_claims",
    "fact_prescriptions", "dim_patient_ehr", "dim_provider_ehr", "fact_encounters",
    "fact_conditions", "fact_observations", "fact_medications", "fact_procedures",
    "fact_allergies", "fact_immunizations",
]
MARTS = [
    "kpi_summary", "patient_age_group", "patient_gender_race", "risk_score_distribution",
    "claims_by_month", "payment_buckets", "high_cost_patients", "top_drugs",
    "encounter_by_class", "encounters_by_month", "top_medications", "medication_chronic_split",
    "top_observations", "abnormal_by_test", "table_row_counts",
]
OPERATORS = [
    "dedup_business_key", "clean_amounts", "exact_p99", "high_cost_customers", "top_parts",
    "abnormal_rate",
]


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]",
        **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
           "spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "16g",
           "spark.checkpoint.dir": os.environ.get("BENCH_WORK") or tempfile.mkdtemp(prefix="bench-")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    for entity in schemas.RAW_ENTITIES:
        tables.landed(spark, SF_DIR, entity)
    tables.landed_bundles(spark, SF_DIR)

    seconds = {}

    def clock(name: str, repeats: int) -> None:
        runs = []
        for _ in range(repeats):
            start = time.perf_counter()
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
        print(f"{seconds[name]:8.3f}s {name}", file=sys.stderr, flush=True)

    for name in JOBS:
        clock(name, 1)
    lake = tables.Lake(spark, SF_DIR)
    for name in BUILDS[:12]:
        lake[name]
    for name in BUILDS + MARTS + OPERATORS:
        clock(name, REPEATS)
    spark.stop()
    print(json.dumps({
        "metric": "total_wall_clock", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
