"""Clinical records: document bundles to a star schema.

Each ``build_`` function takes the exploded resources (see
``documents.explode_entries``) and is pure and lazy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from carebasin import schemas
from carebasin.operators import clinical
from carebasin.operators.dedup import one_per_key
from carebasin.operators.documents import explode_entries, flatten, of_type
from carebasin.operators.people import add_key, mask_columns
from carebasin.plans.lake import write_clinical
from carebasin.sources.readers import read_bundles
from carebasin.sources.writers import stage, stages_removed, well_dealt


#: Files of a resource type, at least, that its table's tasks read.
FILES = 64


def flatten_patients(resources: DataFrame) -> DataFrame:
    return flatten(of_type(resources, "Patient"), schemas.PATIENT)


def flatten_practitioners(resources: DataFrame) -> DataFrame:
    return flatten(of_type(resources, "Practitioner"), schemas.PRACTITIONER)


def flatten_practitioner_profiles(resources: DataFrame) -> DataFrame:
    """The wider practitioner view, with prefix and gender; not part of a table."""
    return flatten(of_type(resources, "Practitioner"), schemas.PRACTITIONER_PROFILE)


def flatten_encounters(resources: DataFrame) -> DataFrame:
    return flatten(of_type(resources, "Encounter"), schemas.ENCOUNTER)


def flatten_conditions(resources: DataFrame) -> DataFrame:
    return flatten(of_type(resources, "Condition"), schemas.CONDITION)


def flatten_observations(resources: DataFrame) -> DataFrame:
    return flatten(of_type(resources, "Observation"), schemas.OBSERVATION)


def flatten_medications(resources: DataFrame) -> DataFrame:
    return flatten(of_type(resources, "MedicationRequest"), schemas.MEDICATION_REQUEST)


def flatten_procedures(resources: DataFrame) -> DataFrame:
    return flatten(of_type(resources, "Procedure"), schemas.PROCEDURE)


def flatten_allergies(resources: DataFrame) -> DataFrame:
    return flatten(of_type(resources, "AllergyIntolerance"), schemas.ALLERGY)


def flatten_immunizations(resources: DataFrame) -> DataFrame:
    return flatten(of_type(resources, "Immunization"), schemas.IMMUNIZATION)


def build_patients(resources: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Patient dimension: ages first, then the personal columns are masked."""
    return (
        flatten_patients(resources)
        .transform(clinical.add_patient_age, as_of)
        .transform(mask_columns, schemas.PERSONAL_COLUMNS)
        .transform(add_key, "patient_id", "patient_key")
    )


def build_practitioners(resources: DataFrame) -> DataFrame:
    return (
        flatten_practitioners(resources)
        .transform(one_per_key, ["npi"])
        .transform(add_key, "practitioner_id", "provider_key")
    )


def build_encounters(resources: DataFrame) -> DataFrame:
    return (
        flatten_encounters(resources)
        .transform(clinical.normalize_timestamps, ["period_start", "period_end"])
        .transform(clinical.add_encounter_columns)
        .transform(add_key, "encounter_id", "encounter_key")
    )


def build_conditions(resources: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """Condition fact; ``lookup`` may replace the built-in diagnosis codes."""
    return (
        flatten_conditions(resources)
        .transform(clinical.normalize_timestamps, ["onset_datetime", "abatement_datetime"])
        .transform(clinical.enrich_icd10, "icd10_code", lookup)
        .transform(clinical.flag_conditions)
        .transform(add_key, "condition_id", "condition_key")
    )


def build_observations(resources: DataFrame) -> DataFrame:
    return (
        flatten_observations(resources)
        .transform(clinical.normalize_timestamps, ["effective_datetime"])
        .transform(clinical.flag_abnormal)
        .transform(add_key, "observation_id", "observation_key")
    )


def build_medications(resources: DataFrame) -> DataFrame:
    return (
        flatten_medications(resources)
        .transform(clinical.normalize_timestamps, ["authored_on"])
        .transform(clinical.enrich_rxnorm, "rxnorm_code")
        .transform(clinical.flag_medications)
        .transform(add_key, "medication_request_id", "medication_key")
    )


def build_procedures(resources: DataFrame) -> DataFrame:
    return (
        flatten_procedures(resources)
        .transform(clinical.normalize_timestamps, ["performed_datetime"])
        .transform(add_key, "procedure_id", "procedure_key")
    )


def build_allergies(resources: DataFrame) -> DataFrame:
    return flatten_allergies(resources).transform(add_key, "allergy_id", "allergy_key")


def build_immunizations(resources: DataFrame) -> DataFrame:
    return (
        flatten_immunizations(resources)
        .transform(clinical.normalize_timestamps, ["occurrence_datetime"])
        .transform(add_key, "immunization_id", "immunization_key")
    )


def build_all(
    resources: DataFrame, as_of: Column | None = None, lookup: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The nine clinical tables by name."""
    return {
        "dim_patient_ehr": build_patients(resources, as_of),
        "dim_provider_ehr": build_practitioners(resources),
        "fact_encounters": build_encounters(resources),
        "fact_conditions": build_conditions(resources, lookup),
        "fact_observations": build_observations(resources),
        "fact_medications": build_medications(resources),
        "fact_procedures": build_procedures(resources),
        "fact_allergies": build_allergies(resources),
        "fact_immunizations": build_immunizations(resources),
    }


def stage_resources(bundles: DataFrame) -> DataFrame:
    """Explode the bundles once into folders by resource type.

    The nine builds then read one folder each instead of all documents. Parsing is
    their main work and compressed text is many times larger when parsed, so a type is
    spread over ``FILES`` files even if it is small. Where the tasks that read the bundles
    are well dealt already, their text is not shuffled: each writes a file per type.
    """
    return stage(
        explode_entries(bundles), "resources", ["resource_type"], spread=FILES, gather=not well_dealt(bundles),
        compression="zstd",
    )


def run(
    spark: SparkSession, landing: str, lake: str,
    as_of: Column | None = None, lookup: DataFrame | None = None, one_per_line: bool = False,
) -> None:
    """Read the bundles, build all clinical tables and write them; the staged
    resources are removed at the end."""
    with stages_removed(spark):
        resources = stage_resources(read_bundles(spark, landing, one_per_line))
        for name, df in build_all(resources, as_of, lookup).items():
            write_clinical(name, df, f"{lake.rstrip('/')}/{schemas.CLINICAL_LAKE[name][0]}", resources)
