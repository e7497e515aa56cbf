"""Claims: raw files to a star schema.

The ``build_`` functions are pure and lazy; ``run`` reads the landing zone and
writes the tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession

from carebasin import schemas
from carebasin.operators import claims, conform, money, people
from carebasin.operators.dedup import one_per_key
from carebasin.plans.lake import write_clean
from carebasin.sources.readers import read_raw_entity
from carebasin.sources.writers import stage, stages_removed

Settle = Callable[[DataFrame], DataFrame]


def _as_is(df: DataFrame) -> DataFrame:
    return df


def settled(df: DataFrame) -> DataFrame:
    """Write the deduplicated rows once; the default of the job."""
    return stage(df, "claims", compression="zstd")


class Settling:
    """``settled`` that remembers what it wrote: ``rows`` in the order of the builds."""

    def __init__(self) -> None:
        self.rows: list[DataFrame] = []

    def __call__(self, df: DataFrame) -> DataFrame:
        self.rows.append(settled(df))
        return self.rows[-1]


def build_patients(raw: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Beneficiary summary to the patient dimension."""
    return (
        raw.transform(conform.rename_columns, schemas.BENEFICIARY)
        .transform(conform.cast_columns, schemas.BENEFICIARY)
        .transform(one_per_key, ["patient_id"])
        .transform(people.decode_gender)
        .transform(people.decode_race)
        .transform(people.flag_missing_facts)
        .transform(people.add_age, as_of=as_of)
        .transform(people.add_risk)
        .transform(people.add_key, "patient_id", "patient_key")
    )


def build_providers(raw: DataFrame) -> DataFrame:
    """Provider file to the provider dimension."""
    return (
        raw.transform(conform.rename_columns, schemas.PROVIDER)
        .transform(one_per_key, ["provider_id"])
        .transform(people.add_key, "provider_id", "provider_key")
    )


def _typed_claims(inpatient: DataFrame, outpatient: DataFrame) -> DataFrame:
    both = conform.stack(
        conform.tag(conform.rename_columns(inpatient, schemas.INPATIENT), claim_type="inpatient"),
        conform.tag(conform.rename_columns(outpatient, schemas.OUTPATIENT), claim_type="outpatient"),
    )
    return conform.cast_columns(both, schemas.INPATIENT, schemas.OUTPATIENT)


def _typed_carrier_claims(raw: DataFrame) -> DataFrame:
    return (
        raw.transform(conform.rename_columns, schemas.CARRIER)
        .transform(conform.cast_columns, schemas.CARRIER)
        .transform(claims.decode_claim_status)
    )


def _typed_prescriptions(raw: DataFrame) -> DataFrame:
    return raw.transform(conform.rename_columns, schemas.PRESCRIPTION).transform(
        conform.cast_columns, schemas.PRESCRIPTION
    )


@dataclass(frozen=True)
class Fact:
    """How one fact table is made: its raw entities, the steps to typed rows, keys,
    the date and the amount that count."""

    entities: tuple[str, ...]
    typed: Callable[..., DataFrame]
    key: str
    surrogate: str
    day: str
    amount: str
    stays: bool = False

    def rows(self, *raw: DataFrame) -> DataFrame:
        """Typed rows with filled amounts, before deduplication."""
        return self.typed(*raw).transform(money.fill_missing_amounts, schemas.FILLED_AMOUNTS)

    def finished(self, settled: DataFrame, method: str = "exact", threshold: Column | None = None) -> DataFrame:
        """The table's columns from deduplicated rows."""
        fact = (
            settled.transform(claims.add_date_parts, self.day)
            .transform(money.clean_amounts, [self.amount], method=method, threshold=threshold)
            .transform(people.add_key, self.key, self.surrogate)
        )
        return claims.add_length_of_stay(fact) if self.stays else fact

    def build(self, *raw: DataFrame, method: str, settle: Settle) -> DataFrame:
        """``settle`` writes the deduplicated rows once, as the amount threshold and the
        table itself both read them; ``_as_is`` leaves that out."""
        return self.finished(settle(one_per_key(self.rows(*raw), [self.key])), method)


FACTS = {
    "fact_claims": Fact(
        ("inpatient_claims", "outpatient_claims"), _typed_claims,
        "claim_id", "claim_key", "admit_date", "payment_amount", stays=True,
    ),
    "fact_carrier_claims": Fact(
        ("carrier_claims",), _typed_carrier_claims, "claim_id", "claim_key", "service_date", "payment_amount",
    ),
    "fact_prescriptions": Fact(
        ("prescription_drug_events",), _typed_prescriptions,
        "prescription_id", "prescription_key", "service_date", "total_cost",
    ),
}


def build_claims(
    inpatient: DataFrame, outpatient: DataFrame, method: str = "exact", settle: Settle = settled
) -> DataFrame:
    """Inpatient and outpatient files to one claim fact."""
    return FACTS["fact_claims"].build(inpatient, outpatient, method=method, settle=settle)


def build_carrier_claims(
    raw: DataFrame, method: str = "exact", settle: Settle = settled
) -> DataFrame:
    """Carrier (professional) claims to their fact."""
    return FACTS["fact_carrier_claims"].build(raw, method=method, settle=settle)


def build_prescriptions(
    raw: DataFrame, method: str = "exact", settle: Settle = settled
) -> DataFrame:
    """Prescription drug events to their fact."""
    return FACTS["fact_prescriptions"].build(raw, method=method, settle=settle)


def build_diagnosis_lookup(raw: DataFrame) -> DataFrame:
    """Landed diagnosis codes as a lookup for condition enrichment."""
    return raw.transform(conform.rename_columns, schemas.DIAGNOSIS)


def build_all(
    raw: Callable[[str], DataFrame], as_of: Column | None = None,
    method: str = "exact", settle: Settle = settled,
) -> dict[str, DataFrame]:
    """The five claims tables by name; ``raw`` gives the frame of a raw entity."""
    return {
        "dim_patient_cms": build_patients(raw("beneficiary_summary"), as_of),
        "dim_provider_cms": build_providers(raw("providers")),
        "fact_claims": build_claims(
            raw("inpatient_claims"), raw("outpatient_claims"), method, settle
        ),
        "fact_carrier_claims": build_carrier_claims(raw("carrier_claims"), method, settle),
        "fact_prescriptions": build_prescriptions(
            raw("prescription_drug_events"), method, settle
        ),
    }


def run(
    spark: SparkSession, landing: str, lake: str,
    as_of: Column | None = None, method: str = "exact",
) -> None:
    """Read the landing zone, build all claims tables and write them; the settled
    copies are removed at the end."""
    with stages_removed(spark):
        settling = Settling()
        tables = build_all(partial(read_raw_entity, spark, landing), as_of, method, settling)
        sources = dict(zip(FACTS, settling.rows, strict=True))
        for name, df in tables.items():
            write_clean(name, df, f"{lake.rstrip('/')}/{schemas.CLAIMS_LAKE[name][0]}", sources.get(name))
