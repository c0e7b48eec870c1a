"""Extraction from the source tables: star join, eligibility, cohorts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.scalars import pseudonymize
from rollcall.functions.temporal import birth_year, minute_boundaries

# Exclusions of the extract.
EXCLUDED_STATUS = ("planned", "in-progress")
EXCLUDED_TYPE2 = ("T", "S", "M")
EXCLUDED_CODES = ("FAMF", "FAMT", "FAMS")
PHONE_PATTERNS = ("%telefo%", "tc%")


def star_extract(
    encounter: DataFrame,
    subagenda: DataFrame,
    agenda: DataFrame,
    patient: DataFrame,
    address: DataFrame,
    location: DataFrame,
) -> DataFrame:
    """Join encounters to their agendas, patient, address and location.

    Keys are (system, value) pairs, except the address, which names its parent
    patient by value only.  Agendas, patient: inner; location, address: left.
    The size of each dimension decides at run time whether it is broadcast.
    """
    parent = agenda.select(
        F.col("system").alias("parent_system"),
        F.col("value").alias("parent_value"),
        F.col("name").alias("hoofdagenda"),
        F.col("active").alias("agenda_active"),
    )
    child = subagenda.select(
        F.col("system").alias("subagenda_system"),
        F.col("value").alias("subagenda_id"),
        F.col("name").alias("subagenda"),
        "specialty_code",
        F.col("active").alias("subagenda_active"),
        "parent_system",
        "parent_value",
    )
    agendas = child.join(parent, ["parent_system", "parent_value"])
    people = patient.select(
        F.col("system").alias("patient_system"),
        F.col("value").alias("patient_value"),
        F.col("birth_date"),
        F.col("deceased"),
    )
    addresses = address.select(
        F.col("parent_value").alias("patient_value"),
        F.col("postal_code"),
        F.col("active").alias("address_active"),
    )
    places = location.select(
        F.col("system").alias("location_system"),
        F.col("value").alias("location_value"),
        F.col("name").alias("name"),
        F.col("description").alias("description"),
    )
    return (
        encounter.join(agendas, ["subagenda_system", "subagenda_id"])
        .join(people, ["patient_system", "patient_value"])
        .join(places, ["location_system", "location_value"], "left")
        .join(addresses, "patient_value", "left")
    )


def to_appointment(df: DataFrame, salt: str, keep: Sequence[str] = ()) -> DataFrame:
    """Project a joined extract to the appointment columns; no plain patient id.

    ``keep`` names further columns to carry along.
    """
    return df.select(
        "APP_ID",
        pseudonymize("patient_value", salt).alias("pseudo_id"),
        "hoofdagenda",
        F.col("parent_value").alias("hoofdagenda_id"),
        "subagenda_id",
        "specialty_code",
        "soort_consult",
        "afspraak_code",
        "start",
        "end",
        "gearriveerd",
        "created",
        minute_boundaries("start", "end").alias("minutesDuration"),
        "status",
        "status_code_original",
        "mutationReason_code",
        "mutationReason_display",
        birth_year("birth_date").alias("BIRTH_YEAR"),
        F.col("postal_code").alias("address_postalCodeNumbersNL"),
        "name",
        "description",
        *keep,
    )


def _common_exclusions() -> Column:
    """SQL predicates as written in a WHERE clause: missing values drop out."""
    keep = (
        ~F.col("type2_code").isin(*EXCLUDED_TYPE2)
        & ~F.col("type1_code").isin(*EXCLUDED_CODES)
        & (F.col("without_patient") != 1)
    )
    for pattern in PHONE_PATTERNS:
        keep &= ~F.col("type1_display").ilike(pattern)
    return keep


def _living_with_address() -> Column:
    return (F.col("deceased") == 0) & (F.col("address_active") == 1)


def from_system(df: DataFrame, system: str | None) -> DataFrame:
    """Rows whose ``identifier_system`` is the given source system; all rows if none is given."""
    return df if system is None else df.where(F.col("identifier_system") == system)


def filter_eligible(
    df: DataFrame, asof: dt.datetime, years: int = 8, system: str | None = None
) -> DataFrame:
    """Finished past appointments of the last ``years`` years, of one source system if given."""
    since = F.add_months(F.to_date(F.lit(asof)), -12 * years)
    return from_system(df, system).where(
        (F.col("start") >= since)
        & (F.col("end") < F.lit(asof))
        & ~F.col("status").isin(*EXCLUDED_STATUS)
        & _common_exclusions()
        & _living_with_address()
    )


def filter_prediction_window(
    df: DataFrame, asof: dt.date, days: int = 14, years: int = 8, system: str | None = None
) -> DataFrame:
    """Past and planned appointments up to midnight ``days`` days ahead, of one source system if given."""
    since = F.add_months(F.lit(asof), -12 * years)
    until = asof + dt.timedelta(days=days)
    return from_system(df, system).where(
        (F.col("start") >= since)
        & (F.col("start") <= F.lit(until))
        & _common_exclusions()
        & _living_with_address()
    )


def filter_trial_cohort(
    df: DataFrame,
    agendas: Sequence[str],
    coded_agendas: Sequence[str],
    codes: Sequence[str],
    first: dt.date,
    last: dt.date,
) -> DataFrame:
    """Agendas taken whole, or only for some codes, between two midnights."""
    agenda = F.col("hoofdagenda_id")
    member = agenda.isin(list(agendas)) | (
        agenda.isin(list(coded_agendas)) & F.col("afspraak_code").isin(list(codes))
    )
    return df.where(
        member & (F.col("start") >= F.lit(first)) & (F.col("start") <= F.lit(last))
    )


def left_filtered(left: DataFrame, right: DataFrame, key: str, keep: Column) -> DataFrame:
    """Left join whose filter on the right side makes it an inner join."""
    return left.join(right, key, "left").where(keep)


def active_patient_history(
    df: DataFrame, day: dt.date, strict: bool = False
) -> DataFrame:
    """Full history of patients with a planned appointment on ``day``.

    The source query tests the appointment code of the outer row where it means
    the inner one.  That is kept; ``strict`` also tests the inner row.
    """
    keep_code = ~F.col("type1_code").isin(*EXCLUDED_CODES)
    planned = (
        (F.col("start") >= F.lit(day))
        & (F.col("start") < F.lit(day + dt.timedelta(days=1)))
        & (F.col("status") == "planned")
        & ~F.col("type2_code").isin(*EXCLUDED_TYPE2)
        & (F.col("without_patient") != 1)
    )
    for pattern in PHONE_PATTERNS:
        planned &= ~F.col("type1_display").ilike(pattern)
    if strict:
        planned &= keep_code
    active = df.where(planned).select("patient_value").distinct()
    return df.where(keep_code).join(active, "patient_value", "left_semi")


def not_in_rows(df: DataFrame, other: DataFrame, key: str, other_key: str) -> DataFrame:
    """SQL ``NOT IN`` on keys that are never missing, as a shuffled anti join."""
    excluded = other.select(F.col(other_key).alias(key)).distinct()
    return df.join(excluded, key, "left_anti")
