"""Clinic rules and job settings."""

from __future__ import annotations

import tomllib
from collections.abc import Sequence
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Mutation codes that mark a missed appointment.
MISSED_CODES = ("N", "0000000012", "0000000013")

# Words stored in the call tables.
STATUS_NOT_CALLED = "Niet gebeld"
STATUS_CALLING = "Wordt gebeld"
STATUS_CALLED = "Gebeld"
STATUS_UNREACHABLE = "Onbereikbaar"
OUTCOME_REMINDED = "Herinnerd"
OUTCOME_VOICEMAIL = "Voicemail ingesproken"
OUTCOME_MOVED = "Verzet/Geannuleerd"
OUTCOME_UNREACHABLE = "Onbereikbaar"
OUTCOME_NONE = "Geen"
OUTCOME_NOT_CALLED = "Niet gebeld"
OUTCOME_DO_NOT_CALL = "Bel me niet"
UNKNOWN_LOCATION = "Onbekend"
PHONE_CONSULT = "Telefonisch"


@dataclass(frozen=True)
class ClinicRule:
    """Which appointments belong to a clinic.  An empty list does not filter."""

    name: str
    main_agenda_codes: Sequence[str]
    include_rct: bool = True
    phone_number: str = ""
    teleq_name: str = ""
    subagenda_exclude: bool = False
    subagendas: Sequence[str] = ()
    appcode_exclude: bool = False
    appcodes: Sequence[str] = ()


@dataclass(frozen=True)
class Settings:
    missed_codes: Sequence[str] = MISSED_CODES
    minutes_early_cutoff: int = 60
    appointments_last_days: int = 14
    mute_period: float = 0
    keep_sensitive_data: int = 14
    prediction_threshold: float = 0.1
    clinics: Sequence[ClinicRule] = field(default_factory=tuple)

    @property
    def rct_clinics(self) -> list[str]:
        return [rule.name for rule in self.clinics if rule.include_rct]


def load_settings(path: str | Path) -> Settings:
    """Read settings from a TOML file with one ``[clinic.<name>]`` table each."""
    with Path(path).open("rb") as handle:
        raw = tomllib.load(handle)
    flat: dict = {}
    for section in ("preprocess", "feature_building", "dashboard"):
        flat.update(raw.get(section, {}))
    clinics = tuple(
        ClinicRule(name=name, **rule) for name, rule in raw.get("clinic", {}).items()
    )
    return Settings(clinics=clinics, **flat)


RULES_SCHEMA = T.StructType(
    [
        T.StructField("clinic_ord", T.IntegerType(), False),
        T.StructField("clinic", T.StringType(), False),
        T.StructField("include_rct", T.BooleanType(), False),
        T.StructField("phone_number", T.StringType(), False),
        T.StructField("teleq_name", T.StringType(), False),
        T.StructField("main_agenda_codes", T.ArrayType(T.StringType(), False), False),
        T.StructField("subagenda_exclude", T.BooleanType(), False),
        T.StructField("subagendas", T.ArrayType(T.StringType(), False), False),
        T.StructField("appcode_exclude", T.BooleanType(), False),
        T.StructField("appcodes", T.ArrayType(T.StringType(), False), False),
    ]
)


def rules_frame(spark: SparkSession, rules: Sequence[ClinicRule]) -> DataFrame:
    """The rules as a DataFrame: one row per clinic, a hand-written list."""
    rows = [
        (
            position,
            rule.name,
            rule.include_rct,
            rule.phone_number,
            rule.teleq_name,
            list(rule.main_agenda_codes),
            rule.subagenda_exclude,
            list(rule.subagendas),
            rule.appcode_exclude,
            list(rule.appcodes),
        )
        for position, rule in enumerate(rules)
    ]
    return spark.createDataFrame(rows, RULES_SCHEMA)
