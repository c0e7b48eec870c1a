"""The feature table: history, distance, calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.scalars import clamp, haversine_km, share
from rollcall.functions.temporal import (
    DAY_US,
    MINUTE_US,
    floor_days,
    micros,
    weekday_monday0,
)
from rollcall.operators.timeline import Lagged, Previous, SameDay, Trailing, with_history
from rollcall.schema import FEATURE_COLUMNS

ENTITY, START = "pseudo_id", "start"
LEAK_GUARD_US = 3 * DAY_US
FEATURE_INPUTS = (
    ENTITY,
    START,
    "APP_ID",
    "missed",
    "created",
    "gearriveerd",
    "minutesDuration",
    "BIRTH_YEAR",
    "address_postalCodeNumbersNL",
)


def lagged_cumulative(
    df: DataFrame,
    value: str,
    out: str,
    exclude_us: int = LEAK_GUARD_US,
    func: str = "sum",
    chunk_us: int | None = None,
) -> DataFrame:
    """Sum or count over a patient's rows that are at least ``exclude_us`` old."""
    return with_history(
        df, ENTITY, START, [Lagged(out, value, exclude_us, func)], chunk_us
    )


def add_missed_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("_missed", (F.col("missed") == "missed").cast("long"))


def _early_us(cutoff: float) -> Column:
    """Microseconds between arrival and start; whole numbers add up exactly."""
    limit = int(cutoff * MINUTE_US)
    early = F.coalesce(micros(START) - micros("gearriveerd"), F.lit(0).cast("long"))
    return clamp(early, F.lit(-limit).cast("long"), F.lit(limit).cast("long"))


def add_minutes_early(df: DataFrame, cutoff: float = 60) -> DataFrame:
    """Minutes between arrival and start; 0 without arrival, limited to ±cutoff."""
    return df.withColumn("minutes_early", _early_us(cutoff) / F.lit(float(MINUTE_US)))


def prev_missed_features(
    df: DataFrame, chunk_us: int | None = None, stage: bool = False
) -> DataFrame:
    specs = [
        Lagged("prev_missed", "_missed", LEAK_GUARD_US),
        Lagged("earlier_appointments", "missed", LEAK_GUARD_US, "count"),
    ]
    out = with_history(add_missed_flag(df), ENTITY, START, specs, chunk_us, stage)
    return _add_missed_share(out.drop("_missed"))


def _add_missed_share(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "prev_missed_share", share(F.col("prev_missed"), F.col("earlier_appointments"))
    )


def add_prev_minutes_early(
    df: DataFrame, cutoff: float = 60, chunk_us: int | None = None
) -> DataFrame:
    """Mean minutes early over earlier appointments, given their count."""
    ready = add_minutes_early(df, cutoff).withColumn("_early_us", _early_us(cutoff))
    spec = Lagged("_early_sum", "_early_us", LEAK_GUARD_US)
    return _add_early_mean(with_history(ready, ENTITY, START, [spec], chunk_us))


def _add_early_mean(df: DataFrame) -> DataFrame:
    minutes = F.col("_early_sum") / F.lit(float(MINUTE_US))
    return df.withColumn(
        "prev_minutes_early", share(minutes, F.col("earlier_appointments"))
    ).drop("_early_sum", "_early_us")


def appointments_last_days(
    df: DataFrame, days: int = 14, chunk_us: int | None = None
) -> DataFrame:
    spec = Trailing("appointments_last_days", "APP_ID", days * DAY_US)
    return with_history(df, ENTITY, START, [spec], chunk_us)


def appointments_same_day(
    df: DataFrame, chunk_us: int | None = None, stage: bool = False
) -> DataFrame:
    spec = SameDay("appointments_same_day", "APP_ID")
    return with_history(df, ENTITY, START, [spec], chunk_us, stage)


def days_since_last(df: DataFrame, chunk_us: int | None = None, stage: bool = False) -> DataFrame:
    out = with_history(df, ENTITY, START, [Previous("_previous")], chunk_us, stage)
    return _add_days_since_last(out)


def _add_days_since_last(df: DataFrame) -> DataFrame:
    days = F.coalesce(floor_days(START, "_previous"), F.lit(0))
    return df.withColumn("days_since_last_appointment", days).drop("_previous")


def add_days_since_created(df: DataFrame) -> DataFrame:
    """Whole days between creation and start; late creation counts as 0."""
    days = floor_days(START, "created")
    return df.withColumn(
        "days_since_created", F.when(days < 0, F.lit(0).cast("long")).otherwise(days)
    )


def add_time_features(df: DataFrame) -> DataFrame:
    return df.withColumns({"weekday": weekday_monday0(START), "hour": F.hour(START)})


def add_age(df: DataFrame) -> DataFrame:
    return df.withColumn("age", F.year(START) - F.col("BIRTH_YEAR"))


def add_patient_features(df: DataFrame, postal: DataFrame) -> DataFrame:
    """Distance and age.  Appointments without a known postal code are dropped,
    so this comes after everything that looks at the history."""
    places = postal.select(
        F.col("postalcode").alias("address_postalCodeNumbersNL"),
        haversine_km("latitude", "longitude").alias("dist_hospital"),
    )
    located = df.join(places, "address_postalCodeNumbersNL")
    return add_age(located.select(*df.columns, "dist_hospital"))


def create_features(
    df: DataFrame,
    postal: DataFrame,
    last_days: int = 14,
    minutes_cutoff: float = 60,
    chunk_us: int | None = None,
    stage: bool = True,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """All features in one pass over each patient's timeline.

    ``keep`` limits the columns carried along to those and the feature inputs,
    which makes the one wide shuffle narrower.  ``stage=False`` saves a write when
    the input already is a stored table.
    """
    if keep is not None:
        wanted = {*FEATURE_INPUTS, *keep}
        df = df.select(*[c for c in df.columns if c in wanted])
    ready = add_minutes_early(add_missed_flag(df), minutes_cutoff).withColumn(
        "_early_us", _early_us(minutes_cutoff)
    )
    specs = [
        Lagged("prev_missed", "_missed", LEAK_GUARD_US),
        Lagged("earlier_appointments", "missed", LEAK_GUARD_US, "count"),
        Lagged("_early_sum", "_early_us", LEAK_GUARD_US),
        Trailing("appointments_last_days", "APP_ID", last_days * DAY_US),
        SameDay("appointments_same_day", "APP_ID"),
        Previous("_previous"),
    ]
    history = with_history(ready, ENTITY, START, specs, chunk_us, stage).drop("_missed")
    out = _add_days_since_last(_add_early_mean(_add_missed_share(history)))
    return add_patient_features(add_time_features(add_days_since_created(out)), postal)


def select_feature_columns(df: DataFrame) -> DataFrame:
    return df.select(ENTITY, START, *FEATURE_COLUMNS)


def filter_to_score(features: DataFrame, start_date) -> DataFrame:
    """Planned appointments from a date on.  Only valid above the history step."""
    return features.where(
        (F.col("status") == "planned") & (F.col(START) >= F.lit(start_date))
    )
