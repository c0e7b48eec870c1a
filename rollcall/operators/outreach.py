"""Who to call: ranked list, mute period, lookups."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollcall.config import (
    OUTCOME_MOVED,
    OUTCOME_REMINDED,
    OUTCOME_UNREACHABLE,
    OUTCOME_VOICEMAIL,
    STATUS_CALLED,
    STATUS_UNREACHABLE,
)
from rollcall.functions.temporal import add_working_days, easter_day
from rollcall.operators.cleaning import on_day

# The outcomes that count as called, and the marks of the call list.
CALLED_OUTCOMES = (OUTCOME_REMINDED, OUTCOME_VOICEMAIL, OUTCOME_MOVED, OUTCOME_UNREACHABLE)
CALLED_MARK, NOT_CALLED_MARK = "🟢", "🔴"


@dataclass(frozen=True)
class Feast:
    """A yearly feast: a day of the year, or a number of days after Easter; ``before_sunday`` moves it off a Sunday by a day."""

    name: str
    month: int = 0
    day: int = 0
    after_easter: int | None = None
    before_sunday: bool = False
    first: int = 1
    last: int = 9999
    every: int = 1


# The public feasts of the Netherlands.
DUTCH_FEASTS = (
    Feast("Nieuwjaarsdag", 1, 1),
    Feast("Eerste paasdag", after_easter=0),
    Feast("Tweede paasdag", after_easter=1),
    Feast("Koninginnedag", 4, 30, before_sunday=True, first=1980, last=2013),
    Feast("Koningsdag", 4, 27, before_sunday=True, first=2014),
    Feast("Bevrijdingsdag", 5, 5, first=1990, every=5),
    Feast("Hemelvaartsdag", after_easter=39),
    Feast("Eerste pinksterdag", after_easter=49),
    Feast("Tweede pinksterdag", after_easter=50),
    Feast("Eerste kerstdag", 12, 25),
    Feast("Tweede kerstdag", 12, 26),
)


def feast_calendar(
    spark: SparkSession, first: int, last: int, feasts: Sequence[Feast] = DUTCH_FEASTS
) -> DataFrame:
    """(date, name) of all feasts of the years ``first`` to ``last``; a calendar for :func:`flag_holiday`."""
    year = F.col("year")
    days = []
    for feast in feasts:
        if feast.after_easter is not None:
            day = F.date_add(easter_day(year), feast.after_easter)
        else:
            day = F.make_date(year, F.lit(feast.month), F.lit(feast.day))
        if feast.before_sunday:
            day = F.date_sub(day, F.when(F.weekday(day) == 6, 1).otherwise(0))
        held = year.between(feast.first, feast.last) & ((year - feast.first) % feast.every == 0)
        days.append(F.struct(F.when(held, day).alias("date"), F.lit(feast.name).alias("name")))
    years = spark.range(first, last + 1).select(F.col("id").cast("int").alias("year"))
    return years.select(F.explode(F.array(*days)).alias("d")).select("d.*").where(F.col("date").isNotNull())


def flag_holiday(df: DataFrame, date_col: str, calendar: DataFrame) -> DataFrame:
    """Add ``holiday`` from a calendar of (date, name); null on ordinary days."""
    days = calendar.groupBy(F.col("date").alias("_day")).agg(F.min("name").alias("holiday"))
    return df.join(days, F.to_date(date_col) == F.col("_day"), "left").drop("_day")


def prediction_context(
    predictions: DataFrame,
    calls: DataFrame,
    requests: DataFrame,
    day: dt.date,
    patient: str | None = None,
) -> DataFrame:
    """Active predictions from a day on, with call status and scoring time."""
    live = predictions.where(F.col("active") & (F.col("start_time") >= F.lit(day)))
    if patient is not None:
        live = live.where(F.col("patient_id") == patient)
    status = calls.select(F.col("prediction_id").alias("id"), "call_status")
    scored = requests.select(F.col("id").alias("request_id"), "timestamp")
    return (
        live.join(status, "id", "left")
        .join(scored, "request_id", "left")
        .select(
            "id",
            "patient_id",
            "start_time",
            "clinic_name",
            "clinic_teleq_unit",
            "clinic_reception",
            "call_status",
            "timestamp",
        )
    )


def last_updated(context: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return context.groupBy(*by).agg(F.max("timestamp").alias("last_updated"))


def muted_pairs(
    predictions: DataFrame, calls: DataFrame, day: dt.date, months: float
) -> DataFrame:
    """(patient, clinic) pairs called in the mute period before the calling day."""
    # Half-even rounding, like the built-in of the driver language.
    length = round(months * 30.5)
    until = add_working_days(F.lit(day), -3)
    recent = calls.where(
        (F.col("timestamp") >= F.date_sub(until, length))
        & (F.col("timestamp") < until)
        & F.col("call_status").isin(STATUS_CALLED, STATUS_UNREACHABLE)
    ).select(F.col("prediction_id").alias("id"))
    return predictions.join(recent, "id", "left_semi").select("patient_id", "clinic_name").distinct()


def mute_anti(
    candidates: DataFrame,
    predictions: DataFrame,
    calls: DataFrame,
    day: dt.date,
    months: float,
) -> DataFrame:
    muted = muted_pairs(predictions, calls, day, months)
    return candidates.join(muted, ["patient_id", "clinic_name"], "left_anti")


def call_candidates(
    predictions: DataFrame, patients: DataFrame, day: dt.date, threshold: float
) -> DataFrame:
    """(patient, clinic) pairs to call for a day, with group and highest score."""
    people = patients.where(
        (F.col("treatment_group") >= 1) & (F.coalesce("opt_out", F.lit(0)) == 0)
    ).select(F.col("id").alias("patient_id"), "treatment_group")
    return (
        predictions.where(
            on_day("start_time", day) & F.col("active") & (F.col("prediction") >= threshold)
        )
        .join(people, "patient_id")
        .groupBy("patient_id", "treatment_group", "clinic_name")
        .agg(F.max("prediction").alias("score"))
    )


def call_list(
    predictions: DataFrame,
    patients: DataFrame,
    calls: DataFrame,
    day: dt.date,
    threshold: float = 0.1,
    months: float = 0,
) -> DataFrame:
    """Patients to call, best first: group upwards, then score downwards."""
    open_pairs = mute_anti(
        call_candidates(predictions, patients, day, threshold), predictions, calls, day, months
    )
    # A patient appears at the place of their first pair.
    first = open_pairs.groupBy("patient_id").agg(
        F.min(F.struct("treatment_group", (-F.col("score")).alias("_down"))).alias("_key")
    )
    return first.select(
        "patient_id",
        F.col("_key.treatment_group").alias("treatment_group"),
        (-F.col("_key._down")).alias("score"),
    ).orderBy("treatment_group", F.col("score").desc(), "patient_id")


def called_today(predictions: DataFrame, calls: DataFrame, today: dt.date) -> DataFrame:
    done = calls.where(
        F.col("call_outcome").isin(*CALLED_OUTCOMES) & on_day("timestamp", today)
    ).select(F.col("prediction_id").alias("id"))
    return predictions.where("active").join(done, "id", "left_semi").select("patient_id").distinct()


def uncalled(
    listed: DataFrame, predictions: DataFrame, calls: DataFrame, today: dt.date
) -> DataFrame:
    """The listed patients without an outcome today."""
    return listed.join(called_today(predictions, calls, today), "patient_id", "left_anti")


def first_uncalled(
    listed: DataFrame, predictions: DataFrame, calls: DataFrame, today: dt.date
) -> DataFrame:
    """The first listed patient without an outcome today, or no row."""
    return (
        uncalled(listed, predictions, calls, today)
        .orderBy("treatment_group", F.col("score").desc(), "patient_id")
        .limit(1)
    )


def phone_lookup(contacts: DataFrame, phone: str, listed: DataFrame) -> DataFrame:
    """Listed patients who have the number as any of their three phones."""
    hit = (
        (F.col("mobile_phone") == phone)
        | (F.col("home_phone") == phone)
        | (F.col("other_phone") == phone)
    )
    found = contacts.where(hit).select("patient_id").distinct()
    return found.join(listed.select("patient_id"), "patient_id", "left_semi")


def call_marker(df: DataFrame, called: str = CALLED_MARK, not_called: str = NOT_CALLED_MARK) -> DataFrame:
    done = F.col("call_status") == STATUS_CALLED
    return df.withColumn("calling_icon", F.when(done, called).otherwise(not_called))


def rank_by_score(predictions: DataFrame, key: str = "id") -> DataFrame:
    return predictions.orderBy(F.col("prediction").desc(), key)


def top_per_day(df: DataFrame, ts: str, score: str, key: str, k: int) -> DataFrame:
    """The k best rows of each date; mappers already keep only k rows per date."""
    per_day = W.partitionBy(F.to_date(ts)).orderBy(F.col(score).desc(), key)
    return df.withColumn("day_rank", F.row_number().over(per_day)).where(
        F.col("day_rank") <= k
    )
