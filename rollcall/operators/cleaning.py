"""Clinic rules, labels, filters and deduplication."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollcall.config import MISSED_CODES, PHONE_CONSULT, ClinicRule, rules_frame
from rollcall.functions.scalars import differs_from, not_in

_RULE_FIELDS = ["subagenda_exclude", "subagendas", "appcode_exclude", "appcodes"]


def apply_clinic_rules(df: DataFrame, rules: Sequence[ClinicRule]) -> DataFrame:
    """Tag each appointment with every clinic whose rule it meets.

    One pass: agenda codes are unfolded into an equi-join (hash, broadcast: the
    rules are a hand-written list), the include/exclude lists are filters on top.
    """
    codes = rules_frame(df.sparkSession, rules).select(
        "clinic",
        "clinic_ord",
        *_RULE_FIELDS,
        F.explode(F.array_distinct("main_agenda_codes")).alias("_code"),
    )
    tagged = df.join(F.broadcast(codes), df["hoofdagenda_id"] == codes["_code"])
    return tagged.where(
        _list_passes("subagenda_id", "subagendas", "subagenda_exclude")
        & _list_passes("afspraak_code", "appcodes", "appcode_exclude")
    ).select(*[df[c] for c in df.columns], "clinic", "clinic_ord")


def _list_passes(value: str, items: str, exclude: str) -> Column:
    listed = F.coalesce(F.array_contains(items, F.col(value)), F.lit(False))
    return (F.size(items) == 0) | F.when(F.col(exclude), ~listed).otherwise(listed)


def union_clinics(df: DataFrame, rules: Sequence[ClinicRule]) -> DataFrame:
    """Same rows as :func:`apply_clinic_rules`, written as a union of slices."""
    slices = []
    for position, rule in enumerate(rules):
        keep = F.col("hoofdagenda_id").isin(list(rule.main_agenda_codes))
        for column, items, exclude in (
            ("subagenda_id", rule.subagendas, rule.subagenda_exclude),
            ("afspraak_code", rule.appcodes, rule.appcode_exclude),
        ):
            if items:
                keep &= not_in(column, items) if exclude else F.col(column).isin(list(items))
        slices.append(
            df.where(keep).select(
                "*", F.lit(rule.name).alias("clinic"), F.lit(position).alias("clinic_ord")
            )
        )
    whole = slices[0]
    for part in slices[1:]:
        whole = whole.unionByName(part)
    return whole


def cohort_by_date(
    df: DataFrame, day: dt.date, entity: str = "pseudo_id", ts: str = "start"
) -> DataFrame:
    """All rows of entities that have a row on ``day``."""
    present = df.where(on_day(ts, day)).select(entity).distinct()
    return df.join(present, entity, "left_semi")


def on_day(ts: str, day: dt.date) -> Column:
    """Half-open range instead of a cast, so that the scan can use it."""
    return (F.col(ts) >= F.lit(day)) & (F.col(ts) < F.lit(day + dt.timedelta(days=1)))


def label_missed(df: DataFrame, codes: Sequence[str] = MISSED_CODES) -> DataFrame:
    missed = F.col("mutationReason_code").isin(list(codes))
    return df.withColumn("missed", F.when(missed, "missed").otherwise("attended"))


def drop_moved_and_cancelled(
    df: DataFrame, observation: Observation | None = None
) -> DataFrame:
    """Drop missed visits that are finished, and cancellations that are not missed.

    With an :class:`Observation` the dropped rows are counted during the same
    pass, as ``moved`` and ``cancelled``.
    """
    missed = F.col("missed") == "missed"
    moved = F.coalesce(missed & (F.col("status") == "finished"), F.lit(False))
    cancelled = F.coalesce(~missed & (F.col("status") == "cancelled"), F.lit(False))
    if observation is not None:
        df = df.observe(
            observation,
            F.count(F.when(moved, 1)).alias("moved"),
            F.count(F.when(cancelled, 1)).alias("cancelled"),
        )
    return df.where(~moved & ~cancelled)


def drop_null_start_and_phone(df: DataFrame) -> DataFrame:
    return df.where(F.col("start").isNotNull() & differs_from("soort_consult", PHONE_CONSULT))


def dedup_ignoring(
    df: DataFrame, ignored: Sequence[str], order: str, skip: Sequence[str] = ()
) -> DataFrame:
    """Keep the first of the rows that agree in all columns but ``ignored``.

    ``skip`` names helper columns that do not count as data (such as the order). A partitioning by any of the
    compared columns serves the window, so rows that already lie together are not shuffled again.
    """
    helpers = set(ignored) | set(skip) | {order}
    keys = [c for c in df.columns if c not in helpers]
    return _first_row(df, W.partitionBy(*keys).orderBy(order))


def dedup_keep_last(
    df: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """One row per key: the one that comes last in ``order``."""
    return _first_row(df, W.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order]))


def _first_row(df: DataFrame, window: WindowSpec) -> DataFrame:
    return df.withColumn("_nth", F.row_number().over(window)).where("_nth = 1").drop("_nth")


def clean_appointments(
    df: DataFrame,
    rules: Sequence[ClinicRule],
    order: str,
    codes: Sequence[str] = MISSED_CODES,
    day: dt.date | None = None,
    observation: Observation | None = None,
) -> DataFrame:
    """Rules, cohort, label, filters and both deduplications, in that order.

    Patient and start are part of both deduplications' keys: one shuffle by them serves both.
    """
    tagged = apply_clinic_rules(df, rules)
    if day is not None:
        tagged = cohort_by_date(tagged, day)
    labelled = drop_moved_and_cancelled(label_missed(tagged, codes), observation)
    # Cheap filters first: they commute with the variant dedup, which compares
    # whole rows and so never mixes rows the filters would treat differently.
    present = drop_null_start_and_phone(labelled).repartition("pseudo_id", "start")
    single = dedup_ignoring(
        present, ["address_postalCodeNumbersNL"], order, skip=["clinic_ord"]
    )
    return dedup_keep_last(single, ["pseudo_id", "start"], ["clinic_ord", order]).drop(
        "clinic_ord"
    )
