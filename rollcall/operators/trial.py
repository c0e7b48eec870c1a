"""Stratified treatment assignment and its checks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.scalars import not_in
from rollcall.operators.binning import apply_bins, top_row
from rollcall.operators.ordering import ranked

OUTSIDE_TRIAL = 2


def join_known_groups(predictions: DataFrame, patients: DataFrame) -> DataFrame:
    """Add the treatment group a patient already has."""
    known = patients.select(F.col("id").alias("pseudo_id"), "treatment_group")
    return predictions.join(known, "pseudo_id", "left")


def merge_groups(known: DataFrame, new: DataFrame) -> DataFrame:
    """Full outer merge of patient groups; the known group comes first."""
    old = known.select("id", F.col("treatment_group").alias("_known"))
    fresh = new.select("id", F.col("treatment_group").alias("_new"))
    return old.join(fresh, "id", "full_outer").select(
        "id", F.coalesce("_known", "_new").alias("treatment_group")
    )


def start_bit(strata: Sequence[str], seed: int | None) -> Column:
    """0 or 1 per stratum, from a seeded hash; ``None`` always starts with 0."""
    if seed is None:
        return F.lit(0).cast("long")
    return F.pmod(F.xxhash64(*strata, F.lit(seed)), F.lit(2))


def alternate(
    df: DataFrame,
    strata: Sequence[str],
    score: str = "prediction",
    tie: Sequence[str] = ("APP_ID",),
    seed: int | None = 1337,
    out: str = "arm",
) -> DataFrame:
    """Alternate 0/1 down each stratum by descending score.

    A stratum can hold much of the table, so ranks come from a range sort.
    """
    order = [F.col(score).desc(), *[F.col(c) for c in tie]]
    placed = ranked(df, order, "_rank", strata)
    arm = F.pmod(F.col("_rank") + start_bit(strata, seed), F.lit(2)).cast("int")
    return placed.withColumn(out, arm).drop("_rank")


def treatment_groups(
    predictions: DataFrame,
    patients: DataFrame,
    edges: DataFrame,
    rct_clinics: Sequence[str] | None = None,
    tie: Sequence[str] = ("APP_ID",),
    seed: int | None = 1337,
) -> DataFrame:
    """Assign every prediction a treatment group.

    Known patients keep theirs, clinics outside the trial get 2, and new
    patients alternate within (agenda, score bin); a new patient with several
    appointments gets the most frequent arm (the smaller one on a tie).
    Rows without a bin take no part in the alternation.
    """
    if predictions.isEmpty():
        raise ValueError("no predictions to assign")
    grouped = join_known_groups(predictions, patients)
    if rct_clinics is not None:
        outside = not_in("clinic", list(rct_clinics))
        grouped = grouped.withColumn(
            "treatment_group",
            F.when(outside, F.lit(OUTSIDE_TRIAL)).otherwise(F.col("treatment_group")),
        )
    binned = apply_bins(grouped, edges, "hoofdagenda")
    new = F.col("treatment_group").isNull()
    drawn = alternate(
        binned.where(new & F.col("score_bin").isNotNull()).select(
            "pseudo_id", "hoofdagenda", "score_bin", "prediction", *tie
        ),
        ["hoofdagenda", "score_bin"],
        tie=tie,
        seed=seed,
    )
    # Only 0 and 1 are drawn, so the mode is a comparison of two counts.
    modes = drawn.groupBy("pseudo_id").agg(
        F.when(F.sum("arm") * 2 > F.count("arm"), 1).otherwise(0).alias("_mode")
    )
    group = F.coalesce(
        F.col("treatment_group").cast("int"),
        F.col("_mode"),
        F.raise_error(F.lit("a new patient has no score inside (0, 1]")).cast("int"),
    )
    return binned.join(modes, "pseudo_id", "left").select(
        *predictions.columns, "score_bin", group.alias("treatment_group")
    )


def group_violations(df: DataFrame, patient: str = "pseudo_id") -> DataFrame:
    """Patients with more than one treatment group or a missing one."""
    return (
        df.groupBy(patient)
        .agg(
            F.countDistinct("treatment_group").alias("n_groups"),
            F.count(F.when(F.col("treatment_group").isNull(), 1)).alias("n_missing"),
        )
        .where((F.col("n_groups") != 1) | (F.col("n_missing") > 0))
    )


def group_consistency(df: DataFrame, patient: str = "pseudo_id") -> DataFrame:
    """One row: how many patients there are, and how many break a rule."""
    per_patient = df.groupBy(patient).agg(
        F.countDistinct("treatment_group").alias("n_groups"),
        F.count(F.when(F.col("treatment_group").isNull(), 1)).alias("n_missing"),
    )
    return per_patient.agg(
        F.count(F.lit(1)).alias("patients"),
        F.count(F.when(F.col("n_groups") != 1, 1)).alias("not_one_group"),
        F.count(F.when(F.col("n_missing") > 0, 1)).alias("missing_group"),
    )


def strata_balance(
    df: DataFrame,
    first_per_patient: bool = False,
    by: Sequence[str] = ("hoofdagenda", "treatment_group", "score_bin"),
    tie: Sequence[str] = ("APP_ID",),
) -> DataFrame:
    """Rows per (agenda, arm, bin), for all rows or each patient's top row."""
    if first_per_patient:
        df = top_row(df, "pseudo_id", "prediction", tie)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def replay_assignment(
    predictions: DataFrame,
    edges: DataFrame,
    days: Sequence[dt.date],
    patients: DataFrame,
    tie: Sequence[str] = ("APP_ID",),
    seed: int | None = 1337,
) -> DataFrame:
    """Assign day by day, carrying each patient's group to later days.

    Equals the day-by-day loop without one: only the first day on which a
    patient has a bin can draw an arm, so all days alternate in one ranking with
    the day as a further stratum.
    """
    day = F.to_date("start")
    chosen = predictions.where(day.isin(list(days))) if days else predictions
    binned = apply_bins(join_known_groups(chosen, patients), edges, "hoofdagenda")
    binned = binned.withColumn("_day", day)
    unknown = F.col("treatment_group").isNull() & F.col("score_bin").isNotNull()
    debut = binned.where(unknown).groupBy("pseudo_id").agg(F.min("_day").alias("_day"))
    drawn = alternate(
        binned.where(unknown)
        .join(debut, ["pseudo_id", "_day"], "left_semi")
        .select("pseudo_id", "_day", "hoofdagenda", "score_bin", "prediction", *tie),
        ["_day", "hoofdagenda", "score_bin"],
        tie=tie,
        seed=seed,
    )
    modes = drawn.groupBy("pseudo_id").agg(
        F.when(F.sum("arm") * 2 > F.count("arm"), 1).otherwise(0).alias("_mode")
    )
    return binned.join(modes, "pseudo_id", "left").select(
        *predictions.columns,
        "score_bin",
        F.coalesce("treatment_group", "_mode").cast("int").alias("treatment_group"),
    )
