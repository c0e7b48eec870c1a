"""Model quality tables: AUC, curves, calibration, daily precision."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.scalars import right_closed_bin, share, uniform_edges
from rollcall.functions.temporal import month_start
from rollcall.operators.ordering import ranked, running_totals
from rollcall.operators.outreach import top_per_day

DAILY_KS = tuple(range(5, 155, 5))


def _by_score(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score: the only rows that get sorted."""
    return df.groupBy(*by, F.col(score).alias("score")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"),
        F.sum(1 - F.col(label).cast("long")).alias("neg"),
    )


def roc_auc(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve (rank sum, ties count half), per group."""
    counts = running_totals(
        _by_score(df, score, label, by), [F.col("score")], {"neg_up_to": "neg"}, by
    )
    below = (F.col("neg_up_to") - F.col("neg")).cast("double") + F.col("neg") / 2
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return counts.groupBy(*by).agg(
        F.try_divide(F.sum(F.col("pos").cast("double") * below), pairs).alias("auc"),
        F.sum(F.col("pos") + F.col("neg")).alias("n"),
    )


def _cumulative(df: DataFrame, score: str, label: str) -> DataFrame:
    return running_totals(
        _by_score(df, score, label), [F.col("score").desc()], {"tp": "pos", "fp": "neg"}
    )


def _class_totals(df: DataFrame, label: str) -> tuple[int, int]:
    row = df.agg(
        F.sum(F.col(label).cast("long")).alias("p"), F.count(F.lit(1)).alias("n")
    ).first()
    return row["p"] or 0, row["n"] - (row["p"] or 0)


def roc_points(
    df: DataFrame, score: str, label: str, drop_intermediate: bool = True
) -> DataFrame:
    """fpr and tpr per threshold, downwards, from (0, 0) at infinity.

    ``drop_intermediate`` leaves out points where the slope does not change; the first and the last
    stay.
    """
    positives, negatives = _class_totals(df, label)
    points = _cumulative(df, score, label)
    if drop_intermediate:
        placed = ranked(points, [F.col("score").desc()], "_rank")
        following = placed.select(
            (F.col("_rank") - 1).alias("_rank"),
            F.col("pos").alias("_next_pos"),
            F.col("neg").alias("_next_neg"),
        )
        turn = (
            (F.col("_rank") == 0)
            | F.col("_next_pos").isNull()
            | (F.col("pos") != F.col("_next_pos"))
            | (F.col("neg") != F.col("_next_neg"))
        )
        points = placed.join(following, "_rank", "left").where(turn)
    spark = df.sparkSession
    origin = spark.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.select(
        F.col("score").alias("threshold"),
        (F.col("fp") / F.lit(negatives)).alias("fpr"),
        (F.col("tp") / F.lit(positives)).alias("tpr"),
    ).unionByName(origin)


def pr_points(df: DataFrame, score: str, label: str) -> DataFrame:
    """Precision and recall per threshold, plus the closing point (1, 0)."""
    positives, _ = _class_totals(df, label)
    points = _cumulative(df, score, label).select(
        F.col("score").alias("threshold"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        (F.col("tp") / F.lit(positives)).alias("recall"),
    )
    closing = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return points.unionByName(closing)


def calibration(
    df: DataFrame, score: str, label: str, n_bins: int = 10, by: Sequence[str] = ()
) -> DataFrame:
    """Mean score and fraction of positives per non-empty uniform bin."""
    bucket = right_closed_bin(score, uniform_edges(n_bins)[1:-1])
    return df.groupBy(*by, bucket.alias("bucket")).agg(
        F.avg(score).alias("prob_pred"),
        F.avg(F.col(label).cast("double")).alias("prob_true"),
        F.count(F.lit(1)).alias("n"),
    )


def calibration_error(
    df: DataFrame, score: str, label: str, n_bins: int = 10, by: Sequence[str] = ()
) -> DataFrame:
    """Binned calibration error: the row-weighted gap between score and outcome."""
    bins = calibration(df, score, label, n_bins, by)
    gap = F.abs(F.col("prob_pred") - F.col("prob_true")) * F.col("n")
    return bins.groupBy(*by).agg(
        (F.sum(gap) / F.sum("n")).alias("ece"), F.sum("n").alias("n")
    )


#: Cells of the score grid, waves of the smoothed residual, and halvings of the width.
SMOOTH_CELLS, SMOOTH_WAVES, SMOOTH_HALVINGS = 256, 192, 12


def smoothed_calibration_error(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., smooth_ece, n): the smooth calibration error of Blasiok and Nakkiran (2023).

    The residuals label - score, smoothed over the scores by a Gaussian that is reflected at 0 and 1, have a mean absolute
    value that falls as the width grows; the error is the width that equals it. Residuals are summed on a grid (each shared
    by the two nearest cells). Reflected smoothing damps the grid's cosine waves, wave k by exp(-(pi k width)**2 / 2), so a group
    is one row of SMOOTH_WAVES numbers, and the width is found by halving an interval without another pass.

    Rows without a score or label are left out; scores beyond 0 and 1 count at the ends.
    """
    f = F.least(F.greatest(F.col(score).cast("double"), F.lit(0.0)), F.lit(1.0))
    rows = df.where(F.col(score).isNotNull() & F.col(label).isNotNull() & ~F.isnan(F.col(score).cast("double")))
    place = f * SMOOTH_CELLS
    cell = F.least(F.floor(place), F.lit(SMOOTH_CELLS - 1))
    gap = F.col(label).cast("double") - f
    shares = F.array(
        F.struct(cell.alias("cell"), ((1 - (place - cell)) * gap).alias("gap"), F.lit(1).alias("one")),
        F.struct((cell + 1).alias("cell"), ((place - cell) * gap).alias("gap"), F.lit(0).alias("one")),
    )
    cells = (
        rows.select(*by, F.explode(shares).alias("_s"))
        .groupBy(*by, F.col("_s.cell").alias("_cell"))
        .agg(F.sum("_s.gap").alias("_gap"), F.sum("_s.one").alias("_one"))
    )
    pairs = F.sort_array(F.collect_list(F.struct("_cell", "_gap")))
    # One row a group, with at most SMOOTH_CELLS + 1 cells.
    held = cells.groupBy(*by).agg(pairs.alias("_cells"), F.sum("_one").alias("n"))
    waves, points = F.sequence(F.lit(0), F.lit(SMOOTH_WAVES)), F.sequence(F.lit(0), F.lit(SMOOTH_CELLS))

    def wave(k: Column) -> Column:
        total = F.aggregate(
            F.col("_cells"),
            F.lit(0.0),
            lambda s, c: s + c["_gap"] * F.cos(k * c["_cell"] * (math.pi / SMOOTH_CELLS)),
        )
        return F.when(k == 0, total).otherwise(2 * total) / F.col("n")

    def error(width: Column) -> Column:
        damped = F.transform(F.col("_waves"), lambda a, k: a * F.exp(-F.pow(k * width * math.pi, F.lit(2.0)) / 2))

        def mean_height(d: Column) -> Column:
            def height(t: Column) -> Column:
                parts = F.transform(d, lambda a, k: a * F.cos(k * t * (math.pi / SMOOTH_CELLS)))
                return F.abs(F.aggregate(parts, F.lit(0.0), lambda s, x: s + x))

            # The ends of the grid count half.
            weight = lambda t: F.when((t == 0) | (t == SMOOTH_CELLS), 0.5).otherwise(1.0)
            return F.aggregate(points, F.lit(0.0), lambda s, t: s + weight(t) * height(t)) / SMOOTH_CELLS

        # The one-element array binds the damped waves once.
        return F.get(F.transform(F.array(damped), mean_height), F.lit(0))

    def halve(state: Column, _: Column) -> Column:
        middle = (state["low"] + state["high"]) / 2
        above = error(middle) > middle
        return F.struct(
            F.when(above, middle).otherwise(state["low"]).alias("low"),
            F.when(above, state["high"]).otherwise(middle).alias("high"),
        )

    waved = held.withColumn("_waves", F.transform(waves, wave))
    start = F.struct(F.lit(0.0).alias("low"), F.lit(1.0).alias("high"))
    width = F.aggregate(
        F.sequence(F.lit(1), F.lit(SMOOTH_HALVINGS)), start, halve, lambda s: (s["low"] + s["high"]) / 2
    )
    return waved.select(*by, width.alias("smooth_ece"), "n")


def _key_hash(key: str, seed: int) -> Column:
    """Hex digits that order keys at random, the same in any engine that has md5."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))


def monthly_auc(
    df: DataFrame,
    score: str,
    label: str,
    asof: dt.date,
    ts: str = "start",
    key: str | None = None,
    fraction: float | None = None,
    seed: int = 0,
) -> DataFrame:
    """AUC per complete month; optionally on a reproducible sample by key hash."""
    rows = df.where(F.col(ts) < F.lit(asof.replace(day=1)))
    if fraction is not None:
        if fraction < 1:
            rows = rows.where(_key_hash(key, seed) < f"{int(fraction * 2**32):08x}")
    return roc_auc(rows.withColumn("month", month_start(ts)), score, label, ["month"])


def auc_summary(per_month: DataFrame) -> DataFrame:
    return per_month.agg(
        F.avg("auc").alias("mean_auc"),
        F.min("auc").alias("min_auc"),
        F.max("auc").alias("max_auc"),
        F.count(F.lit(1)).alias("months"),
    )


def daily_top_k(
    df: DataFrame,
    ts: str,
    score: str,
    label: str,
    key: str,
    ks: Sequence[int] = DAILY_KS,
) -> DataFrame:
    """Mean and deviation over weekdays of precision and recall at the k best rows.

    A day without positives has recall 0.  Only the best ``max(ks)`` rows of a day
    are ever ranked; day totals are plain counts.
    """
    weekdays = df.where(F.weekday(ts) < 5).select(ts, score, label, key)
    totals = weekdays.groupBy(F.to_date(ts).alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col(label).cast("long")).alias("positives")
    )
    hits = (
        top_per_day(weekdays, ts, score, key, max(ks))
        .groupBy(F.to_date(ts).alias("day"))
        .agg(
            F.array(
                *[
                    F.sum(F.when(F.col("day_rank") <= k, F.col(label)).otherwise(0)).cast("long")
                    for k in ks
                ]
            ).alias("_hits")
        )
    )
    per_day = totals.join(hits, "day").select(
        "day",
        "rows",
        "positives",
        F.posexplode(F.arrays_zip(F.array(*[F.lit(k) for k in ks]).alias("k"), F.col("_hits"))),
    )
    k, found = F.col("col.k"), F.col("col._hits")
    daily = per_day.select(
        k.alias("k"),
        (found / F.least(k, F.col("rows"))).alias("precision"),
        share(found, F.col("positives")).alias("recall"),
    )
    return daily.groupBy("k").agg(
        F.avg("precision").alias("mean_precision"),
        F.stddev_pop("precision").alias("std_precision"),
        F.avg("recall").alias("mean_recall"),
        F.stddev_pop("recall").alias("std_recall"),
        F.count(F.lit(1)).alias("days"),
    )


def daily_top_k_random(
    df: DataFrame, ts: str, label: str, key: str, seed: int = 0, ks: Sequence[int] = DAILY_KS
) -> DataFrame:
    """The same figures for a seeded random order: the baseline."""
    shuffled = df.withColumn("_shuffle", _key_hash(key, seed))
    return daily_top_k(shuffled, ts, "_shuffle", label, key, ks)
