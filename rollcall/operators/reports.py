"""KPI, monitoring, trial and exploratory tables."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.config import (
    OUTCOME_DO_NOT_CALL,
    OUTCOME_MOVED,
    OUTCOME_NONE,
    OUTCOME_NOT_CALLED,
    OUTCOME_REMINDED,
    OUTCOME_UNREACHABLE,
    OUTCOME_VOICEMAIL,
    STATUS_NOT_CALLED,
)
from rollcall.functions.scalars import differs_from
from rollcall.functions.temporal import month_start
from rollcall.operators.binning import qcut

LABELS = ("missed", "attended")
# The sets of outcomes that the reports count.
KPI_OUTCOMES = {
    "called": (OUTCOME_REMINDED, OUTCOME_MOVED, OUTCOME_UNREACHABLE, OUTCOME_VOICEMAIL),
    "reached": (OUTCOME_REMINDED, OUTCOME_MOVED),
    "reminded": (OUTCOME_REMINDED,),
    "moved": (OUTCOME_MOVED,),
}
OPT_OUT_OUTCOMES = (
    OUTCOME_REMINDED,
    OUTCOME_MOVED,
    OUTCOME_NONE,
    OUTCOME_DO_NOT_CALL,
    OUTCOME_VOICEMAIL,
    OUTCOME_UNREACHABLE,
)
PLOTTED_OUTCOMES = (OUTCOME_REMINDED, OUTCOME_MOVED, OUTCOME_VOICEMAIL, OUTCOME_UNREACHABLE)


def within_days(ts: str, first: dt.date, last: dt.date) -> Column:
    """Both dates included, as a half-open range on the raw column."""
    return (F.col(ts) >= F.lit(first)) & (F.col(ts) < F.lit(last + dt.timedelta(days=1)))


# --- joined bases -----------------------------------------------------------


def kpi_base(
    predictions: DataFrame, calls: DataFrame, patients: DataFrame, first: dt.date, last: dt.date
) -> DataFrame:
    """Predictions of trial patients in a period, with call status and opt-out."""
    answers = calls.select(F.col("prediction_id").alias("id"), "call_status", "call_outcome")
    people = patients.select(F.col("id").alias("patient_id"), "opt_out", "treatment_group")
    return (
        predictions.where(within_days("start_time", first, last))
        .join(answers, "id", "left")
        .join(people, "patient_id", "left")
        .where(F.col("treatment_group") >= 1)
        .select("id", "start_time", "clinic_name", "call_status", "call_outcome", "opt_out")
    )


def monitoring_base(
    predictions: DataFrame, requests: DataFrame, patients: DataFrame, first: dt.date, last: dt.date
) -> DataFrame:
    """Requests in a period with the predictions they made for trial patients."""
    asked = requests.where(within_days("timestamp", first, last)).select(
        F.col("id").alias("request_id"), "timestamp", "api_version", "response_code", "runtime"
    )
    people = patients.where(F.col("treatment_group") >= 1).select(F.col("id").alias("patient_id"))
    return (
        predictions.join(asked, "request_id")
        .join(people, "patient_id", "left_semi")
        .select(
            "id", "timestamp", "api_version", "response_code", "runtime", "prediction", "clinic_name"
        )
    )


def called_cohort(predictions: DataFrame, calls: DataFrame) -> DataFrame:
    answers = calls.select(
        F.col("prediction_id").alias("id"), "call_status", "call_outcome", "timestamp"
    )
    return predictions.join(answers, "id")


def trial_combine(
    predictions: DataFrame, calls: DataFrame, patients: DataFrame, outcomes: DataFrame
) -> DataFrame:
    """Predictions of trial patients with calls and the exported outcome.

    Only group 2 is left out; a missing group stays in.
    """
    answers = calls.select(
        F.col("prediction_id").alias("id"), "call_status", "call_outcome", "timestamp"
    )
    people = patients.select(F.col("id").alias("patient_id"), "treatment_group")
    exported = outcomes.select(F.col("APP_ID").alias("id"), "start", "outcome")
    return (
        predictions.select("id", "patient_id", "prediction", "start_time", "clinic_name")
        .join(answers, "id", "left")
        .join(people, "patient_id", "left")
        .where(differs_from("treatment_group", 2))
        .join(exported, "id", "left")
    )


def feature_cohort(features: DataFrame, not_called: DataFrame) -> DataFrame:
    """Features of the appointments of patients who were not called."""
    ids = not_called.select(F.col("appointment_id").cast("long").alias("APP_ID")).distinct()
    return features.join(ids, "APP_ID", "left_semi")


# --- row labels -------------------------------------------------------------


def trial_outcome(df: DataFrame) -> DataFrame:
    """Outcome from the codes; an attended visit overrides a missed code."""
    attended = F.col("status_code_original") == "J"
    missed = F.col("mutationReason_code") == "N"
    return df.withColumn("outcome", F.when(attended, "Attended").when(missed, "Missed"))


def flag_moved(df: DataFrame) -> DataFrame:
    """The predicted and the actual start differ; no actual start counts as moved."""
    same = F.coalesce(F.col("start_time") == F.col("start"), F.lit(False))
    return df.withColumn("app_moved", ~same)


def normalize_call_outcome(df: DataFrame) -> DataFrame:
    """Missing -> not called, "none" -> unreachable, plus a sort code."""
    outcome = F.when(F.col("call_outcome").isNull(), OUTCOME_NOT_CALLED).when(
        F.col("call_outcome") == OUTCOME_NONE, OUTCOME_UNREACHABLE
    ).otherwise(F.col("call_outcome"))
    # Sort codes; other outcomes have none.
    codes = (
        F.when(F.col("call_outcome") == "Niet gebeld", 0)
        .when(F.col("call_outcome") == "Onbereikbaar", 1)
        .when(F.col("call_outcome") == "Herinnerd", 2)
        .when(F.col("call_outcome") == "Verzet/Geannuleerd", 3)
    )
    return df.withColumn("call_outcome", outcome).withColumn("color_sort", codes)


def label_period(df: DataFrame, first: dt.date, last: dt.date, ts: str = "start") -> DataFrame:
    inside = within_days(ts, first, last)
    return df.withColumn("pilot", F.when(inside, "pilot").otherwise("Geen pilot"))


def filter_remarks(df: DataFrame, substrings: Sequence[str], column: str = "remarks") -> DataFrame:
    """Distinct remarks that contain none of the substrings."""
    kept = df.select(column).where(F.col(column).isNotNull())
    for part in substrings:
        kept = kept.where(~F.contains(F.col(column), F.lit(part)))
    return kept.distinct()


# --- label shares -----------------------------------------------------------


def label_counts(df: DataFrame, by: Sequence[str], labels: Sequence[str] = LABELS) -> DataFrame:
    """Rows per label as columns; null where a label does not occur."""
    return df.groupBy(*by).pivot("missed", list(labels)).count()


def feature_rate(df: DataFrame, feature: str, decimals: int | None = None) -> DataFrame:
    """Share of missed visits per feature value; null when one label is missing.

    ``decimals`` first rounds the feature half to even.
    """
    if decimals is not None:
        df = df.withColumn(feature, F.bround(feature, decimals))
    known = df.where(F.col(feature).isNotNull())
    counts = label_counts(known, [feature])
    missed = F.col("missed") / (F.col("missed") + F.col("attended"))
    return counts.withColumn("missed_share", missed).withColumn(
        "attended_share", 1 - F.col("missed_share")
    )


def label_share(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Share of each label within the group; null where a label does not occur."""
    counts = label_counts(df, by)
    total = F.coalesce("missed", F.lit(0)) + F.coalesce("attended", F.lit(0))
    return counts.select(
        *by, (F.col("missed") / total).alias("missed"), (F.col("attended") / total).alias("attended")
    )


def group_share_by_label(df: DataFrame, group: str) -> DataFrame:
    """Share of each group within a label, labels as columns."""
    counts = label_counts(df, [group])
    totals = counts.agg(F.sum("missed").alias("_a"), F.sum("attended").alias("_b")).first()
    return counts.select(
        group,
        (F.col("missed") / F.lit(totals["_a"])).alias("missed"),
        (F.col("attended") / F.lit(totals["_b"])).alias("attended"),
    )


def monthly_rate(df: DataFrame, by: Sequence[str], ts: str = "start") -> DataFrame:
    """Label shares and row count per group and calendar month."""
    dated = df.withColumn("month", month_start(ts))
    keys = [*by, "month"]
    counts = label_counts(dated, keys)
    missed, shown = F.coalesce("missed", F.lit(0)), F.coalesce("attended", F.lit(0))
    total = missed + shown
    return counts.select(
        *keys,
        (F.col("missed") / total).alias("missed"),
        (F.col("attended") / total).alias("attended"),
        total.alias("n"),
    )


def month_of_year_rate(df: DataFrame, by: Sequence[str], ts: str = "start") -> DataFrame:
    return label_share(df.withColumn("month", F.month(ts)), ["month", *by])


def reason_counts(df: DataFrame, reason: str = "mutationReason_display") -> DataFrame:
    missed = df.where((F.col("missed") == "missed") & F.col(reason).isNotNull())
    return missed.groupBy(reason).agg(F.count(F.lit(1)).alias("n"))


def appointments_per_day(df: DataFrame, ts: str = "start") -> DataFrame:
    """Rows per day from the first to the last date, empty days included."""
    counts = df.groupBy(F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    # One row with the range, unfolded into one row per date.
    spine = counts.agg(F.min("day").alias("_a"), F.max("day").alias("_b")).select(
        F.explode(F.sequence("_a", "_b")).alias("day")
    )
    return spine.join(counts, "day", "left").select(
        "day", F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )


def daily_count_histogram(per_day: DataFrame) -> DataFrame:
    return per_day.groupBy("n").agg(F.count(F.lit(1)).alias("days"))


# --- calls ------------------------------------------------------------------


def percentage_text(part: Column, total: Column, absolute: bool = True) -> Column:
    """``"n (p%)"`` with two decimals; an empty set counts as zero percent."""
    percent = F.when(total == 0, F.lit(0.0)).otherwise(F.try_divide(part, total) * 100)
    if absolute:
        return F.format_string("%d (%.2f%%)", part, percent)
    return F.format_string("%.2f%%", percent)


def call_kpis(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The five call figures as text, over normalized outcomes."""
    counts = {
        name: F.count(F.when(F.col("call_outcome").isin(*outcomes), 1))
        for name, outcomes in KPI_OUTCOMES.items()
    }
    counts["opt_out"] = F.count(
        F.when(F.col("call_outcome").isin(*OPT_OUT_OUTCOMES) & (F.col("opt_out") == 1), 1)
    )
    total = F.count(F.lit(1))
    figures = df.groupBy(*by).agg(
        total.alias("_total"), *[value.alias(f"_{name}") for name, value in counts.items()]
    )
    return figures.select(
        *by, *[percentage_text(F.col(f"_{n}"), F.col("_total")).alias(n) for n in counts]
    )


def outcomes_per_day(
    df: DataFrame, clinic: str | None = None, include_not_called: bool = False
) -> DataFrame:
    shown = [*PLOTTED_OUTCOMES, *([OUTCOME_NOT_CALLED] if include_not_called else [])]
    if clinic is not None:
        df = df.where(F.col("clinic_name") == clinic)
    order = F.array_position(F.lit(shown), F.col("call_outcome")).cast("int") - 1
    return (
        df.where(F.col("call_outcome").isin(*shown))
        .groupBy(F.to_date("start_time").alias("date"), "call_outcome")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("order", order)
    )


def outcome_matrix(
    df: DataFrame, by: str, outcomes: Sequence[str], keep_missing: bool = True
) -> DataFrame:
    """Counts per group and outcome, outcomes as columns, missing as ``none_given``."""
    rows = df if keep_missing else df.where(F.col(by).isNotNull())
    known = F.col("call_outcome")
    return rows.groupBy(by).agg(
        *[F.count(F.when(known == o, 1)).alias(o) for o in outcomes],
        F.count(F.when(known.isNull(), 1)).alias("none_given"),
    )


def value_totals(df: DataFrame, column: str) -> DataFrame:
    known = df.where(F.col(column).isNotNull())
    return known.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def outcome_by_hour(calls: DataFrame) -> DataFrame:
    """Calls per hour and outcome, and the outcome's share of that hour."""
    known = calls.where(F.col("timestamp").isNotNull() & F.col("call_outcome").isNotNull())
    counts = known.groupBy(F.hour("timestamp").alias("hour_called"), "call_outcome").agg(
        F.count(F.lit(1)).alias("n")
    )
    # At most 24 rows.
    hours = counts.groupBy("hour_called").agg(F.sum("n").alias("_total"))
    return counts.join(hours, "hour_called").select(
        "hour_called", "call_outcome", "n", (F.col("n") / F.col("_total")).alias("share")
    )


def monitoring_summary(base: DataFrame) -> DataFrame:
    """Highest version text and latest scoring time."""
    return base.agg(
        F.max("api_version").alias("api_version"),
        F.date_format(F.max("timestamp"), "yyyy-MM-dd HH:mm").alias("latest"),
    )


def responses_per_day(base: DataFrame) -> DataFrame:
    return base.groupBy(F.to_date("timestamp").alias("date"), "response_code").agg(
        F.count(F.lit(1)).alias("n")
    )


def runtime_series(base: DataFrame) -> DataFrame:
    return base.select("timestamp", "runtime").distinct()


def histogram(
    df: DataFrame,
    value: str,
    low: float | None,
    high: float | None,
    n_bins: int,
    by: Sequence[str] = (),
) -> DataFrame:
    """Fixed-width counts; the last bin includes its upper edge, empty bins are absent.

    Without limits the range of the data is used.
    """
    if low is None or high is None:
        row = df.agg(F.min(value).alias("a"), F.max(value).alias("b")).first()
        low = row["a"] if low is None else low
        high = row["b"] if high is None else high
    x = F.col(value)
    index = F.floor((x - F.lit(float(low))) / F.lit(float(high - low)) * n_bins)
    bucket = F.when(x == F.lit(float(high)), F.lit(n_bins - 1)).otherwise(index)
    inside = df.where((x >= F.lit(float(low))) & (x <= F.lit(float(high))))
    return inside.groupBy(*by, bucket.cast("int").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n")
    )


def not_called() -> Column:
    return F.col("call_status").isNull() | (F.col("call_status") == STATUS_NOT_CALLED)


def complete_months(df: DataFrame, asof: dt.date, ts: str = "start_time") -> DataFrame:
    """Rows before the month of ``asof``, with their month."""
    return df.where(F.col(ts) < F.lit(asof.replace(day=1))).withColumn("month", month_start(ts))


def not_called_monthly(df: DataFrame, asof: dt.date) -> DataFrame:
    """Count and percentage of not-called rows per complete month."""
    per_month = (
        complete_months(df, asof)
        .groupBy("month")
        .agg(F.count(F.when(not_called(), 1)).alias("not_called"), F.count(F.lit(1)).alias("total"))
    )
    # Months without any such row have no percentage.
    percent = F.when(
        F.col("not_called") > 0, F.col("not_called") / F.col("total") * 100
    )
    return per_month.withColumn("percent_not_called", percent)


def recent_periods(df: DataFrame, n: int = 12) -> DataFrame:
    """Rows of the ``n`` latest months present."""
    latest = df.select("month").distinct().orderBy(F.col("month").desc()).limit(n)
    return df.join(latest, "month", "left_semi")


def monthly_density(
    df: DataFrame, n_bins: int, value: str = "prediction", last: int = 12
) -> DataFrame:
    """Score density per month over the latest months."""
    counts = histogram(recent_periods(df, last), value, 0.0, 1.0, n_bins, ["month"])
    totals = counts.groupBy("month").agg(F.sum("n").alias("_total"))
    return counts.join(totals, "month").select(
        "month", "bucket", "n", (F.col("n") / F.col("_total") * n_bins).alias("density")
    )


#: Cells into which scores are binned before they are smoothed, and grid points at which a density is told.
KERNEL_CELLS, KERNEL_POINTS = 1024, 128


def kernel_density(
    df: DataFrame, value: str, by: Sequence[str], adjust: float = 0.3, low: float = 0.0, high: float = 1.0
) -> DataFrame:
    """(by..., n, bandwidth, point, density): Gaussian kernel density of a value per group at evenly spaced points.

    The bandwidth is ``adjust`` times Scott's rule (sample deviation times n ** -0.2). A value shares its weight between the two
    nearest of KERNEL_CELLS + 1 cells, so what is smoothed has a fixed size per group, whatever the number of rows.
    Missing values are left out, values beyond the ends count at the end; a group without a spread has no density.
    """
    step = (high - low) / KERNEL_CELLS
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(value)).select(*by, F.col(value).cast("double").alias("_x"))
    moments = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("_x").alias("_sd"))
    place = F.least(F.greatest((F.col("_x") - low) / step, F.lit(0.0)), F.lit(float(KERNEL_CELLS)))
    cell = F.least(F.floor(place), F.lit(KERNEL_CELLS - 1))
    shares = F.array(
        F.struct(cell.alias("cell"), (1 - (place - cell)).alias("weight")),
        F.struct((cell + 1).alias("cell"), (place - cell).alias("weight")),
    )
    weights = (
        rows.select(*by, F.explode(shares).alias("_s"))
        .groupBy(*by, F.col("_s.cell").alias("_cell"))
        .agg(F.sum("_s.weight").alias("_weight"))
    )
    # At most KERNEL_CELLS + 1 cells a group, each spread over the points.
    width = F.col("_sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)) * adjust
    known = moments.where(F.col("_sd") > 0).select(*by, "n", width.alias("bandwidth"))
    point = F.explode(F.sequence(F.lit(0), F.lit(KERNEL_POINTS))).alias("_k")
    spread = weights.join(known, list(by)).select("*", point)
    x = low + F.col("_k") * ((high - low) / KERNEL_POINTS)
    z = (x - (low + F.col("_cell") * step)) / F.col("bandwidth")
    height = F.col("_weight") * F.exp(-0.5 * z * z) / (F.col("n") * F.col("bandwidth") * math.sqrt(2 * math.pi))
    return spread.groupBy(*by, "n", "bandwidth", x.alias("point")).agg(F.sum(height).alias("density"))


# --- trial and pilot --------------------------------------------------------


def with_known_outcome(df: DataFrame) -> DataFrame:
    return df.where(F.col("outcome").isNotNull()).withColumn(
        "missed", (F.col("outcome") == "Missed").cast("int")
    )


def trial_rates(df: DataFrame, called_only: bool = False) -> DataFrame:
    """Mean of missed visits and count per arm, optionally treated patients reached only."""
    rows = with_known_outcome(df).where(F.col("treatment_group").isNotNull())
    if called_only:
        rows = rows.where(
            F.col("call_outcome").isin(OUTCOME_REMINDED, OUTCOME_MOVED)
            | (F.col("treatment_group") == 0)
        )
    return rows.groupBy("treatment_group").agg(
        F.avg("missed").alias("mean"), F.count(F.lit(1)).alias("n")
    )


def trial_rates_by_score(df: DataFrame, n_bins: int = 10) -> DataFrame:
    """Mean of missed visits per arm (columns) and score quantile."""
    binned = qcut(with_known_outcome(df), "prediction", n_bins, "score_bin")
    return binned.groupBy("score_bin").pivot("treatment_group", [0, 1]).agg(F.avg("missed"))


def outcome_shares(df: DataFrame, call_outcome: str) -> DataFrame:
    """Normalized outcomes among appointments with one call outcome."""
    counts = (
        df.where((F.col("call_outcome") == call_outcome) & F.col("outcome").isNotNull())
        .groupBy("outcome")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total = counts.agg(F.sum("n")).first()[0]
    return counts.withColumn("share", F.col("n") / F.lit(total))


def moved_by_outcome(df: DataFrame) -> DataFrame:
    """Moved flag by final outcome for calls that moved an appointment."""
    return (
        flag_moved(df)
        .where(F.col("call_outcome") == OUTCOME_MOVED)
        .groupBy("app_moved")
        .agg(
            F.count(F.when(F.col("outcome") == "Missed", 1)).alias("missed"),
            F.count(F.when(F.col("outcome") == "Attended", 1)).alias("attended"),
            F.count(F.when(F.col("outcome").isNull(), 1)).alias("unknown"),
        )
    )


def pilot_bin_stats(
    df: DataFrame,
    years: Sequence[int] | None = None,
    called: DataFrame | None = None,
    bin_col: str = "predict_bin",
) -> DataFrame:
    """Mean, sample deviation and size of the label per period and score bin.

    ``called`` (APP_ID) keeps, within the pilot, only called appointments.
    """
    if years is not None:
        df = df.where(F.year("start").isin(list(years)))
    if called is not None:
        mark = called.select("APP_ID").distinct().withColumn("_called", F.lit(True))
        df = df.join(mark, "APP_ID", "left").where(
            (F.col("pilot") == "Geen pilot") | F.col("_called")
        )
    missed = (F.col("missed") == "missed").cast("int")
    return df.groupBy("pilot", bin_col).agg(
        F.avg(missed).alias("mean"),
        F.stddev_samp(missed).alias("std"),
        F.count(F.lit(1)).alias("size"),
    )


def reclassification(
    df: DataFrame, by_a: Column, by_b: Column, by: Sequence[str] = ()
) -> DataFrame:
    """Percentage called by model A against called by model B, B as columns."""
    cells = df.groupBy(*by, by_a.alias("called_by_a")).agg(
        F.count(F.when(~by_b, 1)).alias("_no"), F.count(F.when(by_b, 1)).alias("_yes")
    )
    if by:
        totals = cells.groupBy(*by).agg(F.sum(F.col("_no") + F.col("_yes")).alias("_total"))
        cells = cells.join(totals, list(by))
    else:
        total = cells.agg(F.sum(F.col("_no") + F.col("_yes"))).first()[0]
        cells = cells.withColumn("_total", F.lit(total))

    def percent(part: str) -> Column:
        value = F.bround(F.col(part) / F.col("_total") * 100, 2)
        return F.when(F.col(part) > 0, value)

    return cells.select(
        *by, "called_by_a", percent("_no").alias("not_called_by_b"), percent("_yes").alias("called_by_b")
    )


def lowest_scores(df: DataFrame, score: str, key: str, n: int = 5) -> DataFrame:
    return df.orderBy(F.col(score), F.col(key)).limit(n)
