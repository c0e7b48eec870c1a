"""Reports: rates, call figures, monitoring, trial and pilot tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from rollcall.operators import binning, features, reports, trial
from rollcall.plans import bases as b
from rollcall.plans.joins import MONITOR_SQL, TRIAL_CTES, monitoring, trial_rows
from rollcall.plans.registry import query

_RATE = (
    "SELECT {key}, nullif(count(*) FILTER (missed = 'missed'), 0) AS missed,"
    " nullif(count(*) FILTER (missed = 'attended'), 0) AS attended,"
    " round(nullif(count(*) FILTER (missed = 'missed'), 0) /"
    " (nullif(count(*) FILTER (missed = 'missed'), 0)"
    " + nullif(count(*) FILTER (missed = 'attended'), 0)), 6) AS missed_share,"
    " round(1 - nullif(count(*) FILTER (missed = 'missed'), 0) /"
    " (nullif(count(*) FILTER (missed = 'missed'), 0)"
    " + nullif(count(*) FILTER (missed = 'attended'), 0)), 6) AS attended_share"
    " FROM {source} GROUP BY {key}"
)
_SHARES = (
    "round(nullif(count(*) FILTER (missed = 'missed'), 0) / count(*), 6) AS missed,"
    " round(nullif(count(*) FILTER (missed = 'attended'), 0) / count(*), 6) AS attended"
)


@query(
    "feature_vs_rate",
    b.with_ctes(_RATE.format(key="earlier_appointments", source="history"), "history"),
)
def feature_vs_rate(spark, sf_dir):
    history = features.prev_missed_features(b.cleaned(spark, sf_dir), stage=True)
    out = reports.feature_rate(history, "earlier_appointments")
    return b.rounded(out, "missed_share", "attended_share")


@query(
    "feature_vs_rate_rounded",
    b.with_ctes(
        _RATE.format(key="round_even(value, 0)", source="r").replace(
            "SELECT round_even(value, 0)", "SELECT round_even(value, 0) AS value"
        ),
        r="SELECT value, CASE WHEN event_type = 'error' THEN 'missed' ELSE 'attended' END AS missed"
        " FROM events",
    ),
)
def feature_vs_rate_rounded(spark, sf_dir):
    rows = b.table(spark, sf_dir, "events").selectExpr(
        "value", "CASE WHEN event_type = 'error' THEN 'missed' ELSE 'attended' END AS missed"
    )
    return b.rounded(reports.feature_rate(rows, "value", 0), "missed_share", "attended_share")


@query(
    "label_share_by_group",
    b.with_ctes(
        """SELECT clinic, round(nullif(count(*) FILTER (missed = 'missed'), 0)
        / (SELECT count(*) FROM cleaned WHERE missed = 'missed'), 6) AS missed,
        round(nullif(count(*) FILTER (missed = 'attended'), 0)
        / (SELECT count(*) FROM cleaned WHERE missed = 'attended'), 6) AS attended,
        round(nullif(count(*) FILTER (missed = 'missed'), 0) / count(*), 6) AS missed_within
        FROM cleaned GROUP BY clinic""",
        "cleaned",
    ),
)
def label_share_by_group(spark, sf_dir):
    rows = b.cleaned(spark, sf_dir).select("clinic", "missed")
    within = reports.label_share(rows, ["clinic"]).select(
        "clinic", F.col("missed").alias("missed_within")
    )
    joined = reports.group_share_by_label(rows, "clinic").join(within, "clinic")
    return b.rounded(joined, "missed", "attended", "missed_within")


@query(
    "monthly_rate",
    b.with_ctes(
        f"""SELECT clinic, date_trunc('month', start)::DATE AS month, {_SHARES},
        count(*) AS n FROM cleaned GROUP BY 1, 2""",
        "cleaned",
    ),
)
def monthly_rate(spark, sf_dir):
    return b.rounded(
        reports.monthly_rate(b.cleaned(spark, sf_dir), ["clinic"]), "missed", "attended"
    )


@query(
    "month_of_year_rate",
    b.with_ctes(
        f"""SELECT month(start)::INTEGER AS month, CASE WHEN start::DATE BETWEEN
        DATE '1999-10-05' AND DATE '1999-11-01' THEN 'pilot' ELSE 'Geen pilot' END AS pilot,
        {_SHARES} FROM cleaned GROUP BY 1, 2""",
        "cleaned",
    ),
)
def month_of_year_rate(spark, sf_dir):
    rows = reports.label_period(
        b.cleaned(spark, sf_dir), dt.date(1999, 10, 5), dt.date(1999, 11, 1)
    )
    return b.rounded(reports.month_of_year_rate(rows, ["pilot"]), "missed", "attended")


@query(
    "reason_counts",
    b.with_ctes(
        """SELECT "mutationReason_display", count(*) AS n FROM cleaned WHERE missed = 'missed'
        AND "mutationReason_display" IS NOT NULL GROUP BY 1""",
        "cleaned",
    ),
)
def reason_counts(spark, sf_dir):
    return reports.reason_counts(b.cleaned(spark, sf_dir))


@query(
    "appointments_per_day",
    b.with_ctes(
        """SELECT n, count(*) AS days FROM (SELECT d, count(start) AS n FROM
        (SELECT unnest(generate_series(min(start)::DATE, max(start)::DATE, INTERVAL 1 DAY))::DATE
        AS d FROM cleaned) LEFT JOIN cleaned ON start::DATE = d GROUP BY d) GROUP BY n""",
        "cleaned",
    ),
)
def appointments_per_day(spark, sf_dir):
    return reports.daily_count_histogram(reports.appointments_per_day(b.cleaned(spark, sf_dir)))


# --- calls --------------------------------------------------------------------

_KPI_ROWS = """SELECT p.id, start_time, clinic_name, opt_out, CASE WHEN call_outcome IS NULL
    THEN 'Niet gebeld' WHEN call_outcome = 'Geen' THEN 'Onbereikbaar' ELSE call_outcome END
    AS call_outcome FROM predictions p LEFT JOIN calls c ON c.prediction_id = p.id
    JOIN patients t ON t.id = p.patient_id WHERE start_time::DATE BETWEEN DATE '2024-01-08'
    AND DATE '2024-01-21' AND treatment_group >= 1"""


def kpi_rows(spark, sf_dir):
    return reports.normalize_call_outcome(
        reports.kpi_base(
            b.predictions(spark, sf_dir),
            b.calls(spark, sf_dir),
            b.patients(spark, sf_dir),
            dt.date(2024, 1, 8),
            dt.date(2024, 1, 21),
        )
    )


def _kpi_sql(name: str, outcomes: tuple[str, ...], extra: str = "") -> str:
    inside = ", ".join(f"'{o}'" for o in outcomes)
    n = f"count(*) FILTER (call_outcome IN ({inside}){extra})"
    return f"printf('%d (%.2f%%)', {n}, {n} / count(*) * 100) AS {name}"


@query(
    "call_outcome_kpis",
    b.with_ctes(
        "SELECT clinic_name, "
        + ", ".join(_kpi_sql(n, o) for n, o in reports.KPI_OUTCOMES.items())
        + ", "
        + _kpi_sql("opt_out", reports.OPT_OUT_OUTCOMES, " AND opt_out = 1")
        + " FROM kpi_rows GROUP BY clinic_name",
        "predictions",
        "calls",
        "patients",
        kpi_rows=_KPI_ROWS,
    ),
)
def call_outcome_kpis(spark, sf_dir):
    return reports.call_kpis(kpi_rows(spark, sf_dir), ["clinic_name"])


@query(
    "outcomes_per_day",
    b.with_ctes(
        """SELECT start_time::DATE AS date, call_outcome, count(*) AS n, (list_position(
        ['Herinnerd', 'Verzet/Geannuleerd', 'Voicemail ingesproken', 'Onbereikbaar',
        'Niet gebeld'], call_outcome) - 1)::INTEGER AS "order" FROM kpi_rows
        WHERE clinic_name = 'clinic_1' GROUP BY 1, 2""",
        "predictions",
        "calls",
        "patients",
        kpi_rows=_KPI_ROWS,
    ),
)
def outcomes_per_day(spark, sf_dir):
    return reports.outcomes_per_day(
        kpi_rows(spark, sf_dir), clinic="clinic_1", include_not_called=True
    )


_OUTCOMES = ["Geen", "Herinnerd", "Onbereikbaar", "Verzet/Geannuleerd", "Voicemail ingesproken"]


@query(
    "outcome_matrix",
    b.with_ctes(
        "SELECT clinic_name, treatment_group, "
        + ", ".join(f"count(*) FILTER (call_outcome = '{o}') AS \"{o}\"" for o in _OUTCOMES)
        + ", count(*) FILTER (call_outcome IS NULL) AS none_given FROM ("
        "SELECT clinic_name, NULL::INTEGER AS treatment_group, call_outcome FROM predictions p"
        " LEFT JOIN calls c ON c.prediction_id = p.id UNION ALL"
        " SELECT 'all', coalesce(treatment_group, -1)::INTEGER, call_outcome FROM predictions p"
        " LEFT JOIN calls c ON c.prediction_id = p.id LEFT JOIN patients t ON t.id = p.patient_id)"
        " GROUP BY 1, 2",
        "predictions",
        "calls",
        "patients",
    ),
)
def outcome_matrix(spark, sf_dir):
    """Both matrices: per clinic, and per treatment group with the missing one."""
    answers = b.calls(spark, sf_dir).select(F.col("prediction_id").alias("id"), "call_outcome")
    people = b.patients(spark, sf_dir).select(F.col("id").alias("patient_id"), "treatment_group")
    rows = b.predictions(spark, sf_dir).join(answers, "id", "left").join(people, "patient_id", "left")
    per_clinic = reports.outcome_matrix(rows, "clinic_name", _OUTCOMES).withColumn(
        "treatment_group", F.lit(None).cast("int")
    )
    per_group = (
        reports.outcome_matrix(rows, "treatment_group", _OUTCOMES)
        .withColumn("clinic_name", F.lit("all"))
        .withColumn("treatment_group", F.coalesce("treatment_group", F.lit(-1)))
    )
    return per_clinic.unionByName(per_group)


@query(
    "outcome_totals",
    b.with_ctes(
        "SELECT 'status' AS kind, call_status AS value, count(*) AS n FROM calls GROUP BY 2"
        " UNION ALL SELECT 'outcome', call_outcome, count(*) FROM calls GROUP BY 2",
        "calls",
    ),
)
def outcome_totals(spark, sf_dir):
    made = b.calls(spark, sf_dir)
    parts = [
        reports.value_totals(made, column).select(
            F.lit(kind).alias("kind"), F.col(column).alias("value"), "n"
        )
        for kind, column in (("status", "call_status"), ("outcome", "call_outcome"))
    ]
    return parts[0].unionByName(parts[1])


@query(
    "outcome_by_hour",
    b.with_ctes(
        """SELECT hour("timestamp")::INTEGER AS hour_called, call_outcome, count(*) AS n,
        round(count(*) / sum(count(*)) OVER (PARTITION BY hour("timestamp")), 6) AS share
        FROM calls GROUP BY hour("timestamp"), call_outcome""",
        "calls",
    ),
)
def outcome_by_hour(spark, sf_dir):
    return b.rounded(reports.outcome_by_hour(b.calls(spark, sf_dir)), "share")


# --- monitoring ---------------------------------------------------------------


@query(
    "monitoring_rollup",
    b.with_ctes(
        """SELECT max(api_version) AS api_version,
        strftime(max("timestamp"), '%Y-%m-%d %H:%M') AS latest FROM m""",
        "predictions",
        "requests",
        "patients",
        m=MONITOR_SQL,
    ),
)
def monitoring_rollup(spark, sf_dir):
    return reports.monitoring_summary(monitoring(spark, sf_dir))


@query(
    "responses_per_day",
    b.with_ctes(
        """SELECT "timestamp"::DATE AS date, response_code, count(*) AS n FROM m GROUP BY 1, 2""",
        "predictions",
        "requests",
        "patients",
        m=MONITOR_SQL,
    ),
)
def responses_per_day(spark, sf_dir):
    return reports.responses_per_day(monitoring(spark, sf_dir))


@query(
    "runtime_series",
    b.with_ctes(
        """SELECT DISTINCT "timestamp", runtime FROM m""",
        "predictions",
        "requests",
        "patients",
        m=MONITOR_SQL,
    ),
)
def runtime_series(spark, sf_dir):
    return b.rounded(reports.runtime_series(monitoring(spark, sf_dir)), "runtime")


@query(
    "score_histogram",
    b.with_ctes(
        """SELECT treatment_group, least(floor((prediction - 0.0) / 1.0 * 50), 49)::INTEGER
        AS bucket, count(*) AS n FROM predictions p LEFT JOIN patients t ON t.id = p.patient_id
        GROUP BY 1, 2""",
        "predictions",
        "patients",
    ),
)
def score_histogram(spark, sf_dir):
    rows = trial.join_known_groups(
        b.predictions(spark, sf_dir).withColumnRenamed("patient_id", "pseudo_id"),
        b.patients(spark, sf_dir),
    )
    return reports.histogram(rows, "prediction", 0.0, 1.0, 50, ["treatment_group"])


# Orders as predictions over several years, calls on some of them.
_YEARS = {
    "id": "o_orderkey",
    "start_time": "o_orderdate",
    "prediction": "o_totalprice / 500000",
    "call_status": "CASE o_orderstatus WHEN 'F' THEN 'Gebeld' WHEN 'O' THEN 'Niet gebeld' END",
}
_YEARS_SQL = b._sql_select(_YEARS, "orders")


def yearly_predictions(spark, sf_dir):
    return b._spark_select(b.table(spark, sf_dir, "orders"), _YEARS)


@query(
    "not_called_monthly",
    b.with_ctes(
        """SELECT date_trunc('month', start_time)::DATE AS month, count(*) FILTER (
        call_status IS NULL OR call_status = 'Niet gebeld') AS not_called, count(*) AS total,
        round(count(*) FILTER (call_status IS NULL OR call_status = 'Niet gebeld')
        / count(*) * 100, 6) AS percent_not_called FROM y
        WHERE start_time < TIMESTAMP '2001-07-01 00:00:00' GROUP BY 1""",
        y=_YEARS_SQL,
    ),
)
def not_called_monthly(spark, sf_dir):
    return b.rounded(
        reports.not_called_monthly(yearly_predictions(spark, sf_dir), dt.date(2001, 7, 15)),
        "percent_not_called",
    )


_RECENT_SQL = """SELECT *, date_trunc('month', start_time)::DATE AS month FROM y
    WHERE start_time < TIMESTAMP '2001-07-01 00:00:00'
    AND (call_status IS NULL OR call_status = 'Niet gebeld')"""


def _recent(spark, sf_dir):
    rows = reports.complete_months(yearly_predictions(spark, sf_dir), dt.date(2001, 7, 15))
    return rows.where(reports.not_called())


@query(
    "monthly_score_density",
    b.with_ctes(
        """SELECT month, bucket, count(*) AS n,
        round(count(*) / sum(count(*)) OVER (PARTITION BY month) * 20, 6) AS density FROM (
        SELECT month, least(floor(prediction * 20), 19)::INTEGER AS bucket FROM r WHERE month IN (
        SELECT DISTINCT month FROM r ORDER BY month DESC LIMIT 12)) GROUP BY month, bucket""",
        y=_YEARS_SQL,
        r=_RECENT_SQL,
    ),
)
def monthly_score_density(spark, sf_dir):
    return b.rounded(reports.monthly_density(_recent(spark, sf_dir), 20), "density")


@query(
    "monthly_kernel_density",
    b.with_ctes(
        f"""SELECT month, n, round(bw, 6) AS bandwidth, round(point, 6) AS point, round(density, 6) AS density FROM (
        SELECT month, n, bw, k / {reports.KERNEL_POINTS}.0::DOUBLE AS point,
        sum(w * exp(-0.5::DOUBLE * pow((k / {reports.KERNEL_POINTS}.0::DOUBLE - cell / {reports.KERNEL_CELLS}.0::DOUBLE) / bw, 2))
            / (n * bw * sqrt(2 * pi()))) AS density
        FROM (SELECT month, cell, sum(w) AS w FROM (
            SELECT month, unnest([c, c + 1]) AS cell, unnest([1 - (p - c), p - c]) AS w FROM (
            SELECT month, p, least(floor(p), {reports.KERNEL_CELLS - 1}) AS c FROM (
            SELECT month, least(greatest(prediction * {reports.KERNEL_CELLS}, 0), {reports.KERNEL_CELLS}) AS p FROM latest)))
            GROUP BY ALL)
        JOIN (SELECT month, count(*) AS n, stddev_samp(prediction) * pow(count(*)::DOUBLE, -0.2::DOUBLE) * 0.3::DOUBLE AS bw
              FROM latest GROUP BY month HAVING stddev_samp(prediction) > 0) USING (month),
        range(0, {reports.KERNEL_POINTS} + 1) g(k) GROUP BY ALL)""",
        y=_YEARS_SQL,
        r=_RECENT_SQL,
        latest="""SELECT month, prediction FROM r WHERE month IN (
        SELECT DISTINCT month FROM r ORDER BY month DESC LIMIT 12)""",
    ),
)
def monthly_kernel_density(spark, sf_dir):
    """The smoothed distribution of scores in each of the latest months."""
    rows = reports.recent_periods(_recent(spark, sf_dir))
    return b.rounded(reports.kernel_density(rows, "prediction", ["month"]), "bandwidth", "point", "density")


@query(
    "recent_periods",
    b.with_ctes(
        """SELECT id, month FROM r WHERE month IN (
        SELECT DISTINCT month FROM r ORDER BY month DESC LIMIT 12)""",
        y=_YEARS_SQL,
        r=_RECENT_SQL,
    ),
)
def recent_periods(spark, sf_dir):
    return reports.recent_periods(_recent(spark, sf_dir)).select("id", "month")


# --- trial and pilot ----------------------------------------------------------

_TRIAL_NEEDS = ("predictions", "calls", "patients")


@query(
    "trial_rates",
    b.with_ctes(
        """SELECT 'all' AS cohort, treatment_group, round(avg((outcome = 'Missed')::INTEGER), 6)
        AS mean, count(*) AS n FROM combined WHERE outcome IS NOT NULL
        AND treatment_group IS NOT NULL GROUP BY treatment_group UNION ALL
        SELECT 'called', treatment_group, round(avg((outcome = 'Missed')::INTEGER), 6), count(*)
        FROM combined WHERE outcome IS NOT NULL AND treatment_group IS NOT NULL
        AND (call_outcome IN ('Herinnerd', 'Verzet/Geannuleerd') OR treatment_group = 0)
        GROUP BY treatment_group""",
        *_TRIAL_NEEDS,
        **TRIAL_CTES,
    ),
)
def trial_rates(spark, sf_dir):
    rows = trial_rows(spark, sf_dir)
    parts = [
        reports.trial_rates(rows, called_only=only).withColumn("cohort", F.lit(name))
        for name, only in (("all", False), ("called", True))
    ]
    return b.rounded(parts[0].unionByName(parts[1]), "mean")


@query(
    "trial_rates_by_score",
    b.with_ctes(
        """SELECT greatest(len(list_filter(edges, lambda e: e < prediction)) - 1, 0)::INTEGER
        AS score_bin, round(avg((outcome = 'Missed')::INTEGER) FILTER (treatment_group = 0), 6)
        AS "0", round(avg((outcome = 'Missed')::INTEGER) FILTER (treatment_group = 1), 6) AS "1"
        FROM known, (SELECT quantile_cont(prediction, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8,
        0.9, 1]) AS edges FROM known) GROUP BY 1""",
        *_TRIAL_NEEDS,
        **TRIAL_CTES,
        known="SELECT * FROM combined WHERE outcome IS NOT NULL",
    ),
)
def trial_rates_by_score(spark, sf_dir):
    return b.rounded(reports.trial_rates_by_score(trial_rows(spark, sf_dir), 10), "0", "1")


@query(
    "trial_outcome_shares",
    b.with_ctes(
        """SELECT call_outcome, outcome, count(*) AS n,
        round(count(*) / sum(count(*)) OVER (PARTITION BY call_outcome), 6) AS share
        FROM combined WHERE outcome IS NOT NULL AND call_outcome IN ('Herinnerd', 'Geen')
        GROUP BY call_outcome, outcome""",
        *_TRIAL_NEEDS,
        **TRIAL_CTES,
    ),
)
def trial_outcome_shares(spark, sf_dir):
    rows = trial_rows(spark, sf_dir)
    parts = [
        reports.outcome_shares(rows, c).withColumn("call_outcome", F.lit(c))
        for c in ("Herinnerd", "Geen")
    ]
    return b.rounded(parts[0].unionByName(parts[1]), "share")


@query(
    "trial_moved_by_outcome",
    b.with_ctes(
        """SELECT coalesce(start_time <> start, true) AS app_moved,
        count(*) FILTER (outcome = 'Missed') AS missed, count(*) FILTER (outcome = 'Attended')
        AS attended, count(*) FILTER (outcome IS NULL) AS unknown FROM combined
        WHERE call_outcome = 'Verzet/Geannuleerd' GROUP BY 1""",
        *_TRIAL_NEEDS,
        **TRIAL_CTES,
    ),
)
def trial_moved_by_outcome(spark, sf_dir):
    return reports.moved_by_outcome(trial_rows(spark, sf_dir))


_PILOT = {
    "APP_ID": "o_orderkey",
    "start": "o_orderdate",
    "prediction": "o_totalprice / 500000",
    "missed": "CASE WHEN o_orderstatus = 'F' THEN 'missed' ELSE 'attended' END",
}
_TWELFTHS = ", ".join(repr(i / 12) for i in range(13))


@query(
    "pilot_bin_stats",
    b.with_ctes(
        f"""SELECT pilot, predict_bin, round(avg((missed = 'missed')::INTEGER), 6) AS mean,
        round(stddev_samp((missed = 'missed')::INTEGER), 6) AS std, count(*) AS size FROM (
        SELECT *, CASE WHEN start::DATE BETWEEN DATE '1999-10-05' AND DATE '1999-11-01'
        THEN 'pilot' ELSE 'Geen pilot' END AS pilot,
        greatest(len(list_filter(edges, lambda e: e < prediction)) - 1, 0)::INTEGER AS predict_bin
        FROM o, (SELECT quantile_cont(prediction, [{_TWELFTHS}]) AS edges FROM o))
        WHERE year(start) IN (1998, 1999) AND (pilot = 'Geen pilot' OR "APP_ID" IN (
        SELECT event_id FROM events WHERE event_type IN ('view', 'click', 'error')))
        GROUP BY 1, 2""",
        o=b._sql_select(_PILOT, "orders WHERE month(o_orderdate) = 10"),
    ),
)
def pilot_bin_stats(spark, sf_dir):
    october = b._spark_select(
        b.table(spark, sf_dir, "orders").where("month(o_orderdate) = 10"), _PILOT
    )
    rows = reports.label_period(
        binning.qcut(october, "prediction", 12, "predict_bin"),
        dt.date(1999, 10, 5),
        dt.date(1999, 11, 1),
    )
    called = (
        b.table(spark, sf_dir, "events")
        .where("event_type IN ('view', 'click', 'error')")
        .select(F.col("event_id").alias("APP_ID"))
    )
    return b.rounded(reports.pilot_bin_stats(rows, [1998, 1999], called), "mean", "std")


_CUTS = """SELECT clinic, bin_a >= 8 AS a, bin_b >= 8 AS b FROM (SELECT clinic,
    greatest(len(list_filter(ea, lambda e: e < pa)) - 1, 0) AS bin_a,
    greatest(len(list_filter(eb, lambda e: e < pb)) - 1, 0) AS bin_b FROM two,
    (SELECT quantile_cont(pa, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]) AS ea,
    quantile_cont(pb, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]) AS eb FROM two))"""
_TWO = {
    "clinic": "l_returnflag",
    "pa": "l_extendedprice",
    "pb": "l_extendedprice * (1 - l_discount) * l_quantity",
}


@query(
    "reclassification_table",
    b.with_ctes(
        """SELECT clinic, a AS called_by_a, CASE WHEN count(*) FILTER (NOT b) > 0 THEN round_even(
        count(*) FILTER (NOT b) / sum(count(*)) OVER (PARTITION BY clinic) * 100, 2) END
        AS not_called_by_b, CASE WHEN count(*) FILTER (b) > 0 THEN round_even(
        count(*) FILTER (b) / sum(count(*)) OVER (PARTITION BY clinic) * 100, 2) END AS called_by_b
        FROM (SELECT * FROM cuts UNION ALL SELECT 'all', a, b FROM cuts) GROUP BY clinic, a""",
        two=b._sql_select(_TWO, "lineitem"),
        cuts=_CUTS,
    ),
)
def reclassification_table(spark, sf_dir):
    two = b._spark_select(b.table(spark, sf_dir, "lineitem"), _TWO)
    binned = binning.qcut(binning.qcut(two, "pa", 10, "bin_a"), "pb", 10, "bin_b")
    cut_a, cut_b = F.col("bin_a") >= 8, F.col("bin_b") >= 8
    whole = reports.reclassification(binned, cut_a, cut_b).withColumn("clinic", F.lit("all"))
    return reports.reclassification(binned, cut_a, cut_b, ["clinic"]).unionByName(whole)


_GROUPED = """SELECT user_id AS pseudo_id, CASE WHEN user_id % 10 = 0 AND event_type = 'view'
    THEN NULL WHEN user_id % 10 = 1 THEN (event_id % 2)::INTEGER ELSE (user_id % 2)::INTEGER END
    AS treatment_group FROM events"""


@query(
    "group_consistency",
    b.with_ctes(
        """SELECT count(*) AS patients, count(*) FILTER (g <> 1) AS not_one_group,
        count(*) FILTER (m > 0) AS missing_group FROM (SELECT pseudo_id,
        count(DISTINCT treatment_group) AS g, count(*) FILTER (treatment_group IS NULL) AS m
        FROM g GROUP BY 1)""",
        g=_GROUPED,
    ),
)
def group_consistency(spark, sf_dir):
    rows = b.table(spark, sf_dir, "events").selectExpr(
        "user_id AS pseudo_id",
        "CASE WHEN user_id % 10 = 0 AND event_type = 'view' THEN NULL WHEN user_id % 10 = 1"
        " THEN CAST(event_id % 2 AS INT) ELSE CAST(user_id % 2 AS INT) END AS treatment_group",
    )
    return trial.group_consistency(rows)


@query(
    "lowest_scores",
    b.with_ctes(
        """SELECT id, round(prediction, 6) AS prediction FROM predictions
        ORDER BY prediction, id LIMIT 5""",
        "predictions",
    ),
)
def lowest_scores(spark, sf_dir):
    rows = reports.lowest_scores(b.predictions(spark, sf_dir), "prediction", "id", 5)
    return b.rounded(rows.select("id", "prediction"), "prediction")
