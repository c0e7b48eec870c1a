"""History windows, bins, assignment, quality curves."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from rollcall.functions.temporal import DAY_US
from rollcall.operators import binning, features, ordering, quality, trial
from rollcall.plans import bases as b
from rollcall.plans.registry import query
from rollcall.session import scratch_path
from rollcall.sources.tables import read_bins, write_bins

_LAG3 = b._LAG3
_LAG5 = _LAG3.replace("3 DAYS", "5 DAYS")


@query(
    "lagged_cumulative",
    b.with_ctes(
        f"""SELECT "APP_ID", round(coalesce(sum(value) OVER {_LAG5}, 0.0), 6) AS value_sum,
        (count(value) OVER {_LAG5})::BIGINT AS value_count FROM ev JOIN
        (SELECT event_id, CASE WHEN event_type <> 'view' THEN value END AS value FROM events)
        ON event_id = "APP_ID" """,
        "ev",
    ),
)
def lagged_cumulative(spark, sf_dir):
    """Sum and count of a nullable column over rows at least five days old."""
    rows = b.table(spark, sf_dir, "events").selectExpr(
        "event_id AS APP_ID",
        "user_id AS pseudo_id",
        "ts AS start",
        "CASE WHEN event_type <> 'view' THEN value END AS value",
    )
    summed = features.lagged_cumulative(rows, "value", "value_sum", 5 * DAY_US)
    both = features.lagged_cumulative(summed, "value", "value_count", 5 * DAY_US, "count")
    return b.rounded(both.select("APP_ID", "value_sum", "value_count"), "value_sum")


_MISSED_SQL = (
    f"coalesce(sum((missed = 'missed')::INTEGER) OVER {_LAG3}, 0)::BIGINT AS prev_missed,"
    f" (count(missed) OVER {_LAG3})::BIGINT AS earlier_appointments"
)


@query(
    "prev_missed_features",
    b.with_ctes(
        f"""SELECT "APP_ID", prev_missed, earlier_appointments, CASE WHEN
        earlier_appointments = 0 THEN 0.0 ELSE round(prev_missed / earlier_appointments, 6) END
        AS prev_missed_share FROM (SELECT *, {_MISSED_SQL} FROM ev)""",
        "ev",
    ).replace("THEN 0.0 ELSE", "THEN 0.0::DOUBLE ELSE"),
)
def prev_missed_features(spark, sf_dir):
    out = features.prev_missed_features(b.event_appointments(spark, sf_dir)).select(
        "APP_ID", "prev_missed", "earlier_appointments", "prev_missed_share"
    )
    return b.rounded(out, "prev_missed_share")


@query(
    "prev_minutes_early",
    b.with_ctes(
        f"""SELECT "APP_ID", CASE WHEN n = 0 THEN 0.0::DOUBLE
        ELSE round(early / 60000000.0::DOUBLE / n, 6) END AS prev_minutes_early FROM (
        SELECT "APP_ID", count(*) OVER {_LAG3} AS n, coalesce(sum(least(3600000000,
        greatest(-3600000000, coalesce(epoch_us(start) - epoch_us(gearriveerd), 0))))
        OVER {_LAG3}, 0)::BIGINT AS early FROM ev)""",
        "ev",
    ),
)
def prev_minutes_early(spark, sf_dir):
    counted = features.lagged_cumulative(
        b.event_appointments(spark, sf_dir), "missed", "earlier_appointments", func="count"
    )
    out = features.add_prev_minutes_early(counted).select("APP_ID", "prev_minutes_early")
    return b.rounded(out, "prev_minutes_early")


@query(
    "appointments_last_days",
    b.with_ctes(
        f"""SELECT "APP_ID", (count("APP_ID") OVER {b._LAST14})::BIGINT AS appointments_last_days
        FROM ev""",
        "ev",
    ),
)
def appointments_last_days(spark, sf_dir):
    return features.appointments_last_days(b.event_appointments(spark, sf_dir), 14).select(
        "APP_ID", "appointments_last_days"
    )


@query(
    "appointments_same_day",
    b.with_ctes(
        """SELECT "APP_ID", count(*) OVER (PARTITION BY pseudo_id, start::DATE)
        AS appointments_same_day FROM ev""",
        "ev",
    ),
)
def appointments_same_day(spark, sf_dir):
    return features.appointments_same_day(b.event_appointments(spark, sf_dir)).select(
        "APP_ID", "appointments_same_day"
    )


@query(
    "days_since_last",
    b.with_ctes(
        'SELECT "APP_ID", coalesce('
        + b.floor_days_sql("start", "lag(start) OVER (PARTITION BY pseudo_id ORDER BY start)")
        + ", 0) AS days_since_last_appointment FROM cleaned",
        "cleaned",
    ),
)
def days_since_last(spark, sf_dir):
    return features.days_since_last(b.cleaned(spark, sf_dir), stage=True).select(
        "APP_ID", "days_since_last_appointment"
    )


@query(
    "hourly_chunks",
    b.with_ctes(
        f"""SELECT "APP_ID", {_MISSED_SQL}, (count("APP_ID") OVER {b._LAST14})::BIGINT
        AS appointments_last_days, count(*) OVER (PARTITION BY pseudo_id, start::DATE)
        AS appointments_same_day FROM ev""",
        "ev",
    ),
)
def hourly_chunks(spark, sf_dir):
    """The history columns in the chunked form that very busy patients get."""
    hour = DAY_US // 24
    out = features.prev_missed_features(b.event_appointments(spark, sf_dir), chunk_us=hour)
    out = features.appointments_last_days(out, 14, chunk_us=hour)
    return features.appointments_same_day(out, chunk_us=hour).select(
        "APP_ID",
        "prev_missed",
        "earlier_appointments",
        "appointments_last_days",
        "appointments_same_day",
    )


# --- bins ---------------------------------------------------------------------

_SCORED = {
    "APP_ID": "o_orderkey",
    "pseudo_id": "o_custkey",
    "hoofdagenda": "o_orderpriority",
    "clinic": "'clinic ' || o_orderpriority",
    "prediction": "o_totalprice / 500000",
    "start": "o_orderdate",
}
_SCORED_SQL = b._sql_select(_SCORED, "orders")
_TOP_SQL = (
    "SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY pseudo_id"
    ' ORDER BY prediction DESC, "APP_ID") = 1'
)
_EDGES_SQL = (
    "SELECT hoofdagenda, quantile_cont(prediction, [0, 0.25, 0.5, 0.75, 1]) AS edges"
    " FROM top GROUP BY 1"
)
_BINNED_SQL = (
    "SELECT s.*, CASE WHEN prediction > 0 AND prediction <= 1 THEN"
    " len(list_filter(edges[2:], lambda e: e < prediction))::INTEGER END AS score_bin"
    " FROM scored s JOIN edges USING (hoofdagenda)"
)
_BIN_CTES = {"scored": _SCORED_SQL, "top": _TOP_SQL, "edges": _EDGES_SQL}


def scored(spark, sf_dir):
    return b._spark_select(b.table(spark, sf_dir, "orders"), _SCORED)


def edges(spark, sf_dir):
    return binning.bin_edges(scored(spark, sf_dir), "hoofdagenda")


@query(
    "quantile_bins",
    b.with_ctes(
        """SELECT id, greatest(len(list_filter(edges, lambda e: e < prediction)) - 1, 0)::INTEGER
        AS bin FROM predictions, (SELECT quantile_cont(prediction, [0, 0.1, 0.2, 0.3, 0.4, 0.5,
        0.6, 0.7, 0.8, 0.9, 1]) AS edges FROM predictions)""",
        "predictions",
    ),
)
def quantile_bins(spark, sf_dir):
    return binning.qcut(b.predictions(spark, sf_dir), "prediction", 10).select("id", "bin")


@query(
    "top_row_per_patient",
    b.with_ctes(
        'SELECT "APP_ID", pseudo_id, hoofdagenda, prediction FROM top',
        **_BIN_CTES,
    ),
)
def top_row_per_patient(spark, sf_dir):
    out = binning.top_row(scored(spark, sf_dir), "pseudo_id", "prediction", ["APP_ID"])
    return out.select("APP_ID", "pseudo_id", "hoofdagenda", "prediction")


@query(
    "bin_edges_per_group",
    b.with_ctes(
        "SELECT hoofdagenda, unnest([1, 2, 3, 4, 5])::INTEGER AS i,"
        " round(unnest(edges), 9) AS edge FROM edges",
        **_BIN_CTES,
    ),
)
def bin_edges_per_group(spark, sf_dir):
    out = edges(spark, sf_dir).select("hoofdagenda", F.posexplode("edges").alias("i", "edge"))
    return b.rounded(out.withColumn("i", F.col("i") + 1), "edge", decimals=9)


@query(
    "sink_bins_json",
    b.with_ctes(
        "SELECT hoofdagenda, len(edges)::INTEGER AS n, round(edges[3], 9) AS median FROM edges",
        **_BIN_CTES,
    ),
)
def sink_bins_json(spark, sf_dir):
    path = scratch_path(spark, "bins")
    write_bins(edges(spark, sf_dir), path)
    out = read_bins(spark, path).select(
        "hoofdagenda", F.size("edges").alias("n"), F.element_at("edges", 3).alias("median")
    )
    return b.rounded(out, "median", decimals=9)


@query(
    "apply_score_bins",
    b.with_ctes('SELECT "APP_ID", score_bin FROM binned', **_BIN_CTES, binned=_BINNED_SQL),
)
def apply_score_bins(spark, sf_dir):
    return binning.apply_bins(
        scored(spark, sf_dir), edges(spark, sf_dir), "hoofdagenda"
    ).select("APP_ID", "score_bin")


# --- assignment ---------------------------------------------------------------


@query(
    "alternate_assignment",
    b.with_ctes(
        """SELECT "APP_ID", ((row_number() OVER (PARTITION BY hoofdagenda, score_bin
        ORDER BY prediction DESC, "APP_ID") - 1) % 2)::INTEGER AS arm FROM binned""",
        **_BIN_CTES,
        binned=_BINNED_SQL,
    ),
)
def alternate_assignment(spark, sf_dir):
    binned = binning.apply_bins(scored(spark, sf_dir), edges(spark, sf_dir), "hoofdagenda")
    return trial.alternate(binned, ["hoofdagenda", "score_bin"], seed=None).select("APP_ID", "arm")


_RCT = ("clinic 1-URGENT", "clinic 2-HIGH", "clinic 3-MEDIUM")
_RCT_SQL = ", ".join(f"'{c}'" for c in _RCT)
_GROUP_CTES = {
    **_BIN_CTES,
    "binned": _BINNED_SQL,
    "grouped": f"""SELECT s.*, CASE WHEN clinic NOT IN ({_RCT_SQL}) THEN 2
        ELSE k.treatment_group END AS known FROM binned s
        LEFT JOIN patients k ON k.id = s.pseudo_id""",
    "drawn": """SELECT pseudo_id, (row_number() OVER (PARTITION BY hoofdagenda, score_bin
        ORDER BY prediction DESC, "APP_ID") - 1) % 2 AS arm FROM grouped WHERE known IS NULL
        AND score_bin IS NOT NULL""",
    "modes": """SELECT pseudo_id, CASE WHEN sum(arm) * 2 > count(*) THEN 1 ELSE 0 END AS m
        FROM drawn GROUP BY 1""",
    "assigned": """SELECT g.*, coalesce(known, m)::INTEGER AS treatment_group FROM grouped g
        LEFT JOIN modes USING (pseudo_id)""",
}


def assigned(spark, sf_dir):
    return trial.treatment_groups(
        scored(spark, sf_dir),
        b.patients(spark, sf_dir),
        edges(spark, sf_dir),
        _RCT,
        seed=None,
    )


@query(
    "treatment_groups",
    b.with_ctes(
        'SELECT "APP_ID", pseudo_id, treatment_group FROM assigned', "patients", **_GROUP_CTES
    ),
)
def treatment_groups(spark, sf_dir):
    return assigned(spark, sf_dir).select("APP_ID", "pseudo_id", "treatment_group")


_FIRST = (
    "SELECT * FROM assigned QUALIFY row_number() OVER (PARTITION BY pseudo_id"
    ' ORDER BY prediction DESC, "APP_ID") = 1'
)
_BALANCE = (
    "SELECT '{name}' AS part, hoofdagenda, treatment_group, score_bin, count(*) AS n"
    " FROM {source} GROUP BY ALL"
)


@query(
    "strata_balance",
    b.with_ctes(
        _BALANCE.format(name="all", source="assigned")
        + " UNION ALL "
        + _BALANCE.format(name="first", source="firsts"),
        "patients",
        **_GROUP_CTES,
        firsts=_FIRST,
    ),
)
def strata_balance(spark, sf_dir):
    rows = assigned(spark, sf_dir)
    parts = [
        trial.strata_balance(rows, first_per_patient=first).withColumn("part", F.lit(name))
        for name, first in (("all", False), ("first", True))
    ]
    return parts[0].unionByName(parts[1])


@query(
    "daily_assignment_replay",
    b.with_ctes(
        """SELECT r."APP_ID", r.pseudo_id, score_bin, m AS treatment_group FROM binned r
        LEFT JOIN (SELECT pseudo_id, (CASE WHEN sum(arm) * 2 > count(*) THEN 1 ELSE 0 END)::INTEGER
        AS m FROM (SELECT pseudo_id, (row_number() OVER (PARTITION BY start::DATE, hoofdagenda,
        score_bin ORDER BY prediction DESC, "APP_ID") - 1) % 2 AS arm FROM binned
        JOIN (SELECT pseudo_id, min(start::DATE) AS d FROM binned GROUP BY 1) USING (pseudo_id)
        WHERE start::DATE = d) GROUP BY 1) USING (pseudo_id)""",
        **_BIN_CTES,
        binned=_BINNED_SQL,
    ),
)
def daily_assignment_replay(spark, sf_dir):
    """Day-by-day assignment of all orders, patients keeping their first group."""
    none = spark.createDataFrame([], "id long, treatment_group int")
    out = trial.replay_assignment(
        scored(spark, sf_dir), edges(spark, sf_dir), [], none, seed=None
    )
    return out.select("APP_ID", "pseudo_id", "score_bin", "treatment_group")


# --- splits -------------------------------------------------------------------


@query(
    "temporal_split",
    """SELECT event_id AS "APP_ID", row_number() OVER (ORDER BY ts, event_id) >
    (SELECT count(*) - ceil(0.2 * count(*)) FROM events) AS is_test FROM events""",
)
def temporal_split(spark, sf_dir):
    rows = b.event_appointments(spark, sf_dir)
    return ordering.temporal_split(rows, ["start", "APP_ID"]).select(
        "APP_ID", "is_test"
    )


@query(
    "time_series_cv",
    """SELECT fold, count(*) AS n, min(o_orderdate)::DATE AS first_day,
    max(o_orderdate)::DATE AS last_day FROM (SELECT o_orderdate, CASE WHEN r < n - 10 * s THEN 0
    ELSE ((r - (n - 10 * s)) // s)::INTEGER + 1 END AS fold FROM (SELECT o_orderdate,
    row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS r, count(*) OVER () AS n,
    count(*) OVER () // 11 AS s FROM orders)) GROUP BY fold""",
)
def time_series_cv(spark, sf_dir):
    rows = scored(spark, sf_dir).select("start", "APP_ID")
    folds = ordering.time_folds(rows, ["start", "APP_ID"], 10)
    return folds.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"),
        F.to_date(F.min("start")).alias("first_day"),
        F.to_date(F.max("start")).alias("last_day"),
    )


# --- quality ------------------------------------------------------------------

_LABELLED = {
    "id": "event_id",
    "start": "ts",
    "y": "CASE WHEN event_type = 'error' THEN 1 ELSE 0 END",
    "score": "value / 500",
}
_LABELLED_SQL = b._sql_select(_LABELLED, "events")


def labelled_scores(spark, sf_dir):
    return b._spark_select(b.table(spark, sf_dir, "events"), _LABELLED)


_AUC_SQL = (
    "SELECT {key} round((sum(r) FILTER (y = 1) - p * (p + 1) / 2.0) / (p * (n - p)), 6) AS auc,"
    " n FROM (SELECT {key} y, {rank} AS r, {count} AS n, {pos} AS p FROM {source})"
    " GROUP BY {key} n, p"
)
_RANK = (
    "rank() OVER ({part} ORDER BY score) + (count(*) OVER ({part2} score) - 1) / 2.0"
)


@query(
    "roc_auc_exact",
    b.with_ctes(
        _AUC_SQL.format(
            key="",
            rank=_RANK.format(part="", part2="PARTITION BY"),
            count="count(*) OVER ()",
            pos="sum(y) OVER ()",
            source="s",
        ),
        s=_LABELLED_SQL,
    ),
)
def roc_auc_exact(spark, sf_dir):
    return b.rounded(quality.roc_auc(labelled_scores(spark, sf_dir), "score", "y"), "auc")


_PER_SCORE = (
    "SELECT score, sum(y) AS pos, count(*) - sum(y) AS neg,"
    " sum(sum(y)) OVER (ORDER BY score DESC) AS tp,"
    " sum(count(*) - sum(y)) OVER (ORDER BY score DESC) AS fp FROM s GROUP BY score"
)


@query(
    "roc_points",
    b.with_ctes(
        """SELECT round(score, 6) AS threshold, round(fp / (SELECT count(*) - sum(y) FROM s), 6)
        AS fpr, round(tp / (SELECT sum(y) FROM s), 6) AS tpr FROM (SELECT *,
        lead(pos) OVER (ORDER BY score DESC) AS np, lead(neg) OVER (ORDER BY score DESC) AS nn,
        row_number() OVER (ORDER BY score DESC) AS place
        FROM c) WHERE place = 1 OR np IS NULL OR np <> pos OR nn <> neg
        UNION ALL SELECT 'infinity'::DOUBLE, 0.0, 0.0""",
        s=_LABELLED_SQL,
        c=_PER_SCORE,
    ),
)
def roc_points(spark, sf_dir):
    out = quality.roc_points(labelled_scores(spark, sf_dir), "score", "y")
    finite = F.when(F.col("threshold") == float("inf"), F.col("threshold")).otherwise(
        F.round("threshold", 6)
    )
    return b.rounded(out.withColumn("threshold", finite), "fpr", "tpr")


@query(
    "precision_recall_points",
    b.with_ctes(
        """SELECT round(score, 6) AS threshold, round(tp / (tp + fp), 6) AS precision,
        round(tp / (SELECT sum(y) FROM s), 6) AS recall FROM c
        UNION ALL SELECT NULL, 1.0, 0.0""",
        s=_LABELLED_SQL,
        c=_PER_SCORE,
    ),
)
def precision_recall_points(spark, sf_dir):
    out = quality.pr_points(labelled_scores(spark, sf_dir), "score", "y")
    return b.rounded(out, "threshold", "precision", "recall")


def _bucket_sql(n: int) -> str:
    inner = ", ".join(repr(i * (1.0 / n)) + "::DOUBLE" for i in range(1, n))
    return f"len(list_filter([{inner}], lambda e: e < score))::INTEGER"


@query(
    "calibration_curve",
    b.with_ctes(
        " UNION ALL ".join(
            f"SELECT {n} AS bins, {_bucket_sql(n)} AS bucket, round(avg(score), 6) AS prob_pred,"
            " round(avg(y), 6) AS prob_true, count(*) AS n FROM s GROUP BY 2"
            for n in (10, 20)
        ),
        s=_LABELLED_SQL,
    ),
)
def calibration_curve(spark, sf_dir):
    rows = labelled_scores(spark, sf_dir)
    parts = [
        quality.calibration(rows, "score", "y", n).withColumn("bins", F.lit(n)) for n in (10, 20)
    ]
    return b.rounded(parts[0].unionByName(parts[1]), "prob_pred", "prob_true")


_MONTHLY = {
    "id": "o_orderkey",
    "start": "o_orderdate",
    "y": "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END",
    "score": "o_totalprice / 500000",
}
_MONTHLY_SQL = b._sql_select(_MONTHLY, "orders")


def monthly_scores(spark, sf_dir):
    return b._spark_select(b.table(spark, sf_dir, "orders"), _MONTHLY)


@query(
    "calibration_error",
    b.with_ctes(
        f"""SELECT month, round(sum(abs(p - t) * n) / sum(n), 6) AS ece, sum(n)::BIGINT AS n FROM (
        SELECT date_trunc('month', start)::DATE AS month, {_bucket_sql(10)} AS bucket,
        avg(score) AS p, avg(y) AS t, count(*) AS n FROM s GROUP BY 1, 2) GROUP BY month""",
        s=_MONTHLY_SQL,
    ),
)
def calibration_error(spark, sf_dir):
    rows = monthly_scores(spark, sf_dir).withColumn("month", F.trunc(F.to_date("start"), "MM"))
    return b.rounded(quality.calibration_error(rows, "score", "y", 10, ["month"]), "ece")


def _smooth_sql() -> str:
    cells, waves = quality.SMOOTH_CELLS, quality.SMOOTH_WAVES
    steps = ["h0 AS (SELECT month, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high FROM totals)"]
    for k in range(quality.SMOOTH_HALVINGS):
        steps.append(f"""h{k + 1} AS MATERIALIZED (
          SELECT month, CASE WHEN e > m THEN m ELSE low END AS low, CASE WHEN e > m THEN high ELSE m END AS high FROM (
            SELECT month, low, high, m, sum(abs(v) * CASE WHEN t IN (0, {cells}) THEN 0.5::DOUBLE ELSE 1 END) / {cells} AS e FROM (
              SELECT month, low, high, (low + high) / 2 AS m, t,
                     sum(a * exp(-pow(k * (low + high) / 2 * pi(), 2) / 2) * cos(k * t * (pi() / {cells}))) AS v
              FROM h{k} JOIN waves USING (month), range(0, {cells + 1}) g(t) GROUP BY ALL) GROUP BY ALL))""")
    return f"""SELECT month, round((low + high) / 2, 6) AS smooth_ece, n FROM h{quality.SMOOTH_HALVINGS} JOIN totals USING (month)""", {
        "s": _MONTHLY_SQL,
        "placed": f"""SELECT month, y - f AS gap, f * {cells} AS p, least(floor(f * {cells}), {cells - 1}) AS c FROM (
            SELECT date_trunc('month', start)::DATE AS month, y, least(greatest(score, 0), 1)::DOUBLE AS f FROM s)""",
        "totals": "SELECT month, count(*)::BIGINT AS n FROM placed GROUP BY month",
        "cells": """SELECT month, cell, sum(gap) AS gap FROM (
            SELECT month, unnest([c, c + 1]) AS cell, unnest([(1 - (p - c)) * gap, (p - c) * gap]) AS gap FROM placed) GROUP BY ALL""",
        "waves": f"""SELECT month, k, (CASE WHEN k = 0 THEN 1 ELSE 2 END) * sum(gap * cos(k * cell * (pi() / {cells}))) / any_value(n) AS a
            FROM cells JOIN totals USING (month), range(0, {waves + 1}) w(k) GROUP BY month, k""",
    }, ", ".join(steps)


def _smooth_oracle() -> str:
    body, ctes, steps = _smooth_sql()
    named = ", ".join(f"{name} AS MATERIALIZED ({sql})" for name, sql in ctes.items())
    return f"WITH {named}, {steps} {body}"


@query("smoothed_calibration_error", _smooth_oracle())
def smoothed_calibration_error(spark, sf_dir):
    rows = monthly_scores(spark, sf_dir).withColumn("month", F.trunc(F.to_date("start"), "MM"))
    return b.rounded(quality.smoothed_calibration_error(rows, "score", "y", ["month"]), "smooth_ece")


@query(
    "monthly_auc",
    b.with_ctes(
        _AUC_SQL.format(
            key="month,",
            rank=_RANK.format(part="PARTITION BY month", part2="PARTITION BY month,"),
            count="count(*) OVER (PARTITION BY month)",
            pos="sum(y) OVER (PARTITION BY month)",
            source="(SELECT *, date_trunc('month', start)::DATE AS month FROM s"
            " WHERE start < TIMESTAMP '2001-07-01 00:00:00')",
        ),
        s=_MONTHLY_SQL,
    ),
)
def monthly_auc(spark, sf_dir):
    out = quality.monthly_auc(monthly_scores(spark, sf_dir), "score", "y", dt.date(2001, 7, 20))
    return b.rounded(out, "auc")


_AUC_EXACT_SQL = _AUC_SQL.replace(" round(", " (").replace("(p * (n - p)), 6)", "nullif(p * (n - p), 0))")


@query(
    "monthly_auc_sampled",
    b.with_ctes(
        "SELECT round(avg(auc), 6) AS mean_auc, round(min(auc), 6) AS min_auc, round(max(auc), 6) AS max_auc,"
        " count(*) AS months FROM ("
        + _AUC_EXACT_SQL.format(
            key="month,",
            rank=_RANK.format(part="PARTITION BY month", part2="PARTITION BY month,"),
            count="count(*) OVER (PARTITION BY month)",
            pos="sum(y) OVER (PARTITION BY month)",
            source="(SELECT *, date_trunc('month', start)::DATE AS month FROM s"
            " WHERE start < TIMESTAMP '2001-07-01 00:00:00' AND md5(id::VARCHAR || '|0') < '33333333')",
        )
        + ")",
        s=_MONTHLY_SQL,
    ),
)
def monthly_auc_sampled(spark, sf_dir):
    """The monitoring figure on a reproducible fifth of the rows, and its summary."""
    out = quality.auc_summary(
        quality.monthly_auc(
            monthly_scores(spark, sf_dir), "score", "y", dt.date(2001, 7, 20), key="id", fraction=0.2
        )
    )
    return b.rounded(out, "mean_auc", "min_auc", "max_auc")


_KS = ", ".join(str(k) for k in quality.DAILY_KS)


_TOP_K_SQL = f"""SELECT k, round(avg(prec), 6) AS mean_precision, round(stddev_pop(prec), 6)
        AS std_precision, round(avg(rec), 6) AS mean_recall, round(stddev_pop(rec), 6)
        AS std_recall, count(*) AS days FROM (SELECT k, d, hits / least(k, n) AS prec,
        CASE WHEN p = 0 THEN 0 ELSE hits / p END AS rec FROM (SELECT k, d, count(*) AS n,
        sum(y) AS p, coalesce(sum(y) FILTER (r <= k), 0) AS hits FROM (SELECT start::DATE AS d, y,
        row_number() OVER (PARTITION BY start::DATE ORDER BY {{score}} DESC, id) AS r FROM s
        WHERE isodow(start) < 6), (SELECT unnest([{_KS}])::INTEGER AS k) GROUP BY k, d)) GROUP BY k"""
_TOP_K_FIGURES = ("mean_precision", "std_precision", "mean_recall", "std_recall")


@query("daily_top_k", b.with_ctes(_TOP_K_SQL.format(score="score"), s=_LABELLED_SQL))
def daily_top_k(spark, sf_dir):
    out = quality.daily_top_k(labelled_scores(spark, sf_dir), "start", "score", "y", "id")
    return b.rounded(out, *_TOP_K_FIGURES)


@query(
    "daily_top_k_random",
    b.with_ctes(_TOP_K_SQL.format(score="md5(id::VARCHAR || '|0')"), s=_LABELLED_SQL),
)
def daily_top_k_random(spark, sf_dir):
    out = quality.daily_top_k_random(labelled_scores(spark, sf_dir), "start", "y", "id")
    return b.rounded(out, *_TOP_K_FIGURES)
