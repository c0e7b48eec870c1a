"""Joins: extract, enrichment, semi and anti joins."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from rollcall.operators import cleaning, extract, features, ledger, outreach, reports, trial
from rollcall.plans import bases as b
from rollcall.plans.registry import query
from rollcall.plans.scalars import _ENC_SQL, _EXCLUSION_SQL, encounters
from rollcall.streaming.scoring import attach_sensitive

DAY = dt.date(2024, 1, 18)
DAY_SQL = "TIMESTAMP '2024-01-18 00:00:00'"


@query(
    "star_extract",
    """SELECT o.o_orderkey AS "APP_ID", upper(sha256(c_custkey::VARCHAR || 'pepper')) AS pseudo_id,
    r_name AS hoofdagenda, r_regionkey::VARCHAR AS hoofdagenda_id,
    n_nationkey::VARCHAR AS subagenda_id, o_orderpriority AS specialty_code, l_linenumber AS line,
    l_extendedprice AS price, date_diff('minute', o_orderdate, l_shipdate) AS "minutesDuration",
    1930 + (c_custkey % 80)::INTEGER AS "BIRTH_YEAR", s_nationkey AS postal, p_name AS place
    FROM lineitem JOIN orders o ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    LEFT JOIN supplier ON s_suppkey = c_custkey
    LEFT JOIN part ON p_partkey = l_partkey AND p_size < 25""",
)
def star_extract(spark, sf_dir):
    """Lineitem as encounters; nation/region the agendas, supplier the address (one
    per patient, often missing), small parts the locations."""
    system = F.lit("sys")
    orders = b.table(spark, sf_dir, "orders")
    customer = b.table(spark, sf_dir, "customer")
    encounter = (
        b.table(spark, sf_dir, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").alias("APP_ID"),
            F.col("l_linenumber").alias("line"),
            F.col("l_extendedprice").alias("price"),
            system.alias("subagenda_system"),
            F.col("c_nationkey").cast("string").alias("subagenda_id"),
            system.alias("patient_system"),
            F.col("c_custkey").alias("patient_value"),
            system.alias("location_system"),
            F.col("l_partkey").alias("location_value"),
            F.col("o_orderpriority").alias("soort_consult"),
            F.col("o_orderpriority").alias("afspraak_code"),
            F.col("o_orderdate").alias("start"),
            F.col("l_shipdate").alias("end"),
            F.col("l_shipdate").alias("gearriveerd"),
            F.col("o_orderdate").alias("created"),
            F.col("o_orderstatus").alias("status"),
            *[
                F.lit(None).cast("string").alias(c)
                for c in ("status_code_original", "mutationReason_code", "mutationReason_display")
            ],
        )
    )
    subagenda = b.table(spark, sf_dir, "nation").select(
        system.alias("system"),
        F.col("n_nationkey").cast("string").alias("value"),
        F.col("n_name").alias("name"),
        F.lit("x").alias("specialty_code"),
        F.lit(1).alias("active"),
        system.alias("parent_system"),
        F.col("n_regionkey").cast("string").alias("parent_value"),
    )
    agenda = b.table(spark, sf_dir, "region").select(
        system.alias("system"),
        F.col("r_regionkey").cast("string").alias("value"),
        F.col("r_name").alias("name"),
        F.lit(1).alias("active"),
    )
    patient = customer.select(
        system.alias("system"),
        F.col("c_custkey").alias("value"),
        F.make_date(
            (F.lit(1930) + F.col("c_custkey") % 80).cast("int"), F.lit(1), F.lit(1)
        ).alias("birth_date"),
        F.lit(0).alias("deceased"),
    )
    address = b.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("parent_value"),
        F.col("s_nationkey").alias("postal_code"),
        F.lit(1).alias("active"),
    )
    location = (
        b.table(spark, sf_dir, "part")
        .where("p_size < 25")
        .select(
            system.alias("system"),
            F.col("p_partkey").alias("value"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("description"),
        )
    )
    joined = extract.star_extract(encounter, subagenda, agenda, patient, address, location)
    named = joined.withColumn("specialty_code", F.col("soort_consult"))
    # Line and price tell the repeated order lines apart.
    return extract.to_appointment(named, "pepper", keep=["line", "price"]).select(
        "APP_ID",
        "pseudo_id",
        "hoofdagenda",
        "hoofdagenda_id",
        "subagenda_id",
        "specialty_code",
        "minutesDuration",
        "BIRTH_YEAR",
        "line",
        "price",
        F.col("address_postalCodeNumbersNL").alias("postal"),
        F.col("name").alias("place"),
    )


@query(
    "extract_order",
    """SELECT n_name, r_name, o_orderkey, o_orderdate FROM orders
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey ORDER BY r_name, n_name, o_orderdate, o_orderkey""",
)
def extract_order(spark, sf_dir):
    dims = b.table(spark, sf_dir, "nation").join(
        b.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    people = b.table(spark, sf_dir, "customer").join(dims, F.col("c_nationkey") == F.col("n_nationkey"))
    return (
        b.table(spark, sf_dir, "orders")
        .join(people, F.col("o_custkey") == F.col("c_custkey"))
        .select("n_name", "r_name", "o_orderkey", "o_orderdate")
        .orderBy("r_name", "n_name", "o_orderdate", "o_orderkey")
    )


@query(
    "left_join_turned_inner",
    """SELECT o_orderkey, c_acctbal FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    WHERE c_acctbal > 5000""",
)
def left_join_turned_inner(spark, sf_dir):
    orders = b.table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    rows = extract.left_filtered(
        orders, b.table(spark, sf_dir, "customer"), "c_custkey", F.col("c_acctbal") > 5000
    )
    return rows.select("o_orderkey", "c_acctbal")


@query(
    "active_patient_semi",
    b.with_ctes(
        f"""SELECT "APP_ID", line, start, type1_code, patient_value FROM enc
        WHERE type1_code NOT IN ('FAMF', 'FAMT', 'FAMS') AND patient_value IN (
        SELECT patient_value FROM enc WHERE start >= TIMESTAMP '2001-04-16 00:00:00'
        AND start < TIMESTAMP '2001-04-17 00:00:00' AND status = 'planned'
        AND {_EXCLUSION_SQL.replace("type1_code NOT IN ('FAMF', 'FAMT', 'FAMS') AND ", "")})""",
        enc=_ENC_SQL,
    ),
)
def active_patient_semi(spark, sf_dir):
    rows = extract.active_patient_history(encounters(spark, sf_dir), dt.date(2001, 4, 16))
    return rows.select("APP_ID", "line", "start", "type1_code", "patient_value")


@query(
    "cohort_semi_by_date",
    b.with_ctes(
        """SELECT "APP_ID", _seq, clinic, start FROM ruled WHERE pseudo_id IN (
        SELECT pseudo_id FROM ruled WHERE start::DATE = DATE '2001-03-01')""",
        "ruled",
    ),
)
def cohort_semi_by_date(spark, sf_dir):
    tagged = cleaning.apply_clinic_rules(b.appointments(spark, sf_dir), b.RULES)
    return cleaning.cohort_by_date(tagged, b.START_DATE).select("APP_ID", "_seq", "clinic", "start")


@query(
    "geo_enrich",
    b.with_ctes(
        f"""SELECT "APP_ID", _seq, round({b.haversine_sql('latitude', 'longitude')}, 6)
        AS dist_hospital, (year(start) - "BIRTH_YEAR")::INTEGER AS age FROM appts
        JOIN postal ON "address_postalCodeNumbersNL" = postalcode""",
        "appts",
        "postal",
    ),
)
def geo_enrich(spark, sf_dir):
    out = features.add_patient_features(
        b.appointments(spark, sf_dir), b.postal_codes(spark, sf_dir)
    )
    return b.rounded(out.select("APP_ID", "_seq", "dist_hospital", "age"), "dist_hospital")


@query(
    "attach_sensitive",
    b.with_ctes(
        """SELECT e.pseudo_id, e.start, round(e.prediction, 6) AS prediction,
        c.full_name AS name_text, c.mobile_phone AS telecom1_value FROM
        (SELECT user_id AS pseudo_id, ts AS start, value / 500 AS prediction FROM events) e
        LEFT JOIN (SELECT user_id AS pseudo_id, ts AS start, full_name, mobile_phone FROM events
        JOIN contacts ON user_id = patient_id WHERE event_type <> 'purchase') c
        ON e.pseudo_id = c.pseudo_id AND e.start = c.start""",
        "contacts",
    ),
)
def q_attach_sensitive(spark, sf_dir):
    events = b.table(spark, sf_dir, "events")
    scored = events.selectExpr("user_id AS pseudo_id", "ts AS start", "value / 500 AS prediction")
    known = (
        events.where("event_type <> 'purchase'")
        .join(b.contacts(spark, sf_dir), F.col("user_id") == F.col("patient_id"))
        .select(
            F.col("user_id").alias("pseudo_id"),
            F.col("ts").alias("start"),
            F.col("full_name").alias("name_text"),
            F.col("mobile_phone").alias("telecom1_value"),
        )
    )
    return b.rounded(
        attach_sensitive(scored, known, ["name_text", "telecom1_value"]), "prediction"
    )


@query(
    "known_groups",
    b.with_ctes(
        """SELECT APP_ID, pseudo_id, treatment_group FROM ev LEFT JOIN patients
        ON pseudo_id = id""",
        "ev",
        "patients",
    ).replace("APP_ID,", '"APP_ID",'),
)
def known_groups(spark, sf_dir):
    rows = b.event_appointments(spark, sf_dir).select("APP_ID", "pseudo_id")
    return trial.join_known_groups(rows, b.patients(spark, sf_dir))


@query(
    "prediction_context",
    b.with_ctes(
        f"""SELECT p.id, p.patient_id, start_time, clinic_name, clinic_teleq_unit,
        clinic_reception, call_status, r."timestamp" FROM predictions p
        LEFT JOIN calls c ON c.prediction_id = p.id LEFT JOIN requests r ON r.id = p.request_id
        WHERE active AND start_time >= {DAY_SQL} ORDER BY patient_id, start_time""",
        "predictions",
        "calls",
        "requests",
    ),
)
def prediction_context(spark, sf_dir):
    return outreach.prediction_context(
        b.predictions(spark, sf_dir), b.calls(spark, sf_dir), b.requests(spark, sf_dir), DAY
    ).orderBy("patient_id", "start_time")


@query(
    "kpi_base",
    b.with_ctes(
        """SELECT p.id, start_time, clinic_name, call_status, call_outcome, opt_out
        FROM predictions p LEFT JOIN calls c ON c.prediction_id = p.id
        LEFT JOIN patients t ON t.id = p.patient_id
        WHERE start_time::DATE BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'
        AND treatment_group >= 1""",
        "predictions",
        "calls",
        "patients",
    ),
)
def q_kpi_base(spark, sf_dir):
    return reports.kpi_base(
        b.predictions(spark, sf_dir),
        b.calls(spark, sf_dir),
        b.patients(spark, sf_dir),
        dt.date(2024, 1, 8),
        dt.date(2024, 1, 21),
    )


MONITOR_SQL = """SELECT p.id, r."timestamp", api_version, response_code, round(runtime, 6)
    AS runtime, round(prediction, 6) AS prediction, clinic_name FROM predictions p
    LEFT JOIN requests r ON r.id = p.request_id LEFT JOIN patients t ON t.id = p.patient_id
    WHERE r."timestamp"::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-16'
    AND treatment_group >= 1"""


def monitoring(spark, sf_dir):
    return reports.monitoring_base(
        b.predictions(spark, sf_dir),
        b.requests(spark, sf_dir),
        b.patients(spark, sf_dir),
        dt.date(2024, 1, 5),
        dt.date(2024, 1, 16),
    )


@query("monitoring_base", b.with_ctes(MONITOR_SQL, "predictions", "requests", "patients"))
def q_monitoring_base(spark, sf_dir):
    return b.rounded(monitoring(spark, sf_dir), "runtime", "prediction")


@query(
    "called_cohort_inner",
    b.with_ctes(
        """SELECT p.id, p.patient_id, call_status, call_outcome, c."timestamp" FROM predictions p
        JOIN calls c ON c.prediction_id = p.id""",
        "predictions",
        "calls",
    ),
)
def called_cohort_inner(spark, sf_dir):
    return reports.called_cohort(b.predictions(spark, sf_dir), b.calls(spark, sf_dir)).select(
        "id", "patient_id", "call_status", "call_outcome", "timestamp"
    )


# Outcome export: orders as the appointments the predictions were made for.
_OUTCOME = {
    "APP_ID": "o_orderkey",
    "start": "TIMESTAMP '2024-01-01 00:00:00' + (o_orderkey % 30) * INTERVAL '1' DAY",
    "outcome": "CASE o_orderstatus WHEN 'F' THEN 'Missed' WHEN 'O' THEN 'Attended' END",
}
TRIAL_CTES = {
    "outcomes": b._sql_select(_OUTCOME, "orders"),
    "combined": """SELECT p.id, p.patient_id, prediction, date_trunc('day', start_time)
        AS start_time, clinic_name, call_status, call_outcome, treatment_group, start, outcome
        FROM predictions p LEFT JOIN calls c ON c.prediction_id = p.id
        LEFT JOIN patients t ON t.id = p.patient_id LEFT JOIN outcomes x ON x."APP_ID" = p.id
        WHERE treatment_group IS NULL OR treatment_group <> 2""",
}


def trial_rows(spark, sf_dir):
    scored = b.predictions(spark, sf_dir).withColumn(
        "start_time", F.date_trunc("day", "start_time").cast("timestamp_ntz")
    )
    outcomes = b._spark_select(b.table(spark, sf_dir, "orders"), _OUTCOME)
    return reports.trial_combine(
        scored, b.calls(spark, sf_dir), b.patients(spark, sf_dir), outcomes
    )


@query(
    "trial_combine",
    b.with_ctes(
        """SELECT id, treatment_group, call_outcome, start, outcome,
        round(prediction, 6) AS prediction FROM combined""",
        "predictions",
        "calls",
        "patients",
        **TRIAL_CTES,
    ),
)
def q_trial_combine(spark, sf_dir):
    rows = trial_rows(spark, sf_dir).select(
        "id", "treatment_group", "call_outcome", "start", "outcome", "prediction"
    )
    return b.rounded(rows, "prediction")


@query(
    "rekey_foreign_key",
    """SELECT event_id, o_orderkey + 500000 AS prediction_id, event_type FROM events
    LEFT JOIN orders ON 'A' || o_orderkey::VARCHAR = 'A' || event_id::VARCHAR""",
)
def rekey_foreign_key(spark, sf_dir):
    child = b.table(spark, sf_dir, "events").selectExpr(
        "event_id", "'A' || CAST(event_id AS STRING) AS prediction_id", "event_type"
    )
    parent = b.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey + 500000 AS id", "'A' || CAST(o_orderkey AS STRING) AS appointment_id"
    )
    return ledger.rekey(child, parent, "prediction_id", "appointment_id")


# Mute period of half a month: 15 days before Monday 15 January (three working
# days before Thursday the 18th).
MUTED_SQL = """SELECT DISTINCT patient_id, clinic_name FROM predictions p
    JOIN calls c ON c.prediction_id = p.id WHERE c."timestamp" >= TIMESTAMP '2023-12-31 00:00:00'
    AND c."timestamp" < TIMESTAMP '2024-01-15 00:00:00'
    AND call_status IN ('Gebeld', 'Onbereikbaar')"""


@query(
    "call_mute_anti",
    b.with_ctes(
        f"""SELECT DISTINCT patient_id, clinic_name FROM predictions p
        WHERE start_time >= {DAY_SQL} AND NOT EXISTS (SELECT 1 FROM muted m
        WHERE m.patient_id = p.patient_id AND m.clinic_name = p.clinic_name)""",
        "predictions",
        "calls",
        muted=MUTED_SQL,
    ),
)
def call_mute_anti(spark, sf_dir):
    made = b.predictions(spark, sf_dir)
    listed = (
        made.where(F.col("start_time") >= F.lit(DAY)).select("patient_id", "clinic_name").distinct()
    )
    return outreach.mute_anti(listed, made, b.calls(spark, sf_dir), DAY, 0.5)


LISTED_SQL = f"""SELECT patient_id, treatment_group, score FROM (
    SELECT patient_id, treatment_group, clinic_name, max(prediction) AS score FROM predictions p
    JOIN patients t ON t.id = p.patient_id WHERE start_time::DATE = {DAY_SQL}::DATE AND active
    AND treatment_group >= 1 AND (opt_out IS NULL OR opt_out = 0) AND prediction >= 0.01
    GROUP BY 1, 2, 3) g WHERE NOT EXISTS (SELECT 1 FROM muted m WHERE m.patient_id = g.patient_id
    AND m.clinic_name = g.clinic_name)
    QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY treatment_group, score DESC) = 1"""


def listed(spark, sf_dir):
    return outreach.call_list(
        b.predictions(spark, sf_dir),
        b.patients(spark, sf_dir),
        b.calls(spark, sf_dir),
        DAY,
        threshold=0.01,
        months=0.5,
    )


@query(
    "call_list",
    b.with_ctes(
        """SELECT patient_id, treatment_group, round(score, 6) AS score FROM listed
        ORDER BY treatment_group, score DESC, patient_id""",
        "predictions",
        "calls",
        "patients",
        muted=MUTED_SQL,
        listed=LISTED_SQL,
    ),
)
def q_call_list(spark, sf_dir):
    return b.rounded(listed(spark, sf_dir), "score")


@query(
    "uncalled_today",
    b.with_ctes(
        """SELECT patient_id, treatment_group, round(score, 6) AS score FROM listed
        WHERE patient_id NOT IN (SELECT patient_id FROM predictions p JOIN calls c
        ON c.prediction_id = p.id WHERE active AND c."timestamp"::DATE = DATE '2024-01-15'
        AND call_outcome IN ('Herinnerd', 'Voicemail ingesproken', 'Verzet/Geannuleerd',
        'Onbereikbaar')) ORDER BY treatment_group, score DESC, patient_id LIMIT 1""",
        "predictions",
        "calls",
        "patients",
        muted=MUTED_SQL,
        listed=LISTED_SQL,
    ),
)
def uncalled_today(spark, sf_dir):
    first = outreach.first_uncalled(
        listed(spark, sf_dir),
        b.predictions(spark, sf_dir),
        b.calls(spark, sf_dir),
        dt.date(2024, 1, 15),
    )
    return b.rounded(first, "score")


@query(
    "phone_lookup",
    b.with_ctes(
        """SELECT DISTINCT patient_id FROM contacts WHERE (mobile_phone = '069'
        OR home_phone = '069' OR other_phone = '069')
        AND patient_id IN (SELECT patient_id FROM predictions)""",
        "contacts",
        "predictions",
    ),
)
def q_phone_lookup(spark, sf_dir):
    return outreach.phone_lookup(
        b.contacts(spark, sf_dir), "069", b.predictions(spark, sf_dir)
    )


@query(
    "not_in_exclusion",
    """SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (
    SELECT o_custkey FROM orders WHERE o_totalprice > 300000)""",
)
def not_in_exclusion(spark, sf_dir):
    dear = b.table(spark, sf_dir, "orders").where("o_totalprice > 300000")
    return extract.not_in_rows(
        b.table(spark, sf_dir, "customer"), dear, "c_custkey", "o_custkey"
    ).select("c_custkey", "c_name")


@query(
    "feature_cohort_isin",
    b.with_ctes(
        """SELECT "APP_ID", missed, prev_missed, earlier_appointments FROM features
        WHERE "APP_ID" IN (SELECT appointment_id::BIGINT FROM predictions p
        LEFT JOIN calls c ON c.prediction_id = p.id
        WHERE call_status IS NULL OR call_status = 'Niet gebeld')""",
        "features",
        "predictions",
        "calls",
    ),
)
def feature_cohort_isin(spark, sf_dir):
    answers = b.calls(spark, sf_dir).select(F.col("prediction_id").alias("id"), "call_status")
    left_alone = b.predictions(spark, sf_dir).join(answers, "id", "left").where(reports.not_called())
    return reports.feature_cohort(b.features(spark, sf_dir, []), left_alone).select(
        "APP_ID", "missed", "prev_missed", "earlier_appointments"
    )


@query(
    "merge_groups_outer",
    b.with_ctes(
        """SELECT coalesce(p.id, n.id) AS id, coalesce(p.treatment_group, n.treatment_group)
        AS treatment_group FROM patients p FULL OUTER JOIN (SELECT o_custkey + 700 AS id,
        max((o_orderkey % 2)::INTEGER) AS treatment_group FROM orders GROUP BY 1) n
        ON p.id = n.id""",
        "patients",
    ),
)
def merge_groups_outer(spark, sf_dir):
    new = (
        b.table(spark, sf_dir, "orders")
        .groupBy((F.col("o_custkey") + 700).alias("id"))
        .agg(F.max((F.col("o_orderkey") % 2).cast("int")).alias("treatment_group"))
    )
    return trial.merge_groups(b.patients(spark, sf_dir), new)


@query(
    "distinct_ids",
    b.with_ctes("SELECT DISTINCT patient_id FROM predictions", "predictions"),
)
def distinct_ids(spark, sf_dir):
    return b.predictions(spark, sf_dir).select("patient_id").distinct()


@query(
    "rank_by_score",
    b.with_ctes(
        """SELECT id, round(prediction, 6) AS prediction FROM predictions
        ORDER BY prediction DESC, id""",
        "predictions",
    ),
)
def q_rank_by_score(spark, sf_dir):
    return b.rounded(
        outreach.rank_by_score(b.predictions(spark, sf_dir)).select("id", "prediction"),
        "prediction",
    )
