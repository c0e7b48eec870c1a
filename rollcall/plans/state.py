"""Table maintenance: upserts, retention, deactivation, call results."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from rollcall.operators import ledger
from rollcall.plans import bases as b
from rollcall.plans.registry import query
from rollcall.session import scratch_path
from rollcall.sources.tables import log_run, read_runs

# Orders as one scoring batch; known contacts are the customers in credit.
_BATCH = {
    "APP_ID": "o_orderkey",
    "pseudo_id": "o_custkey",
    "hoofdagenda": "o_orderpriority",
    "description": "'desk ' || o_orderstatus",
    "clinic": "CASE o_orderstatus WHEN 'F' THEN 'clinic_a' WHEN 'O' THEN 'clinic_b'"
    " ELSE 'clinic_c' END",
    "prediction": "o_totalprice / 500000",
    "start": "o_orderdate",
    "name_text": "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'name ' ||"
    " CAST(o_orderkey AS VARCHAR(20)) END",
    "patient_id": "'h' || CAST(o_custkey AS VARCHAR(20))",
    "name_given1_callMe": "'first ' || CAST(o_orderkey AS VARCHAR(20))",
    "telecom1_value": "'06' || CAST(o_orderkey AS VARCHAR(20))",
    "telecom2_value": "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE '030' END",
    "telecom3_value": "o_orderpriority",
    "birthDate": "CAST(o_orderdate AS DATE)",
    "treatment_group": "CAST(o_orderkey % 3 AS INT)",
    "status": "o_orderstatus",
}
_BATCH_SQL = b._sql_select(_BATCH, "orders")
_LAST = ' OVER (PARTITION BY pseudo_id ORDER BY hoofdagenda DESC, prediction, "APP_ID" DESC) = 1'
_FIRST = ' OVER (PARTITION BY pseudo_id ORDER BY hoofdagenda, prediction DESC, "APP_ID") = 1'


def scored_batch(spark, sf_dir):
    return b._spark_select(b.table(spark, sf_dir, "orders"), _BATCH)


@query(
    "upsert_sensitive",
    b.with_ctes(
        f"""SELECT coalesce(k.patient_id, l.pseudo_id) AS patient_id,
        CASE WHEN k.patient_id IS NULL THEN f.patient_id ELSE k.hospital_number END
        AS hospital_number, CASE WHEN k.patient_id IS NULL THEN coalesce(f.name_text, '')
        ELSE k.full_name END AS full_name, CASE WHEN k.patient_id IS NULL
        THEN f."name_given1_callMe" ELSE k.first_name END AS first_name,
        CASE WHEN k.patient_id IS NULL THEN f."birthDate" ELSE k.birth_date END AS birth_date,
        CASE WHEN l.pseudo_id IS NULL THEN k.mobile_phone ELSE l.telecom1_value END
        AS mobile_phone, CASE WHEN l.pseudo_id IS NULL THEN k.home_phone ELSE l.telecom2_value END
        AS home_phone, CASE WHEN l.pseudo_id IS NULL THEN k.other_phone ELSE l.telecom3_value END
        AS other_phone FROM known k FULL OUTER JOIN
        (SELECT * FROM batch QUALIFY row_number(){_LAST}) l ON l.pseudo_id = k.patient_id
        LEFT JOIN (SELECT * FROM batch QUALIFY row_number(){_FIRST}) f
        ON f.pseudo_id = l.pseudo_id""",
        "contacts",
        batch=_BATCH_SQL,
        known="SELECT * FROM contacts WHERE patient_id IN"
        " (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)",
    ),
)
def upsert_sensitive(spark, sf_dir):
    solvent = b.table(spark, sf_dir, "customer").where("c_acctbal >= 0")
    known = b._spark_select(solvent, b.CONTACT_COLUMNS)
    batch = scored_batch(spark, sf_dir)
    return ledger.upsert_sensitive(known, batch, ledger.batch_order())


@query(
    "upsert_patients",
    b.with_ctes(
        f"""SELECT coalesce(k.id, l.pseudo_id) AS id, call_number, opt_out, CASE WHEN
        l.pseudo_id IS NULL THEN k.treatment_group ELSE l.treatment_group END AS treatment_group
        FROM known k FULL OUTER JOIN (SELECT * FROM batch QUALIFY row_number(){_LAST}) l
        ON l.pseudo_id = k.id""",
        "patients",
        batch=_BATCH_SQL,
        known="SELECT * FROM patients WHERE id IN"
        " (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)",
    ),
)
def upsert_patients(spark, sf_dir):
    solvent = b.table(spark, sf_dir, "customer").where("c_acctbal >= 0")
    known = b._spark_select(solvent, b.PATIENT_COLUMNS)
    batch = scored_batch(spark, sf_dir)
    return ledger.upsert_patients(known, batch, ledger.batch_order())


_STORED = {
    "id": "o_orderkey",
    "appointment_id": "CAST(o_orderkey AS VARCHAR(20))",
    "prediction": "CAST(0.5 AS DOUBLE)",
    "start_time": "o_orderdate",
    "clinic_name": "'old'",
    "clinic_reception": "'old desk'",
    "clinic_phone_number": "'000'",
    "clinic_teleq_unit": "'old unit'",
    "clinic_actual_name": "'old clinic'",
    "request_id": "CAST(1 AS BIGINT)",
    "patient_id": "o_custkey",
    "active": "o_orderkey % 2 = 0",
}
# Stored predictions: finished and partial orders.  The batch: finished and open ones.
_STORED_SQL = b._sql_select(_STORED, "orders WHERE o_orderstatus <> 'O'")
_RULE_VALUES = ", ".join(
    f"('{r.name}', '{r.phone_number}', '{r.teleq_name}')" for r in b.RULES
)
_UPSERTED = f"""SELECT coalesce(s.id, (SELECT max(id) FROM stored) + new_rank) AS id,
    coalesce(s.appointment_id, n.appointment_id) AS appointment_id,
    coalesce(n.prediction, s.prediction) AS prediction,
    coalesce(s.start_time, n.start_time) AS start_time,
    coalesce(n.clinic_name, s.clinic_name) AS clinic_name,
    coalesce(n.clinic_reception, s.clinic_reception) AS clinic_reception,
    coalesce(n.phone, s.clinic_phone_number) AS clinic_phone_number,
    coalesce(n.unit, s.clinic_teleq_unit) AS clinic_teleq_unit,
    coalesce(n.clinic, s.clinic_actual_name) AS clinic_actual_name,
    CASE WHEN n.appointment_id IS NULL THEN s.request_id ELSE 7 END::BIGINT AS request_id,
    coalesce(s.patient_id, n.patient_id) AS patient_id,
    n.appointment_id IS NOT NULL OR s.active AS active FROM stored s FULL OUTER JOIN (
    SELECT "APP_ID"::VARCHAR AS appointment_id, start AS start_time, prediction,
    hoofdagenda AS clinic_name, description AS clinic_reception, phone, unit, clinic,
    pseudo_id AS patient_id, sum((status = 'O')::INTEGER) OVER (
    ORDER BY "APP_ID"::VARCHAR, start ROWS UNBOUNDED PRECEDING)::BIGINT AS new_rank
    FROM batch JOIN (VALUES {_RULE_VALUES}) r(clinic, phone, unit) USING (clinic)) n
    ON n.appointment_id = s.appointment_id AND n.start_time = s.start_time"""
_UPSERT_CTES = {
    "stored": _STORED_SQL,
    "batch": _BATCH_SQL + " WHERE o_orderstatus <> 'P'",
    "upserted": _UPSERTED,
}


def upserted(spark, sf_dir):
    rows = b.table(spark, sf_dir, "orders").where("o_orderstatus <> 'O'")
    stored = b._spark_select(rows, _STORED)
    batch = scored_batch(spark, sf_dir).where("status <> 'P'")
    return ledger.upsert_predictions(stored, batch, b.RULES, 7, ledger.batch_order())


@query(
    "upsert_predictions",
    b.with_ctes(
        "SELECT * FROM upserted", **_UPSERT_CTES
    ),
)
def upsert_predictions(spark, sf_dir):
    return upserted(spark, sf_dir)


@query(
    "deactivate_outdated",
    b.with_ctes(
        """SELECT id, active AND NOT (start_time >= TIMESTAMP '1999-01-01 00:00:00'
        AND id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')) AS active
        FROM stored""",
        **_UPSERT_CTES,
    ),
)
def deactivate_outdated(spark, sf_dir):
    orders = b.table(spark, sf_dir, "orders")
    stored = b._spark_select(orders.where("o_orderstatus <> 'O'"), _STORED)
    touched = orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id"))
    return ledger.deactivate(stored, touched, dt.date(1999, 1, 1)).select("id", "active")


@query(
    "id_difference",
    b.with_ctes(
        """SELECT id FROM stored WHERE active AND start_time >= TIMESTAMP '1999-01-01 00:00:00'
        AND id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
        **_UPSERT_CTES,
    ),
)
def id_difference(spark, sf_dir):
    orders = b.table(spark, sf_dir, "orders")
    stored = b._spark_select(orders.where("o_orderstatus <> 'O'"), _STORED)
    touched = orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id"))
    return ledger.id_difference(stored, touched, dt.date(1999, 1, 1))


@query(
    "retention_delete",
    b.with_ctes(
        """SELECT patient_id, full_name FROM contacts WHERE patient_id IN (SELECT o_custkey
        FROM orders WHERE o_orderdate > TIMESTAMP '2001-06-16 00:00:00')""",
        "contacts",
    ),
)
def retention_delete(spark, sf_dir):
    made = b.table(spark, sf_dir, "orders").selectExpr(
        "o_custkey AS patient_id", "o_orderdate AS start_time"
    )
    return ledger.retention_delete(
        b.contacts(spark, sf_dir), made, dt.date(2001, 6, 30), days=14
    ).select("patient_id", "full_name")


@query(
    "log_request",
    """SELECT 200 AS response_code, count(*)::VARCHAR || ' predictions' AS response_message,
    'predict' AS endpoint, 'v1' AS api_version FROM events""",
)
def log_request(spark, sf_dir):
    """Time a pass over the predictions and log it."""
    began = dt.datetime.now(dt.timezone.utc)
    n = b.predictions(spark, sf_dir).count()
    seconds = (dt.datetime.now(dt.timezone.utc) - began).total_seconds()
    path = scratch_path(spark, "runs")
    log_run(spark, path, 1, began, seconds, "v1", message=f"{n} predictions")
    return read_runs(spark, path).select(
        "response_code", "response_message", "endpoint", "api_version"
    )


# Call results: events on stored calls (orders) and on new ones.
_CALL_BATCH = {
    "prediction_id": "user_id",
    "timestamp": "ts",
    "user": "'agent ' || event_type",
    "call_outcome": "CASE event_type WHEN 'view' THEN 'Geen' WHEN 'click' THEN 'Herinnerd'"
    " ELSE 'Onbereikbaar' END",
    "remarks": "props",
    "patient_id": "user_id",
    "call_number": "CAST(event_id % 3 AS INT)",
    "opt_out": "CAST(event_id % 2 AS INT)",
}
_STORED_CALLS = {
    "id": "c_custkey + 100",
    "timestamp": "TIMESTAMP '2023-12-01 00:00:00'",
    "user": "c_name",
    "call_status": "'Wordt gebeld'",
    "call_outcome": "'Onbereikbaar'",
    "remarks": "''",
    "prediction_id": "c_custkey",
}
_CALL_CTES = {
    "stored": b._sql_select(_STORED_CALLS, "customer WHERE c_acctbal >= 0"),
    "results": b._sql_select(_CALL_BATCH, "events"),
    "latest": "SELECT * FROM results QUALIFY row_number() OVER"
    ' (PARTITION BY prediction_id ORDER BY "timestamp" DESC) = 1',
}


@query(
    "record_call",
    b.with_ctes(
        """SELECT coalesce(s.id, (SELECT max(id) FROM stored) + row_number() OVER (
        PARTITION BY s.id IS NULL ORDER BY n.prediction_id)) AS id,
        CASE WHEN n.prediction_id IS NULL THEN s."timestamp" ELSE n."timestamp" END AS "timestamp",
        coalesce(n."user", s."user") AS "user", CASE WHEN n.prediction_id IS NULL THEN s.call_status
        WHEN n.call_outcome = 'Geen' THEN 'Niet gebeld' ELSE 'Gebeld' END AS call_status,
        coalesce(n.call_outcome, s.call_outcome) AS call_outcome,
        coalesce(n.remarks, s.remarks) AS remarks,
        coalesce(s.prediction_id, n.prediction_id) AS prediction_id
        FROM stored s FULL OUTER JOIN latest n ON n.prediction_id = s.prediction_id""",
        **_CALL_CTES,
    ),
)
def record_call(spark, sf_dir):
    solvent = b.table(spark, sf_dir, "customer").where("c_acctbal >= 0")
    stored = b._spark_select(solvent, _STORED_CALLS)
    batch = b._spark_select(b.table(spark, sf_dir, "events"), _CALL_BATCH)
    return ledger.record_calls(stored, batch)


@query(
    "record_contact_choice",
    b.with_ctes(
        """SELECT p.id, CASE WHEN n.patient_id IS NULL THEN p.call_number ELSE n.call_number END
        AS call_number, CASE WHEN n.patient_id IS NULL THEN p.opt_out ELSE n.opt_out END AS opt_out,
        p.treatment_group FROM patients p LEFT JOIN latest n ON n.patient_id = p.id""",
        "patients",
        **_CALL_CTES,
    ),
)
def record_contact_choice(spark, sf_dir):
    batch = b._spark_select(b.table(spark, sf_dir, "events"), _CALL_BATCH)
    return ledger.record_contact_choice(b.patients(spark, sf_dir), batch)


@query(
    "start_calls",
    b.with_ctes(
        """SELECT id, CASE WHEN prediction_id IN (SELECT event_id FROM events
        WHERE event_type = 'click') THEN 'Wordt gebeld' ELSE call_status END AS call_status
        FROM calls""",
        "calls",
    ),
)
def start_calls(spark, sf_dir):
    clicked = b.table(spark, sf_dir, "events").where("event_type = 'click'")
    ids = clicked.select(F.col("event_id").alias("prediction_id"))
    return ledger.start_calls(b.calls(spark, sf_dir), ids).select("id", "call_status")
