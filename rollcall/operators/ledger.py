"""State tables as snapshots: every change is a join that yields the next one.

No operator overwrites the table it reads; the caller writes the returned
snapshot to a new folder.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.config import (
    OUTCOME_NONE,
    STATUS_CALLED,
    STATUS_CALLING,
    STATUS_NOT_CALLED,
    ClinicRule,
    rules_frame,
)
from rollcall.operators.ordering import ranked

PHONES = {
    "mobile_phone": "telecom1_value",
    "home_phone": "telecom2_value",
    "other_phone": "telecom3_value",
}


def batch_order(tie: Sequence[str] = ("APP_ID",)) -> Column:
    """Sortable position in the stored order: agenda, then score downwards."""
    return F.struct(
        F.col("hoofdagenda"), (-F.col("prediction")).alias("_down"), *[F.col(c) for c in tie]
    )


def upsert_sensitive(table: DataFrame, batch: DataFrame, order: Column) -> DataFrame:
    """Add contacts of new patients; of known ones only the phones change.

    Several batch rows of a new patient: the first gives name and birth date,
    the last one the phones.
    """
    placed = batch.withColumn("_order", order)
    identity = F.struct(
        F.col("patient_id").alias("hospital_number"),
        F.coalesce("name_text", F.lit("")).alias("full_name"),
        F.col("name_given1_callMe").alias("first_name"),
        F.col("birthDate").alias("birth_date"),
    )
    phones = F.struct(*[F.col(source).alias(name) for name, source in PHONES.items()])
    fresh = placed.groupBy(F.col("pseudo_id").alias("_pid")).agg(
        F.min_by(identity, "_order").alias("_identity"),
        F.max_by(phones, "_order").alias("_phones"),
    )
    joined = table.join(fresh, table["patient_id"] == fresh["_pid"], "full_outer")
    known, seen = table["patient_id"].isNotNull(), F.col("_pid").isNotNull()
    columns = []
    for name in table.columns:
        if name == "patient_id":
            value = F.coalesce(table["patient_id"], F.col("_pid"))
        elif name in PHONES:
            value = F.when(seen, F.col(f"_phones.{name}")).otherwise(table[name])
        else:
            value = F.when(known, table[name]).otherwise(F.col(f"_identity.{name}"))
        columns.append(value.alias(name))
    return joined.select(*columns)


def upsert_patients(table: DataFrame, batch: DataFrame, order: Column) -> DataFrame:
    """Insert patients or set their treatment group; the last batch row wins."""
    last = batch.groupBy(F.col("pseudo_id").alias("_pid")).agg(
        F.max_by("treatment_group", order).alias("_group")
    )
    joined = table.join(last, table["id"] == last["_pid"], "full_outer")
    return joined.select(
        *[
            F.coalesce(table["id"], F.col("_pid")).alias("id")
            if c == "id"
            else F.when(F.col("_pid").isNotNull(), F.col("_group"))
            .otherwise(table[c])
            .alias(c)
            if c == "treatment_group"
            else table[c]
            for c in table.columns
        ]
    )


def highest_id(table: DataFrame) -> int:
    return table.agg(F.max("id")).first()[0] or 0


def upsert_predictions(
    table: DataFrame,
    batch: DataFrame,
    rules: Sequence[ClinicRule],
    request_id: int,
    order: Column,
    top_id: int | None = None,
) -> DataFrame:
    """Insert or update by (appointment, start); id and patient never change.

    New rows get ids after the highest one, in key order.  Returns the whole
    next snapshot with every batch row active.  ``table`` may be only the part
    the batch can touch; ``top_id`` is then the highest id of the whole.
    """
    key = ["appointment_id", "start_time"]
    clinics = rules_frame(batch.sparkSession, rules).select(
        "clinic", "phone_number", "teleq_name"
    )
    last = (
        batch.groupBy(
            F.col("APP_ID").cast("string").alias("appointment_id"),
            F.col("start").cast(table.schema["start_time"].dataType).alias("start_time"),
        )
        .agg(
            # The patient is set by the row that inserts, the rest by the last one.
            F.min_by("pseudo_id", order).alias("_patient"),
            F.max_by(
                F.struct("prediction", "hoofdagenda", "description", "clinic"), order
            ).alias("_row"),
        )
        .select(*key, "_patient", "_row.*")
        # One row per clinic of a hand-written list.
        .join(F.broadcast(clinics), "clinic", "left")
    )
    incoming = last.select(
        *key,
        "prediction",
        F.col("hoofdagenda").alias("clinic_name"),
        F.col("description").alias("clinic_reception"),
        F.col("phone_number").alias("clinic_phone_number"),
        F.col("teleq_name").alias("clinic_teleq_unit"),
        F.col("clinic").alias("clinic_actual_name"),
        F.lit(request_id).cast(table.schema["request_id"].dataType).alias("request_id"),
        F.col("_patient").alias("patient_id"),
    )
    touched = table.join(incoming.select(*key), key, "left_semi")
    repeated = touched.groupBy(*key).count().where("count > 1")
    if not repeated.isEmpty():
        raise ValueError("several stored predictions for one appointment and start")

    id_type = table.schema["id"].dataType
    top = top_id if top_id is not None else highest_id(table)
    new_keys = incoming.select(*key).join(table.select(*key), key, "left_anti")
    numbered = ranked(new_keys, [F.col(c) for c in key], "_rank").select(
        *key, (F.col("_rank") + top + 1).cast(id_type).alias("_new_id")
    )
    incoming = incoming.join(numbered, key, "left")

    old, new = table.alias("old"), incoming.alias("new")
    match = (F.col("old.appointment_id") == F.col("new.appointment_id")) & (
        F.col("old.start_time") == F.col("new.start_time")
    )
    seen = F.col("new.appointment_id").isNotNull()
    columns = []
    for name in table.columns:
        if name == "id":
            value = F.coalesce(F.col("old.id"), F.col("new._new_id"))
        elif name in ("patient_id", *key):
            value = F.coalesce(F.col(f"old.{name}"), F.col(f"new.{name}"))
        elif name == "active":
            value = F.when(seen, F.lit(True)).otherwise(F.col("old.active"))
        else:
            value = F.when(seen, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}"))
        columns.append(value.alias(name))
    return old.join(new, match, "full_outer").select(*columns)


def retention_delete(
    contacts: DataFrame, predictions: DataFrame, start_date: dt.date, days: int
) -> DataFrame:
    """Contacts of patients with a prediction later than ``days`` before the date."""
    limit = dt.datetime.combine(start_date, dt.time()) - dt.timedelta(days=days)
    recent = predictions.where(F.col("start_time") > F.lit(limit)).select("patient_id")
    return contacts.join(recent.distinct(), "patient_id", "left_semi")


def id_difference(
    predictions: DataFrame, batch_ids: DataFrame, start_date: dt.date
) -> DataFrame:
    """Ids of active predictions from the date on that the batch did not touch."""
    live = predictions.where(
        F.col("active") & (F.col("start_time") >= F.lit(start_date))
    ).select("id")
    return live.join(batch_ids.select("id").distinct(), "id", "left_anti")


def deactivate(
    predictions: DataFrame, batch_ids: DataFrame, start_date: dt.date
) -> DataFrame:
    """Switch off predictions from the date on that are missing in the batch."""
    touched = batch_ids.select("id").distinct().withColumn("_touched", F.lit(True))
    outdated = (F.col("start_time") >= F.lit(start_date)) & F.col("_touched").isNull()
    return (
        predictions.join(touched, "id", "left")
        .withColumn("active", F.col("active") & ~outdated)
        .select(*predictions.columns)
    )


def rekey(child: DataFrame, parent: DataFrame, foreign: str, business: str) -> DataFrame:
    """Replace a business key in ``foreign`` by the parent's surrogate ``id``."""
    lookup = parent.select(F.col(business).alias("_business"), F.col("id").alias("_id"))
    return child.join(lookup, child[foreign] == lookup["_business"], "left").select(
        *[F.col("_id").alias(c) if c == foreign else child[c] for c in child.columns]
    )


def start_calls(calls: DataFrame, prediction_ids: DataFrame) -> DataFrame:
    """Mark the calls of these predictions as being made."""
    now = prediction_ids.select("prediction_id").distinct().withColumn("_now", F.lit(True))
    status = F.when(F.col("_now"), STATUS_CALLING).otherwise(F.col("call_status"))
    return (
        calls.join(now, "prediction_id", "left")
        .withColumn("call_status", status)
        .select(*calls.columns)
    )


def record_calls(calls: DataFrame, batch: DataFrame) -> DataFrame:
    """Merge a batch of call results: one row per prediction, the latest result.

    ``batch``: prediction_id, timestamp, user, call_outcome, remarks.  The outcome
    "none" means not called, any other one called.
    """
    latest = batch.groupBy("prediction_id").agg(
        F.max_by(F.struct("timestamp", "user", "call_outcome", "remarks"), "timestamp").alias(
            "_new"
        )
    )
    top = highest_id(calls)
    fresh = latest.select("prediction_id").join(calls, "prediction_id", "left_anti")
    numbered = ranked(fresh, [F.col("prediction_id")], "_rank").select(
        "prediction_id", (F.col("_rank") + top + 1).alias("_new_id")
    )
    status = F.when(
        F.col("_new.call_outcome") == OUTCOME_NONE, STATUS_NOT_CALLED
    ).otherwise(STATUS_CALLED)
    joined = calls.join(latest.join(numbered, "prediction_id", "left"), "prediction_id", "full_outer")
    seen = F.col("_new").isNotNull()
    columns = []
    for name in calls.columns:
        if name == "id":
            value = F.coalesce("id", "_new_id").cast(calls.schema["id"].dataType)
        elif name == "prediction_id":
            value = F.col(name)
        elif name == "call_status":
            value = F.when(seen, status).otherwise(F.col(name))
        else:
            value = F.when(seen, F.col(f"_new.{name}")).otherwise(F.col(name))
        columns.append(value.alias(name))
    return joined.select(*columns)


def record_contact_choice(patients: DataFrame, batch: DataFrame) -> DataFrame:
    """Set each patient's contact number and opt-out from their latest call."""
    latest = batch.groupBy(F.col("patient_id").alias("_pid")).agg(
        F.max_by(F.struct("call_number", "opt_out"), "timestamp").alias("_new")
    )
    seen = F.col("_pid").isNotNull()
    return patients.join(latest, patients["id"] == latest["_pid"], "left").select(
        *[
            F.when(seen, F.col(f"_new.{c}")).otherwise(patients[c]).alias(c)
            if c in ("call_number", "opt_out")
            else patients[c]
            for c in patients.columns
        ]
    )
