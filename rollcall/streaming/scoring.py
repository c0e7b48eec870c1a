"""The scoring job, as one function for a batch and as a stream of batches.

State and history live in hash buckets of the patient (:mod:`rollcall.streaming.buckets`): batch *n* reads the buckets of
its patients in version *n - 1* and writes them in version *n*.  A replayed batch overwrites its own version only, so a
restart changes nothing.

A run also changes patients that it does not hold: their predictions from its start date on are switched off, and
contacts without a recent prediction are deleted.  For buckets that a run does not touch, both follow from the run's two
dates, which the manifest keeps, and are applied whenever the bucket is read.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rollcall.config import Settings
from rollcall.operators.cleaning import clean_appointments
from rollcall.operators.features import create_features, filter_to_score
from rollcall.operators.ledger import (
    batch_order,
    deactivate,
    highest_id,
    retention_delete,
    upsert_patients,
    upsert_predictions,
    upsert_sensitive,
)
from rollcall.operators.outreach import rank_by_score
from rollcall.operators.trial import OUTSIDE_TRIAL, treatment_groups
from rollcall.schema import CONTACT, CONTACT_COLUMNS, PATIENT, PREDICTION
from rollcall.session import materialize
from rollcall.sources.tables import log_run
from rollcall.streaming.buckets import BUCKET, BUCKETS, VERSION, BucketStore, bucket_of, touched_buckets

Scorer = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class State:
    contacts: DataFrame
    patients: DataFrame
    predictions: DataFrame

    @staticmethod
    def empty(spark: SparkSession) -> State:
        return State(*[spark.createDataFrame([], s) for s in (CONTACT, PATIENT, PREDICTION)])


def attach_sensitive(
    predictions: DataFrame, appointments: DataFrame, columns: Sequence[str] = CONTACT_COLUMNS
) -> DataFrame:
    """Add the contact columns of the same appointment."""
    keys = ["pseudo_id", "start"]
    slim = predictions.select(*keys, "prediction")
    return slim.join(appointments.select(*keys, *columns), keys, "left")


def score_appointments(
    cleaned: DataFrame, postal: DataFrame, scorer: Scorer, start_date: dt.date | None
) -> DataFrame:
    """Features on the full history, then score the planned appointments only.

    The cleaned rows are read for the features and for the contacts: write them once.
    """
    cleaned = materialize(cleaned, "cleaned")
    features = create_features(cleaned, postal, stage=False, keep=["status"])
    if start_date is not None:
        features = filter_to_score(features, start_date)
    return attach_sensitive(scorer(features), cleaned)


def assign_groups(
    predictions: DataFrame,
    patients: DataFrame,
    edges: DataFrame | None,
    settings: Settings,
    seed: int | None = 1337,
) -> DataFrame:
    """Treatment groups; without any trial clinic everyone is outside.

    The result feeds several tables, so it is written once.
    """
    if not settings.rct_clinics or edges is None:
        return predictions.withColumn("treatment_group", F.lit(OUTSIDE_TRIAL))
    known = patients.select("id", "treatment_group")
    groups = treatment_groups(predictions, known, edges, settings.rct_clinics, seed=seed)
    return materialize(groups.drop("score_bin"), "grouped")


def apply_scores(
    state: State,
    scored: DataFrame,
    settings: Settings,
    start_date: dt.date,
    request_id: int,
    top_id: int | None = None,
) -> State:
    """The five table changes of one scoring run, as new snapshots.

    A run only scores appointments from ``start_date`` on, so older predictions
    pass through without taking part in any join.  ``state`` may be the part of the run's
    patients only; ``top_id`` is then the highest prediction id of the whole.
    """
    order = batch_order()
    from_now = F.col("start_time") >= F.lit(start_date)
    settled = state.predictions.where(~from_now)
    kept = retention_delete(
        state.contacts, state.predictions, start_date, settings.keep_sensitive_data
    )
    predictions = materialize(
        upsert_predictions(
            state.predictions.where(from_now),
            scored,
            settings.clinics,
            request_id,
            order,
            highest_id(state.predictions) if top_id is None else top_id,
        ),
        "upserted",
    )
    # The run's own rows are the ones that carry its request id.
    batch_ids = predictions.where(F.col("request_id") == request_id).select("id")
    return State(
        contacts=upsert_sensitive(kept, scored, order),
        patients=upsert_patients(state.patients, scored, order),
        predictions=deactivate(predictions, batch_ids, start_date).unionByName(settled),
    )


def run_scoring(
    appointments: DataFrame,
    postal: DataFrame,
    state: State,
    scorer: Scorer,
    settings: Settings,
    start_date: dt.date,
    edges: DataFrame | None = None,
    request_id: int = 1,
    order: str = "_seq",
    seed: int | None = 1337,
    cohort: bool = True,
) -> tuple[State, DataFrame]:
    """One scoring run over full patient histories.

    ``cohort`` keeps only patients with an appointment on the start date.
    """
    cleaned = clean_appointments(
        appointments,
        settings.clinics,
        order,
        settings.missed_codes,
        day=start_date if cohort else None,
    )
    scored = materialize(score_appointments(cleaned, postal, scorer, start_date), "scored")
    if scored.isEmpty():
        raise ValueError("no appointments for the start date and filters")
    scored = assign_groups(scored, state.patients, edges, settings, seed)
    return apply_scores(state, scored, settings, start_date, request_id), rank_by_score(
        scored, "APP_ID"
    )


#: Versions after which a bucket is rewritten even if no batch touches it, so that deleted contacts leave the files as well: a week
#: of runs every two hours.
SETTLE_AFTER = 84

_KEYS = {"contacts": "patient_id", "patients": "id", "predictions": "patient_id"}


class SnapshotTables:
    """The state tables and the history of a stream, in buckets of the patient under one folder."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        initial: State | None = None,
        buckets: int = BUCKETS,
        settle_after: int = SETTLE_AFTER,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.given = initial is not None
        self.initial = initial or State.empty(spark)
        schemas = {name: (key, getattr(self.initial, name).schema) for name, key in _KEYS.items()}
        self.store = BucketStore(spark, self.root, schemas, buckets)
        self.buckets = buckets
        self.settle_after = settle_after

    def latest(self) -> int:
        return self.store.latest()

    def read(self, version: int, buckets: Sequence[int] | None = None) -> State:
        """All of a version, or the given buckets of it."""
        if version < 0:
            return self.initial
        runs = self.store.manifest(version)["facts"]["runs"]
        frames = {name: self.store.read(name, version, buckets) for name in _KEYS}
        predictions, contacts = frames["predictions"], frames["contacts"]
        first, limit = _pending(runs, "start", min), _pending(runs, "limit", max)
        off = F.col("start_time") >= first.cast("timestamp")
        # Several runs may have passed by a bucket: the earliest start and the latest limit stand for all.
        switched = predictions.withColumn("active", F.col("active") & ~F.coalesce(off, F.lit(False)))
        last = predictions.groupBy("patient_id").agg(F.max("start_time").alias("_last"))
        kept = contacts.withColumn("_limit", limit.cast("timestamp")).join(last, "patient_id", "left")
        kept = kept.where(F.col("_limit").isNull() | (F.col("_last") > F.col("_limit")))
        return State(
            contacts=kept.select(*contacts.columns).drop(VERSION),
            patients=frames["patients"].drop(VERSION),
            predictions=switched.drop(VERSION),
        )

    def top_id(self, version: int) -> int:
        if version < 0:
            return highest_id(self.initial.predictions)
        return self.store.manifest(version)["facts"]["top_id"]

    def to_write(self, touched: Sequence[int], version: int) -> list[int]:
        """The buckets that a version writes: those of its patients, those long unwritten, at first all that were given."""
        if version == 0 and self.given:
            return list(range(self.buckets))
        files = self.store.manifest(version - 1)["files"].values()
        overdue = {int(b) for f in files for b, v in f.items() if v <= version - self.settle_after}
        return sorted(overdue.union(touched))

    def write(
        self, state: State, version: int, written: Sequence[int], start_date: dt.date, keep_days: int
    ) -> None:
        """Commit whole buckets; the run's dates stand for what it does to all others."""
        limit = dt.datetime.combine(start_date, dt.time()) - dt.timedelta(days=keep_days)
        run = {"version": version, "start": start_date.isoformat(), "limit": limit.isoformat(" ")}

        def facts() -> dict:
            top = max(self.top_id(version - 1), highest_id(self.store.written("predictions", version)))
            return {"top_id": top, "runs": [*self._open_runs(version - 1, written), run]}

        self.store.commit(version, {name: getattr(state, name) for name in _KEYS}, written, facts)

    def pass_on(self, version: int) -> None:
        """A version without changes: a manifest and no file, unless tables were given to start from."""
        if version == 0 and self.given:
            frames = {name: getattr(self.initial, name) for name in _KEYS}
            self.store.commit(0, frames, range(self.buckets), lambda: {"top_id": self.top_id(-1), "runs": []})
            return
        runs, top = self._open_runs(version - 1, []), self.top_id(version - 1)
        self.store.commit(version, {}, [], lambda: {"top_id": top, "runs": runs})

    def _open_runs(self, version: int, written: Sequence[int]) -> list[dict]:
        """Earlier runs that some bucket has not seen yet once these are written."""
        known = self.store.manifest(version)
        gone = {str(b) for b in written}
        oldest = min((v for f in known["files"].values() for b, v in f.items() if b not in gone), default=version)
        return [r for r in known["facts"].get("runs", []) if r["version"] > oldest]

    def append_history(self, batch: DataFrame, version: int) -> None:
        placed = batch.withColumn(BUCKET, bucket_of(F.col("pseudo_id"), self.buckets))
        path = f"{self.root}/history/batch={version}"
        placed.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)

    def history(
        self, schema: T.StructType, version: int, buckets: Sequence[int] | None = None, only: bool = False
    ) -> DataFrame:
        """Everything received up to a batch, or by it ``only``; of some buckets if given."""
        parts = [T.StructField("batch", T.LongType()), T.StructField(BUCKET, T.IntegerType())]
        found = self.spark.read.schema(T.StructType([*schema.fields, *parts])).parquet(f"{self.root}/history")
        found = found.where(F.col("batch") == version if only else F.col("batch") <= version)
        if buckets is not None:
            found = found.where(F.col(BUCKET).isin(list(buckets)))
        return found.select(*schema.fieldNames())


def _pending(runs: Sequence[dict], date: str, best: Callable) -> Column:
    """The earliest or latest date of the runs after a row's version; null where no run came after it."""
    value = F.lit(None).cast("string")
    for place, run in enumerate(runs):
        known = best(r[date] for r in runs[place:])
        before = runs[place - 1]["version"] if place else -1
        value = F.when(F.col(VERSION).between(before, run["version"] - 1), F.lit(known)).otherwise(value)
    return value


def without_resent(source: DataFrame, received: str, delay: str, keys: Sequence[str]) -> DataFrame:
    """The stream with each version of an appointment (its ``keys``) once, however often it is sent within ``delay``.

    ``received`` is the timestamp that the watermark follows.  Spark's state store holds the keys of one delay.
    """
    return source.withWatermark(received, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_scoring(
    source: DataFrame,
    prepare: Callable[[DataFrame], DataFrame],
    tables: SnapshotTables,
    checkpoint: str,
    postal: DataFrame,
    scorer: Scorer,
    settings: Settings,
    start_date: Callable[[DataFrame], dt.date] | dt.date,
    edges: DataFrame | None = None,
    order: str = "_seq",
    seed: int | None = 1337,
    version: str = "stream",
) -> StreamingQuery:
    """Score each arriving batch with the history of its patients.

    The new rows are appended to the history, features are computed over the full
    history of the patients in the batch, and only rows of the batch are stored.
    History and state are read and written in the buckets of these patients only.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        began, clock = dt.datetime.now(dt.timezone.utc), time.monotonic()
        arrived = prepare(batch)
        schema = arrived.schema
        tables.append_history(arrived, batch_id)
        new = tables.history(schema, batch_id, only=True)
        if new.isEmpty():
            tables.pass_on(batch_id)
            return
        touched = touched_buckets(new, "pseudo_id", tables.buckets)
        seen = tables.history(schema, batch_id, touched)
        patients = new.select("pseudo_id").distinct()
        relevant = seen.join(patients, "pseudo_id", "left_semi")
        first = start_date(new) if callable(start_date) else start_date
        cleaned = clean_appointments(relevant, settings.clinics, order, settings.missed_codes)
        scored = score_appointments(cleaned, postal, scorer, first)
        scored = scored.join(new.select("APP_ID").distinct(), "APP_ID", "left_semi")
        scored = materialize(scored, "scored")
        if scored.isEmpty():
            tables.pass_on(batch_id)
            return
        written = tables.to_write(touched, batch_id)
        state = tables.read(batch_id - 1, written)
        grouped = assign_groups(scored, state.patients, edges, settings, seed)
        after = apply_scores(
            state, grouped, settings, first, batch_id + 1, tables.top_id(batch_id - 1)
        )
        tables.write(after, batch_id, written, first, settings.keep_sensitive_data)
        log_run(
            seen.sparkSession,
            f"{tables.root}/requests",
            batch_id + 1,
            began,
            time.monotonic() - clock,
            version,
        )

    return (
        source.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_assignment(
    source: DataFrame,
    root: str,
    checkpoint: str,
    edges: DataFrame,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    rct_clinics: Sequence[str] | None = None,
    tie: Sequence[str] = ("APP_ID",),
    seed: int | None = 1337,
    patient_type: T.DataType | None = None,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Give patients a group when first seen and keep it in all later batches.

    Known groups lie in hash buckets of the patient; a batch reads and writes the buckets of its patients.
    """
    root = root.rstrip("/")

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch) if prepare else batch
        kind = patient_type or rows.schema["pseudo_id"].dataType
        schema = T.StructType(
            [T.StructField("id", kind), T.StructField("treatment_group", T.IntegerType())]
        )
        store = BucketStore(rows.sparkSession, root, {"patients": ("id", schema)}, buckets)
        rows = materialize(rows, "arrived")
        if rows.isEmpty():
            store.commit(batch_id, {}, [])
            return
        touched = touched_buckets(rows, "pseudo_id", buckets)
        patients = store.read("patients", batch_id - 1, touched).drop(VERSION)
        assigned = materialize(
            treatment_groups(rows, patients, edges, rct_clinics, tie, seed), "assigned"
        )
        last: Column = F.struct("start", *tie)
        fresh = assigned.groupBy(F.col("pseudo_id").alias("id")).agg(
            F.max_by("treatment_group", last).alias("treatment_group")
        )
        kept = patients.join(fresh.select("id"), "id", "left_anti")
        store.commit(batch_id, {"patients": kept.unionByName(fresh)}, touched)
        assigned.write.mode("overwrite").parquet(f"{root}/assigned/batch={batch_id}")

    return (
        source.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
