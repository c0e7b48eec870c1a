"""State tables, call list and stream."""

import datetime as dt
import json

import pytest
from fixture_rows import SCORING_DAY, SETTINGS, postal_codes, records
from pyspark.sql import functions as F

from rollcall.config import ClinicRule
from rollcall.operators import ledger, outreach, reports
from rollcall.schema import CALL, CONTACT, PATIENT, PREDICTION
from rollcall.sources.appointments import coerce_appointments, read_appointments_json
from rollcall.sources.tables import log_run, read_runs
from rollcall.streaming.buckets import touched_buckets
from rollcall.streaming.scoring import (
    SnapshotTables,
    State,
    apply_scores,
    run_scoring,
    stream_assignment,
    stream_scoring,
    without_resent,
)

DAY = dt.date(2024, 7, 16)
RULES = [ClinicRule(name="clinic H1", main_agenda_codes=("H1",), phone_number="1", teleq_name="H1")]
NOON = dt.datetime(2024, 7, 16, 12)
BATCH = (
    "APP_ID string, pseudo_id string, start timestamp, hoofdagenda string, prediction double,"
    " name_text string, patient_id string, name_given1_callMe string, birthDate date,"
    " telecom1_value string, telecom2_value string, telecom3_value string, description string,"
    " clinic string, treatment_group int"
)


def batch_row(app, who, agenda="A", score=0.5, phone="1", name="n", group=1, start=NOON):
    born = dt.date(1970, 1, 1)
    return (
        app, who, start, agenda, score, name, f"h{who}", name, born,
        phone, None, None, "desk", "clinic H1", group,
    )


def prediction(id, app, who="p", start=NOON, active=True, score=0.1, clinic="old", request=1):
    return (id, app, score, start, clinic, "r", "t", None, None, request, who, active)


def test_contacts_first_name_last_phone(spark):
    table = spark.createDataFrame(
        [("k", "h", "Known", "K", None, "0", "0", "0"), ("idle", "h", "Idle", None, None, "9", "9", "9")],
        CONTACT,
    )
    batch = spark.createDataFrame(
        [
            batch_row("1", "k", phone="new", name="ignored"),
            batch_row("2", "n", agenda="A", phone="first", name=None),
            batch_row("3", "n", agenda="B", phone="last", name="later"),
        ],
        BATCH,
    )
    rows = {r.patient_id: r for r in ledger.upsert_sensitive(table, batch, ledger.batch_order()).collect()}
    assert set(rows) == {"k", "n", "idle"}
    assert (rows["k"].full_name, rows["k"].mobile_phone, rows["k"].home_phone) == ("Known", "new", None)
    assert (rows["n"].full_name, rows["n"].mobile_phone) == ("", "last")
    assert rows["idle"].mobile_phone == "9"


def test_patients_last_row_wins(spark):
    table = spark.createDataFrame([("k", 2, 1, 0), ("idle", None, None, 1)], PATIENT)
    batch = spark.createDataFrame(
        [batch_row("1", "k", score=0.9, group=0), batch_row("2", "k", score=0.1, group=1), batch_row("3", "n")],
        BATCH,
    )
    rows = {tuple(r) for r in ledger.upsert_patients(table, batch, ledger.batch_order()).collect()}
    assert rows == {("k", 2, 1, 1), ("idle", None, None, 1), ("n", None, None, 1)}


def test_predictions_insert_update_and_ids(spark):
    table = spark.createDataFrame([prediction(5, "a", who="orig", active=False), prediction(9, "z")], PREDICTION)
    batch = spark.createDataFrame(
        [batch_row("a", "other", score=0.7), batch_row("b", "n"), batch_row("c", "n")], BATCH
    )
    out = ledger.upsert_predictions(table, batch, RULES, 3, ledger.batch_order())
    rows = {r.appointment_id: r for r in out.collect()}
    assert {k: r.id for k, r in rows.items()} == {"a": 5, "z": 9, "b": 10, "c": 11}
    a = rows["a"]
    assert (a.patient_id, a.prediction, a.active, a.request_id) == ("orig", 0.7, True, 3)
    assert (a.clinic_name, a.clinic_teleq_unit, a.clinic_actual_name) == ("A", "H1", "clinic H1")
    assert (rows["z"].clinic_name, rows["z"].request_id) == ("old", 1)
    again = ledger.upsert_predictions(out, batch, RULES, 3, ledger.batch_order())
    assert sorted(again.collect()) == sorted(out.collect())


def test_stored_twice_is_an_error(spark):
    table = spark.createDataFrame([prediction(1, "a"), prediction(2, "a")], PREDICTION)
    batch = spark.createDataFrame([batch_row("a", "p")], BATCH)
    with pytest.raises(ValueError):
        ledger.upsert_predictions(table, batch, RULES, 3, ledger.batch_order())


def test_retention_and_deactivation(spark):
    limit = dt.datetime(2024, 7, 2)
    made = spark.createDataFrame(
        [prediction(1, "a", "edge", limit), prediction(2, "b", "new", limit + dt.timedelta(seconds=1)),
         prediction(3, "c", "new")],
        PREDICTION,
    )
    people = spark.createDataFrame(
        [(w, None, w, None, None, None, None, None) for w in ("edge", "new", "none")], CONTACT
    )
    kept = ledger.retention_delete(people, made, DAY, 14)
    assert {r.patient_id for r in kept.collect()} == {"new"}
    touched = spark.createDataFrame([(2,)], "id long")
    assert {r.id for r in ledger.id_difference(made, touched, DAY).collect()} == {3}
    active = {r.id: r.active for r in ledger.deactivate(made, touched, DAY).collect()}
    assert active == {1: True, 2: True, 3: False}


def test_call_results(spark):
    calls = spark.createDataFrame([(4, None, None, "Wordt gebeld", "Onbereikbaar", "", 1)], CALL)
    batch = spark.createDataFrame(
        [
            (1, NOON, "u", "Geen", "r", "p", 1, 0),
            (2, NOON, "u", "Geen", "r", "q", 2, 0),
            (2, NOON + dt.timedelta(hours=1), "u", "Herinnerd", "r2", "q", 3, 1),
        ],
        "prediction_id long, timestamp timestamp, user string, call_outcome string, remarks string,"
        " patient_id string, call_number int, opt_out int",
    )
    rows = {r.prediction_id: r for r in ledger.record_calls(calls, batch).collect()}
    assert (rows[1].id, rows[1].call_status) == (4, "Niet gebeld")
    assert (rows[2].id, rows[2].call_status, rows[2].remarks) == (5, "Gebeld", "r2")
    people = spark.createDataFrame([("q", 0, 0, 1), ("idle", 7, 0, 1)], PATIENT)
    assert {tuple(r) for r in ledger.record_contact_choice(people, batch).collect()} == {
        ("q", 3, 1, 1),
        ("idle", 7, 0, 1),
    }


def test_run_log_replaces_only_its_own_record(spark, tmp_path):
    for code in (400, 200):
        log_run(spark, str(tmp_path), 1, NOON, 1.5, "v", code)
    log_run(spark, str(tmp_path), 2, NOON, 2.5, "v")
    assert sorted((r.id, r.response_code) for r in read_runs(spark, str(tmp_path)).collect()) == [
        (1, 200),
        (2, 200),
    ]


def test_mute_period_ends(spark):
    """Thursday the 18th: calls count from the Monday before, back 15 days."""
    day = dt.date(2024, 1, 18)
    stamps = {
        1: dt.datetime(2023, 12, 30, 23, 59),
        2: dt.datetime(2023, 12, 31),
        3: dt.datetime(2024, 1, 14, 23, 59),
        4: dt.datetime(2024, 1, 15),
    }
    made = spark.createDataFrame([prediction(i, str(i), f"p{i}") for i in stamps], PREDICTION)
    calls = spark.createDataFrame(
        [(i, at, None, "Gebeld", "Herinnerd", "", i) for i, at in stamps.items()], CALL
    )
    muted = {r.patient_id for r in outreach.muted_pairs(made, calls, day, 0.5).collect()}
    assert muted == {"p2", "p3"}
    assert outreach.muted_pairs(made, calls, day, 0).isEmpty()


def test_call_list_order_and_filters(spark):
    made = spark.createDataFrame(
        [
            prediction(1, "1", "a", score=0.3),
            prediction(2, "2", "b", score=0.9),
            prediction(3, "3", "b", score=0.2, clinic="x"),
            prediction(4, "4", "opted", score=0.9),
            prediction(5, "5", "control", score=0.9),
            prediction(6, "6", "low", score=0.01),
            prediction(7, "7", "off", active=False, score=0.9),
            prediction(8, "8", "outside", score=0.5),
            prediction(9, "9", "later", start=NOON + dt.timedelta(days=1), score=0.9),
        ],
        PREDICTION,
    )
    groups = {"control": 0, "outside": 2}
    people = spark.createDataFrame(
        [(w, None, 1 if w == "opted" else (0 if w == "a" else None), groups.get(w, 1))
         for w in ("a", "b", "opted", "control", "low", "off", "outside", "later")],
        PATIENT,
    )
    calls = spark.createDataFrame([], CALL)
    listed = outreach.call_list(made, people, calls, DAY)
    assert [r.patient_id for r in listed.collect()] == ["b", "a", "outside"]
    done = spark.createDataFrame([(1, NOON, None, "Gebeld", "Herinnerd", "", 2)], CALL)
    first = outreach.first_uncalled(listed, made, done, NOON.date())
    assert [r.patient_id for r in first.collect()] == ["a"]


def test_kpis_of_nothing(spark):
    empty = spark.createDataFrame([], "call_outcome string, opt_out int")
    assert reports.call_kpis(empty).first().called == "0 (0.00%)"


# --- scoring runs -------------------------------------------------------------


def scorer(features):
    chance = F.lit(0.1) + F.col("prev_missed_share") / 2 + F.col("hour") / 1000
    return features.withColumn("prediction", chance)


@pytest.fixture(scope="module")
def body(tmp_path_factory):
    path = tmp_path_factory.mktemp("body") / "body.json"
    path.write_text(json.dumps(records()))
    return str(path)


def test_scoring_run(spark, body):
    rows = read_appointments_json(spark, body, order=True)
    state, scored = run_scoring(rows, postal_codes(spark), State.empty(spark), scorer, SETTINGS, SCORING_DAY)
    assert scored.count() == 3
    made = state.predictions.collect()
    assert sorted(r.id for r in made) == [1, 2, 3]
    assert all(r.active and r.start_time.date() == SCORING_DAY for r in made)
    assert {r.treatment_group for r in state.patients.collect()} == {2}
    assert state.contacts.where("full_name = 'Name bob'").count() == 1
    fewer = rows.where("pseudo_id <> 'cas'")
    second, _ = run_scoring(
        fewer, postal_codes(spark), state, scorer, SETTINGS, SCORING_DAY, request_id=2
    )
    off = [r.patient_id for r in second.predictions.collect() if not r.active]
    assert off == ["cas"]


def test_scoring_nothing_is_an_error(spark, body):
    rows = read_appointments_json(spark, body, order=True)
    with pytest.raises(ValueError):
        run_scoring(
            rows, postal_codes(spark), State.empty(spark), scorer, SETTINGS, dt.date(2030, 1, 1)
        )


def text_schema():
    from pyspark.sql import types as T

    from rollcall.schema import APPOINTMENT

    return T.StructType([T.StructField(f.name, T.StringType()) for f in APPOINTMENT.fields])


def prepare(batch):
    return coerce_appointments(batch).withColumn("_seq", F.col("APP_ID").cast("long"))


def test_stream_equals_batch_and_survives_a_replay(spark, tmp_path):
    """Past visits arrive first, the planned ones in a second file."""
    source = tmp_path / "in"
    source.mkdir()
    planned = [r for r in records() if r["status"] == "planned"]
    past = [r for r in records() if r["status"] != "planned"]

    def drop(name, rows):
        (source / name).write_text("\n".join(json.dumps(r) for r in rows))

    def run(tables, checkpoint):
        stream = spark.readStream.schema(text_schema()).json(str(source))
        stream_scoring(
            stream, prepare, tables, str(checkpoint), postal_codes(spark), scorer, SETTINGS, SCORING_DAY
        ).awaitTermination()

    tables = SnapshotTables(spark, str(tmp_path / "state"))
    drop("1.json", past)
    run(tables, tmp_path / "offsets")
    assert tables.read(0).predictions.isEmpty()
    drop("2.json", planned)
    run(tables, tmp_path / "offsets")
    streamed = tables.read(1)

    body = tmp_path / "all.json"
    body.write_text(json.dumps(records()))
    rows = read_appointments_json(spark, str(body)).withColumn("_seq", F.col("APP_ID").cast("long"))
    state, _ = run_scoring(
        rows, postal_codes(spark), State.empty(spark), scorer, SETTINGS, SCORING_DAY, request_id=2
    )
    for name in ("contacts", "patients", "predictions"):
        assert sorted(getattr(streamed, name).collect(), key=str) == sorted(
            getattr(state, name).collect(), key=str
        )

    # Losing the last commit makes the second batch run again.
    (tmp_path / "offsets" / "commits" / "1").unlink()
    (tmp_path / "offsets" / "commits" / ".1.crc").unlink(missing_ok=True)
    before = sorted(streamed.predictions.collect(), key=str)
    run(tables, tmp_path / "offsets")
    assert sorted(tables.read(1).predictions.collect(), key=str) == before
    assert read_runs(spark, str(tmp_path / "state" / "requests")).count() == 1


def scored_rows(spark, run, day, patients):
    """One appointment of each patient, on the days from ``day`` on."""
    start = dt.datetime.combine(day, dt.time(9))
    rows = [
        batch_row(f"{run}-{p}", p, phone=f"t{run}", group=2, start=start + dt.timedelta(days=k)) for k, p in enumerate(patients)
    ]
    return spark.createDataFrame(rows, BATCH)


@pytest.mark.parametrize("settle_after", [2, 84])
def test_buckets_hold_what_whole_tables_hold(spark, tmp_path, settle_after):
    """Runs over few patients switch off and delete rows of all others, whose files they do not touch."""
    day = SCORING_DAY
    everyone = [f"p{i}" for i in range(9)]
    runs = [(day, everyone), (day, ["p1"]), (day + dt.timedelta(days=400), ["p2", "p8"]), (day + dt.timedelta(days=2), ["new"])]
    whole = State.empty(spark)
    tables = SnapshotTables(spark, str(tmp_path / "state"), buckets=8, settle_after=settle_after)
    for version, (first, patients) in enumerate(runs):
        rows = scored_rows(spark, version, first, patients)
        whole = apply_scores(whole, rows, SETTINGS, first, version + 1)
        touched = touched_buckets(rows, "pseudo_id", 8)
        written = tables.to_write(touched, version)
        part = tables.read(version - 1, written)
        after = apply_scores(part, rows, SETTINGS, first, version + 1, tables.top_id(version - 1))
        tables.write(after, version, written, first, SETTINGS.keep_sensitive_data)
        for name in ("contacts", "patients", "predictions"):
            want = sorted(getattr(whole, name).collect(), key=str)
            assert sorted(getattr(tables.read(version), name).collect(), key=str) == want, (version, name)
        if version == 1 and settle_after > 2:
            made = {f.parent.name for f in (tmp_path / "state" / "predictions" / "v=1").rglob("*.parquet")}
            assert made == {f"bucket={touched[0]}"} and len(touched) == 1
    assert tables.latest() == 3 and whole.contacts.count() < 9
    assert sorted(p.name for p in (tmp_path / "state" / "manifest").iterdir() if p.is_dir()) == ["v=2", "v=3"]
    named = {v for m in (2, 3) for v in tables.store.manifest(m)["files"]["predictions"].values()}
    held = {int(f.parent.parent.name[2:]) for f in (tmp_path / "state" / "predictions").rglob("*.parquet")}
    assert held == named
    # A version written again, also an empty one, changes nothing.
    before = sorted(tables.read(3).predictions.collect(), key=str)
    tables.write(after, 3, written, first, SETTINGS.keep_sensitive_data)
    tables.pass_on(4)
    assert sorted(tables.read(4).predictions.collect(), key=str) == before


def test_given_tables_are_kept(spark, tmp_path):
    rows = scored_rows(spark, 0, SCORING_DAY, ["a", "b", "c"])
    given = apply_scores(State.empty(spark), rows, SETTINGS, SCORING_DAY, 1)
    tables = SnapshotTables(spark, str(tmp_path / "state"), given, buckets=4)
    assert tables.to_write([1], 0) == [0, 1, 2, 3]
    tables.pass_on(0)
    assert sorted(tables.read(0).predictions.collect(), key=str) == sorted(given.predictions.collect(), key=str)
    assert tables.top_id(0) == 3 and tables.read(0).contacts.count() == 3


def test_resent_rows_count_once(spark, tmp_path):
    """Every part is sent twice; the tables are those of sending it once."""
    results = []
    for times in (1, 2):
        source = tmp_path / f"in{times}"
        source.mkdir()
        tables = SnapshotTables(spark, str(tmp_path / f"state{times}"), buckets=4)
        for part in range(times):
            (source / f"{part}.json").write_text("\n".join(json.dumps(r) for r in records()))
            stream = spark.readStream.schema(text_schema()).json(str(source))
            stream = stream.withColumn("received", F.lit("2024-01-01 00:00:00").cast("timestamp"))
            once = without_resent(stream, "received", "1 day", ["APP_ID", "start", "status"]).drop("received")
            stream_scoring(
                once, prepare, tables, str(tmp_path / f"offsets{times}"), postal_codes(spark), scorer, SETTINGS, SCORING_DAY
            ).awaitTermination()
        found = tables.read(tables.latest())
        history = spark.read.parquet(str(tmp_path / f"state{times}" / "history")).count()
        results.append((sorted(found.predictions.collect(), key=str), sorted(found.contacts.collect(), key=str), history))
    assert results[0] == results[1] and len(results[0][0]) == 3


def test_stream_keeps_first_groups(spark, tmp_path):
    source, root = tmp_path / "in", tmp_path / "state"
    edges = spark.createDataFrame([("A", [0.0, 0.25, 0.5, 0.75, 0.9])], "hoofdagenda string, edges array<double>")
    schema = "APP_ID int, pseudo_id string, hoofdagenda string, clinic string, prediction double, start timestamp"
    for part in range(3):
        rows = [
            (part * 20 + i, f"p{(i * (part + 1)) % 17}", "A", "c", (i + 1) / 21, NOON + dt.timedelta(days=part))
            for i in range(20)
        ]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(schema).parquet(str(source))
        stream_assignment(stream, str(root), str(tmp_path / "offsets"), edges).awaitTermination()
    everyone = spark.read.parquet(str(root / "assigned"))
    assert everyone.count() == 60
    per_patient = everyone.groupBy("pseudo_id").agg(F.countDistinct("treatment_group").alias("n"))
    assert {r.n for r in per_patient.collect()} == {1}
