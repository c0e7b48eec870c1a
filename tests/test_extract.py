"""Extract filters, scratch space, and label tables on hand-made rows."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from rollcall import session
from rollcall.operators import extract, reports

DAY = dt.date(2024, 1, 10)
SCHEMA = (
    "patient_value string, start timestamp, end timestamp, status string, type1_code string,"
    " type1_display string, type2_code string, without_patient int, deceased int, address_active int"
)


def visit(who, start, status="planned", code="C", display="Controle", kind="R", empty=0, dead=0, home=1):
    return (who, start, start + dt.timedelta(minutes=30), status, code, display, kind, empty, dead, home)


def at(day, hour=9):
    return dt.datetime(2024, 1, day, hour)


@pytest.fixture(scope="module")
def visits(spark):
    rows = [
        visit("kept", at(10)),
        visit("kept", at(1), status="finished"),
        visit("code", at(10), code="FAMF"),
        visit("code", at(1), status="finished"),
        visit("phone", at(10), display="TELEFOnisch"),
        visit("call", at(10), display="tc kort"),
        visit("other day", at(11)),
        visit("null code", at(10), code=None),
        visit("null display", at(10), display=None),
        visit("dead", at(1), status="finished", dead=1),
        visit("moved away", at(1), status="finished", home=None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_active_patients_keep_their_history(visits):
    loose = extract.active_patient_history(visits, DAY).collect()
    # The loose form tests the code of the row itself, so "code" keeps its old visit.
    assert sorted((r.patient_value, r.start.day) for r in loose) == [
        ("code", 1),
        ("kept", 1),
        ("kept", 10),
    ]
    strict = extract.active_patient_history(visits, DAY, strict=True).collect()
    assert {r.patient_value for r in strict} == {"kept"}


def test_eligible_rows_are_past_and_complete(visits):
    rows = extract.filter_eligible(visits, dt.datetime(2024, 1, 9)).collect()
    assert sorted((r.patient_value, r.start.day) for r in rows) == [("code", 1), ("kept", 1)]
    assert extract.filter_eligible(visits, dt.datetime(2033, 1, 9)).isEmpty()


def test_prediction_window_includes_planned_rows(visits):
    rows = extract.filter_prediction_window(visits, dt.date(2024, 1, 1), days=10).collect()
    # Until midnight of the 11th: the visit at nine that day is out.
    assert sorted({r.patient_value for r in rows}) == ["code", "kept"]


def test_source_system_is_an_argument(visits):
    marked = visits.withColumn("identifier_system", F.when(F.col("patient_value") == "kept", "a"))
    past = extract.filter_eligible(marked, dt.datetime(2024, 1, 9), system="a")
    ahead = extract.filter_prediction_window(marked, dt.date(2024, 1, 1), days=10, system="a")
    assert [r.patient_value for r in past.collect()] == ["kept"]
    assert {r.patient_value for r in ahead.collect()} == {"kept"}
    assert extract.filter_eligible(marked, dt.datetime(2024, 1, 9), system="b").isEmpty()


def test_not_in_keeps_unmatched_keys(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(2,), (2,)], "o int")
    assert [r.k for r in extract.not_in_rows(left, right, "k", "o").collect()] == [1]


def test_feature_rate_keeps_missing_labels_missing(spark):
    rows = [("attended", 1), ("attended", 1), ("missed", 2), ("attended", 2), ("missed", None)]
    df = spark.createDataFrame(rows, "missed string, feature int")
    got = {r.feature: r for r in reports.feature_rate(df, "feature").collect()}
    assert set(got) == {1, 2}
    assert got[1].missed is None and got[1].missed_share is None
    assert (got[2].missed_share, got[2].attended_share) == (0.5, 0.5)


def test_feature_rate_rounds_half_to_even(spark):
    df = spark.createDataFrame([("attended", 0.5), ("missed", 1.5), ("attended", 2.5)], "missed string, f double")
    assert {r.f for r in reports.feature_rate(df, "f", 0).collect()} == {0.0, 2.0}


def test_attended_overrides_missed(spark):
    df = spark.createDataFrame(
        [("J", "N"), (None, "N"), ("A", None)], "status_code_original string, mutationReason_code string"
    )
    assert [r.outcome for r in reports.trial_outcome(df).collect()] == ["Attended", "Missed", None]


def test_days_without_appointments_are_counted(spark):
    df = spark.createDataFrame([(at(1),), (at(1, 10),), (at(4),)], "start timestamp")
    per_day = reports.appointments_per_day(df)
    assert [r.n for r in per_day.orderBy("day").collect()] == [2, 0, 0, 1]
    assert {r.n: r.days for r in reports.daily_count_histogram(per_day).collect()} == {0: 2, 1: 1, 2: 1}


def test_materialized_rows_can_be_dropped(spark):
    kept = session.materialize(spark.range(5).withColumn("x", F.lit(1)), "probe")
    assert kept.count() == 5
    folder = session._own_folder(spark).removeprefix("file:")
    assert os.path.isdir(folder)
    session.drop_scratch(spark)
    assert not os.path.exists(folder)


def test_scratch_defaults_to_the_home_on_the_default_file_system(spark):
    assert session.scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")

    class Unset:
        _jvm, _jsc = spark._jvm, spark._jsc
        sparkContext = conf = type("", (), {"getCheckpointDir": lambda _: None, "get": lambda _, key, default: default})()

    home = spark._jvm.org.apache.hadoop.fs.FileSystem.get(spark._jsc.hadoopConfiguration()).getHomeDirectory()
    assert session.scratch_root(Unset()).startswith(home.toString())
