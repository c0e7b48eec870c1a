"""Treatment assignment: rules and invariants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rollcall.operators import trial

SCHEMA = "APP_ID int, prediction double, hoofdagenda string, pseudo_id long, clinic string"


@pytest.fixture(scope="module")
def predictions(spark):
    agendas = "AABBCCDDEE"
    patients = [1, 2, 3, 1, 3, 2, 4, 1, 2, 4]
    clinics = ["C1", "C1", "C2", "C2", "C3", "C3", "C5", "C5", "C5", "C5"]
    rows = [
        (i, (i + 1) / 10, a, p, c) for i, (a, p, c) in enumerate(zip(agendas, patients, clinics))
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def edges(spark):
    common = [0.003, 0.03, 0.053, 0.077, 0.69]
    return spark.createDataFrame([(a, common) for a in "ABCDE"], "hoofdagenda string, edges array<double>")


def known(spark, *rows):
    return spark.createDataFrame(list(rows), "id long, treatment_group int")


@pytest.mark.parametrize("seed", [None, 0, 1337])
def test_one_group_per_patient(spark, predictions, edges, seed):
    out = trial.treatment_groups(predictions, known(spark), edges, seed=seed)
    assert dict(out.dtypes)["treatment_group"] == "int"
    assert out.count() == 10
    assert {r.treatment_group for r in out.collect()} <= {0, 1}
    assert trial.group_violations(out).isEmpty()


def test_known_patients_keep_their_group(spark, predictions, edges):
    out = trial.treatment_groups(predictions, known(spark, (1, 1), (2, 0)), edges)
    groups = {(r.pseudo_id, r.treatment_group) for r in out.collect()}
    assert (1, 1) in groups and (2, 0) in groups
    assert trial.group_violations(out).isEmpty()


def test_clinics_outside_the_trial(spark, predictions, edges):
    out = trial.treatment_groups(predictions, known(spark, (1, 1)), edges, ["C1", "C5"])
    for r in out.collect():
        assert (r.treatment_group == 2) == (r.clinic not in ("C1", "C5"))
    nobody = trial.treatment_groups(predictions, known(spark), edges, [])
    assert {r.treatment_group for r in nobody.collect()} == {2}


def test_no_predictions_is_an_error(spark, edges):
    with pytest.raises(ValueError):
        trial.treatment_groups(spark.createDataFrame([], SCHEMA), known(spark), edges)


def test_a_new_patient_without_any_bin_is_an_error(spark, edges):
    df = spark.createDataFrame([(1, 0.0, "A", 7, "C1")], SCHEMA)
    with pytest.raises(Exception, match="no score inside"):
        trial.treatment_groups(df, known(spark), edges).collect()


def test_arms_alternate_in_a_hot_stratum(spark):
    df = spark.range(3000).select(
        F.col("id").alias("APP_ID"),
        F.when(F.col("id") % 3 == 0, "A").otherwise("B").alias("g"),
        ((F.col("id") * 37 % 101) / 101).alias("prediction"),
    )
    for seed in (None, 3):
        rows = trial.alternate(df, ["g"], seed=seed).orderBy("g", F.col("prediction").desc(), "APP_ID").collect()
        for g in "AB":
            arms = [r.arm for r in rows if r.g == g]
            assert all(a != b for a, b in zip(arms, arms[1:]))
            if seed is None:
                assert arms[0] == 0


def test_merge_prefers_the_known_group(spark):
    merged = trial.merge_groups(known(spark, (1, 1), (2, None)), known(spark, (1, 0), (2, 0), (3, 1)))
    assert {tuple(r) for r in merged.collect()} == {(1, 1), (2, 0), (3, 1)}


def test_replay_equals_the_day_by_day_loop(spark, edges):
    start = dt.datetime(2024, 1, 1)
    rows = [
        (i, ((i * 37) % 100 + 1) / 101, "ABCDE"[i % 5], (i * 7) % 23, "C", start + dt.timedelta(days=i // 20))
        for i in range(100)
    ]
    df = spark.createDataFrame(rows, SCHEMA + ", start timestamp")
    replayed = trial.replay_assignment(df, edges, [], known(spark), seed=None)
    got = {r.APP_ID: r.treatment_group for r in replayed.collect()}
    patients: dict[int, int] = {}
    for day in range(5):
        part = df.where(F.to_date("start") == F.lit(start.date() + dt.timedelta(days=day)))
        table = known(spark, *patients.items())
        for r in trial.treatment_groups(part, table, edges, seed=None).collect():
            assert got[r.APP_ID] == r.treatment_group
            patients[r.pseudo_id] = r.treatment_group
    assert trial.group_violations(replayed).isEmpty()


def test_group_violations(spark):
    rows = [(1, 0), (1, 1), (2, None), (3, 1)]
    df = spark.createDataFrame(rows, "pseudo_id int, treatment_group int")
    assert {r.pseudo_id for r in trial.group_violations(df).collect()} == {1, 2}
