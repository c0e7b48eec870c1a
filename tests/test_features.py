"""History features: literal values, brute force on a hot patient, plan shape."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from rollcall.functions.temporal import DAY_US
from rollcall.operators import features
from rollcall.operators.timeline import (
    Lagged,
    Previous,
    SameDay,
    Trailing,
    with_history,
)


def stamp(text):
    return dt.datetime.fromisoformat(text)


def ordered(df, *columns):
    rows = df.orderBy("start", "pseudo_id").collect()
    return [[r[c] for r in rows] for c in columns]


def test_lagged_sum_and_count(spark):
    days = ["01-01", "01-02", "01-10", "01-01", "01-04", "01-05"]
    rows = [
        (who, val, stamp(f"2022-{day}"))
        for who, val, day in zip(["1"] * 3 + ["5"] * 3, [1, 1, 0, 0, 1, 1], days)
    ]
    df = spark.createDataFrame(rows, "pseudo_id string, val int, start timestamp")
    out = features.lagged_cumulative(df, "val", "total")
    out = features.lagged_cumulative(out, "val", "n", func="count")
    rows = out.orderBy("pseudo_id", "start").collect()
    by_key = {(r.pseudo_id, r.start.strftime("%m-%d")): (r.total, r.n) for r in rows}
    assert by_key == {
        ("1", "01-01"): (0, 0),
        ("1", "01-02"): (0, 0),
        ("1", "01-10"): (2, 2),
        ("5", "01-01"): (0, 0),
        ("5", "01-04"): (0, 1),
        ("5", "01-05"): (0, 1),
    }


def test_unknown_function_is_an_error():
    with pytest.raises(NotImplementedError):
        Lagged("x", "y", DAY_US, "max")


def test_previous_missed_visits(spark):
    rows = [
        ("1", "missed", stamp("2022-01-01")),
        ("1", "missed", stamp("2022-01-02")),
        ("5", "missed", stamp("2022-01-01")),
        ("5", "attended", stamp("2022-01-04")),
    ]
    df = spark.createDataFrame(rows, "pseudo_id string, missed string, start timestamp")
    out = features.prev_missed_features(df)
    assert ordered(out, "prev_missed", "prev_missed_share", "earlier_appointments") == [
        [0, 0, 0, 1],
        [0.0, 0.0, 0.0, 1.0],
        [0, 0, 0, 1],
    ]


def test_minutes_early(spark):
    rows = [
        ("1", 0, "2022-01-01 00:04", "2022-01-01"),
        ("1", 0, "2022-01-02 00:02", "2022-01-02"),
        ("1", 2, "2022-01-10 00:01", "2022-01-10"),
        ("5", 0, "2021-12-31 23:55", "2022-01-01"),
        ("5", 1, "2022-01-04 00:01", "2022-01-04"),
        ("5", 1, "2022-01-05 00:00", "2022-01-05"),
    ]
    df = spark.createDataFrame(
        [(w, n, stamp(a), stamp(s)) for w, n, a, s in rows],
        "pseudo_id string, earlier_appointments int, gearriveerd timestamp, start timestamp",
    )
    (early,) = ordered(features.add_prev_minutes_early(df), "prev_minutes_early")
    assert early == [0.0, 0.0, 0.0, 5.0, 5.0, -3.0]


def test_minutes_early_is_limited_and_zero_without_arrival(spark):
    rows = [
        ("1", stamp("2022-01-01 12:00"), stamp("2022-01-01 08:00")),
        ("2", stamp("2022-01-01 12:00"), stamp("2022-01-01 18:00")),
        ("3", stamp("2022-01-01 12:00"), None),
    ]
    df = spark.createDataFrame(rows, "pseudo_id string, start timestamp, gearriveerd timestamp")
    (early,) = ordered(features.add_minutes_early(df), "minutes_early")
    assert early == [60.0, -60.0, 0.0]


def test_appointment_windows(spark):
    rows = [
        ("1", 1, "2022-01-01 09:00"),
        ("5", 2, "2022-01-01 10:00"),
        ("1", 3, "2022-01-02 16:00"),
        ("5", 4, "2022-01-04 11:00"),
        ("5", 5, "2022-01-04 11:30"),
        ("1", 6, "2022-01-10 17:00"),
    ]
    df = spark.createDataFrame(
        [(w, i, stamp(s)) for w, i, s in rows], "pseudo_id string, APP_ID int, start timestamp"
    )
    out = features.appointments_last_days(features.days_since_last(df), 5)
    out = features.appointments_same_day(out)
    assert ordered(
        out, "days_since_last_appointment", "appointments_same_day", "appointments_last_days"
    ) == [[0, 0, 1, 3, 0, 8], [1, 1, 1, 2, 2, 1], [1, 1, 2, 2, 3, 1]]


def test_frame_ends(spark):
    """A row exactly three days old counts; one exactly fourteen days old does not."""
    rows = [("1", 1, stamp("2022-01-01")), ("1", 2, stamp("2022-01-04")), ("1", 3, stamp("2022-01-15"))]
    df = spark.createDataFrame(rows, "pseudo_id string, APP_ID int, start timestamp")
    out = features.lagged_cumulative(df, "APP_ID", "n", func="count")
    out = features.appointments_last_days(out, 14)
    assert ordered(out, "n", "appointments_last_days") == [[0, 1, 2], [1, 2, 2]]


def test_patient_features_drop_unknown_places(spark):
    rows = [
        ("1", stamp("2022-01-01"), 1991, 3994),
        ("2", stamp("2022-01-01"), 2000, 3584),
        ("3", stamp("2022-01-01"), 2000, 9999),
        ("4", stamp("2022-01-01"), 2000, None),
    ]
    df = spark.createDataFrame(
        rows,
        "pseudo_id string, start timestamp, BIRTH_YEAR int, address_postalCodeNumbersNL int",
    )
    postal = spark.createDataFrame(
        [(3994, 52.0238, 5.1842), (3584, 52.0846, 5.1637)],
        "postalcode int, latitude double, longitude double",
    )
    out = features.add_patient_features(df, postal)
    distance, age = ordered(out, "dist_hospital", "age")
    assert age == [31, 22]
    assert 6 < distance[0] < 8
    assert distance[1] < 2


def hot_rows(seed, n=600):
    """A third of the rows belong to one patient; times tie and cross midnight; patients and times are missing."""
    rng = random.Random(seed)
    origin = dt.datetime(2024, 2, 26)
    rows = []
    for i in range(n):
        who = "hot" if i % 3 == 0 else f"p{rng.randrange(12)}"
        minutes = rng.randrange(0, 40 * 24 * 60, 30)
        value = None if rng.random() < 0.1 else rng.randrange(5)
        who = None if rng.random() < 0.1 else who
        at = None if rng.random() < 0.05 else origin + dt.timedelta(minutes=minutes)
        rows.append((i, who, at, value))
    return rows


SPECS = [
    Lagged("lag_sum", "v", 3 * DAY_US),
    Lagged("lag_n", "v", 5 * DAY_US, "count"),
    Trailing("last", "v", 14 * DAY_US),
    Trailing("last3", "v", 3 * DAY_US),
    SameDay("day_n", "v"),
    Previous("prev"),
]


@pytest.mark.parametrize("chunk", [None, DAY_US // 24, DAY_US // 96])
def test_history_equals_brute_force_and_windows(spark, chunk):
    """Any chunk width gives the same; without patient or time rows count as window SQL has them."""
    rows = hot_rows((chunk or 1) % 97)
    df = spark.createDataFrame(rows, "i int, pseudo_id string, start timestamp, v int")
    got = {r.i: r for r in with_history(df, "pseudo_id", "start", SPECS, chunk).collect()}
    assert len(got) == len(rows)
    df.createOrReplaceTempView("history_rows")
    ranged = "OVER (PARTITION BY pseudo_id ORDER BY unix_micros(start) RANGE BETWEEN"
    windows = spark.sql(
        f"""SELECT i, coalesce(sum(v) {ranged} UNBOUNDED PRECEDING AND {3 * DAY_US} PRECEDING), 0) AS lag_sum,
        count(v) {ranged} UNBOUNDED PRECEDING AND {5 * DAY_US} PRECEDING) AS lag_n,
        count(v) {ranged} {14 * DAY_US - 1} PRECEDING AND CURRENT ROW) AS last,
        count(v) {ranged} {3 * DAY_US - 1} PRECEDING AND CURRENT ROW) AS last3,
        count(v) OVER (PARTITION BY pseudo_id, to_date(start)) AS day_n,
        lag(start) OVER (PARTITION BY pseudo_id ORDER BY start) AS prev FROM history_rows"""
    )
    for r in windows.collect():
        assert r.asDict() == {c: got[r.i][c] for c in r.asDict()}
    for i, who, at, _ in rows:
        if at is None:
            continue
        mine = [(t, v) for _, w, t, v in rows if w == who]
        timed = [(t, v) for t, v in mine if t is not None]
        untimed = [v for t, v in mine if t is None]
        lag = untimed + [v for t, v in timed if t <= at - dt.timedelta(days=3)]
        lag5 = untimed + [v for t, v in timed if t <= at - dt.timedelta(days=5)]
        last = [v for t, v in timed if at - dt.timedelta(days=14) < t <= at]
        day = [v for t, v in timed if t.date() == at.date()]
        row = got[i]
        assert row.lag_sum == sum(v or 0 for v in lag)
        assert row.lag_n == sum(v is not None for v in lag5)
        assert row.last == sum(v is not None for v in last)
        assert row.day_n == sum(v is not None for v in day)


def test_history_of_one_busy_patient_is_linear(spark):
    """80,000 rows inside one trailing window."""
    df = spark.range(80_000).select(
        F.lit("hot").alias("p"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("t"),
        F.col("id").alias("v"),
    )
    out = with_history(df, "p", "t", [Trailing("n", "v", 14 * DAY_US)])
    began = time.perf_counter()
    assert out.agg(F.max("n"), F.sum("n")).first() == (80_000, 80_000 * 80_001 // 2)
    assert time.perf_counter() - began < 60


def test_chunk_must_divide_a_day(spark):
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 1)], "p string, t timestamp, v int")
    with pytest.raises(ValueError):
        with_history(df, "p", "t", [SameDay("n", "v")], DAY_US - 1)


def test_row_windows_never_span_a_hot_patient(spark):
    """Windows over a hot patient's rows are partitioned by (patient, chunk)."""
    df = spark.createDataFrame(hot_rows(1), "i int, pseudo_id string, start timestamp, v int")
    specs = [Lagged("s", "v", 3 * DAY_US), Previous("prev"), SameDay("n", "v")]
    out = with_history(df, "pseudo_id", "start", specs)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_chunk" in plan
    for line in plan.splitlines():
        if "Window [" in line and "_at" in line:
            assert "[_entity" in line and "_chunk" in line.split("], [")[-2]
