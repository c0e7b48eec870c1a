"""Column expressions against hand-computed values."""

import datetime as dt
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from rollcall.functions import scalars, temporal


def one(spark, *columns):
    row = spark.range(1).select(*columns).first()
    return row[0] if len(columns) == 1 else tuple(row)


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize(
    ("start", "n", "target"),
    [
        ("2023-09-11", 3, "2023-09-14"),
        ("2023-09-11", 6, "2023-09-19"),
        ("2023-09-13", 3, "2023-09-18"),
        ("2023-09-15", 0, "2023-09-15"),
        ("2025-10-28", -3, "2025-10-23"),
        ("2025-10-28", -6, "2025-10-20"),
        ("2025-10-31", -3, "2025-10-28"),
        ("2025-10-31", -6, "2025-10-23"),
        ("2023-09-16", 0, "2023-09-16"),
        ("2023-09-16", 1, "2023-09-18"),
        ("2023-09-17", -1, "2023-09-15"),
    ],
)
def test_working_days(spark, start, n, target):
    value = one(spark, temporal.add_working_days(F.lit(start).cast("date"), n))
    assert value == dt.date.fromisoformat(target)


def test_working_days_walk(spark):
    """Every weekday, 40 steps each way, against the day-by-day walk."""

    def walk(day, n):
        step = 1 if n > 0 else -1
        left = abs(n)
        while left:
            day += dt.timedelta(days=step)
            left -= day.weekday() < 5
        return day

    cases = [
        (dt.date(2024, 1, 1) + dt.timedelta(days=d), n) for d in range(7) for n in range(-40, 41)
    ]
    df = spark.createDataFrame(cases, "d date, n int")
    rows = df.select("d", "n", temporal.add_working_days("d", "n").alias("t")).collect()
    assert all(r.t == walk(r.d, r.n) for r in rows)


def test_floor_days_floors_negatives(spark):
    assert one(
        spark,
        temporal.floor_days(ts("2024-01-02 00:00:00"), ts("2024-01-01 00:00:01")),
        temporal.floor_days(ts("2024-01-01 00:00:00"), ts("2024-01-01 01:00:00")),
    ) == (0, -1)


def test_minute_boundaries_count_marks(spark):
    assert one(
        spark,
        temporal.minute_boundaries(ts("2024-01-01 00:00:59"), ts("2024-01-01 00:01:00")),
        temporal.minute_boundaries(ts("2024-01-01 00:00:00"), ts("2024-01-01 00:00:59")),
    ) == (1, 0)


def test_pseudonymize(spark):
    want = hashlib.sha256(b"12salt").hexdigest().upper()
    empty = hashlib.sha256(b"salt").hexdigest().upper()
    null = F.lit(None).cast("string")
    assert one(
        spark, scalars.pseudonymize(F.lit(12), "salt"), scalars.pseudonymize(null, "salt")
    ) == (want, empty)


def test_haversine(spark):
    near, town = one(
        spark,
        scalars.haversine_km(F.lit(52.0846), F.lit(5.1637)),
        scalars.haversine_km(F.lit(52.0238), F.lit(5.1842)),
    )
    assert near < 2
    assert 6 < town < 8


def test_null_rules(spark):
    null = F.lit(None).cast("string")
    assert one(spark, scalars.differs_from(null, "x"), scalars.not_in(null, ["x"])) == (True, True)
    assert one(spark, scalars.share(F.lit(1), F.lit(0)), scalars.share(F.lit(0), F.lit(0))) == (0, 0)
    number = F.lit(None).cast("int")
    assert one(spark, scalars.clamp(number, F.lit(0), F.lit(1))) is None


def test_right_closed_bins(spark):
    edges = scalars.uniform_edges(4)[1:-1]
    values = [0.0, 0.25, 0.26, 1.0]
    got = one(spark, *[scalars.right_closed_bin(F.lit(v), edges) for v in values])
    assert got == (0, 0, 1, 3)
    assert one(spark, scalars.right_closed_bin(F.lit(None).cast("double"), edges)) is None


def test_uniform_edges_end_at_one():
    assert scalars.uniform_edges(10)[-1] == 1.0
    assert all(math.isclose(e, i / 10) for i, e in enumerate(scalars.uniform_edges(10)))
