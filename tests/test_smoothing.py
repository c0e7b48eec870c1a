"""Kernel densities, the smoothed calibration error and the computed calendar against direct versions."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.functions.temporal import easter_day
from rollcall.operators import outreach, quality, reports


def direct_error(f, y):
    """The width that equals the mean absolute smoothed residual; mirrored kernels summed row by row."""
    f, gap = np.array(f), np.array(y) - np.array(f)
    t = np.linspace(0, 1, 2001)

    def error(width):
        total = np.zeros_like(t)
        for shift in range(-6, 7):
            for centre in (2 * shift + f, 2 * shift - f):
                z = (t[:, None] - centre[None, :]) / width
                total += (np.exp(-0.5 * z * z) * gap[None, :]).sum(1) / (width * math.sqrt(2 * math.pi))
        return np.trapezoid(np.abs(total) / len(f), t)

    low, high = 1e-4, 1.0
    for _ in range(14):
        middle = (low + high) / 2
        low, high = (middle, high) if error(middle) > middle else (low, middle)
    return (low + high) / 2


@pytest.mark.parametrize("kind", ["calibrated", "shifted", "far"])
def test_smoothed_error_is_the_direct_one(spark, kind):
    rng = random.Random(11)
    f = [rng.betavariate(2, 5) for _ in range(2000)]
    chance = {"calibrated": lambda x: x, "shifted": lambda x: min(1, x + 0.1), "far": lambda x: 1 - x}[kind]
    y = [float(rng.random() < chance(x)) for x in f]
    rows = [(kind, a, b) for a, b in zip(f, y, strict=True)] + [("other", 0.5, 1.0), (kind, None, 1.0), (kind, 0.2, None)]
    df = spark.createDataFrame(rows, "month string, score double, y double")
    got = {r["month"]: r for r in quality.smoothed_calibration_error(df, "score", "y", ["month"]).collect()}
    assert got[kind]["n"] == 2000
    assert got[kind]["smooth_ece"] == pytest.approx(direct_error(f, y), abs=1e-3)
    assert 0 < got["other"]["smooth_ece"] <= 0.5 + 1e-3


def test_smoothed_error_of_nothing(spark):
    df = spark.createDataFrame([], "score double, y double")
    assert quality.smoothed_calibration_error(df, "score", "y", []).where("n > 0").collect() == []


def test_density_is_the_direct_sum(spark):
    rng = random.Random(5)
    values = {"a": [rng.betavariate(2, 6) for _ in range(2000)], "b": [rng.random() for _ in range(300)], "c": [0.4] * 5, "d": [0.1]}
    rows = [(g, x) for g, own in values.items() for x in own] + [("a", None), ("a", float("nan"))]
    got = {}
    for r in reports.kernel_density(spark.createDataFrame(rows, "g string, x double"), "x", ["g"]).collect():
        got.setdefault(r["g"], {})[r["point"]] = r
    # Groups without a spread have no density.
    assert set(got) == {"a", "b"}
    for g, told in got.items():
        x = np.array(values[g])
        width = 0.3 * x.std(ddof=1) * len(x) ** -0.2
        assert len(told) == reports.KERNEL_POINTS + 1
        for point, r in told.items():
            want = np.exp(-0.5 * ((point - x) / width) ** 2).sum() / (len(x) * width * math.sqrt(2 * math.pi))
            assert r["density"] == pytest.approx(want, abs=1e-3)
            assert (r["n"], r["bandwidth"]) == (len(x), pytest.approx(width))


def easter_by_tables(year):
    """The church's tables: golden number, epact, paschal full moon, Sunday after it."""
    golden = year % 19 + 1
    century = year // 100 + 1
    solar, lunar = 3 * century // 4 - 12, (8 * century + 5) // 25 - 5
    epact = (11 * golden + 20 + lunar - solar) % 30
    if epact == 24 or (epact == 25 and golden > 11):
        epact += 1
    full = 44 - epact
    if full < 21:
        full += 30
    sunday = 5 * year // 4 - solar - 10
    full += 7 - (sunday + full) % 7
    return dt.date(year, 3, 1) + dt.timedelta(days=full - 1)


def test_easter(spark):
    rows = spark.range(1583, 3000).select("id", easter_day(F.col("id").cast("int")).alias("day")).collect()
    assert all(r["day"] == easter_by_tables(r["id"]) for r in rows)
    days = {r["id"]: r["day"] for r in rows}
    assert (days[1961], days[2000], days[2024], days[2025], days[2038]) == (
        dt.date(1961, 4, 2), dt.date(2000, 4, 23), dt.date(2024, 3, 31), dt.date(2025, 4, 20), dt.date(2038, 4, 25),
    )


def test_calendar(spark):
    rows = outreach.feast_calendar(spark, 2012, 2025).collect()
    days = {(r["date"], r["name"]) for r in rows}
    assert (dt.date(2024, 5, 9), "Hemelvaartsdag") in days and (dt.date(2024, 5, 20), "Tweede pinksterdag") in days
    # The king's birthday moves off a Sunday; the queen's was another day.
    assert (dt.date(2014, 4, 26), "Koningsdag") in days and (dt.date(2025, 4, 26), "Koningsdag") in days
    assert (dt.date(2013, 4, 30), "Koninginnedag") in days and not any(d.year == 2014 and n == "Koninginnedag" for d, n in days)
    assert {d.year for d, n in days if n == "Bevrijdingsdag"} == {2015, 2020, 2025}
    visits = spark.createDataFrame([(dt.datetime(2024, 5, 9, 8),), (dt.datetime(2024, 5, 10),), (None,)], "start timestamp")
    flagged = outreach.flag_holiday(visits, "start", outreach.feast_calendar(spark, 2024, 2024)).collect()
    assert sorted(str(r["holiday"]) for r in flagged) == ["Hemelvaartsdag", "None", "None"]
