"""Ranks, quantiles, splits, bins and quality figures against brute force."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.operators import binning, ordering, quality
from rollcall.operators.reports import histogram


@pytest.fixture(scope="module")
def scores(spark):
    """Many ties; one group holds most rows."""
    rng = random.Random(5)
    rows = [
        (i, rng.choice(["big"] * 8 + ["small", None]), rng.randrange(40) / 40, rng.randrange(2))
        for i in range(900)
    ]
    return rows, spark.createDataFrame(rows, "id int, g string, s double, y int")


def test_global_rank(scores):
    rows, df = scores
    got = ordering.ranked(df, [F.col("s").desc(), F.col("id")]).orderBy("rank").collect()
    want = sorted(rows, key=lambda r: (-r[2], r[0]))
    assert [(r.id, r["rank"]) for r in got] == [(w[0], i) for i, w in enumerate(want)]


def test_rank_within_groups_with_a_missing_group(scores):
    rows, df = scores
    got = {r.id: r["rank"] for r in ordering.ranked(df, [F.col("s"), F.col("id")], by=["g"]).collect()}
    assert len(got) == len(rows)
    for group in ("big", "small", None):
        mine = sorted((r[2], r[0]) for r in rows if r[1] == group)
        assert [got[i] for _, i in mine] == list(range(len(mine)))


def test_running_totals_within_groups(scores):
    rows, df = scores
    out = ordering.running_totals(df, [F.col("s"), F.col("id")], {"total": "y"}, ["g"])
    got = {r.id: r.total for r in out.collect()}
    for group in ("big", "small", None):
        total = 0
        for _, i, y in sorted((r[2], r[0], r[3]) for r in rows if r[1] == group):
            total += y
            assert got[i] == total


@pytest.mark.parametrize("n", [1, 2, 7, 900])
def test_quantiles_interpolate(scores, n):
    rows, df = scores
    probs = [0, 0.1, 0.25, 0.5, 0.9, 1]
    part = df.where(F.col("id") < n)
    got = ordering.exact_quantiles(part, "s", probs).first().edges
    assert np.allclose(got, np.quantile([r[2] for r in rows[:n]], probs))


def test_quantiles_per_group(scores):
    rows, df = scores
    got = {r.g: r.edges for r in ordering.exact_quantiles(df, "s", [0.1, 0.5], ["g"]).collect()}
    for group in ("big", "small", None):
        assert np.allclose(got[group], np.quantile([r[2] for r in rows if r[1] == group], [0.1, 0.5]))


def test_temporal_split_counts_up(spark):
    df = spark.createDataFrame([(i, i // 3) for i in range(11)], "id int, t int")
    test = ordering.temporal_split(df, ["t", "id"]).where("is_test")
    assert sorted(r.id for r in test.collect()) == [8, 9, 10]


def test_time_folds(spark):
    df = spark.createDataFrame([(i,) for i in range(25)], "t int")
    rows = ordering.time_folds(df, ["t"], 3).orderBy("t").collect()
    assert [r.fold for r in rows] == [0] * 7 + [1] * 6 + [2] * 6 + [3] * 6
    with pytest.raises(ValueError):
        ordering.time_folds(df, ["t"], 30)


def test_qcut_is_right_closed_and_includes_the_lowest(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 9)], "x double")
    rows = binning.qcut(df, "x", 4).orderBy("x").collect()
    assert [r.bin for r in rows] == [0, 0, 1, 1, 2, 2, 3, 3]
    with pytest.raises(ValueError):
        binning.qcut(spark.createDataFrame([(1.0,), (1.0,)], "x double"), "x", 2)


def test_fixed_edges(spark):
    edges = spark.createDataFrame([("A", [0.003, 0.03, 0.053, 0.077, 0.69])], "a string, edges array<double>")
    values = [0.0, 0.03, 0.031, 0.69, 1.0, None]
    df = spark.createDataFrame([(i, "A", v) for i, v in enumerate(values)], "i int, a string, prediction double")
    rows = binning.apply_bins(df, edges, "a").orderBy("i").collect()
    assert [r.score_bin for r in rows] == [None, 0, 1, 3, 4, None]


def test_an_agenda_without_edges_is_an_error(spark):
    edges = spark.createDataFrame([("A", [0.0, 1.0])], "a string, edges array<double>")
    df = spark.createDataFrame([("B", 0.5)], "a string, prediction double")
    with pytest.raises(Exception, match="no bin edges for B"):
        binning.apply_bins(df, edges, "a").collect()


def test_top_row_ties(spark):
    df = spark.createDataFrame(
        [("p", 3, 0.9, "x"), ("p", 1, 0.9, "y"), ("p", 2, 0.1, "z")],
        "pseudo_id string, APP_ID int, prediction double, v string",
    )
    assert [r.v for r in binning.top_row(df, "pseudo_id", "prediction", ["APP_ID"]).collect()] == ["y"]


def test_auc_with_ties(scores):
    rows, df = scores
    up = [r[2] for r in rows if r[3]]
    down = [r[2] for r in rows if not r[3]]
    want = sum((a > b) + (a == b) / 2 for a in up for b in down) / (len(up) * len(down))
    assert quality.roc_auc(df, "s", "y").first().auc == pytest.approx(want)


def test_auc_of_one_class_is_missing(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "s double, y int")
    assert quality.roc_auc(df, "s", "y").first().auc is None


def test_roc_points_keep_the_area(scores):
    _, df = scores
    few = quality.roc_points(df, "s", "y").orderBy("fpr", "tpr").collect()
    every = quality.roc_points(df, "s", "y", drop_intermediate=False).orderBy("fpr", "tpr").collect()

    def area(points):
        return sum(
            (b.fpr - a.fpr) * (a.tpr + b.tpr) / 2 for a, b in zip(points, points[1:])
        )

    assert len(few) <= len(every) == 41
    assert area(few) == pytest.approx(area(every))
    assert area(every) == pytest.approx(quality.roc_auc(df, "s", "y").first().auc)


def test_roc_keeps_the_first_point(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 1), (0.7, 0), (0.6, 1)], "s double, y int")
    points = sorted((r.threshold, r.fpr, round(r.tpr, 3)) for r in quality.roc_points(df, "s", "y").collect())
    assert (0.9, 0.0, 0.333) in points and points[-1] == (float("inf"), 0.0, 0.0)


def test_calibration_error_of_perfect_scores_is_zero(spark):
    df = spark.createDataFrame([(1.0, 1), (0.0, 0)], "s double, y int")
    assert quality.calibration_error(df, "s", "y").first().ece == 0


def test_daily_top_k(spark):
    monday, saturday = dt.datetime(2024, 1, 1, 9), dt.datetime(2024, 1, 6, 9)
    tuesday = dt.datetime(2024, 1, 2, 9)
    rows = [
        (1, monday, 0.9, 1), (2, monday, 0.8, 0), (3, monday, 0.1, 1),
        (4, tuesday, 0.5, 0),
        (5, saturday, 0.9, 1),
    ]
    df = spark.createDataFrame(rows, "id int, t timestamp, s double, y int")
    got = {r.k: r for r in quality.daily_top_k(df, "t", "s", "y", "id", [1, 2]).collect()}
    assert (got[1].mean_precision, got[1].mean_recall, got[1].days) == (0.5, 0.25, 2)
    assert (got[2].mean_precision, got[2].mean_recall) == (0.25, 0.25)
    assert got[1].std_precision == 0.5


def test_histogram_last_bin_is_closed(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,), (1.5,), (None,)], "x double")
    got = {r.bucket: r.n for r in histogram(df, "x", 0.0, 1.0, 2).collect()}
    assert got == {0: 1, 1: 2}
    assert {r.bucket: r.n for r in histogram(df, "x", None, None, 3).collect()} == {0: 1, 1: 1, 2: 2}


def test_bins_use_every_edge(spark):
    edges = spark.createDataFrame([("A", [i / 2000 for i in range(2001)])], "hoofdagenda string, edges array<double>")
    df = spark.createDataFrame([("A", 0.75), ("A", 0.95), ("A", 1.0), ("A", 0.0)], "hoofdagenda string, prediction double")
    bins = {r.prediction: r.score_bin for r in binning.apply_bins(df, edges, "hoofdagenda", "prediction").collect()}
    assert bins == {0.75: 1499, 0.95: 1899, 1.0: 1999, 0.0: None}


def test_spaced_quantiles_are_the_exact_ones_in_a_plan_that_does_not_grow_with_them(spark):
    rng = random.Random(5)
    rows = [("a", float(rng.randint(0, 40))) for _ in range(900)] + [("b", rng.random()) for _ in range(700)]
    rows += [("c", 1.5), ("d", 2.0), ("d", 4.0), ("e", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    counts = df.groupBy("g", "x").agg(F.count(F.lit(1)).alias("n"))
    for parts in (2, 7, 20):
        found = ordering.spaced_quantiles(counts, "x", "n", parts, ["g"])
        wanted = ordering.exact_quantiles(df, "x", [k / parts for k in range(1, parts)], by=["g"])
        assert {r["g"]: r["edges"] for r in found.collect()} == {r["g"]: r["edges"] for r in wanted.collect()}
    plan = found._jdf.queryExecution().analyzed().toString()
    assert plan.count("max(") < 10
