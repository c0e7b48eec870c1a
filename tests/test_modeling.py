"""Folds, splines, training and importances on a small table."""

import dataclasses

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.operators import boosting, modeling
from rollcall.plans import bases, models

NUMERIC = ("a", "b")


@pytest.fixture(scope="module")
def rows(spark):
    """The label follows ``a``; ``b`` is noise; one patient holds a third of the rows."""
    df = spark.range(600).select(
        F.col("id").alias("key"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40 + 1).alias("pseudo_id"),
        ((F.col("id") * 7919) % 600 / 600).alias("a"),
        ((F.col("id") * 104729) % 601 / 601).alias("b"),
        (F.col("id") % 12).cast("int").alias("hour"),
        F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("clinic"),
    )
    return df.withColumn("label", (F.col("a") > 0.6).cast("double")).cache()


def trees(**kwargs):
    return modeling.boosted_trees(NUMERIC, ("hour",), max_iter=2, step=0.3, **kwargs)


def test_group_folds(rows):
    folded = modeling.group_folds(rows, "pseudo_id", k=5)
    assert folded.count() == 600
    per_patient = folded.groupBy("pseudo_id").agg(F.countDistinct("fold").alias("n"))
    assert per_patient.where("n <> 1").isEmpty()
    sizes = [
        r["count"]
        for r in folded.where("pseudo_id > 0").select("pseudo_id", "fold").distinct().groupBy("fold").count().collect()
    ]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_grid_picks_by_auc_and_scores(rows):
    folded = modeling.group_folds(rows, "pseudo_id", k=2)
    result = modeling.train_grid(folded, (1, 2), (0.3,), k=2, pipeline=trees())
    assert len(result.precision) == len(result.recall) == 2
    assert [p["maxIter"] for p in result.params] == [1, 2]
    assert min(result.auc) > 0.9
    scored = modeling.score(result.model, rows)
    assert scored.where("prediction < 0 or prediction > 1").isEmpty()
    assert modeling.roc_auc(scored, "prediction", "label").first().auc > 0.95


def test_fold_metrics(rows):
    folded = modeling.group_folds(rows, "pseudo_id", k=2)
    out = modeling.fold_metrics(folded, trees(), k=2).collect()
    assert {r.fold for r in out} == {0, 1}
    assert all(r.auc > 0.9 and r.precision > 0.5 and r.recall > 0.5 for r in out)


def test_spline_basis(spark):
    spots = [i / 10 for i in range(41)]
    df = spark.createDataFrame([(s,) for s in spots], "spot double")
    got = np.array([r[0] for r in df.select(modeling.spline_basis(F.col("spot"))).collect()])
    assert got.shape == (41, 7)
    assert np.allclose(got.sum(axis=1), 1) and (got >= 0).all()

    def bump(t):  # the cubic B-spline on 0..4 by its recursive definition
        def base(k, i, x):
            if k == 0:
                return float(i <= x < i + 1)
            return (x - i) / k * base(k - 1, i, x) + (i + k + 1 - x) / k * base(k - 1, i + 1, x)

        return base(3, 0, t)

    want = np.array([[bump(s - j + 3) for j in range(7)] for s in spots[:-1]])
    assert np.allclose(got[:-1], want)


def test_logistic_baseline(rows):
    model = modeling.logistic_baseline(rows, NUMERIC, ("hour",), max_iter=20)
    scored = modeling.score(model, rows)
    assert modeling.roc_auc(scored, "prediction", "label").first().auc > 0.95


def test_groups(rows):
    per_group = modeling.leave_one_group_out(rows, "clinic", trees().fit)
    assert {r.clinic for r in per_group.collect()} == {"x", "y"}
    assert modeling.auc_mean_std(per_group).first().groups == 2
    own = modeling.per_group_models(rows, "clinic", trees().fit)
    assert own.count() == 600
    assert len(modeling.group_values(rows.sparkSession.range(1500), "id")) == 1500


def test_importances(rows):
    model = trees().fit(rows)
    out = modeling.permutation_importance(model, rows, [*NUMERIC, "hour"], "key", repeats=2)
    by_name = {r.feature: r.importance for r in out.collect()}
    assert by_name["a"] > 0.2
    assert abs(by_name["b"]) < 0.05
    impurity = {r.feature: r.importance for r in modeling.tree_importance(model, rows).collect()}
    assert max(impurity, key=impurity.get) == "a"
    assert set(impurity) == {"a", "b", "hour_idx"}


def test_held_out_evaluation(rows):
    train = modeling.group_folds(rows.where("key < 450"), "pseudo_id", k=2)
    test = rows.where("key >= 450")
    out = modeling.held_out_evaluation(train, test, iterations=(1, 2), rates=(0.3,), k=2, pipeline=trees()).collect()
    assert sum(r.n for r in out) == test.count() == 150
    assert {(r.step, r.test_auc) for r in out} == {(0.3, out[0].test_auc)} and out[0].test_auc > 0.9
    assert {r.max_iter for r in out} < {1, 2}
    positives = test.where("label = 1").count()
    assert sum(r.prob_true * r.n for r in out) == pytest.approx(positives)


def test_queries_ask_for_production_rounds_and_score_the_planned(spark, monkeypatch):
    """The rounds that the queries ask for are recorded, and one is run."""
    real, asked = boosting.fit_many, []

    def recorded(df, specs, *args, **kwargs):
        asked.append([s.rounds for s in specs])
        return real(df, [dataclasses.replace(s, rounds=1) for s in specs], *args, **kwargs)

    monkeypatch.setattr(boosting, "fit_many", recorded)
    monkeypatch.setattr(modeling, "fit_many", recorded)
    sf = "/root/testdata/sf0.001"
    scored = {r[models.KEY] for r in models.score(spark, sf).collect()}
    planned = bases.features(spark, sf, ["status"]).where("status = 'planned'")
    # The planned ones are the newest, and fewer than the test share.
    assert scored == {r.APP_ID for r in planned.collect()} and scored
    models.tree_importance(spark, sf)
    models.per_clinic_models(spark, sf)
    models.leave_one_group_out(spark, sf)
    models.cross_validated_metrics(spark, sf)
    assert {n for rounds in asked for n in rounds} == {300}
    asked.clear()
    models.train_grid(spark, sf)
    assert [len(a) for a in asked] == [15] and set(asked[0]) == {max(modeling.ITERATIONS)}
