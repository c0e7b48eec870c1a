"""Boosting of many models against a plain version with whole numbers, and both ways of fitting against each other."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.operators import boosting, modeling, ordering

UNIT = 2**30


def plain(rows, labels, bins, n_numeric, step, rounds):
    """Scores of the training rows: every split found by trying each bin or category prefix over lists of rows."""
    n, missing = len(rows), bins - 1
    positives = sum(labels)
    raw = [math.log(positives / (n - positives))] * n
    for _ in range(rounds):
        # The same exponential, then whole numbers only.
        g, h = (list(map(int, x)) for x in boosting.gradients(np.array(raw), np.array(labels, float)))
        total = lambda own, x: sum(x[i] for i in own)

        def best(own):
            if len(own) < 2 * boosting.MIN_LEAF:
                return None
            sg, sh = total(own, g), total(own, h)
            found = None
            for f in range(len(rows[0])):
                options = []
                if f < n_numeric:
                    for with_missing in (False, True):
                        for k in range(missing):
                            options.append(set(range(k + 1)) | ({missing} if with_missing else set()))
                else:
                    cells = {}
                    for i in own:
                        cells.setdefault(rows[i][f], []).append(i)
                    ok = [c for c, m in sorted(cells.items()) if total(m, h) * (len(own) / sh) >= boosting.CATEGORY_SUPPORT]
                    ok.sort(key=lambda c: total(cells[c], g) / (total(cells[c], h) + boosting.CATEGORY_SUPPORT * UNIT))
                    options = [set(ok[: k + 1]) for k in range(len(ok))]
                for goes in options:
                    left = [i for i in own if rows[i][f] in goes]
                    right = [i for i in own if rows[i][f] not in goes]
                    if min(len(left), len(right)) < boosting.MIN_LEAF:
                        continue
                    a, c = (total(left, g), total(left, h)), (total(right, g), total(right, h))
                    if min(a[1], c[1]) < boosting.MIN_HESSIAN * UNIT:
                        continue
                    worth = float(a[0]) * float(a[0]) / float(a[1]) + float(c[0]) * float(c[0]) / float(c[1])
                    if found is None or worth > found[0]:
                        found = (worth, left, right)
            if found is None:
                return None
            gain = found[0] - float(sg) ** 2 / float(sh)
            return (gain, found[1], found[2]) if gain > 0 else None

        leaves = [list(range(n))]
        splits = [best(leaves[0])]
        while len(leaves) < boosting.LEAVES and any(splits):
            k = max((k for k in range(len(splits)) if splits[k]), key=lambda k: (splits[k][0], -k))
            _, left, right = splits[k]
            leaves[k : k + 1], splits[k : k + 1] = [left, right], [best(left), best(right)]
        for own in leaves:
            value = -step * total(own, g) / total(own, h)
            for i in own:
                raw[i] += value
    return [1 / (1 + math.exp(-x)) for x in raw]


def table(spark, n=400, seed=3):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        a = rng.choice([None, 0.5, 1.5, 2.5, 4.0])
        c = rng.choice(["x", "y", "z", "w", None])
        chance = 0.2 + 0.4 * (a is None) + 0.3 * (c in ("x", "w")) - 0.1 * (a == 4.0)
        rows.append((k, a, rng.randint(0, 6), c, float(rng.random() < chance), rng.choice(["p", "p", "q"])))
    return rows, spark.createDataFrame(rows, "key long, a double, b int, c string, label double, grp string")


def specs(rounds=4):
    return [
        boosting.Spec("all", F.lit(True), 0.3, rounds),
        boosting.Spec("p", F.col("grp") == "p", 0.1, rounds - 1),
        boosting.Spec("not p", F.col("grp") != "p", 0.3, rounds),
        boosting.Spec("none", F.col("grp") == "nobody", 0.3, rounds),
    ]


def scores(models, df, name):
    rows = boosting.score_many(models, df, ["key"], [(name, None, F.lit(True))]).collect()
    return {r["key"]: r["prediction"] for r in rows}


def test_equals_plain_version(spark):
    rows, df = table(spark)
    models = boosting.fit_many(df, specs(), ("a", "b"), ("c",))
    width = models.bins.width
    place = {"a": {None: width - 1, 0.5: 0, 1.5: 1, 2.5: 2, 4.0: 3}, "c": {None: width - 1, "w": 0, "x": 1, "y": 2, "z": 3}}
    for name, chosen, step, rounds in (("all", "pq", 0.3, 4), ("p", "p", 0.1, 3), ("not p", "q", 0.3, 4)):
        own = [r for r in rows if r[5] in chosen]
        binned = [(place["a"][r[1]], r[2], place["c"][r[3]]) for r in own]
        want = plain(binned, [int(r[4]) for r in own], width, 2, step, rounds)
        got = scores(models, df, name)
        assert [got[r[0]] for r in own] == pytest.approx(want, abs=1e-12)
    assert set(scores(models, df, "none").values()) == {0.5}


@pytest.mark.parametrize("limit", [0, 60, 150])
def test_passes_and_tasks_fit_the_same_models(spark, limit):
    _, df = table(spark, 600, seed=limit)
    df = df.withColumn("b", F.pmod(F.xxhash64("key"), F.lit(40)).cast("int"))
    in_task = boosting.fit_many(df, specs(), ("a", "b"), ("c",))
    in_passes = boosting.fit_many(df.repartition(3), specs(), ("a", "b"), ("c",), in_task_rows=limit)
    for name in in_task.forests:
        assert scores(in_task, df, name) == scores(in_passes, df, name)


def test_scores_after_fewer_rounds_are_those_of_a_shorter_run(spark):
    _, df = table(spark)
    long = boosting.fit_many(df, specs(6)[:1], ("a", "b"), ("c",))
    short = boosting.fit_many(df, specs(2)[:1], ("a", "b"), ("c",))
    rows = boosting.score_many(long, df, ["key"], [("all", [2, 6], F.col("key") < 50)]).collect()
    assert len(rows) == 100
    want = scores(short, df, "all")
    assert all(r["prediction"] == want[r["key"]] for r in rows if r["rounds"] == 2)


def test_checkpoints_and_many_values(spark, monkeypatch):
    monkeypatch.setattr(boosting, "CHECKPOINT_ROUNDS", 2)
    df = spark.range(3000).selectExpr("id AS key", "sin(id) AS a", "id % 7 AS b", "'k' AS c", "CAST(sin(id) > 0.3 AS double) AS label")
    spec = [boosting.Spec("m", F.lit(True), 0.3, 5)]
    models = boosting.fit_many(df, spec, ("a", "b"), ("c",), in_task_rows=500)
    assert len(models.bins.numeric["a"]) <= boosting.MAX_BINS
    got = scores(models, df, "m")
    assert np.mean([(got[k] > 0.5) == (math.sin(k) > 0.3) for k in range(3000)]) > 0.99
    gains = dict(boosting.split_gains(models, "m"))
    assert gains["a"] > 0.95 and sum(gains.values()) == pytest.approx(1)


def test_empty_and_constant_tables(spark):
    _, df = table(spark, 60)
    models = boosting.fit_many(df.withColumn("label", F.lit(1.0)), specs()[:1], ("a", "b"), ("c",))
    assert all(p > 0.9 for p in scores(models, df, "all").values())
    models = boosting.fit_many(df.limit(0), specs()[:1], ("a", "b"), ("c",))
    assert set(scores(models, df, "all").values()) == {0.5}
    unseen = df.withColumn("c", F.lit("new")).withColumn("a", F.lit(float("nan")))
    models = boosting.fit_many(df, specs()[:1], ("a", "b"), ("c",))
    assert len(scores(models, unseen, "all")) == 60


def test_grid_and_choice(spark):
    _, df = table(spark, 500)
    folded = df.withColumn("fold", (F.col("key") % 3).cast("int"))
    inputs = {"numeric": ("a", "b"), "categorical": ("c",), "k": 3}
    scored = modeling.candidate_scores(folded, (2, 4), (0.1, 0.3), **inputs)
    assert scored.groupBy("step", "max_iter").count().where("count <> 500").isEmpty() and scored.count() == 2000
    metrics = modeling.candidate_metrics(scored).collect()
    assert len(metrics) == 4 and all(0.5 < r["auc"] < 1 for r in metrics)
    out = modeling.evaluated_choice(folded.where("key < 400"), df.where("key >= 400"), (2, 4), (0.1, 0.3), **inputs).collect()
    assert sum(r["n"] for r in out) == 100 and len({(r["max_iter"], r["step"], r["test_auc"]) for r in out}) == 1


def test_group_models(spark):
    _, df = table(spark, 500)
    for others in (False, True):
        out = modeling.group_models(df, "grp", ["key", "grp"], others, ("a", "b"), ("c",), rounds=3)
        assert sorted(r["key"] for r in out.collect()) == list(range(500))


@pytest.mark.parametrize("start", [1, 2, 3, 4, 5, 16, 17, 100, 1000, 4999, 5000])
def test_permutations_are_bijections(spark, start):
    n = start
    ranks = spark.range(n).select(
        "id", *[ordering.permuted(F.col("id"), n, f"key {k}").alias(f"p{k}") for k in range(2)]
    ).collect()
    for k in range(2):
        assert sorted(r[f"p{k}"] for r in ranks) == list(range(n))
    if n >= 100:
        assert [r["p0"] for r in ranks] != [r["p1"] for r in ranks]
        assert abs(np.corrcoef([r["id"] for r in ranks], [r["p0"] for r in ranks])[0, 1]) < 0.3


def test_exchange_importance(spark):
    _, df = table(spark, 800)
    models = boosting.fit_many(df, [boosting.Spec("m", F.lit(True), 0.2, 10)], ("a", "b"), ("c",))
    out = {r["feature"]: r for r in modeling.exchange_importance(models, df, "key", "m", repeats=4).collect()}
    assert set(out) == {"a", "b", "c"}
    assert out["a"]["importance"] > 0.02 and out["c"]["importance"] > 0.02 and out["b"]["importance"] < 0.08
    assert all(r["std"] > 0 for r in out.values())


def test_joint_counts_and_row_index_are_those_of_plain_loops():
    rng = np.random.default_rng(4)
    bins = np.stack([rng.integers(0, k, 3000) for k in (3, 5, 40, 2, 200, 1)], axis=1).astype(np.uint8)
    bins[rng.random(bins.shape) < 0.1] = 219
    g, h = rng.integers(-UNIT, UNIT, 3000).astype(float), rng.integers(0, UNIT // 4, 3000).astype(float)
    layout = boosting.Layout(bins, 220)
    assert len(layout.cells) < bins.shape[1]
    for rows in (None, np.sort(rng.choice(3000, 1500, replace=False)), np.arange(7)):
        at = slice(None) if rows is None else rows
        assert (layout.histogram(rows, g, h) == boosting.histogram(bins[at], g[at], h[at], 220)).all()
    wanted = rng.random(220) < 0.3
    for f in range(bins.shape[1]):
        assert sorted(layout.having(f, wanted)) == np.flatnonzero(wanted[bins[:, f]]).tolist()
        assert layout.held(f, wanted) == wanted[bins[:, f]].sum()


def test_a_model_larger_than_a_node_of_a_pass_is_still_fitted_by_one_task(spark, monkeypatch):
    rows, df = table(spark)
    monkeypatch.setattr(boosting, "IN_TASK_ROWS", len(rows) // 4)
    monkeypatch.setattr(boosting, "_fit_in_passes", None)
    models = boosting.fit_many(df, [boosting.Spec("m", F.lit(True), rounds=2)], ["a", "b"], ["c"])
    assert len(models.forests["m"].trees) == 2


def test_rows_end_where_their_paths_do():
    rng = np.random.default_rng(6)
    bins = rng.integers(0, 30, (2000, 5)).astype(np.uint8)
    label = (rng.random(2000) < 0.2 + 0.02 * bins[:, 1]).astype(float)
    forest = boosting.boost("m", bins, label, 0.1, 4, 31, 4)
    other = rng.integers(0, 31, (500, 5)).astype(np.uint8)
    score, after = np.full(500, forest.start), []
    for tree in forest.trees:
        assert (boosting.Walker(tree).values(other.T) == tree.value[tree.leaves_of(other)]).all()
        score = score + tree.value[tree.leaves_of(other)]
        after.append(score)
    assert all((a == b).all() for a, b in zip(forest.raw(other, [1, 4]), (after[0], after[3]), strict=True))
    stump = boosting.boost("m", bins[:10], label[:10], 0.1, 2, 31, 4)
    assert (stump.raw(other, [2])[0] == stump.raw(other[:1], [2])[0][0]).all()


def trees_of(models, name):
    return [(t.feature.tolist(), t.left_bins.tolist(), t.child.tolist(), t.value.tolist(), t.gain.tolist()) for t in models.forests[name].trees]


def test_java_and_numpy_fit_the_same_trees(spark, monkeypatch):
    _, df = table(spark, 3000, seed=8)
    df = df.withColumn("b", F.pmod(F.xxhash64("key"), F.lit(300)).cast("int")).withColumn(
        "d", F.when(F.col("key") % 7 != 0, F.sin("key"))
    )
    inputs = [*specs(12), boosting.Spec("few", F.col("key") < 25, 0.3, 3)], ("a", "b", "d"), ("c",)
    in_java = boosting.fit_many(df.repartition(5), *inputs)
    monkeypatch.setattr(boosting.kernel, "register", lambda spark: False)
    monkeypatch.setattr(boosting, "_fit_in_java", None)
    in_numpy = boosting.fit_many(df, *inputs)
    assert in_java.bins == in_numpy.bins
    for name, forest in in_java.forests.items():
        assert forest.start == in_numpy.forests[name].start
        assert trees_of(in_java, name) == trees_of(in_numpy, name)
    assert max(len(t.feature) for t in in_java.forests["all"].trees) == 2 * boosting.LEAVES - 1


def test_java_fits_models_beyond_the_rows_of_numpy_without_passes(spark, monkeypatch):
    rows, df = table(spark)
    monkeypatch.setattr(boosting, "MODEL_ROWS", len(rows) // 4)
    monkeypatch.setattr(boosting, "_fit_in_passes", None)
    models = boosting.fit_many(df, [boosting.Spec("m", F.lit(True), rounds=2)], ["a", "b"], ["c"])
    assert len(models.forests["m"].trees) == 2


def test_rows_without_label_are_not_learned_from(spark):
    _, df = table(spark, 60)
    df = df.withColumn("label", F.when(F.col("key") > 0, F.col("label")))
    with pytest.raises(Exception, match="has no label"):
        boosting.fit_many(df, specs()[:1], ("a", "b"), ("c",))
    learned = boosting.fit_many(df, [boosting.Spec("m", F.col("key") > 0, 0.3, 2)], ("a", "b"), ("c",))
    assert len(scores(learned, df, "m")) == 60


def test_exponential_is_that_of_the_library():
    x = np.concatenate([np.linspace(-40, 40, 10001), [-750.0, 750.0, 0.0, 1e-18]])
    assert boosting.exponential(x) == pytest.approx(np.exp(np.clip(x, -700, 700)), rel=1e-15)


def test_many_permutations_are_those_of_the_expression(spark):
    for n in (1, 2, 17, 4999):
        found = ordering.Permutations(n, ["a 1", "b"])
        rows = spark.range(n).orderBy("id").select(*[ordering.permuted(F.col("id"), n, k).alias(k) for k in ("a 1", "b")]).collect()
        for k in range(2):
            assert found.receivers(k, np.arange(n)).tolist() == [r[k] for r in rows]


def test_exchanged_scores_are_those_of_whole_rows(spark, monkeypatch):
    rows, df = table(spark, 500)
    models = boosting.fit_many(df, [boosting.Spec("m", F.lit(True), 0.2, 10)], ("a", "b"), ("c",))
    forest, width = models.forests["m"], models.bins.width
    rng = np.random.default_rng(2)
    columns, given = rng.integers(0, width, (3, 80)).astype(np.uint8), rng.integers(0, width, (3, 4, 80)).astype(np.uint8)
    plain_scores, exchanged = forest.raw_exchanged(columns, given)
    assert (plain_scores == forest.raw(columns.T, [10])[0]).all()
    for f in range(3):
        for repeat in range(4):
            other = columns.copy()
            other[f] = given[f, repeat]
            assert (exchanged[f, repeat] == forest.raw(other.T, [10])[0]).all()

    # Whole tables, row by row, against blocks of a few rows.
    df = df.withColumn("label", F.when(F.col("key") % 50 != 0, F.col("label")))
    want = {}
    whole = {r["key"]: r for r in df.collect()}
    known = {k: r["label"] for k, r in whole.items() if r["label"] is not None}

    def accuracy(frame):
        got = scores(models, frame, "m")
        return sum((got[k] > 0.5) == (known[k] == 1) for k in known) / len(known)

    for f in models.bins.names:
        losses = []
        for repeat in range(2):
            to = ordering.Permutations(500, [f"5 {repeat} {f}"]).receivers(0, np.arange(500))
            taken = {int(to[k]): whole[k][f] for k in range(500)}
            mixed = [tuple((r | {f: taken[k]}).values()) for k, r in ((k, r.asDict()) for k, r in whole.items())]
            losses.append(accuracy(df) - accuracy(spark.createDataFrame(mixed, df.schema)))
        want[f] = (np.mean(losses), np.std(losses))
    # Before, values went to their receivers by a join of whole rows.
    monkeypatch.setattr(modeling, "EXCHANGE_ROWS", (64, 128))
    monkeypatch.setattr(modeling, "EXCHANGE_BLOCKS", 4)
    out = modeling.exchange_importance(models, df, "key", "m", repeats=2, seed=5)
    got = {r["feature"]: (r["importance"], r["std"]) for r in out.collect()}
    assert set(got) == set(want) and all(got[f] == pytest.approx(want[f], abs=1e-12) for f in want)
    assert modeling.exchange_importance(models, df.limit(0), "key", "m").isEmpty()
