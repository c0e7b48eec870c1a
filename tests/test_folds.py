"""Stratified group folds against the plain greedy loop over all groups."""

import random

import numpy as np
import pytest

from rollcall.operators import modeling


def plain(groups, k):
    """groups: {group: (positives, rows)}. Returns {group: fold}."""
    totals = np.maximum(1, [sum(n - p for p, n in groups.values()), sum(p for p, _ in groups.values())])
    held, folds = [np.zeros(2) for _ in range(k)], {}
    key = lambda g: (-abs(groups[g][1] - 2 * groups[g][0]), *groups[g], g is not None, g or 0)
    for g in sorted(groups, key=key):
        p, n = groups[g]
        best = None
        for f in range(k):
            held[f] = held[f] + (n - p, p)
            spread = np.mean([np.std([h[c] / totals[c] for h in held]) for c in (0, 1)])
            held[f] = held[f] - (n - p, p)
            if best is None or spread < best[0] - 1e-9 or (abs(spread - best[0]) <= 1e-9 and held[f].sum() < best[1]):
                best = (spread, held[f].sum(), f)
        folds[g] = best[2]
        held[best[2]] = held[best[2]] + (n - p, p)
    return folds


@pytest.mark.parametrize("k,seed", [(5, 1), (3, 2), (2, 3)])
def test_equals_the_plain_loop(spark, k, seed):
    rng = random.Random(seed)
    rows = [(g, float(rng.random() < 0.25), "x") for g in range(300) for _ in range(rng.choice([1, 1, 2, 3, 5, 9]))]
    rows += [(1000, float(i % 4 == 0), "x") for i in range(400)] + [(None, None, "x"), (None, 1.0, "x")]
    df = spark.createDataFrame(rows, "pseudo_id long, label double, _of string")
    groups = {}
    for g, y, _ in rows:
        p, n = groups.get(g, (0, 0))
        groups[g] = (p + int(y or 0), n + 1)
    folded = modeling.stratified_folds(df.drop("_of"), "pseudo_id", k=k)
    got = {r["pseudo_id"]: r["fold"] for r in folded.select("pseudo_id", "fold").distinct().collect()}
    assert folded.count() == len(rows)
    assert got == plain(groups, k)


def test_many_equal_groups_take_one_turn():
    plan = modeling.greedy_fold_plan([(0, 1, 10**12), (1, 1, 10**11)], 5)
    assert sum(len(p) for p in plan) < 30
    assert [sum(n for _, n, _ in p) for p in plan] == [10**12, 10**11]


def test_empty_table(spark):
    df = spark.createDataFrame([], "pseudo_id long, label double")
    assert modeling.stratified_folds(df, "pseudo_id").collect() == []
