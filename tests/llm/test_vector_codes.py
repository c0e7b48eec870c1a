"""Vector codes against a plain version that scans all entries in every round."""

import hashlib
import math
import random

import numpy as np
import pytest

from rollcall.llm import vector_codes

SCHEMA = "code string, vec_id long, embedding array<double>, label int, far string"


def plain(rows):
    """rows: (vec_id, embedding, label). Returns ([(vec_id, code, error, label_error)], sha)."""
    kept = [(i, [math.floor(1024 * x) for x in e], y) for i, e, y in rows if e and all(x is not None and math.isfinite(x) for x in e)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // 4
    parts = [[v[p * width : (p + 1) * width] for p in range(4)] for _, v, _ in kept]
    books = [[list(row[p]) for row in parts[:256]] for p in range(4)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(4):
        for p in range(4):
            members = {}
            for row in parts:
                members.setdefault(nearest(row[p], books[p])[1], []).append(row[p])
            for k, own in members.items():
                books[p][k] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    coded = []
    for (i, _, y), row in zip(kept, parts, strict=True):
        found = [nearest(row[p], books[p]) for p in range(4)]
        coded.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), y))
    sums = {}
    for _, _, error, y in coded:
        sums[y] = sums.get(y, 0) + error
    text = ",".join(str(c) for book in books for e in book for c in e)
    return [(i, c, e, sums[y]) for i, c, e, y in coded], hashlib.sha256(text.encode()).hexdigest()


def compare(spark, rows):
    table = spark.createDataFrame([("x", i, e, y, "z") for i, e, y in rows], SCHEMA)
    got = vector_codes.coded_vectors(table).collect()
    want, sha = plain(rows)
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted([tuple(r)[:4] for r in got], key=key) == sorted(want, key=key)
    assert {r["codebooks_sha256"] for r in got} == {sha}


def test_equals_plain_version(spark):
    rng = random.Random(3)
    rows = [(k, [rng.gauss(0, 0.3) for _ in range(8)], rng.choice([None, 1, 2])) for k in range(700)]
    rows += [(1000, None, 1), (1001, [], 1), (1002, [0.1] * 7 + [math.nan], 1), (1003, [None] + [0.1] * 7, 2), (1004, [math.inf] * 8, 2)]
    compare(spark, rows)


def test_ties_and_repeated_rows(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(300), [rng.choice([-1, 0, 1]) / 1024 for _ in range(8)], 1) for _ in range(600)]
    rows += [(7, [0.0] * 8, 5)] * 50 + [(None, [0.001] * 8, None)] * 2
    compare(spark, rows)


def test_few_rows_and_large_values(spark):
    compare(spark, [(1, [0.5] * 4, 1)])
    # Whole numbers beyond exact floating point, and beyond 64 bits for intermediate products.
    compare(spark, [(k, [float((k * 37) % 11) * 40_000, -float(k % 3) * 1e5, 3.0, 0.25 * k], k % 2) for k in range(300)])
    compare(spark, [(k, [float(k % 5) * 9e5] * 4, 0) for k in range(260)])


def test_other_lengths_are_dropped(spark):
    table = spark.createDataFrame(
        [("x", 1, [0.1] * 8, 1, "y"), ("x", 2, [0.1] * 4, 1, "y"), ("x", 3, [0.2] * 6, 1, "y"), ("x", 0, [0.3] * 7, 1, "y")], SCHEMA
    )
    assert [r["vec_id"] for r in vector_codes.coded_vectors(table).collect()] == [1]
    assert vector_codes.coded_vectors(table.where("vec_id > 9")).collect() == []


def test_huge_values_do_not_fail(spark):
    table = spark.createDataFrame([("x", k, [1e300, -1e12, 0.0, float(k)], 1, "y") for k in range(300)], SCHEMA)
    rows = vector_codes.coded_vectors(table).collect()
    assert len(rows) == 300 and all(r["error"] >= 0 for r in rows)


@pytest.mark.parametrize("top", [3, 1000, 1 << 27, 1 << 39])
def test_active_entries_give_the_full_scan(top):
    rng = np.random.default_rng(top)
    x, old = rng.integers(-top, top, (500, 3)), rng.integers(-top, top, (256, 3))
    new = old.copy()
    new[rng.choice(256, 40, replace=False)] += 1
    new[:20] = new[20:40]
    code, far = vector_codes.assign(x, old, np.ones(256, bool), None, None)
    moved = (old != new).any(axis=1)
    active = vector_codes.assign(x, new, moved, code, far)
    full = vector_codes.assign(x, new, np.ones(256, bool), None, None)
    assert (active[0] == full[0]).all() and (active[1] == full[1]).all()


def test_many_labels_are_joined_salted(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "BROADCAST_LABELS", 1)
    rng = random.Random(5)
    compare(spark, [(k, [rng.random() for _ in range(4)], rng.choice([None, 1, 2, 2, 2])) for k in range(300)])
