import random

import numpy as np
import pytest
from brute import near_components, shingle_set

from rollcall.llm.near_dups import _Search, components, deduplicated, near_duplicates, sketches
from rollcall.llm.queries import QUERIES


def sample(spark, path="/root/testdata/sf0.01"):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]


def test_query_equals_brute_force(spark):
    want = near_components(sample(spark), 4, 80)
    rows = QUERIES["op10_fast_sketch_dups"](spark, "/root/testdata/sf0.01").collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    assert len(rows) == len(want) and len({c for _, c in want.values()}) < len(want)


def test_a_large_group_of_near_copies_and_chains(spark):
    """Copies that each differ from the base, chains in which only neighbours are similar."""
    rng = random.Random(1)
    vocabulary = [f"w{k}" for k in range(500)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    rows = []
    for k in range(300):
        own = list(base)
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(120)] = f"x{k}"
        rows.append((k, " ".join(own)))
    step = [rng.choice(vocabulary) for _ in range(100)]
    for k in range(40):
        step[(k * 7) % 100] = f"c{k}"
        rows.append((1000 + k, " ".join(step)))
    rows += [(2000 + k, " ".join(rng.choice(vocabulary) for _ in range(80))) for k in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(df, 4, 80).collect()}
    assert got == near_components(rows, 4, 80)


def test_edge_rows(spark):
    text = " ".join(f"word{k}" for k in range(60))
    rows = [
        (1, text, "a", 7),
        (2, text.upper(), "b", 7),
        (2, text.upper(), "b", 7),
        (None, text, None, 7),
        (3, None, None, None),
        (4, "", "", None),
        (5, " \t\n", "", None),
        (6, "two words", "", None),
        (7, "Two  Words", "", None),
        (8, "x" * 300_000, "", None),
        (9, "long " * 100_000, "", None),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, node string, comp int")
    got = sorted(
        ((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df, 4, 80).collect()),
        key=lambda x: (x[0] is None, x),
    )
    assert got == [
        (1, 57, 1, True), (2, 57, 1, False), (2, 57, 1, False), (3, 0, 3, True), (4, 0, 4, True),
        (5, 0, 5, True), (6, 1, 6, True), (7, 1, 6, False), (8, 1, 8, True), (9, 1, 9, True),
        (None, 57, 1, False),
    ]
    left = deduplicated(df, 4, 80)
    assert left.columns == df.columns
    assert sorted(r.doc_id for r in left.collect()) == [1, 3, 4, 5, 6, 8, 9]
    empty = df.limit(0)
    assert near_duplicates(empty, 4, 80).count() == 0 and deduplicated(empty, 4, 80).count() == 0
    again = spark.createDataFrame([(2, text), (2, text), (2, text + " more")], "doc_id long, text string")
    assert deduplicated(again, 4, 80).count() == 1


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(0)
    errors = []
    for _ in range(60):
        a = np.unique(rng.integers(0, 2**63, 300, dtype=np.uint64))
        b = np.concatenate([a[:200], rng.integers(0, 2**63, 100, dtype=np.uint64)])
        s = sketches([a, b])
        assert (s != np.iinfo(np.uint64).max).all()
        errors.append((s[0] == s[1]).mean() - 200 / 400)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06
    small = sketches([np.array([5], np.uint64), np.array([5], np.uint64), np.array([6], np.uint64)])
    assert (small[0] == small[1]).all() and (small[0] != small[2]).all()


@pytest.mark.parametrize("n", [1, 50])
def test_components_of_a_path(spark, n):
    order = list(range(n + 1))
    random.Random(3).shuffle(order)
    rows = [(bytes([a]), bytes([b])) for a, b in zip(order, order[1:], strict=False)]
    found = components(spark.createDataFrame(rows, "a binary, b binary")).collect()
    assert len(found) == n + 1 and {bytes(r.comp) for r in found} == {b"\0"}


def test_shingle_sets_have_the_right_sizes():
    assert len(shingle_set("A b c d e", 4)) == 2 and len(shingle_set("a b", 4)) == 1


def test_open_pairs_meet_by_their_first_runs(spark):
    """Variants that lie below 0.8 to one another are not tried pair by pair within a bucket."""
    base = [f"w{k}" for k in range(200)]
    rows = [(k, " ".join(base[:165] + [f"x{k}y{j}" for j in range(35)])) for k in range(40)]
    # Two of them share their change.
    rows.append((40, rows[7][1] + " end"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    search = _Search(df, 4, 80)
    labels = search.classes.select("node", search.classes.node.alias("comp"))
    pairs = search.open_pairs(labels)
    joins = [x for x in pairs._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in x]
    assert joins and "run" in joins[0] and "bucket#" not in joins[0].split("Inner")[0]
    assert pairs.count() == 1
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(df, 4, 80).collect()}
    assert got == near_components(rows, 4, 80) and got[40][1] == 7


def test_similarities_that_the_bands_would_lose_are_refused(spark):
    df = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    with pytest.raises(ValueError, match="80"):
        near_duplicates(df, percent=50)
