import random

import numpy as np
import pyarrow as pa
from brute import UPPER, words

from rollcall.llm import decontaminate
from rollcall.llm.decontaminate import BenchmarkIndex, best_stretch, clean_documents, find_leaks
from rollcall.llm.queries import QUERIES


def edit_distance_to_best_stretch(item, text):
    row = [0] * (len(text) + 1)
    for k, word in enumerate(item):
        new = [k + 1]
        for j, other in enumerate(text):
            new.append(min(new[-1] + 1, row[j + 1] + 1, row[j] + (word != other)))
        row = new
    return min(row)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    items = {r.item_id: words(r.text.translate(UPPER)) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    docs = {r.doc_id: words((r.text or "").translate(UPPER)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want = set()
    for d, text in docs.items():
        own = set(text)
        for i, item in items.items():
            limit = int(0.2 * len(item))
            # A stretch within the limit keeps all but `limit` of the item's words.
            if sum(w not in own for w in item) <= limit and edit_distance_to_best_stretch(item, text) <= limit:
                want.add((d, i))
    got = QUERIES["op5_cgk_decontamination"](spark, sf).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want) > 0


def test_recall_at_the_edit_limit():
    rng = random.Random(2)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randint(8, 60))) for _ in range(100)]
    index = BenchmarkIndex(pa.table({"item_id": range(100), "text": texts}))
    found = 0
    for item in index.pieces:
        changed = list(item)
        for _ in range(int(0.2 * len(item))):
            at, kind = rng.randrange(len(changed)), rng.randrange(3)
            new = np.uint64(rng.getrandbits(60))
            if kind == 0:
                changed[at] = new
            elif kind == 1 and len(changed) > 1:
                del changed[at]
            else:
                changed.insert(at, new)
        noise = [np.uint64(rng.getrandbits(60)) for _ in range(80)]
        text = np.array(noise[:40] + changed + noise[40:], np.uint64)
        found += any(True for _ in index.search(text, np.array([0, len(text)])))
    assert found >= 99


def test_best_stretch_is_exact():
    rng = random.Random(5)
    for _ in range(200):
        item = [rng.randrange(4) for _ in range(rng.randint(1, 12))]
        text = [rng.randrange(4) for _ in range(rng.randint(0, 25))]
        edits, begin, size = best_stretch(np.array(item, np.uint64), np.array(text, np.uint64))
        assert edits == edit_distance_to_best_stretch(item, text)
        assert 0 <= begin <= begin + size <= len(text)


def test_edge_rows_and_blocks(spark, monkeypatch):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    other = " ".join(f"n{k}" for k in range(300))
    benchmark = spark.createDataFrame(
        [(1, item), (2, None), (3, ""), (4, "too short"), (5, other), (6, item), (None, "p q r s t u")],
        "item_id long, text string",
    )
    docs = spark.createDataFrame(
        [
            (1, f"some words before {item.upper()}%%% and after", "x", 1),
            (1, f"some words before {item.upper()}%%% and after", "x", 1),
            (2, None, None, None),
            (3, "", "", 0),
            (4, "clean text of the and to " * 50_000, "", 0),
            (5, "front " + " ".join(other.split()[40:295]) + " back", "", 0),
            (6, "front " + " ".join(other.split()[90:260]) + " back", "", 0),
            (None, item.replace("delta", "DELTA! again"), "", 0),
            (7, "too short", "", 0),
            (8, item, "", 0),
        ],
        "doc_id long, text string, item_id string, edits int",
    )
    want = [(None, 1), (None, 6), (1, 1), (1, 1), (1, 6), (1, 6), (5, 5), (7, 4), (8, 1), (8, 6)]
    order = {"key": lambda x: tuple((v is not None, v or 0) for v in x)}
    got = [(r.doc_id, r.item_id) for r in find_leaks(docs, benchmark).collect()]
    assert sorted(got, **order) == want
    assert sorted(r.doc_id for r in clean_documents(docs, benchmark).collect()) == [2, 3, 4, 6]
    assert clean_documents(docs, benchmark).columns == docs.columns
    monkeypatch.setattr(decontaminate, "MAX_BLOCK_WORDS", 60)
    got = [(r.doc_id, r.item_id) for r in find_leaks(docs, benchmark).collect()]
    assert sorted(got, **order) == want
    assert find_leaks(docs.limit(0), benchmark).count() == 0
    assert clean_documents(docs, benchmark.limit(0)).count() == docs.count()


def hits(item, text):
    index = BenchmarkIndex(pa.table({"item_id": [1], "text": [item]}))
    return list(decontaminate._hits(index, pa.array([text])))


def test_one_rule_for_items_of_any_length():
    stock = [f"w{k}" for k in range(1200)]
    for n in (100, 128, 129, 257, 1000):
        item = " ".join(stock[:n])
        limit = int(0.2 * n)
        for missing, found in ((limit, 1), (limit + 1, 0)):
            kept = [w for k, w in enumerate(stock[:n]) if (k * 7) % n >= missing]
            assert len(hits(item, "before " + " ".join(kept) + " after")) == found, (n, missing)
        assert hits(item, " ".join(stock[:70])) == ([] if n > 87 else [(0, 0, 0, 70, n - 70)])


def test_short_items_are_found_word_by_word():
    for n in (1, 2, 3, 4):
        item = " ".join(["alpha", "beta", "gamma", "delta"][:n])
        assert hits(item, f"say {item.upper()} twice {item}")
        assert not hits(item, f"say {item}x and {'no ' + item[1:]}")
