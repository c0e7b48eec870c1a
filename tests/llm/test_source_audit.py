"""The source audit against plain counting with unbounded whole numbers."""

import random
import re
from collections import Counter

import numpy as np

from rollcall.llm import source_audit

SCHEMA = "rank string, doc_id long, text string, lang string, source string, n string"
UPPER = {c: c + 32 for c in range(65, 91)}


def plain(rows):
    """rows: (text, lang, source)."""
    counts, documents = {}, {}
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
        counts.setdefault(lang, {}).setdefault(source, Counter()).update(found)
        documents.setdefault(lang, Counter()).update(set(found))
    result = []
    for lang, groups in counts.items():
        kept = sorted(t for t, n in documents[lang].items() if n >= source_audit.MIN_DOCUMENTS)
        v = len(kept)

        def shares(of):
            total = sum(of[t] for t in kept)
            return {t: 1 + 10**9 * (of[t] + 2) // (total + 2 * v) for t in kept}

        q = shares(sum(groups.values(), Counter()))
        p = {s: shares(c) for s, c in groups.items()}
        gap = lambda a, b: (a - b) ** 2 // (a + b)
        for source, own in groups.items():
            pair = [(o, sum(gap(p[source][t], p[o][t]) for t in kept)) for o in groups if o != source]
            term = [(t, gap(p[source][t], q[t])) for t in kept if own[t] > 0 and p[source][t] > q[t]]
            for part, items, top in (("pair", pair, None), ("term", term, 10)):
                order = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:top]
                result += [(lang, source, part, item, f, k + 1) for k, (item, f) in enumerate(order)]
    return sorted(result)


def audited(spark, rows):
    docs = spark.createDataFrame([("x", 1, t, g, s, "y") for t, g, s in rows], SCHEMA)
    return sorted(tuple(r) for r in source_audit.audited(docs).collect())


def sample(n, seed=1):
    rng = random.Random(seed)
    stock = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(80)] + ["ÄÖ", "été", "Longer" * 5, "日本語", "O'Neil", "x1y"]
    rows = []
    for _ in range(n):
        source = rng.choice(["a", "b", "B", "é", None, "hot", "hot", "hot"])
        words = rng.choices(stock, weights=[1 + (len(source or "") * k) % 7 for k in range(len(stock))], k=rng.randint(0, 40))
        rows.append((" ".join(words), rng.choice(["en", "de", None]), source))
    return rows


def test_equals_plain_version(spark):
    rows = sample(400) + [(None, "en", "silent"), ("", "xx", "alone"), ("rare words only", "yy", "p"), ("others", "yy", "q")]
    rows += [("same row twice", "en", "a")] * 12 + [("é" * 50_000 + " word " * 20_000, "en", "long")]
    assert audited(spark, rows) == plain(rows)


def test_slices_and_small_tasks_change_nothing(spark, monkeypatch):
    rows = sample(300, seed=2)
    want = plain(rows)
    monkeypatch.setattr(source_audit, "SLICE", 7)
    assert audited(spark, rows) == want


def test_empty_table(spark):
    assert audited(spark, []) == []


def test_a_long_text_counts_as_one_document(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(source_audit, "PENDING", 3)
    monkeypatch.setattr(source_audit, "slices_of", lambda c: cut(c, 20))
    from rollcall.llm.pieces import slices_of as cut

    texts = ["apple pear apple plum " * 30, "pear", None, "apple " * 40, "kiwi apple"]
    counts = source_audit._TermCounts()
    n = len(texts)
    counts.add(
        pa.RecordBatch.from_arrays(
            [pa.array([t or "" for t in texts]), pa.array(["en"] * n), pa.array(["s", "s", "s", "t", "s"])],
            names=["text", "lang", "source"],
        )
    )
    told = {(r["source"], r["term"]): (r["n"], r["documents"]) for r in counts.rows().to_pylist()}
    assert told == {
        ("s", "apple"): (61, 2), ("s", "pear"): (31, 2), ("s", "plum"): (30, 1), ("s", "kiwi"): (1, 1),
        ("t", "apple"): (40, 1), ("s", None): (0, 0), ("t", None): (0, 0),
    }


def test_crowded_tasks_hand_on_what_they_hold():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays(
        [pa.array(["a b c"] * 3000), pa.array(["en"] * 3000), pa.array(["s"] * 3000)], names=["text", "lang", "source"]
    )
    crowded = source_audit._TermCounts.crowded
    source_audit._TermCounts.crowded = lambda self: True
    try:
        parts = list(source_audit._count_terms(iter([batch])))
    finally:
        source_audit._TermCounts.crowded = crowded
    assert len(parts) == 3
    assert sum(r["n"] for p in parts for r in p.to_pylist()) == 9000


def test_shares_are_exact_for_large_counts():
    for count, total, kept in ((0, 0, 1), (10**13, 2 * 10**14, 10**6), (7, 10**14 + 3, 12_345)):
        got = source_audit.shares_of(np.array([count]), total, kept)[0]
        assert got == 1 + 10**9 * (count + 2) // (total + 2 * kept)
