"""Held-out accuracy of the quality classifier and of language identification, and their defined cases."""

import itertools
import math
import random
import zlib

import numpy as np
import pyarrow as pa
from brute import words as plain_words

from rollcall.llm import language_id, quality_model
from rollcall.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def truth(spark, table, column):
    return {r.doc_id: r[column] for r in spark.read.parquet(f"{SF}/{table}.parquet").collect()}


def auc(scores, labels):
    ranks = np.argsort(np.argsort(scores)) + 1
    good = labels == 1
    return (ranks[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def test_quality_of_held_out_rows(spark):
    rows = QUERIES["op4_ftrl_quality"](spark, SF).collect()
    labels = truth(spark, "labels", "quality")
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert auc(*map(np.array, zip(*held, strict=True))) > 0.97
    assert np.mean([(s >= 0.5) == y for s, y in held]) > 0.93


def test_ftrl_separates_and_scores_as_trained():
    texts = pa.array(["good plain words here", "bad### bad### bad###"] * 50)
    rows = quality_model.sparse_rows(texts)
    weights = quality_model.ftrl(rows, np.array([1.0, 0.0] * 50))
    plain = [1 / (1 + math.exp(-float(weights[i] @ x))) for i, x in rows]
    assert np.allclose(quality_model.score_texts(texts, weights), plain)
    assert plain[0] > 0.8 > 0.2 > plain[1]


def plain_shape(word):
    """Runs of character classes of a word's bytes: lower case or not ASCII, upper case, digit, other."""
    classes = ["u" if 65 <= c <= 90 else "d" if 48 <= c <= 57 else "l" if 97 <= c <= 122 or c > 127 else "o" for c in word.encode()]
    return "".join(k for k, _ in itertools.groupby(classes))


def plain_features(text):
    """{feature: value} by dictionaries: shares of word and shape runs, and the bias."""
    w = plain_words(text)
    shapes = [(plain_shape(x), k > 0 and w[k - 1] == x) for k, x in enumerate(w)]
    found = {"bias": 1.0}
    for kind, (base, width) in enumerate(((w, 1), (w, 2), (shapes, 1), (shapes, 2), (shapes, 3))):
        runs = [(kind, *base[k : k + width]) for k in range(len(base) - width + 1)]
        for run in runs:
            found[run] = found.get(run, 0.0) + quality_model.SCALE / len(runs)
    return found


def plain_ftrl(rows, labels):
    """FTRL-proximal with logistic loss, one coordinate at a time."""
    z, n = {}, {}
    q = quality_model

    def weight(f):
        if abs(z.get(f, 0.0)) <= q.L1:
            return 0.0
        return (math.copysign(q.L1, z[f]) - z[f]) / ((q.BETA + math.sqrt(n[f])) / q.ALPHA + q.L2)

    for _ in range(q.EPOCHS):
        for row, label in zip(rows, labels, strict=True):
            w = {f: weight(f) for f in row}
            p = 1 / (1 + math.exp(-sum(w[f] * x for f, x in row.items())))
            for f, x in row.items():
                g, old = (p - label) * x, n.get(f, 0.0)
                z[f] = z.get(f, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / q.ALPHA * w[f]
                n[f] = old + g * g
    return {f: weight(f) for f in z}


def test_training_equals_a_dictionary_version(spark):
    draw = random.Random(5)
    stock = ["plain", "Good", "été", "x1", "###", "words"]
    texts = [" ".join(draw.choices(stock, k=draw.randrange(0, 7))) for _ in range(47)] + ["", "Good Good\n\tGood", "B2B"]
    labels = [float(k % 3 > 0) for k in range(50)]
    plain = plain_ftrl([plain_features(t) for t in texts], labels)
    weights = quality_model.ftrl(quality_model.sparse_rows(pa.array(texts)), np.array(labels))
    assert np.allclose(np.sort(weights[weights != 0]), sorted(w for w in plain.values() if w))
    want = [1 / (1 + math.exp(-sum(plain[f] * x for f, x in plain_features(t).items()))) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in quality_model.scored(docs, weights).collect()}
    assert np.allclose([got[k] for k in range(50)], want)


def test_quality_edge_rows(spark):
    rows = [(1, None, 1), (2, "", 1), (None, "a b", 1), (3, "x" * 300_000, 1), (3, " \n", 1), (4, "word " * 100_000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (3, 0), (3, 1), (9, 1)], "doc_id long, label int")
    allowed = quality_model.fold(quality_model.F.col("doc_id"), 3) >= 0
    weights = quality_model.train(docs, labels, allowed)
    got = quality_model.scored(docs, weights).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    none = quality_model.train(docs, labels.limit(0), allowed)
    assert [r.score for r in quality_model.scored(docs, none).collect()] == [0.5] * 6
    assert quality_model.scored(docs.limit(0), none).count() == 0


def test_language_of_held_out_rows(spark):
    rows = QUERIES["op9_ppm_language"](spark, SF).collect()
    lang = truth(spark, "documents", "lang")
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.lang_pred in {*lang.values(), "und"} for r in rows)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in rows if r.held_out]) > 0.97


def plain_bits(text, counts):
    """Code length by method C with escapes down the orders, counted byte by byte."""
    data, bits = b"\n" * 3 + text.encode(), 0.0
    for i in range(3, len(data)):
        for k in (3, 2, 1, 0):
            seen = counts.get((k, data[i - k : i]), {})
            n, d = sum(seen.values()), len(seen)
            if data[i] in seen:
                bits += math.log2((n + d) / seen[data[i]])
                break
            if n:
                bits += math.log2((n + d) / d)
        else:
            bits += 8
    return bits


def test_code_lengths_are_exact(spark, monkeypatch):
    train = [(1, "the cat sat on the mat", "en"), (2, "der Hund läuft", "de"), (3, "and the hat", "en")]
    docs = spark.createDataFrame(train, "doc_id long, text string, lang string")
    trees = language_id.train(docs, language_id.F.lit(True))
    assert trees.langs == ["de", "en"]
    counts = {"de": {}, "en": {}}
    for _, text, lang in train:
        data = b"\n" * 3 + text.encode()
        for i in range(3, len(data)):
            for k in range(4):
                own = counts[lang].setdefault((k, data[i - k : i]), {})
                own[data[i]] = own.get(data[i], 0) + 1
    texts = ["the dog läuft", "", "xyz", "mat mat mat", "ü" * 40, "a"]
    monkeypatch.setattr(language_id, "CACHE_NUMBERS", 1 << 9)  # slots are lost, results stay
    got = language_id.code_lengths(pa.array(texts), language_id.CostCache(trees))
    want = [[plain_bits(t, counts[x]) for x in trees.langs] for t in texts]
    assert np.allclose(got, want)


def test_language_edge_rows(spark):
    rows = [
        (1, "the cat sat", "en", 0), (2, "der Hund", "de", 0), (None, "der Hund", "de", 0), (3, None, "en", 0),
        (4, "12 34!", None, 0), (5, "", "de", 0), (6, "the " * 200_000, None, 0), (6, "the cat", None, 0),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    trees = language_id.train(docs, language_id.F.lit(True))
    got = language_id.identified(docs, trees).collect()
    assert [r.lang_pred for r in sorted(got, key=lambda r: (r.doc_id is None, r.doc_id))] == [
        "en", "de", "und", "und", "und", "en", "en", "de",
    ]
    none = language_id.train(docs.limit(0), language_id.F.lit(True))
    assert {r.lang_pred for r in language_id.identified(docs, none).collect()} == {"und"}
    assert language_id.identified(docs.limit(0), trees).count() == 0
