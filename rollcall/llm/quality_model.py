"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

Features are runs of one and two words, and runs of one to three word shapes (classes of characters with
repeats collapsed, marked if the word repeats the one before), hashed to 2**BITS weights. A text's value of a
feature is its share of the text's runs of that kind, so scoring is a sparse dot product of any length of text.

Training reads a bounded sample of labelled rows (about SAMPLE_ROWS, by a hash of doc_id), split over SHARDS
tasks that each run FTRL-proximal over theirs; the shards' weights are averaged.

Defined cases: null and empty texts have no features and get the score of the bias alone; rows without label, with a
null label or a null doc_id teach nothing; differing labels of one doc_id count by their mean; without any labels
all scores are 0.5. Only ``doc_id`` and ``text`` are read of the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import ship_package
from rollcall.llm.wordnum import U64, find_words, hash_segments, hash_words, mix64, slices, text_bytes

BITS = 18
SAMPLE_ROWS = 12_000
SHARDS = 4
EPOCHS = 2

#: FTRL-proximal: learning rate, its smoothing, and both penalties.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 1e-3, 1e-4
SCALE = 10.0

_BIAS = 1 << BITS
_KINDS = 5
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[128:] = 1
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3


def word_runs(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """For texts in one buffer: number of the first word of each, and the bucket of the run of each kind at each word.

    Runs that would cross the end of a text are -1.
    """
    starts, ends, at = find_words(raw, offsets)
    if not len(starts):
        return at, [np.zeros(0, np.int64)] * _KINDS
    words = hash_words(raw, starts, ends, lower=False)
    kinds = _CLASS[raw]
    inside = np.zeros(len(raw) + 1, np.int32)
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends, -1)
    inside = np.cumsum(inside[:-1]) > 0
    turn = np.ones(len(raw), bool)
    turn[1:] = kinds[1:] != kinds[:-1]
    turn[starts] = True
    turn &= inside
    places = np.flatnonzero(turn)
    begin = np.searchsorted(places, starts)
    shapes = hash_segments(kinds[places], np.diff(np.append(begin, len(places))))
    first_word = np.zeros(len(words), bool)
    first_word[at[:-1][at[:-1] < at[1:]]] = True
    repeats = np.zeros(len(words), bool)
    repeats[1:] = (words[1:] == words[:-1]) & ~first_word[1:]
    shapes = np.where(repeats, mix64(shapes), shapes)
    result = []
    for salt, (base, width) in enumerate(((words, 1), (words, 2), (shapes, 1), (shapes, 2), (shapes, 3))):
        run = np.full(len(base), U64(salt + 1))
        crossed = np.zeros(len(base), bool)
        for k in range(width):
            shifted = np.zeros(len(base), U64)
            shifted[: len(base) - k] = base[k:]
            run = mix64(run ^ shifted)
            if k:
                later = np.ones(len(base), bool)
                later[: len(base) - k] = first_word[k:]
                crossed |= later
        bucket = (run >> U64(64 - BITS)).astype(np.int64)
        bucket[crossed] = -1
        result.append(bucket)
    return at, result


def texts_runs(column: pa.Array) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
    """(number of the first text, word offsets, runs by kind) of slices of a column."""
    raw, offsets = text_bytes(column)
    for first, last in slices(offsets):
        part = raw[offsets[first] : offsets[last]]
        yield first, *word_runs(part, offsets[first : last + 1] - offsets[first])


def sparse_rows(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(features, values) of each text, bias included."""
    rows = []
    for _, at, kinds in texts_runs(column):
        for k in range(len(at) - 1):
            features, values = [np.array([_BIAS])], [np.ones(1)]
            for runs in kinds:
                own = runs[at[k] : at[k + 1]]
                own = own[own >= 0]
                if len(own):
                    found, counts = np.unique(own, return_counts=True)
                    features.append(found)
                    values.append(counts * (SCALE / len(own)))
            joined, place = np.unique(np.concatenate(features), return_inverse=True)
            rows.append((joined, np.bincount(place, weights=np.concatenate(values))))
    return rows


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> np.ndarray:
    """Weights after EPOCHS passes of FTRL-proximal with logistic loss over the rows in their order."""
    z, n = np.zeros(_BIAS + 1), np.zeros(_BIAS + 1)

    def weights(i):
        w = (np.sign(z[i]) * L1 - z[i]) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where(np.abs(z[i]) <= L1, 0.0, w)

    for _ in range(EPOCHS):
        for (i, x), y in zip(rows, labels, strict=True):
            w = weights(i)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - y) * x
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - sigma * w
            n[i] += g * g
    return weights(np.arange(_BIAS + 1))


def _train(table: pa.Table) -> pa.Table:
    table = table.sort_by("place")
    column = table.column("text").combine_chunks()
    w = ftrl(sparse_rows(column), table.column("label").to_numpy())
    used = np.flatnonzero(w)
    return pa.table({"feature": pa.array(used), "weight": pa.array(w[used])})


def train(docs: DataFrame, labels: DataFrame, allowed: Column) -> np.ndarray:
    """Weights learned from labelled rows (doc_id, label) for which ``allowed`` holds.

    The sample of labels is bounded, so it is broadcast to the documents; texts are not shuffled but for
    those of the sample.
    """
    ship_package(docs.sparkSession)
    usable = (
        labels.filter(allowed & F.col("doc_id").isNotNull() & F.col("label").isNotNull())
        .groupBy("doc_id")
        .agg(F.avg("label").alias("label"))
    )
    share = min(1.0, SAMPLE_ROWS / max(1, usable.count()))
    place = F.xxhash64(F.lit("sample"), F.col("doc_id"))
    sample = usable.withColumn("place", place).filter(
        F.pmod("place", F.lit(1_000_003)) <= F.lit(share * 1_000_003)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    trained = (
        rows.select("text", "label", "place", F.pmod(F.shiftright("place", 24), F.lit(SHARDS)).alias("shard"))
        .groupBy("shard")
        .applyInArrow(_train, "feature long, weight double")
        .groupBy("feature")
        .agg((F.sum("weight") / SHARDS).alias("weight"))
    )
    weights = np.zeros(_BIAS + 1)
    # At most 2**BITS + 1 rows.
    found = trained.toArrow()
    weights[found.column("feature").to_numpy()] = found.column("weight").to_numpy()
    return weights


def score_texts(column: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Chance of label 1 of each text."""
    scores = []
    for _, at, kinds in texts_runs(column):
        total = np.full(len(at) - 1, weights[_BIAS])
        for runs in kinds:
            valid = runs >= 0
            sums = np.concatenate([[0.0], np.cumsum(np.where(valid, weights[runs], 0.0))])
            counts = np.concatenate([[0], np.cumsum(valid)])
            had = counts[at[1:]] - counts[at[:-1]]
            total += SCALE * (sums[at[1:]] - sums[at[:-1]]) / np.maximum(had, 1)
        scores.append(1 / (1 + np.exp(-np.clip(total, -35, 35))))
    return np.concatenate(scores) if scores else np.zeros(0)


def scored(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """(doc_id, score) of every row; one pass without a shuffle."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    doc_type = docs.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score_texts(batch.column("text"), shared.value))],
                names=["doc_id", "score"],
            )

    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {doc_type}, score double")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds
