"""Language identification by prediction by partial matching.

Each language has a byte context tree of variable order up to ORDER. A byte costs the code length that the longest
known context gives it; where a context has not seen the byte, its escape is paid and the next shorter one is
asked, down to eight bits for a byte never seen. Escapes follow method C: a context that saw d different bytes
in n escapes with d / (n + d). Counts are frozen after training, so the code length of a text is a sum
over its (ORDER + 1)-byte strings, and the cost of each string is computed once per task.

Training counts those strings over a bounded sample of rows per language (about SAMPLE_ROWS, by a hash of doc_id).

Defined cases: null text and text without a letter is ``und`` with score 0; so is everything if no language was learned;
rows with null language or null doc_id teach nothing; ties go to the first language in code-point order. Only
``doc_id``, ``text`` and, for training, ``lang`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import ship_package
from rollcall.llm.wordnum import slices, text_bytes

ORDER = 3
SAMPLE_ROWS = 2_000
UNDETERMINED = "und"

#: Cached costs of a task: this many numbers at most.
CACHE_NUMBERS = 1 << 22


def strings(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The string that ends at each byte of each text, as a number.

    Every text is read as if ORDER newlines stood before it.
    """
    n = len(offsets) - 1
    lengths = np.diff(offsets)
    padded = np.full(len(raw) + ORDER * n, 10, np.uint8)
    place = np.arange(len(raw)) + ORDER * (np.repeat(np.arange(n), lengths) + 1)
    padded[place] = raw
    packed = np.zeros(len(raw), np.uint32)
    for k in range(ORDER + 1):
        packed = (packed << np.uint32(8)) | padded[place - ORDER + k]
    return packed


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offsets = text_bytes(batch.column("text"))
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        for lang in dict.fromkeys(langs):
            own = np.flatnonzero(langs == lang)
            parts = [strings(raw[offsets[k] : offsets[k + 1]], np.array([0, offsets[k + 1] - offsets[k]])) for k in own]
            found, counts = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(found), pa.string()), pa.array(found.astype(np.int64)), pa.array(counts)],
                names=["lang", "string", "times"],
            )


class ContextTrees:
    """Frozen statistics of all languages: counts of strings and contexts of each order, one column per language."""

    def __init__(self, langs: list[str], strings: np.ndarray, lang: np.ndarray, times: np.ndarray):
        self.langs = langs
        self.orders = []
        for k in range(ORDER + 1):
            key = strings & np.uint64((1 << 8 * (k + 1)) - 1)
            keys, row = np.unique(key, return_inverse=True)
            seen = np.zeros((len(keys), len(langs)))
            np.add.at(seen, (row, lang), times)
            contexts, row = np.unique(keys >> np.uint64(8), return_inverse=True)
            total, different = (np.zeros((len(contexts), len(langs))) for _ in range(2))
            np.add.at(total, row, seen)
            np.add.at(different, row, seen > 0)
            self.orders.append((keys, seen, contexts, total, different))

    def cost(self, strings: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each string after the bytes before it, one column per language."""
        bits = np.zeros((len(strings), len(self.langs)))
        open_ = np.ones(bits.shape, bool)
        for k in range(ORDER, -1, -1):
            keys, seen, contexts, total, different = self.orders[k]
            key = strings.astype(np.uint64) & np.uint64((1 << 8 * (k + 1)) - 1)
            n, d = _rows(contexts, total, key >> np.uint64(8)), _rows(contexts, different, key >> np.uint64(8))
            own = _rows(keys, seen, key)
            hit = open_ & (own > 0)
            escape = open_ & (own == 0) & (n > 0)
            bits[hit] += np.log2((n + d)[hit] / own[hit])
            bits[escape] += np.log2((n + d)[escape] / d[escape])
            open_ &= ~hit
        return bits + 8.0 * open_


def _rows(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros((len(wanted), values.shape[1]))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where((keys[at] == wanted)[:, None], values[at], 0.0)


class CostCache:
    """Costs by string in a direct-mapped table; strings that lost their slot are computed anew, so results are exact."""

    def __init__(self, trees: ContextTrees):
        self.trees = trees
        bits = max(8, int(np.log2(CACHE_NUMBERS / max(1, len(trees.langs)))))
        self.shift = np.uint32(32 - bits)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.costs = np.zeros((1 << bits, len(trees.langs)))

    def slots(self, strings: np.ndarray) -> np.ndarray:
        return (strings * np.uint32(2654435769)) >> self.shift

    def lookup(self, strings: np.ndarray) -> np.ndarray:
        slot = self.slots(strings)
        missed = np.flatnonzero(self.keys[slot] != strings)
        if not len(missed):
            return self.costs[slot]
        new, place = np.unique(strings[missed], return_inverse=True)
        bits = self.trees.cost(new)
        result = self.costs[slot]
        result[missed] = bits[place]
        at = self.slots(new)
        self.keys[at], self.costs[at] = new, bits
        return result


def train(docs: DataFrame, allowed: Column) -> ContextTrees:
    """Trees from rows for which ``allowed`` holds, a bounded sample of each language."""
    ship_package(docs.sparkSession)
    usable = docs.filter(allowed & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    # One row per language; the driver holds a model of each, so there are few. Texts stay where they are but for the sample's.
    sizes = usable.groupBy("lang").agg(F.count("*").alias("rows")).toArrow()
    table = docs.sparkSession.createDataFrame(sizes) if sizes.num_rows else usable.select("lang", F.lit(1).alias("rows")).limit(0)
    place = F.pmod(F.xxhash64(F.lit("sample"), F.col("doc_id")), F.lit(1_000_003))
    sample = (
        usable.select("doc_id", "text", "lang")
        .join(F.broadcast(table), "lang")
        .filter(place * F.col("rows") <= F.lit(SAMPLE_ROWS * 1_000_003))
    )
    counted = (
        sample.select("lang", "text")
        .mapInArrow(_count, "lang string, string long, times long")
        .groupBy("lang", "string")
        .agg(F.sum("times").alias("times"))
        .toArrow()
    )
    names = np.array(counted.column("lang").to_pylist(), dtype=object)
    langs = sorted(set(names))
    number = {x: k for k, x in enumerate(langs)}
    return ContextTrees(
        langs,
        counted.column("string").to_numpy().astype(np.uint64),
        np.array([number[x] for x in names], np.int64),
        counted.column("times").to_numpy(),
    )


def code_lengths(column: pa.Array, cache: CostCache) -> np.ndarray:
    """Bits of each text under each language."""
    raw, offsets = text_bytes(column)
    lengths = []
    for first, last in slices(offsets):
        own = offsets[first : last + 1] - offsets[first]
        packed = strings(raw[offsets[first] : offsets[last]], own)
        total = np.zeros((last - first, len(cache.trees.langs)))
        full = np.flatnonzero(np.diff(own))
        if len(full):
            total[full] = np.add.reduceat(cache.lookup(packed), own[full], axis=0)
        lengths.append(total)
    return np.concatenate(lengths) if lengths else np.zeros((0, len(cache.trees.langs)))


def identified(docs: DataFrame, trees: ContextTrees) -> DataFrame:
    """(doc_id, lang_pred, score) of every row; the score is the language's share of probability."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    doc_type = docs.schema["doc_id"].dataType.simpleString()

    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, cache = shared.value, CostCache(shared.value)
        for batch in batches:
            bits = code_lengths(batch.column("text"), cache)
            lettered = batch.column("lettered").to_numpy(zero_copy_only=False)
            if len(trees.langs):
                best = bits.argmin(axis=1)
                ahead = np.clip(bits - bits.min(axis=1, keepdims=True), 0, 1000)
                score = np.where(lettered, 1 / np.exp2(-ahead).sum(axis=1), 0.0)
                names = [trees.langs[b] if ok else UNDETERMINED for b, ok in zip(best, lettered, strict=True)]
            else:
                score, names = np.zeros(len(lettered)), [UNDETERMINED] * len(lettered)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score)],
                names=["doc_id", "lang_pred", "score"],
            )

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered")
    return docs.select("doc_id", "text", lettered).mapInArrow(
        identify, f"doc_id {doc_type}, lang_pred string, score double"
    )
