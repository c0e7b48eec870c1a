"""Benchmark decontamination: CGK embeddings of item-sized windows, bit sampling, exact verification.

A document holds a benchmark item if some stretch of its words turns into the item by at most
``EDIT_SHARE`` of the item's words as insertions, deletions or substitutions.

* Windows: an item with at most k edits leaves one of its k + 1 equal parts untouched, so a document's
  windows are laid where such a part occurs; no other window can be within the limit.
* Embedding: a random walk copies a window's words to three times its length; each step stays or
  moves on by a random bit of the word it stands on. Walks over similar texts fall into step again after
  an edit, so edit distance becomes Hamming distance.
* Bit sampling: each of REPETITIONS walks is sampled at SAMPLES places; equal samples make a candidate.
* Candidates are verified by the exact edit distance of the whole item to the best stretch around the windows.

Items longer than MAX_PIECE words are looked for by their pieces: were every piece changed by more than EDIT_SHARE of its words,
the item would be, too, so one piece at least is within its own limit. Pieces only say where to look; one rule holds for items
of any length. Items of up to four words have a limit of 0 and are found where they stand word by word.

The benchmark is cut into blocks of at most MAX_BLOCK_WORDS words (on average; whole items). A task builds each block's
index and writes it to the shared folder, from which the tasks that scan documents read it, one at a time; the driver sees file
names only.

Defined cases: null and empty texts hold nothing, null and empty items are in nothing; equal items and repeated rows are
reported each; of equally near places of an item in a document the first is told; very long texts are scanned as a whole, and
long items compared as a whole; empty tables find nothing. A-Z count as a-z. Only ``doc_id`` and ``text``, ``item_id`` and ``text`` are read;
:func:`clean_documents` keeps all columns, whatever their names.
"""

from __future__ import annotations

import math
import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import ship_package, word_count
from rollcall.llm.token_store import file_system
from rollcall.llm.wordnum import U64, find_words, hash_words, mix64, slices, text_bytes
from rollcall.session import scratch_path

EDIT_SHARE = 0.2
MAX_PIECE = 128
MAX_BLOCK_WORDS = 500_000

#: Chosen for a recall of 0.99 at the edit limit (measured by the tests).
REPETITIONS = 32
SAMPLES = 2

_PAD = U64(0)
_BASE = U64(0x9E3779B97F4A7C15)


class BenchmarkIndex:
    """Pieces of the items, the parts that windows are laid by, and the sampled keys of their embeddings."""

    def __init__(self, items: pa.Table):
        texts = items.column("text").combine_chunks() if items.num_rows else pa.array([], pa.string())
        raw, offsets = text_bytes(texts)
        starts, ends, at = find_words(raw, offsets)
        hashes = hash_words(raw, starts, ends)
        self.items = [hashes[at[k] : at[k + 1]] for k in range(items.num_rows)]
        self.ids = items.column("item_id").to_pylist()
        self.pieces: list[np.ndarray] = []
        self.owner: list[int] = []
        #: Words of the item before each piece.
        self.before: list[int] = []
        for k, words in enumerate(self.items):
            offset = 0
            for piece in np.array_split(words, math.ceil(len(words) / MAX_PIECE)) if len(words) else ():
                self.pieces.append(piece)
                self.owner.append(k)
                self.before.append(offset)
                offset += len(piece)
        self.limits = [int(EDIT_SHARE * len(p)) for p in self.pieces]
        rng = np.random.default_rng(20240229)
        longest = max((len(p) for p in self.pieces), default=1)
        self.turns = rng.integers(0, 2**63, (3 * longest, REPETITIONS), dtype=np.uint64) * U64(2) + U64(1)
        self.places = rng.random((REPETITIONS, SAMPLES))
        self._lay_parts()
        keys = []
        for first in range(0, len(self.pieces), 512):
            group = self.pieces[first : first + 512]
            lengths = np.array([len(p) for p in group])
            table = np.full((len(group), lengths.max() + 1), _PAD)
            for row, piece in enumerate(group):
                table[row, : len(piece)] = piece
            keys.append(self.embed(table, lengths).reshape(-1))
        flat = np.concatenate(keys) if keys else np.zeros(0, U64)
        order = np.argsort(flat, kind="stable")
        self.keys, self.key_piece = flat[order], order // REPETITIONS

    def _lay_parts(self) -> None:
        found: dict[int, set[tuple[int, int, int]]] = {}
        for piece, limit in zip(self.pieces, self.limits, strict=True):
            parts = limit + 1
            size = len(piece) // parts
            width = min(size, 4)
            for p in range(parts):
                gram = grams(piece[p * size : p * size + width], width)[0]
                found.setdefault(width, set()).add((int(gram), len(piece), p * size))
        self.parts = {}
        for width, rows in found.items():
            listed = sorted(rows)
            gram = np.array([r[0] for r in listed], U64)
            hint = np.zeros(1 << 16, bool)
            hint[(gram >> U64(48)).astype(np.int64)] = True
            self.parts[width] = (hint, gram, np.array([r[1] for r in listed]), np.array([r[2] for r in listed]))

    def embed(self, table: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Sampled keys, one row per window and one column per repetition.

        ``table`` holds the windows' words padded by at least one column.
        """
        n = len(table)
        steps = int(3 * lengths.max())
        seen = np.empty((steps, n, REPETITIONS), U64)
        at = np.zeros((n, REPETITIONS), np.int64)
        base = (np.arange(n) * table.shape[1])[:, None]
        flat = table.reshape(-1)
        last = table.shape[1] - 1
        for j in range(steps):
            word = flat[base + at]
            seen[j] = word
            at += ((word * self.turns[j]) >> U64(63)).astype(np.int64)
            np.minimum(at, last, out=at)
        key = np.broadcast_to(
            mix64(lengths.astype(U64))[:, None] ^ mix64(np.arange(1, REPETITIONS + 1, dtype=U64)), at.shape
        ).copy()
        rows, reps = np.arange(n)[:, None], np.arange(REPETITIONS)
        for s in range(SAMPLES):
            where = (self.places[:, s] * (3 * lengths)[:, None]).astype(np.int64)
            key = mix64(key ^ seen[where, rows, reps])
        return key

    def search(self, words: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(document, item, first word, words, edits) for texts whose words are words[at[k]:at[k + 1]]."""
        laid = []
        for width, (hint, gram, length, offset) in self.parts.items():
            own = grams(words, width)
            hits = np.flatnonzero(hint[(own >> U64(48)).astype(np.int64)])
            low = np.searchsorted(gram, own[hits], "left")
            count = np.searchsorted(gram, own[hits], "right") - low
            hits, low, count = hits[count > 0], low[count > 0], count[count > 0]
            doc = np.searchsorted(at, hits, "right") - 1
            inside = hits + width <= at[doc + 1]
            hits, low, count, doc = hits[inside], low[inside], count[inside], doc[inside]
            which = np.repeat(low, count) + _ranges(count)
            hits, doc = np.repeat(hits, count), np.repeat(doc, count)
            first = np.maximum(hits - offset[which], at[doc])
            laid.append(np.stack([first, length[which], doc], axis=1))
        windows = np.unique(np.concatenate(laid), axis=0) if laid else np.zeros((0, 3), np.int64)
        met = [self._met(words, at, windows[k : k + 256]) for k in range(0, len(windows), 256)]
        if met:
            yield from self._verified(words, at, np.concatenate(met))

    def _met(self, words, at, windows) -> np.ndarray:
        """(document, item, word at which the item would begin) of windows that share a sampled key with a piece."""
        first, length, doc = windows.T
        columns = np.arange(length.max() + 1)
        place = first[:, None] + columns
        table = words[np.minimum(place, len(words) - 1)]
        table[(columns >= length[:, None]) | (place >= at[doc + 1][:, None])] = _PAD
        keys = self.embed(table, length).reshape(-1)
        low = np.searchsorted(self.keys, keys, "left")
        count = np.searchsorted(self.keys, keys, "right") - low
        met = np.flatnonzero(count)
        piece = self.key_piece[np.repeat(low[met], count[met]) + _ranges(count[met])]
        window = np.repeat(met // REPETITIONS, count[met])
        pairs = np.unique(np.stack([window, piece], axis=1), axis=0)
        window, piece = pairs[:, 0], pairs[:, 1]
        owner, before = np.array(self.owner, np.int64), np.array(self.before, np.int64)
        return np.stack([doc[window], owner[piece], first[window] - before[piece]], axis=1)

    def _verified(self, words, at, met) -> Iterator[tuple[int, int, int, int, int]]:
        """Exact distances; places of an item that lie near each other are looked at as one stretch."""
        met = np.unique(met, axis=0)
        begins = np.ones(len(met), bool)
        if len(met) > 1:
            room = np.array([2 * int(EDIT_SHARE * len(i)) + 1 for i in self.items])[met[1:, 1]]
            near = (met[1:, :2] == met[:-1, :2]).all(axis=1) & (met[1:, 2] - met[:-1, 2] <= room)
            begins[1:] = ~near
        first = np.flatnonzero(begins)
        last = np.append(first[1:], len(met)) - 1
        for a, b in zip(first.tolist(), last.tolist(), strict=True):
            doc, owner = int(met[a, 0]), int(met[a, 1])
            item = self.items[owner]
            limit, zero = int(EDIT_SHARE * len(item)), int(at[doc])
            start = max(int(met[a, 2]) - limit, zero)
            stop = min(int(met[b, 2]) + len(item) + limit, int(at[doc + 1]))
            edits, begin, size = best_stretch(item, words[start:stop])
            if edits <= limit:
                yield doc, owner, start + begin - zero, size, edits


def _ranges(counts: np.ndarray) -> np.ndarray:
    """0 .. c - 1 for each count c, end to end."""
    total = int(counts.sum())
    return np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)


def grams(words: np.ndarray, width: int) -> np.ndarray:
    """A number for every run of ``width`` words."""
    n = max(len(words) - width + 1, 0)
    total = np.zeros(n, U64)
    for k in range(width):
        total = total * _BASE + words[k : k + n]
    return mix64(total)


def best_stretch(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Least edit distance between ``item`` and any stretch of ``text``; the stretch's begin and length."""
    last, end = _last_row(item, text)
    back, begin = _last_row(item[::-1], text[:end][::-1])
    return last, end - begin, begin


def _last_row(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    steps = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for word in item:
        change = np.empty_like(row)
        change[0] = row[0] + 1
        change[1:] = np.minimum(row[1:] + 1, row[:-1] + (text != word))
        row = np.minimum.accumulate(change - steps) + steps
    end = int(row.argmin())
    return int(row[end]), end


def index_blocks(benchmark: DataFrame) -> list[str]:
    """Files of the indexes of the benchmark's blocks, in the shared folder; each is of bounded size."""
    spark = benchmark.sparkSession
    ship_package(spark)
    sized = benchmark.select("item_id", "text")
    total = sized.agg(F.coalesce(F.sum(word_count(F.col("text"))), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(total / MAX_BLOCK_WORDS))
    folder = scratch_path(spark, "benchmark-index")

    def build(rows: pa.Table) -> pa.Table:
        files, root = file_system(folder)
        files.create_dir(root, recursive=True)
        # A lost attempt's file is named by nobody.
        name = f"{uuid.uuid4().hex}.index"
        with files.open_output_stream(f"{root}/{name}") as out:
            out.write(pickle.dumps(BenchmarkIndex(rows)))
        return pa.table({"name": [name]})

    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).alias("block")
    built = sized.select("item_id", "text", block).groupBy("block").applyInArrow(build, "name string")
    # One name per block.
    return sorted(f"{folder}/{r['name']}" for r in built.collect())


_LOADED: dict[str, BenchmarkIndex] = {}


def _loaded(file: str) -> BenchmarkIndex:
    """The index of a file; a worker process keeps the last one."""
    if file not in _LOADED:
        _LOADED.clear()
        files, path = file_system(file)
        with files.open_input_stream(path) as source:
            _LOADED[file] = pickle.loads(source.read())
    return _LOADED[file]


def _hits(index: BenchmarkIndex, column: pa.Array) -> Iterator[tuple[int, int, int, int, int]]:
    raw, offsets = text_bytes(column)
    for first, last in slices(offsets):
        starts, ends, at = find_words(raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        words = hash_words(raw[offsets[first] : offsets[last]], starts, ends)
        for doc, *rest in index.search(words, at):
            yield first + doc, *rest


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start_word, n_words, edits): the best place of each item in each document that holds it."""
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    found = None
    for file in index_blocks(benchmark):

        def scan(batches: Iterator[pa.RecordBatch], file=file) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                index = _loaded(file)
                best: dict[tuple[int, int], tuple[int, int, int]] = {}
                for doc, item, start, size, edits in _hits(index, batch.column("text")):
                    told = (edits, start, size)
                    if told < best.get((doc, item), (edits + 1, 0, 0)):
                        best[doc, item] = told
                rows = sorted(best)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array([d for d, _ in rows], pa.int64())),
                        pa.array([index.ids[i] for _, i in rows], None if rows else pa.int64()),
                        pa.array([best[r][1] for r in rows], pa.int64()),
                        pa.array([best[r][2] for r in rows], pa.int64()),
                        pa.array([best[r][0] for r in rows], pa.int64()),
                    ],
                    names=["doc_id", "item_id", "start_word", "n_words", "edits"],
                )

        part = docs.select("doc_id", "text").mapInArrow(
            scan, f"doc_id {doc_type}, item_id {item_type}, start_word long, n_words long, edits long"
        )
        found = part if found is None else found.union(part)
    if found is None:
        none = f"doc_id {doc_type}, item_id {item_type}, start_word long, n_words long, edits long"
        return docs.sparkSession.createDataFrame([], none)
    return found


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The input rows that hold no item; one pass over the texts per block of the benchmark, no shuffle."""
    for file in index_blocks(benchmark):

        def keep(batches: Iterator[pa.RecordBatch], file=file) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                held = {doc for doc, *_ in _hits(_loaded(file), batch.column("text"))}
                yield batch.take(pa.array([k for k in range(batch.num_rows) if k not in held], pa.int64()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
