"""Token counts by a two-tier lookup on the map side.

A text's tokens are those of its pieces (:mod:`rollcall.llm.pieces`), so counting needs the number of tokens of each
piece only. Lengths of frequent pieces are in a compact hash table that is broadcast; other pieces are encoded by the
worker that meets them and kept in its cache. No piece of a text crosses an exchange.

The frequent pieces are found over all texts: each task keeps a frequency summary of SUMMARY pieces (after
Misra and Gries: every piece with more than 1 / SUMMARY of a task's pieces is in its summary), and the summaries, not the
pieces, are added up. The FREQUENT commonest of at most KEY_BYTES bytes make the table, which so has a fixed greatest
size (24 bytes a slot, 2**18 slots). The table only saves work: any table gives the same counts.

Strings of special tokens inside a text count as the tokenizer counts them by default (one token each); texts with such
strings or with characters of unknown class go through the tokenizer whole.

Defined cases: null and empty texts have 0 bytes and 0 tokens; repeated rows are counted each by itself; very long texts
are worked on in parts; ties between equally frequent pieces go to the smaller bytes; an empty table gives an empty
result. Only ``doc_id`` and ``text`` are read, so other columns may have any names.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import ship_package
from rollcall.llm.pieces import (
    Cutter,
    PieceLookup,
    PieceTable,
    char_classes,
    distinct_keys,
    key_bytes,
    slices_of,
    span_keys,
    special_strings,
)
from rollcall.llm.wordnum import text_bytes

FREQUENT = 1 << 16
SUMMARY = 1 << 13


def count_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class _Counter:
    """Token counts of texts by pieces, with the tokenizer for what the tables do not know."""

    def __init__(self, tokenizer_json: str, cutter: Cutter, shared: PieceTable | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.cutter = cutter
        self.whole = Tokenizer.from_str(tokenizer_json)
        self.single = Tokenizer.from_str(tokenizer_json)
        self.single.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.lookup = PieceLookup(self.lengths, shared)

    def lengths(self, pieces: list[bytes]) -> list[int]:
        found = self.single.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)
        return [len(e) for e in found]

    def counts(self, column: pa.Array) -> np.ndarray:
        totals = np.zeros(len(column), np.int64)
        for raw, begin, text in slices_of(column):
            pieces = self.cutter.cut(raw, begin)
            own = np.zeros(len(text), np.int64)
            if len(pieces.starts):
                own += np.bincount(pieces.owner, self.lookup.numbers(pieces), len(text)).astype(np.int64)
            ends = np.append(begin[1:], len(raw))
            for k in pieces.whole:
                part = raw[begin[k] : ends[k]].tobytes().decode()
                own[k] += len(self.whole.encode(part, add_special_tokens=False))
            np.add.at(totals, text, own)
        return totals


class _Summary:
    """Frequencies of pieces with a bounded number of counters."""

    def __init__(self):
        self.table, self.low, self.high = PieceTable(), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.counts = np.zeros(0, np.int64)

    def add(self, low: np.ndarray, high: np.ndarray) -> None:
        number = self.table.find(low, high)
        new = np.flatnonzero(number < 0)
        if len(new):
            first, place = distinct_keys(low[new], high[new])
            fresh = np.arange(len(first), dtype=np.int32) + len(self.counts)
            self.table.add(low[new[first]], high[new[first]], fresh)
            self.low = np.concatenate([self.low, low[new[first]]])
            self.high = np.concatenate([self.high, high[new[first]]])
            number[new] = fresh[place]
        self.counts = np.bincount(number, minlength=len(self.low)) + np.pad(
            self.counts, (0, len(self.low) - len(self.counts))
        )
        if len(self.counts) > 16 * SUMMARY:
            self.shrink()

    def shrink(self) -> None:
        """Keep SUMMARY counters; the next count is taken off all of them."""
        if len(self.counts) <= SUMMARY:
            return
        order = np.argsort(-self.counts, kind="stable")
        self.counts = self.counts - self.counts[order[SUMMARY]]
        kept = order[:SUMMARY][self.counts[order[:SUMMARY]] > 0]
        self.low, self.high, self.counts = self.low[kept], self.high[kept], self.counts[kept]
        self.table = PieceTable(len(kept))
        self.table.add(self.low, self.high, np.arange(len(kept), dtype=np.int32))


def frequent_pieces(docs: DataFrame, cutter, limit: int = FREQUENT) -> list[bytes]:
    """The commonest short pieces of all texts, at most ``limit``; ``cutter`` is a broadcast Cutter."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = _Summary()
        for batch in batches:
            for raw, begin, _ in slices_of(batch.column("text")):
                low, high, short = cutter.value.cut(raw, begin).keys()
                summary.add(low[short], high[short])
        summary.shrink()
        pieces = key_bytes(summary.low, summary.high)
        yield pa.RecordBatch.from_arrays(
            [pa.array(pieces, pa.binary()), pa.array(summary.counts, pa.int64())], names=["piece", "n"]
        )

    summed = (
        docs.select("text")
        .mapInArrow(summarise, "piece binary, n long")
        .groupBy("piece")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.col("n").desc(), "piece")
        .limit(limit)
    )
    # At most ``limit`` rows of KEY_BYTES.
    return summed.select("piece").toArrow().column("piece").to_pylist()


def length_table(pieces: list[bytes], tokenizer_json: str) -> PieceTable:
    """The table of the pieces' numbers of tokens."""
    table = PieceTable(FREQUENT)
    if pieces:
        lengths = np.array([len(p) for p in pieces])
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        low, high, _ = span_keys(raw, np.cumsum(lengths) - lengths, lengths)
        table.add(low, high, np.array(_Counter(tokenizer_json, None, None).lengths(pieces), np.int32))
    return table


_COUNTERS: dict[str, _Counter] = {}


def _counter(key: str, tokenizer_json: str, cutter: Cutter, shared: PieceTable) -> _Counter:
    """The counter of this worker process; its cache serves all tasks of a query that the process runs."""
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = _Counter(tokenizer_json, cutter, shared)
    return _COUNTERS[key]


def counted(docs: DataFrame, tokenizer_path: str, frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row: one pass for the table, one for the counts, and no text moves."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    ship_package(spark)
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer_json = file.read()
    classes = char_classes(Tokenizer.from_str(tokenizer_json).pre_tokenizer)
    cutter = Cutter(classes, join_space=True, specials=special_strings(tokenizer_json))
    send = spark.sparkContext.broadcast
    sent_cutter, sent_json = send(cutter), send(tokenizer_json)
    table = send(length_table(frequent_pieces(docs, sent_cutter, frequent), tokenizer_json))
    query = uuid.uuid4().hex
    doc_type = docs.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(query, sent_json.value, sent_cutter.value, table.value)
        for batch in batches:
            text = batch.column("text")
            _, offsets = text_bytes(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(counter.counts(text))],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    return docs.select("doc_id", "text").mapInArrow(count, f"doc_id {doc_type}, n_bytes long, n_tokens long")
