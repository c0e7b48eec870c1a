"""Token ids in binary shards, found through a minimal perfect hash index.

Files of a store, all under one folder that every executor sees:

* ``ids/``: one payload file per range of the order asked for. A 16-byte header (magic ``RIDS``, version, bytes per
  id), then little-endian ids without gaps; by default documents stand in ascending doc_id order (null last).
* ``entries/``: a row per document, written by Spark: its key, which file, where in it, how many ids.
* ``shards/``: a row per payload file with the number of ids before it. A payload file counts only if the rows of the
  same task attempt name it, so files of lost attempts are never read.
* ``index/``: a row per bucket of keys. A bucket holds a minimal perfect hash of its keys and, in hash order, a
  fingerprint of each key with its shard, offset and length: a lookup reads one bucket and one entry of it.

Keys are (doc_id, repeat): the n-th row of a doc_id has repeat n - 1, so repeated and null doc_ids have keys too.

Defined cases: null and empty texts are encoded as the end id alone; very long texts are encoded in parts; rows with equal doc_ids are
stored each by itself, in the order of their texts' hashes; an empty table makes an empty store. Only ``doc_id`` and ``text`` are
read, so other columns may have any names.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollcall.llm.common import ship_package
from rollcall.llm.pieces import (
    CLASSED,
    LETTER,
    NUMBER,
    OTHER,
    SPACE,
    UNKNOWN,
    Cutter,
    PieceLookup,
    slices_of,
    special_strings,
)
from rollcall.operators.ordering import ranked
from rollcall.session import drop_paths

HEADER_BYTES = 16
MAGIC, VERSION = b"RIDS", 1

#: Pieces whose ids a worker remembers, bytes of long ones among them, and keys per index bucket (on average).
CACHED_PIECES = 500_000
CACHED_BYTES = 32 << 20
BUCKET_KEYS = 50_000
READ_BYTES = 4 << 20

# ASCII, Latin-1, Latin Extended-A but for the dotted capital I, and general punctuation; their letters
# and numbers.
_SIMPLE = "[\t-\r -~\xa0-\u012f\u0131-\u017f\u2010-\u2027\u2030-\u205e]"
_LETTERS = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f"
_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"


def _header(width: int) -> bytes:
    return struct.pack("<4sHHQ", MAGIC, VERSION, width, 0)


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it; Spark's ``file:/x`` and plain paths are shared local folders."""
    local = re.sub(r"^file:/+", "/", path)
    if local.startswith("/"):
        return fs.LocalFileSystem(), local
    return fs.FileSystem.from_uri(path)


def _simple_letters() -> tuple[np.ndarray, np.ndarray]:
    """Classes of the characters whose case and kind are the tokenizer's by :data:`_SIMPLE`, and their lower case."""
    classes = np.full(CLASSED, UNKNOWN, np.uint8)
    lower = np.arange(CLASSED, dtype=np.uint32)
    for kind, rule in ((OTHER, _SIMPLE), (LETTER, f"[{_LETTERS}]"), (NUMBER, f"[{_NUMBERS}]"), (SPACE, r"\s")):
        matches = re.compile(rule).fullmatch
        for point in range(0x2100):
            if classes[point] != UNKNOWN or kind == OTHER:
                if matches(chr(point)):
                    classes[point] = kind
    for point in np.flatnonzero(classes != UNKNOWN):
        lower[point] = ord(chr(point).lower())
    return classes, lower


class PieceEncoder:
    """Ids of texts as bytes. The tokenizer works inside pieces of words, so ids of pieces seen before are looked up.

    The tokenizer cuts a lower-cased text into contractions, runs of letters, single digits and runs of other characters,
    and encodes each by itself. Texts of Latin letters, digits and punctuation, on which Python's rules for
    case and letters are the tokenizer's, are cut here; any other text goes through the tokenizer whole.

    Ids of known pieces lie one after another in ``pool``; a piece's number tells where.
    """

    def __init__(self, tokenizer_json: str, width: int):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        # The same vocabulary and merges for pieces, which are lower-cased and cut already.
        self.pieces = Tokenizer.from_str(tokenizer_json)
        self.pieces.normalizer = normalizers.Sequence([])
        self.pieces.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.kind = np.dtype(f"<u{width}")
        classes, lower = _simple_letters()
        if not _cuts_so(tokenizer_json):
            classes[:] = UNKNOWN
        self.cutter = Cutter(classes, join_space=False, lower=lower, specials=special_strings(tokenizer_json))
        self.lookup = PieceLookup(self._remember, limit=CACHED_PIECES, limit_bytes=CACHED_BYTES, forget=self._empty)
        self._empty()

    def _empty(self) -> None:
        self.pool, self.used = np.zeros(1 << 16, self.kind), 0
        self.begin, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _remember(self, pieces: list[bytes]) -> list[int]:
        """Numbers of new pieces, whose ids join the pool."""
        found = self.pieces.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)
        ids = [e.ids for e in found]
        lengths = np.array([len(x) for x in ids], np.int64)
        need = self.used + int(lengths.sum())
        if need > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(need, self.kind)])
        first = len(self.begin)
        self.begin = np.concatenate([self.begin, self.used + np.cumsum(lengths) - lengths])
        self.length = np.concatenate([self.length, lengths])
        self.pool[self.used : need] = np.concatenate([np.array(x, self.kind) for x in ids])
        self.used = need
        return list(range(first, first + len(pieces)))

    def _stretches(self, column: pa.Array) -> Iterator[tuple[int, bytes]]:
        """(text number, ids) of consecutive stretches of texts."""
        for raw, begin, text in slices_of(column):
            cut = self.cutter.cut(raw, begin)
            number = self.lookup.numbers(cut) if len(cut.starts) else np.zeros(0, np.int32)
            lengths = self.length[number]
            ends = np.cumsum(lengths)
            place = np.arange(int(lengths.sum())) + np.repeat(self.begin[number] - (ends - lengths), lengths)
            ids = self.pool[place].tobytes()
            upto = np.concatenate([[0], ends])[np.searchsorted(cut.owner, np.arange(len(text) + 1))] * self.kind.itemsize
            whole = set(cut.whole.tolist())
            stops = np.append(begin[1:], len(raw))
            for k, number_of in enumerate(text.tolist()):
                if k in whole:
                    part = raw[begin[k] : stops[k]].tobytes().decode()
                    own = self.tokenizer.encode(part, add_special_tokens=False).ids
                    yield number_of, np.array(own, self.kind).tobytes()
                else:
                    yield number_of, ids[upto[k] : upto[k + 1]]

    def encode(self, texts: list[str] | pa.Array) -> Iterator[bytes]:
        column = texts if isinstance(texts, pa.Array | pa.ChunkedArray) else pa.array(texts, pa.string())
        for _, parts in groupby(self._stretches(column), key=itemgetter(0)):
            yield b"".join(ids for _, ids in parts)


def _cuts_so(tokenizer_json: str) -> bool:
    """Whether a tokenizer lower-cases and cuts texts as PieceEncoder does."""
    told = json.loads(tokenizer_json)
    steps = (told.get("normalizer") or {}).get("normalizers", [])
    cuts = (told.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"] and bool(cuts) and cuts[0].get("pattern") == {
        "Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    }


_ENCODERS: dict[tuple[int, int], PieceEncoder] = {}


def _encoder(tokenizer_json: str, width: int) -> PieceEncoder:
    """The encoder of this worker process; what it remembers serves all tasks that the process runs."""
    key = (zlib.crc32(tokenizer_json.encode()), width)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = PieceEncoder(tokenizer_json, width)
    return _ENCODERS[key]


def _writer(tokenizer_json: str, folder: str, end_id: int, width: int):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = None, np.array([end_id], f"<u{width}").tobytes()
        shard = TaskContext.get().partitionId()
        name = f"{shard:06d}-{uuid.uuid4().hex}.ids"
        files, root = file_system(folder)
        out, at, nth = None, 0, 0
        for batch in batches:
            if out is None:
                encoder = _encoder(tokenizer_json.value, width)
                files.create_dir(root, recursive=True)
                out = files.open_output_stream(f"{root}/{name}")
                out.write(_header(width))
            for first in range(0, batch.num_rows, 1024):
                part = batch.slice(first, 1024)
                lengths, offsets = [], []
                for payload in encoder.encode(part.column("text")):
                    out.write(payload + end)
                    offsets.append(at)
                    lengths.append(len(payload) // width + 1)
                    at += lengths[-1]
                n = len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([shard] * n, pa.int32()),
                        pa.array([name] * n),
                        pa.array(range(nth, nth + n), pa.int64()),
                        pa.array(offsets, pa.int64()),
                        pa.array(lengths, pa.int64()),
                    ],
                    names=["doc_id", "shard", "file", "nth", "offset", "n_tokens"],
                )
                nth += n
        if out is not None:
            out.close()

    return write


def write_store(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, order: list[Column] | None = None
) -> None:
    """Encode all documents and write the store's four parts under ``path`` (a new folder).

    ``order``: the order of the ids in the files; by default ascending doc_id, null last.
    """
    spark = docs.sparkSession
    ship_package(spark)
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer_json = file.read()
    from tokenizers import Tokenizer

    width = 2 if max(Tokenizer.from_str(tokenizer_json).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    order = order or [F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64("text")]
    sort = [F.col(f"by{k}") for k in range(len(order))]
    rows = docs.select(
        F.col("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        *[c.alias(f"by{k}") for k, c in enumerate(order)],
    )
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    (
        rows.repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .select("doc_id", "text")
        .mapInArrow(
            _writer(spark.sparkContext.broadcast(tokenizer_json), f"{path}/ids", end_id, width),
            f"doc_id {doc_type}, shard int, file string, nth long, offset long, n_tokens long",
        )
        .write.parquet(f"{path}/encoded")
    )
    encoded = spark.read.parquet(f"{path}/encoded")
    # One row per payload file.
    files = encoded.groupBy("shard", "file").agg(
        F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_docs")
    )
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    files.withColumn("start", F.sum("n_tokens").over(before) - F.col("n_tokens")).withColumn(
        "width", F.lit(width)
    ).write.parquet(f"{path}/shards")
    # ``repeat`` is the number of earlier rows of the same doc_id in the store.
    slim = encoded.select("doc_id", "shard", "nth", "offset", "n_tokens")
    numbered = ranked(slim, [F.col("shard"), F.col("nth")], out="repeat", by=["doc_id"])
    numbered.write.parquet(f"{path}/entries")
    drop_paths(spark, [f"{path}/encoded"])
    _write_index(spark.read.parquet(f"{path}/entries"), path)


def key_hashes(doc_id: Column, repeat: Column) -> list[Column]:
    """Two independent 64-bit hashes of a key: the first places it, the second is its fingerprint."""
    return [
        F.xxhash64(doc_id, repeat).alias("k1"),
        F.xxhash64(F.lit("fingerprint"), repeat, doc_id).alias("k2"),
    ]


# --- minimal perfect hashing ---------------------------------------------------------------------------------------

_LEVEL_SEEDS = [(k * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64 for k in range(64)]


def _level_places(k1: np.ndarray, k2: np.ndarray, level: int, size: int) -> np.ndarray:
    x = k1 ^ (k2 * np.uint64(_LEVEL_SEEDS[level] | 1))
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    return (x % np.uint64(size)).astype(np.int64)


def build_hash(k1: np.ndarray, k2: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Level sizes and bits of a minimal perfect hash of distinct keys.

    Each level throws the remaining keys on twice as many bits; keys that are alone on theirs stay.
    """
    sizes, bits = [], []
    left = np.arange(len(k1))
    while len(left):
        if len(sizes) == len(_LEVEL_SEEDS):
            raise ValueError("keys are not distinct")
        size = max(64, 2 * len(left))
        place = _level_places(k1[left], k2[left], len(sizes), size)
        alone = np.bincount(place, minlength=size) == 1
        sizes.append(size)
        bits.append(alone)
        left = left[~alone[place]]
    return sizes, np.concatenate(bits) if bits else np.zeros(0, bool)


def hash_places(k1: np.ndarray, k2: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """The number of each key, 0 to n - 1 without gaps for the keys the hash was built of; -1 if surely unknown."""
    rank = np.cumsum(bits) - 1
    result = np.full(len(k1), -1, np.int64)
    left, begin = np.arange(len(k1)), 0
    for level, size in enumerate(sizes):
        place = begin + _level_places(k1[left], k2[left], level, size)
        here = bits[place]
        result[left[here]] = rank[place[here]]
        left, begin = left[~here], begin + size
    return result


_SLOT = np.dtype([("fingerprint", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("n_tokens", "<u8")])


def _fingerprint(k2: np.ndarray) -> np.ndarray:
    return (k2 >> np.uint64(32)).astype(np.uint32)


def _write_index(entries: DataFrame, path: str) -> None:
    spark = entries.sparkSession
    buckets = max(1, -(-entries.count() // BUCKET_KEYS))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        k1, k2 = rows["k1"].to_numpy().view(np.uint64), rows["k2"].to_numpy().view(np.uint64)
        sizes, bits = build_hash(k1, k2)
        slots = np.zeros(len(rows), _SLOT)
        at = hash_places(k1, k2, sizes, bits)
        slots["fingerprint"][at] = _fingerprint(k2)
        for name in ("shard", "offset", "n_tokens"):
            slots[name][at] = rows[name].to_numpy()
        told = (int(rows["bucket"].iloc[0]), len(rows), sizes, np.packbits(bits).tobytes(), slots.tobytes())
        return pd.DataFrame([told], columns=["bucket", "n_keys", "sizes", "bits", "slots"])

    keyed = entries.select(*key_hashes(F.col("doc_id"), F.col("repeat")), "shard", "offset", "n_tokens")
    (
        keyed.withColumn("bucket", F.pmod("k1", F.lit(buckets)))
        .groupBy("bucket")
        .applyInPandas(build, "bucket long, n_keys long, sizes array<long>, bits binary, slots binary")
        .withColumn("buckets", F.lit(buckets))
        .write.parquet(f"{path}/index")
    )


def look_up(keys: DataFrame, path: str) -> DataFrame:
    """(doc_id, repeat, shard, offset, n_tokens) for keys (doc_id, repeat), which must be distinct.

    A key that the store does not hold gives no row, but for a chance of 2**-32 per key.
    """
    spark = keys.sparkSession
    ship_package(spark)
    index = spark.read.parquet(f"{path}/index")
    one = index.select("buckets").first()
    doc_type = keys.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_type}, repeat long, shard long, offset long, n_tokens long"
    if one is None:
        return spark.createDataFrame([], schema)

    def answer(rows: pa.Table, bucket: pa.Table) -> pa.Table:
        shard, offset, length = (np.zeros(0, np.int64) for _ in range(3))
        good = np.zeros(0, np.int64)
        if bucket.num_rows and rows.num_rows:
            k1, k2 = (rows.column(c).to_numpy().view(np.uint64) for c in ("k1", "k2"))
            sizes = bucket.column("sizes")[0].as_py()
            bits = np.unpackbits(np.frombuffer(bucket.column("bits")[0].as_py(), np.uint8))[: sum(sizes)].astype(bool)
            slots = np.frombuffer(bucket.column("slots")[0].as_py(), _SLOT)
            at = hash_places(k1, k2, sizes, bits)
            good = np.flatnonzero((at >= 0) & (slots["fingerprint"][at] == _fingerprint(k2)))
            found = slots[at[good]]
            shard, offset, length = (found[n].astype(np.int64) for n in ("shard", "offset", "n_tokens"))
        kept = rows.select(["doc_id", "repeat"]).take(pa.array(good))
        return pa.table(
            {
                "doc_id": kept.column("doc_id"),
                "repeat": kept.column("repeat"),
                "shard": pa.array(shard),
                "offset": pa.array(offset),
                "n_tokens": pa.array(length),
            }
        )

    placed = keys.select(
        "doc_id", F.col("repeat").cast("long").alias("repeat"), *key_hashes(F.col("doc_id"), F.col("repeat").cast("long"))
    ).withColumn("bucket", F.pmod("k1", F.lit(one[0])))
    return (
        placed.groupBy("bucket")
        .cogroup(index.select("bucket", "sizes", "bits", "slots").groupBy("bucket"))
        .applyInArrow(answer, schema)
    )


def read_ids(places: DataFrame, path: str, payload: bool = True) -> DataFrame:
    """Places found by :func:`look_up` with ``start`` (ids of all documents before), the ids' crc and, unless
    ``payload`` is false, the ids themselves (little-endian u4)."""
    spark = places.sparkSession
    ship_package(spark)
    # One row per payload file.
    shards = spark.read.parquet(f"{path}/shards").select("shard", "file", F.col("start").alias("before"), "width")
    doc_type = places.schema["doc_id"].dataType.simpleString()
    ids_folder = f"{path}/ids"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = file_system(ids_folder)
        name, source, held, held_at, width = None, None, b"", 0, 2
        for whole, first in ((b, k) for b in batches for k in range(0, b.num_rows, 512)):
            batch = whole.slice(first, 512)
            columns = {c: batch.column(c).to_pylist() for c in ("file", "offset", "n_tokens", "width")}
            payloads, crcs = [], []
            for file, offset, count, width in zip(*columns.values(), strict=True):
                if file != name:
                    if source is not None:
                        source.close()
                    name, source, held, held_at = file, files.open_input_file(f"{root}/{file}"), b"", 0
                    if source.read_at(HEADER_BYTES, 0) != _header(width):
                        raise ValueError(f"{file} is not a payload file of this version")
                begin, size = HEADER_BYTES + offset * width, count * width
                if not held_at <= begin or begin + size > held_at + len(held):
                    held, held_at = source.read_at(max(size, READ_BYTES), begin), begin
                own = memoryview(held)[begin - held_at : begin - held_at + size]
                wide = np.frombuffer(own, f"<u{width}").astype("<u4").tobytes()
                payloads.append(wide if payload else None)
                crcs.append(zlib.crc32(wide))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", "repeat", "start", "n_tokens")),
                    pa.array(crcs, pa.int64()),
                    pa.array(payloads, pa.binary()),
                ],
                names=["doc_id", "repeat", "start", "n_tokens", "ids_crc32", "ids"],
            )
        if source is not None:
            source.close()

    return (
        places.join(F.broadcast(shards), "shard")
        .withColumn("start", F.col("before") + F.col("offset"))
        .repartitionByRange("start")
        .sortWithinPartitions("start")
        .select("doc_id", "repeat", "start", "n_tokens", "file", "offset", "width")
        .mapInArrow(read, f"doc_id {doc_type}, repeat long, start long, n_tokens long, ids_crc32 long, ids binary")
    )


def stored_keys(spark: SparkSession, path: str) -> DataFrame:
    """The keys (doc_id, repeat) of all stored documents."""
    return spark.read.parquet(f"{path}/entries").select("doc_id", "repeat")


def token_digest(
    docs: DataFrame, path: str, tokenizer_path: str, order: list[Column] | None = None
) -> DataFrame:
    """Write the store, look every document up in its index and digest what the files hold."""
    write_store(docs, path, tokenizer_path, order=order)
    found = look_up(stored_keys(docs.sparkSession, path), path)
    return read_ids(found, path, payload=False).select("doc_id", "start", "n_tokens", "ids_crc32")
