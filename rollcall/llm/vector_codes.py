"""Vector code compression: four bytes a vector, from codebooks of Lloyd rounds that compare active entries only.

Components are integers floor(1024 * x); vectors are cut into PARTS equal parts, each with its own codebook of up to
ENTRIES entries, which starts as that part of the smallest vec_ids. A round assigns every part to its nearest entry and
replaces each entry by the floor of its parts' mean.

Each round is one pass that keeps, for every part, its entry and the exact squared distance to it. In the next round only entries
that moved are active: a part whose own entry stayed can only change to a moved one, so it is compared with those and its
stored distance; a part whose own entry moved is compared with all. Equal distances go to the lower index either way, so the
codes are those of a full scan. A pass writes rows and its tasks' sums to the shared folder, and reads nothing but the pass before it;
the driver holds the codebooks only. Distances are matrix products in floating point where all values are exact there, and whole numbers
otherwise.

Defined cases: vectors that are null or hold a null or non-finite component are dropped, and so are empty ones, those whose length is no
multiple of PARTS and those of another length than the first seed's, which no codebook fits. Components beyond +-2**40 count as that,
and distances beyond 2**63 - 1 as that. Null vec_ids come last; rows with equal vec_ids are ordered by their components and
coded each by itself. Fewer rows than ENTRIES make smaller codebooks, an empty table an empty result. Only ``vec_id``, ``embedding`` and
``label`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import ship_package
from rollcall.session import drop_paths, scratch_path

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
LIMIT = 1 << 40
LONGEST = (1 << 63) - 1

#: Rows of a batch that are compared at once.
BLOCK = 4096

#: Sums of labels are broadcast up to this many labels, and joined by salted labels beyond.
BROADCAST_LABELS = 100_000
SALTS = 32


def components(vector: Column) -> Column:
    """Integer components of a vector."""
    bound = F.lit(float(LIMIT))
    scaled = lambda x: F.greatest(F.least(F.floor(x.cast("double") * SCALE).cast("double"), bound), -bound)
    return F.transform(vector, lambda x: scaled(x).cast("long"))


def kept_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, v) of the rows that can be coded, but for their length."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    vector = F.col("embedding")
    whole = (F.size(vector) > 0) & (F.size(vector) % PARTS == 0)
    rows = vectors.where(vector.isNotNull() & whole & F.forall(vector, finite))
    return rows.select("vec_id", "label", components(vector).alias("v"))


# --- assignment ----------------------------------------------------------------------------------------------------


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to entries."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    worst = x.shape[1] * (2 * top) ** 2
    if worst < 1 << 53:
        a, b = x.astype(np.float64), entries.astype(np.float64)
        found = (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]
        return found.astype(np.int64)
    if worst <= LONGEST:
        return np.stack([((x - e) ** 2).sum(1) for e in entries], axis=1)
    a, b = x.astype(object), entries.astype(object)
    exact = np.stack([((a - e) ** 2).sum(1) for e in b], axis=1)
    return exact


def assign(
    x: np.ndarray, book: np.ndarray, moved: np.ndarray, code: np.ndarray | None, far: np.ndarray | None
) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each row and its squared distance; ``code`` and ``far`` are those of the round before.

    ``moved`` tells which entries differ from that round's.
    """
    n = len(x)
    new_code, new_far = np.zeros(n, np.int64), np.zeros(n, np.int64)
    # A distance at the bound may be cut off, so such rows are compared with all entries.
    stays = np.zeros(n, bool) if code is None else ~moved[code] & (far < LONGEST)
    rescan, active = np.flatnonzero(~stays), np.flatnonzero(stays)
    if len(rescan):
        found = distances(x[rescan], book)
        new_code[rescan] = found.argmin(1)
        new_far[rescan] = np.minimum(found[np.arange(len(rescan)), new_code[rescan]], LONGEST)
    if len(active):
        new_code[active], new_far[active] = code[active], far[active]
        changed = np.flatnonzero(moved)
        if len(changed):
            found = distances(x[active], book[changed])
            best = found.argmin(1)
            least, entry = found[np.arange(len(active)), best], changed[best]
            own, own_code = far[active], code[active]
            better = (least < own) | ((least == own) & (entry < own_code))
            new_code[active[better]] = entry[better]
            new_far[active[better]] = least[better].astype(np.int64)
    return new_code, new_far


@dataclass(frozen=True)
class Books:
    """Codebooks (part, entry, place) of a round and which entries moved since the round before."""

    entries: np.ndarray
    moved: np.ndarray


_ROW = "vec_id {id}, label {label}, v array<long>, code binary, far array<long>"
_SUM = "part int, entry int, n long, total array<long>"


def _sum_rows(sums: np.ndarray, counts: np.ndarray) -> list[pa.Array]:
    part, entry = np.nonzero(counts)
    totals = sums[part, entry]
    ends = np.arange(len(part) + 1, dtype=np.int32) * sums.shape[2]
    return [
        pa.array(part, pa.int32()),
        pa.array(entry, pa.int32()),
        pa.array(counts[part, entry], pa.int64()),
        pa.ListArray.from_arrays(pa.array(ends), pa.array(totals.reshape(-1), pa.int64())),
    ]


def _passing(books, width: int, names: list[str], with_sums: bool):
    """A task's pass over its rows: rows with their new entries and, at the end, the sums of each entry's parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book: Books = books.value
        shape = (PARTS, book.entries.shape[1], width)
        sums, counts = np.zeros(shape, np.int64), np.zeros(shape[:2], np.int64)
        schema, room = None, LONGEST

        def summed() -> pa.RecordBatch:
            told = _sum_rows(sums, counts)
            n = len(told[0])
            lead = [pa.nulls(n, schema.field(c).type) for c in names]
            return pa.RecordBatch.from_arrays(lead + told, names=[*names, "part", "entry", "n", "total"])

        for whole in batches:
            for first in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(first, BLOCK)
                n = batch.num_rows
                x = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(n, PARTS, width)
                code = far = None
                if "code" in batch.schema.names:
                    code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(n, PARTS)
                    far = batch.column("far").flatten().to_numpy().reshape(n, PARTS)
                new_code, new_far = np.zeros((n, PARTS), np.int64), np.zeros((n, PARTS), np.int64)
                for p in range(PARTS):
                    before = (None, None) if code is None else (code[:, p].astype(np.int64), far[:, p])
                    new_code[:, p], new_far[:, p] = assign(x[:, p], book.entries[p], book.moved[p], *before)
                ends = pa.array(np.arange(n + 1, dtype=np.int32) * PARTS)
                codes = new_code.astype(np.uint8).tobytes()
                columns = [
                    batch.column("vec_id"),
                    batch.column("label"),
                    batch.column("v"),
                    pa.array([codes[PARTS * k : PARTS * (k + 1)] for k in range(n)], pa.binary()),
                    pa.ListArray.from_arrays(ends, pa.array(new_far.reshape(-1))),
                ]
                if not with_sums:
                    columns.pop(2)
                    yield pa.RecordBatch.from_arrays(columns, names=names)
                    continue
                told = pa.RecordBatch.from_arrays(columns, names=names)
                schema = told.schema
                none = [pa.nulls(n, t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns + none, names=[*names, "part", "entry", "n", "total"])
                # Sums stay within 64 bits: they are handed on before they could leave them.
                need = n * int(np.abs(x).max(initial=0))
                if need > room:
                    yield summed()
                    sums[:], counts[:], room = 0, 0, LONGEST
                room -= need
                for p in range(PARTS):
                    order = np.argsort(new_code[:, p], kind="stable")
                    entry, begin = np.unique(new_code[order, p], return_index=True)
                    sums[p, entry] += np.add.reduceat(x[order, p], begin, axis=0)
                    counts[p, entry] += np.diff(np.append(begin, n))
        if with_sums and schema is not None:
            yield summed()

    return run


def _moved_books(state: DataFrame, books: Books, width: int) -> Books:
    """The next round's codebooks: floors of the means; entries without parts stay."""
    exact = "decimal(38,0)"
    sums = (
        state.where(F.col("part").isNotNull())
        .groupBy("part", "entry")
        .agg(F.sum("n").alias("n"), *[F.sum(F.col("total")[k].cast(exact)).alias(f"s{k}") for k in range(width)])
    )
    entries = books.entries.copy()
    # At most PARTS * ENTRIES rows.
    for row in sums.collect():
        entries[row["part"], row["entry"]] = [int(row[f"s{k}"]) // row["n"] for k in range(width)]
    return Books(entries, (entries != books.entries).any(axis=2))


def _add_label_sums(coded: DataFrame) -> DataFrame:
    """Add ``label_error``, the errors summed over the rows of a label; missing labels are one label."""
    exact = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = coded.groupBy("label").agg(F.least(exact, F.lit(LONGEST).cast("decimal(38,0)")).cast("long").alias("label_error"))
    sums = sums.withColumnRenamed("label", "of")
    same = F.col("label").eqNullSafe(F.col("of"))
    if sums.count() <= BROADCAST_LABELS:
        return coded.join(F.broadcast(sums), same).drop("of")
    salted = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)))
    copies = sums.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(copies, same & (F.col("salt") == F.col("copy"))).drop("of", "salt", "copy")


def coded_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every row that can be coded."""
    spark = vectors.sparkSession
    ship_package(spark)
    kept = kept_vectors(vectors)
    kinds = {"id": vectors.schema["vec_id"].dataType.simpleString(), "label": vectors.schema["label"].dataType.simpleString()}
    first = [F.col("vec_id").isNull(), "vec_id", "v"]
    lead = kept.orderBy(*first).limit(1).collect()
    if not lead:
        none = f"vec_id {kinds['id']}, code string, error long, label_error long, codebooks_sha256 string"
        return spark.createDataFrame([], none)
    length = len(lead[0]["v"])
    width = length // PARTS
    kept = kept.where(F.size("v") == length)
    # At most ENTRIES rows.
    seeds = np.array([r["v"] for r in kept.orderBy(*first).limit(ENTRIES).collect()], np.int64)
    entries = seeds.reshape(len(seeds), PARTS, width).transpose(1, 0, 2).copy()
    books = Books(entries, np.ones(entries.shape[:2], bool))
    row = _ROW.format(**kinds)
    names = ["vec_id", "label", "v", "code", "far"]
    state, path = kept, None
    for _ in range(ROUNDS):
        sent = spark.sparkContext.broadcast(books)
        following = scratch_path(spark, "vector-codes")
        state.mapInArrow(_passing(sent, width, names, True), f"{row}, {_SUM}").write.parquet(following)
        if path is not None:
            drop_paths(spark, [path])
        path = following
        written = spark.read.parquet(path)
        books = _moved_books(written, books, width)
        state = written.where(F.col("part").isNull()).select(*names)
    sent = spark.sparkContext.broadcast(books)
    final = scratch_path(spark, "vector-codes")
    short = row.replace("v array<long>, ", "")
    state.mapInArrow(_passing(sent, width, [n for n in names if n != "v"], False), short).write.parquet(final)
    drop_paths(spark, [path])
    error = F.aggregate(F.col("far"), F.lit(0).cast("decimal(38,0)"), lambda s, x: (s + x).cast("decimal(38,0)"))
    coded = spark.read.parquet(final).select(
        "vec_id", "label", F.lower(F.hex("code")).alias("code"), F.least(error, F.lit(LONGEST)).cast("long").alias("error")
    )
    digest = hashlib.sha256(",".join(map(str, books.entries.reshape(-1).tolist())).encode()).hexdigest()
    return _add_label_sums(coded).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
