"""Near duplicates by fast similarity sketching, banding and exact verification.

A document's set holds its distinct runs of a few words. Rounds of hashing place the elements of a set in
bins: in the first T rounds each element gets a hashed bin, in the next T round k fills bin k for certain, and a bin
keeps its least (round, hash) value. A set is done once all bins are filled, so large sets need one
round or two, small ones a few more, and every bin agrees between two sets with a chance equal to their
similarity, with the concentration of independent draws. Bins are joined to bands; sets that share a
band are candidates, and candidates are confirmed on full sets.

Equal sets are one class, whatever the number of their copies. In a bucket, members are compared with
one pivot, the class that meets the most others. Only members that then still belong to different components,
and have enough runs in common with any others at all, are compared with one another: no bucket is expanded to
all its pairs, and no link between components is lost.

Defined cases: texts without words (and null) have an empty set and are linked with nothing; null doc_ids take
part, but a component is named by its smallest id that is not null (none: null); repeated ids and rows are
documents of their own; an empty table gives no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import ship_package
from rollcall.llm.wordnum import U64, mix64, text_shingles
from rollcall.session import materialize

#: Bins of a sketch and bins of a band. At a similarity of 0.8 a pair shares none of the 32 bands with a
#: chance of (1 - 0.8**4)**32 < 5e-8.
BINS = 128
BAND_ROWS = 4
BANDS = BINS // BAND_ROWS

#: Candidates that agree on fewer bins are not looked at in full: at 0.8 the chance of so few is below 1e-7.
MIN_AGREEING_BINS = 77

#: Both are laid for this similarity; above it they miss fewer pairs still.
LEAST_PERCENT = 80

_SEEDS = mix64(np.arange(1, 2 * BINS + 1, dtype=U64) * U64(0xD1B54A32D192ED03))
_FIRST_KEY, _SECOND_KEY = U64(0x8CB92BA72F3D8DD7), U64(0xA0761D6478BD642F)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Fast similarity sketch of each set, one row of BINS values; sets must not be empty."""
    n = len(sets)
    filled = np.full((n, BINS), np.iinfo(np.uint64).max, U64)
    active = np.arange(n)
    for r in range(2 * BINS):
        if not len(active):
            break
        elements = np.concatenate([sets[k] for k in active])
        sizes = np.array([len(sets[k]) for k in active])
        hashed = mix64(elements ^ _SEEDS[r])
        value = (U64(r) << U64(56)) | (hashed & U64((1 << 56) - 1))
        owner = np.repeat(active, sizes)
        if r < BINS:
            np.minimum.at(filled.reshape(-1), owner * BINS + (hashed >> U64(57)).astype(np.int64), value)
        else:
            first = np.zeros(len(active), np.int64)
            np.cumsum(sizes[:-1], out=first[1:])
            filled[active, r - BINS] = np.minimum(filled[active, r - BINS], np.minimum.reduceat(value, first))
        active = active[(filled[active] == np.iinfo(np.uint64).max).any(axis=1)]
    return filled


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """One number for each band of each sketch; equal only where band and bins are equal."""
    bands = sketch.reshape(len(sketch), BANDS, BAND_ROWS)
    key = np.broadcast_to(_SEEDS[:BANDS], (len(sketch), BANDS)).copy()
    for k in range(BAND_ROWS):
        key = mix64(key ^ bands[:, :, k])
    return key


def _describe(width: int):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, done = [], 0

            def flush(sets, done):
                full = [k for k, s in enumerate(sets) if len(s)]
                sketch = sketches([sets[k] for k in full]) if full else np.zeros((0, BINS), U64)
                keys = band_keys(sketch).astype(np.int64)
                tags = (sketch & U64(0xFF)).astype(np.uint8)
                nodes: list[bytes | None] = [None] * len(sets)
                bands: list[np.ndarray | None] = [None] * len(sets)
                tag: list[bytes | None] = [None] * len(sets)
                for row, k in enumerate(full):
                    s = sets[k]
                    one = mix64(s ^ _FIRST_KEY).sum(dtype=U64)
                    two = np.bitwise_xor.reduce(mix64(s ^ _SECOND_KEY))
                    nodes[k] = one.tobytes() + two.tobytes()
                    bands[k] = keys[row]
                    tag[k] = tags[row].tobytes()
                own = batch.slice(done, len(sets))
                return pa.RecordBatch.from_arrays(
                    [
                        own.column("doc_id"),
                        own.column("r1"),
                        own.column("r2"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(nodes, pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                        pa.array(tag, pa.binary()),
                    ],
                    names=["doc_id", "r1", "r2", "n_shingles", "node", "bands", "tags"],
                )

            held = 0
            for s in text_shingles(batch.column("text"), width):
                sets.append(s)
                held += len(s)
                if held > 200_000:
                    yield flush(sets, done)
                    done += len(sets)
                    sets, held = [], 0
            if sets:
                yield flush(sets, done)

    return describe


def _exploded(width: int):
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nids = batch.column("nid").to_numpy()
            for k, runs in enumerate(text_shingles(batch.column("text"), width)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(runs), nids[k])), pa.array(runs.view(np.int64))], names=["nid", "run"]
                )

    return explode


def _ordered(a: Column, b: Column) -> list[Column]:
    """A pair with its smaller class first."""
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sketches agree well enough."""
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS) for c in ("ta", "tb")
        )
        good = np.flatnonzero((a == b).sum(axis=1) >= MIN_AGREEING_BINS)
        yield batch.select(["a", "b"]).take(pa.array(good))


def _confirmed(width: int, percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            pairs = zip(text_shingles(batch.column("xa"), width), text_shingles(batch.column("xb"), width), strict=True)
            for k, (a, b) in enumerate(pairs):
                common = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * common >= percent * (len(a) + len(b) - common):
                    good.append(k)
            yield batch.select(["a", "b"]).take(pa.array(good, pa.int64()))

    return confirm


def row_keys(docs: DataFrame) -> DataFrame:
    """doc_id and text with two hashes that name the row (equal rows share them)."""
    return docs.select(
        F.col("doc_id"),
        F.col("text"),
        F.xxhash64("doc_id", "text").alias("r1"),
        F.xxhash64("text", "doc_id", F.lit(1)).alias("r2"),
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node that each node of an edge list (a, b) can reach.

    Labels spread to neighbours and jump to their label's label, so chains shorten by halves. Each pass is
    written to the shared folder; only a count of changes comes to the driver.
    """
    spark = edges.sparkSession
    both = materialize(
        edges.select("a", "b")
        .union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .union(edges.select("a", F.col("a").alias("b")))
        .union(edges.select(F.col("b").alias("a"), "b"))
        .distinct(),
        "links",
    )
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("comp")), "labels")
    while True:
        spread = (
            both.join(labels, both.b == labels.node)
            .groupBy("a")
            .agg(F.min("comp").alias("comp"))
        )
        far = labels.select(F.col("node").alias("comp"), F.col("comp").alias("far"))
        before = labels.select(F.col("node").alias("a"), F.col("comp").alias("before"))
        moved = materialize(
            spread.join(far, "comp").join(before, "a").select(
                F.col("a").alias("node"), F.least("comp", "far").alias("comp"), "before"
            ),
            "labels",
        )
        labels = moved.select("node", "comp")
        if moved.filter("comp <> before").limit(1).count() == 0:
            return labels


def describe_sets(docs: DataFrame, width: int) -> DataFrame:
    """Per row: doc_id, row keys, n_shingles, node (name of its set; null if empty), bands, tags."""
    ship_package(docs.sparkSession)
    return row_keys(docs).mapInArrow(
        _describe(width),
        "doc_id long, r1 long, r2 long, n_shingles long, node binary, bands array<bigint>, tags binary",
    )


class _Search:
    """Classes of equal sets and what their comparisons need."""

    def __init__(self, docs: DataFrame, width: int, percent: int):
        if percent < LEAST_PERCENT:
            raise ValueError(f"bands and bins are laid for similarities of {LEAST_PERCENT} % or more, not {percent} %")
        self.width, self.percent = width, percent
        self.rows = materialize(describe_sets(docs, width), "near-rows")
        self.classes = materialize(
            self.rows.filter("node IS NOT NULL")
            .groupBy("node")
            .agg(
                F.min("doc_id").alias("id"),
                F.first("n_shingles").alias("n"),
                F.min(F.struct("r1", "r2")).alias("rep"),
                F.first("bands").alias("bands"),
                F.first("tags").alias("tags"),
            ),
            "near-classes",
        )
        banded = self.classes.select("node", F.explode("bands").alias("bucket"))
        sizes = banded.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
        met = materialize(banded.join(sizes, "bucket"), "near-met")
        # The class that meets the most others is most likely what the others were copied from.
        degree = met.groupBy("node").agg(F.sum(F.col("size") - 1).alias("degree"))
        ranked = met.select("bucket", "node").join(degree, "node")
        pivots = ranked.groupBy("bucket").agg(F.max(F.struct("degree", "node")).alias("top")).select(
            "bucket", F.col("top.degree").alias("degree"), F.col("top.node").alias("pivot")
        )
        self.members = materialize(met.select("bucket", "node").join(pivots, "bucket"), "near-members")
        involved = self.members.select("node").distinct()
        reps = self.classes.join(involved, "node", "left_semi").select("node", "rep.r1", "rep.r2")
        # Equal rows share their keys; one text per class is enough.
        self.texts = materialize(
            row_keys(docs).join(reps, ["r1", "r2"]).select("node", "text").dropDuplicates(["node"]), "near-texts"
        )

    def labelled(self, labels: DataFrame | None, df: DataFrame, node: str, comp: str) -> DataFrame:
        if labels is None:
            return df.withColumn(comp, F.col(node))
        renamed = labels.select(F.col("node").alias(node), F.col("comp").alias("_c"))
        return df.join(renamed, node, "left").withColumn(comp, F.coalesce("_c", node)).drop("_c")

    def open_pairs(self, labels: DataFrame) -> DataFrame:
        """Pairs of a bucket that belong to different components and can be similar.

        Runs are sorted by how many open classes have them, rarest first. If two sets have ``o`` runs in common
        or more, then among the first n - o + 1 of each there is a common one. Copies that changed too
        much to be linked to their base begin with their own changes, so they stay pairs only with copies
        that share a change. Pairs are formed by these first runs, not by bucket, and must also meet in a bucket.
        """
        owned = self.labelled(labels, self.members.select("bucket", "node"), "node", "comp")
        mixed = owned.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi")
        open_rows = materialize(owned.join(mixed.select("bucket"), "bucket", "left_semi"), "near-open")
        nodes = materialize(
            open_rows.groupBy("node")
            .agg(F.collect_set("bucket").alias("buckets"))
            .join(self.classes.select("node", "n"), "node")
            .withColumn("nid", F.monotonically_increasing_id()),
            "near-open-nodes",
        )
        runs = materialize(
            self.texts.join(nodes.select("node", "nid"), "node")
            .select("nid", "text")
            .mapInArrow(_exploded(self.width), "nid long, run long"),
            "near-open-runs",
        )
        times = runs.groupBy("run").agg(F.count("*").alias("times"))
        rarest = (
            runs.join(times, "run")
            .groupBy("nid")
            .agg(F.sort_array(F.collect_list(F.struct("times", "run"))).alias("sorted"))
            .select("nid", F.expr(f"transform(slice(sorted, 1, {self._prefix('size(sorted)', 'size(sorted)', 'least')}), x -> x.run)").alias("first"))
        )
        comps = open_rows.groupBy("node").agg(F.first("comp").alias("comp"))
        told = nodes.join(rarest, "nid").join(comps, "node")
        left = materialize(
            told.select("node", "comp", "n", "buckets", F.posexplode("first").alias("at", "run")), "near-open-rows"
        )
        right = left.toDF(*[f"{c}_b" for c in left.columns])
        length, length_b = (self._prefix(own, other, "both") for own, other in (("n", "n_b"), ("n_b", "n")))
        return (
            left.join(
                right,
                F.expr(
                    f"run = run_b AND comp < comp_b"
                    f" AND 100 * least(n, n_b) >= {self.percent} * greatest(n, n_b)"
                    f" AND at < {length} AND at_b < {length_b}"
                    f" AND arrays_overlap(buckets, buckets_b)"
                ),
            )
            .select(*_ordered(F.col("node"), F.col("node_b")))
            .distinct()
        )

    def _prefix(self, own: str, other: str, kind: str) -> str:
        """SQL of the number of first runs in which a set of ``own`` runs must meet one of ``other`` runs.

        ``least``: whatever the other's size, which is percent / 100 of the own at least.
        """
        p = self.percent
        least = f"({p} * {own} + 99) div 100" if kind == "least" else f"({p} * ({own} + {other}) + {99 + p}) div {100 + p}"
        return f"CAST({own} - ({least}) + 1 AS INT)"

    def confirm(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) of classes that are similar, by sketch first and then on full sets."""
        tags = self.classes.select("node", "n", "tags")
        sized = (
            pairs.join(tags.toDF("a", "na", "ta"), "a")
            .join(tags.toDF("b", "nb", "tb"), "b")
            .filter(100 * F.least("na", "nb") >= self.percent * F.greatest("na", "nb"))
            .select("a", "b", "ta", "tb")
        )
        likely = sized.mapInArrow(_alike, "a binary, b binary")
        return materialize(
            likely.join(self.texts.toDF("a", "xa"), "a")
            .join(self.texts.toDF("b", "xb"), "b")
            .mapInArrow(_confirmed(self.width, self.percent), "a binary, b binary"),
            "near-edges",
        )


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: doc_id, r1, r2, n_shingles, node, comp (null without words), component_id, kept.

    Documents are linked if 100 * intersection >= percent * union of their sets of ``width``-word runs.
    """
    search = _Search(docs, width, percent)
    nearest = (
        search.members.filter(F.col("node") != F.col("pivot"))
        .groupBy("node")
        .agg(F.max(F.struct("degree", "pivot")).alias("top"))
        .select(*_ordered(F.col("node"), F.col("top.pivot")))
        .distinct()
    )
    first = materialize(nearest, "near-pairs")
    edges = search.confirm(first)
    labels = components(edges)

    # Pivots of the other buckets, where they still lead to another component.
    open_pairs = search.labelled(
        labels, search.labelled(labels, search.members, "node", "ca"), "pivot", "cb"
    ).filter("ca <> cb")
    second = materialize(
        open_pairs.select(*_ordered(F.col("node"), F.col("pivot"))).distinct().join(first, ["a", "b"], "left_anti"),
        "near-pairs",
    )
    edges = edges.union(search.confirm(second))
    labels = components(edges)

    # What still shares a bucket across components was compared with the pivot only.
    third = search.open_pairs(labels).join(first.union(second), ["a", "b"], "left_anti")
    edges = edges.union(search.confirm(third))
    labels = materialize(components(edges), "near-labels")

    named = search.labelled(labels, search.classes.select("node", "id"), "node", "comp")
    ids = named.groupBy("comp").agg(F.min("id").alias("component_id"))
    of_node = materialize(named.select("node", "comp").join(ids, "comp"), "near-components")
    plain = search.rows.select("doc_id", "r1", "r2", "n_shingles", "node")
    joined = plain.filter("node IS NOT NULL").join(of_node, "node").select(
        "doc_id", "r1", "r2", "n_shingles", "node", "comp", "component_id"
    )
    alone = plain.filter("node IS NULL").select(
        "doc_id", "r1", "r2", "n_shingles", "node", F.col("node").alias("comp"), F.col("doc_id").alias("component_id")
    )
    return joined.union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The input rows without near duplicates: one row of each component, and every row without words."""
    found = near_duplicates(docs, width, percent).filter("comp IS NOT NULL")
    last = F.coalesce(F.col("doc_id"), F.lit((1 << 63) - 1))
    chosen = (
        found.groupBy("comp")
        .agg(F.min(F.struct(last.alias("id"), "r1", "r2")).alias("best"))
        .select(F.col("best.r1").alias("r1"), F.col("best.r2").alias("r2"))
    )
    wordy = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    rows = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
        wordy.alias("wordy"),
        F.xxhash64("doc_id", "text").alias("r1"),
        F.xxhash64("text", "doc_id", F.lit(1)).alias("r2"),
    )
    equal = Window.partitionBy("r1", "r2").orderBy("r1")
    kept = (
        rows.filter("wordy").join(chosen, ["r1", "r2"]).withColumn("nth", F.row_number().over(equal)).filter("nth = 1")
    )
    return kept.select("row.*").union(rows.filter("NOT wordy").select("row.*"))
