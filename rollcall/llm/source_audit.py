"""Source divergence audit: how far the term shares of every two sources of a language lie apart.

Terms are runs of ASCII letters and non-ASCII characters, A-Z lower-cased. A language keeps the terms that stand in MIN_DOCUMENTS of its
documents; every (lang, source) group, and the language as a whole, gives each kept term the smoothed share
1 + floor(10**9 * (count + 2) / (N + 2 V)) with N its occurrences of kept terms and V the number of kept terms. Two shares p
and q differ by floor((p - q)**2 / (p + q)).

Counting: tasks add up terms per group before anything is shuffled. Pairs: a group's counts are arrays sorted by term number, cut into
slices of SLICE numbers; for every unordered pair of sources the two groups' slices are co-grouped, the shorter array is looked up in
the longer one, and terms of both, of the left only and of the right only are priced in both directions at once (the price is
symmetric). Terms that neither group has all cost the same, so they are counted, not listed. A task holds two slices, however
large the groups are.

All arithmetic is on whole numbers: exact up to 2 * 10**14 occurrences a group.

Defined cases: null text, lang and source are empty strings; groups whose texts have no term take part with all counts 0; a language
without kept terms has value 0 for every pair and no term rows; equal values are ranked by the item's UTF-8 bytes; repeated rows are
documents of their own; an empty table gives an empty result. Very long texts are worked on in parts and count as one document.
Only ``text``, ``lang`` and ``source`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import ship_package
from rollcall.llm.pieces import PieceLookup, Pieces, slices_of
from rollcall.operators.ordering import ranked
from rollcall.session import materialize

MIN_DOCUMENTS = 10
TOP_TERMS = 10

#: Term numbers of a slice of a group.
SLICE = 1 << 16

#: (text, term) entries that a task holds before it adds them up, and (group, term) entries before it hands them on.
PENDING, HELD = 500_000, 1_000_000

_INSIDE = np.zeros(256, dtype=bool)
_INSIDE[ord("a") : ord("z") + 1] = True
_INSIDE[ord("A") : ord("Z") + 1] = True
_INSIDE[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


# --- counting ------------------------------------------------------------------------------------------------------


def term_spans(raw: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and bytes of every term of consecutive segments."""
    inside = np.zeros(len(raw) + 1, bool)
    inside[:-1] = _INSIDE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[begins] = True
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:]
    closes = ~inside
    closes[1:] = inside[:-1] & (~inside[1:] | edge[1:])
    closes[0] = False
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) - starts


def _summed(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Different keys with the sums of their values."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    if not len(begin):
        return (key, *values)
    return (key[begin], *(np.add.reduceat(v[order], begin) for v in values))


class _TermCounts:
    """Occurrences and documents of terms per group, for one task."""

    def __init__(self):
        self.terms: list[bytes] = []
        self.groups: dict[tuple[str, str], int] = {}
        self.full = False
        self.lookup = PieceLookup(self._number, limit=HELD, forget=self._forget)
        self.held = [(np.zeros(0, np.int64),) * 3]

    def _number(self, spans: list[bytes]) -> list[int]:
        first = len(self.terms)
        self.terms += spans
        return list(range(first, len(self.terms)))

    def _forget(self) -> None:
        raise AssertionError("numbers are handed on before the lookup is full")

    def add(self, batch: pa.RecordBatch) -> None:
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        group = np.array([self.groups.setdefault(g, len(self.groups)) for g in zip(langs, sources, strict=True)])
        waiting, size = [], 0
        for raw, begin, text in slices_of(batch.column("text")):
            starts, lengths = term_spans(raw, begin)
            if not len(starts):
                continue
            owner = text[np.searchsorted(begin, starts, side="right") - 1]
            number = self.lookup.numbers(Pieces(_LOWER[raw], starts, lengths, owner, ()))
            key, n = np.unique((owner << 32) | number, return_counts=True)
            waiting.append((key, n))
            size += len(key)
            if size > PENDING:
                # The last text may go on in the next slice.
                rest = self._settle(waiting, group, int(text[-1]))
                waiting, size = [rest], len(rest[0])
        self._settle(waiting, group, len(group))

    def _settle(self, waiting, group: np.ndarray, until: int) -> tuple[np.ndarray, np.ndarray]:
        """Add up texts before number ``until``; returns the entries of the others."""
        if not waiting:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        key, n = _summed(*(np.concatenate(x) for x in zip(*waiting, strict=True)))
        done = int(np.searchsorted(key, until << 32))
        of = (group[key[:done] >> 32] << 32) | (key[:done] & 0xFFFFFFFF)
        self.held.append(_summed(of, n[:done], np.ones(done, np.int64)))
        if sum(len(h[0]) for h in self.held) > HELD:
            self._fold()
        return key[done:], n[done:]

    def _fold(self) -> None:
        self.held = [_summed(*(np.concatenate(x) for x in zip(*self.held, strict=True)))]

    def crowded(self) -> bool:
        return len(self.held[0][0]) > HELD // 2 or len(self.terms) > HELD // 2 or self.lookup.long_bytes > 16 << 20

    def rows(self) -> pa.RecordBatch:
        """Counts so far, and a row without a term for every group seen."""
        self._fold()
        key, n, documents = self.held[0]
        names = list(self.groups)
        group = np.concatenate([key >> 32, np.arange(len(names))])
        terms = pa.array(self.terms, pa.binary()).take(pa.array(key & 0xFFFFFFFF)).cast(pa.string())
        pad = np.zeros(len(names), np.int64)
        pick = pa.array(group)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([g[0] for g in names], pa.string()).take(pick),
                pa.array([g[1] for g in names], pa.string()).take(pick),
                pa.concat_arrays([terms, pa.nulls(len(names), pa.string())]),
                pa.array(np.concatenate([n, pad])),
                pa.array(np.concatenate([documents, pad])),
            ],
            names=["lang", "source", "term", "n", "documents"],
        )


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = _TermCounts()
    for whole in batches:
        for first in range(0, whole.num_rows, 1024):
            counts.add(whole.slice(first, 1024))
            if counts.crowded():
                counts._fold()
                if counts.crowded():
                    yield counts.rows()
                    counts = _TermCounts()
    if counts.groups:
        yield counts.rows()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, documents) of all texts; every group also has a row with a null term."""
    ship_package(docs.sparkSession)
    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    partial = named.mapInArrow(_count_terms, "lang string, source string, term string, n long, documents long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))


# --- shares --------------------------------------------------------------------------------------------------------

# 10**9 in two factors, so that no product leaves 64 bits.
_FACTORS = (31_250, 32_000)


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def share(count: Column, total: Column, kept: Column) -> Column:
    """The smoothed share of a term, in whole parts of 10**9."""
    scaled, whole = (count + 2) * _FACTORS[0], total + 2 * kept
    return 1 + _div(scaled, whole) * _FACTORS[1] + _div((scaled % whole) * _FACTORS[1], whole)


def difference(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


def shares_of(count: np.ndarray, total: int, kept: int) -> np.ndarray:
    """:func:`share` of an array of counts."""
    quotient, rest = np.divmod((count + 2) * _FACTORS[0], total + 2 * kept)
    return 1 + quotient * _FACTORS[1] + rest * _FACTORS[1] // (total + 2 * kept)


def merged_price(a_ids, a_counts, b_ids, b_counts, a_total: int, b_total: int, kept: int) -> tuple[int, int]:
    """The sum of differences over terms that either group has, and the number of these terms.

    Ids are sorted. Each id of the shorter array gallops to its place in the longer one.
    """
    if len(a_ids) > len(b_ids):
        a_ids, a_counts, a_total, b_ids, b_counts, b_total = b_ids, b_counts, b_total, a_ids, a_counts, a_total
    place = np.searchsorted(b_ids, a_ids)
    both = np.zeros(len(a_ids), bool)
    inner = place < len(b_ids)
    both[inner] = b_ids[place[inner]] == a_ids[inner]
    alone = np.ones(len(b_ids), bool)
    alone[place[both]] = False
    p, q = shares_of(a_counts, a_total, kept), shares_of(b_counts, b_total, kept)
    none = np.zeros(1, np.int64)
    p_none, q_none = shares_of(none, a_total, kept), shares_of(none, b_total, kept)
    total = 0
    for x, y in ((p[both], q[place[both]]), (p[~both], q_none), (p_none, q[alone])):
        total += int(((x - y) ** 2 // (x + y)).sum()) if len(x) and len(y) else 0
    return total, len(a_ids) + int(alone.sum())


def _price_pair(left: pa.Table, right: pa.Table) -> pa.Table:
    lead = left if left.num_rows else right
    sides = []
    for side in (left, right):
        if side.num_rows:
            sides += [side.column(c).combine_chunks().flatten().to_numpy() for c in ("ids", "counts")]
        else:
            sides += [np.zeros(0, np.int64), np.zeros(0, np.int64)]
    total, listed = merged_price(*sides, *(lead.column(c)[0].as_py() for c in ("a_total", "b_total", "kept")))
    head = {c: lead.column(c).slice(0, 1) for c in ("lang", "a", "b")}
    return pa.table({**head, "value": pa.array([total], pa.int64()), "listed": pa.array([listed], pa.int64())})


# --- audit ---------------------------------------------------------------------------------------------------------


def _pairs(groups: DataFrame) -> DataFrame:
    """(lang, a, b) of two sources of a language, a before b, with both totals; groups: (lang, source, total, kept)."""
    a = groups.select("lang", F.col("source").alias("a"), F.col("total").alias("a_total"), "kept")
    b = groups.select("lang", F.col("source").alias("b"), F.col("total").alias("b_total"))
    return a.join(b, "lang").where(F.col("a") < F.col("b"))


def pair_values(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value) of every unordered pair; counts: (lang, source, id, n) of kept terms."""
    entry = F.struct(F.col("id"), F.col("n"))
    arrays = (
        counts.groupBy("lang", "source", F.call_function("div", F.col("id"), F.lit(SLICE)).alias("slice"))
        .agg(F.sort_array(F.collect_list(entry)).alias("entries"))
        .select("lang", "source", "slice", F.col("entries.id").alias("ids"), F.col("entries.n").alias("counts"))
    )
    pairs = materialize(_pairs(groups), "source-pairs")
    key = ["lang", "a", "b", "slice"]
    sides = []
    for side in ("a", "b"):
        held = arrays.withColumnRenamed("source", side).join(pairs, ["lang", side])
        # Both sides read the same tables, so each gets columns of its own.
        sides.append(held.select(*[F.col(c).alias(c) for c in held.columns]).groupBy(*key))
    priced = (
        sides[0]
        .cogroup(sides[1])
        .applyInArrow(_price_pair, "lang string, a string, b string, value long, listed long")
        .groupBy("lang", "a", "b")
        .agg(F.sum("value").alias("value"), F.sum("listed").alias("listed"))
    )
    zero = F.lit(0).cast("long")
    absent = difference(
        share(zero, F.col("a_total"), F.col("kept")), share(zero, F.col("b_total"), F.col("kept"))
    )
    unlisted = F.col("kept") - F.coalesce("listed", zero)
    value = F.coalesce("value", zero) + F.when(unlisted > 0, unlisted * absent).otherwise(zero)
    return pairs.join(priced, ["lang", "a", "b"], "left").select("lang", "a", "b", value.alias("value"))


def audited(docs: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank): the other sources by distance, and the terms a source overuses most."""
    counts = materialize(term_counts(docs), "term-counts")
    terms = counts.where(F.col("term").isNotNull())
    kept = (
        terms.groupBy("lang", "term")
        .agg(F.sum("n").alias("lang_n"), F.sum("documents").alias("documents"))
        .where(F.col("documents") >= MIN_DOCUMENTS)
    )
    numbered = ranked(kept.select("lang", "term", "lang_n"), [F.col("lang"), F.col("term")], out="id")
    langs = numbered.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
    known = materialize(
        terms.select("lang", "source", "term", "n").join(numbered, ["lang", "term"]), "kept-term-counts"
    )
    totals = known.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    groups = materialize(
        counts.where(F.col("term").isNull())
        .select("lang", "source")
        .join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .select(
            "lang",
            "source",
            *[F.coalesce(c, zero).alias(c) for c in ("total", "kept", "lang_total")],
        ),
        "source-groups",
    )
    pairs = materialize(pair_values(known.select("lang", "source", "id", "n"), groups), "source-distances")
    both_ways = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        pairs.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value")
    )
    p = share(F.col("n"), F.col("total"), F.col("kept"))
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))
    overused = (
        known.where(F.col("n") > 0)
        .join(groups, ["lang", "source"])
        .where(p > q)
        .select("lang", "source", F.col("term").alias("item"), difference(p, q).alias("value"))
    )
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    parts = [("pair", both_ways, None), ("term", overused, TOP_TERMS)]
    result = None
    for name, rows, top in parts:
        placed = rows.withColumn("rank", F.row_number().over(order))
        placed = placed if top is None else placed.where(F.col("rank") <= top)
        told = placed.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")
        result = told if result is None else result.unionByName(told)
    return result
