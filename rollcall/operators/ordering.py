"""Exact ranks, running totals and quantiles over a whole table.

A window without ``partitionBy`` runs in one task, and a window per group puts
a hot group in one task.  These operators range-partition by the full ordering
instead, number the rows inside each range, and add the totals of the ranges
before it (one row per range).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from hashlib import md5

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollcall.session import materialize, shuffle_width

_POSITION_BITS = 33  # layout of monotonically_increasing_id


def _placed(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Sort globally and keep each row's range and position, written once.

    The write pins the range boundaries: every later reader, also after a lost
    executor, sees the same placement.
    """
    width = shuffle_width(df.sparkSession)
    ordered = df.repartitionByRange(width, *order).sortWithinPartitions(*order)
    numbered = ordered.withColumn("_id", F.monotonically_increasing_id())
    return materialize(
        numbered.select(
            *df.columns,
            F.shiftright("_id", _POSITION_BITS).alias("_range"),
            F.col("_id").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_in_range"),
        ),
        "placed",
    )


def _range_offsets(placed: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """Totals of all earlier ranges; at most one row per shuffle partition."""
    per_range = placed.groupBy("_range").agg(
        *[F.sum(value).alias(name) for name, value in totals.items()]
    )
    earlier = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    return per_range.select(
        "_range",
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in totals],
    )


def _with_group_stats(
    df: DataFrame, by: Sequence[str], stats: dict[str, Column]
) -> DataFrame:
    """Join per-group aggregates back; missing group values match each other."""
    aggregates = [value.alias(name) for name, value in stats.items()]
    if not by:
        # Nothing to join on: one row of figures, added as constants.
        row = df.agg(*aggregates).first()
        return df.withColumns({name: F.lit(row[name]) for name in stats})
    grouped = df.groupBy(*[F.col(c).alias(f"_g_{c}") for c in by]).agg(*aggregates)
    same = [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in by]
    return df.join(grouped, same).drop(*[f"_g_{c}" for c in by])


def ranked(
    df: DataFrame,
    order: Sequence[Column],
    out: str = "rank",
    by: Sequence[str] = (),
) -> DataFrame:
    """Add the 0-based position of each row in ``order``, within ``by`` if given.

    ``order`` should end in a unique column: ties otherwise fall as they come, and
    all rows of a tie stay in one range.
    """
    placed = _placed(df, [F.col(c) for c in by] + list(order))
    offsets = _range_offsets(placed, {"_before": F.lit(1)})
    # The offsets hold one row per shuffle partition, so they always fit.
    whole = placed.join(F.broadcast(offsets), "_range").withColumn(
        out, F.col("_before") + F.col("_in_range")
    )
    whole = whole.drop("_range", "_in_range", "_before")
    if not by:
        return whole
    return _with_group_stats(whole, by, {"_first": F.min(out)}).select(
        *df.columns, (F.col(out) - F.col("_first")).alias(out)
    )


#: Rounds of the network in :func:`permuted`.
MIXING_ROUNDS = 4


def permutation_sides(n: int) -> tuple[int, int]:
    """Sides of the smallest near-square grid of :func:`permuted` that holds n places."""
    side = math.isqrt(max(n - 1, 0)) + 1
    return side, max(1, -(-n // side))


def permuted(rank: Column, n: int, key: Column | str) -> Column:
    """A pseudo-random bijection of the ranks 0 .. n - 1, one per ``key`` (text), without a sort.

    A Feistel network whose halves are the column and the row of a grid of just over n places permutes the grid; a rank that leaves
    0 .. n - 1 is sent through again until it is back inside, so ranks inside map one to one. At most a grid's side of places lie
    outside, so a walk of many steps is as unlikely as many hits of a rare place in a row: the steps allowed
    leave a chance below 2**-100 that any rank is still outside (its result would be missing).
    """
    side, rows = permutation_sides(n)
    outside = side * rows - n
    steps = 1 if not outside else min(outside + 1, 1 + math.ceil((100 + math.log2(n)) / math.log2(side * rows / outside)))
    key = F.lit(key) if isinstance(key, str) else key

    def mixed(value: Column, turn: Column) -> Column:
        digest = F.md5(F.concat_ws(":", key, turn.cast("string"), value.cast("string")))
        return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")

    def through(state: Column, turn: Column) -> Column:
        even = turn % 2 == 0
        return F.struct(
            F.when(even, (state["l"] + mixed(state["r"], turn)) % side).otherwise(state["l"]).alias("l"),
            F.when(even, state["r"]).otherwise((state["r"] + mixed(state["l"], turn)) % rows).alias("r"),
        )

    def network(state: Column, _: Column) -> Column:
        x = state["x"]
        start = F.struct((x % side).alias("l"), F.call_function("div", x, F.lit(side).cast("long")).alias("r"))
        turns = F.sequence(F.lit(0), F.lit(MIXING_ROUNDS - 1))
        end = F.aggregate(turns, start, through, lambda s: s["r"] * side + s["l"])
        done = state["moved"] & (x < n)
        return F.struct(F.when(done, x).otherwise(end).alias("x"), F.lit(True).alias("moved"))

    begin = F.struct(rank.cast("long").alias("x"), F.lit(False).alias("moved"))
    end = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), begin, network, lambda s: s["x"])
    return F.when(end < n, end)


class Permutations:
    """:func:`permuted` for many keys, over arrays of ranks: what a turn adds to a half depends on the other half only, so it is looked up."""

    def __init__(self, n: int, keys: Sequence[str]) -> None:
        self.n = n
        self.side, self.rows = permutation_sides(n)
        self.added = []
        for key in keys:
            turns = []
            for turn in range(MIXING_ROUNDS):
                values, modulus = (self.rows, self.side) if turn % 2 == 0 else (self.side, self.rows)
                digests = (md5(f"{key}:{turn}:{value}".encode()).hexdigest()[:8] for value in range(values))
                turns.append(np.array([int(d, 16) % modulus for d in digests], np.int64))
            self.added.append(turns)

    def receivers(self, k: int, ranks: np.ndarray) -> np.ndarray:
        """Where the permutation of the key in place k sends ranks."""
        out, open_ranks = np.empty(len(ranks), np.int64), np.arange(len(ranks))
        x = ranks
        while len(open_ranks):
            r, left = np.divmod(x, self.side)
            for turn, added in enumerate(self.added[k]):
                if turn % 2 == 0:
                    left = left + added.take(r)
                    left -= self.side * (left >= self.side)
                else:
                    r = r + added.take(left)
                    r -= self.rows * (r >= self.rows)
            x = r * self.side + left
            out[open_ranks] = x
            outside = x >= self.n
            open_ranks, x = open_ranks[outside], x[outside]
        return out


def running_totals(
    df: DataFrame,
    order: Sequence[Column],
    totals: dict[str, str],
    by: Sequence[str] = (),
) -> DataFrame:
    """Add inclusive running sums of long columns, ``{out: column}``.

    Exact for integers.  Within ``by`` the running sum of the group's start is
    subtracted, so values must not be negative there.
    """
    placed = _placed(df, [F.col(c) for c in by] + list(order))
    offsets = _range_offsets(placed, {f"_b_{o}": F.col(c) for o, c in totals.items()})
    inside = W.partitionBy("_range").orderBy("_in_range").rowsBetween(W.unboundedPreceding, 0)
    summed = placed.select(
        "*", *[F.sum(c).over(inside).alias(f"_r_{o}") for o, c in totals.items()]
    )
    whole = summed.join(F.broadcast(offsets), "_range").select(
        *df.columns,
        *[(F.col(f"_b_{o}") + F.col(f"_r_{o}")).alias(o) for o in totals],
    )
    if not by:
        return whole
    starts = {f"_f_{o}": F.min(F.col(o) - F.col(c)) for o, c in totals.items()}
    return _with_group_stats(whole, by, starts).select(
        *df.columns, *[(F.col(o) - F.col(f"_f_{o}")).alias(o) for o in totals]
    )


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    out: str = "edges",
) -> DataFrame:
    """Linear-interpolated quantiles per group, as one array column.

    Spark's ``percentile`` keeps a group's distinct values in one task.  Here equal
    values are counted first, and the two order statistics around each position
    are picked from the running totals of the counts.
    """
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, value)
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    totals = running_totals(counts, [F.col(value)], {"_upto": "_c"}, by)
    sized = _with_group_stats(totals, by, {"_n": F.max("_upto")})

    def at(position: Column) -> Column:
        """The value at a 0-based position: its run of equal values covers it."""
        covers = (F.col("_upto") > position) & (F.col("_upto") - F.col("_c") <= position)
        return F.max(F.when(covers, F.col(value)))

    picks = []
    for i, q in enumerate(probs):
        spot = F.lit(float(q)) * (F.col("_n") - 1)
        picks.append(at(F.floor(spot)).alias(f"_lo{i}"))
        picks.append(at(F.ceil(spot)).alias(f"_hi{i}"))
    picked = sized.groupBy(*by).agg(F.max("_n").alias("_n"), *picks)
    edges = []
    for i, q in enumerate(probs):
        spot = F.lit(float(q)) * (F.col("_n") - 1)
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        edges.append(low + (high - low) * (spot - F.floor(spot)))
    return picked.select(*by, F.array(*edges).alias(out))


def spaced_quantiles(
    counts: DataFrame, value: str, rows: str, parts: int, by: Sequence[str], out: str = "edges"
) -> DataFrame:
    """:func:`exact_quantiles` at k / ``parts`` for k = 1 .. parts - 1, of values that stand ``rows`` times each.

    Every value is sent to the positions that it covers only, so the work does not grow with the number of positions.
    """
    totals = running_totals(counts.where(F.col(value).isNotNull()), [F.col(value)], {"_upto": rows}, by)
    sized = _with_group_stats(totals, by, {"_n": F.max("_upto")}).withColumn("_from", F.col("_upto") - F.col(rows))
    steps = F.lit(float(parts)) / F.greatest(F.col("_n") - 1, F.lit(1))
    first = F.greatest(F.floor((F.col("_from") - 1) * steps) - 1, F.lit(1))
    last = F.least(F.ceil(F.col("_upto") * steps) + 1, F.lit(parts - 1))
    near = F.when(first <= last, F.sequence(first.cast("int"), last.cast("int")))
    spot = F.col("_k").cast("double") / F.lit(float(parts)) * (F.col("_n") - 1)

    def at(position: Column) -> Column:
        return F.max(F.when((F.col("_upto") > position) & (F.col("_from") <= position), F.col(value)))

    picked = (
        sized.withColumn("_k", F.explode(near))
        .withColumn("_spot", spot)
        .groupBy(*by, "_k", "_spot")
        .agg(at(F.floor("_spot")).alias("_low"), at(F.ceil("_spot")).alias("_high"))
    )
    edge = F.col("_low") + (F.col("_high") - F.col("_low")) * (F.col("_spot") - F.floor("_spot"))
    listed = F.sort_array(F.collect_list(F.struct("_k", edge.alias("edge"))))
    return picked.groupBy(*by).agg(F.transform(listed, lambda x: x.edge).alias(out))


def cut_rows(df: DataFrame, order: Sequence[str], positions: Sequence[int]) -> list[tuple]:
    """The ordering values of the rows at some 0-based positions.

    Only the ordering columns are sorted, and only the asked rows are collected.
    """
    placed = ranked(df.select(*order), [F.col(c) for c in order], "_rank")
    rows = placed.where(F.col("_rank").isin(list(positions))).orderBy("_rank").collect()
    return [tuple(row[c] for c in order) for row in rows]


def _from_cut(df: DataFrame, order: Sequence[str], cut: tuple) -> Column:
    bound = F.struct(
        *[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(order, cut)]
    )
    return F.struct(*order) >= bound


def temporal_split(df: DataFrame, order: Sequence[str], test_share: float = 0.2) -> DataFrame:
    """Add ``is_test``: the last ``ceil(share * n)`` rows in ascending ``order``.

    ``order`` must be unique per row.  The table itself is not sorted: a ranking
    of the ordering columns finds the boundary, the rest is a comparison.
    """
    n = df.count()
    first = n - math.ceil(test_share * n)
    if first >= n:
        return df.withColumn("is_test", F.lit(False))
    (cut,) = cut_rows(df, order, [first])
    return df.withColumn("is_test", _from_cut(df, order, cut))


def time_folds(df: DataFrame, order: Sequence[str], n_splits: int = 10) -> DataFrame:
    """Add ``fold``: test block 1..n of an expanding time split, 0 for the head.

    All test blocks have ``n // (splits + 1)`` rows and end at the last row.
    Rows of lower folds train a fold's model.
    """
    n = df.count()
    size = n // (n_splits + 1)
    if size == 0:
        raise ValueError(f"{n} rows are too few for {n_splits} splits")
    starts = [n - (n_splits - i) * size for i in range(n_splits)]
    fold = F.lit(0)
    for cut in cut_rows(df, order, starts):
        fold = fold + _from_cut(df, order, cut).cast("int")
    return df.withColumn("fold", fold)
