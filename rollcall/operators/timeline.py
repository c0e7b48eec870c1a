"""Per-entity history features in one form that is linear and survives a hot entity.

* Each row is copied to the instants at which it starts (or stops) counting, so that "everything at
  least three days old" becomes "everything up to now", and a trailing window the difference of two such sums.
* Entities are cut into time chunks; a window over (entity, chunk) adds up the part inside the chunk, so
  no task gets a whole hot entity, and no frame is added up again for each row.
* Chunk totals are pre-aggregated before their shuffle, and a window over these few rows per entity carries the
  sum of all earlier chunks forward.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollcall.functions.temporal import DAY_US, floor_div, micros
from rollcall.session import materialize


@dataclass(frozen=True)
class Lagged:
    """Sum of a column, or count of its values, over rows at least ``lag_us`` old."""

    out: str
    value: str
    lag_us: int
    func: str = "sum"

    def __post_init__(self) -> None:
        if self.func not in ("sum", "count"):
            raise NotImplementedError(f"cumulative function {self.func!r}")

    def effects(self) -> dict[tuple[int, bool], Column]:
        """Changes of the sum by (delay, whether it ends a trailing window)."""
        value = F.col(self.value)
        if self.func == "count":
            value = value.isNotNull().cast("long")
        return {(self.lag_us, False): value}


@dataclass(frozen=True)
class Trailing:
    """Count of a column's values in ``(t - width, t]``, the row itself included."""

    out: str
    value: str
    width_us: int

    def effects(self) -> dict[tuple[int, bool], Column]:
        present = F.col(self.value).isNotNull().cast("long")
        return {(0, False): present, (self.width_us, True): -present}


@dataclass(frozen=True)
class Previous:
    """Start of the entity's previous row in time order (null for the first)."""

    out: str


@dataclass(frozen=True)
class SameDay:
    """Count of a column's values on the same calendar date."""

    out: str
    value: str


Spec = Lagged | Trailing | Previous | SameDay


#: Places on the time axis for rows without a time: they come before all others, and stop counting
#: for trailing windows before the first real time.
_NO_TIME_CHUNK = -(2**62)
_AFTER_NO_TIME = -(2**61)


def with_history(
    df: DataFrame,
    entity: str,
    ts: str,
    specs: Sequence[Spec],
    chunk_us: int | None = None,
    stage: bool = False,
) -> DataFrame:
    """Add the history columns described by ``specs``.

    One form for all entities and sizes, linear in the rows. The result does not depend on ``chunk_us`` (a
    divisor of a day, by default a day). Rows without entity form an entity of their own; rows without time are
    peers that come before all rows of their entity, as in a window that sorts nulls first.
    The input is read twice, in full and slim for the chunk totals; ``stage`` writes it once first, for inputs
    that cost more than a scan.
    """
    chunk_us = chunk_us or DAY_US
    if DAY_US % chunk_us:
        raise ValueError("chunk_us must divide a day")
    if stage:
        df = materialize(df, "staged")
    sums = [s for s in specs if isinstance(s, (Lagged, Trailing))]
    effects = [s.effects() for s in sums]
    moments = sorted({(0, False)}.union(*effects))

    # A struct is never null, so rows without entity join their totals too.
    key = F.struct(F.col(entity).alias("value")).alias("_entity")
    # One copy per moment.  Only the copy at moment 0 keeps the row itself.
    row = F.struct(*[F.col(c) for c in df.columns])
    copies = []
    for moment in moments:
        own = moment == (0, False)
        changes = [
            F.coalesce(effect.get(moment, F.lit(0)), F.lit(0)).alias(f"_m{i}")
            for i, effect in enumerate(effects)
        ]
        delay, ends = moment
        at = micros(ts) + F.lit(delay).cast("long")
        if ends:
            # Rows without time stay peers of each other and leave trailing windows behind them.
            at = F.coalesce(at, F.lit(_AFTER_NO_TIME).cast("long"))
        copies.append(
            F.struct(
                at.alias("_at"),
                (row if own else F.lit(None)).alias("_row"),
                (micros(ts) if own else F.lit(None).cast("long")).alias("_own"),
                *changes,
            )
        )
    if len(copies) == 1:
        timeline = df.select(key, copies[0].alias("_c"))
    else:
        timeline = df.select(key, F.explode(F.array(*copies)).alias("_c"))
    timeline = timeline.select("_entity", "_c.*").withColumn(
        "_chunk",
        F.coalesce(floor_div(F.col("_at"), chunk_us), F.lit(_NO_TIME_CHUNK).cast("long")),
    )

    inside = W.partitionBy("_entity", "_chunk").orderBy("_at")
    before = inside.rowsBetween(W.unboundedPreceding, -1)
    local = [F.sum(f"_m{i}").over(inside).alias(f"_s{i}") for i in range(len(sums))]
    want_previous = any(isinstance(s, Previous) for s in specs)
    if want_previous:
        local.append(F.max("_own").over(before).alias("_prev"))
    rows = timeline.select("_entity", "_chunk", "_row", *local).where(
        F.col("_row").isNotNull()
    )

    carried = _chunk_carry(timeline, specs, sums, chunk_us)
    joined = rows.join(carried, ["_entity", "_chunk"], "left")

    out = [F.col(f"_row.{c}").alias(c) for c in df.columns]
    position = {id(s): i for i, s in enumerate(sums)}
    same_day = 0
    for spec in specs:
        if isinstance(spec, Previous):
            value = F.coalesce("_prev", "_prev_before")
            out.append(
                F.timestamp_micros(value).cast(df.schema[ts].dataType).alias(spec.out)
            )
        elif isinstance(spec, SameDay):
            out.append(F.coalesce(f"_day{same_day}", F.lit(0)).alias(spec.out))
            same_day += 1
        else:
            i = position[id(spec)]
            out.append((F.col(f"_s{i}") + F.coalesce(f"_c{i}", F.lit(0))).alias(spec.out))
    return joined.select(*out)


def _chunk_carry(timeline: DataFrame, specs, sums, chunk_us: int) -> DataFrame:
    """Per (entity, chunk): what earlier chunks and the same day add up to."""
    same_day = [s for s in specs if isinstance(s, SameDay)]
    totals = timeline.groupBy("_entity", "_chunk").agg(
        F.max("_own").alias("_last"),
        F.count("_row").alias("_rows"),
        *[F.sum(f"_m{i}").alias(f"_t{i}") for i in range(len(sums))],
        *[F.count(f"_row.{s.value}").alias(f"_n{i}") for i, s in enumerate(same_day)],
    )
    earlier = (
        W.partitionBy("_entity").orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    )
    per_day = W.partitionBy(
        "_entity", floor_div(F.col("_chunk"), DAY_US // chunk_us)
    )
    return totals.select(
        "_entity",
        "_chunk",
        "_rows",
        F.max("_last").over(earlier).alias("_prev_before"),
        *[F.sum(f"_t{i}").over(earlier).alias(f"_c{i}") for i in range(len(sums))],
        *[F.sum(f"_n{i}").over(per_day).alias(f"_day{i}") for i in range(len(same_day))],
    ).where("_rows > 0").drop("_rows")
