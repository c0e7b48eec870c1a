"""Mixing sources to target weights along a curriculum.

Each source has a target of words for the whole training and a weight schedule over training time t in
[0, 1]. The integral of the schedule, scaled to the target, is the source's cumulative demand of words;
inverting it at a document's place in its source gives the document's training position. Sorting all
taken copies by position makes the training order.

Defined cases: null or empty texts have size 0; a null source is a source like any other and sorts last;
repeated rows count as documents of their own; if no source has a word, all targets are 0 and nothing is taken.
Input columns are packed away while positions are computed, so any names may occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import packed, word_count
from rollcall.session import materialize

#: No source is repeated more often than this.
MAX_REPEATS = 3

#: Weight over training time, by the source's mix weight: knots (t, weight), linear in between.
#: Light sources fade out, heavy ones come in late.
SCHEDULES: dict[int, list[tuple[float, float]]] = {
    1: [(0.0, 1.5), (1.0, 0.5)],
    2: [(0.0, 1.0), (1.0, 1.0)],
    3: [(0.0, 0.5), (0.25, 0.75), (1.0, 1.5)],
}

#: Hex digits of the order key that name a cell: cumulative sums run over cells, then inside each.
CELL_DIGITS = 4


def demand(knots: list[tuple[float, float]]) -> list[float]:
    """Integral of the schedule from 0 to each knot."""
    sums = [0.0]
    for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
        sums.append(sums[-1] + (w0 + w1) / 2 * (t1 - t0))
    return sums


def invert_demand(share: Column, knots: list[tuple[float, float]]) -> Column:
    """Training time at which the cumulative demand reaches ``share`` (0 to 1) of its total."""
    sums = demand(knots)
    level = share * F.lit(sums[-1])
    result: Column | None = None
    for k in range(len(knots) - 1):
        (t0, w0), (t1, w1) = knots[k], knots[k + 1]
        rest = level - F.lit(sums[k])
        slope = (w1 - w0) / (t1 - t0)
        if slope == 0:
            at = F.lit(t0) + rest / F.lit(w0)
        else:
            at = F.lit(t0) + (F.sqrt(F.lit(w0 * w0) + F.lit(2 * slope) * rest) - F.lit(w0)) / F.lit(slope)
        inside = level <= F.lit(sums[k + 1])
        if result is None:
            result = F.when(inside, at)
        elif k < len(knots) - 2:
            result = result.when(inside, at)
        else:
            result = result.otherwise(at)
    return result if len(knots) > 2 else at


def source_targets(sizes: DataFrame) -> DataFrame:
    """Targets of the sources: (src, no_src, source_size) gains weight and target.

    Sources in code-point order, null last, weigh 1, 2, 3, 1, ... and share all words by weight. A target
    stops at MAX_REPEATS times the source's size; what is over goes to the others by weight until none is
    above. Sources are visited by size per weight: each either takes its limit or, from the first that
    stays below it on, all share what is left. One row per source, so one sorted pass suffices.
    """
    one = Window.partitionBy(F.lit(0))
    ranked = sizes.withColumn(
        "weight",
        ((F.row_number().over(one.orderBy("no_src", "src")) - 1) % 3 + 1).cast("int"),
    ).withColumn("limit", F.col("source_size") * MAX_REPEATS)
    before = one.orderBy(F.col("limit") / F.col("weight"), "no_src", "src").rowsBetween(
        Window.unboundedPreceding, -1
    )
    everything = one.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    full = (
        ranked.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("weights", F.sum("weight").over(everything))
        .withColumn("limits_before", F.coalesce(F.sum("limit").over(before), F.lit(0)))
        .withColumn("weights_before", F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn(
            "capped",
            (F.col("total") - F.col("limits_before")).cast("double")
            / (F.col("weights") - F.col("weights_before"))
            * F.col("weight")
            > F.col("limit"),
        )
        .withColumn("taken_limits", F.sum(F.when(F.col("capped"), F.col("limit")).otherwise(0)).over(everything))
        .withColumn("taken_weights", F.sum(F.when(F.col("capped"), F.col("weight")).otherwise(0)).over(everything))
    )
    shared = (
        (F.col("total") - F.col("taken_limits")).cast("double")
        / (F.col("weights") - F.col("taken_weights"))
        * F.col("weight")
    )
    return full.select(
        "src",
        "no_src",
        "source_size",
        "weight",
        F.when(F.col("capped"), F.col("limit").cast("double"))
        .otherwise(F.least(shared, F.col("limit").cast("double")))
        .alias("target"),
    )


def place_documents(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` (columns ``keep``, or all, packed as ``row``) with size, source_size, weight, target, copies, start.

    ``start`` is the number of words before it in its source, in the order of md5(doc_id). Copies of a
    document are taken while their middle lies below the target, so a source misses its target by
    half a document at most. Sums run over (source, key prefix) cells; a source of any size is spread.
    """
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = materialize(
        packed(
            docs,
            keep,
            F.coalesce(F.col("source"), F.lit("")).alias("src"),
            F.col("source").isNull().alias("no_src"),
            word_count(F.col("text")).alias("size"),
            key.alias("key"),
            F.substring(key, 1, CELL_DIGITS).alias("cell"),
        ),
        "mix-rows",
    )
    cells = rows.groupBy("src", "no_src", "cell").agg(F.sum("size").alias("cell_size"))
    sources = source_targets(
        rows.groupBy("src", "no_src").agg(F.sum("size").alias("source_size"))
    )
    by_cell = Window.partitionBy("src", "no_src").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    offsets = (
        cells.withColumn("before", F.sum("cell_size").over(by_cell) - F.col("cell_size"))
        .join(sources, ["src", "no_src"])
        .drop("cell_size")
    )
    in_cell = (
        Window.partitionBy("src", "no_src", "cell")
        .orderBy("key", "size")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    middle = F.col("start") + F.col("size") / F.lit(2.0)
    passes = F.ceil((F.col("target") - middle) / F.col("source_size"))
    return (
        rows.withColumn("upto", F.sum("size").over(in_cell))
        .join(offsets, ["src", "no_src", "cell"])
        .withColumn("start", F.col("before") + F.col("upto") - F.col("size"))
        .withColumn(
            "copies",
            F.when(F.col("source_size") == 0, 0)
            .otherwise(F.greatest(F.lit(0), F.least(F.lit(MAX_REPEATS), passes)))
            .cast("int"),
        )
        .select("row", "size", "source_size", "weight", "target", "start", "copies")
    )


def position(copy: Column) -> Column:
    """Training position of a placed document's copy (0, 1, ...)."""
    middle = copy * F.col("source_size") + F.col("start") + F.col("size") / F.lit(2.0)
    share = F.least(F.lit(1.0), middle / F.col("target"))
    chosen = F.when(F.col("weight") == 1, invert_demand(share, SCHEDULES[1]))
    for weight in (2, 3):
        chosen = chosen.when(F.col("weight") == weight, invert_demand(share, SCHEDULES[weight]))
    return chosen


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: input columns, one row per taken copy, in training order over the partitions."""
    copies = place_documents(docs).filter("copies > 0").withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))
    )
    ordered = copies.select("row", position(F.col("copy")).alias("at"), "start", "copy")
    return (
        ordered.repartitionByRange("at", "start")
        .sortWithinPartitions("at", "start", "copy")
        .select("row.*")
    )
