"""Sharding by fixed virtual slots.

A record hashes to one of a few thousand slots for ever; only the small slot-to-shard map changes.
The map is a versioned table: rebalancing reads the bytes per slot and edits as few entries as it can.

Defined cases: a null text has no bytes (size 1, checksum 0) and a null doc_id is a value like any other;
repeated rows each get a place of their own, but fully equal rows share a slot; an empty table gives no rows
and the untouched first map. Only ``doc_id`` and ``text`` are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollcall.session import materialize

#: Slots of the map, and finer cells of a slot in which rows are numbered. Both are fixed: growing data
#: makes cells larger, never the map.
SLOTS = 4096
CELLS = 64


def first_map(shards: int, slots: int = SLOTS) -> list[int]:
    """Version 0: slots dealt round robin."""
    return [slot % shards for slot in range(slots)]


def rebalanced(shard_of: list[int], slot_bytes: list[int], shards: int) -> list[int]:
    """The map with slots moved from the fullest to the emptiest shard while that evens them out.

    Each move takes the slot nearest to half the difference, so the spread shrinks with every
    move and the loop ends. All slots that are not moved keep their shard.
    """
    result = list(shard_of)
    load = [0] * shards
    members: list[set[int]] = [set() for _ in range(shards)]
    for slot, shard in enumerate(result):
        load[shard] += slot_bytes[slot]
        if slot_bytes[slot]:
            members[shard].add(slot)
    while True:
        full = max(range(shards), key=lambda s: (load[s], s))
        bare = min(range(shards), key=lambda s: (load[s], s))
        gap = load[full] - load[bare]
        fits = [slot for slot in members[full] if slot_bytes[slot] < gap]
        if not fits:
            return result
        slot = min(fits, key=lambda s: (abs(2 * slot_bytes[s] - gap), s))
        members[full].remove(slot)
        members[bare].add(slot)
        result[slot] = bare
        load[full] -= slot_bytes[slot]
        load[bare] += slot_bytes[slot]


def map_table(spark: SparkSession, versions: list[list[int]]) -> DataFrame:
    """(version, slot, shard) rows of the maps; as many as slots and versions, however large the data."""
    listed = ",".join(str(s) for shard_of in versions for s in shard_of)
    width = len(versions[0])
    return spark.range(1).select(
        F.posexplode(F.split(F.lit(listed), ",")).alias("at", "value")
    ).select(
        F.floor(F.col("at") / width).cast("int").alias("version"),
        (F.col("at") % width).cast("int").alias("virtual_slot"),
        F.col("value").cast("int").alias("shard"),
    )


def shard_records(docs: DataFrame, shards: int = 16, slots: int = SLOTS) -> tuple[DataFrame, DataFrame]:
    """Records with shard and place, and the versioned map (version 0 as dealt, 1 as rebalanced by bytes).

    Records: doc_id, size, text_crc32, virtual_slot, shard, slot. ``slot`` numbers the rows of a shard
    from 0 without gaps. Rows are numbered inside hash cells and moved by the cells' running counts, so no
    task sorts a whole shard.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    records = materialize(
        docs.select(
            F.col("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.pmod(F.xxhash64("doc_id", "text"), F.lit(slots * CELLS)).cast("int").alias("cell"),
        ),
        "shard-records",
    )
    cells = materialize(
        records.groupBy("cell").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")),
        "shard-cells",
    )
    slot_bytes = [0] * slots
    # One row per slot: at most `slots` of them.
    for slot, total in (
        cells.groupBy(F.floor(F.col("cell") / CELLS).alias("s")).agg(F.sum("bytes")).collect()
    ):
        slot_bytes[slot] = int(total)
    dealt = first_map(shards, slots)
    slot_map = materialize(
        map_table(spark, [dealt, rebalanced(dealt, slot_bytes, shards)]), "slot-map"
    )
    current = slot_map.filter(F.col("version") == 1).select("virtual_slot", "shard")
    placed_cells = (
        cells.withColumn("virtual_slot", F.floor(F.col("cell") / CELLS).cast("int"))
        .join(F.broadcast(current), "virtual_slot")
        .withColumn(
            "before",
            F.sum("rows").over(
                Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
            )
            - F.col("rows"),
        )
        .select("cell", "virtual_slot", "shard", "before")
    )
    in_cell = Window.partitionBy("cell").orderBy("doc_id", "text_crc32", "size")
    # At most slots * CELLS rows, so this side always fits.
    placed = (
        records.withColumn("nth", F.row_number().over(in_cell) - 1)
        .join(F.broadcast(placed_cells), "cell")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            "virtual_slot",
            "shard",
            (F.col("before") + F.col("nth")).cast("long").alias("slot"),
        )
    )
    return placed, slot_map
