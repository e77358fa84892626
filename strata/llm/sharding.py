"""Sharding by fixed virtual slots (operator 5).

Every record hashes into one of thousands of virtual slots, for ever. A
versioned map says which shard holds a slot: it is laid out once from the bytes
of each slot, largest first onto the lightest shard, and edited afterwards, so
a rebalance or a new shard moves whole slots and never rehashes a record. The
map has one row per slot, so it is small whatever the corpus.

A record's slot comes from its id and its size, so copies of a text spread; a
null text has no bytes; rows that repeat in full share a slot. An empty table
gives a map of empty slots and no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

#: Virtual slots, fixed for the life of a corpus.
N_SLOTS = 8192
#: Bytes a record takes beside its text.
ROW_BYTES = 8

MAP_SCHEMA = "version int, vslot int, shard int, rows long, bytes long"


def with_slots(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_slots: int = N_SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, vslot) of every record."""
    raw = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    sized = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(raw) + ROW_BYTES).cast("long").alias("size"),
                        F.crc32(raw).alias("text_crc32"))
    return sized.withColumn("vslot", F.pmod(F.xxhash64("doc_id", "size"), F.lit(n_slots)).cast("int"))


def slot_loads(slotted: DataFrame) -> DataFrame:
    """Rows and bytes of each slot that has any."""
    return slotted.groupBy("vslot").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"))


def _loads(loads: DataFrame, n_slots: int) -> list[tuple[int, int]]:
    """(rows, bytes) by slot; the table has one row per slot at most."""
    out = [(0, 0)] * n_slots
    for r in loads.collect():
        out[r["vslot"]] = (r["rows"], r["bytes"])
    return out


def new_map(spark: SparkSession, loads: DataFrame, n_shards: int, n_slots: int = N_SLOTS) -> DataFrame:
    """Version 1: slots by falling bytes, each onto the shard with the fewest bytes."""
    load = _loads(loads, n_slots)
    heap = [(0, 0, shard) for shard in range(n_shards)]
    rows = []
    for v in sorted(range(n_slots), key=lambda v: (-load[v][1], v)):
        total, held, shard = heapq.heappop(heap)
        rows.append((1, v, shard, *load[v]))
        heapq.heappush(heap, (total + load[v][1], held + 1, shard))
    return spark.createDataFrame(sorted(rows), MAP_SCHEMA)


def rebalance(slot_map: DataFrame, loads: DataFrame, n_shards: int | None = None, tolerance: float = 0.01) -> DataFrame:
    """The next version of a map: as few slots move as bring every shard within
    ``tolerance`` of the mean bytes; new shards (a larger ``n_shards``) start empty.

    Slots move from the heaviest shard to the lightest, each time the largest
    slot that still narrows the gap.
    """
    old = sorted(slot_map.collect(), key=lambda r: r["vslot"])
    n_slots = len(old)
    load = _loads(loads, n_slots)
    n_shards = n_shards or max((r["shard"] for r in old), default=0) + 1
    shard = [r["shard"] for r in old]
    total, held = [0] * n_shards, [[] for _ in range(n_shards)]
    for v in range(n_slots):
        total[shard[v]] += load[v][1]
        held[shard[v]].append(v)
    for slots in held:
        slots.sort(key=lambda v: (load[v][1], -v))
    mean = sum(total) / n_shards
    while True:
        high = max(range(n_shards), key=lambda s: (total[s], -s))
        low = min(range(n_shards), key=lambda s: (total[s], s))
        gap = total[high] - total[low]
        move = next((v for v in reversed(held[high]) if 0 < load[v][1] < gap), None)
        if move is None or max(total[high] - mean, mean - total[low]) <= tolerance * mean:
            break
        held[high].remove(move)
        held[low].append(move)
        held[low].sort(key=lambda v: (load[v][1], -v))
        total[high] -= load[move][1]
        total[low] += load[move][1]
        shard[move] = low
    version = max((r["version"] for r in old), default=0) + 1
    rows = [(version, v, shard[v], *load[v]) for v in range(n_slots)]
    return slot_map.sparkSession.createDataFrame(rows, MAP_SCHEMA)


def save_map(slot_map: DataFrame, path: str) -> None:
    """Add the map's version to the store at ``path``; older versions stay."""
    slot_map.coalesce(1).write.mode("append").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A version of the stored map, the newest by default."""
    stored = spark.read.schema(MAP_SCHEMA).parquet(path)
    wanted = version if version is not None else stored.agg(F.max("version")).first()[0]
    return stored.where(F.col("version") == F.lit(wanted))


def assign(slotted: DataFrame, slot_map: DataFrame) -> DataFrame:
    """``slotted`` with its shard and its place there, gapless from 0.

    A place is the rows of the shard's earlier slots plus the rank within the
    slot, so no task sorts a whole shard.
    """
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    placed = slot_map.select("vslot", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"))
    rank = F.row_number().over(Window.partitionBy("vslot").orderBy("doc_id", "size", "text_crc32"))
    ranked = slotted.withColumn("rank", rank.cast("long"))
    # the map has n_slots rows of 16 bytes: a proven bound
    return (ranked.join(F.broadcast(placed), "vslot")
            .withColumn("place", F.col("base") + F.col("rank") - 1).drop("rank", "base"))


def op5_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    slotted = with_slots(C.table(spark, sf_dir, "documents"))
    path = C.scratch_path(spark, "slot_map")
    save_map(new_map(spark, slot_loads(slotted), 24), path)
    placed = assign(slotted, load_map(spark, path))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         F.col("place").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
                         F.col("vslot").alias("virtual_slot"))
