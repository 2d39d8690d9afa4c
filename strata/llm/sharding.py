"""Sharding over fixed virtual slots, DataFrame functions only.

Every record hashes to one of N_SLOTS virtual slots, for good. A small,
versioned slot-to-shard map says which shard owns a slot. Growing or
rebalancing edits the map and never the hash, so only the rows of the edited
slots move. Rows and bytes are aggregated per slot, then joined to the map
(N_SLOTS + NULL_BINS rows at most, whatever the input).

``initial_map`` and ``grow`` are pure functions of the shard count, so a
placement by them follows the law ``key``: id and shard count decide.
``rebalance`` edits a map by the measured bytes instead; its versions are
stored beside the others.

Defined results: null text has no bytes (size 16 = the record overhead, CRC of
the empty string); all rows without an id count as one key and share its shard;
repeated rows get places of their own; an empty table gives an empty placement; extra columns
are ignored by ``place``.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

NULL_BINS = 1_024
N_SLOTS = 1 << 14
OVERHEAD_BYTES = 16
Map = list[int]


def initial_map(shards: int, n_slots: int = N_SLOTS) -> Map:
    """Map for ``shards`` shards: one shard owns all slots, then the map grows."""
    owner = [0] * n_slots
    for _ in range(1, shards):
        owner = grow(owner)
    return owner


def grow(owner: Map) -> Map:
    """One more shard: it takes its even share of slots from the fullest shards.

    No slot changes hands between old shards.
    """
    held: dict[int, list[int]] = {}
    for slot, shard in enumerate(owner):
        held.setdefault(shard, []).append(slot)
    new, target = max(owner) + 1, len(owner) // (max(owner) + 2)
    heap = [(-len(slots), shard) for shard, slots in held.items()]
    heapq.heapify(heap)
    out = list(owner)
    for _ in range(target):
        n, shard = heapq.heappop(heap)
        out[held[shard].pop()] = new
        heapq.heappush(heap, (n + 1, shard))
    return out


def rebalance(owner: Map, slot_bytes: dict[int, int], tolerance: float = 0.02) -> Map:
    """Move slots from the heaviest to the lightest shard until near equal bytes.

    Bounded by the number of slots; each move takes the largest slot that still
    narrows the gap between the two shards.
    """
    out = list(owner)
    load = [0] * (max(owner) + 1)
    held: list[list[int]] = [[] for _ in load]
    for slot, shard in enumerate(out):
        load[shard] += slot_bytes.get(slot, 0)
        held[shard].append(slot)
    mean = sum(load) / len(load)
    for _ in range(len(out)):
        high, low = load.index(max(load)), load.index(min(load))
        gap = load[high] - load[low]
        if gap <= tolerance * mean:
            break
        fits = [s for s in held[high] if 0 < slot_bytes.get(s, 0) < gap]
        if not fits:
            break
        slot = min(fits, key=lambda s: (abs(gap - 2 * slot_bytes[s]), s))
        held[high].remove(slot)
        held[low].append(slot)
        out[slot] = low
        load[high] -= slot_bytes[slot]
        load[low] += slot_bytes[slot]
    return out


def store_map(spark: SparkSession, path: str, version: int, owner: Map) -> None:
    """Add one version of the map: rows (slot, shard) below ``version=<n>``."""
    rows = spark.createDataFrame(list(enumerate(owner)), "slot int, shard int").coalesce(1)
    rows.write.parquet(f"{path}/version={version}")


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema("slot int, shard int").parquet(f"{path}/version={version}")


def with_slots(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               n_slots: int = N_SLOTS) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    # All null ids are one key, so they share a slot; their places are numbered in NULL_BINS
    # parts by text, for they may be a third of all rows.
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    part = F.lit(n_slots) + F.pmod(F.xxhash64(text), F.lit(NULL_BINS))
    return df.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(OVERHEAD_BYTES)).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.pmod(F.xxhash64(key), F.lit(n_slots)).cast("int").alias("virtual_slot"),
        F.when(F.col(id_col).isNull(), part)
        .otherwise(F.pmod(F.xxhash64(key), F.lit(n_slots))).cast("int").alias("part"))


def slot_load(slotted: DataFrame) -> DataFrame:
    """Rows and bytes per virtual slot; at most N_SLOTS rows."""
    return slotted.groupBy("virtual_slot").agg(F.count(F.lit(1)).alias("slot_rows"),
                                               F.sum("size").alias("slot_bytes"))


def place(df: DataFrame, owners: DataFrame, grown: DataFrame | None = None,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shard, gapless place within the shard, and the shard after growth.

    A row's place is the number of rows in its shard's earlier virtual slots
    plus its number within its own slot, so no task ever holds a whole shard.
    """
    slotted = with_slots(df, id_col, text_col)
    counted = slotted.groupBy("virtual_slot", "part").agg(F.count(F.lit(1)).alias("slot_rows"),
                                                          F.sum("size").alias("slot_bytes"))
    load = (counted
            .join(F.broadcast(owners.withColumnRenamed("slot", "virtual_slot")), "virtual_slot"))
    # The windows run over the aggregate: N_SLOTS + NULL_BINS rows at most.
    by_shard = Window.partitionBy("shard")
    load = load.select(
        "virtual_slot", "part", "shard",
        F.sum("slot_bytes").over(Window.partitionBy("virtual_slot")).alias("slot_bytes"),
        F.sum("slot_bytes").over(by_shard).alias("shard_bytes"),
        (F.sum("slot_rows").over(by_shard.orderBy("virtual_slot", "part")) - F.col("slot_rows"))
        .alias("before"))
    if grown is not None:
        load = load.join(F.broadcast(grown.select(F.col("slot").alias("virtual_slot"),
                                                  F.col("shard").alias("grown_shard"))),
                         "virtual_slot")
    else:
        load = load.withColumn("grown_shard", F.lit(None).cast("int"))
    within = F.row_number().over(Window.partitionBy("part")
                                 .orderBy("doc_id", "size", "text_crc32"))
    return (slotted.withColumn("nth", within.cast("long"))
            .join(F.broadcast(load.drop("virtual_slot")), "part")
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("before") + F.col("nth") - 1).alias("slot"), "grown_shard",
                    "virtual_slot", "slot_bytes", "shard_bytes"))
