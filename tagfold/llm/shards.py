"""Sharding by fixed virtual slots.

Records are hashed by key, size and checksum into a few thousand virtual slots,
whose number never changes. The bytes per slot are aggregated, and a versioned
map, kept as a table, says which shard owns each slot: the first version deals
the slots out so that the shards get nearly equal bytes; a later run reads the
latest version, edits it so that as few slots move as bring the shards back into
balance, writes that as the next version and places the records by it. Only the
map (one row per slot) ever reaches the driver.

Edge cases: a null text has no bytes and size 1; a null key is a key; records
that repeat a key with other texts are records of their own, and where rows
repeat one record so often that they outweigh a mean slot, they are dealt over
all slots; a very long text is one record, which no split can make smaller; an
empty table gives an empty result, and its map is still complete; ties in size
go to the slot and the shard of lower number; extra columns are left aside.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import path_exists, scratch_path
from .common import written

N_SLOTS = 4096
N_SHARDS = 16


def slotted(docs: DataFrame, key: str = "doc_id", n_slots: int = N_SLOTS) -> DataFrame:
    """(key, size, text_crc32, vslot) of every record."""
    raw = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = docs.select(F.col(key), (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    rows = written(rows.withColumn("_row", F.monotonically_increasing_id())
                   .withColumn("_hash", F.xxhash64(key, "size", "text_crc32")), "op1_hashed")
    total = rows.agg(F.sum("size")).first()[0] or 0
    # records whose repeats outweigh a mean slot: fewer than n_slots
    heavy = (rows.groupBy("_hash").agg(F.sum("size").alias("_all"), F.count(F.lit(1)).alias("_n"))
             .filter((F.col("_all") > total / n_slots) & (F.col("_n") > 1)))
    heavy = F.broadcast(written(heavy.select(F.col("_hash").alias("_heavy")), "op1_heavy"))
    slot = F.when(F.col("_heavy").isNull(), F.col("_hash")).otherwise(F.xxhash64("_hash", "_row"))
    return (rows.join(heavy, F.col("_hash") == F.col("_heavy"), "left")
            .select(key, "size", "text_crc32", F.pmod(slot, F.lit(n_slots)).cast("int").alias("vslot")))


def slot_bytes(records: DataFrame) -> DataFrame:
    """Bytes and rows per virtual slot."""
    return records.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def first_map(weights: dict[int, int], n_slots: int = N_SLOTS, n_shards: int = N_SHARDS) -> list[int]:
    """Version 1: slots by falling bytes, each to the shard with the fewest."""
    heap = [(0, s) for s in range(n_shards)]
    owner = [0] * n_slots
    for slot in sorted(range(n_slots), key=lambda s: (-weights.get(s, 0), s)):
        load, shard = heapq.heappop(heap)
        owner[slot] = shard
        heapq.heappush(heap, (load + weights.get(slot, 0), shard))
    return owner


def rebalanced(owner: list[int], weights: dict[int, int], n_shards: int, tolerance: float = 0.01) -> list[int]:
    """The next version: edit ``owner`` for ``n_shards`` shards (more, fewer or
    as many) by moving slots from the fullest to the emptiest shard while that
    narrows a gap wider than ``tolerance`` of the mean. Slots of dropped shards
    move first."""
    owner = list(owner)
    load = [0] * n_shards
    held: list[list[int]] = [[] for _ in range(n_shards)]
    homeless = []
    for slot, s in enumerate(owner):
        if s < n_shards:
            load[s] += weights.get(slot, 0)
            held[s].append(slot)
        else:
            homeless.append(slot)

    def give(slot, s):
        owner[slot] = s
        held[s].append(slot)
        load[s] += weights.get(slot, 0)

    for slot in sorted(homeless, key=lambda x: (-weights.get(x, 0), x)):
        give(slot, min(range(n_shards), key=lambda s: (load[s], s)))
    mean = max(1.0, sum(load) / n_shards)
    while True:
        hi = max(range(n_shards), key=lambda s: (load[s], -s))
        lo = min(range(n_shards), key=lambda s: (load[s], s))
        gap = load[hi] - load[lo]
        fits = [x for x in held[hi] if 0 < weights.get(x, 0) < gap]
        if gap <= tolerance * mean or not fits:
            return owner
        slot = min(fits, key=lambda x: (abs(2 * weights.get(x, 0) - gap), x))
        held[hi].remove(slot)
        load[hi] -= weights.get(slot, 0)
        give(slot, lo)


def map_table(spark, owner: list[int], version: int) -> DataFrame:
    """The versioned map as a table (version, vslot, shard)."""
    return spark.createDataFrame([(version, i, s) for i, s in enumerate(owner)], "version int, vslot int, shard int")


def latest_map(spark, path: str) -> tuple[int, list[int]]:
    """The latest version of the stored map and its owners; version 0 and none
    where there is no map yet."""
    if not path_exists(spark, path):
        return 0, []
    maps = spark.read.parquet(path)
    version = maps.agg(F.max("version")).first()[0]
    return version, [r.shard for r in maps.filter(F.col("version") == version).orderBy("vslot").collect()]  # n_slots rows


def next_map(spark, path: str, weights: dict[int, int], n_slots: int, n_shards: int) -> int:
    """Write the next version of the map at ``path``: the first one, or an edit
    of the latest; none where that one is in balance already. The version."""
    version, owner = latest_map(spark, path)
    edited = rebalanced(owner, weights, n_shards) if version else first_map(weights, n_slots, n_shards)
    if edited == owner:
        return version
    map_table(spark, edited, version + 1).coalesce(1).write.mode("append").parquet(path)
    return version + 1


def sharded(docs: DataFrame, key: str = "doc_id", n_shards: int = N_SHARDS, n_slots: int = N_SLOTS,
            map_path: str | None = None) -> DataFrame:
    """Every record with its virtual slot, its shard under the new version of
    the map stored at ``map_path`` (a fresh one if none is named) and its
    gapless position in the shard.

    Positions need no sort of a whole shard: a shard's slots follow each other,
    so a record's position is its slot's offset plus its rank in the slot."""
    spark = docs.sparkSession
    map_path = map_path or scratch_path(spark, "op1_map")
    records = written(slotted(docs, key, n_slots), "op1_records")
    sums = slot_bytes(records)
    version = next_map(spark, map_path, {r.vslot: r.bytes for r in sums.select("vslot", "bytes").collect()}, n_slots, n_shards)
    maps = spark.read.parquet(map_path).filter(F.col("version") == version)
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    plan = maps.join(sums, "vslot").select("vslot", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"))
    plan = written(plan, "op1_plan")  # at most n_slots rows
    rank = F.row_number().over(Window.partitionBy("vslot").orderBy(F.col(key), "text_crc32", "size"))
    return (records.withColumn("rank", rank).join(F.broadcast(plan), "vslot")
            .select(key, "size", "text_crc32", "vslot", "shard", (F.col("first") + F.col("rank") - 1).alias("slot"),
                    F.lit(version).alias("map_version")))


def shard_documents(docs: DataFrame) -> DataFrame:
    """The digest per document, under the law of near-equal bytes."""
    return sharded(docs).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                                F.lit(None).cast("int").alias("grown_shard"), "vslot")
