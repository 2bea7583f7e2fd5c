"""Sharding by fixed virtual slots.

A record's text is hashed into one of `slots` slots. Bytes and rows are summed per slot, and a slot-to-shard
map, stored with its version, says where each slot lies. The first version deals the slots out in turn. A new
version is the newest one of its folder, read back, with single slots moved, or exchanged, from the fullest shard
to the emptiest until no edit brings them nearer. Rows never move except with their slot.

Equal texts share a slot. A slot that holds more than a quarter of a shard's bytes, or of its rows, is hot: it is
cut into `parts` slots by the document id and, for a document that repeats, the copy. There are at most eight hot
slots for each shard, so the map has at most slots + 8 * shards * parts rows.

Defined results: a null text has size 1, crc32 0 and the slot of the empty text; a null id is an id of its own;
rows that repeat each get a place; no rows in, none out.
"""

from __future__ import annotations

import os
from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from touchline.llm.common import body, row_key, text_key
from touchline.session import scratch_path, stored

MAP = "slot_id long, shard int, bytes long, rows long"


@dataclass(frozen=True)
class Settings:
    shards: int = 16
    slots: int = 4096
    parts: int = 64


def present(spark, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def rebalanced(before: dict[int, int], size: dict[int, int], shards: int) -> dict[int, int]:
    """The next version of the slot-to-shard map: `before`, edited until shard sizes are near equal.

    Slots that `before` lacks start at slot modulo shards; slots of shards that are no more, too. Every edit
    lessens the sum of the squares of the shards' sizes, whole numbers, so edits end.
    """
    now = {s: before[s] if before.get(s, shards) < shards else s % shards for s in size}
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for slot, shard in now.items():
        held[shard].append((size[slot], slot))
    for one in held:
        one.sort()
    sums = [sum(b for b, _ in one) for one in held]

    def move(item: tuple[int, int], here: int, there: int) -> None:
        held[here].remove(item)
        insort(held[there], item)
        sums[here] -= item[0]
        sums[there] += item[0]
        now[item[1]] = there

    while True:
        high, low = max(range(shards), key=sums.__getitem__), min(range(shards), key=sums.__getitem__)
        gap = sums[high] - sums[low]
        at = bisect_left(held[high], (gap // 2, -1))
        near = [x for x in held[high][max(0, at - 1) : at + 1] if 0 < x[0] < gap]
        if near:
            move(min(near, key=lambda x: abs(2 * x[0] - gap)), high, low)
            continue
        if not held[high] or not held[low]:
            return now
        more, less = np.array([b for b, _ in held[high]]), np.array([b for b, _ in held[low]])
        change = more[:, None] - less[None, :]
        off = np.where((change > 0) & (change < gap), np.abs(2 * change - gap), np.iinfo(np.int64).max)
        i, j = np.unravel_index(off.argmin(), off.shape)
        if off[i, j] >= gap:
            return now
        up, down = held[high][i], held[low][j]
        move(up, high, low)
        move(down, low, high)


def records(docs: DataFrame) -> DataFrame:
    """Documents that repeat are one record of n rows."""
    text = body()
    size = F.octet_length(text).cast("long") + 1
    rows = docs.select("doc_id", row_key().alias("rid"), size.alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), text_key().alias("key"))
    return rows.groupBy("doc_id", "rid", "size", "text_crc32", "key").agg(F.count("*").alias("n"))


def slotted(docs: DataFrame, settings: Settings) -> DataFrame:
    """Records with their virtual slot."""
    found = stored(records(docs).withColumn("base", F.pmod("key", F.lit(settings.slots))), "shard-records")
    # At most `slots` rows.
    sums = found.groupBy("base").agg(F.sum(F.col("size") * F.col("n")).alias("bytes"), F.sum("n").alias("rows")).collect()
    total, count = sum(r["bytes"] for r in sums), sum(r["rows"] for r in sums)
    quarter = 4 * settings.shards
    hot = sorted(r["base"] for r in sums if r["bytes"] * quarter > total or r["rows"] * quarter > count)
    if not hot:
        return found.select("doc_id", "rid", "size", "text_crc32", "n", F.col("base").alias("slot_id"))
    ranks = F.create_map(*[F.lit(x) for pair in enumerate(hot) for x in reversed(pair)])
    rank = F.try_element_at(ranks, F.col("base"))
    pieces = F.when(rank.isNull(), F.lit(1)).otherwise(F.least("n", F.lit(settings.parts))).cast("long")
    found = found.withColumns({"rank": rank, "pieces": pieces})
    found = found.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
    n = F.expr("n div pieces") + (F.col("piece") < F.col("n") % F.col("pieces")).cast("long")
    own = settings.slots + F.col("rank") * settings.parts + F.pmod(F.xxhash64("rid") + F.col("piece"), F.lit(settings.parts))
    return found.select("doc_id", "rid", "size", "text_crc32", n.alias("n"), F.coalesce(own, "base").alias("slot_id"))


def next_map(slots: DataFrame, settings: Settings, before: dict[int, int] | None = None) -> list[tuple[int, int, int, int]]:
    """(slot, shard, bytes, rows) of the map after `before`; at most slots + 8 * shards * parts rows pass the driver."""
    sums = slots.groupBy("slot_id").agg(F.sum(F.col("size") * F.col("n")).alias("bytes"), F.sum("n").alias("rows")).collect()
    now = rebalanced(before or {}, {r["slot_id"]: r["bytes"] for r in sums}, settings.shards)
    return sorted((r["slot_id"], now[r["slot_id"]], r["bytes"], r["rows"]) for r in sums)


def store_map(spark, rows: list[tuple[int, int, int, int]], version: int, folder: str) -> DataFrame:
    """Writes a version of the map beside the others and reads it back."""
    at = os.path.join(folder, f"version={version}")
    spark.createDataFrame(rows, MAP).coalesce(1).write.parquet(at)
    return spark.read.schema(MAP).parquet(at)


def newest_map(spark, folder: str) -> tuple[int, dict[int, int]]:
    """The newest version in a folder, and its shard of every slot; 0 and nothing if there is none."""
    if not present(spark, folder):
        return 0, {}
    stored_maps = spark.read.schema(f"{MAP}, version int").parquet(folder)
    version = stored_maps.agg(F.max("version")).first()[0]
    if version is None:
        return 0, {}
    return version, {r["slot_id"]: r["shard"] for r in stored_maps.filter(F.col("version") == version).select("slot_id", "shard").collect()}


def placed(docs: DataFrame, settings: Settings = Settings(), folder: str | None = None) -> DataFrame:
    """Every row's shard and its place there, gapless from 0: doc_id, rid, size, text_crc32, slot_id, shard, slot.

    The newest map of `folder` is edited into its next version.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "shard-map")
    slots = stored(slotted(docs, settings), "shard-slots")
    version, before = newest_map(spark, folder)
    shard_map = store_map(spark, next_map(slots, settings, before), version + 1, folder)
    above = Window.partitionBy("shard").orderBy("slot_id").rowsBetween(Window.unboundedPreceding, -1)
    shard_map = shard_map.select("slot_id", "shard", F.coalesce(F.sum("rows").over(above), F.lit(0)).alias("base"))
    within = Window.partitionBy("slot_id").orderBy("doc_id", "text_crc32", "rid").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("base") + F.coalesce(F.sum("n").over(within), F.lit(0))
    found = slots.join(F.broadcast(shard_map), "slot_id").withColumn("start", start)
    found = found.withColumn("slot", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)))
    return found.select("doc_id", "rid", "size", "text_crc32", "slot_id", "shard", "slot")


def write_shards(docs: DataFrame, places: DataFrame, path: str) -> None:
    """Writes the rows of `docs` into a folder per shard, sorted by place within a file."""
    rows = docs.withColumn("rid", row_key()).dropDuplicates(["rid"]).join(places.select("rid", "shard", "slot"), "rid").drop("rid")
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def shards(docs: DataFrame, settings: Settings = Settings(), folder: str | None = None) -> DataFrame:
    """Every row's shard and place by the map of `folder`, whose first version deals the fixed slots out in turn."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "shard-map")
    if not present(spark, folder):
        store_map(spark, [(s, s % settings.shards, 0, 0) for s in range(settings.slots)], 1, folder)
    found = placed(docs, settings, folder)
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), F.col("slot_id").alias("virtual_slot")
    )


def sharding(spark, sf_dir: str) -> DataFrame:
    """Query: the shard of every document."""
    return shards(spark.read.parquet(f"{sf_dir}/documents.parquet"))
