"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

Every record hashes into one of thousands of slots, which never change. A map says which shard holds which slot. Version 0
deals slots out in turn; a later version is an edit of the one before: bytes are summed per slot, full shards release
their smallest slots and these go to the shards with most room. Only released slots move. Each version is stored and
old ones stay readable, so that a reader can follow where a record was.

Only DataFrame functions are used. The map has one row per slot (``MOST_SLOTS`` at most, checked), so it may be broadcast
and edited in one task; records are never gathered by shard, slot or key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import store

SLOTS = 4096
MOST_SLOTS = 65536


def slot_of(key: Column, text: Column, slots: int = SLOTS) -> Column:
    """The slot of a record, by its key and its text: a key with very many texts spreads, and equal records stay together."""
    return F.pmod(F.xxhash64(key.isNull(), key, text.isNull(), text), F.lit(slots)).cast("int")


def records(docs: DataFrame, slots: int = SLOTS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, virtual_slot, part, at) of every row, stored; ``part`` and ``at`` say where the row was read."""
    body = F.col(text).cast("binary")
    out = docs.select(
        F.col(key),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(body), F.lit(0)).cast("long").alias("text_crc32"),
        slot_of(F.col(key), F.col(text), slots).alias("virtual_slot"),
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("at"),
    )
    return store(out, "shard-records")


def slot_bytes(rows: DataFrame) -> DataFrame:
    """Bytes per slot that has any; combined before the shuffle."""
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"))


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 0: slots dealt out in turn."""
    if not 0 < shards <= slots <= MOST_SLOTS:
        raise ValueError(f"between 1 and {MOST_SLOTS} slots are needed, and no more shards than slots")
    slot = F.col("id").cast("int")
    return spark.range(slots).select(F.lit(0).alias("version"), slot.alias("virtual_slot"), (slot % shards).alias("shard"))


def rebalance(current: DataFrame, weights: DataFrame, shards: int) -> DataFrame:
    """The next version of a map, with bytes per shard near equal and few slots moved.

    A shard keeps its largest slots up to an equal share of all bytes. The released ones, largest first, each go to the
    shard that holds least (of equals, the first). Slots without records stay. Shards of ``current`` beyond ``shards``
    are emptied, new ones start empty.
    """
    known = current.join(F.broadcast(weights), "virtual_slot", "left").withColumn("bytes", F.coalesce("bytes", F.lit(0)))
    order = Window.partitionBy("shard").orderBy(F.desc("bytes"), "virtual_slot")
    share = F.sum("bytes").over(Window.partitionBy()) / F.lit(shards)
    upto = F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, 0))
    marked = known.select("version", "virtual_slot", "shard", "bytes", ((F.col("shard") < shards) & (upto <= share)).alias("kept"))
    entry = F.struct(F.col("bytes").alias("bytes"), F.col("virtual_slot").alias("slot"), F.col("shard").alias("was"))
    whole = marked.agg(
        (F.max("version") + 1).alias("version"),
        F.collect_list(F.when(F.col("kept"), entry)).alias("stay"),
        F.sort_array(F.collect_list(F.when(~F.col("kept"), entry)), asc=False).alias("free"),
    )
    none = F.lit(0).cast("long")
    held = lambda i: F.aggregate("stay", none, lambda a, e: a + F.when(e["was"] == i, e["bytes"]).otherwise(none))
    loads = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), held)

    def put(state: Column, e: Column) -> Column:
        to = (F.array_position(state["loads"], F.array_min(state["loads"])) - 1).cast("int")
        grown = F.transform(state["loads"], lambda x, i: F.when(i == to, x + e["bytes"]).otherwise(x))
        moved = F.struct(e["slot"].alias("virtual_slot"), to.alias("shard"))
        return F.struct(grown.alias("loads"), F.concat(state["moved"], F.array(moved)).alias("moved"))

    nothing = F.expr("CAST(array() AS array<struct<virtual_slot:int,shard:int>>)")
    dealt = whole.select("version", "stay", F.aggregate("free", F.struct(loads.alias("loads"), nothing.alias("moved")), put).alias("done"))
    stays = F.transform("stay", lambda e: F.struct(e["slot"].alias("virtual_slot"), e["was"].alias("shard")))
    return dealt.select("version", F.inline(F.concat(stays, "done.moved")))


def save_map(new: DataFrame, path: str) -> None:
    """Adds a version to the stored map; versions that exist already are never written again."""
    new.write.partitionBy("version").mode("append").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of the stored map, the newest by default."""
    found = spark.read.schema("virtual_slot int, shard int, version int").parquet(path)
    if version is not None:
        return found.filter(F.col("version") == version)
    return found.filter(F.col("version") == found.agg(F.max("version")).scalar())


def place(rows: DataFrame, shard_map: DataFrame) -> DataFrame:
    """Adds ``shard``, ``map_version`` and ``slot``, the place of the record in its shard, counted from 0 without gaps.

    Places are counted within what one task read and then shifted by what earlier parts put into the same shard, so no
    task sorts a shard.
    """
    shards = F.broadcast(shard_map.withColumnRenamed("version", "map_version"))
    dealt = rows.join(shards, "virtual_slot")
    here = Window.partitionBy("part", "shard").orderBy("at")
    numbered = dealt.withColumn("_n", F.row_number().over(here) - 1)
    sizes = dealt.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    return numbered.join(starts, ["shard", "part"]).withColumn("slot", F.col("_start") + F.col("_n")).drop("_n", "_start", "part", "at")
