"""Sharding by fixed virtual slots.

A record is hashed into one of SLOTS virtual slots, for good. Bytes are summed a slot, and a
map says which shard holds a slot. The map has versions: the first deals the slots in turn, and each
edit (rebalanced, grown) moves whole slots and makes the next version. Records are never hashed anew.
All of it is DataFrame expressions; a map has SLOTS rows, whatever the table's size.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from vectorloom.llm.common import shuffles, stored

SLOTS, HEADER = 4096, 8


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, virtual of every row; null texts are empty.

    The virtual slot hashes id, checksum and size, so that rows that only share an id or a text are dealt apart.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + HEADER).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    name = F.concat_ws(":", F.col("doc_id").cast("string"), F.col("text_crc32").cast("string"), F.col("size").cast("string"))
    return own.withColumn("virtual", (F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("long") % slots).cast("int"))


def slot_bytes(own: DataFrame) -> DataFrame:
    """virtual, bytes of the slots that hold records."""
    return own.groupBy("virtual").agg(F.sum("size").alias("bytes"))


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """version, virtual, shard: version 1, slots dealt in turn."""
    return spark.range(slots).select(F.lit(1).alias("version"), F.col("id").cast("int").alias("virtual"), (F.col("id") % shards).cast("int").alias("shard"))


def _edited(current: DataFrame, weights: DataFrame, shards: int, start: Column, place) -> DataFrame:
    """The next version: slots are read by falling bytes, and place(loads, slot, total) names the shard of each.

    loads (bytes a shard) begin at start(slots) and follow each move. One row with all slots, SLOTS of them.
    """
    all_slots = current.join(weights, "virtual", "left").select("version", F.struct((-F.coalesce("bytes", F.lit(0))).alias("order"), "virtual", F.coalesce("bytes", F.lit(0)).alias("bytes"), "shard").alias("x"))
    one = all_slots.groupBy().agg(F.max("version").alias("version"), F.array_sort(F.collect_list("x")).alias("slots"), F.coalesce(F.sum("x.bytes"), F.lit(0)).alias("total"))

    def step(state: Column, slot: Column) -> Column:
        to = F.array(place(state["loads"], slot, F.col("total")))

        def after(shard: Column) -> Column:
            change = lambda load, i: load + F.when(i == shard, slot["bytes"]).otherwise(0) - start.change(i, slot)
            moves = F.concat(state["moves"], F.array(F.struct(slot["virtual"].alias("virtual"), shard.alias("shard"))))
            return F.struct(F.transform(state["loads"], change).alias("loads"), moves.alias("moves"))

        return F.transform(to, after)[0]  # `to` is computed once

    empty = F.expr("cast(array() as array<struct<virtual:int,shard:int>>)")
    done = one.withColumn("state", F.aggregate("slots", F.struct(start.loads(shards).alias("loads"), empty.alias("moves")), step))
    return done.select((F.col("version") + 1).alias("version"), F.explode("state.moves").alias("m")).select("version", "m.virtual", "m.shard")


class _Empty:
    """Shards fill up from nothing."""

    @staticmethod
    def loads(shards: int) -> Column:
        return F.array_repeat(F.lit(0).cast("long"), shards)

    @staticmethod
    def change(shard: Column, slot: Column) -> Column:
        return F.lit(0)


class _Full:
    """Shards begin with what they hold, and a slot that is moved leaves its own."""

    @staticmethod
    def loads(shards: int) -> Column:
        held = lambda i: F.aggregate("slots", F.lit(0).cast("long"), lambda s, x: s + F.when(x["shard"] == i, x["bytes"]).otherwise(0))
        return F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), held)

    @staticmethod
    def change(shard: Column, slot: Column) -> Column:
        return F.when(shard == slot["shard"], slot["bytes"]).otherwise(0)


def rebalanced(current: DataFrame, weights: DataFrame, shards: int) -> DataFrame:
    """The next version of a map, with bytes a shard nearly equal.

    By falling bytes, a slot stays in its shard while that has no more than its share, and else goes to the
    least full one (the first of equals). No shard then has more over its share than the bytes of the
    first slot that fitted nowhere, or of a slot that alone is more than a share.
    """

    def place(loads: Column, slot: Column, total: Column) -> Column:
        fits = F.element_at(loads, slot["shard"] + 1) + slot["bytes"] <= F.ceil(total / F.lit(shards))
        return F.when(fits, slot["shard"]).otherwise((F.array_position(loads, F.array_min(loads)) - 1).cast("int"))

    return _edited(current, weights, shards, _Empty, place)


def grown(current: DataFrame, weights: DataFrame, shards: int) -> DataFrame:
    """The next version with one more shard, number `shards`: slots only move into it, from shards with more than their share left."""

    def place(loads: Column, slot: Column, total: Column) -> Column:
        share = F.floor(total / F.lit(shards + 1))
        fits = (F.element_at(loads, shards + 1) + slot["bytes"] <= share) & (F.element_at(loads, slot["shard"] + 1) - slot["bytes"] >= share)
        return F.when(fits, F.lit(shards)).otherwise(slot["shard"]).cast("int")

    return _edited(current, weights, shards + 1, _Full, place)


def save_map(version: DataFrame, path: str) -> None:
    """Adds a version to the store of maps. A version that is written again replaces itself, so a repeated write adds nothing."""
    version.repartition(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(path)  # SLOTS rows


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """version, virtual, shard of a version, or of the newest."""
    every = spark.read.schema("virtual int, shard int, version int").parquet(path).select("version", "virtual", "shard")
    return every.filter(F.col("version") == version) if version is not None else every.join(F.broadcast(every.agg(F.max("version").alias("version"))), "version")


def placed(own: DataFrame, current: DataFrame) -> DataFrame:
    """The stored records with shard and slot, their place in the shard (0, 1, ...) by doc_id, checksum and size.

    The records' partitions are ranges in that order: a place is the shard's rows in earlier partitions and
    those before it in its own. No task gets more than one partition's rows.
    """
    part = own.withColumn("part", F.spark_partition_id())
    part = part.join(F.broadcast(current.select("virtual", "shard")), "virtual")  # SLOTS rows
    sums = part.groupBy("part", "shard").agg(F.count("*").alias("n"))
    before = sums.withColumn("before", F.coalesce(F.sum("n").over(W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("n")
    nth = F.row_number().over(W.partitionBy("part", "shard").orderBy("doc_id", "text_crc32", "size")) - 1
    return part.withColumn("nth", nth).join(before, ["part", "shard"]).withColumn("slot", (F.col("before") + F.col("nth")).cast("long"))


def sharded(docs: DataFrame, shards: int, path: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row: sizes are near equal (law bytes).

    Versions 1 (in turn) and 2 (by bytes) of the map are kept at path, by default in the checkpoint folder. Rows with
    a null id, empty or null texts and repeated rows are records like others; rows that agree in
    id, checksum and size share a virtual slot. An empty table has no rows. A record is as large as
    its text and HEADER bytes; one that exceeds a share makes its shard as large.
    """
    spark = docs.sparkSession
    # the random column only splits rows that are equal, whose order does not matter
    own = stored(records(docs).repartitionByRange(shuffles(spark), "doc_id", "text_crc32", "size", F.rand(1)))
    path = path or f"{spark.sparkContext.getCheckpointDir()}/shard-map-{uuid.uuid4().hex}"
    first = first_map(spark, shards)
    save_map(first, path)
    save_map(rebalanced(first, slot_bytes(own), shards), path)
    out = placed(own, load_map(spark, path))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
