"""Sharding by fixed virtual slots, in DataFrame functions only.

A record is hashed into one of some thousands of slots; their number never changes. A map, kept
in versions, says which shard a slot belongs to. It is edited by the bytes that each slot holds: slots
of shards that are gone, and of each shard those beyond its fair share, are dealt out anew, the
largest first, always to the shard with the fewest bytes. Other slots stay where they are, so a
shard that is added fills up from what the others have too much of. Every version stays readable.

The law is ``bytes``: sizes of shards are near equal, they differ by about a slot at most.

The slot is a hash of the id and the text, so copies of a text with different ids spread over the
slots. Rows that are equal in both are counted before the shuffle; they go to slots in blocks of
4096, so no group of repeated rows, nor one without an id, is hot. A slot's rows are numbered in
blocks too. What is broadcast has one row a slot.

Cases: a null text has no bytes and a null id is one more id; a map made for an empty table deals
its slots out in turn, as it does with slots that hold nothing; repeated rows count each, and get
numbers of their own; ties of slots go to the lower slot, ties of shards to the lower shard;
``placed`` keeps all columns, whatever their names are, and gives equal rows one slot.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparklake.llm.arrays import stored, work_dir

SLOTS = 8192
SHARDS = 40
BLOCK = 4096  # repeated rows that share a slot
EACH = 16  # bytes of a record beside its text


def _name(column: str) -> Column:
    return F.col(f"`{column}`")


def size_of(text: Column) -> Column:
    return (F.octet_length(F.coalesce(text, F.lit(""))) + EACH).cast("bigint")


def slot_of(identity: Column, block: Column, slots: int = SLOTS) -> Column:
    """The slot of an identity, a digest in hexadecimal, and a block of its repeats."""
    text = F.concat_ws(":", identity, block.cast("string"))
    return F.pmod(F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("bigint"), F.lit(slots)).cast("int")


def identity_of(doc_id: Column, text: Column) -> Column:
    """A digest of id and text, where a null differs from every value."""
    whole = F.concat(F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.md5(whole.cast("binary"))


def empty_map(spark: SparkSession, slots: int = SLOTS) -> DataFrame:
    """(slot, shard): no slot has a shard yet."""
    return spark.range(slots).select(F.col("id").cast("int").alias("slot"), F.lit(None).cast("int").alias("shard"))


def edited(placing: DataFrame, held: DataFrame, shards: int) -> DataFrame:
    """The map ``placing`` (slot, shard) edited for so many shards and the ``held`` (slot, bytes).

    All is one row of arrays of one element a slot or a shard: their numbers are fixed, whatever
    the input's size is. A shard keeps its slots, smallest first, as long as they stay within its
    share; what it can't keep is dealt out.
    """
    sized = placing.join(held.select("slot", "bytes"), "slot", "left").withColumn("bytes", F.coalesce("bytes", F.lit(0).cast("bigint")))
    facts = sized.agg(F.array_sort(F.collect_list(F.struct("bytes", "slot", "shard"))).alias("all"), F.sum("bytes").alias("total"))
    kept = "array<struct<bytes:bigint,slot:int,shard:int>>"
    none = f"cast(array() as {kept})"
    fold = f"""
      aggregate(all, named_struct('load', array_repeat(0L, {shards}), 'stays', {none}, 'open', {none}),
        (s, x) -> if(x.shard < {shards} and s.load[x.shard] + x.bytes <= ceil(total / {shards}) and (x.bytes > 0 or x.shard is not null),
          named_struct('load', transform(s.load, (l, i) -> if(i = x.shard, l + x.bytes, l)), 'stays', array_append(s.stays, x), 'open', s.open),
          named_struct('load', s.load, 'stays', s.stays, 'open', array_append(s.open, x))))"""
    # the largest come first, of equal ones the lower slot
    pick = f"if(x.bytes = 0, x.slot % {shards}, cast(array_position(s.load, array_min(s.load)) - 1 as int))"
    deal = f"""
      aggregate(array_sort(open, (x, y) -> if(x.bytes <> y.bytes, if(x.bytes > y.bytes, -1, 1), x.slot - y.slot)),
        named_struct('load', load, 'dealt', {none}),
        (s, x) -> named_struct('load', transform(s.load, (l, i) -> if(i = {pick}, l + x.bytes, l)),
          'dealt', array_append(s.dealt, named_struct('bytes', x.bytes, 'slot', x.slot, 'shard', {pick}))))"""
    first = facts.select(F.expr(fold).alias("s")).select("s.*")
    second = first.select("stays", F.expr(deal).alias("d"))
    return second.select(F.inline(F.concat("stays", "d.dealt"))).select("slot", "shard")


class SlotMap:
    """The versions of a map in a folder that all executors share, each a table of its own."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _at(self, version: int) -> str:
        return os.path.join(self.path, f"version={version}")

    def write(self, placing: DataFrame, version: int) -> DataFrame:
        """Versions are written once; a write that a lost driver left half done is repeated."""
        placing.coalesce(1).write.mode("overwrite").parquet(self._at(version))
        return self.read(version)

    def read(self, version: int) -> DataFrame:
        return self.spark.read.schema("slot int, shard int").parquet(self._at(version))


def digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, identity, block, copies, virtual) of each record.

    Rows that are equal in id and text are one row for each block of their copies.
    """
    whole = F.coalesce(_name(text), F.lit(""))
    rows = docs.select(
        _name(doc_id).alias("doc_id"),
        size_of(_name(text)).alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"),
        identity_of(_name(doc_id), _name(text)).alias("identity"),
    )
    rows = rows.groupBy("doc_id", "size", "text_crc32", "identity").agg(F.count("*").alias("repeats"))
    last = F.expr(f"(repeats - 1) div {BLOCK}")
    rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    rows = rows.withColumn("copies", F.least(F.lit(BLOCK), F.col("repeats") - F.col("block") * BLOCK)).drop("repeats")
    return rows.withColumn("virtual", slot_of(F.col("identity"), F.col("block"), slots))


def bytes_of(records: DataFrame) -> DataFrame:
    """(slot, rows, bytes) of the slots that hold something."""
    return records.groupBy(F.col("virtual").alias("slot")).agg(
        F.sum("copies").alias("rows"), F.sum(F.col("size") * F.col("copies")).alias("bytes")
    )


def placed(docs: DataFrame, placing: DataFrame, text: str = "text", doc_id: str = "doc_id", slots: int = SLOTS) -> DataFrame:
    """``row``, all columns as a struct, with the ``slot`` and the ``shard`` a map gives it."""
    slot = slot_of(identity_of(_name(doc_id), _name(text)), F.lit(0), slots)
    rows = docs.select(F.struct(*[_name(c) for c in docs.columns]).alias("row"), slot.alias("slot"))
    return rows.join(F.broadcast(placing), "slot").select("row", "slot", "shard")


def write_shards(docs: DataFrame, placing: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id") -> None:
    """The rows as one folder for each shard; a shard's slots go to tasks of their own."""
    rows = placed(docs, placing, text, doc_id)
    rows.repartition("shard", "slot").write.partitionBy("shard").parquet(path)


def numbered(records: DataFrame, placing: DataFrame, held: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): ``slot`` numbers a shard's records from 0 on.

    Virtual slots follow one another in a shard, and blocks of records in a virtual slot, so each
    begins where the ones before end; only the sums of slots are known to all tasks.
    """
    before = Window.partitionBy("shard").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = placing.join(held, "slot").withColumn("start", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    starts = starts.select(F.col("slot").alias("virtual"), "shard", "start")
    own = Window.partitionBy("virtual").orderBy("identity", "block").rowsBetween(Window.unboundedPreceding, -1)
    rows = records.withColumn("at", F.coalesce(F.sum("copies").over(own), F.lit(0))).join(F.broadcast(starts), "virtual")
    copy = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1))
    return rows.select("doc_id", "size", "text_crc32", "shard", "start", "at", copy.alias("copy")).select(
        "doc_id", "size", "text_crc32", "shard", reduce(Column.__add__, [F.col(c) for c in ("start", "at", "copy")]).alias("slot")
    )


def op12(docs: DataFrame) -> DataFrame:
    """The registered query: forty shards by bytes, from the map's first edited version."""
    spark = docs.sparkSession
    records = stored(digests(docs.select("doc_id", "text")), "slot-records")
    held = bytes_of(records)
    versions = SlotMap(spark, work_dir(spark, "slot-map"))
    placing = versions.write(edited(empty_map(spark), held, SHARDS), 1)
    return numbered(records, placing, held).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
