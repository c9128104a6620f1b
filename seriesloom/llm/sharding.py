"""Sharding by jump consistent hash: (doc_id, number of shards) decide the shard, without a ring or a table.

The jump walks from bucket to bucket with the 64-bit linear congruential generator of the published algorithm; a
bucket's next jump is ahead of it by at least one, so as many steps as there are shards always end the walk. One more
shard takes rows from the others and moves nothing between them. Everything is a column expression.

Slots number the rows of a shard without gaps. Rows are counted in runs of at most 65,536 input rows, the counts of a
shard are summed over its runs, and a row adds its place in its run; no task holds a whole shard, whatever the ids.

A null text has size 1 and the checksum of no bytes; a null doc_id hashes like 0; repeated doc_ids share a shard and
have a slot each; an empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import id_text, table, written

SHARDS, RUN_BITS = 16, 16
# Fixed value of the published generator.
MULTIPLIER = 2862933555777941757
LOW = 0xFFFFFFFF


def _low_product(a: Column, b: int) -> tuple[Column, Column]:
    """(low 32 bits, what is above) of a * b for a, b below 2**32, without overflow of signed 64-bit integers."""
    low, high = a.bitwiseAND(F.lit(0xFFFF)) * F.lit(b), F.shiftright(a, 16) * F.lit(b)
    total = low + F.shiftleft(high.bitwiseAND(F.lit(0xFFFF)), 16)
    return total.bitwiseAND(F.lit(LOW)), F.shiftright(total, 32) + F.shiftright(high, 16)


def jump_hash(key: Column, shards: int) -> Column:
    """The published jump consistent hash of a 64-bit key, as an int from 0 to shards - 1."""

    def walk(state: Column, _: Column) -> Column:
        low, carry = _low_product(state["low"], MULTIPLIER & LOW)
        above = carry + _low_product(state["low"], MULTIPLIER >> 32)[0] + _low_product(state["high"], MULTIPLIER & LOW)[0]
        plus = low + F.lit(1)
        high = (above + F.shiftright(plus, 32)).bitwiseAND(F.lit(LOW))
        reach = F.lit(float(1 << 31)) / (F.shiftright(high, 1) + F.lit(1)).cast("double")
        step = F.struct(
            high.alias("high"), plus.bitwiseAND(F.lit(LOW)).alias("low"), state["jump"].alias("bucket"),
            F.floor((state["jump"] + F.lit(1)).cast("double") * reach).cast("long").alias("jump"),
        )
        return F.when(state["jump"] < F.lit(shards), step).otherwise(state)

    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    start = F.struct(F.shiftrightunsigned(key, 32).alias("high"), key.bitwiseAND(F.lit(LOW)).alias("low"), F.lit(-1).cast("long").alias("bucket"), F.lit(0).cast("long").alias("jump"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, walk, lambda s: s["bucket"].cast("int"))


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and the shard that one more shard would give."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = id_text(docs).select(
        "doc_id", (F.octet_length(text).cast("long") + F.lit(1)).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        jump_hash(F.col("doc_id"), shards).alias("shard"), jump_hash(F.col("doc_id"), shards + 1).alias("grown_shard"),
        F.monotonically_increasing_id().alias("place"),
    )
    # A row's place is only stable once it is written.
    rows = written(rows, "shards").withColumn("run", F.shiftright("place", RUN_BITS))
    ahead = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = rows.groupBy("shard", "run").agg(F.count("*").alias("n")).select("shard", "run", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("shard", "run").orderBy("place"))
    placed = rows.withColumn("inside", inside).join(runs, ["shard", "run"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("before") + F.col("inside") - 1).cast("long").alias("slot"), "grown_shard")


def op6_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op6_jump_shards": op6_jump_shards}
ORACLES: dict[str, str] = {}
