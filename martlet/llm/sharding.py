"""Operator 9: sharding by rendezvous hashing (DataFrame functions only).

Every shard draws a number from the record key and its own id and the largest
weighted draw wins: ``-ln(u) / weight`` is smallest.  A shard that joins later can
only take rows for itself, because the draws of the others stay as they are.

Rows with a null key share the empty key.  Equal keys share a shard; their rows
get different slots.  Equal draws go to the lower shard id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlet.llm.common import partitions, read_table, stored, text_or_empty


def _draw(key: Column, shard: int, weight: float) -> Column:
    """The shard's draw for a key; the smallest wins.  Uses the top 52 bits as u in (0, 1)."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(shard), key), 12)
    u = (bits.cast("double") + 0.5) / float(1 << 52)
    return -F.log(u) / F.lit(float(weight))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Shard id 0..len(weights)-1 of a key.  A shard of weight 0 gets nothing."""
    drawn = [F.struct(_draw(key, i, w).alias("d"), F.lit(i).alias("s")) for i, w in enumerate(weights) if w > 0]
    if not drawn:
        raise ValueError("no shard has a positive weight")
    return (F.least(*drawn) if len(drawn) > 1 else drawn[0])["s"]


def with_slots(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Number the rows of each shard from 0 without bringing a shard into one task.

    Rows are numbered within (shard, bucket) first; the sizes of the buckets, as many
    as shards times shuffle partitions, give each bucket's first slot.
    """
    buckets = partitions(df.sparkSession)
    rows = df.withColumn("_bucket", F.pmod(F.xxhash64(*order, F.lit("slot")), F.lit(buckets)))
    sizes = rows.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    within = Window.partitionBy("shard", "_bucket").orderBy(*order)
    return (rows.withColumn("_rank", F.row_number().over(within) - 1)
            .join(firsts, ["shard", "_bucket"])
            .withColumn("slot", (F.col("_first") + F.col("_rank")).cast("long"))
            .drop("_bucket", "_rank", "_first"))


def shard_documents(docs: DataFrame, weights: Sequence[float], key: str = "doc_id", text: str = "text",
                    new_weight: float = 1.0) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot, and the shard after one more shard joins."""
    body = text_or_empty(text)
    k = F.coalesce(F.col(key).cast("string"), F.lit(""))
    n = len(weights)
    assigned = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        rendezvous(k, weights).alias("shard"),
        rendezvous(k, [*weights, new_weight]).alias("grown_shard"),
    )
    assert n > 0
    # the small columns are kept once, so that texts are read and hashed only once
    return with_slots(stored(assigned, "shards"), ["doc_id", "text_crc32", "size"])


SHARDS = 40


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_documents(read_table(spark, sf_dir, "documents"), [1.0] * SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
