"""Which partitions hold a key, without reading the table's keys.

The index of a partitioned table has a row per partition and block of keys.  A block is
``BLOCK`` consecutive values of one integer key column, and its bitmap has a bit per value,
so the index is exact and has no false answers either way.  Keys that are given out
in order make few blocks per partition; an order that moved adds one block to its new
partition, not a wider range.  A merge reduces its source to one bitmap per block, meets the
index on the block alone and keeps the partitions whose bitmap shares a bit.  What a run reads
follows the blocks its source touches, not the history of the table.

A NULL key has a block of its own, so that null-safe merges find it.  Of a composite key only
one column is indexed: the partitions found are then a superset, which a merge narrows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 32_768  # bits of one Spark bitmap
NULL_BLOCK = -(1 << 62)


def block_of(key: Column) -> Column:
    # 2 ** 15 values a block: the arithmetic shift is a floor division, for negative keys too
    return F.coalesce(F.shiftright(key.cast("bigint"), 15), F.lit(NULL_BLOCK))


def bit_of(key: Column) -> Column:
    return F.coalesce(F.pmod(key.cast("bigint"), F.lit(BLOCK)), F.lit(0))


def key_bitmaps(rows: DataFrame, key: str, partition_col: str | None = None) -> DataFrame:
    """(partition value,) block, keys (bitmap) of the rows; partial bitmaps meet before the shuffle."""
    by = [] if partition_col is None else [F.col(partition_col)]
    return (rows.select(*by, block_of(F.col(key)).alias("block"), bit_of(F.col(key)).alias("bit"))
            .groupBy(*by, "block").agg(F.bitmap_construct_agg(F.col("bit")).alias("keys")))


def partitions_holding(index: DataFrame, keys: DataFrame, key: str, partition_col: str) -> DataFrame:
    """The partition values (one column, distinct) that hold at least one of ``keys``."""
    wanted = key_bitmaps(keys, key).withColumnRenamed("keys", "wanted")
    both = index.join(wanted, "block").select(partition_col, "block", F.explode(F.array("keys", "wanted")).alias("b"))
    shared = both.groupBy(partition_col, "block").agg(F.bitmap_and_agg(F.col("b")).alias("b"))
    return shared.where(F.bitmap_count("b") > 0).select(partition_col).distinct()


def merged(old: DataFrame, new: DataFrame, partition_col: str) -> DataFrame:
    """The index that answers for both inputs."""
    return (old.select(partition_col, "block", "keys").unionByName(new.select(partition_col, "block", "keys"))
            .groupBy(partition_col, "block").agg(F.bitmap_or_agg(F.col("keys")).alias("keys")))
