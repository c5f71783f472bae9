"""A4 as sets that can be merged: exact distinct counts of whole-number ids at any level.

A count of distinct orders cannot be added up: an order with lines in two categories counts in
each of them but once in the day.  ``id_sets`` keeps, per group and block of 64 ids, one whole
number with a bit per id seen; ``merge_sets`` gives the sets of a
coarser level and ``count_sets`` their sizes.  Stored per day they answer for any span of days
and any roll-up without the lines.  Sets are exact, and partial sets meet before each shuffle.
A group whose ids lie far apart costs a short row per id, never a wide bitmap for each.
NULL ids count nowhere, as in ``COUNT(DISTINCT ...)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 6  # 64 ids a block: the bits of a bigint


def id_sets(rows: DataFrame, by: Sequence[str], id_col: str) -> DataFrame:
    """``by``, block, ids (a bit each): the ids of each group."""
    k = F.col(id_col).cast("bigint")
    # the arithmetic shift is a floor division, for negative ids too
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(k, F.lit(1 << BLOCK_BITS)).cast("int"))
    return (rows.where(F.col(id_col).isNotNull())
            .select(*by, F.shiftright(k, BLOCK_BITS).alias("block"), bit.alias("ids"))
            .groupBy(*by, "block").agg(F.bit_or("ids").alias("ids")))


def merge_sets(sets: DataFrame, by: dict[str, Column | str]) -> DataFrame:
    """The sets of a coarser level: name -> column of ``sets`` (or an expression of them) to keep."""
    keys = [(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in by.items()]
    return sets.select(*keys, "block", "ids").groupBy(*by, "block").agg(F.bit_or("ids").alias("ids"))


def count_sets(sets: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """``by`` and the number of distinct ids."""
    return sets.groupBy(*by).agg(F.sum(F.bit_count("ids")).cast("bigint").alias(name))
