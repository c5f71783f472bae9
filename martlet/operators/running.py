"""Running sum over a global order without one-partition windows.

``Window.orderBy(...)`` with no partition moves every row into one task.
Here a first job finds cut points of the order, one per range; they are literals
from then on.  Each row's range follows from comparing it with them, so every branch
of the plan assigns the same ranges whatever columns it reads and however it is run.
The per-range totals (one row per range) become offsets, added to a window running
inside each range.  The order ends with a unique key, so no value can fill a range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGE_COL = "_range"


def cut_points(df: DataFrame, order: Sequence[Column], ranges: int) -> list[tuple]:
    """Least key of each range of a range partitioning but the first; at most ``ranges - 1`` rows."""
    keys = df.select(*[c.alias(f"k{i}") for i, c in enumerate(order)])
    key = F.struct(*keys.columns)
    least = (keys.repartitionByRange(ranges, *[F.col(c) for c in keys.columns])
             .groupBy(F.spark_partition_id().alias("p")).agg(F.min(key).alias("k")).collect())
    return [tuple(k) for k in sorted(tuple(r["k"]) for r in least)[1:]]


def range_of(order: Sequence[Column], cuts: list[tuple], types: Sequence[str]) -> Column:
    """Number of cut points at or below the row's key, by halving."""
    key = F.struct(*[c.cast(t).alias(f"k{i}") for i, (c, t) in enumerate(zip(order, types))])

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        cut = F.struct(*[F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(cuts[mid], types))])
        return F.when(key < cut, search(lo, mid)).otherwise(search(mid + 1, hi))

    return search(0, len(cuts))


def running_sum(df: DataFrame, value: str, order: Sequence[Column], out: str = "running_total",
                ranges: int | None = None, total_out: str | None = None) -> DataFrame:
    """``df`` plus ``out`` = SUM(value) over all rows up to and including this
    one, and, with ``total_out``, the sum over all rows.

    ``order``: columns without nulls, all ascending (negate a number to descend), that
    together are unique.
    """
    n = ranges or max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    types = [f.dataType.simpleString() for f in df.select(*order).schema.fields]
    ranged = df.withColumn(RANGE_COL, range_of(order, cut_points(df, order, n), types))
    per_range = ranged.groupBy(RANGE_COL).agg(F.sum(value).alias("_range_total"))
    # at most n rows: a single-partition window over them is fine
    before = Window.orderBy(RANGE_COL).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(RANGE_COL).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = per_range.select(
        RANGE_COL,
        F.coalesce(F.sum("_range_total").over(before), F.lit(0)).alias("_offset"),
        F.sum("_range_total").over(everything).alias("_grand_total"))
    inside = Window.partitionBy(RANGE_COL).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    j = ranged.join(offsets, RANGE_COL)
    j = j.withColumn(out, F.coalesce(F.sum(value).over(inside), F.lit(0)) + F.col("_offset"))
    if total_out:
        j = j.withColumnRenamed("_grand_total", total_out)
    return j.drop(RANGE_COL, "_offset", "_grand_total")
