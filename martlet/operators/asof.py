"""As-of join and slowly changing dimension (type 2) on plain DataFrames.

``as_of_join`` gives each row of the left side the right side's values that held at its time.
The left side is reduced to its distinct (key, time) pairs first, so a key with a third of all
rows is as many pairs as it has times (days, for the mart).  Pairs and versions are
sorted together per key, the last version is carried forward, and the answers go back to the
rows by an equal join on (key, time), which adaptive execution splits where it is skewed.  No
pair of a row and a version that does not hold is ever made.

``versions`` turns dated observations into intervals; ``extend_versions`` adds a new snapshot to
a stored history.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The first known version holds before it was first seen, too.
SINCE_EVER = dt.date(1900, 1, 1)


def as_of(left: DataFrame, history: DataFrame, by: Sequence[str], time: str, since: str, values: Sequence[str]) -> DataFrame:
    """``left`` with the values of the newest version whose ``since`` is not after ``time``.

    For a left side of few rows per key (one per day, say): a key's rows and versions are
    sorted in one task.  A row before the first version, or with a NULL time or key, gets NULLs.
    A version counts as a whole: its NULL values hide older ones.  ``since`` is unique per key.
    """
    rows = left.select(*by, F.col(time).alias("_t"), F.lit(1).alias("_order"), F.struct(*left.columns).alias("_row"))
    kind = dict(rows.dtypes)["_t"]
    held = (history.where(F.col(since).isNotNull())
            .select(*by, F.col(since).cast(kind).alias("_t"), F.lit(0).alias("_order"), F.struct(*values).alias("_v")))
    # at the same time the version comes first
    order = Window.partitionBy(*by).orderBy(F.col("_t").asc_nulls_first(), "_order")
    last = F.last("_v", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    both = rows.unionByName(held, allowMissingColumns=True).withColumn("_held", last).where("_order = 1")
    known = F.col("_t").isNotNull()
    for k in by:  # NULL keys never match
        known = known & F.col(k).isNotNull()
    return both.select("_row.*", *[F.when(known, F.col(f"_held.{v}")).alias(v) for v in values])


def as_of_join(left: DataFrame, history: DataFrame, by: Sequence[str], time: str, since: str, values: Sequence[str]) -> DataFrame:
    """``left``, of any number of rows per key, with the values that held at its time."""
    points = as_of(left.select(*by, time).distinct(), history, by, time, since, values)
    return left.join(points, [*by, time], "left")


def versions(observed: DataFrame, key: str, since: str, values: Sequence[str], first_since: dt.date | None = SINCE_EVER) -> DataFrame:
    """Dated observations -> key, values, valid_from, valid_to (exclusive, NULL: open), valid_from unique per key.

    An observation equal to the one before it opens no version.  Of several observations of a key
    on one day the greatest (by the values) counts.  ``first_since`` opens each key's first version.
    """
    day = observed.groupBy(key, since).agg(F.max(F.struct(*values)).alias("_v"))
    by_time = Window.partitionBy(key).orderBy(since)
    before = F.lag("_v").over(by_time)
    first = F.row_number().over(by_time) == 1
    changed = (day.withColumn("_first", first).withColumn("_new", first | ~F.col("_v").eqNullSafe(before))
               .where("_new"))
    start = F.col(since).cast("date")
    if first_since is not None:
        start = F.when(F.col("_first"), F.lit(first_since)).otherwise(start)
    opened = changed.select(key, *[F.col(f"_v.{v}").alias(v) for v in values], start.alias("valid_from"))
    return opened.withColumn("valid_to", F.lead("valid_from").over(Window.partitionBy(key).orderBy("valid_from")))


def extend_versions(history: DataFrame, snapshot: DataFrame, key: str, values: Sequence[str], day: dt.date) -> DataFrame:
    """The history after the snapshot of ``day``: a changed key's open version is closed and a new one opened.

    Snapshots come in the order of their days (an older one raises); the newest day may be
    given again and is judged anew, so a repeated run changes nothing.  A new key opens at
    ``SINCE_EVER``; a key that the snapshot lacks stays as it is.
    """
    newest = history.agg(F.max("valid_from")).first()[0]
    if newest is not None and newest > day:
        raise ValueError(f"the history holds a version of {newest}, later than the snapshot of {day}")
    on = F.lit(day)
    shape = [key, *values, "valid_from", "valid_to"]
    # what this very day opened or closed is taken back first
    before = history.where(F.col("valid_from") < on).withColumn(
        "valid_to", F.when(F.col("valid_to") < on, F.col("valid_to")))
    now = snapshot.groupBy(key).agg(F.max(F.struct(*values)).alias("_now"))
    last = before.where("valid_to is null").withColumn("_old", F.struct(*values))
    j = last.join(now, key, "full_outer")
    had, has = F.col("_old").isNotNull(), F.col("_now").isNotNull()
    changed = had & has & ~F.col("_now").eqNullSafe(F.col("_old"))
    kept = j.where(had).withColumn("valid_to", F.when(changed, on)).select(*shape)
    new = j.where((has & ~had) | changed).select(
        key, *[F.col(f"_now.{v}").alias(v) for v in values],
        F.when(had, on).otherwise(F.lit(SINCE_EVER)).alias("valid_from"), F.lit(None).cast("date").alias("valid_to"))
    return before.where("valid_to is not null").select(*shape).unionByName(kept).unionByName(new)
