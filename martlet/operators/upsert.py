"""Keyed upsert (MERGE without a table format), U1-U5.

``merge_rows`` is the row-level result of ``MERGE INTO target USING source ON
keys WHEN MATCHED THEN UPDATE * WHEN NOT MATCHED THEN INSERT *``: target rows
whose key has no match in the source, plus every source row.  Nothing is
deleted unless asked for.  The columns are the source's (column sync: new columns appear, NULL
on old rows; dropped columns disappear).

``null_safe=False`` compares keys with ``=`` (the warehouse default): a row
with a NULL in any key never matches, so it is inserted again on every run.
``null_safe=True`` compares with ``<=>``; Spark still plans that as an
equi-join on the keys.

The anti join shuffles target and source keys on the merge key; a hot key is
split by AQE's skew-join handling.  ``PartitionedMerge`` narrows the target to
the partitions a source can touch before joining.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    """Two source rows would update one target row (the warehouse MERGE fails)."""


def _match(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool) -> Column:
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[k]) if null_safe else left[k] == right[k]
        cond = c if cond is None else cond & c
    return cond


def merge_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = True,
               deletes: DataFrame | None = None) -> DataFrame:
    """U1 + U3: the merged rows, with the source's columns.

    ``deletes`` (its columns are some of the target's) names target rows that leave, such
    as the lines of orders cancelled since.
    """
    src_keys = source.select(*keys)
    kept = target.join(src_keys, _match(target, src_keys, keys, null_safe), "left_anti")
    if deletes is not None:
        kept = kept.join(deletes, list(deletes.columns), "left_anti")
    return kept.unionByName(source, allowMissingColumns=True).select(*source.columns)


def merge_tagged(rows: DataFrame, source: Column, keys: Sequence[str], null_safe: bool = True) -> DataFrame:
    """U1 where target and source rows come from one plan: a row goes if it is not from the ``source`` and its key is.

    The plan behind ``rows`` runs once, and one exchange on the keys brings a key's rows together;
    a key has few rows.  Same rows as ``merge_rows`` of the two sides.
    """
    replaced = F.max(source).over(Window.partitionBy(*keys))
    if not null_safe:  # a NULL key matches nothing
        for k in keys:
            replaced = replaced & F.col(k).isNotNull()
    return rows.withColumn("_replaced", replaced).where(source | ~F.col("_replaced")).drop("_replaced")


def duplicate_source_keys(source: DataFrame, keys: Sequence[str], null_safe: bool = True) -> DataFrame:
    """Keys held by more than one source row (partial aggregation, then a shuffle of counts)."""
    s = source
    if not null_safe:  # a NULL key matches nothing, so it cannot update a row twice
        for k in keys:
            s = s.where(F.col(k).isNotNull())
    return s.groupBy(*keys).count().where(F.col("count") > 1).drop("count")


def check_mergeable(target: DataFrame | None, source: DataFrame, keys: Sequence[str],
                    null_safe: bool = True) -> None:
    """U4: raise if a target row would be matched by two source rows.

    Only duplicated source keys that exist in the target fail, as in the
    warehouse; duplicated keys new to the target are inserted twice.
    """
    dups = duplicate_source_keys(source, keys, null_safe)
    if not dups.limit(1).count():
        return
    if target is None:
        return
    hit = dups.join(target.select(*keys), _match(dups, target.select(*keys), keys, null_safe), "left_semi")
    bad = hit.limit(5).collect()
    if bad:
        raise DuplicateKeyError(f"source has several rows for target keys {keys}: {[r.asDict() for r in bad]}")


def among(partition_col: str, values: Sequence) -> Column:
    """Rows of the partitions ``values`` as one literal list, so that a scan prunes to them; NULL is a value."""
    part = F.col(partition_col)
    known = [v for v in values if v is not None]
    cond = part.isin(known) if known else F.lit(False)
    if len(known) < len(values):
        cond = cond | part.isNull()
    return F.coalesce(cond, F.lit(False))


@dataclass
class PartitionedMerge:
    """The merge of a date-partitioned target, limited to touched partitions.

    touched = partition values in the source, plus partition values of target
    rows whose key is in the source (an order's date may move).  The set of
    touched values is bounded by the calendar, not by the data, so it is
    collected and used as a literal IN list: the target scan then prunes to
    those partitions.

    Where the partition column is one of the keys, a row can only meet rows of its own
    partition, so the target is not read to find them.  Otherwise ``candidates`` (from
    ``operators.keyindex``) limits the search to the partitions that may hold a key; without
    them the keys of the whole target are read.
    """
    touched: list
    rewritten: DataFrame          # new content of the touched partitions

    @staticmethod
    def plan(target: DataFrame, source: DataFrame, keys: Sequence[str], partition_col: str,
             null_safe: bool = True, deletes: DataFrame | None = None,
             candidates: Sequence | None = None) -> "PartitionedMerge":
        src_keys = source.select(*keys)
        held = target.select(*dict.fromkeys([*keys, partition_col]))
        if candidates is not None:
            held = held.where(among(partition_col, candidates))
        touched_df = source.select(partition_col)
        if partition_col not in keys:
            touched_df = touched_df.union(
                held.join(src_keys, _match(held, src_keys, keys, null_safe), "left_semi").select(partition_col))
        if deletes is not None:
            touched_df = touched_df.union(held.join(deletes, list(deletes.columns), "left_semi").select(partition_col))
        touched = [r[0] for r in touched_df.distinct().collect()]
        pm = PartitionedMerge(touched, None)
        pm.rewritten = merge_rows(target.where(pm.in_touched(partition_col)), source, keys, null_safe, deletes)
        return pm

    def in_touched(self, partition_col: str) -> Column:
        return among(partition_col, self.touched)

    def full_result(self, target: DataFrame, partition_col: str) -> DataFrame:
        """The whole merged table: untouched partitions as they are, touched ones rewritten."""
        return (target.where(~self.in_touched(partition_col))
                .unionByName(self.rewritten, allowMissingColumns=True)
                .select(*self.rewritten.columns))


def incremental_bound(target: DataFrame | None, as_of: dt.date, date_col: str = "order_date",
                      lookback_days: int = 7) -> dt.date | None:
    """F4 bound from a one-row aggregate of the target; None means a first run
    (no target, or an empty one, is built in full)."""
    if target is None:
        return None
    from martlet.plans.silver import incremental_lower_bound

    mx = target.agg(F.max(date_col)).first()[0]
    if mx is None:
        return None
    return incremental_lower_bound(mx, as_of, lookback_days)
