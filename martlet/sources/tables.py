"""Mart tables as Parquet directories, with keyed upserts.

Tables lie in a folder per layer (``silver``, ``gold``).  A whole-table write goes to a
fresh folder beside the table and takes its place by a rename once it is complete, so a
job that dies before leaves the old table, and one that dies between the two renames is
finished by the next reader.  A date-partitioned table rewrites only the partitions that
a merge touches: their new rows are staged in the shared folder first, so the write never
reads what it replaces, and the staged folder is removed afterwards.

A partitioned table whose merge key does not hold the partition column has a key index
beside it (``operators.keyindex``), so that a merge finds moved rows without reading the keys of
the whole table.  The index is only ever ahead of the table: before partitions are rewritten it
gets the new keys on top of the old ones, and only afterwards are the old ones taken off, so a
job that dies leaves an index that names too many partitions, never too few.  Partitions
that the index does not know count as holding any key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.operators.keyindex import key_bitmaps, merged, partitions_holding
from martlet.operators.upsert import PartitionedMerge, among, check_mergeable, merge_rows
from martlet.session import scratch_path

HIVE_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
NEXT, LAST, KEYS = "__next", "__last", "__keys"


def layer_of(name: str) -> str:
    """The layer a table belongs to, by its name."""
    return "gold" if name.startswith("fact_") else "silver"


def _by_partition(df: DataFrame, partition_by: str | None) -> DataFrame:
    """Rows of a partition together, so that each gets few files; Spark splits large ones."""
    return df.hint("rebalance", partition_by) if partition_by else df


def indexed_key(df: DataFrame, keys: Sequence[str], partition_by: str | None) -> str | None:
    """The key column of a table's index: the first whole-number key, where the keys do not name the partition."""
    if partition_by is None or partition_by in keys:
        return None
    kinds = dict(df.dtypes)
    return next((k for k in keys if kinds[k] in ("bigint", "int", "smallint", "tinyint")), None)


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.last_touched: dict[str, list | None] = {}  # partition values each upsert rewrote

    def path(self, name: str) -> str:
        return f"{self.root}/{layer_of(name)}/{name}"

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def _delete(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    def _rename(self, a: str, b: str) -> None:
        fs, p = self._fs(a)
        if not fs.rename(p, self._fs(b)[1]):
            raise OSError(f"could not rename {a} to {b}")

    def _switch(self, name: str) -> None:
        """Put the complete folder beside the table in its place."""
        path = self.path(name)
        if self._exists(path):
            self._delete(path + LAST)
            self._rename(path, path + LAST)
        self._rename(path + NEXT, path)
        self._delete(path + LAST)

    def read(self, name: str) -> DataFrame | None:
        """The table, or None where there is none; any other fault is raised."""
        path = self.path(name)
        if not self._exists(path) and self._exists(f"{path}{NEXT}/_SUCCESS"):
            self._switch(name)  # a job died between the two renames
        try:
            return self.spark.read.parquet(path)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def exists(self, name: str) -> bool:
        return self.read(name) is not None

    def overwrite(self, name: str, df: DataFrame, partition_by: str | None = None, index_key: str | None = None) -> DataFrame:
        """Full refresh (``materialized='table'``): one write, then the switch."""
        w = _by_partition(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "static")
        if partition_by:
            w = w.partitionBy(partition_by)
        w.parquet(self.path(name) + NEXT)
        self._delete(self.path(name) + KEYS)  # no index says: any partition may hold any key
        self._switch(name)
        out = self.read(name)
        if index_key is not None and partition_by is not None:
            self._write_index(name, key_bitmaps(out, index_key, partition_by), partition_by)
        return out

    # key index ------------------------------------------------------------

    def key_index(self, name: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(self.path(name) + KEYS)
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def _write_index(self, name: str, rows: DataFrame, partition_by: str) -> None:
        (_by_partition(rows, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(partition_by).parquet(self.path(name) + KEYS))

    def partition_values(self, path: str, partition_by: str) -> set[str]:
        """The partition folders' values, as text."""
        fs, p = self._fs(path)
        if not fs.exists(p):
            return set()
        names = (s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())
        return {n.split("=", 1)[1] for n in names if n.startswith(partition_by + "=")}

    def candidates(self, name: str, wanted: DataFrame, key: str, partition_by: str) -> list | None:
        """Partition values that may hold one of the keys ``wanted``; None where there is no index."""
        index = self.key_index(name)
        if index is None:
            return None
        unknown = self.partition_values(self.path(name), partition_by) - self.partition_values(self.path(name) + KEYS, partition_by)
        found = [r[0] for r in partitions_holding(index, wanted, key, partition_by).collect()]  # bounded by the calendar
        if unknown:
            target = self.read(name).select(partition_by)
            kind = dict(target.dtypes)[partition_by]
            row = self.spark.createDataFrame([(None if v == HIVE_NULL_PARTITION else v,) for v in sorted(unknown)], "v string")
            found += [r[0] for r in row.select(F.col("v").cast(kind)).collect()]
        return list(dict.fromkeys(found))

    def _index_ahead(self, name: str, rewritten: DataFrame, key: str, partition_by: str, touched: list, path: str) -> DataFrame:
        """Add the new rows' keys to the touched partitions' index; returns (stored at ``path``) what it holds in the end."""
        new = key_bitmaps(rewritten, key, partition_by)
        new.write.parquet(path)
        new = self.spark.read.schema(new.schema).parquet(path)
        old = self.key_index(name)
        if old is not None:
            both = merged(old.where(among(partition_by, touched)), new, partition_by)
            ahead = scratch_path(self.spark, f"{name}-keys-ahead")
            both.write.parquet(ahead)  # it reads what it replaces
            self._write_index(name, self.spark.read.schema(both.schema).parquet(ahead), partition_by)
            self._delete(ahead)
        return new

    def upsert(self, name: str, df: DataFrame, keys: Sequence[str], partition_by: str | None = None,
               null_safe: bool = True, check: bool = True, deletes: DataFrame | None = None) -> DataFrame:
        """Incremental model: first run writes, later runs merge on ``keys``."""
        target = self.read(name)
        self.last_touched[name] = None  # everything, unless the partitions below tell
        index_key = indexed_key(df, keys, partition_by)
        if target is None:
            return self.overwrite(name, df, partition_by, index_key)
        staged = [scratch_path(self.spark, f"{name}-src"), scratch_path(self.spark, f"{name}-merged")]
        try:
            df.write.parquet(staged[0])
            src = self.spark.read.schema(df.schema).parquet(staged[0])
            candidates = None
            if index_key is not None and set(src.columns) == set(target.columns):
                wanted = src.select(index_key)
                if deletes is not None and index_key in deletes.columns:
                    wanted = wanted.union(deletes.select(index_key))
                if deletes is None or index_key in deletes.columns:
                    candidates = self.candidates(name, wanted, index_key, partition_by)
            if check:
                near = target if candidates is None else target.where(among(partition_by, candidates))
                check_mergeable(near, src, keys, null_safe)
            if partition_by is None or set(src.columns) != set(target.columns):
                # whole table; also when the columns changed (U3), so that no partition keeps the old schema
                return self.overwrite(name, merge_rows(target, src, keys, null_safe, deletes), partition_by, index_key)
            pm = PartitionedMerge.plan(target, src, keys, partition_by, null_safe, deletes, candidates)
            self.last_touched[name] = list(pm.touched)
            pm.rewritten.write.parquet(staged[1])
            rewritten = self.spark.read.schema(pm.rewritten.schema).parquet(staged[1])
            self.replace_partitions(name, rewritten, partition_by, pm.touched, index_key)
        finally:
            for path in staged:
                self._delete(path)
        return self.read(name)

    def replace(self, name: str, df: DataFrame, keys: Sequence[str], partition_by: str, values: list) -> None:
        """``df``, computed once, in place of all rows of the partitions ``values``."""
        path = scratch_path(self.spark, f"{name}-replace")
        try:
            df.write.parquet(path)
            self.replace_partitions(name, self.spark.read.schema(df.schema).parquet(path), partition_by, values,
                                    indexed_key(df, keys, partition_by))
        finally:
            self._delete(path)

    def replace_partitions(self, name: str, rows: DataFrame, partition_by: str, values: list,
                           index_key: str | None = None) -> None:
        """Write ``rows``, a stored table, over the partitions ``values``; one without rows goes."""
        scratch = scratch_path(self.spark, f"{name}-keys")
        new = None if index_key is None else self._index_ahead(name, rows, index_key, partition_by, values, scratch)
        present = {r[0] for r in rows.select(partition_by).distinct().collect()}
        (_by_partition(rows, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(partition_by).parquet(self.path(name)))
        gone = [v for v in values if v not in present]
        for v in gone:
            self._delete(f"{self.path(name)}/{partition_by}={HIVE_NULL_PARTITION if v is None else v}")
        if new is not None:
            self._write_index(name, new, partition_by)
            for v in gone:
                self._delete(f"{self.path(name)}{KEYS}/{partition_by}={HIVE_NULL_PARTITION if v is None else v}")
            self._delete(scratch)
