"""Incremental bronze ingest of landed order files with Structured Streaming.

The landing folder is read as a file-source stream with the declared raw
schema (``dt`` comes from the ``dt=`` folder names), so each run parses only
files it has not seen; the stream's checkpoint records which.  Each
micro-batch is split into header rows, order records, exploded lines and lines that
did not parse, and
written under ``epoch=<batch id>``, overwriting that folder: a batch retried
after a failure rewrites the same folder, so the bronze tables stay
exactly-once.  ``Trigger.AvailableNow`` processes what is there and stops,
which suits a weekly job; a continuous trigger works the same way.

``merge_sales`` goes on to silver and gold: each micro-batch is merged by key (U1).  What is merged
are the orders that the batch brought, as the newest of all their landings has them, so a file
that arrives late does not undo a newer one.  An epoch that was merged is noted beside the
bronze tables and skipped when it comes again; one that died before the note is merged once
more, which gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from martlet.plans import refresh, silver, staging
from martlet.sources import bronze
from martlet.sources import schemas as S
from martlet.sources.fixtures import RawSources
from martlet.sources.tables import TableStore

STREAM_SALES = T.StructType(S.RAW_SALES.fields + [T.StructField("dt", T.DateType(), True)])


def _write_epoch(df: DataFrame, path: str, epoch: int) -> None:
    (df.withColumn("epoch", F.lit(epoch)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("epoch", "dt").parquet(path))


def _write_bronze(batch: DataFrame, epoch: int, bronze_root: str) -> None:
    batch = batch.persist()  # parsed once, written four times
    try:
        orders, lines = bronze.split_sales(bronze.data_rows(batch))
        for name, rows in (("orders", orders), ("items", lines), ("headers", bronze.header_rows(batch)),
                           ("quarantine", bronze.quarantine_rows(batch))):
            _write_epoch(rows, f"{bronze_root}/sales_{name}", epoch)
    finally:
        batch.unpersist()


def _stream(spark: SparkSession, landing_root: str, checkpoint: str, per_batch, available_now: bool,
            max_files_per_trigger: int | None) -> StreamingQuery:
    reader = (spark.readStream.schema(STREAM_SALES)
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", S.CORRUPT))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.json(f"{landing_root.rstrip('/')}/{bronze.SALES_DIR}")
    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def ingest_sales(spark: SparkSession, landing_root: str, bronze_root: str, checkpoint: str,
                 available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    bronze_root = bronze_root.rstrip("/")
    return _stream(spark, landing_root, checkpoint, lambda batch, epoch: _write_bronze(batch, epoch, bronze_root),
                   available_now, max_files_per_trigger)


def merge_epoch(spark: SparkSession, bronze_root: str, mart_root: str, epoch: int, null_safe: bool = True,
                delete_cancelled: bool = False) -> list | None:
    """Merge the bronze rows of one epoch into silver and gold; the order dates touched ([] if it was merged before)."""
    note = f"{bronze_root}/merged_epochs/epoch={epoch}"
    store = TableStore(spark, mart_root)
    if store._exists(f"{note}/_SUCCESS"):
        return []
    orders, lines = read_bronze_sales(spark, bronze_root)
    came = orders.where(F.col("epoch") == epoch)
    since = came.agg(F.min("dt")).first()[0]
    touched: list | None = []
    if since is not None:
        # older landings cannot replace these, so only folders from the batch's first on are read
        ids = came.select(F.col("data.id").alias("_id")).distinct()
        newer = lambda rows: rows.where(F.col("dt") >= F.lit(since)).join(ids, F.col("data.id") == F.col("_id"), "left_semi")
        statuses = store.read("dim_sales_status")
        typed = staging.stg_orders(newer(orders), with_dt=True)
        gone = silver.cancelled_orders(typed, statuses) if delete_cancelled else None
        items = silver.silver_order_items(staging.stg_order_items(newer(lines), with_order_header=True), statuses)
        if gone is not None:
            items = items.join(gone, "order_id", "left_anti").select(*items.columns)
        for (name, keys), rows in ((refresh.SILVER_ORDERS, silver.silver_orders(typed, statuses)), (refresh.SILVER_ITEMS, items)):
            store.upsert(name, rows, keys, partition_by=refresh.DAY, null_safe=null_safe, deletes=gone)
            dates = store.last_touched[name]
            touched = None if dates is None or touched is None else touched + dates
        refresh.refresh_gold(store, null_safe, None if touched is None else list(dict.fromkeys(touched)), replace=delete_cancelled)
    spark.range(0).write.mode("overwrite").parquet(note)
    return touched


def merge_sales(spark: SparkSession, landing_root: str, bronze_root: str, mart_root: str, checkpoint: str,
                available_now: bool = True, max_files_per_trigger: int | None = None, null_safe: bool = True,
                delete_cancelled: bool = False) -> StreamingQuery:
    """U1 on a stream: landed files to bronze, silver and gold, exactly once per epoch.  The dimensions exist already."""
    bronze_root = bronze_root.rstrip("/")

    def per_batch(batch: DataFrame, epoch: int) -> None:
        _write_bronze(batch, epoch, bronze_root)
        merge_epoch(spark, bronze_root, mart_root, epoch, null_safe, delete_cancelled)

    return _stream(spark, landing_root, checkpoint, per_batch, available_now, max_files_per_trigger)


def read_bronze_sales(spark: SparkSession, bronze_root: str) -> tuple[DataFrame, DataFrame]:
    """(orders, lines) as written by ``ingest_sales``.

    ``dt`` and ``epoch`` prune, and ``epoch`` tells which of two landings of one ``dt`` is newer.
    """
    root = bronze_root.rstrip("/")
    return spark.read.parquet(f"{root}/sales_orders"), spark.read.parquet(f"{root}/sales_items")


def sources_from_bronze(spark: SparkSession, bronze_root: str, landing_root: str) -> RawSources:
    """Order inputs from the streamed bronze tables, products and lookups from the landing."""
    landed = bronze.read_sources(spark, landing_root)
    return RawSources(
        sales_orders=lambda: read_bronze_sales(spark, bronze_root)[0],
        sales_items=lambda: read_bronze_sales(spark, bronze_root)[1],
        products=lambda: landed.products,
        categories=lambda: landed.categories,
        channels=lambda: landed.channels,
        statuses=lambda: landed.statuses,
    )
