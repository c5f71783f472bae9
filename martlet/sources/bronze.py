"""Landed NDJSON: read, split header rows, explode order lines, land.

Layout (as the extraction writes it)::

    <root>/sales_data/dt=<window end>/*.json    one order per line + one header row
    <root>/products_data/*.json                 one product per line + one header row
    <root>/dim_data/categories|channels|statuses/*.json

Every file carries a header row ``{"metadata": {...}}``.  Reads use declared
schemas and PERMISSIVE mode: a line that is no JSON lands in ``_corrupt_record``
instead of failing the job and is kept out of the data rows; a record with a bad
field stays, with that field NULL.  Both kinds go to the quarantine rows.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.sources import schemas as S
from martlet.sources.fixtures import RawSources
from martlet.sources.tables import HIVE_NULL_PARTITION, TableStore

SALES_DIR, PRODUCTS_DIR = "sales_data", "products_data"
LOOKUP_DIRS = {"categories": "dim_data/categories", "channels": "dim_data/channels",
               "statuses": "dim_data/statuses"}
LOOKUP_SCHEMAS = {"categories": S.RAW_CATEGORIES, "channels": S.RAW_CHANNELS, "statuses": S.RAW_STATUSES}


def read_landed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """schema'd, permissive NDJSON read; ``dt`` comes from the folder names."""
    return (spark.read.schema(schema)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", S.CORRUPT)
            .json(path))


def parse_lines(lines: DataFrame, schema: T.StructType, whole: bool = False) -> DataFrame:
    """S1-S6 for lines already read as text (``value``, and ``dt`` if they have it).

    Each line is parsed once: the fields come out of a generator, into which later
    projections are not folded (they would repeat the parse for every field they name).
    ``whole`` keeps the record as it came in a VARIANT column ``record`` too, with the fields
    that the schema does not declare (NULL for a line that is no JSON).
    """
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": S.CORRUPT})
    keys = ["dt"] if "dt" in lines.columns else []
    record = [F.try_parse_json("value").alias("record")] if whole else []
    return lines.select(F.inline(F.array(parsed)), *keys, *record)


def read_landed_whole(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """As ``read_landed``, each line with its whole record as VARIANT beside the declared fields."""
    return parse_lines(spark.read.text(path), schema, whole=True)


def undeclared(rows: DataFrame, path: str, kind: str = "string"):
    """A field of the whole record by its JSON path, whether the schema lists it or not; NULL where it is missing."""
    return F.try_variant_get(rows["record"], path, kind)


def _record(raw: DataFrame) -> str:
    return "data" if "data" in raw.columns else "id"


def data_rows(raw: DataFrame) -> DataFrame:
    """Records only (no header row, no line without a record)."""
    return raw.where(F.col("metadata").isNull() & F.col(_record(raw)).isNotNull()).drop("metadata", S.CORRUPT)


def header_rows(raw: DataFrame) -> DataFrame:
    """The header rows, one per landed file."""
    cols = ["metadata"] + (["dt"] if "dt" in raw.columns else [])
    return raw.where(F.col("metadata").isNotNull()).select(*cols)


def quarantine_rows(raw: DataFrame) -> DataFrame:
    """The text of every line that did not parse as declared, and whether a record was kept from it."""
    cols = [S.CORRUPT] + (["dt"] if "dt" in raw.columns else [])
    return raw.where(F.col(S.CORRUPT).isNotNull()).select(*cols, F.col(_record(raw)).isNotNull().alias("kept"))


def split_sales(sales: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(orders, lines) from landed order records.

    Orders keep the record without its line array.  Lines are exploded in
    place (N1: ``explode`` drops records whose array is NULL or empty) and
    keep the ids of their own record's header (date text, status) and ``dt``,
    so no later step has to join lines back to orders to find them.  Both are
    narrow projections of the same scan.
    """
    landed = [c for c in ("dt", "epoch") if c in sales.columns]
    orders = sales.select(F.col("data").dropFields("itens").alias("data"), *landed)
    lines = sales.select(
        F.struct(F.col("data.id").alias("id"), F.col("data.data").alias("data"),
                 F.col("data.situacao").alias("situacao")).alias("data"),
        *landed,
        F.explode("data.itens").alias("item"))
    return orders, lines


def sources_of(sales: DataFrame, products: DataFrame, lookups: dict[str, DataFrame]) -> RawSources:
    """The raw inputs of the mart from parsed rows (headers and quarantined lines still among them)."""
    orders, lines = split_sales(data_rows(sales))
    return RawSources(sales_orders=orders, sales_items=lines, products=data_rows(products),
                      **{k: data_rows(v) for k, v in lookups.items()})


def _landed(spark: SparkSession, root: str, dates: tuple | None) -> tuple[DataFrame, DataFrame, dict]:
    root = root.rstrip("/")
    sales = read_landed(spark, f"{root}/{SALES_DIR}", S.RAW_SALES)
    if dates is not None:
        first, last = dates
        sales = sales.where(F.col("dt") >= F.lit(first)) if first is not None else sales
        sales = sales.where(F.col("dt") <= F.lit(last)) if last is not None else sales
    products = read_landed(spark, f"{root}/{PRODUCTS_DIR}", S.RAW_PRODUCTS)
    return sales, products, {k: read_landed(spark, f"{root}/{d}", LOOKUP_SCHEMAS[k]) for k, d in LOOKUP_DIRS.items()}


def read_sources(spark: SparkSession, root: str) -> RawSources:
    """Landed files -> the raw inputs of the mart, as one lazy plan (each use parses the files)."""
    return sources_of(*_landed(spark, root, None))


def _landing_metrics(days: list) -> list:
    """Aggregates of E4 for known ``dt`` values, to be observed on a write."""
    record = F.col("metadata").isNull() & F.col("data").isNotNull()
    declared = F.get_json_object("metadata", "$.total_orders").try_cast("bigint")
    out = [F.count(F.lit(1)).alias("lines")]
    for i, d in enumerate(days):
        here = F.col("dt").eqNullSafe(F.lit(d))
        out += [F.max(F.when(here, declared)).alias(f"declared_{i}"),
                F.count_if(here & F.col("metadata").isNotNull()).alias(f"headers_{i}"),
                F.count_if(here & record).alias(f"landed_{i}"),
                F.count_if(here & F.col(S.CORRUPT).isNotNull()).alias(f"quarantined_{i}")]
    return out


OBSERVED_DAYS = 31  # four counters a day are evaluated for every line
AUDIT_SCHEMA = "dt date, declared_rows bigint, landed_rows bigint, quarantined_rows bigint, count_matches boolean"


def observed_write(sales: DataFrame, days: list, write) -> DataFrame:
    """``write(sales)`` and the run audit (E4) of what was written, counted by the write itself.

    ``days`` are the ``dt`` values of the landing.  A ``dt`` has one header; of several the
    greatest count is taken.
    """
    seen = Observation()
    write(sales.observe(seen, *_landing_metrics(days)))
    m = seen.get
    rows = [(d, m[f"declared_{i}"], m[f"landed_{i}"], m[f"quarantined_{i}"], m[f"declared_{i}"] == m[f"landed_{i}"])
            for i, d in enumerate(days) if m[f"headers_{i}"]]
    return sales.sparkSession.createDataFrame(rows, AUDIT_SCHEMA)


def landed_days(spark: SparkSession, root: str, dates: tuple | None = None) -> list:
    """The ``dt`` folders of the landed orders, within ``dates`` if given."""
    names = TableStore(spark, root).partition_values(f"{root.rstrip('/')}/{SALES_DIR}", "dt")
    days = sorted(dt.date.fromisoformat(n) for n in names if n != HIVE_NULL_PARTITION)
    first, last = dates or (None, None)
    return [d for d in days if (first is None or d >= first) and (last is None or d <= last)]


def ingest_audited(spark: SparkSession, root: str, bronze_root: str, dates: tuple | None = None,
                   only_sales: bool = False) -> tuple[RawSources, DataFrame]:
    """``ingest`` and the run audit of the order files.

    A weekly run's counts come from the write that parses the files.  A first load of more than
    ``OBSERVED_DAYS`` folders is counted by group from the parsed table instead.
    """
    days = landed_days(spark, root, dates)
    if len(days) > OBSERVED_DAYS:
        raw = ingest(spark, root, bronze_root, dates, only_sales)
        kept = spark.read.schema(_landed(spark, root, dates)[0].schema).parquet(f"{bronze_root.rstrip('/')}/sales")
        return raw, run_audit(kept.where(F.col("dt").between(F.lit(days[0]), F.lit(days[-1])))).select(
            "dt", "declared_rows", "landed_rows", "quarantined_rows", "count_matches")
    audit = []
    raw = ingest(spark, root, bronze_root, dates, only_sales,
                 lambda sales, write: audit.append(observed_write(sales, days, write)))
    return raw, audit[0]


def ingest(spark: SparkSession, root: str, bronze_root: str, dates: tuple | None = None,
           only_sales: bool = False, around=lambda sales, write: write(sales)) -> RawSources:
    """Parse the landed files once into Parquet under ``bronze_root`` and read the inputs from there.

    ``dates`` (first, last) limits the order files to those ``dt`` folders; the bronze
    folders of other dates stay.  Lines that did not parse go to ``quarantine`` with theirs.
    """
    bronze_root = bronze_root.rstrip("/")
    sales, products, lookups = _landed(spark, root, dates)
    around(sales, lambda rows: rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt")
           .parquet(f"{bronze_root}/sales"))
    kept = spark.read.schema(sales.schema).parquet(f"{bronze_root}/sales")
    if dates is not None:
        kept = kept.where(F.col("dt").between(*[F.lit(d) for d in (dates[0] or dt.date.min, dates[1] or dt.date.max)]))
    (quarantine_rows(kept).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt")
     .parquet(f"{bronze_root}/quarantine"))
    if not only_sales:
        for name, df in (("products", products), *lookups.items()):
            df.write.mode("overwrite").parquet(f"{bronze_root}/{name}")
            df = spark.read.schema(df.schema).parquet(f"{bronze_root}/{name}")
            if name == "products":
                products = df
            else:
                lookups[name] = df
    return sources_of(kept, products, lookups)


def _with_header(records: DataFrame, metadata: dict) -> DataFrame:
    """Records plus one header row whose ``metadata`` is written as a JSON object."""
    spark = records.sparkSession
    meta_schema = T.StructType([T.StructField(k, T.LongType() if isinstance(v, int) else T.StringType())
                                for k, v in metadata.items()])
    header = spark.createDataFrame(
        [tuple(v if (v is None or isinstance(v, int)) else str(v) for v in metadata.values())], meta_schema)
    header = header.select(F.struct(*[F.col(k) for k in metadata]).alias("metadata"))
    return records.unionByName(header, allowMissingColumns=True)


def land_sales(records: DataFrame, root: str, window_end: dt.date, metadata: dict) -> bool:
    """Land order records under ``dt=<window end>``; nothing is written when empty.

    Dynamic partition overwrite replaces that one ``dt`` folder only.
    """
    if records.isEmpty():
        return False
    rows = _with_header(records.select("data"), metadata).withColumn("dt", F.lit(window_end))
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("dt").json(f"{root.rstrip('/')}/{SALES_DIR}"))
    return True


def land_full(records: DataFrame, path: str, metadata: dict) -> None:
    """Replace a whole product or lookup list."""
    _with_header(records, metadata).write.mode("overwrite").json(path)


def run_audit(raw: DataFrame) -> DataFrame:
    """Header rows parsed, next to the number of data rows and quarantined lines landed beside them.

    One row per header (per ``dt`` for orders); the counts are those of the same
    ``dt`` (or of the whole list).
    """
    keys = ["dt"] if "dt" in raw.columns else []
    meta = header_rows(raw).select(*keys, F.from_json("metadata", S.RUN_METADATA).alias("m"))
    meta = meta.select(*keys, "m.*")
    declared = F.coalesce(F.col("total_orders"), F.col("total_products"), F.col("total_records"))
    record = F.col("metadata").isNull() & F.col(_record(raw)).isNotNull()
    counts = [F.count_if(record).alias("landed_rows"), F.count_if(F.col(S.CORRUPT).isNotNull()).alias("quarantined_rows")]
    if keys:
        out = meta.join(raw.groupBy(*keys).agg(*counts), keys, "left")
    else:  # one list: a one-row count
        n = raw.agg(*counts).first()
        out = meta.withColumns({k: F.lit(n[k]).cast("bigint") for k in ("landed_rows", "quarantined_rows")})
    return out.withColumn("declared_rows", declared).withColumn(
        "count_matches", F.coalesce(F.col("declared_rows") == F.col("landed_rows"), F.lit(False)))


def metadata_for_run(params: dict, successful: int, failed: int, batches: int, total: int,
                     total_key: str = "total_orders") -> dict:
    """The header block of one landed file."""
    return {
        "extraction_timestamp": dt.datetime.now(dt.timezone.utc).isoformat(),
        "extraction_params": json.dumps(params, ensure_ascii=False),
        "successful_extractions": successful,
        "failed_extractions": failed,
        "batches_processed": batches,
        total_key: total,
    }
