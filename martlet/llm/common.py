"""Helpers the operators share: scratch tables in the shared folder, column names, text forms.

Input rules that hold for every operator of this subpackage:

* only the named key and text columns of the input are read, so extra columns,
  whatever their names, change nothing;
* a null text counts as the empty text;
* repeated rows are all kept and answered alike;
* an empty table gives an empty result with the same columns.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the white space that separates words in every operator here.
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    set_before = spark.sparkContext.getCheckpointDir()
    if set_before:
        return set_before.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="martlet-llm-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


#: A public setting of Spark 4: a query's shuffle files go when the query has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: A public setting: rows that go to a Python worker at a time.
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXT_ROWS = 2000  # whole texts at a time: both sides of the exchange hold a batch


def stored(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends there.

    The shuffle files behind it are not needed any more and are removed with the write.
    ``batch_rows``: rows that go to a Python worker at a time, if the session's number is to be less.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"
    wanted = {SHUFFLE_CLEANUP: "true"}
    if batch_rows is not None and not 0 < int(spark.conf.get(ARROW_ROWS)) <= batch_rows:
        wanted[ARROW_ROWS] = str(batch_rows)
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))


def partitions(spark: SparkSession) -> int:
    """Number of shuffle partitions the session asks for; it follows the input's size."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
