"""Extraction audit as Spark jobs.

Input: a landed table of fetch attempts, ``extraction_attempts(run_id,
entity, batch, object_id, attempt, ok)``: attempt 0 is the batched first pass,
attempts 1..3 the sequential retries of ids that failed it.

All outputs are counts from partial aggregations; failed ids come back as
rows (``failed_ids``), never as one collected list per batch, so a batch
holding a third of all ids costs what any other batch costs.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the extraction.
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
MAX_RETRIES = 3
WEEKLY_SPAN_DAYS = 7


def weekly_window(today: dt.date) -> tuple[dt.date, dt.date]:
    """Yesterday and the six days before it, both ends inclusive."""
    end = today - dt.timedelta(days=1)
    return end - dt.timedelta(days=WEEKLY_SPAN_DAYS - 1), end


def parse_window(start: str, end: str) -> tuple[dt.date, dt.date]:
    """Explicit ``YYYY-MM-DD`` dates; anything else is rejected."""
    for name, v in (("start", start), ("end", end)):
        if not re.match(DATE_PATTERN, v or ""):
            raise ValueError(f"{name} must be in YYYY-MM-DD format, got {v!r}")
    a, b = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    return a, b


def in_window(df: DataFrame, start: dt.date, end: dt.date, col: str = "order_date") -> DataFrame:
    """rows whose date is in the window, both ends inclusive."""
    return df.where(F.col(col).between(F.lit(start), F.lit(end)))


def first_pass(attempts: DataFrame) -> DataFrame:
    return attempts.where(F.col("attempt") == 0)


def batch_summary(attempts: DataFrame) -> DataFrame:
    """Per (run, entity, batch) the first-pass successes and failures."""
    return (first_pass(attempts).groupBy("run_id", "entity", "batch").agg(
        F.count_if(F.col("ok")).alias("successful_count"),
        F.count_if(~F.col("ok")).alias("failed_count")))


def failed_ids(attempts: DataFrame) -> DataFrame:
    """Ids that failed the first pass, one row each."""
    return first_pass(attempts).where(~F.col("ok")).select("run_id", "entity", "batch", "object_id")


def retry_outcomes(attempts: DataFrame) -> DataFrame:
    """E3 per id: retried, recovered (a retry within MAX_RETRIES succeeded) or permanent."""
    failed = failed_ids(attempts).select("run_id", "entity", "object_id")
    retries = attempts.where(F.col("attempt").between(1, MAX_RETRIES))
    per_id = (retries.groupBy("run_id", "entity", "object_id")
              .agg(F.max(F.col("ok").cast("int")).alias("_any_ok"),
                   F.max("attempt").alias("attempts_used")))
    j = failed.join(per_id, ["run_id", "entity", "object_id"], "left")
    return j.select("run_id", "entity", "object_id",
                    F.coalesce(F.col("attempts_used"), F.lit(0)).alias("attempts_used"),
                    (F.coalesce(F.col("_any_ok"), F.lit(0)) == 1).alias("recovered"))


def run_summary(attempts: DataFrame) -> DataFrame:
    """E3 per run: first-pass counts, retry counts and the corrected totals.

    ``failed_extractions`` counts each permanent failure once (the source
    arithmetic ``failed - recovered + permanent`` counts it twice when every
    failed id is retried).
    """
    fp = (first_pass(attempts).groupBy("run_id", "entity").agg(
        F.count_if(F.col("ok")).alias("first_pass_ok"),
        F.count_if(~F.col("ok")).alias("first_pass_failed"),
        F.count_distinct("batch").alias("batches_processed")))
    rt = (retry_outcomes(attempts).groupBy("run_id", "entity").agg(
        F.count(F.lit(1)).alias("total_retried"),
        F.count_if(F.col("recovered")).alias("successful_retries"),
        F.count_if(~F.col("recovered")).alias("permanent_failures")))
    j = fp.join(rt, ["run_id", "entity"], "left")
    z = F.lit(0).cast("bigint")
    return j.select(
        "run_id", "entity", "batches_processed", "first_pass_ok", "first_pass_failed",
        F.coalesce("total_retried", z).alias("total_retried"),
        F.coalesce("successful_retries", z).alias("successful_retries"),
        F.coalesce("permanent_failures", z).alias("permanent_failures"),
        (F.col("first_pass_ok") + F.coalesce("successful_retries", z)).alias("successful_extractions"),
        F.coalesce("permanent_failures", z).alias("failed_extractions"))


def permanent_failures(attempts: DataFrame) -> DataFrame:
    """Ids still missing after the retries (rows, for a re-run)."""
    return retry_outcomes(attempts).where(~F.col("recovered")).select("run_id", "entity", "object_id")
