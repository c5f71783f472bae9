"""Defensive casts of the staging layer (the reference's SAFE_CAST).

All of them return NULL instead of raising, under ANSI mode as well.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The warehouse NUMERIC type, and the accepted date text shape.
NUMERIC = "decimal(38,9)"
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"


def safe_id(col: Column | str) -> Column:
    """An id: whole number or its text to BIGINT; anything else gives NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast("bigint")


def safe_numeric(col: Column | str) -> Column:
    """SAFE_CAST(x AS NUMERIC): text or number to DECIMAL(38,9); bad text gives NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast(NUMERIC)


def safe_int64(col: Column | str) -> Column:
    """SAFE_CAST(x AS INT64) for numeric JSON values: 1.5 -> 2, -1.5 -> -2.

    The value is read as an exact decimal and rounded half away from zero
    (``round`` on a decimal is HALF_UP), then narrowed; text that is not a
    number and values outside BIGINT give NULL.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c.try_cast(NUMERIC), 0).try_cast("bigint")


def safe_date(col: Column | str) -> Column:
    """SAFE_CAST(x AS DATE) for ``yyyy-MM-dd`` text; anything else (``0000-00-00``,
    ``2024``, ``2024-02-30``) gives NULL."""
    c = F.col(col) if isinstance(col, str) else col
    txt = c.cast("string")
    return F.when(txt.rlike(DATE_PATTERN), txt.try_cast("date"))
