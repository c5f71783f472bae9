"""Lookup sides of joins: broadcast only where their rows were counted and are few.

``spread_join`` is for lists of a few keys (statuses, channels) whose size Spark does not know:
an exchange on such a key alone would bring most rows into as many tasks as there are keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a product list that every executor may hold (some 100 MB of the columns in use).
MOST_ROWS = 500_000
#: Copies of a list per shuffle partition: enough for hashes to fill the partitions evenly.
COPIES = 8


def lookup(df: DataFrame, rows: int | None, most: int = MOST_ROWS) -> DataFrame:
    """``df`` as the broadcast side of joins if ``rows``, a counted bound on its rows, allows it.

    Beyond ``most``, or without a count, the plan is left to Spark: an exchange on the join key,
    which adaptive execution splits where a key is skewed.
    """
    return F.broadcast(df) if rows is not None and rows <= most else df


def spread_join(rows: DataFrame, few: DataFrame, key: str, by: Sequence[str], how: str = "left") -> DataFrame:
    """``rows`` joined with the list ``few`` on ``key``, the same rows as by a plain join.

    The list is repeated ``COPIES`` times per shuffle partition and each row meets one copy, dealt by
    a hash of its columns ``by``, so the rows of one key spread over all partitions.
    """
    n = COPIES * max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    copies = few.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    dealt = rows.withColumn("_copy", F.pmod(F.xxhash64(*by), F.lit(n)).cast("int"))
    return dealt.join(copies, [key, "_copy"], how).drop("_copy")
