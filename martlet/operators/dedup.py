"""Keep one row per key: ``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY ...) = 1``.

Spark plans ``row_number`` + ``rn = 1`` as a partial ``WindowGroupLimit``
before the shuffle and a final one after it, so a hot key is cut to one row per
map task before anything moves: a key holding a third of all rows costs no
more shuffle than any other key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                   rank_col: str = "rn", keep_rank: bool = False) -> DataFrame:
    """Rows ranked first within each key by ``order``; ``order`` should be total
    on the output columns so the kept row does not depend on scheduling."""
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) == 1)
    return ranked if keep_rank else ranked.drop(rank_col)
