"""Keep one row per key by an explicit order.

``row_number() == 1`` (not ``dropDuplicates``, whose survivor is arbitrary).
Catalyst turns the ``rn = 1`` filter into a partial ``WindowGroupLimit`` that
runs before the shuffle, so a hot key sends at most one row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys, order) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def last_per_key(df: DataFrame, keys, order) -> DataFrame:
    desc = [(F.col(o) if isinstance(o, str) else o).desc() for o in order]
    return first_per_key(df, keys, desc)
