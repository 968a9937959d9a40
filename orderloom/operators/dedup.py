"""Keep the latest record per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest: Sequence[str], ties: Sequence[str]
) -> DataFrame:
    """First row per key by ``newest`` descending, then ``ties`` ascending.

    NULL key parts form one key. ``row_number() = 1`` lets Spark put a group
    limit before the shuffle: each task sends one row per key, so a key with
    very many copies stays cheap. ``ties`` should leave no two different rows equal.
    """
    window = Window.partitionBy(*keys).orderBy(*(F.col(name).desc() for name in newest), *map(F.col, ties))
    return df.withColumn("_row", F.row_number().over(window)).filter("_row = 1").drop("_row")
