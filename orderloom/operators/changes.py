"""Change propagation: which keys' rows differ between two states, and replacing only theirs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def differing(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Keys with a row that only one of the two frames has, or one of them more often; rows are compared whole.

    Equal rows cancel out in a sum, in part before the shuffle, so what is shuffled is at most a row for each
    distinct row and task.
    """
    both = before.withColumn("_side", F.lit(1)).unionByName(after.withColumn("_side", F.lit(-1)))
    left = both.groupBy(*before.columns).agg(F.sum("_side").alias("_side")).filter("_side <> 0")
    return left.select(key).distinct()


def differing_by(before: DataFrame, after: DataFrame, unique: Sequence[str], key: str) -> DataFrame:
    """Keys with a row that only one of the two frames has, where ``unique`` columns, never null, name a row of each.

    A full join on these columns: frames that are dealt out by them already are compared where they lie.
    """
    others = [c for c in before.columns if c not in unique]
    sides = (
        df.select(*unique, F.struct(F.lit(1).alias("there"), *others).alias(name))
        for df, name in ((before, "_before"), (after, "_after"))
    )
    left, right = sides
    both = left.join(right, [*unique], "full").filter(~F.col("_before").eqNullSafe(F.col("_after")))
    return both.select(key).distinct()


def replaced(current: DataFrame, rows: DataFrame, touched: DataFrame, key: str) -> DataFrame:
    """``current`` with the rows of the touched keys replaced by ``rows``."""
    return current.join(touched, key, "left_anti").unionByName(rows.select(current.columns))


def newest_generation(rows: DataFrame, key: str, generation: str, base: int, deleted: str) -> DataFrame:
    """Live rows of a table kept as generations: a base, and after it only the rows of keys that changed.

    A key's rows are those of the last generation that names it; a key that lost all its rows is named by one row
    marked as deleted. The keys of later generations are few beside the base: they are counted once for each
    generation and joined, by broadcast where Spark finds them small, and else by a shuffle that splits hot keys.
    """
    last = rows.filter(F.col(generation) > base).groupBy(key).agg(F.max(generation).alias("_last"))
    live = F.col("_last").isNull() | (F.col("_last") == F.col(generation))
    return rows.join(last, key, "left").filter(live & ~F.coalesce(F.col(deleted), F.lit(False))).drop("_last")
