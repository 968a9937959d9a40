"""Rankings and medians over a whole table without gathering it in one task.

A window with no partition key sends every row to a single task. Here all of
them come from one operator, ``running_total``: range-partition and sort the
rows, total each range, and shift every range by the total of those before it.
Only the per-range totals, at most one row per shuffle partition and group,
are brought together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.context import cut_lineage

_VALUE = "decimal(38,2)"


def exact_in_cents(df: DataFrame, column: str) -> None:
    """Refuses types whose values ``_VALUE`` would round, and so tie."""
    kind = df.schema[column].dataType
    whole = isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    if not whole and not (isinstance(kind, T.DecimalType) and kind.scale <= 2 and kind.precision - kind.scale <= 36):
        raise ValueError(f"{column}: {kind.simpleString()} is not exact to two digits")


@dataclass(frozen=True)
class By:
    """Numeric column to order by; NULLs come first ascending and last descending."""

    column: str
    descending: bool = False

    def nulls(self) -> Column:
        return F.when(F.col(self.column).isNull(), F.lit(1 if self.descending else -1)).otherwise(0)

    def checked(self, df: DataFrame) -> By:
        exact_in_cents(df, self.column)
        return self

    def value(self) -> Column:
        value = F.col(self.column).cast(_VALUE)
        return -value if self.descending else value


def running_total(
    df: DataFrame, order: Sequence[str], weight: str, into: str, within: Sequence[str] = ()
) -> DataFrame:
    """Add ``into``: the sum of ``weight`` over all rows strictly before this one.

    ``within`` restarts the sum per group and is meant for few groups. ``order``
    must be unique within a group. The range-partitioned rows are checkpointed
    because range bounds come from a sample and must not differ between the pass
    that totals the ranges and the pass that reads the rows.
    """
    ranged = df.repartitionByRange(*within, *order).withColumn("_range", F.spark_partition_id())
    stored = cut_lineage(ranged)

    group = ["_range", *within]
    earlier_ranges = Window.partitionBy(*within).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        stored.groupBy(*group)
        .agg(F.sum(weight).alias("_total"))
        .select(
            *(F.col(name).alias(f"_at_{name}") for name in group),
            F.coalesce(F.sum("_total").over(earlier_ranges), F.lit(0)).alias("_offset"),
        )
    )
    earlier_rows = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    same_group = reduce(
        lambda left, right: left & right,
        (F.col(name).eqNullSafe(F.col(f"_at_{name}")) for name in group),
    )
    # One row per range and group: bounded by the number of shuffle partitions.
    return (
        stored.withColumn("_before", F.coalesce(F.sum(weight).over(earlier_rows), F.lit(0)))
        .join(F.broadcast(offsets), same_group)
        .withColumn(into, F.col("_before") + F.col("_offset"))
        .drop("_before", "_offset", "_range", *(f"_at_{name}" for name in group))
    )


def row_positions(df: DataFrame, order: Sequence[str], into: str, within: Sequence[str]) -> DataFrame:
    """Add ``into``: how many rows of the group sort strictly before this one.

    As ``running_total`` with the weight 1, but rows are numbered where they lie in the sorted ranges, so
    nothing is shuffled after the range partitioning.
    """
    ranged = df.repartitionByRange(*within, *order).sortWithinPartitions(*within, *order)
    stored = cut_lineage(ranged.withColumn("_range", F.spark_partition_id()))
    # The low bits count the rows of a partition in stored order; groups are adjacent in it.
    numbered = stored.withColumn("_row", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    earlier = Window.partitionBy(*within).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy("_range", *within)
        .agg(F.count(F.lit(1)).alias("_rows"), F.min("_row").alias("_first"))
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first"))
        .drop("_rows", "_first")
    )
    # One row per range and group: bounded by the number of shuffle partitions.
    placed = numbered.join(F.broadcast(offsets), ["_range", *within])
    return placed.withColumn(into, F.col("_row") + F.col("_offset")).drop("_range", "_row", "_offset")


def _value_counts(df: DataFrame, orders: Mapping[str, By]) -> DataFrame:
    """Rows (name, nulls, value, n) for several orderings, reading ``df`` once."""
    for by in orders.values():
        by.checked(df)
    stacked = df.select(
        F.explode(
            F.array(
                *(
                    F.struct(F.lit(name).alias("name"), by.nulls().alias("nulls"), by.value().alias("value"))
                    for name, by in orders.items()
                )
            )
        ).alias("item")
    ).select("item.*")
    return stacked.groupBy("name", "nulls", "value").agg(F.count(F.lit(1)).alias("n"))


def _rows_before(df: DataFrame, orders: Mapping[str, By]) -> DataFrame:
    """Add, per ordering, how many rows sort strictly before each row's value.

    Ranks follow from counts per distinct value, so tied rows never meet in one
    task; a value that very many rows share is one row here, and the join back
    leaves splitting its rows to adaptive execution.
    """
    counts = running_total(
        _value_counts(df, orders), order=["nulls", "value"], weight="n", into="before", within=["name"]
    )
    ranked = df
    for name, by in orders.items():
        lookup = counts.filter(F.col("name") == name).select(
            F.col("nulls").alias("_nulls"), F.col("value").alias("_value"), F.col("before").alias(name)
        )
        same = (by.nulls() == F.col("_nulls")) & by.value().eqNullSafe(F.col("_value"))
        ranked = ranked.join(lookup, same, "left").drop("_nulls", "_value")
    return ranked


def global_rank(df: DataFrame, orders: Mapping[str, By]) -> DataFrame:
    """``rank() over (order by ...)`` per entry; ``df`` should be stored or cheap."""
    ranked = _rows_before(df, orders)
    return ranked.withColumns({name: (F.col(name) + 1).cast("int") for name in orders})


def global_percent_rank(df: DataFrame, orders: Mapping[str, By]) -> DataFrame:
    """``percent_rank() over (order by ...)`` per entry; 0 for a single row."""
    others = df.agg((F.count(F.lit(1)) - 1).alias("others")).scalar()
    ranked = _rows_before(df, orders)
    return ranked.withColumns(
        {
            name: F.coalesce(F.try_divide(F.col(name).cast("double"), others.cast("double")), F.lit(0.0))
            for name in orders
        }
    )


def global_ntile(df: DataFrame, n: int, orders: Mapping[str, By], tie_break: str) -> DataFrame:
    """``ntile(n) over (order by ..., tie_break)`` per entry.

    A bucket is decided by the last rows of the n-1 buckets before it, so only
    those few edge rows are looked up and every row is compared with them. All
    orderings share one range sort of narrow rows. ``tie_break`` must be unique.
    """
    for by in orders.values():
        by.checked(df)
    stacked = df.select(
        F.col(tie_break).alias("tie"),
        F.explode(
            F.array(
                *(
                    F.struct(F.lit(name).alias("name"), by.nulls().alias("nulls"), by.value().alias("value"))
                    for name, by in orders.items()
                )
            )
        ).alias("item"),
    ).select("item.*", "tie")
    numbered = row_positions(stacked, order=["nulls", "value", "tie"], into="before", within=["name"])
    size = df.agg(F.count(F.lit(1)).alias("size")).scalar()
    position = F.col("before") + 1
    is_edge = reduce(
        lambda left, right: left | right,
        (
            position == F.expr(f"size DIV {n} * {bucket} + least(size % {n}, {bucket})")
            for bucket in range(1, n)
        ),
    )
    edges = (
        numbered.withColumn("size", size)
        .filter(is_edge)
        .agg(F.collect_list(F.struct("name", F.struct("nulls", "value", "tie").alias("key"))).alias("edges"))
        .scalar()
    )

    def bucket_of(name: str, by: By) -> Column:
        key = F.struct(by.nulls().alias("nulls"), by.value().alias("value"), F.col(tie_break).alias("tie"))
        passed = F.filter(F.col("_edges"), lambda edge: (edge["name"] == name) & (edge["key"] < key))
        return F.size(passed) + 1

    return (
        df.withColumn("_edges", edges)
        .withColumns({name: bucket_of(name, by) for name, by in orders.items()})
        .drop("_edges")
    )


def group_medians(df: DataFrame, group: str, medians: Mapping[str, str]) -> DataFrame:
    """Lower median of each column per value of the boolean ``group`` (NULL is one value).

    ``medians`` maps a result name to a column. The exact value is found from
    running counts, so accuracy does not depend on how many rows a group has.
    NULLs are left out.
    """
    if dict(df.dtypes)[group] != "boolean":
        raise ValueError("medians are grouped by a boolean column")
    for column in medians.values():
        exact_in_cents(df, column)
    stacked = df.select(
        F.col(group).alias("group"),
        F.explode(
            F.array(
                *(
                    F.struct(F.lit(name).alias("name"), F.col(column).cast(_VALUE).alias("value"))
                    for name, column in medians.items()
                )
            )
        ).alias("item"),
    ).select("group", "item.*")
    counts = (
        stacked.filter(F.col("value").isNotNull())
        .groupBy("group", "name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = running_total(counts, order=["value"], weight="n", into="before", within=["group", "name"])
    upto = F.col("before") + F.col("n")
    sizes = totals.groupBy("group", "name").agg(F.max(upto).alias("size"))
    halves = (
        totals.alias("t")
        .join(
            F.broadcast(sizes).alias("s"),
            F.col("t.group").eqNullSafe(F.col("s.group")) & (F.col("t.name") == F.col("s.name")),
        )
        .filter(upto * 2 >= F.col("size"))
        .groupBy("t.group")
        .agg(
            *(
                F.min(F.when(F.col("t.name") == name, F.col("value"))).alias(name)
                for name in medians
            )
        )
    )
    return halves.withColumnRenamed("group", group)
