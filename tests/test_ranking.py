"""Distributed rankings equal plain windows on data with heavy ties and NULLs."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from orderloom.operators.ranking import (
    By,
    global_ntile,
    global_percent_rank,
    global_rank,
    group_medians,
    running_total,
)

SCHEMA = "id bigint, whole int, money decimal(14,2), flag boolean"


def sample(spark, rows, seed=7):
    rng = random.Random(seed)
    data = [
        (
            i,
            None if rng.random() < 0.02 else (0 if rng.random() < 0.35 else rng.randint(-20, 20)),
            None if rng.random() < 0.02 else Decimal(rng.choice([1, rng.randint(-9000, 9000)])) / 100,
            rng.choice([True, False, None]),
        )
        for i in range(rows)
    ]
    rng.shuffle(data)
    return spark.createDataFrame(data, SCHEMA).repartition(5)


def window(by: By, tie: str | None = None):
    column = F.col(by.column)
    order = [column.desc_nulls_last() if by.descending else column.asc_nulls_first()]
    return Window.orderBy(*order, *([tie] if tie else []))


ORDERS = {"a": By("whole"), "b": By("whole", descending=True), "c": By("money"), "d": By("money", True)}


@pytest.mark.parametrize("rows", [1, 7, 2003])
def test_ranks(spark, rows):
    df = sample(spark, rows)
    plain = df.withColumns({name: F.rank().over(window(by)) for name, by in ORDERS.items()})
    ranked = global_rank(df, ORDERS)
    assert ranked.dtypes == plain.dtypes
    assert sorted(map(str, ranked.collect())) == sorted(map(str, plain.collect()))
    plain = df.withColumns({name: F.percent_rank().over(window(by)) for name, by in ORDERS.items()})
    assert sorted(map(str, global_percent_rank(df, ORDERS).collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("rows", [1, 3, 5, 11, 2003])
def test_ntile(spark, rows):
    df = sample(spark, rows, seed=rows)
    plain = df.withColumns({name: F.ntile(5).over(window(by, "id")) for name, by in ORDERS.items()})
    scored = global_ntile(df, 5, ORDERS, tie_break="id")
    assert sorted(map(str, scored.collect())) == sorted(map(str, plain.collect()))


def test_ntile_sizes_differ_by_at_most_one(spark):
    scored = global_ntile(sample(spark, 1234), 5, {"score": By("whole")}, tie_break="id")
    sizes = [row["count"] for row in scored.groupBy("score").count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_empty(spark):
    df = sample(spark, 0)
    assert global_rank(df, ORDERS).count() == 0
    assert global_percent_rank(df, ORDERS).count() == 0
    assert global_ntile(df, 5, ORDERS, tie_break="id").count() == 0
    assert group_medians(df, "flag", {"m": "money"}).count() == 0


def test_running_total_within_groups(spark):
    df = sample(spark, 1500).withColumn("w", F.lit(2))
    plain = df.withColumn(
        "before",
        F.coalesce(
            F.sum("w").over(
                Window.partitionBy("flag").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ),
    )
    total = running_total(df, ["id"], "w", "before", within=["flag"])
    assert sorted(map(str, total.select(plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_medians_are_the_exact_lower_ones(spark):
    df = sample(spark, 1502)
    medians = group_medians(df, "flag", {"m": "money", "w": "whole"})
    found = {row["flag"]: (row["m"], row["w"]) for row in medians.collect()}
    for flag in (True, False, None):
        rows = [r for r in df.collect() if r["flag"] == flag]
        for position, column in enumerate(("money", "whole")):
            values = sorted(r[column] for r in rows if r[column] is not None)
            assert found[flag][position] == values[(len(values) - 1) // 2]


def test_medians_need_a_boolean_group(spark):
    with pytest.raises(ValueError):
        group_medians(sample(spark, 3), "id", {"m": "money"})


def test_no_user_row_goes_through_a_single_partition(spark):
    df = sample(spark, 50)
    for result in (
        global_ntile(df, 5, ORDERS, tie_break="id"),
        global_percent_rank(df, {"p": By("money")}),
    ):
        plan = result._jdf.queryExecution().optimizedPlan().toString()
        windows = [line for line in plan.splitlines() if "Window" in line]
        assert windows and all("_range" in line for line in windows)


def test_positions_need_no_shuffle_after_the_ranges(spark):
    from orderloom.operators.ranking import row_positions

    rows = spark.range(1000).selectExpr("id % 3 AS name", "id AS value")
    placed = row_positions(rows, order=["value"], into="before", within=["name"])
    found = {(r["name"], r["value"]): r["before"] for r in placed.collect()}
    assert all(before == value // 3 for (_, value), before in found.items())
    plan = placed._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 2  # of the counts by range only: all in the small side
