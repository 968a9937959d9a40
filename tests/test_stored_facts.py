"""What the order queries store, read once and shuffle by: one path over the lines for each query."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from orderloom.context import stored
from orderloom.operators.order_facts import order_facts, priced_items
from orderloom.plans import churn, discount, loyalty, reports, silver
from parity import fixtures
from tests.conftest import SF_DIR

LINE = """order_id bigint, lineitem_id bigint, user_id bigint, restaurant_id bigint, item_name string, item_category string,
    item_quantity int, is_loyalty boolean, order_date date, revenue decimal(12,2)"""


def lines(spark, *rows):
    made = [(o, i, 7, 3, "soup", None, 1, None, None, revenue and Decimal(revenue)) for o, i, revenue in rows]
    return spark.createDataFrame(made, LINE)


def options(spark, *rows):
    table = spark.createDataFrame(list(rows), "order_id bigint, lineitem_id bigint, price string")
    price = F.col("price").cast("decimal(10,2)")
    return table.select("order_id", "lineitem_id", price.alias("option_price"), F.coalesce(price < 0, F.lit(False)).alias("is_discount"))


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.fixture
def odd(spark):
    """Lines that share an id between orders, come twice, or have no option, price or key."""
    return (
        lines(spark, (1, 10, "5"), (2, 10, "6"), (1, 10, "5"), (1, 11, None), (3, 12, "0"), (None, 13, "1"), (4, None, "2")),
        options(spark, (1, 10, "-1"), (1, 10, "2"), (2, 10, None), (1, 11, "3"), (9, 12, "4"), (None, 13, "5"), (4, None, "-6")),
    )


def test_pricing_by_line_gives_the_same_rows(odd):
    plain, by_line = priced_items(*odd), priced_items(*odd, by_line=True)
    assert by_line.dtypes == plain.dtypes
    assert sorted(map(str, by_line.collect())) == sorted(map(str, plain.collect()))


def test_pricing_by_line_shuffles_neither_side_again(spark, odd):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert exchanges(priced_items(*(df.repartition("lineitem_id") for df in odd), by_line=True)) == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_kept_sums_give_the_same_facts_and_are_all_that_is_read(odd):
    priced = priced_items(*odd)
    plain, kept = order_facts(priced), order_facts(priced, stored)
    assert kept.dtypes == plain.dtypes and sorted(map(str, kept.collect())) == sorted(map(str, plain.collect()))
    assert "lineitem_id" not in kept._jdf.queryExecution().optimizedPlan().toString()


def columns_read(spark, df):
    return [set(spark.read.parquet(path).columns) for path in df.inputFiles() if "/stored-" in path]


def test_churn_stores_what_it_reads_of_the_facts(spark):
    found = columns_read(spark, registry.GOLD["gold_churn_indicators"](spark, SF_DIR))
    assert found and all(names == set(churn.READS) for names in found)


@pytest.mark.parametrize("name", ["gold_loyalty_summary", "report_loyalty_kpis", "report_overview_kpis"])
def test_line_items_are_made_once(spark, monkeypatch, name):
    made, items = [], fixtures.items
    monkeypatch.setattr(fixtures, "items", lambda *args: made.append(args) or items(*args))
    registry.queries()[name](spark, SF_DIR)
    assert len(made) == 1


def test_loyalty_reads_its_columns_of_the_facts(spark):
    facts, priced = fixtures.lines_and_facts(spark, SF_DIR, loyalty.READS)
    assert facts.columns == list(loyalty.READS)
    assert facts.agg(F.sum("net")).first() == priced.agg(F.sum("net_revenue")).first()


@pytest.mark.parametrize("name", ["gold_discount_customer", "order_facts_after_correction"])
def test_nothing_below_the_stored_sums_is_read_again(spark, name):
    files = registry.queries()[name](spark, SF_DIR).inputFiles()
    assert files and all("/stored-" in path for path in files)


@pytest.mark.parametrize("name", ["gold_discount_order_summary", "gold_discount_customer", "report_discount_kpis"])
def test_discounts_store_what_they_read_of_the_facts(spark, name):
    reads = discount.CUSTOMER_READS if name == "gold_discount_customer" else discount.ORDER_READS
    found = columns_read(spark, registry.queries()[name](spark, SF_DIR))
    assert found and all(names == set(reads) for names in found)


@pytest.fixture
def odd_tables(spark, tmp_path):
    """Lines without an order or part, with a repeated part, twice, without a key, and two orders' lines of one id."""
    day = "timestamp_ntz '2001-02-03'"
    made = {
        "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double",
        "orders": "o_orderkey bigint, o_custkey bigint, o_orderpriority string",
        "part": "p_partkey bigint, p_name string, p_type string",
    }
    rows = {
        "lineitem": [
            *((1, part, number, 2.0, 10.0, 0.1, 0.05) for number, part in enumerate([1, 2, 3, 9, 7, 13, 1], 1)),
            *((2, 1, 1, 1.0, 5.0, 0.0, 0.0), (2, 1, 1, 1.0, 5.0, 0.0, 0.0), (1, 1, 11, 3.0, 7.0, 0.2, 0.01)),
            *((5, 1, 1, 1.0, 6.0, 0.1, 0.02), (None, 1, 1, 1.0, 1.0, 0.1, 0.1), (3, None, 1, 1.0, 1.0, 0.1, 0.1)),
            *((3, 4, 2, None, None, None, None), (4, 1, None, 1.0, 2.0, 0.1, 0.1), (4, 1, 2, 1.0, 2.0, 0.1, 0.1)),
        ],
        "orders": [(1, 11, "1-URGENT"), (2, 12, "5-LOW"), (3, 13, "2-HIGH"), (4, None, None), (None, 14, "1-URGENT")],
        "part": [(1, "a", "b"), (2, "c", "d"), (2, "c", "d"), (3, None, None), (4, "e", "f"), (7, "g", "h"), (13, "i", "j"), (None, "k", "l")],
    }
    dated = {"lineitem": "l_shipdate", "orders": "o_orderdate"}
    for name, schema in made.items():
        table = spark.createDataFrame(rows[name], schema)
        if name in dated:
            table = table.withColumn(dated[name], F.expr(day))
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_lines_dealt_out_once_give_the_same_line_items_and_options(spark, odd_tables):
    items, bought = fixtures.raw_by_line(spark, odd_tables)
    nameless = silver.order_items(items, fixtures.ITEM_TIES).drop("item_name", "item_category")
    found = nameless, silver.order_item_options(bought, fixtures.OPTION_TIES)
    plain = fixtures.items(spark, odd_tables).drop("item_name", "item_category"), fixtures.options(spark, odd_tables)
    for made, wanted in zip(found, plain):
        assert made.dtypes == wanted.dtypes and wanted.count()
        assert sorted(map(str, made.collect())) == sorted(map(str, wanted.collect()))
    facts = fixtures.net_facts(spark, odd_tables), fixtures.facts(spark, odd_tables)
    assert facts[0].dtypes == facts[1].dtypes
    assert len({tuple(sorted(map(str, df.collect()))) for df in facts}) == 1


def test_lines_are_shuffled_once_for_line_items_and_options(spark):
    limits = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in limits}
    for name, value in limits.items():
        spark.conf.set(name, value)
    try:
        plan = fixtures.net_facts(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(l_orderkey") == 1 and "ReusedExchange" in plan
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_lines_dealt_out_once_hold_the_names_asked_for(spark, odd_tables):
    lines, _ = fixtures.raw_by_line(spark, odd_tables, "p_name", "p_type")
    found, plain = silver.order_items(lines, fixtures.ITEM_TIES), fixtures.items(spark, odd_tables)
    assert found.dtypes == plain.dtypes and plain.filter("item_category IS NOT NULL").count()
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))
    tables = [loyalty.loyalty_by_category(df) for df in (fixtures.sums_by_line(spark, odd_tables, "p_type"), fixtures.priced(spark, odd_tables))]
    assert len({tuple(sorted(map(str, df.collect()))) for df in tables}) == 1


@pytest.mark.parametrize("name", ["gold_loyalty_by_category", "report_leading_loyalty_categories"])
def test_loyalty_categories_shuffle_lines_once_by_each_key(spark, name):
    limits = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {key: spark.conf.get(key) for key in limits}
    for key, value in limits.items():
        spark.conf.set(key, value)
    try:
        plan = registry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString().splitlines()
        made = [line for line in plan if "Exchange hashpartitioning(" in line and "ReusedExchange" not in line]
        assert [sum(f"({key}" in line for line in made) for key in ("l_orderkey", "l_partkey", "lineitem_id")] == [1, 1, 1]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_leading_loyalty_categories_are_whole_and_read_once(spark):
    rows = [("a", "x", 5), ("a", "y", 1), ("b", "x", 6), ("c", None, None), ("c", "x", 2), (None, "x", 99), ("d", "y", 3)]
    table = spark.createDataFrame(rows, "item_category string, loyalty_label string, revenue int").select(
        "*", *(F.col("revenue").cast(kind).alias(c) for c, kind in (("total_revenue", "decimal(22,2)"), ("total_orders", "bigint"), ("unique_customers", "bigint")))
    )
    found = reports.leading_loyalty_categories(table, k=3)
    assert found.columns == ["item_category", "loyalty_label", "total_revenue", "total_orders", "unique_customers"]
    assert {(r[0], r[1], r[3]) for r in found.collect()} == {row for row in rows if row[0] in ("b", "a", "d")}
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_frames_stored_together_come_back_as_they_were(spark):
    one = spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], "k bigint, name string")
    two = spark.createDataFrame([("7.50", 1)], "price string, k bigint").withColumn("price", F.col("price").cast("decimal(10,2)"))
    table, found = fixtures._stored_together(one, two, one.limit(0))
    assert [df.dtypes for df in found] == [one.dtypes, two.dtypes, one.dtypes]
    assert [sorted(map(str, df.collect())) for df in found] == [sorted(map(str, df.collect())) for df in (one, two, one.limit(0))]
    assert {path.rsplit("/", 1)[0] for df in found for path in df.inputFiles()} == {table.inputFiles()[0].rsplit("/", 1)[0]}


def test_correction_joins_lines_once_and_keeps_nothing_it_has_read(spark, odd_tables, monkeypatch):
    kept, plans = [], []

    def seen(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        kept.append(stored(df))
        return kept[-1]

    monkeypatch.setattr(fixtures, "stored", seen)
    found = registry.queries()["order_facts_after_correction"](spark, SF_DIR)
    assert sum("l_shipdate" in plan for plan in plans) == 1
    left = {path.rsplit("/", 1)[0] for path in found.inputFiles()}
    folder = spark._jvm.java.io.File
    there = [folder(df.stored_at.removeprefix("file:")).exists() for df in kept]
    assert there.count(False) == 2 and all(folder(path.removeprefix("file://")).exists() for path in left)
    again = registry.queries()["order_facts_after_correction"](spark, odd_tables)
    after = silver.corrected(
        fixtures.items(spark, odd_tables), silver.order_items(fixtures.correction(spark, odd_tables), fixtures.ITEM_TIES)
    )
    plain = order_facts(priced_items(after, fixtures.options(spark, odd_tables)))
    assert again.dtypes == plain.dtypes and sorted(map(str, again.collect())) == sorted(map(str, plain.collect()))
