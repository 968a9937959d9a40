"""Raw order tables derived from the TPC-H-like test data.

The test tables have no faults, so nulls, negative prices, zero quantities, orders
before the calendar begins and the like are planted by fixed rules on the keys; no
rule leaves a row out. ``tie`` orders records that
share an ingestion time and belongs to no table. Works on whole tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.context import drop_shuffles, release, stored
from orderloom.operators.changes import differing_by, replaced
from orderloom.operators.order_facts import order_facts, priced_columns, priced_items
from orderloom.plans import silver

ITEM_TIES = ("tie", "item_price", "item_quantity")
OPTION_TIES = ("tie", "option_price")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _unless(fault: str, value: str) -> Column:
    return F.expr(f"CASE WHEN {fault} THEN NULL ELSE {value} END")


def _order() -> Column:
    return _unless("l_partkey % 500 = 13", "l_orderkey")


def _items_of(lines: DataFrame) -> DataFrame:
    """Raw line items of lines with their ``lineitem_id``, order and part."""
    price = "CAST(l_extendedprice AS DECIMAL(10,2))"
    return lines.select(
        _order().alias("order_id"),
        "lineitem_id",
        _unless("o_custkey % 12 = 5", "o_custkey").alias("user_id"),
        F.expr("CASE WHEN l_partkey % 4 = 0 THEN concat('CARD-', o_custkey) END").alias("printed_card_number"),
        F.expr("l_orderkey % 61").alias("restaurant_id"),
        F.expr("concat('app', l_orderkey % 3)").alias("app_name"),
        F.col("p_name").alias("item_name"),
        _unless("l_partkey % 50 = 0", "p_type").alias("item_category"),
        _unless("l_partkey % 89 = 0", f"IF(l_partkey % 97 = 0, -{price}, {price})").alias("item_price"),
        F.expr("IF(l_partkey % 101 = 0, 0, CAST(l_quantity AS INT))").alias("item_quantity"),
        F.lit("USD").alias("currency"),
        _unless("l_orderkey % 41 = 0", "l_orderkey % 10 < 3").alias("is_loyalty"),
        _unless(
            "l_orderkey % 211 = 0", "IF(l_orderkey % 67 = 3, o_orderdate - INTERVAL '10' YEAR, o_orderdate)"
        ).alias("creation_time_utc"),
        F.col("l_shipdate").alias("ingestion_ts"),
        F.col("l_partkey").alias("tie"),
    )


def _promotion() -> list[Column]:
    price, rate = "CAST(l_extendedprice AS DECIMAL(10,2))", "CAST(l_discount AS DECIMAL(3,2))"
    return [
        _unless("l_partkey % 53 = 0", "'PROMO'").alias("option_group_name"),
        _unless("l_partkey % 59 = 0", "'discount'").alias("option_name"),
        _unless("l_partkey % 61 = 0", f"IF(promoted, CAST(-({price} * {rate}) AS DECIMAL(10,2)), CAST(0 AS DECIMAL(10,2)))").alias("option_price"),
    ]


def _side() -> list[Column]:
    return [
        F.lit("SIDE").alias("option_group_name"),
        F.lit("extra").alias("option_name"),
        F.expr("CAST(CAST(l_tax AS DECIMAL(3,2)) * 100 AS DECIMAL(10,2))").alias("option_price"),
    ]


def _options_of(lines: DataFrame, *option: Column) -> DataFrame:
    """Raw options of lines with their ``lineitem_id``, and with their order for a promotion."""
    return lines.select(
        _order().alias("order_id"),
        "lineitem_id",
        *option,
        F.lit(1).alias("option_quantity"),
        F.col("l_shipdate").alias("ingestion_ts"),
        F.col("l_partkey").alias("tie"),
    )


def _with_line_item(lines: DataFrame) -> DataFrame:
    return lines.withColumn("lineitem_id", _unless("l_partkey % 500 = 7", "l_orderkey * 10 + l_linenumber"))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", F.expr("o_orderpriority IN ('1-URGENT', '2-HIGH')").alias("promoted")
    )


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem")
    parts = _table(spark, sf_dir, "part")
    joined = lines.join(_orders(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey")
    )
    return _items_of(_with_line_item(joined))


def raw_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A promotion and a side on every line. It is a discount on discounted lines of urgent and high-priority
    orders, and its price is 0 on all others, as is that of an untaxed side."""
    lines = _table(spark, sf_dir, "lineitem")
    ordered = lines.join(_orders(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))
    discounts = _options_of(_with_line_item(ordered), *_promotion())
    return discounts.unionByName(_options_of(_with_line_item(lines), *_side()))


def raw_by_line(spark: SparkSession, sf_dir: str, *named: str) -> tuple[DataFrame, DataFrame]:
    """Raw line items, with those of their part's columns that are named, and raw options, from lines dealt out by line
    item once for both.

    Lines without an order or part stay, as their options do. Records without a key, and copies of a line item or side
    that repeated parts or orders make or do not make here, are what Silver drops. A line travels as one value, so both
    readers need the same columns and Spark shuffles them once.
    """
    parts = _table(spark, sf_dir, "part").select("p_partkey", *named).distinct()
    if named:
        parts = parts.groupBy("p_partkey").agg(F.min(F.struct(*named)).alias("part")).select("p_partkey", "part.*")
    joined = (
        _with_line_item(_table(spark, sf_dir, "lineitem"))
        .filter(F.col("lineitem_id").isNotNull() & _order().isNotNull())
        .join(_orders(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
    )
    line = F.struct(
        *("l_orderkey", "l_partkey", "l_quantity", "l_tax", "l_shipdate", "o_custkey", "o_orderdate", "promoted"),
        # NULL without an order
        F.expr("CASE WHEN o_orderkey IS NOT NULL THEN p_partkey IS NOT NULL END").alias("has_part"),
        *named,
        # what the prices are cast to, in fewer bytes
        F.expr("CASE WHEN o_orderkey IS NOT NULL THEN CAST(l_extendedprice AS DECIMAL(10,2)) END").alias("l_extendedprice"),
        F.expr("CASE WHEN o_orderkey IS NOT NULL THEN CAST(l_discount AS DECIMAL(3,2)) END").alias("l_discount"),
    )
    dealt = joined.select("lineitem_id", F.array(line).alias("line")).repartition("lineitem_id").select("lineitem_id", F.inline("line"))
    nameless = {name: F.lit(None).cast("string") for name in ("p_name", "p_type") if name not in named}
    promotion, side = F.struct(*_promotion()), F.struct(*_side())
    bought = F.when(F.col("has_part").isNotNull(), F.array(promotion, side)).otherwise(F.array(side))
    return _items_of(dealt.filter("has_part").withColumns(nameless)), _options_of(dealt, F.inline(bought))


def raw_date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar of all order days; lines that are dated before it find no calendar row."""
    days = _table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date_key")).distinct()
    day_name = F.date_format("date_key", "EEEE")
    month_day = F.month("date_key") * 100 + F.dayofmonth("date_key")
    return days.select(
        "date_key",
        day_name.alias("day_of_week"),
        F.weekofyear("date_key").alias("week"),
        F.month("date_key").alias("month"),
        F.year("date_key").alias("year"),
        day_name.isin("Saturday", "Sunday").alias("is_weekend"),
        month_day.isin(101, 704, 1225).alias("is_holiday"),
        F.when(month_day == 101, "New Year")
        .when(month_day == 704, "Independence Day")
        .when(month_day == 1225, "Christmas")
        .alias("holiday_name"),
    )


def items(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None) -> DataFrame:
    return silver.order_items(raw_order_items(spark, sf_dir) if raw is None else raw, ITEM_TIES)


def correction(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None) -> DataFrame:
    """A later load: every line again, those of large quantities three days on and a unit dearer, all others as they were."""
    large = F.expr("COALESCE(item_quantity > 40, FALSE)")
    return (raw_order_items(spark, sf_dir) if raw is None else raw).withColumns(
        {
            "item_price": F.when(large, F.expr("CAST(item_price + 1 AS DECIMAL(10,2))")).otherwise(F.col("item_price")),
            "creation_time_utc": F.when(large, F.expr("creation_time_utc + INTERVAL '3' DAY")).otherwise(F.col("creation_time_utc")),
        }
    )


def _stored_together(*frames: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Frames that are made from one shuffle, stored in one pass: the table they share, and each with its own rows and
    columns."""
    numbered = [df.withColumn("_frame", F.lit(k)) for k, df in enumerate(frames)]
    table = stored(reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), numbered))
    return table, [table.filter(F.col("_frame") == k).select(df.columns) for k, df in enumerate(frames)]


def facts_after_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order facts kept up after the correction: only the orders it changed are priced and summed up again.

    Both loads and the options are made where the lines lie by line item. What a step shuffled goes before the next one
    begins, and what it stored once nothing reads it.
    """
    lines, bought = raw_by_line(spark, sf_dir, "p_name", "p_type")
    loads = (priced_columns(items(spark, sf_dir, raw)) for raw in (lines, correction(spark, sf_dir, lines)))
    bought = options(spark, sf_dir, bought).select("order_id", "lineitem_id", "option_price", "is_discount")
    made, (before, arriving, bought) = _stored_together(*loads, bought)
    drop_shuffles(spark)
    after = stored(silver.corrected(before, arriving))
    drop_shuffles(spark)
    touched = stored(differing_by(before, after, ["order_id", "lineitem_id"], "order_id"))
    drop_shuffles(spark)
    of_touched = priced_items(*(df.join(touched, "order_id", "left_semi") for df in (after, bought)))
    changed = order_facts(of_touched, stored)
    release(after)
    facts = order_facts(priced_items(before, bought), stored)
    release(made)
    return replaced(facts, changed, touched, "order_id")


def options(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None) -> DataFrame:
    return silver.order_item_options(raw_options(spark, sf_dir) if raw is None else raw, OPTION_TIES)


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.date_dim(raw_date_dim(spark, sf_dir))


def priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return priced_items(items(spark, sf_dir), options(spark, sf_dir))


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_facts(priced(spark, sf_dir))


def priced_by_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``priced``, for plans that read net revenue or discounts: options are dealt out by line item once, for
    their duplicates, their totals and the join with the line items."""
    bought = options(spark, sf_dir, raw_options(spark, sf_dir).repartition("lineitem_id"))
    return priced_items(items(spark, sf_dir), bought, by_line=True)


def sums_by_line(spark: SparkSession, sf_dir: str, *named: str) -> DataFrame:
    """Priced lines for sums: of names and categories they hold only the part's columns that are named."""
    lines, bought = raw_by_line(spark, sf_dir, *named)
    return priced_items(items(spark, sf_dir, lines), options(spark, sf_dir, bought), by_line=True)


def net_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_facts(sums_by_line(spark, sf_dir))


def gross_facts(spark: SparkSession, sf_dir: str, columns: Sequence[str]) -> DataFrame:
    """For plans that read such columns several times: stored once, as the daily run does. Options are not needed."""
    return stored(facts(spark, sf_dir).select(*columns))


def lines_and_facts(spark: SparkSession, sf_dir: str, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Such columns of the facts, and the priced lines they are summed up from: both are stored once, as the daily
    run does."""
    lines = stored(priced_by_line(spark, sf_dir).drop("item_name", "item_quantity", "discount_depth_pct"))
    return stored(order_facts(lines).select(*columns)), lines


def stored_facts(spark: SparkSession, sf_dir: str, columns: Sequence[str] = ()) -> DataFrame:
    """For plans that read the facts several times, or whether an order has a discount: summed up and stored once,
    all of them or such columns only."""
    return order_facts(sums_by_line(spark, sf_dir), lambda sums: stored(sums.select(*columns or sums.columns)))
