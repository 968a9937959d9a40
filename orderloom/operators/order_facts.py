"""Line items priced with their options, and the order-grain table the Gold plans share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.numbers import LINE_MONEY, total
from orderloom.schemas import SILVER, conform

ORDER_KEYS = ("order_id", "user_id", "restaurant_id", "order_date", "is_loyalty")


def option_totals(options: DataFrame) -> DataFrame:
    """One row per line item: price of all options and of the discounts among them."""
    discount_price = F.when(F.col("is_discount"), F.col("option_price")).otherwise(0)
    return options.groupBy("order_id", "lineitem_id").agg(
        F.sum("option_price").try_cast(LINE_MONEY).alias("total_option_price"),
        F.sum(discount_price).try_cast(LINE_MONEY).alias("total_discount_amount"),
        F.count_if("is_discount").alias("discount_count"),
        F.bool_or("is_discount").alias("has_discount"),
    )


def priced_items(items: DataFrame, options: DataFrame, by_line: bool = False) -> DataFrame:
    """Every line item with its option totals and net revenue, in the columns Gold reads.

    Options are totalled before the join, so it never multiplies line items, and
    a plan that reads no option column drops the join altogether. Net revenue is
    NULL where revenue is NULL, whatever the options cost.

    ``by_line`` is for frames that lie by line item, as they do once duplicates are removed: totals and join stay
    there, and orders are compared row by row. Such a join is not dropped.
    """
    totals = option_totals(options)
    if by_line:
        totals = totals.withColumnsRenamed({"order_id": "_order", "lineitem_id": "_line"})
        same_order = F.col("order_id").between(F.col("_order"), F.col("_order"))  # equal, but no key to shuffle by
        joined = items.join(totals, (F.col("lineitem_id") == F.col("_line")) & same_order, "left")
    else:
        joined = items.join(totals, ["order_id", "lineitem_id"], "left")
    joined = joined.fillna(
        {"total_option_price": 0, "total_discount_amount": 0, "discount_count": 0, "has_discount": False}
    )
    depth = F.try_divide(F.abs("total_discount_amount") * 100, F.col("revenue")).try_cast("decimal(6,2)")
    priced = joined.withColumns(
        {
            "net_revenue": (F.col("revenue") + F.col("total_option_price")).try_cast(LINE_MONEY),
            "discount_depth_pct": F.when(F.col("revenue") > 0, depth).otherwise(0).cast(LINE_MONEY),
        }
    )
    return conform(priced, SILVER["priced_items"])


def priced_columns(items: DataFrame) -> DataFrame:
    """The columns of line items that prices are made of or stored with."""
    return items.select(*("order_id", "lineitem_id", "user_id", "restaurant_id", "item_name", "item_category"), *("item_quantity", "is_loyalty", "order_date", "revenue"))


def order_facts(priced: DataFrame, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Sums and counts per order, customer, restaurant, day and loyalty flag, and whether any line of the order had a discount.

    The keys hold everything the Gold plans count distinctly at order level, and
    every measure can be added up further, so the plans read this smaller table
    instead of the lines. A hot customer or restaurant is spread by ``order_id``.
    The flag reads the sums a second time: ``keep`` stores them, so lines are priced and summed up once. It may leave
    out columns that a plan does not read.
    """
    facts = priced.groupBy(*ORDER_KEYS).agg(
        F.count("lineitem_id").alias("line_items"),
        total(F.col("revenue")).alias("gross"),
        F.count("revenue").alias("gross_lines"),
        total(F.col("net_revenue")).alias("net"),
        F.count("net_revenue").alias("net_lines"),
        total(F.col("total_discount_amount")).alias("discount"),
        total(F.abs("total_discount_amount")).alias("discount_given"),
        F.bool_or("has_discount").alias("has_discount"),
    )
    if keep:
        facts = keep(facts)
    marked = with_order_discount(facts, facts)
    return conform(marked, tuple(column for column in SILVER["order_facts"] if column[0] in marked.columns))


def customers_only(df: DataFrame) -> DataFrame:
    """Rows eligible for customer metrics: exactly those with a customer."""
    return df.filter(F.col("user_id").isNotNull())


def with_order_discount(df: DataFrame, facts: DataFrame) -> DataFrame:
    """Add ``order_has_discount``: whether any line of the order had a discount.

    Only the ids of discounted orders are joined back; an order id that very
    many rows share is split by adaptive execution on the left side.
    """
    discounted = facts.filter("has_discount").select("order_id").distinct()
    marked = df.join(discounted.withColumn("_discounted", F.lit(True)), "order_id", "left")
    return marked.withColumn(
        "order_has_discount", F.coalesce(F.col("_discounted"), F.lit(False))
    ).drop("_discounted")
