"""Discount effectiveness by order, category and customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.numbers import WIDE_AVERAGE, count_mean, distinct_where, mean, percent, total
from orderloom.functions.rules import (
    DISCOUNT_SEEKER_OTHERWISE,
    DISCOUNT_SEEKERS,
    discount_label,
    first_match,
)
from orderloom.operators.order_facts import customers_only
from orderloom.schemas import GOLD_BUSINESS, conform

# Columns of the order facts that these plans read, besides whether the order has a discount, and what that is made of.
ORDER_READS = ("order_id", "restaurant_id", "order_date", "user_id", "gross", "net", "discount", "line_items", "has_discount")
CUSTOMER_READS = ("order_id", "user_id", "gross", "net", "discount_given", "is_loyalty", "has_discount")


def discount_order_summary(facts: DataFrame) -> DataFrame:
    """Discounted orders against the rest.

    ``discount_order_rate_pct`` is taken within its own group, so it is 100 or 0.
    """
    orders = facts.groupBy("order_id", "restaurant_id", "order_date").agg(
        total(F.col("gross")).alias("order_gross"),
        total(F.col("net")).alias("order_net"),
        total(F.col("discount")).alias("order_discount"),
        F.sum("line_items").alias("items_in_order"),
        F.min("user_id").alias("user_id"),
        F.bool_or("order_has_discount").alias("order_has_discount"),  # one value in an order
    )
    summary = (
        orders.groupBy("order_has_discount")
        .agg(
            F.count("order_id").alias("total_orders"),
            mean(F.col("order_gross"), WIDE_AVERAGE).alias("avg_gross_order_value"),
            mean(F.col("order_net"), WIDE_AVERAGE).alias("avg_net_order_value"),
            count_mean(F.col("items_in_order"), 2).alias("avg_items_per_order"),
            mean(F.col("order_discount"), WIDE_AVERAGE).alias("avg_discount_amount"),
            total(F.col("order_gross")).alias("total_gross_revenue"),
            total(F.col("order_net")).alias("total_net_revenue"),
            F.count_distinct("user_id").alias("unique_customers"),
            percent(F.count_if("order_has_discount"), F.count("order_id"), "decimal(5,2)")
            .cast("double")
            .alias("discount_order_rate_pct"),
        )
        .withColumn("discount_label", discount_label(F.col("order_has_discount")))
    )
    return conform(summary, GOLD_BUSINESS["discount_order_summary"])


def discount_by_category(priced: DataFrame) -> DataFrame:
    per_category = (
        priced.filter(F.col("item_category").isNotNull())
        .groupBy("item_category", "has_discount")
        .agg(
            F.count("lineitem_id").alias("total_line_items"),
            total(F.col("revenue")).alias("total_gross_revenue"),
            total(F.col("net_revenue")).alias("total_net_revenue"),
            mean(F.col("revenue"), WIDE_AVERAGE).alias("avg_item_price"),
            mean(F.col("discount_depth_pct"), WIDE_AVERAGE).alias("avg_discount_depth_pct"),
            total(F.abs("total_discount_amount")).alias("total_discount_given"),
            F.count_distinct("order_id").alias("total_orders"),
        )
        .withColumn("discount_label", discount_label(F.col("has_discount")))
    )
    return conform(per_category, GOLD_BUSINESS["discount_by_category"])


def discount_customer_behaviour(facts: DataFrame) -> DataFrame:
    """An order counts as discounted if any of its lines was, whoever the line belongs to."""
    per_customer = customers_only(facts).groupBy("user_id").agg(
        F.count_distinct("order_id").alias("total_orders"),
        distinct_where("order_id", "order_has_discount").alias("discounted_orders"),
        total(F.col("gross")).alias("total_gross_spend"),
        total(F.col("net")).alias("total_net_spend"),
        total(F.col("discount_given")).alias("total_discounts_received"),
        F.bool_or("is_loyalty").alias("is_loyalty_member"),
    )
    segmented = per_customer.withColumn(
        "discount_usage_rate", percent(F.col("discounted_orders"), F.col("total_orders"), "decimal(5,2)")
    ).withColumn("discount_seeker_segment", first_match(DISCOUNT_SEEKERS, DISCOUNT_SEEKER_OTHERWISE))
    return conform(segmented, GOLD_BUSINESS["discount_customer_behaviour"])
