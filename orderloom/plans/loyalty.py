"""Loyalty members against other customers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.context import cut_lineage
from orderloom.functions.numbers import WIDE_AVERAGE, count_mean, mean, ratio, total
from orderloom.functions.rules import loyalty_label
from orderloom.operators.order_facts import customers_only
from orderloom.operators.ranking import group_medians
from orderloom.schemas import GOLD_BUSINESS, conform


# Columns of the order facts that the summary reads.
READS = ("order_id", "user_id", "restaurant_id", "order_date", "is_loyalty", "net")


def customer_profiles(facts: DataFrame, lines: DataFrame) -> DataFrame:
    """One row per customer and loyalty flag, so a customer can have up to three.

    Only the number of categories needs line items; it is taken from their
    distinct categories, everything else from the order facts.
    """
    reference = facts.agg(F.max("order_date")).scalar()
    profiles = (
        customers_only(facts)
        .groupBy("user_id", "is_loyalty")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            total(F.col("net")).alias("total_net_revenue"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
            F.count_distinct("restaurant_id").alias("unique_restaurants"),
        )
    )
    categories = (
        customers_only(lines)
        .groupBy(F.col("user_id").alias("_user"), F.col("is_loyalty").alias("_loyalty"))
        .agg(F.count_distinct("item_category").alias("unique_categories"))
    )
    same = (F.col("user_id") == F.col("_user")) & F.col("is_loyalty").eqNullSafe(F.col("_loyalty"))
    return (
        profiles.join(categories, same)
        .drop("_user", "_loyalty")
        .withColumns(
            {
                "days_as_customer": F.datediff("last_order_date", "first_order_date"),
                "days_since_last_order": F.datediff(reference, "last_order_date"),
                "avg_order_value": ratio(F.col("total_net_revenue"), F.col("total_orders"), WIDE_AVERAGE),
            }
        )
    )


def loyalty_summary(facts: DataFrame, lines: DataFrame) -> DataFrame:
    """Averages, totals and exact medians over profiles; idle days count from the latest order."""
    profiles = cut_lineage(customer_profiles(facts, lines))
    averages = profiles.groupBy("is_loyalty").agg(
        F.count("user_id").alias("total_customers"),
        mean(F.col("total_net_revenue"), WIDE_AVERAGE).alias("avg_clv"),
        count_mean(F.col("total_orders"), 1).alias("avg_orders"),
        mean(F.col("avg_order_value"), WIDE_AVERAGE).alias("avg_order_value"),
        count_mean(F.col("days_as_customer"), 0).alias("avg_customer_lifespan_days"),
        count_mean(F.col("days_since_last_order"), 0).alias("avg_days_since_last_order"),
        count_mean(F.col("unique_restaurants"), 1).alias("avg_restaurants_visited"),
        count_mean(F.col("unique_categories"), 1).alias("avg_categories_purchased"),
        total(F.col("total_net_revenue")).alias("total_revenue_contribution"),
    )
    medians = group_medians(
        profiles, "is_loyalty", {"median_clv": "total_net_revenue", "median_orders": "total_orders"}
    ).withColumnRenamed("is_loyalty", "median_loyalty")
    summary = averages.join(
        medians, F.col("is_loyalty").eqNullSafe(F.col("median_loyalty")), "left"
    ).withColumns(
        {
            "median_clv": F.col("median_clv").cast("decimal(22,2)"),
            "median_orders": F.col("median_orders").cast("bigint"),
            "loyalty_label": loyalty_label(F.col("is_loyalty")),
        }
    )
    return conform(summary, GOLD_BUSINESS["loyalty_summary"])


def loyalty_by_category(priced: DataFrame) -> DataFrame:
    per_category = (
        priced.filter(F.col("item_category").isNotNull())
        .groupBy("item_category", "is_loyalty")
        .agg(
            total(F.col("net_revenue")).alias("total_revenue"),
            F.count_distinct("order_id").alias("total_orders"),
            F.count_distinct("user_id").alias("unique_customers"),
            mean(F.col("net_revenue"), WIDE_AVERAGE).alias("avg_item_revenue"),
        )
        .withColumn("loyalty_label", loyalty_label(F.col("is_loyalty")))
    )
    return conform(per_category, GOLD_BUSINESS["loyalty_by_category"])


def loyalty_monthly(facts: DataFrame) -> DataFrame:
    monthly = (
        facts.groupBy(
            F.year("order_date").alias("year"), F.month("order_date").alias("month"), "is_loyalty"
        )
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            total(F.col("net")).alias("total_revenue"),
            F.count_distinct("user_id").alias("unique_customers"),
        )
        .withColumn("loyalty_label", loyalty_label(F.col("is_loyalty")))
    )
    return conform(monthly, GOLD_BUSINESS["loyalty_monthly_trend"])
