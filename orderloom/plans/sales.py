"""Sales trends per restaurant by day, week and month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.numbers import AVERAGE, WIDE_AVERAGE, distinct_where, mean_of, ratio, total
from orderloom.schemas import GOLD_BUSINESS, conform


def _with_order_value(df: DataFrame) -> DataFrame:
    return df.withColumn("avg_order_value", ratio(F.col("gross_revenue"), F.col("total_orders"), WIDE_AVERAGE))


def _with_calendar(df: DataFrame, calendar: DataFrame, *attributes: str) -> DataFrame:
    """Left join of day attributes; days the calendar lacks keep NULLs.

    No broadcast hint: the calendar is normally tiny and Spark broadcasts it by
    its size, but nothing here depends on that.
    """
    days = calendar.select("date_key", *attributes).distinct()
    return df.join(days, F.col("order_date") == F.col("date_key"), "left").drop("date_key")


def sales_daily(facts: DataFrame, calendar: DataFrame) -> DataFrame:
    """Totals per day and restaurant first; the calendar joins the much smaller result."""
    daily = facts.groupBy("order_date", "restaurant_id").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.sum("line_items").alias("total_line_items"),
        total(F.col("gross")).alias("gross_revenue"),
        F.count_distinct("user_id").alias("unique_customers"),
        mean_of(F.sum("gross"), F.sum("gross_lines"), AVERAGE).alias("avg_item_revenue"),
        total(F.when(F.col("is_loyalty"), F.col("gross")).otherwise(0)).alias("loyalty_revenue"),
        total(F.when(~F.col("is_loyalty"), F.col("gross")).otherwise(0)).alias("non_loyalty_revenue"),
    )
    attributes = ("day_of_week", "is_weekend", "is_holiday", "holiday_name")
    dated = _with_calendar(_with_order_value(daily), calendar, *attributes).withColumns(
        {"year": F.year("order_date"), "month": F.month("order_date")}
    )
    return conform(dated, GOLD_BUSINESS["sales_trends_daily"])


def sales_weekly(facts: DataFrame, calendar: DataFrame) -> DataFrame:
    """Calendar year with the calendar's own week number, as both are stored."""
    weekly = (
        _with_calendar(facts, calendar, "week")
        .groupBy(F.year("order_date").alias("year"), "week", "restaurant_id")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            total(F.col("gross")).alias("gross_revenue"),
            F.count_distinct("user_id").alias("unique_customers"),
            mean_of(F.sum("gross"), F.sum("gross_lines"), AVERAGE).alias("avg_item_revenue"),
            F.min("order_date").alias("week_start_date"),
            F.max("order_date").alias("week_end_date"),
        )
    )
    return conform(_with_order_value(weekly), GOLD_BUSINESS["sales_trends_weekly"])


def sales_monthly(facts: DataFrame, calendar: DataFrame) -> DataFrame:
    monthly = (
        _with_calendar(facts, calendar, "is_holiday")
        .groupBy(F.year("order_date").alias("year"), F.month("order_date").alias("month"), "restaurant_id")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            total(F.col("gross")).alias("gross_revenue"),
            F.count_distinct("user_id").alias("unique_customers"),
            mean_of(F.sum("gross"), F.sum("gross_lines"), AVERAGE).alias("avg_item_revenue"),
            distinct_where("user_id", "is_loyalty").alias("loyalty_customers"),
            distinct_where("user_id", "NOT is_loyalty").alias("non_loyalty_customers"),
            total(F.when(F.col("is_holiday"), F.col("gross")).otherwise(0)).alias("holiday_revenue"),
        )
    )
    return conform(_with_order_value(monthly), GOLD_BUSINESS["sales_trends_monthly"])
