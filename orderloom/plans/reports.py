"""Report queries over Gold tables: typed frames, latest snapshot, deterministic order.

Averages are exact decimals rounded once and handed out as doubles. Every top-k
orders by value and then by key, and runs as one distributed top-k.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.numbers import TOTAL, WIDE_AVERAGE, count_mean, money_mean, total


def _customers() -> Column:
    return F.count(F.lit(1)).alias("customers")


def _desc(value: str, *keys: str) -> list[Column]:
    return [F.col(value).desc_nulls_last(), *map(F.col, keys)]


def period_key() -> Column:
    """``year-MM``; NULL when the period is unknown."""
    year, month = F.col("year").cast("string"), F.lpad(F.col("month").cast("string"), 2, "0")
    return F.concat(year, F.lit("-"), month)


# Overview


def distinct_customers(clv: DataFrame) -> DataFrame:
    return clv.agg(F.count_distinct("user_id").alias("val"))


def total_net_revenue(clv: DataFrame) -> DataFrame:
    return clv.agg(F.sum("total_net_revenue").try_cast("decimal(22,0)").alias("val"))


def clv_band_overview(clv: DataFrame) -> DataFrame:
    bands = clv.groupBy("clv_band").agg(
        _customers(), money_mean(F.col("total_net_revenue")).alias("avg_revenue")
    )
    return bands.orderBy("clv_band")


def rfm_segment_counts(rfm: DataFrame) -> DataFrame:
    return rfm.groupBy("segment").agg(_customers()).orderBy(*_desc("customers", "segment"))


def risk_tag_counts(churn: DataFrame) -> DataFrame:
    counts = churn.groupBy("overall_risk_tag").agg(_customers())
    return counts.orderBy(*_desc("customers", "overall_risk_tag"))


def overview_kpis(clv: DataFrame, churn: DataFrame) -> DataFrame:
    churned = churn.agg(F.count_if(F.col("overall_risk_tag") == "CHURNED")).scalar()
    return clv.agg(
        F.count_distinct("user_id").alias("total_customers"),
        F.sum("total_net_revenue").try_cast("decimal(22,0)").alias("total_net_revenue"),
        F.count_if(F.col("clv_band") == "HIGH").alias("high_clv_customers"),
    ).withColumn("churned_customers", churned)


# Customers


def clv_bands(clv: DataFrame) -> DataFrame:
    bands = clv.groupBy("clv_band").agg(
        _customers(),
        money_mean(F.col("total_net_revenue")).alias("avg_revenue"),
        count_mean(F.col("total_orders"), 1).alias("avg_orders"),
        count_mean(F.col("days_as_customer"), 0).alias("avg_lifespan_days"),
    )
    return bands.orderBy("clv_band")


def top_customers(clv: DataFrame, k: int = 20) -> DataFrame:
    return (
        clv.orderBy(*_desc("total_net_revenue", "user_id"))
        .limit(k)
        .select(
            "user_id",
            "total_net_revenue",
            "total_orders",
            "clv_band",
            F.col("is_loyalty_member").alias("is_loyalty"),
            "days_since_last_order",
            F.col("unique_restaurants_visited").alias("restaurants_visited"),
        )
    )


def rfm_segments(rfm: DataFrame) -> DataFrame:
    segments = rfm.groupBy("segment").agg(
        _customers(),
        money_mean(F.col("monetary")).alias("avg_spend"),
        count_mean(F.col("frequency"), 1).alias("avg_orders"),
        count_mean(F.col("recency_days"), 0).alias("avg_recency_days"),
    )
    return segments.orderBy(*_desc("customers", "segment"))


def loyalty_clv(clv: DataFrame) -> DataFrame:
    by_loyalty = clv.groupBy(F.col("is_loyalty_member").alias("is_loyalty")).agg(
        _customers(),
        money_mean(F.col("total_net_revenue")).alias("avg_clv"),
        count_mean(F.col("total_orders"), 1).alias("avg_orders"),
    )
    return by_loyalty.withColumn(
        "label",
        F.when(F.col("is_loyalty"), F.lit("Loyalty Member")).when(~F.col("is_loyalty"), F.lit("Non-Loyalty")),
    ).orderBy("is_loyalty")


def customer_kpis(clv: DataFrame) -> DataFrame:
    return clv.agg(
        *(
            F.count_if(F.col("clv_band") == band).alias(f"{band.lower()}_customers")
            for band in ("HIGH", "MEDIUM", "LOW")
        ),
        *(
            money_mean(F.when(F.col("clv_band") == band, F.col("total_net_revenue"))).alias(
                f"{band.lower()}_avg_revenue"
            )
            for band in ("HIGH", "MEDIUM", "LOW")
        ),
        F.count(F.lit(1)).alias("total_customers"),
    )


# Churn

# Tags the churn page always shows.
SHOWN_TAGS = ("ACTIVE", "MONITOR", "AT_RISK", "CHURNED")


def churn_kpis(churn: DataFrame) -> DataFrame:
    """One row for each tag shown, with 0 customers and no average where none has it."""
    tags = F.explode(F.array(*map(F.lit, SHOWN_TAGS)))
    counted = churn.groupBy("overall_risk_tag").agg(_customers(), money_mean(F.col("total_revenue")).alias("avg_revenue"))
    shown = churn.sparkSession.range(1).select(tags.alias("overall_risk_tag"))
    return (
        shown.join(counted, "overall_risk_tag", "left")
        .select("overall_risk_tag", F.coalesce("customers", F.lit(0)).alias("customers"), "avg_revenue")
        .orderBy("overall_risk_tag")
    )


def risk_tags(churn: DataFrame) -> DataFrame:
    tags = churn.groupBy("overall_risk_tag").agg(
        _customers(),
        count_mean(F.col("days_since_last_order"), 0).alias("avg_days_inactive"),
        money_mean(F.col("total_revenue")).alias("avg_revenue"),
    )
    return tags.orderBy(*_desc("customers", "overall_risk_tag"))


def spend_trends(churn: DataFrame) -> DataFrame:
    trends = (
        churn.filter(F.col("pct_spend_change_p1_vs_p2").isNotNull())
        .groupBy("spend_trend")
        .agg(_customers(), money_mean(F.col("pct_spend_change_p1_vs_p2"), 1).alias("avg_pct_change"))
    )
    return trends.orderBy(*_desc("customers", "spend_trend"))


def spend_trend_counts(churn: DataFrame) -> DataFrame:
    counts = churn.groupBy("spend_trend").agg(_customers())
    return counts.orderBy(*_desc("customers", "spend_trend"))


def risk_levels(churn: DataFrame) -> DataFrame:
    levels = churn.groupBy("churn_risk_level").agg(
        _customers(), count_mean(F.col("days_since_last_order"), 0).alias("avg_days")
    )
    return levels.orderBy(*_desc("customers", "churn_risk_level"))


def risk_level_revenue(churn: DataFrame) -> DataFrame:
    levels = churn.groupBy("churn_risk_level").agg(
        _customers(),
        count_mean(F.col("days_since_last_order"), 0).alias("avg_days_inactive"),
        money_mean(F.col("total_revenue")).alias("avg_lifetime_revenue"),
    )
    return levels.orderBy("churn_risk_level")


def at_risk_customers(churn: DataFrame, k: int = 25) -> DataFrame:
    """Customers at risk or gone with more than 50 in lifetime revenue, the highest first."""
    return (
        churn.filter(F.col("overall_risk_tag").isin("AT_RISK", "CHURNED") & (F.col("total_revenue") > 50))
        .orderBy(*_desc("total_revenue", "user_id"))
        .limit(k)
        .select(
            "user_id",
            F.col("days_since_last_order").alias("days_inactive"),
            "total_revenue",
            "churn_risk_level",
            "spend_trend",
            "overall_risk_tag",
            "total_orders",
            F.col("avg_days_between_orders").alias("avg_gap_days"),
        )
    )


# Sales


def monthly_sales(monthly: DataFrame) -> DataFrame:
    """All restaurants together; ``unique_customers`` adds up per-restaurant counts."""
    return (
        monthly.groupBy("year", "month")
        .agg(
            total(F.col("gross_revenue")).alias("total_revenue"),
            F.sum("total_orders").alias("total_orders"),
            F.sum("unique_customers").alias("unique_customers"),
        )
        .withColumn("period", period_key())
        .orderBy("year", "month")
    )


def day_of_week_sales(daily: DataFrame) -> DataFrame:
    days = (
        daily.filter(F.col("day_of_week").isNotNull())
        .groupBy("day_of_week")
        .agg(
            total(F.col("gross_revenue")).alias("total_revenue"),
            F.sum("total_orders").alias("total_orders"),
            money_mean(F.col("avg_order_value")).alias("avg_order_value"),
        )
    )
    return days.orderBy(*_desc("total_revenue", "day_of_week"))


def holiday_sales(daily: DataFrame) -> DataFrame:
    """``days`` counts restaurant days; days outside the calendar have no label."""
    by_holiday = daily.groupBy("is_holiday").agg(
        F.count(F.lit(1)).alias("days"),
        total(F.col("gross_revenue")).alias("total_revenue"),
        money_mean(F.col("gross_revenue")).alias("avg_daily_revenue"),
        F.sum("total_orders").alias("total_orders"),
    )
    return by_holiday.withColumn(
        "label",
        F.when(F.col("is_holiday"), F.lit("Holiday")).when(~F.col("is_holiday"), F.lit("Regular Day")),
    ).orderBy("is_holiday")


def top_days(daily: DataFrame, k: int = 10) -> DataFrame:
    by_day = daily.groupBy("order_date", "restaurant_id", "is_holiday", "day_of_week").agg(
        total(F.col("gross_revenue")).alias("revenue"), F.sum("total_orders").alias("orders")
    )
    return by_day.orderBy(*_desc("revenue", "order_date", "restaurant_id")).limit(k)


def sales_kpis(monthly: DataFrame) -> DataFrame:
    return monthly_sales(monthly).agg(
        total(F.col("total_revenue")).alias("total_revenue"),
        F.sum("total_orders").alias("total_orders"),
        F.count(F.lit(1)).alias("months"),
    )


# Locations


def tier_summary(locations: DataFrame) -> DataFrame:
    tiers = locations.groupBy("performance_tier").agg(
        F.count(F.lit(1)).alias("restaurants"),
        money_mean(F.col("total_gross_revenue")).alias("avg_revenue"),
        money_mean(F.col("avg_order_value")).alias("avg_order_value"),
    )
    return tiers.orderBy(*_desc("avg_revenue", "performance_tier"))


def top_restaurants(locations: DataFrame, k: int = 20) -> DataFrame:
    return (
        locations.orderBy("revenue_rank", "restaurant_id")
        .limit(k)
        .select(
            "restaurant_id",
            F.col("total_gross_revenue").alias("total_revenue"),
            "total_orders",
            "unique_customers",
            "avg_order_value",
            F.col("loyalty_rate").cast("decimal(5,1)").alias("loyalty_rate_pct"),
            "performance_tier",
            F.col("revenue_rank").alias("rank"),
        )
    )


def bottom_restaurants(locations: DataFrame, k: int = 10) -> DataFrame:
    return (
        locations.orderBy(F.col("total_gross_revenue").asc_nulls_last(), "restaurant_id")
        .limit(k)
        .select(
            "restaurant_id",
            F.col("total_gross_revenue").alias("total_revenue"),
            "total_orders",
            "unique_customers",
            F.col("revenue_rank").alias("rank"),
        )
    )


def top_restaurant_growth(monthly: DataFrame, locations: DataFrame, k: int = 5) -> DataFrame:
    """Months with a known growth of the first ``k`` restaurants by revenue."""
    leaders = locations.orderBy("revenue_rank", "restaurant_id").limit(k).select("restaurant_id")
    return (
        monthly.filter(F.col("mom_revenue_growth_pct").isNotNull())
        .join(leaders, "restaurant_id", "left_semi")
        .select(
            "restaurant_id",
            "year",
            "month",
            "monthly_revenue",
            F.col("mom_revenue_growth_pct").cast("decimal(8,1)").alias("mom_growth_pct"),
        )
        .orderBy("restaurant_id", "year", "month")
    )


def location_kpis(locations: DataFrame) -> DataFrame:
    def average_in(tier: str) -> Column:
        return money_mean(F.when(F.col("performance_tier") == tier, F.col("total_gross_revenue")))

    return locations.agg(
        F.count(F.lit(1)).alias("total_restaurants"),
        average_in("TOP_10").alias("top_10_avg_revenue"),
        average_in("STANDARD").alias("standard_avg_revenue"),
    )


# Loyalty


def loyalty_overview(summary: DataFrame) -> DataFrame:
    return summary.select(
        "loyalty_label",
        "total_customers",
        "avg_clv",
        "avg_orders",
        "avg_order_value",
        F.col("avg_days_since_last_order").alias("avg_days_inactive"),
        F.col("total_revenue_contribution").alias("total_revenue"),
        "median_orders",
    )


def loyalty_categories(by_category: DataFrame, k: int = 30) -> DataFrame:
    return (
        by_category.filter(F.col("item_category").isNotNull())
        .orderBy(*_desc("total_revenue", "item_category", "is_loyalty"))
        .limit(k)
        .select("item_category", "loyalty_label", "total_revenue", "total_orders", "unique_customers")
    )


def leading_loyalty_categories(by_category: DataFrame, k: int = 8) -> DataFrame:
    """All rows of the ``k`` categories with the most revenue, ranked over the whole table, which is read once."""
    rows = by_category.filter(F.col("item_category").isNotNull()).select(
        "item_category", "loyalty_label", "total_revenue", "total_orders", "unique_customers"
    )
    by_label = F.collect_list(F.struct(*(name for name in rows.columns if name != "item_category")))
    return (
        rows.groupBy("item_category")
        .agg(total(F.col("total_revenue")).alias("revenue"), by_label.alias("rows"))
        .orderBy(*_desc("revenue", "item_category"))
        .limit(k)
        .select("item_category", F.inline("rows"))
    )


def loyalty_trend(monthly: DataFrame) -> DataFrame:
    return (
        monthly.select(
            "year", "month", "loyalty_label", "total_revenue", "total_orders", "unique_customers"
        )
        .withColumn("period", period_key())
        .orderBy("year", "month", "loyalty_label")
    )


def loyalty_kpis(summary: DataFrame) -> DataFrame:
    """Members against customers known not to be members."""
    member, other = F.col("is_loyalty"), ~F.col("is_loyalty")
    return summary.agg(
        F.max(F.when(member, F.col("total_customers"))).alias("loyalty_members"),
        F.max(F.when(other, F.col("total_customers"))).alias("non_loyalty_customers"),
        F.max(F.when(member, F.col("avg_clv"))).alias("loyalty_avg_clv"),
        F.max(F.when(other, F.col("avg_clv"))).alias("non_loyalty_avg_clv"),
    )


# Discounts


def discount_overview(summary: DataFrame) -> DataFrame:
    return summary.select(
        "discount_label",
        "total_orders",
        "avg_gross_order_value",
        "avg_net_order_value",
        "avg_items_per_order",
        "avg_discount_amount",
        "unique_customers",
    )


def _discount_rows(by_category: DataFrame) -> DataFrame:
    return by_category.select(
        "item_category",
        "discount_label",
        F.col("total_gross_revenue").alias("total_revenue"),
        F.col("total_discount_given").alias("total_discount"),
        F.col("avg_discount_depth_pct").cast("decimal(16,1)").alias("avg_discount_pct"),
        "total_orders",
    )


def discount_categories(by_category: DataFrame, k: int = 30) -> DataFrame:
    named = by_category.filter(F.col("item_category").isNotNull())
    return _discount_rows(named.orderBy(*_desc("total_gross_revenue", "item_category", "has_discount")).limit(k))


def most_discounted_categories(by_category: DataFrame, k: int = 10) -> DataFrame:
    """Discounted categories of the whole table by amount given, compared as numbers."""
    discounted = by_category.filter(F.col("item_category").isNotNull() & F.col("has_discount"))
    return _discount_rows(discounted.orderBy(*_desc("total_discount_given", "item_category")).limit(k))


def top_discount_categories(by_category: DataFrame, k: int = 5) -> DataFrame:
    return (
        by_category.filter("has_discount")
        .orderBy(*_desc("total_discount_given", "item_category"))
        .limit(k)
        .select("item_category", "total_discount_given", "avg_discount_depth_pct", "total_orders")
    )


def discount_segments(customers: DataFrame) -> DataFrame:
    segments = customers.groupBy("discount_seeker_segment").agg(
        _customers(),
        money_mean(F.col("total_net_spend")).alias("avg_spend"),
        money_mean(F.col("discount_usage_rate"), 1).alias("avg_discount_rate"),
        money_mean(F.col("total_discounts_received")).alias("avg_discounts_received"),
    )
    return segments.orderBy(*_desc("customers", "discount_seeker_segment"))


def discount_kpis(summary: DataFrame) -> DataFrame:
    discounted = F.col("order_has_discount")
    return summary.agg(
        F.max(F.when(discounted, F.col("total_orders"))).alias("discounted_orders"),
        F.max(F.when(~discounted, F.col("total_orders"))).alias("non_discounted_orders"),
        F.max(F.when(discounted, F.col("avg_discount_amount"))).alias("avg_discount_amount"),
        F.max(F.when(discounted, F.col("avg_items_per_order"))).alias("avg_items_discounted"),
    )


# Summaries a job prints after writing its table


def clv_band_range(clv: DataFrame) -> DataFrame:
    bands = clv.groupBy("clv_band").agg(
        _customers(),
        F.avg("total_net_revenue").try_cast(WIDE_AVERAGE).alias("avg_net_revenue"),
        F.min("total_net_revenue").alias("min_revenue"),
        F.max("total_net_revenue").alias("max_revenue"),
    )
    return bands.orderBy("clv_band")


def churn_risk_count(clv: DataFrame) -> DataFrame:
    return clv.agg(F.count_if("is_churn_risk").alias("churn_risk_customers"))


def rf_grid(rfm: DataFrame) -> DataFrame:
    grid = rfm.groupBy("r_score", "f_score").agg(_customers())
    return grid.orderBy("r_score", "f_score")


def monthly_totals(monthly: DataFrame) -> DataFrame:
    months = monthly.groupBy("year", "month").agg(
        F.sum("gross_revenue").try_cast(TOTAL).alias("total_revenue")
    )
    return months.orderBy("year", "month")
