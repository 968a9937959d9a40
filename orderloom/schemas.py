"""One explicit schema per table; writers and readers go through ``conform``.

``id`` stands for a key whose type comes from the source and is never cast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ID = "id"


class SchemaMismatch(ValueError):
    """A frame does not have the columns or types its table declares."""


def _columns(text: str) -> tuple[tuple[str, str], ...]:
    return tuple(tuple(item.split(" ", 1)) for item in " ".join(text.split()).split(", "))


_SILVER_RUN = "pipeline_run_ts string, pipeline_run_date string, silver_loaded_at timestamp"
_GOLD_RUN = "snapshot_date string, pipeline_run_ts string, pipeline_run_date string"

SILVER = {
    "order_items": _columns(
        """order_id id, lineitem_id id, user_id id, printed_card_number string, restaurant_id id,
        app_name string, item_name string, item_category string, item_price decimal(10,2),
        item_quantity int, revenue decimal(12,2), currency string, is_loyalty boolean,
        creation_time_utc timestamp, order_date date, dq_flag string,
        eligible_for_customer_metrics boolean, """
        + _SILVER_RUN
        + ", year int, month int, day int"
    ),
    "order_item_options": _columns(
        """order_id id, lineitem_id id, option_group_name string, option_name string,
        option_price decimal(10,2), option_quantity int, is_discount boolean, dq_flag string, """
        + _SILVER_RUN
    ),
    "date_dim": _columns(
        """date_key date, day_of_week string, week int, month int, year int, is_weekend boolean,
        is_holiday boolean, holiday_name string, """
        + _SILVER_RUN
    ),
    "priced_items": _columns(
        """order_id id, lineitem_id id, user_id id, restaurant_id id, item_name string,
        item_category string, item_quantity int, is_loyalty boolean, order_date date,
        revenue decimal(12,2), total_discount_amount decimal(12,2), has_discount boolean,
        net_revenue decimal(12,2), discount_depth_pct decimal(12,2)"""
    ),
    "order_facts": _columns(
        """order_id id, user_id id, restaurant_id id, order_date date, is_loyalty boolean,
        line_items bigint, gross decimal(22,2), gross_lines bigint, net decimal(22,2),
        net_lines bigint, discount decimal(22,2), discount_given decimal(22,2),
        has_discount boolean, order_has_discount boolean"""
    ),
}

GOLD_BUSINESS = {
    "clv": _columns(
        """user_id id, total_gross_revenue decimal(22,2), total_net_revenue decimal(22,2),
        total_discounts_received decimal(22,2), total_orders bigint, total_line_items bigint,
        avg_order_item_value decimal(10,2), first_order_date date, last_order_date date,
        days_as_customer int, days_since_last_order int, active_days bigint,
        avg_order_frequency_days decimal(8,1), is_loyalty_member boolean, loyalty_orders bigint,
        unique_restaurants_visited bigint, revenue_percentile double, clv_band string,
        is_churn_risk boolean"""
    ),
    "rfm": _columns(
        """user_id id, recency_days int, frequency bigint, monetary decimal(22,2),
        first_order_date date, last_order_date date, active_days bigint,
        is_loyalty_member boolean, r_score int, f_score int, m_score int, rfm_score int,
        segment string, is_churn_risk boolean, reference_date string"""
    ),
    "churn_indicators": _columns(
        """user_id id, first_order_date date, last_order_date date, days_since_last_order int,
        customer_lifespan_days int, total_orders bigint, total_revenue decimal(22,2),
        avg_days_between_orders decimal(8,1), min_days_between_orders int,
        max_days_between_orders int, stddev_days_between_orders decimal(8,1),
        spend_last_90d decimal(22,2), spend_91_180d decimal(22,2), spend_181_270d decimal(22,2),
        pct_spend_change_p1_vs_p2 decimal(8,2), is_loyalty_member boolean,
        churn_risk_level string, spend_trend string, overall_risk_tag string,
        reference_date string"""
    ),
    "sales_trends_daily": _columns(
        """order_date date, restaurant_id id, day_of_week string, is_weekend boolean,
        is_holiday boolean, holiday_name string, total_orders bigint, total_line_items bigint,
        gross_revenue decimal(22,2), unique_customers bigint, avg_item_revenue decimal(10,2),
        loyalty_revenue decimal(22,2), non_loyalty_revenue decimal(22,2),
        avg_order_value decimal(16,2), year int, month int"""
    ),
    "sales_trends_weekly": _columns(
        """year int, week int, restaurant_id id, total_orders bigint,
        gross_revenue decimal(22,2), unique_customers bigint, avg_item_revenue decimal(10,2),
        week_start_date date, week_end_date date, avg_order_value decimal(16,2)"""
    ),
    "sales_trends_monthly": _columns(
        """year int, month int, restaurant_id id, total_orders bigint,
        gross_revenue decimal(22,2), unique_customers bigint, avg_item_revenue decimal(10,2),
        loyalty_customers bigint, non_loyalty_customers bigint, holiday_revenue decimal(22,2),
        avg_order_value decimal(16,2)"""
    ),
    "location_performance": _columns(
        """restaurant_id id, total_gross_revenue decimal(22,2), avg_item_revenue decimal(10,2),
        total_orders bigint, total_line_items bigint, unique_customers bigint,
        loyalty_customers bigint, first_order_date date, last_order_date date,
        active_days bigint, unique_categories bigint, unique_items bigint,
        avg_order_value decimal(16,2), avg_daily_revenue decimal(16,2),
        loyalty_rate decimal(5,2), items_per_order decimal(5,2), revenue_rank int,
        orders_rank int, aov_rank int, performance_tier string"""
    ),
    "location_monthly_performance": _columns(
        """restaurant_id id, year int, month int, monthly_revenue decimal(22,2),
        monthly_orders bigint, monthly_unique_customers bigint,
        avg_item_revenue decimal(10,2), prev_month_revenue decimal(22,2),
        mom_revenue_growth_pct decimal(8,2)"""
    ),
    "location_top_items": _columns(
        """restaurant_id id, item_name string, item_category string,
        item_revenue decimal(22,2), total_quantity_sold bigint, orders_containing_item bigint,
        item_rank_in_restaurant int"""
    ),
    "loyalty_summary": _columns(
        """is_loyalty boolean, total_customers bigint, avg_clv decimal(16,2),
        avg_orders double, avg_order_value decimal(16,2), avg_customer_lifespan_days double,
        avg_days_since_last_order double, avg_restaurants_visited double,
        avg_categories_purchased double, total_revenue_contribution decimal(22,2),
        median_clv decimal(22,2), median_orders bigint, loyalty_label string"""
    ),
    "loyalty_by_category": _columns(
        """item_category string, is_loyalty boolean, total_revenue decimal(22,2),
        total_orders bigint, unique_customers bigint, avg_item_revenue decimal(16,2),
        loyalty_label string"""
    ),
    "loyalty_monthly_trend": _columns(
        """year int, month int, is_loyalty boolean, total_orders bigint,
        total_revenue decimal(22,2), unique_customers bigint, loyalty_label string"""
    ),
    "discount_order_summary": _columns(
        """order_has_discount boolean, total_orders bigint,
        avg_gross_order_value decimal(16,2), avg_net_order_value decimal(16,2),
        avg_items_per_order double, avg_discount_amount decimal(16,2),
        total_gross_revenue decimal(22,2), total_net_revenue decimal(22,2),
        unique_customers bigint, discount_order_rate_pct double, discount_label string"""
    ),
    "discount_by_category": _columns(
        """item_category string, has_discount boolean, total_line_items bigint,
        total_gross_revenue decimal(22,2), total_net_revenue decimal(22,2),
        avg_item_price decimal(16,2), avg_discount_depth_pct decimal(16,2),
        total_discount_given decimal(22,2), total_orders bigint, discount_label string"""
    ),
    "discount_customer_behaviour": _columns(
        """user_id id, total_orders bigint, discounted_orders bigint,
        total_gross_spend decimal(22,2), total_net_spend decimal(22,2),
        total_discounts_received decimal(22,2), is_loyalty_member boolean,
        discount_usage_rate decimal(5,2), discount_seeker_segment string"""
    ),
}

GOLD = {name: columns + _columns(_GOLD_RUN) for name, columns in GOLD_BUSINESS.items()}


def struct(columns: tuple[tuple[str, str], ...], id_type: str = "bigint") -> T.StructType:
    """Concrete reader schema for a lake whose keys have ``id_type``."""
    return T.StructType.fromDDL(
        ", ".join(f"`{name}` {id_type if kind == ID else kind}" for name, kind in columns)
    )


def conform(df: DataFrame, columns: tuple[tuple[str, str], ...]) -> DataFrame:
    """Select exactly the declared columns in order, refusing a wrong or missing type."""
    have = dict(df.dtypes)
    wrong = [
        f"{name}: {have.get(name, 'missing')} instead of {kind}"
        for name, kind in columns
        if name not in have or (kind != ID and have[name] != kind)
    ]
    if wrong:
        raise SchemaMismatch("; ".join(wrong))
    return df.select(*(F.col(name) for name, _ in columns))
