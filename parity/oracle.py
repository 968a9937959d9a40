"""DuckDB SQL for every query, written from the raw test tables up.

Averages and ratios are computed on integers, because DuckDB divides decimals in
floating point. ``CTES`` names the building blocks; ``sql`` adds those a query uses.
"""

from __future__ import annotations

import re

SNAPSHOT = "DATE '2001-12-31'"
MARK = "TIMESTAMP '2000-06-30 00:00:00'"


def cents(amount: str) -> str:
    return f"CAST(CAST({amount} AS DECIMAL(28,2)) * 100 AS HUGEINT)"


def half_up(a: str, b: str, digits: int, kind: str) -> str:
    """a / b on integers, b >= 0, rounded half up once."""
    sign = f"(CASE WHEN ({a}) < 0 THEN -1 ELSE 1 END)"
    scaled = f"{sign} * ((2 * abs({a}) * {10**digits} + ({b})) // (2 * NULLIF(({b}), 0)))"
    return f"TRY_CAST(({scaled}) / 1e{digits} AS {kind})"


def avg6(total: str, count: str, kind: str) -> str:
    """Decimal average kept to six digits first, then to two."""
    sign = f"(CASE WHEN ({total}) < 0 THEN -1 ELSE 1 END)"
    six = f"((abs({cents(total)}) * 20000 + ({count})) // (2 * NULLIF(({count}), 0)))"
    return f"TRY_CAST({sign} * (({six} + 5000) // 10000) / 1e2 AS {kind})"


def avg_money(column: str, kind: str) -> str:
    return avg6(f"SUM({column})", f"COUNT({column})", kind)


def mean_money(column: str, digits: int = 2) -> str:
    """One-step average of a two-digit decimal as a double."""
    return half_up(cents(f"SUM({column})"), f"COUNT({column}) * 100", digits, "DOUBLE")


def mean_count(column: str, digits: int) -> str:
    return half_up(f"CAST(SUM({column}) AS HUGEINT)", f"COUNT({column})", digits, "DOUBLE")


def total(amount: str) -> str:
    return f"CAST(SUM({amount}) AS DECIMAL(22,2))"


def growth(current: str, previous: str) -> str:
    pct = half_up(f"({cents(current)} - {cents(previous)}) * 100", cents(previous), 2, "DECIMAL(8,2)")
    return f"CASE WHEN {previous} > 0 THEN {pct} END"


def days(start: str, end: str) -> str:
    return f"CAST(date_diff('day', {start}, {end}) AS INTEGER)"


LABEL = "CASE WHEN is_loyalty THEN 'Loyalty Member' ELSE 'Non-Loyalty' END"
PRICE = "CAST(l_extendedprice AS DECIMAL(10,2))"
ORDER_VALUE = half_up(cents("gross_revenue"), "total_orders * 100", 2, "DECIMAL(16,2)")
YEAR, MONTH = "CAST(year(order_date) AS INTEGER)", "CAST(month(order_date) AS INTEGER)"
CUSTOMERS = "COUNT(*) AS customers"
PERIOD = "CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS period"

DISCOUNT_ROWS = """SELECT item_category, discount_label, total_gross_revenue AS total_revenue,
               total_discount_given AS total_discount,
               CAST(sign(avg_discount_depth_pct) * ((CAST(abs(avg_discount_depth_pct) * 100 AS HUGEINT) + 5) // 10) / 1e1
                    AS DECIMAL(16,1)) AS avg_discount_pct, total_orders"""

CTES = {
    "raw_items": f"""
        SELECT CASE WHEN l_partkey % 500 = 13 THEN NULL ELSE l_orderkey END AS order_id,
               CASE WHEN l_partkey % 500 = 7 THEN NULL ELSE l_orderkey * 10 + l_linenumber END AS lineitem_id,
               CASE WHEN o_custkey % 12 = 5 THEN NULL ELSE o_custkey END AS user_id,
               CASE WHEN l_partkey % 4 = 0 THEN concat('CARD-', CAST(o_custkey AS VARCHAR)) END
                   AS printed_card_number,
               o_orderkey % 61 AS restaurant_id,
               concat('app', CAST(o_orderkey % 3 AS VARCHAR)) AS app_name,
               p_name AS item_name,
               CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE p_type END AS item_category,
               CASE WHEN l_partkey % 89 = 0 THEN NULL WHEN l_partkey % 97 = 0 THEN -{PRICE}
                    ELSE {PRICE} END AS item_price,
               CASE WHEN l_partkey % 101 = 0 THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS item_quantity,
               'USD' AS currency,
               CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE o_orderkey % 10 < 3 END AS is_loyalty,
               CASE WHEN o_orderkey % 211 = 0 THEN NULL WHEN o_orderkey % 67 = 3
                    THEN o_orderdate - INTERVAL 10 YEAR ELSE o_orderdate END AS creation_time_utc,
               l_shipdate AS ingestion_ts, l_partkey AS tie
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "raw_options": f"""
        SELECT CASE WHEN l_partkey % 500 = 13 THEN NULL ELSE l_orderkey END AS order_id,
               CASE WHEN l_partkey % 500 = 7 THEN NULL ELSE l_orderkey * 10 + l_linenumber END AS lineitem_id,
               CASE WHEN l_partkey % 53 = 0 THEN NULL ELSE 'PROMO' END AS option_group_name,
               CASE WHEN l_partkey % 59 = 0 THEN NULL ELSE 'discount' END AS option_name,
               CASE WHEN l_partkey % 61 = 0 THEN NULL WHEN o_orderpriority IN ('1-URGENT', '2-HIGH')
                    THEN CAST(-({PRICE} * CAST(l_discount AS DECIMAL(3,2))) AS DECIMAL(10,2)) ELSE CAST(0 AS DECIMAL(10,2)) END AS option_price,
               1 AS option_quantity, l_shipdate AS ingestion_ts, l_partkey AS tie
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        UNION ALL
        SELECT CASE WHEN l_partkey % 500 = 13 THEN NULL ELSE l_orderkey END,
               CASE WHEN l_partkey % 500 = 7 THEN NULL ELSE l_orderkey * 10 + l_linenumber END,
               'SIDE', 'extra', CAST(CAST(l_tax AS DECIMAL(3,2)) * 100 AS DECIMAL(10,2)),
               1, l_shipdate, l_partkey
        FROM lineitem""",
    "typed_items": """
        SELECT *, CAST(creation_time_utc AS DATE) AS order_date,
               CAST(item_price * item_quantity AS DECIMAL(12,2)) AS revenue,
               CASE WHEN lineitem_id IS NULL THEN 'NULL_LINEITEM_ID'
                    WHEN order_id IS NULL THEN 'NULL_ORDER_ID'
                    WHEN user_id IS NULL THEN 'NULL_USER_ID'
                    WHEN printed_card_number IS NULL THEN 'NULL_CARD_NUMBER'
                    WHEN item_price IS NULL THEN 'NULL_PRICE'
                    WHEN item_price < 0 THEN 'NEGATIVE_PRICE'
                    WHEN item_quantity <= 0 THEN 'INVALID_QUANTITY'
                    WHEN creation_time_utc IS NULL THEN 'NULL_TIMESTAMP'
                    ELSE 'CLEAN' END AS dq_flag
        FROM raw_items""",
    "items": f"""
        SELECT order_id, lineitem_id, user_id, printed_card_number, restaurant_id, app_name, item_name,
               item_category, item_price, item_quantity, revenue, currency, is_loyalty, creation_time_utc,
               order_date, dq_flag, user_id IS NOT NULL AS eligible_for_customer_metrics,
               {YEAR} AS year, {MONTH} AS month, CAST(day(order_date) AS INTEGER) AS day
        FROM (SELECT *, row_number() OVER (PARTITION BY lineitem_id ORDER BY ingestion_ts DESC, tie,
                         item_price NULLS FIRST, item_quantity NULLS FIRST) AS rn
              FROM typed_items WHERE dq_flag NOT IN ('NULL_LINEITEM_ID', 'NULL_ORDER_ID')) x
        WHERE rn = 1""",
    "typed_options": """
        SELECT *, COALESCE(option_price < 0, FALSE) AS is_discount,
               CASE WHEN order_id IS NULL THEN 'NULL_ORDER_ID'
                    WHEN lineitem_id IS NULL THEN 'NULL_LINEITEM_ID'
                    WHEN option_name IS NULL THEN 'NULL_OPTION_NAME'
                    WHEN option_group_name IS NULL THEN 'NULL_OPTION_GROUP'
                    WHEN option_price IS NULL THEN 'NULL_OPTION_PRICE'
                    ELSE 'CLEAN' END AS dq_flag
        FROM raw_options""",
    "options": """
        SELECT order_id, lineitem_id, option_group_name, option_name, option_price, option_quantity,
               is_discount, dq_flag
        FROM (SELECT *, row_number() OVER (PARTITION BY lineitem_id, option_group_name, option_name
                         ORDER BY ingestion_ts DESC, tie, option_price NULLS FIRST) AS rn
              FROM typed_options
              WHERE dq_flag NOT IN ('NULL_ORDER_ID', 'NULL_LINEITEM_ID', 'NULL_OPTION_NAME')) x
        WHERE rn = 1""",
    "calendar": """
        SELECT d AS date_key, dayname(d) AS day_of_week, CAST(week(d) AS INTEGER) AS week,
               CAST(month(d) AS INTEGER) AS month, CAST(year(d) AS INTEGER) AS year,
               dayname(d) IN ('Saturday', 'Sunday') AS is_weekend,
               (month(d) * 100 + day(d)) IN (101, 704, 1225) AS is_holiday,
               CASE month(d) * 100 + day(d) WHEN 101 THEN 'New Year' WHEN 704 THEN 'Independence Day'
                    WHEN 1225 THEN 'Christmas' END AS holiday_name
        FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) x""",
    "option_sums": """
        SELECT order_id, lineitem_id, CAST(SUM(option_price) AS DECIMAL(12,2)) AS total_option_price,
               CAST(SUM(CASE WHEN is_discount THEN option_price ELSE 0 END) AS DECIMAL(12,2))
                   AS total_discount_amount,
               COUNT(*) FILTER (WHERE is_discount) AS discount_count, bool_or(is_discount) AS has_discount
        FROM options GROUP BY ALL""",
    "priced": """
        SELECT i.*, COALESCE(s.total_option_price, 0) AS total_option_price,
               COALESCE(s.total_discount_amount, 0) AS total_discount_amount,
               COALESCE(s.has_discount, FALSE) AS has_discount,
               CAST(revenue + COALESCE(s.total_option_price, 0) AS DECIMAL(12,2)) AS net_revenue
        FROM items i LEFT JOIN option_sums s USING (order_id, lineitem_id)""",
    "clv": f"""
        SELECT user_id, {total("revenue")} AS total_gross_revenue,
               {total("net_revenue")} AS total_net_revenue,
               {total("total_discount_amount")} AS total_discounts_received,
               COUNT(DISTINCT order_id) AS total_orders, COUNT(lineitem_id) AS total_line_items,
               {avg_money("net_revenue", "DECIMAL(10,2)")} AS avg_order_item_value,
               MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date,
               {days("MIN(order_date)", SNAPSHOT)} AS days_as_customer,
               {days("MAX(order_date)", SNAPSHOT)} AS days_since_last_order,
               COUNT(DISTINCT order_date) AS active_days,
               CASE WHEN COUNT(DISTINCT order_id) > 1 THEN
                   {half_up(days("MIN(order_date)", SNAPSHOT), "COUNT(DISTINCT order_id) - 1", 1, "DECIMAL(8,1)")}
                   END AS avg_order_frequency_days,
               bool_or(is_loyalty) AS is_loyalty_member,
               COUNT(DISTINCT CASE WHEN is_loyalty THEN order_id END) AS loyalty_orders,
               COUNT(DISTINCT restaurant_id) AS unique_restaurants_visited
        FROM priced WHERE eligible_for_customer_metrics GROUP BY user_id""",
    "gold_clv": """
        SELECT *, CASE WHEN revenue_percentile >= 0.8 THEN 'HIGH' WHEN revenue_percentile >= 0.2 THEN 'MEDIUM'
                       ELSE 'LOW' END AS clv_band
        FROM (SELECT *, percent_rank() OVER (ORDER BY total_net_revenue NULLS FIRST) AS revenue_percentile,
                     COALESCE(date_diff('day', last_order_date, MAX(last_order_date) OVER ()) > 45, FALSE)
                         AS is_churn_risk
              FROM clv) x""",
    "rfm_base": f"""
        SELECT user_id, COUNT(DISTINCT order_id) AS frequency, {total("revenue")} AS monetary,
               MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date,
               COUNT(DISTINCT order_date) AS active_days, bool_or(is_loyalty) AS is_loyalty_member
        FROM items WHERE eligible_for_customer_metrics GROUP BY user_id""",
    "rfm_scored": f"""
        SELECT *, CAST(ntile(5) OVER (ORDER BY recency_days DESC NULLS LAST, user_id) AS INTEGER) AS r_score,
               CAST(ntile(5) OVER (ORDER BY frequency, user_id) AS INTEGER) AS f_score,
               CAST(ntile(5) OVER (ORDER BY monetary NULLS FIRST, user_id) AS INTEGER) AS m_score
        FROM (SELECT *, {days("last_order_date", "MAX(last_order_date) OVER ()")} AS recency_days,
                     CAST(MAX(last_order_date) OVER () AS VARCHAR) AS reference_date FROM rfm_base) x""",
    "gold_rfm": """
        SELECT user_id, recency_days, frequency, monetary, first_order_date, last_order_date, active_days,
               is_loyalty_member, r_score, f_score, m_score,
               CAST(r_score + f_score + m_score AS INTEGER) AS rfm_score,
               CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'VIP'
                    WHEN r_score >= 3 AND f_score >= 3 THEN 'Loyal Customers'
                    WHEN r_score >= 4 THEN 'New Customers'
                    WHEN r_score = 3 THEN 'Promising'
                    WHEN f_score >= 4 THEN 'At Risk'
                    WHEN f_score >= 2 THEN 'Hibernating'
                    WHEN r_score = 1 THEN 'Lost' ELSE 'Others' END AS segment,
               COALESCE(recency_days > 45, FALSE) AS is_churn_risk, reference_date
        FROM rfm_scored""",
    "latest_eligible": "SELECT MAX(order_date) AS d FROM items WHERE eligible_for_customer_metrics",
    "gaps": f"""
        SELECT user_id, {half_up("CAST(SUM(gap) AS HUGEINT)", "COUNT(gap)", 1, "DECIMAL(8,1)")}
                   AS avg_days_between_orders,
               MIN(gap) AS min_days_between_orders, MAX(gap) AS max_days_between_orders,
               CAST(stddev_samp(gap) AS DECIMAL(8,1)) AS stddev_days_between_orders
        FROM (SELECT user_id,
                     {days("lag(order_date) OVER (PARTITION BY user_id ORDER BY order_date)", "order_date")} AS gap
              FROM (SELECT DISTINCT user_id, order_date FROM items
                    WHERE eligible_for_customer_metrics AND order_date IS NOT NULL) x) y
        WHERE gap IS NOT NULL GROUP BY user_id""",
    "spend": f"""
        SELECT user_id, MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date,
               {days("MAX(order_date)", "ANY_VALUE(d)")} AS days_since_last_order,
               {days("MIN(order_date)", "MAX(order_date)")} AS customer_lifespan_days,
               COUNT(DISTINCT order_id) AS total_orders, {total("revenue")} AS total_revenue,
               {total("CASE WHEN age <= 90 THEN revenue ELSE 0 END")} AS spend_last_90d,
               {total("CASE WHEN age > 90 AND age <= 180 THEN revenue ELSE 0 END")} AS spend_91_180d,
               {total("CASE WHEN age > 180 AND age <= 270 THEN revenue ELSE 0 END")} AS spend_181_270d,
               bool_or(is_loyalty) AS is_loyalty_member, CAST(ANY_VALUE(d) AS VARCHAR) AS reference_date
        FROM (SELECT i.*, d, date_diff('day', order_date, d) AS age
              FROM items i, latest_eligible WHERE eligible_for_customer_metrics) x
        GROUP BY user_id""",
    "churn_levels": f"""
        SELECT s.*, g.avg_days_between_orders, g.min_days_between_orders, g.max_days_between_orders,
               g.stddev_days_between_orders,
               {growth("spend_last_90d", "spend_91_180d")} AS pct_spend_change_p1_vs_p2,
               CASE WHEN days_since_last_order > 180 THEN 'CRITICAL' WHEN days_since_last_order > 90 THEN 'HIGH'
                    WHEN days_since_last_order > 45 THEN 'MEDIUM' ELSE 'LOW' END AS churn_risk_level
        FROM spend s LEFT JOIN gaps g USING (user_id)""",
    "churn_trends": """
        SELECT *, CASE WHEN pct_spend_change_p1_vs_p2 IS NULL THEN 'INSUFFICIENT_DATA'
                       WHEN pct_spend_change_p1_vs_p2 >= 20 THEN 'GROWING'
                       WHEN pct_spend_change_p1_vs_p2 >= -10 THEN 'STABLE'
                       WHEN pct_spend_change_p1_vs_p2 >= -50 THEN 'DECLINING'
                       ELSE 'SEVERELY_DECLINING' END AS spend_trend
        FROM churn_levels""",
    "gold_churn": """
        SELECT *, CASE WHEN churn_risk_level = 'CRITICAL' AND spend_trend IN ('DECLINING', 'SEVERELY_DECLINING')
                           THEN 'CHURNED'
                       WHEN churn_risk_level = 'HIGH' AND spend_trend = 'SEVERELY_DECLINING' THEN 'CHURNED'
                       WHEN churn_risk_level IN ('HIGH', 'CRITICAL') THEN 'AT_RISK'
                       WHEN churn_risk_level = 'MEDIUM' AND spend_trend IN ('DECLINING', 'SEVERELY_DECLINING')
                           THEN 'AT_RISK'
                       WHEN churn_risk_level = 'LOW' THEN 'ACTIVE' ELSE 'MONITOR' END AS overall_risk_tag
        FROM churn_trends""",
    "dated": "SELECT i.*, c.* EXCLUDE (year, month) FROM items i LEFT JOIN calendar c ON order_date = date_key",
    "daily": f"""
        SELECT order_date, restaurant_id, day_of_week, is_weekend, is_holiday, holiday_name,
               COUNT(DISTINCT order_id) AS total_orders, COUNT(lineitem_id) AS total_line_items,
               {total("revenue")} AS gross_revenue, COUNT(DISTINCT user_id) AS unique_customers,
               {avg_money("revenue", "DECIMAL(10,2)")} AS avg_item_revenue,
               {total("CASE WHEN is_loyalty THEN revenue ELSE 0 END")} AS loyalty_revenue,
               {total("CASE WHEN NOT is_loyalty THEN revenue ELSE 0 END")} AS non_loyalty_revenue
        FROM dated GROUP BY order_date, restaurant_id, day_of_week, is_weekend, is_holiday, holiday_name""",
    "gold_daily": f"SELECT *, {ORDER_VALUE} AS avg_order_value, {YEAR} AS year, {MONTH} AS month FROM daily",
    "weekly": f"""
        SELECT year, week, restaurant_id, COUNT(DISTINCT order_id) AS total_orders,
               {total("revenue")} AS gross_revenue, COUNT(DISTINCT user_id) AS unique_customers,
               {avg_money("revenue", "DECIMAL(10,2)")} AS avg_item_revenue,
               MIN(order_date) AS week_start_date, MAX(order_date) AS week_end_date
        FROM dated GROUP BY year, week, restaurant_id""",
    "gold_weekly": f"SELECT *, {ORDER_VALUE} AS avg_order_value FROM weekly",
    "monthly": f"""
        SELECT year, month, restaurant_id, COUNT(DISTINCT order_id) AS total_orders,
               {total("revenue")} AS gross_revenue, COUNT(DISTINCT user_id) AS unique_customers,
               {avg_money("revenue", "DECIMAL(10,2)")} AS avg_item_revenue,
               COUNT(DISTINCT CASE WHEN is_loyalty THEN user_id END) AS loyalty_customers,
               COUNT(DISTINCT CASE WHEN NOT is_loyalty THEN user_id END) AS non_loyalty_customers,
               {total("CASE WHEN is_holiday THEN revenue ELSE 0 END")} AS holiday_revenue
        FROM dated GROUP BY year, month, restaurant_id""",
    "gold_monthly": f"SELECT *, {ORDER_VALUE} AS avg_order_value FROM monthly",
    "location": f"""
        SELECT restaurant_id, {total("revenue")} AS total_gross_revenue,
               {avg_money("revenue", "DECIMAL(10,2)")} AS avg_item_revenue,
               COUNT(DISTINCT order_id) AS total_orders, COUNT(lineitem_id) AS total_line_items,
               COUNT(DISTINCT user_id) AS unique_customers,
               COUNT(DISTINCT CASE WHEN is_loyalty THEN user_id END) AS loyalty_customers,
               MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date,
               COUNT(DISTINCT order_date) AS active_days, COUNT(DISTINCT item_category) AS unique_categories,
               COUNT(DISTINCT item_name) AS unique_items
        FROM items GROUP BY restaurant_id""",
    "location_rates": f"""
        SELECT *, {half_up(cents("total_gross_revenue"), "total_orders * 100", 2, "DECIMAL(16,2)")} AS avg_order_value,
               {half_up(cents("total_gross_revenue"), "active_days * 100", 2, "DECIMAL(16,2)")} AS avg_daily_revenue,
               {half_up("loyalty_customers * 100", "unique_customers", 2, "DECIMAL(5,2)")} AS loyalty_rate,
               {half_up("total_line_items", "total_orders", 2, "DECIMAL(5,2)")} AS items_per_order
        FROM location""",
    "gold_location": """
        SELECT *, CASE WHEN revenue_rank <= 10 THEN 'TOP_10' WHEN revenue_rank <= 25 THEN 'TOP_25'
                       WHEN revenue_rank <= 50 THEN 'TOP_50' ELSE 'STANDARD' END AS performance_tier
        FROM (SELECT *, CAST(rank() OVER (ORDER BY total_gross_revenue DESC NULLS LAST) AS INTEGER) AS revenue_rank,
                     CAST(rank() OVER (ORDER BY total_orders DESC) AS INTEGER) AS orders_rank,
                     CAST(rank() OVER (ORDER BY avg_order_value DESC NULLS LAST) AS INTEGER) AS aov_rank
              FROM location_rates) x""",
    "location_months": f"""
        SELECT restaurant_id, year, month, {total("revenue")} AS monthly_revenue,
               COUNT(DISTINCT order_id) AS monthly_orders, COUNT(DISTINCT user_id) AS monthly_unique_customers,
               {avg_money("revenue", "DECIMAL(10,2)")} AS avg_item_revenue
        FROM items GROUP BY restaurant_id, year, month""",
    "gold_location_monthly": f"""
        SELECT *, {growth("monthly_revenue", "prev_month_revenue")} AS mom_revenue_growth_pct
        FROM (SELECT *, lag(monthly_revenue) OVER (PARTITION BY restaurant_id
                         ORDER BY year NULLS FIRST, month NULLS FIRST) AS prev_month_revenue
              FROM location_months) x""",
    "gold_top_items": f"""
        SELECT * FROM (
            SELECT *, CAST(rank() OVER (PARTITION BY restaurant_id ORDER BY item_revenue DESC NULLS LAST) AS INTEGER)
                       AS item_rank_in_restaurant
            FROM (SELECT restaurant_id, item_name, item_category, {total("revenue")} AS item_revenue,
                         CAST(SUM(item_quantity) AS BIGINT) AS total_quantity_sold,
                         COUNT(DISTINCT order_id) AS orders_containing_item
                  FROM items GROUP BY restaurant_id, item_name, item_category) x) y
        WHERE item_rank_in_restaurant <= 10""",
    "profiles": f"""
        SELECT *, {half_up(cents("total_net_revenue"), "total_orders * 100", 2, "DECIMAL(16,2)")} AS avg_order_value
        FROM (SELECT user_id, is_loyalty, COUNT(DISTINCT order_id) AS total_orders,
                     {total("net_revenue")} AS total_net_revenue,
                     date_diff('day', MIN(order_date), MAX(order_date)) AS days_as_customer,
                     date_diff('day', MAX(order_date), (SELECT MAX(order_date) FROM items)) AS days_since_last_order,
                     COUNT(DISTINCT restaurant_id) AS unique_restaurants,
                     COUNT(DISTINCT item_category) AS unique_categories
              FROM priced WHERE eligible_for_customer_metrics GROUP BY user_id, is_loyalty) x""",
    "gold_loyalty": f"""
        SELECT is_loyalty, COUNT(user_id) AS total_customers,
               {avg_money("total_net_revenue", "DECIMAL(16,2)")} AS avg_clv,
               {mean_count("total_orders", 1)} AS avg_orders,
               {avg_money("avg_order_value", "DECIMAL(16,2)")} AS avg_order_value,
               {mean_count("days_as_customer", 0)} AS avg_customer_lifespan_days,
               {mean_count("days_since_last_order", 0)} AS avg_days_since_last_order,
               {mean_count("unique_restaurants", 1)} AS avg_restaurants_visited,
               {mean_count("unique_categories", 1)} AS avg_categories_purchased,
               {total("total_net_revenue")} AS total_revenue_contribution,
               quantile_disc(total_net_revenue, 0.5) AS median_clv,
               quantile_disc(total_orders, 0.5) AS median_orders, {LABEL} AS loyalty_label
        FROM profiles GROUP BY is_loyalty""",
    "gold_loyalty_category": f"""
        SELECT item_category, is_loyalty, {total("net_revenue")} AS total_revenue,
               COUNT(DISTINCT order_id) AS total_orders, COUNT(DISTINCT user_id) AS unique_customers,
               {avg_money("net_revenue", "DECIMAL(16,2)")} AS avg_item_revenue, {LABEL} AS loyalty_label
        FROM priced WHERE item_category IS NOT NULL GROUP BY item_category, is_loyalty""",
    "gold_loyalty_monthly": f"""
        SELECT year, month, is_loyalty, COUNT(DISTINCT order_id) AS total_orders,
               {total("net_revenue")} AS total_revenue, COUNT(DISTINCT user_id) AS unique_customers,
               {LABEL} AS loyalty_label
        FROM priced GROUP BY year, month, is_loyalty""",
    "order_flags": "SELECT order_id, bool_or(has_discount) AS order_has_discount FROM priced GROUP BY order_id",
    "order_values": f"""
        SELECT order_id, order_has_discount, restaurant_id, order_date, {total("revenue")} AS order_gross,
               {total("net_revenue")} AS order_net, {total("total_discount_amount")} AS order_discount,
               COUNT(lineitem_id) AS items_in_order, MIN(user_id) AS user_id
        FROM priced JOIN order_flags USING (order_id)
        GROUP BY order_id, order_has_discount, restaurant_id, order_date""",
    "gold_discount_orders": f"""
        SELECT order_has_discount, COUNT(order_id) AS total_orders,
               {avg_money("order_gross", "DECIMAL(16,2)")} AS avg_gross_order_value,
               {avg_money("order_net", "DECIMAL(16,2)")} AS avg_net_order_value,
               {mean_count("items_in_order", 2)} AS avg_items_per_order,
               {avg_money("order_discount", "DECIMAL(16,2)")} AS avg_discount_amount,
               {total("order_gross")} AS total_gross_revenue, {total("order_net")} AS total_net_revenue,
               COUNT(DISTINCT user_id) AS unique_customers,
               CASE WHEN order_has_discount THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END AS discount_order_rate_pct,
               CASE WHEN order_has_discount THEN 'Discounted' ELSE 'Non-Discounted' END AS discount_label
        FROM order_values GROUP BY order_has_discount""",
    "depths": f"""
        SELECT *, CASE WHEN revenue > 0 THEN
                   {half_up(f"abs({cents('total_discount_amount')}) * 100", cents("revenue"), 2, "DECIMAL(6,2)")}
                   ELSE 0 END AS discount_depth_pct
        FROM priced""",
    "gold_discount_category": f"""
        SELECT item_category, has_discount, COUNT(lineitem_id) AS total_line_items,
               {total("revenue")} AS total_gross_revenue, {total("net_revenue")} AS total_net_revenue,
               {avg_money("revenue", "DECIMAL(16,2)")} AS avg_item_price,
               {avg_money("discount_depth_pct", "DECIMAL(16,2)")} AS avg_discount_depth_pct,
               {total("abs(total_discount_amount)")} AS total_discount_given,
               COUNT(DISTINCT order_id) AS total_orders,
               CASE WHEN has_discount THEN 'Discounted' ELSE 'Non-Discounted' END AS discount_label
        FROM depths WHERE item_category IS NOT NULL GROUP BY item_category, has_discount""",
    "discount_users": f"""
        SELECT user_id, COUNT(DISTINCT order_id) AS total_orders,
               COUNT(DISTINCT CASE WHEN order_has_discount THEN order_id END) AS discounted_orders,
               {total("revenue")} AS total_gross_spend, {total("net_revenue")} AS total_net_spend,
               {total("abs(total_discount_amount)")} AS total_discounts_received,
               bool_or(is_loyalty) AS is_loyalty_member
        FROM priced JOIN order_flags USING (order_id) WHERE eligible_for_customer_metrics GROUP BY user_id""",
    "gold_discount_customer": f"""
        SELECT *, CASE WHEN discount_usage_rate >= 75 THEN 'HEAVY_DISCOUNT_USER'
                       WHEN discount_usage_rate >= 25 THEN 'MODERATE_DISCOUNT_USER'
                       WHEN discount_usage_rate > 0 THEN 'OCCASIONAL_DISCOUNT_USER'
                       ELSE 'NON_DISCOUNT_USER' END AS discount_seeker_segment
        FROM (SELECT *, {half_up("discounted_orders * 100", "total_orders", 2, "DECIMAL(5,2)")}
                         AS discount_usage_rate FROM discount_users) x""",
    "loyalty_top": """
        SELECT item_category, is_loyalty, loyalty_label, total_revenue, total_orders, unique_customers
        FROM gold_loyalty_category ORDER BY total_revenue DESC NULLS LAST, item_category, is_loyalty NULLS FIRST
        LIMIT 30""",
    "discount_top": f"""
        {DISCOUNT_ROWS} FROM gold_discount_category
        ORDER BY total_gross_revenue DESC NULLS LAST, item_category, has_discount LIMIT 30""",
}


def one_digit(column: str, kind: str) -> str:
    """A two-digit decimal rounded half up to one digit."""
    return half_up(cents(column), "100", 1, kind)


def null_counts(table: str, columns: str) -> str:
    rows = (
        f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_count, COUNT(*) AS total_rows FROM {table}"
        for c in columns.split()
    )
    return " UNION ALL ".join(rows)


ITEM_COLUMNS = """order_id lineitem_id user_id printed_card_number restaurant_id app_name item_name item_category
    item_price item_quantity revenue currency is_loyalty creation_time_utc order_date dq_flag
    eligible_for_customer_metrics"""
OPTION_COLUMNS = "order_id lineitem_id option_group_name option_name option_price option_quantity is_discount dq_flag"
REJECT_ITEM = """order_id, lineitem_id, user_id, printed_card_number, restaurant_id, app_name, item_name, item_category,
    item_price, item_quantity, currency, is_loyalty, creation_time_utc, ingestion_ts, order_date, revenue, dq_flag"""
REJECT_OPTION = """order_id, lineitem_id, option_group_name, option_name, option_price, option_quantity, ingestion_ts,
    is_discount, dq_flag"""


def _stamped(table: str) -> str:
    return f"SELECT *, '2001-12-31' AS snapshot_date FROM {table}"


CTES["raw_corrections"] = """
        SELECT * REPLACE (
            CASE WHEN item_quantity > 40 THEN CAST(item_price + 1 AS DECIMAL(10,2)) ELSE item_price END AS item_price,
            CASE WHEN item_quantity > 40 THEN creation_time_utc + INTERVAL 3 DAY ELSE creation_time_utc END AS creation_time_utc)
        FROM raw_items"""
CTES["typed_corrections"] = CTES["typed_items"].replace("FROM raw_items", "FROM raw_corrections")
CTES["corrected_items"] = CTES["items"].replace("FROM typed_items", "FROM typed_corrections")

CTES["items_now"] = """SELECT * FROM corrected_items UNION ALL
        SELECT i.* FROM items i ANTI JOIN corrected_items c USING (lineitem_id)"""
CTES["priced_now"] = CTES["priced"].replace("FROM items", "FROM items_now")
CTES["facts_now"] = f"""
        SELECT order_id, user_id, restaurant_id, order_date, is_loyalty, COUNT(lineitem_id) AS line_items,
               {total("revenue")} AS gross, COUNT(revenue) AS gross_lines, {total("net_revenue")} AS net,
               COUNT(net_revenue) AS net_lines, {total("total_discount_amount")} AS discount,
               {total("abs(total_discount_amount)")} AS discount_given, bool_or(has_discount) AS has_discount
        FROM priced_now GROUP BY order_id, user_id, restaurant_id, order_date, is_loyalty"""

QUERIES = {
    "order_facts_after_correction": """SELECT *, bool_or(has_discount) OVER (PARTITION BY order_id) AS order_has_discount
        FROM facts_now""",
    "silver_after_correction": """SELECT * FROM corrected_items UNION ALL
        SELECT i.* FROM items i ANTI JOIN corrected_items c USING (lineitem_id)""",
    "silver_order_items": "SELECT * FROM items",
    "silver_order_item_options": "SELECT * FROM options",
    "silver_date_dim": "SELECT * FROM calendar",
    "dlq_order_items": f"SELECT {REJECT_ITEM} FROM typed_items WHERE dq_flag IN ('NULL_LINEITEM_ID', 'NULL_ORDER_ID')",
    "dlq_order_item_options": f"""SELECT {REJECT_OPTION} FROM typed_options
        WHERE dq_flag IN ('NULL_ORDER_ID', 'NULL_LINEITEM_ID', 'NULL_OPTION_NAME')""",
    "dq_profile": null_counts("items", ITEM_COLUMNS),
    "dq_profile_options": null_counts("options", OPTION_COLUMNS),
    "dq_flag_distribution": 'SELECT dq_flag, COUNT(*) AS "rows" FROM items GROUP BY dq_flag',
    "dq_flag_distribution_options": 'SELECT dq_flag, COUNT(*) AS "rows" FROM options GROUP BY dq_flag',
    "incremental_batch": f"""SELECT order_id, lineitem_id, user_id, printed_card_number, restaurant_id, app_name,
        item_name, item_category, item_price, item_quantity, currency, is_loyalty, creation_time_utc,
        CAST(year(creation_time_utc) AS INTEGER) AS year, CAST(month(creation_time_utc) AS INTEGER) AS month,
        CAST(day(creation_time_utc) AS INTEGER) AS day
        FROM raw_items WHERE creation_time_utc > {MARK}""",
    "incremental_mark": f"""SELECT COUNT(*) AS "rows", MAX(creation_time_utc) AS mark
        FROM raw_items WHERE creation_time_utc > {MARK}""",
    "option_totals": "SELECT * FROM option_sums",
    "gold_clv": _stamped("gold_clv"),
    "gold_rfm": _stamped("gold_rfm"),
    "gold_churn_indicators": _stamped("gold_churn"),
    "gold_sales_daily": _stamped("gold_daily"),
    "gold_sales_weekly": _stamped("gold_weekly"),
    "gold_sales_monthly": _stamped("gold_monthly"),
    "gold_location_performance": _stamped("gold_location"),
    "gold_location_monthly": _stamped("gold_location_monthly"),
    "gold_location_top_items": _stamped("gold_top_items"),
    "gold_loyalty_summary": _stamped("gold_loyalty"),
    "gold_loyalty_by_category": _stamped("gold_loyalty_category"),
    "gold_loyalty_monthly": _stamped("gold_loyalty_monthly"),
    "gold_discount_order_summary": _stamped("gold_discount_orders"),
    "gold_discount_by_category": _stamped("gold_discount_category"),
    "gold_discount_customer": _stamped("gold_discount_customer"),
    "report_distinct_customers": "SELECT COUNT(DISTINCT user_id) AS val FROM clv",
    "report_total_net_revenue": f"""SELECT TRY_CAST((CAST(CAST(SUM(total_net_revenue) AS DECIMAL(28,2)) * 100 AS HUGEINT)
        + 50) // 100 AS DECIMAL(22,0)) AS val FROM clv""",
    "report_clv_band_overview": f"""SELECT clv_band, {CUSTOMERS}, {mean_money("total_net_revenue")} AS avg_revenue
        FROM gold_clv GROUP BY clv_band""",
    "report_rfm_segment_counts": f"SELECT segment, {CUSTOMERS} FROM gold_rfm GROUP BY segment",
    "report_risk_tag_counts": f"SELECT overall_risk_tag, {CUSTOMERS} FROM gold_churn GROUP BY overall_risk_tag",
    "report_clv_bands": f"""SELECT clv_band, {CUSTOMERS}, {mean_money("total_net_revenue")} AS avg_revenue,
        {mean_count("total_orders", 1)} AS avg_orders, {mean_count("days_as_customer", 0)} AS avg_lifespan_days
        FROM gold_clv GROUP BY clv_band""",
    "report_top_customers": """SELECT user_id, total_net_revenue, total_orders, clv_band,
        is_loyalty_member AS is_loyalty, days_since_last_order, unique_restaurants_visited AS restaurants_visited
        FROM gold_clv ORDER BY total_net_revenue DESC NULLS LAST, user_id LIMIT 20""",
    "report_rfm_segments": f"""SELECT segment, {CUSTOMERS}, {mean_money("monetary")} AS avg_spend,
        {mean_count("frequency", 1)} AS avg_orders, {mean_count("recency_days", 0)} AS avg_recency_days
        FROM gold_rfm GROUP BY segment""",
    "report_loyalty_clv": f"""SELECT is_loyalty_member AS is_loyalty, {CUSTOMERS},
        {mean_money("total_net_revenue")} AS avg_clv, {mean_count("total_orders", 1)} AS avg_orders,
        CASE WHEN is_loyalty_member THEN 'Loyalty Member' WHEN NOT is_loyalty_member THEN 'Non-Loyalty' END AS label
        FROM clv GROUP BY is_loyalty_member""",
    "report_risk_tags": f"""SELECT overall_risk_tag, {CUSTOMERS},
        {mean_count("days_since_last_order", 0)} AS avg_days_inactive, {mean_money("total_revenue")} AS avg_revenue
        FROM gold_churn GROUP BY overall_risk_tag""",
    "report_spend_trends": f"""SELECT spend_trend, {CUSTOMERS},
        {mean_money("pct_spend_change_p1_vs_p2", 1)} AS avg_pct_change
        FROM gold_churn WHERE pct_spend_change_p1_vs_p2 IS NOT NULL GROUP BY spend_trend""",
    "report_risk_levels": f"""SELECT churn_risk_level, {CUSTOMERS}, {mean_count("days_since_last_order", 0)} AS avg_days
        FROM gold_churn GROUP BY churn_risk_level""",
    "report_at_risk_customers": """SELECT user_id, days_since_last_order AS days_inactive, total_revenue,
        churn_risk_level, spend_trend, overall_risk_tag, total_orders, avg_days_between_orders AS avg_gap_days
        FROM gold_churn WHERE overall_risk_tag IN ('AT_RISK', 'CHURNED') AND total_revenue > 50
        ORDER BY total_revenue DESC NULLS LAST, user_id LIMIT 25""",
    "report_monthly_sales": f"""SELECT year, month, {total("gross_revenue")} AS total_revenue,
        CAST(SUM(total_orders) AS BIGINT) AS total_orders, CAST(SUM(unique_customers) AS BIGINT) AS unique_customers,
        {PERIOD} FROM gold_monthly GROUP BY year, month""",
    "report_day_of_week_sales": f"""SELECT day_of_week, {total("gross_revenue")} AS total_revenue,
        CAST(SUM(total_orders) AS BIGINT) AS total_orders, {mean_money("avg_order_value")} AS avg_order_value
        FROM gold_daily WHERE day_of_week IS NOT NULL GROUP BY day_of_week""",
    "report_holiday_sales": f"""SELECT is_holiday, COUNT(*) AS days, {total("gross_revenue")} AS total_revenue,
        {mean_money("gross_revenue")} AS avg_daily_revenue, CAST(SUM(total_orders) AS BIGINT) AS total_orders,
        CASE WHEN is_holiday THEN 'Holiday' WHEN NOT is_holiday THEN 'Regular Day' END AS label
        FROM gold_daily GROUP BY is_holiday""",
    "report_top_days": f"""SELECT order_date, restaurant_id, is_holiday, day_of_week, {total("gross_revenue")} AS revenue,
        CAST(SUM(total_orders) AS BIGINT) AS orders FROM gold_daily
        GROUP BY order_date, restaurant_id, is_holiday, day_of_week
        ORDER BY revenue DESC NULLS LAST, order_date NULLS FIRST, restaurant_id LIMIT 10""",
    "report_tier_summary": f"""SELECT performance_tier, COUNT(*) AS restaurants,
        {mean_money("total_gross_revenue")} AS avg_revenue, {mean_money("avg_order_value")} AS avg_order_value
        FROM gold_location GROUP BY performance_tier""",
    "report_top_restaurants": f"""SELECT restaurant_id, total_gross_revenue AS total_revenue, total_orders,
        unique_customers, avg_order_value, {one_digit("loyalty_rate", "DECIMAL(5,1)")} AS loyalty_rate_pct,
        performance_tier, revenue_rank AS rank FROM gold_location ORDER BY revenue_rank, restaurant_id LIMIT 20""",
    "report_bottom_restaurants": """SELECT restaurant_id, total_gross_revenue AS total_revenue, total_orders,
        unique_customers, revenue_rank AS rank FROM gold_location
        ORDER BY total_gross_revenue NULLS LAST, restaurant_id LIMIT 10""",
    "report_top_restaurants_chart": f"""SELECT restaurant_id, total_gross_revenue AS total_revenue, total_orders,
        unique_customers, avg_order_value, {one_digit("loyalty_rate", "DECIMAL(5,1)")} AS loyalty_rate_pct,
        performance_tier, revenue_rank AS rank FROM gold_location ORDER BY revenue_rank, restaurant_id LIMIT 10""",
    "report_top_restaurant_growth": f"""SELECT restaurant_id, year, month, monthly_revenue,
        {one_digit("mom_revenue_growth_pct", "DECIMAL(8,1)")} AS mom_growth_pct
        FROM gold_location_monthly WHERE mom_revenue_growth_pct IS NOT NULL AND restaurant_id IN
        (SELECT restaurant_id FROM gold_location ORDER BY revenue_rank, restaurant_id LIMIT 5)""",
    "report_loyalty_overview": """SELECT loyalty_label, total_customers, avg_clv, avg_orders, avg_order_value,
        avg_days_since_last_order AS avg_days_inactive, total_revenue_contribution AS total_revenue, median_orders
        FROM gold_loyalty""",
    "report_loyalty_categories": """SELECT item_category, loyalty_label, total_revenue, total_orders, unique_customers
        FROM loyalty_top""",
    "report_leading_loyalty_categories": """SELECT item_category, loyalty_label, total_revenue, total_orders,
        unique_customers FROM gold_loyalty_category WHERE item_category IN (SELECT item_category
        FROM gold_loyalty_category WHERE item_category IS NOT NULL GROUP BY item_category ORDER BY SUM(total_revenue) DESC NULLS LAST, item_category LIMIT 8)""",
    "report_loyalty_trend": f"""SELECT year, month, loyalty_label, total_revenue, total_orders, unique_customers,
        {PERIOD} FROM gold_loyalty_monthly""",
    "report_discount_overview": """SELECT discount_label, total_orders, avg_gross_order_value, avg_net_order_value,
        avg_items_per_order, avg_discount_amount, unique_customers FROM gold_discount_orders""",
    "report_discount_categories": "SELECT * FROM discount_top",
    "report_most_discounted_categories": f"""{DISCOUNT_ROWS}
        FROM gold_discount_category WHERE has_discount AND item_category IS NOT NULL
        ORDER BY total_discount_given DESC NULLS LAST, item_category LIMIT 10""",
    "report_discount_segments": f"""SELECT discount_seeker_segment, {CUSTOMERS},
        {mean_money("total_net_spend")} AS avg_spend, {mean_money("discount_usage_rate", 1)} AS avg_discount_rate,
        {mean_money("total_discounts_received")} AS avg_discounts_received
        FROM gold_discount_customer GROUP BY discount_seeker_segment""",
    "report_clv_band_range": f"""SELECT clv_band, {CUSTOMERS},
        {avg_money("total_net_revenue", "DECIMAL(16,2)")} AS avg_net_revenue,
        MIN(total_net_revenue) AS min_revenue, MAX(total_net_revenue) AS max_revenue
        FROM gold_clv GROUP BY clv_band""",
    "report_churn_risk_count": "SELECT COUNT(*) FILTER (WHERE is_churn_risk) AS churn_risk_customers FROM gold_clv",
    "report_rf_grid": f"SELECT r_score, f_score, {CUSTOMERS} FROM gold_rfm GROUP BY r_score, f_score",
    "report_risk_level_revenue": f"""SELECT churn_risk_level, {CUSTOMERS},
        {mean_count("days_since_last_order", 0)} AS avg_days_inactive,
        {mean_money("total_revenue")} AS avg_lifetime_revenue FROM gold_churn GROUP BY churn_risk_level""",
    "report_spend_trend_counts": f"SELECT spend_trend, {CUSTOMERS} FROM gold_churn GROUP BY spend_trend",
    "report_monthly_totals": f"""SELECT year, month, {total("gross_revenue")} AS total_revenue FROM gold_monthly
        GROUP BY year, month""",
    "report_top_discount_categories": """SELECT item_category, total_discount_given, avg_discount_depth_pct, total_orders
        FROM gold_discount_category WHERE has_discount
        ORDER BY total_discount_given DESC NULLS LAST, item_category LIMIT 5""",
    "report_overview_kpis": f"""SELECT COUNT(DISTINCT user_id) AS total_customers,
        TRY_CAST((CAST(CAST(SUM(total_net_revenue) AS DECIMAL(28,2)) * 100 AS HUGEINT) + 50) // 100 AS DECIMAL(22,0))
            AS total_net_revenue,
        COUNT(*) FILTER (WHERE clv_band = 'HIGH') AS high_clv_customers,
        (SELECT COUNT(*) FROM gold_churn WHERE overall_risk_tag = 'CHURNED') AS churned_customers FROM gold_clv""",
    "report_customer_kpis": """SELECT COUNT(*) FILTER (WHERE clv_band = 'HIGH') AS high_customers,
        COUNT(*) FILTER (WHERE clv_band = 'MEDIUM') AS medium_customers,
        COUNT(*) FILTER (WHERE clv_band = 'LOW') AS low_customers, COUNT(*) AS total_customers,
        """
    + ", ".join(
        mean_money(f"CASE WHEN clv_band = '{band}' THEN total_net_revenue END") + f" AS {band.lower()}_avg_revenue"
        for band in ("HIGH", "MEDIUM", "LOW")
    )
    + " FROM gold_clv",
    "report_churn_kpis": f"""SELECT t.tag AS overall_risk_tag, COUNT(g.user_id) AS customers,
        {mean_money("g.total_revenue")} AS avg_revenue
        FROM (VALUES ('ACTIVE'), ('MONITOR'), ('AT_RISK'), ('CHURNED')) t(tag)
        LEFT JOIN gold_churn g ON g.overall_risk_tag = t.tag GROUP BY t.tag""",
    "report_sales_kpis": f"""SELECT {total("gross_revenue")} AS total_revenue,
        CAST(SUM(total_orders) AS BIGINT) AS total_orders,
        (SELECT COUNT(*) FROM (SELECT DISTINCT year, month FROM gold_monthly) x) AS months FROM gold_monthly""",
    "report_location_kpis": f"""SELECT COUNT(*) AS total_restaurants,
        {mean_money("CASE WHEN performance_tier = 'TOP_10' THEN total_gross_revenue END")} AS top_10_avg_revenue,
        {mean_money("CASE WHEN performance_tier = 'STANDARD' THEN total_gross_revenue END")} AS standard_avg_revenue
        FROM gold_location""",
    "report_loyalty_kpis": """SELECT MAX(CASE WHEN is_loyalty THEN total_customers END) AS loyalty_members,
        MAX(CASE WHEN NOT is_loyalty THEN total_customers END) AS non_loyalty_customers,
        MAX(CASE WHEN is_loyalty THEN avg_clv END) AS loyalty_avg_clv,
        MAX(CASE WHEN NOT is_loyalty THEN avg_clv END) AS non_loyalty_avg_clv FROM gold_loyalty""",
    "report_discount_kpis": """SELECT MAX(CASE WHEN order_has_discount THEN total_orders END) AS discounted_orders,
        MAX(CASE WHEN NOT order_has_discount THEN total_orders END) AS non_discounted_orders,
        MAX(CASE WHEN order_has_discount THEN avg_discount_amount END) AS avg_discount_amount,
        MAX(CASE WHEN order_has_discount THEN avg_items_per_order END) AS avg_items_discounted
        FROM gold_discount_orders""",
}


def sql(name: str) -> str:
    """The query with the building blocks it needs, in definition order."""
    query = QUERIES[name]
    needed: set[str] = set()
    pending = [query]
    while pending:
        text = pending.pop()
        for cte in CTES:
            if cte not in needed and re.search(rf"(?:FROM|JOIN|,)\s+{cte}\b", text):
                needed.add(cte)
                pending.append(CTES[cte])
    blocks = ", ".join(f"{cte} AS ({body})" for cte, body in CTES.items() if cte in needed)
    return f"WITH {blocks} {query}" if blocks else query
