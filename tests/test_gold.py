"""Business rules and edge cases of the Gold plans on literal rows."""

from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderloom.functions import numbers, rules
from orderloom.operators.order_facts import order_facts, priced_items, with_order_discount
from orderloom.plans import churn, clv, discount, location, loyalty, rfm, sales
from orderloom.schemas import SILVER, SchemaMismatch, conform, struct

DAY0 = datetime.date(2024, 1, 1)


def day(offset: int | None) -> datetime.date | None:
    return None if offset is None else DAY0 + datetime.timedelta(days=offset)


def lines(spark, *rows):
    """Silver items from (order, line, user, restaurant, day offset, price, loyalty[, item, category])."""
    fields = [
        (
            order,
            line,
            user,
            place,
            (rest[0] if rest else "soup"),
            (rest[1] if len(rest) > 1 else "food"),
            1,
            None if price is None else Decimal(price),
            loyal,
            day(offset),
            user is not None,
        )
        for order, line, user, place, offset, price, loyal, *rest in rows
    ]
    return spark.createDataFrame(
        fields,
        """order_id bigint, lineitem_id bigint, user_id bigint, restaurant_id bigint, item_name string,
        item_category string, item_quantity int, revenue decimal(12,2), is_loyalty boolean,
        order_date date, eligible_for_customer_metrics boolean""",
    )


def options(spark, *rows):
    return spark.createDataFrame(
        [(order, line, None if price is None else Decimal(price), price is not None and price.startswith("-"))
         for order, line, price in rows],
        "order_id bigint, lineitem_id bigint, option_price decimal(10,2), is_discount boolean",
    )


def facts(spark, *rows, opts=()):
    return order_facts(priced_items(lines(spark, *rows), options(spark, *opts)))


def calendar(spark, *rows):
    return spark.createDataFrame(
        [(day(offset), name, week, holiday) for offset, name, week, holiday in rows],
        "date_key date, day_of_week string, week int, is_holiday boolean",
    ).withColumns({"is_weekend": F.lit(False), "holiday_name": F.lit(None).cast("string")})


def labels(spark, rule_list, otherwise, schema, rows):
    df = spark.createDataFrame(rows, schema)
    return [r["label"] for r in df.withColumn("label", rules.first_match(rule_list, otherwise)).collect()]


def test_rfm_segments_cover_all_scores(spark):
    scores = [(r, f, m) for r in range(1, 6) for f in range(1, 6) for m in range(1, 6)]
    found = labels(
        spark, rules.RFM_SEGMENTS, rules.RFM_SEGMENT_OTHERWISE, "r_score int, f_score int, m_score int", scores
    )

    def expected(r, f, m):
        if r >= 3 and f >= 3:
            return "VIP" if r >= 4 and f >= 4 and m >= 4 else "Loyal Customers"
        if r >= 3:
            return "New Customers" if r >= 4 else "Promising"
        return {5: "At Risk", 4: "At Risk", 3: "Hibernating", 2: "Hibernating"}.get(
            f, "Lost" if r == 1 else "Others"
        )

    assert found == [expected(*score) for score in scores]


def test_churn_levels_and_trends_at_their_limits(spark):
    days = [None, 45, 46, 90, 91, 180, 181]
    assert labels(
        spark,
        rules.CHURN_RISK_LEVELS,
        rules.CHURN_RISK_LEVEL_OTHERWISE,
        "days_since_last_order int",
        [(d,) for d in days],
    ) == ["LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "CRITICAL"]
    changes = [None, "20", "19.99", "-10", "-10.01", "-50", "-50.01"]
    assert labels(
        spark,
        rules.SPEND_TRENDS,
        rules.SPEND_TREND_OTHERWISE,
        "pct_spend_change_p1_vs_p2 decimal(8,2)",
        [(c and Decimal(c),) for c in changes],
    ) == ["INSUFFICIENT_DATA", "GROWING", "STABLE", "STABLE", "DECLINING", "DECLINING", "SEVERELY_DECLINING"]


def test_overall_risk_tag(spark):
    trends = ["GROWING", "STABLE", "INSUFFICIENT_DATA", "DECLINING", "SEVERELY_DECLINING"]
    expected = {
        "CRITICAL": ["AT_RISK"] * 3 + ["CHURNED"] * 2,
        "HIGH": ["AT_RISK"] * 4 + ["CHURNED"],
        "MEDIUM": ["MONITOR"] * 3 + ["AT_RISK"] * 2,
        "LOW": ["ACTIVE"] * 5,
    }
    for level, tags in expected.items():
        assert (
            labels(
                spark,
                rules.OVERALL_RISK_TAGS,
                rules.OVERALL_RISK_TAG_OTHERWISE,
                "churn_risk_level string, spend_trend string",
                [(level, trend) for trend in trends],
            )
            == tags
        )


def test_other_limits(spark):
    assert labels(
        spark, rules.CLV_BANDS, rules.CLV_BAND_OTHERWISE, "revenue_percentile double",
        [(0.0,), (0.1999,), (0.2,), (0.7999,), (0.8,), (1.0,)],
    ) == ["LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH"]
    assert labels(
        spark, rules.PERFORMANCE_TIERS, rules.PERFORMANCE_TIER_OTHERWISE, "revenue_rank int",
        [(10,), (11,), (25,), (26,), (50,), (51,)],
    ) == ["TOP_10", "TOP_25", "TOP_25", "TOP_50", "TOP_50", "STANDARD"]
    assert labels(
        spark, rules.DISCOUNT_SEEKERS, rules.DISCOUNT_SEEKER_OTHERWISE, "discount_usage_rate decimal(5,2)",
        [(Decimal(r),) for r in ("75", "74.99", "25", "24.99", "0.01", "0")],
    ) == [
        "HEAVY_DISCOUNT_USER", "MODERATE_DISCOUNT_USER", "MODERATE_DISCOUNT_USER",
        "OCCASIONAL_DISCOUNT_USER", "OCCASIONAL_DISCOUNT_USER", "NON_DISCOUNT_USER",
    ]
    assert labels(
        spark, rules.SPEND_PERIODS, rules.SPEND_PERIOD_OTHERWISE, "days_before_reference int",
        [(0,), (90,), (91,), (180,), (181,), (270,), (271,), (None,)],
    ) == ["P1_last_90d"] * 2 + ["P2_91_180d"] * 2 + ["P3_181_270d"] * 2 + ["P4_older"] * 2


def test_arithmetic_gives_null_not_an_error(spark):
    df = spark.createDataFrame(
        [(Decimal("1.00"), Decimal("0.00"), 0)], "a decimal(12,2), zero decimal(12,2), n bigint"
    )
    row = df.select(
        numbers.ratio(F.col("a"), F.col("n"), "decimal(10,2)"),
        numbers.pct_change(F.col("a"), F.col("zero")),
        numbers.percent(F.col("n"), F.col("n"), "decimal(5,2)"),
        numbers.ratio(F.col("a") * 1000000000, F.lit(1), "decimal(5,2)"),
    ).first()
    assert list(row) == [None] * 4


def test_mean_of_parts_equals_plain_average(spark):
    values = [Decimal(v) for v in ("1.00", "1.01", "0.02", "-5.55", "7.77", "0.05", "0.04")]
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(values)], "g int, v decimal(12,2)")
    parts = df.groupBy("g").agg(F.sum("v").alias("s"), F.count("v").alias("n"))
    rebuilt = parts.agg(numbers.mean_of(F.sum("s"), F.sum("n"), "decimal(10,2)").alias("m"), )
    six = parts.agg(numbers.mean_of(F.sum("s"), F.sum("n"), "decimal(16,6)").alias("m"))
    assert rebuilt.first()["m"] == df.agg(F.avg("v").cast("decimal(10,2)").alias("m")).first()["m"]
    assert six.first()["m"] == df.agg(F.avg("v").alias("m")).first()["m"]


def test_option_join_never_multiplies_lines(spark):
    priced = priced_items(
        lines(spark, (1, 1, 7, 3, 0, "10", True), (1, 2, 7, 3, 0, None, True), (2, 3, 7, 3, 0, "0", False)),
        options(spark, (1, 1, "-1"), (1, 1, "2"), (1, 1, None), (1, 2, "5")),
    )
    rows = {r["lineitem_id"]: r for r in priced.collect()}
    assert len(rows) == 3
    assert (rows[1]["net_revenue"], rows[1]["total_discount_amount"]) == (Decimal("11.00"), Decimal("-1.00"))
    assert rows[1]["discount_depth_pct"] == Decimal("10.00")
    assert rows[2]["net_revenue"] is None and rows[2]["has_discount"] is False
    assert rows[3]["discount_depth_pct"] == Decimal("0.00")


def test_gross_plans_drop_the_option_join(spark):
    plan = sales.sales_daily(
        facts(spark, (1, 1, 7, 3, 0, "10", True)), calendar(spark, (0, "Monday", 1, False))
    )
    assert "option_price" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_facts_add_up_to_the_lines(spark):
    rows = [(o, o * 10 + i, o % 3 or None, o % 2, o, f"{o}.{i}0", o % 2 == 0) for o in range(1, 9) for i in range(3)]
    table = facts(spark, *rows)
    assert table.count() == 8
    assert table.agg(F.sum("gross")).first()[0] == lines(spark, *rows).agg(F.sum("revenue")).first()[0]
    conform(table, SILVER["order_facts"])


def test_empty_input_gives_empty_tables(spark):
    none = facts(spark)
    items = lines(spark)
    priced = priced_items(items, options(spark))
    days = calendar(spark)
    for table in (
        clv.clv(none, F.lit("2024-01-01").cast("date")),
        rfm.rfm(none),
        churn.churn_indicators(none),
        sales.sales_daily(none, days),
        sales.sales_weekly(none, days),
        sales.sales_monthly(none, days),
        location.location_performance(none, items),
        location.location_monthly(none),
        location.location_top_items(items),
        loyalty.loyalty_summary(none, items),
        loyalty.loyalty_by_category(priced),
        loyalty.loyalty_monthly(none),
        discount.discount_order_summary(none),
        discount.discount_by_category(priced),
        discount.discount_customer_behaviour(none),
    ):
        assert table.count() == 0


def test_customer_without_prices_sorts_first(spark):
    table = facts(spark, (1, 1, 7, 3, 0, None, None), (2, 2, 8, 3, 1, "5", True), (3, 3, 9, 3, 60, "6", False))
    bands = {r["user_id"]: r for r in clv.clv(table, F.lit("2024-03-01").cast("date")).collect()}
    assert [bands[u]["revenue_percentile"] for u in (7, 8, 9)] == [0.0, 0.5, 1.0]
    assert [bands[u]["clv_band"] for u in (7, 8, 9)] == ["LOW", "MEDIUM", "HIGH"]
    assert [bands[u]["is_churn_risk"] for u in (7, 8, 9)] == [True, True, False]
    assert bands[7]["total_net_revenue"] is None and bands[7]["days_as_customer"] == 60
    scores = {r["user_id"]: r for r in rfm.rfm(table).collect()}
    assert [scores[u]["m_score"] for u in (7, 8, 9)] == [1, 2, 3]
    assert [scores[u]["r_score"] for u in (7, 8, 9)] == [1, 2, 3]


def test_single_customer(spark):
    row = clv.clv(facts(spark, (1, 1, 7, 3, 0, "5", True)), F.lit("2024-01-11").cast("date")).first()
    assert (row["revenue_percentile"], row["clv_band"]) == (0.0, "LOW")
    assert row["avg_order_frequency_days"] is None and row["days_as_customer"] == 10


def test_undated_orders_are_kept(spark):
    table = facts(spark, (1, 1, 7, 3, None, "5", True), (2, 2, 7, 3, 0, "6", True), (3, 3, 8, 3, None, "1", None))
    rows = {r["user_id"]: r for r in churn.churn_indicators(table).collect()}
    assert rows[7]["total_revenue"] == Decimal("11.00") and rows[7]["spend_last_90d"] == Decimal("6.00")
    assert rows[7]["avg_days_between_orders"] is None
    assert rows[8]["days_since_last_order"] is None and rows[8]["churn_risk_level"] == "LOW"
    daily = sales.sales_daily(table, calendar(spark, (0, "Monday", 1, True))).collect()
    assert {r["order_date"] for r in daily} == {None, DAY0}
    months = {r["month"]: r for r in location.location_monthly(table).collect()}
    assert months[1]["prev_month_revenue"] == Decimal("6.00") and months[None]["prev_month_revenue"] is None


def test_order_gaps(spark):
    table = facts(
        spark,
        *((i, i, 7, 3, d, "1", True) for i, d in enumerate([0, 0, 10, 30])),
        (9, 9, 8, 3, 5, "1", True),
        (10, 10, 9, 3, 5, "1", True),
        (11, 11, 9, 3, 9, "1", True),
    )
    rows = {r["user_id"]: r for r in churn.churn_indicators(table).collect()}
    names = [f"{n}_days_between_orders" for n in ("avg", "min", "max", "stddev")]
    assert [rows[7][n] for n in names] == [Decimal("15.0"), 10, 20, Decimal("7.1")]
    assert [rows[8][n] for n in names] == [None] * 4
    assert [rows[9][n] for n in names] == [Decimal("4.0"), 4, 4, None]


def test_growth_skips_months_without_orders(spark):
    table = facts(spark, (1, 1, 7, 3, 0, "100", True), (2, 2, 7, 3, 95, "150", True), (3, 3, 7, 3, 130, "0", True))
    months = {r["month"]: r for r in location.location_monthly(table).collect()}
    assert months[4]["prev_month_revenue"] == Decimal("100.00")
    assert months[4]["mom_revenue_growth_pct"] == Decimal("50.00")
    assert months[5]["mom_revenue_growth_pct"] == Decimal("-100.00")


def test_top_items_keep_ties_at_the_limit(spark):
    rows = [(i, i, 7, 3, 0, "5" if i >= 9 else str(100 + i), True, f"item{i}") for i in range(11)]
    ranks = [r["item_rank_in_restaurant"] for r in location.location_top_items(lines(spark, *rows)).collect()]
    assert sorted(ranks) == [*range(1, 10), 10, 10]
    more = [*rows, (99, 99, 7, 3, 0, "5", True, "item99"), (98, 98, 7, 3, 0, "4", True, "item98")]
    assert location.location_top_items(lines(spark, *more)).count() == 12


def test_top_items_are_cut_before_the_shuffle(spark):
    plan = location.location_top_items(lines(spark, (1, 1, 7, 3, 0, "5", True)))
    assert plan._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2


def test_locations_with_an_unknown_restaurant(spark):
    rows = [(1, 1, 7, None, 0, "5", True), (2, 2, 7, 4, 0, "9", True), (2, 3, None, 4, 0, "1", False)]
    found = {
        r["restaurant_id"]: r for r in location.location_performance(facts(spark, *rows), lines(spark, *rows)).collect()
    }
    assert (found[4]["revenue_rank"], found[None]["revenue_rank"]) == (1, 2)
    assert found[4]["orders_rank"] == found[None]["orders_rank"] == 1
    assert found[4]["loyalty_rate"] == Decimal("100.00") and found[4]["items_per_order"] == Decimal("2.00")


def test_loyalty_profiles_and_labels(spark):
    rows = [(1, 1, 7, 3, 0, "5", True), (2, 2, 7, 3, 3, "7", False), (3, 3, 7, 3, 4, "8", None)]
    summary = loyalty.loyalty_summary(facts(spark, *rows), lines(spark, *rows)).collect()
    assert sorted(r["loyalty_label"] for r in summary) == ["Loyalty Member", "Non-Loyalty", "Non-Loyalty"]
    assert {r["median_clv"] for r in summary} == {Decimal("5.00"), Decimal("7.00"), Decimal("8.00")}


def test_an_order_is_discounted_if_any_line_is(spark):
    rows = [(1, 1, 7, 3, 0, "5", True), (1, 2, 8, 3, 0, "5", True), (2, 3, 8, 3, 0, "5", True)]
    table = facts(spark, *rows, opts=[(1, 1, "-1")])
    assert {(r["order_id"], r["order_has_discount"]) for r in with_order_discount(table, table).collect()} == {
        (1, True),
        (2, False),
    }
    behaviour = {r["user_id"]: r for r in discount.discount_customer_behaviour(table).collect()}
    assert behaviour[8]["discounted_orders"] == 1 and behaviour[8]["discount_usage_rate"] == Decimal("50.00")
    assert behaviour[8]["total_discounts_received"] == Decimal("0.00")
    summary = {r["discount_label"]: r for r in discount.discount_order_summary(table).collect()}
    assert summary["Discounted"]["discount_order_rate_pct"] == 100.0
    assert summary["Non-Discounted"]["discount_order_rate_pct"] == 0.0
    assert summary["Discounted"]["avg_items_per_order"] == 2.0


def test_daily_revenue_adds_up_to_monthly(spark):
    rows = [(i, i, i % 3, i % 2, i * 3, f"{i}.25", None) for i in range(40)]
    table, days = facts(spark, *rows), calendar(spark, *((i, "Monday", i // 7, i == 3) for i in range(50)))
    daily = sales.sales_daily(table, days)
    monthly = sales.sales_monthly(table, days)
    weekly = sales.sales_weekly(table, days)
    totals = {t.agg(F.sum("gross_revenue")).first()[0] for t in (daily, monthly, weekly)}
    assert len(totals) == 1
    assert monthly.agg(F.sum("holiday_revenue")).first()[0] == Decimal("1.25")


def test_repeated_calendar_rows_do_not_multiply_sales(spark):
    table = facts(spark, (1, 1, 7, 3, 0, "5", True))
    once = [(0, "Monday", 1, True)]
    for plan in (sales.sales_daily, sales.sales_weekly, sales.sales_monthly):
        assert plan(table, calendar(spark, *once * 3)).collect() == plan(table, calendar(spark, *once)).collect()


def test_hot_keys_overflow_nothing(spark):
    big = "9999999999.99"
    rows = [(0, i, 7, 3, 0, big, True) for i in range(300)]
    row = clv.clv(facts(spark, *rows), F.lit("2024-01-01").cast("date")).first()
    assert row["total_gross_revenue"] == Decimal(big) * 300


def test_conform_refuses_a_wrong_type(spark):
    df = spark.createDataFrame([], struct(SILVER["order_facts"])).withColumn("gross", F.lit(1))
    with pytest.raises(SchemaMismatch, match="gross"):
        conform(df, SILVER["order_facts"])


def test_leaders_are_ranked_over_all_categories(spark):
    """Over 30 categories; the largest discount has the smallest revenue."""
    from orderloom.plans import reports

    rows = [
        (f"c{k:02d}", flag, f"{'D' if flag else 'R'}", 1000 - k, 50 + k if flag else 0, 1.0, 3)
        for k in range(40)
        for flag in (True, False)
    ]
    table = spark.createDataFrame(
        rows,
        "item_category string, has_discount boolean, discount_label string, total_gross_revenue int, "
        "total_discount_given int, avg_discount_depth_pct double, total_orders int",
    )
    top = [r["item_category"] for r in reports.most_discounted_categories(table).collect()]
    assert top == [f"c{k:02d}" for k in range(39, 29, -1)]
    loyal = spark.createDataFrame(
        [(f"c{k:02d}", label, 10 * (label == "L") * k + k, 1, 1) for k in range(40) for label in ("L", "N")],
        "item_category string, loyalty_label string, total_revenue int, total_orders int, unique_customers int",
    ).withColumn("total_revenue", F.col("total_revenue").cast("decimal(12,2)"))
    leading = reports.leading_loyalty_categories(loyal).collect()
    assert sorted((r["item_category"], r["loyalty_label"]) for r in leading) == [
        (f"c{k:02d}", label) for k in range(32, 40) for label in ("L", "N")
    ]


def test_inexact_types_are_not_ranked(spark):
    from orderloom.operators.ranking import By, global_rank

    with pytest.raises(ValueError):
        global_rank(spark.sql("SELECT CAST(1.234 AS DECIMAL(10,3)) AS x"), {"r": By("x")})
