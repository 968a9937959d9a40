"""Ordered label rules: the first predicate that holds gives the label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Rules = Sequence[tuple[str, str]]


def first_match(rules: Rules, otherwise: str) -> Column:
    """CASE over (label, predicate) pairs in order; a NULL predicate does not match."""
    cases = F
    for label, predicate in rules:
        cases = cases.when(F.expr(predicate), F.lit(label))
    return cases.otherwise(F.lit(otherwise))


# Labels and limits of the business rules, first match wins.
CLV_BANDS = (
    ("HIGH", "revenue_percentile >= 0.80"),
    ("MEDIUM", "revenue_percentile >= 0.20"),
)
CLV_BAND_OTHERWISE = "LOW"

RFM_SEGMENTS = (
    ("VIP", "r_score >= 4 AND f_score >= 4 AND m_score >= 4"),
    ("Loyal Customers", "r_score >= 3 AND f_score >= 3"),
    ("New Customers", "r_score >= 4 AND f_score <= 2"),
    ("Promising", "r_score >= 3 AND f_score <= 2"),
    # Shadowed by "Loyal Customers"; kept so the rule list stays complete.
    ("Need Attention", "r_score = 3 AND f_score = 3"),
    ("At Risk", "r_score <= 2 AND f_score >= 4"),
    ("Hibernating", "r_score <= 2 AND f_score >= 2"),
    ("Lost", "r_score = 1 AND f_score = 1"),
)
RFM_SEGMENT_OTHERWISE = "Others"

CHURN_RISK_LEVELS = (
    ("CRITICAL", "days_since_last_order > 180"),
    ("HIGH", "days_since_last_order > 90"),
    ("MEDIUM", "days_since_last_order > 45"),
)
CHURN_RISK_LEVEL_OTHERWISE = "LOW"

SPEND_TRENDS = (
    ("INSUFFICIENT_DATA", "pct_spend_change_p1_vs_p2 IS NULL"),
    ("GROWING", "pct_spend_change_p1_vs_p2 >= 20"),
    ("STABLE", "pct_spend_change_p1_vs_p2 >= -10"),
    ("DECLINING", "pct_spend_change_p1_vs_p2 >= -50"),
)
SPEND_TREND_OTHERWISE = "SEVERELY_DECLINING"

OVERALL_RISK_TAGS = (
    ("CHURNED", "churn_risk_level = 'CRITICAL' AND spend_trend IN ('DECLINING', 'SEVERELY_DECLINING')"),
    ("CHURNED", "churn_risk_level IN ('HIGH', 'CRITICAL') AND spend_trend = 'SEVERELY_DECLINING'"),
    ("AT_RISK", "churn_risk_level IN ('HIGH', 'CRITICAL')"),
    ("AT_RISK", "churn_risk_level = 'MEDIUM' AND spend_trend IN ('DECLINING', 'SEVERELY_DECLINING')"),
    ("ACTIVE", "churn_risk_level = 'LOW'"),
)
OVERALL_RISK_TAG_OTHERWISE = "MONITOR"

SPEND_PERIODS = (
    ("P1_last_90d", "days_before_reference <= 90"),
    ("P2_91_180d", "days_before_reference <= 180"),
    ("P3_181_270d", "days_before_reference <= 270"),
)
SPEND_PERIOD_OTHERWISE = "P4_older"

PERFORMANCE_TIERS = (
    ("TOP_10", "revenue_rank <= 10"),
    ("TOP_25", "revenue_rank <= 25"),
    ("TOP_50", "revenue_rank <= 50"),
)
PERFORMANCE_TIER_OTHERWISE = "STANDARD"

DISCOUNT_SEEKERS = (
    ("HEAVY_DISCOUNT_USER", "discount_usage_rate >= 75"),
    ("MODERATE_DISCOUNT_USER", "discount_usage_rate >= 25"),
    ("OCCASIONAL_DISCOUNT_USER", "discount_usage_rate > 0"),
)
DISCOUNT_SEEKER_OTHERWISE = "NON_DISCOUNT_USER"

CHURN_RISK_DAYS = 45


def loyalty_label(flag: Column) -> Column:
    """A NULL flag takes the "Non-" label."""
    return F.when(flag, F.lit("Loyalty Member")).otherwise(F.lit("Non-Loyalty"))


def discount_label(flag: Column) -> Column:
    return F.when(flag, F.lit("Discounted")).otherwise(F.lit("Non-Discounted"))
