"""Recency, frequency and monetary quintiles and the segment they lead to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.context import cut_lineage
from orderloom.functions.numbers import total
from orderloom.functions.rules import (
    CHURN_RISK_DAYS,
    RFM_SEGMENT_OTHERWISE,
    RFM_SEGMENTS,
    first_match,
)
from orderloom.operators.order_facts import customers_only
from orderloom.operators.ranking import By, global_ntile
from orderloom.schemas import GOLD_BUSINESS, conform

SCORES = {
    "r_score": By("recency_days", descending=True),
    "f_score": By("frequency"),
    "m_score": By("monetary"),
}


def rfm(facts: DataFrame) -> DataFrame:
    """Score 5 is best in each dimension; equal values are ordered by customer id."""
    per_customer = (
        customers_only(facts)
        .groupBy("user_id")
        .agg(
            F.count_distinct("order_id").alias("frequency"),
            total(F.col("gross")).alias("monetary"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
            F.count_distinct("order_date").alias("active_days"),
            F.bool_or("is_loyalty").alias("is_loyalty_member"),
        )
    )
    customers = cut_lineage(per_customer)
    dated = customers.withColumn("reference", customers.agg(F.max("last_order_date")).scalar()).withColumn(
        "recency_days", F.datediff("reference", "last_order_date")
    )
    scored = global_ntile(dated, 5, SCORES, tie_break="user_id").withColumn(
        "rfm_score", F.col("r_score") + F.col("f_score") + F.col("m_score")
    )
    segmented = scored.withColumns(
        {
            "segment": first_match(RFM_SEGMENTS, RFM_SEGMENT_OTHERWISE),
            "is_churn_risk": F.coalesce(F.col("recency_days") > CHURN_RISK_DAYS, F.lit(False)),
            "reference_date": F.col("reference").cast("string"),
        }
    )
    return conform(segmented, GOLD_BUSINESS["rfm"])
