"""Silver tables: typed, quality-flagged, deduplicated."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.numbers import LINE_MONEY, PRICE
from orderloom.operators import quality
from orderloom.operators.dedup import latest_per_key

# Records of one load share their ingestion time, so the other columns break ties.
ITEM_NEWEST = ("ingestion_ts",)
ITEM_TIES = (
    *("creation_time_utc", "order_id", "user_id", "restaurant_id", "item_price", "item_quantity"),
    *("is_loyalty", "item_name", "item_category", "app_name", "printed_card_number", "currency"),
)
OPTION_NEWEST = ("ingestion_ts",)
OPTION_TIES = ("order_id", "option_price", "option_quantity")


def _cast(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in kinds.items()})


def typed_order_items(raw: DataFrame) -> DataFrame:
    """Casts that turn malformed values into NULL, plus order date and line revenue."""
    typed = _cast(
        raw,
        {
            "creation_time_utc": "timestamp",
            "item_price": PRICE,
            "item_quantity": "int",
            "is_loyalty": "boolean",
        },
    )
    return typed.withColumns(
        {
            "order_date": F.to_date("creation_time_utc"),
            "revenue": (F.col("item_price") * F.col("item_quantity")).try_cast(LINE_MONEY),
        }
    )


def order_items(raw: DataFrame, ties: Sequence[str] = ITEM_TIES) -> DataFrame:
    """One row per line item, the latest record, with quality flag and eligibility."""
    latest = latest_per_key(
        quality.kept(typed_order_items(raw), quality.ORDER_ITEM_RULES), ["lineitem_id"], ITEM_NEWEST, ties
    )
    return (
        quality.with_flags(latest, quality.ORDER_ITEM_RULES)
        .withColumns(
            {
                "eligible_for_customer_metrics": F.col("user_id").isNotNull(),
                "year": F.year("order_date"),
                "month": F.month("order_date"),
                "day": F.dayofmonth("order_date"),
            }
        )
        .select(
            *("order_id", "lineitem_id", "user_id", "printed_card_number", "restaurant_id"),
            *("app_name", "item_name", "item_category", "item_price", "item_quantity"),
            *("revenue", "currency", "is_loyalty", "creation_time_utc", "order_date"),
            *("dq_flag", "eligible_for_customer_metrics", "year", "month", "day"),
        )
    )


def corrected(current: DataFrame, arriving: DataFrame) -> DataFrame:
    """The current line items, each that arrived again in its new form only, whatever its day was."""
    gone = arriving.select("lineitem_id")
    return current.join(gone, "lineitem_id", "left_anti").unionByName(arriving.select(current.columns))


def rejected_order_items(raw: DataFrame) -> DataFrame:
    return quality.rejected(typed_order_items(raw), quality.ORDER_ITEM_RULES)


def typed_options(raw: DataFrame) -> DataFrame:
    typed = _cast(raw, {"option_price": PRICE, "option_quantity": "int"})
    return typed.withColumn("is_discount", F.coalesce(F.col("option_price") < 0, F.lit(False)))


def order_item_options(raw: DataFrame, ties: Sequence[str] = OPTION_TIES) -> DataFrame:
    """One row per (line item, option group, option), the latest record."""
    latest = latest_per_key(
        quality.kept(typed_options(raw), quality.OPTION_RULES),
        ["lineitem_id", "option_group_name", "option_name"],
        OPTION_NEWEST,
        ties,
    )
    return quality.with_flags(latest, quality.OPTION_RULES).select(
        *("order_id", "lineitem_id", "option_group_name", "option_name"),
        *("option_price", "option_quantity", "is_discount", "dq_flag"),
    )


def rejected_options(raw: DataFrame) -> DataFrame:
    return quality.rejected(typed_options(raw), quality.OPTION_RULES)


def date_dim(raw: DataFrame) -> DataFrame:
    return _cast(
        raw,
        {
            "date_key": "date",
            "year": "int",
            "month": "int",
            "week": "int",
            "is_weekend": "boolean",
            "is_holiday": "boolean",
        },
    ).select(
        "date_key", "day_of_week", "week", "month", "year", "is_weekend", "is_holiday", "holiday_name"
    )
