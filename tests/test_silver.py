"""Typing, quality flags, hard drops and deduplication on literal rows."""

from __future__ import annotations

import datetime
from decimal import Decimal

import pytest

from orderloom.operators import quality
from orderloom.operators.dedup import latest_per_key
from orderloom.operators.quality import OPTION_RULES, ORDER_ITEM_RULES, Rule
from orderloom.plans import silver

ITEM = {
    "order_id": 1,
    "lineitem_id": 10,
    "user_id": 5,
    "printed_card_number": "CARD",
    "restaurant_id": 3,
    "app_name": "app",
    "item_name": "soup",
    "item_category": "food",
    "item_price": "2.50",
    "item_quantity": "2",
    "currency": "USD",
    "is_loyalty": "true",
    "creation_time_utc": "2024-01-02 03:04:05",
    "ingestion_ts": "2024-01-03T00:00:00+00:00",
}
ITEM_SCHEMA = ", ".join(f"{c} {'bigint' if c.endswith('_id') else 'string'}" for c in ITEM)
OPTION = {
    "order_id": 1,
    "lineitem_id": 10,
    "option_group_name": "PROMO",
    "option_name": "discount",
    "option_price": "-1.00",
    "option_quantity": "1",
    "ingestion_ts": "2024-01-03",
}
OPTION_SCHEMA = ", ".join(f"{c} {'bigint' if c.endswith('_id') else 'string'}" for c in OPTION)


def items(spark, *changes):
    return spark.createDataFrame([tuple((ITEM | change).values()) for change in changes], ITEM_SCHEMA)


def options(spark, *changes):
    return spark.createDataFrame([tuple((OPTION | change).values()) for change in changes], OPTION_SCHEMA)


ITEM_FAULTS = [
    ("NULL_LINEITEM_ID", {"lineitem_id": None}),
    ("NULL_ORDER_ID", {"order_id": None}),
    ("NULL_USER_ID", {"user_id": None}),
    ("NULL_CARD_NUMBER", {"printed_card_number": None}),
    ("NULL_PRICE", {"item_price": None}),
    ("NEGATIVE_PRICE", {"item_price": "-0.01"}),
    ("INVALID_QUANTITY", {"item_quantity": "0"}),
    ("NULL_TIMESTAMP", {"creation_time_utc": None}),
    ("CLEAN", {}),
]
OPTION_FAULTS = [
    ("NULL_ORDER_ID", {"order_id": None}),
    ("NULL_LINEITEM_ID", {"lineitem_id": None}),
    ("NULL_OPTION_NAME", {"option_name": None}),
    ("NULL_OPTION_GROUP", {"option_group_name": None}),
    ("NULL_OPTION_PRICE", {"option_price": None}),
    ("CLEAN", {}),
]


def test_item_flags_and_their_precedence(spark):
    changes, expected = [], []
    for position, (flag, fault) in enumerate(ITEM_FAULTS):
        changes.append(fault | {"item_name": str(len(expected))})
        expected.append(flag)
        for _, later in ITEM_FAULTS[position + 1 :]:
            if not fault.keys() & later.keys():
                changes.append(fault | later | {"item_name": str(len(expected))})
                expected.append(flag)
    flagged = quality.with_flags(silver.typed_order_items(items(spark, *changes)), ORDER_ITEM_RULES)
    found = {int(row["item_name"]): row["dq_flag"] for row in flagged.collect()}
    assert [found[i] for i in range(len(expected))] == expected


def test_option_flags(spark):
    rows = options(spark, *(fault for _, fault in OPTION_FAULTS))
    flagged = quality.with_flags(silver.typed_options(rows), OPTION_RULES)
    assert sorted(r["dq_flag"] for r in flagged.collect()) == sorted(flag for flag, _ in OPTION_FAULTS)


def test_kept_and_rejected_split_the_input(spark):
    typed = silver.typed_order_items(items(spark, *(fault for _, fault in ITEM_FAULTS)))
    kept = quality.kept(typed, ORDER_ITEM_RULES)
    rejected = quality.rejected(typed, ORDER_ITEM_RULES)
    assert kept.count() + rejected.count() == typed.count()
    assert {r["dq_flag"] for r in rejected.collect()} == {"NULL_LINEITEM_ID", "NULL_ORDER_ID"}


def test_dropping_rules_must_lead(spark):
    with pytest.raises(ValueError):
        quality.kept(items(spark, {}), (Rule("A", "order_id = 1"), Rule("B", "order_id = 2", drops=True)))


def test_malformed_values_become_null(spark):
    bad = {
        "item_price": "abc",
        "item_quantity": "two",
        "is_loyalty": "perhaps",
        "creation_time_utc": "yesterday",
    }
    row = silver.order_items(items(spark, bad)).first()
    assert [row[c] for c in bad] == [None] * 4
    assert (row["revenue"], row["order_date"], row["dq_flag"]) == (None, None, "NULL_PRICE")
    huge = silver.order_items(items(spark, {"item_price": "99999999.99", "item_quantity": "2000"})).first()
    assert huge["revenue"] is None


def test_silver_item_columns_and_types(spark):
    row = silver.order_items(items(spark, {})).first()
    assert row["revenue"] == Decimal("5.00") and row["item_price"] == Decimal("2.50")
    assert row["order_date"] == datetime.date(2024, 1, 2)
    assert (row["year"], row["month"], row["day"]) == (2024, 1, 2)
    assert row["eligible_for_customer_metrics"] is True
    assert silver.order_items(items(spark, {"user_id": None})).first()["eligible_for_customer_metrics"] is False


def test_discount_flag(spark):
    prices = ["-0.01", "0", "1", None]
    rows = silver.typed_options(options(spark, *({"option_price": p} for p in prices))).collect()
    assert [r["is_discount"] for r in rows] == [True, False, False, False]


def test_latest_record_wins_and_repeating_changes_nothing(spark):
    raw = items(
        spark,
        {"item_name": "old"},
        {"item_name": "new", "ingestion_ts": "2024-02-01T00:00:00+00:00"},
        {"lineitem_id": 11, "item_price": "3"},
        {"lineitem_id": 11, "item_price": "2"},
    )
    once = latest_per_key(raw, ["lineitem_id"], silver.ITEM_NEWEST, silver.ITEM_TIES)
    twice = latest_per_key(once, ["lineitem_id"], silver.ITEM_NEWEST, silver.ITEM_TIES)
    found = {r["lineitem_id"]: (r["item_name"], r["item_price"]) for r in once.collect()}
    assert found == {10: ("new", "2.50"), 11: ("soup", "2")}
    assert sorted(once.collect()) == sorted(twice.collect())


def test_null_option_group_is_one_key(spark):
    raw = options(spark, {"option_group_name": None}, {"option_group_name": None}, {})
    assert silver.order_item_options(raw).count() == 2


def test_many_copies_of_one_key_are_cut_before_the_shuffle(spark):
    raw = items(spark, *({"item_name": str(i)} for i in range(300)))
    result = silver.order_items(raw)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and result.count() == 1


def test_null_profile(spark):
    profile = quality.null_profile(items(spark, {"user_id": None}, {"item_price": None, "user_id": None}, {}))
    counts = {r["column_name"]: r["null_count"] for r in profile.collect()}
    assert (counts["user_id"], counts["item_price"], counts["order_id"]) == (2, 1, 0)
    assert {r["total_rows"] for r in profile.collect()} == {3}
