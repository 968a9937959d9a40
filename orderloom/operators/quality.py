"""Data-quality rules: one ordered list per table drives flags, hard drops and profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.rules import first_match


@dataclass(frozen=True)
class Rule:
    flag: str
    predicate: str
    drops: bool = False


# Flags in order of precedence, first match wins.
ORDER_ITEM_RULES = (
    Rule("NULL_LINEITEM_ID", "lineitem_id IS NULL", drops=True),
    Rule("NULL_ORDER_ID", "order_id IS NULL", drops=True),
    Rule("NULL_USER_ID", "user_id IS NULL"),
    Rule("NULL_CARD_NUMBER", "printed_card_number IS NULL"),
    Rule("NULL_PRICE", "item_price IS NULL"),
    Rule("NEGATIVE_PRICE", "item_price < 0"),
    Rule("INVALID_QUANTITY", "item_quantity <= 0"),
    Rule("NULL_TIMESTAMP", "creation_time_utc IS NULL"),
)
OPTION_RULES = (
    Rule("NULL_ORDER_ID", "order_id IS NULL", drops=True),
    Rule("NULL_LINEITEM_ID", "lineitem_id IS NULL", drops=True),
    Rule("NULL_OPTION_NAME", "option_name IS NULL", drops=True),
    Rule("NULL_OPTION_GROUP", "option_group_name IS NULL"),
    Rule("NULL_OPTION_PRICE", "option_price IS NULL"),
)
CLEAN = "CLEAN"
RULES = {"order_items": ORDER_ITEM_RULES, "order_item_options": OPTION_RULES}


def with_flags(df: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Add ``dq_flag``: the first rule that holds, else CLEAN."""
    return df.withColumn("dq_flag", first_match([(r.flag, r.predicate) for r in rules], CLEAN))


def _drop_condition(rules: tuple[Rule, ...]) -> Column:
    """Whether any dropping rule holds.

    Dropping rules lead the list, so this is the same as having one of their
    flags, but it is made of key null checks that Parquet row groups can skip on.
    """
    dropping = [r for r in rules if r.drops]
    if list(rules[: len(dropping)]) != dropping:
        raise ValueError("dropping rules must come first")
    return F.expr(" OR ".join(f"({r.predicate})" for r in dropping))


def kept(df: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    return df.filter(~_drop_condition(rules))


def rejected(df: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Hard-dropped rows with the flag that dropped them."""
    return with_flags(df.filter(_drop_condition(rules)), rules)


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows (column_name, null_count, total_rows), counted for all columns in one pass."""
    names = columns or df.columns
    counted = df.agg(
        *(F.count_if(F.col(name).isNull()).alias(name) for name in names),
        F.count(F.lit(1)).alias("total_rows"),
    )
    return counted.unpivot("total_rows", names, "column_name", "null_count").select(
        "column_name", "null_count", "total_rows"
    )


def flag_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("dq_flag").agg(F.count(F.lit(1)).alias("rows"))


# --- the same counts, gathered while a table is written ---------------------------------------


def tally(columns: Sequence[str], rules: tuple[Rule, ...]) -> list[Column]:
    """Rows, nulls by column and rows by flag as plain sums, which can be observed on rows that are being written,
    added up and taken off again."""
    flags = [*(r.flag for r in rules if not r.drops), CLEAN]
    return [
        F.count(F.lit(1)).alias("rows"),
        *(F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns),
        *(F.count_if(F.col("dq_flag") == flag).alias(f"flag_{flag}") for flag in flags),
    ]


def combined(*signed: tuple[int, Mapping[str, int]]) -> dict[str, int]:
    """Sum of tallies, each with its sign."""
    names = signed[0][1].keys()
    return {name: sum(sign * counts[name] for sign, counts in signed) for name in names}


def tables_of(spark: SparkSession, counts: Mapping[str, int], columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """What ``null_profile`` and ``flag_distribution`` give for the rows that a tally has counted."""
    nulls = [(c, counts[f"null_{c}"], counts["rows"]) for c in columns]
    flags = [(name.removeprefix("flag_"), n) for name, n in counts.items() if name.startswith("flag_") and n]
    return (
        spark.createDataFrame(nulls, "column_name string, null_count bigint, total_rows bigint"),
        spark.createDataFrame(flags, "dq_flag string, rows bigint"),
    )
