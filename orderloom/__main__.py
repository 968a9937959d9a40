"""Command line for scheduled runs: ``python -m orderloom daily --lake ... --source ...``."""

from __future__ import annotations

import argparse
import json
from datetime import UTC, datetime

from orderloom.context import RunContext, build_session
from orderloom.plans import daily
from orderloom.sources.catalog import register
from orderloom.sources.jdbc import JdbcSource
from orderloom.sources.lake import Lake
from orderloom.sources.watermarks import Watermarks

SOURCE_TABLES = ("order_items", "order_item_options", "date_dim")
STAGES = ("bronze", "silver", "gold", "daily", "register")


def parser() -> argparse.ArgumentParser:
    options = argparse.ArgumentParser(prog="orderloom", description=__doc__)
    options.add_argument("stage", choices=STAGES)
    options.add_argument("--lake", required=True, help="root folder of the lake, on shared storage")
    options.add_argument("--source", help="folder with one Parquet table per source table")
    options.add_argument("--jdbc", help="JSON file with url, driver, user, password, schema and splits (table: column, partitions)")
    options.add_argument("--database", default="orders", help="prefix of the catalog databases")
    options.add_argument("--id-type", default="bigint", help="type of the keys in the source")
    return options


def _above(mark: datetime | None) -> str | None:
    """What the order items that a run reads have in common, for the database: the same rows as the mark's predicate."""
    return None if mark is None else f"creation_time_utc > '{mark.astimezone(UTC):%Y-%m-%d %H:%M:%S.%f}'"


def _sources(spark, args, marks):
    if args.source:
        return {table: spark.read.parquet(f"{args.source}/{table}") for table in SOURCE_TABLES}
    if not args.jdbc:
        raise SystemExit("give --source or --jdbc")
    with open(args.jdbc) as file:
        settings = json.load(file)
    prefix, splits = settings.pop("schema", "dbo"), settings.pop("splits", {})
    database = JdbcSource(**settings)

    def read(table: str):
        name = f"{prefix}.{table}"
        wanted = splits.get(table)
        if not wanted:
            return database.table(spark, name)
        above = _above(marks.get(table)) if table == "order_items" else None
        return database.read_ranges(spark, name, database.ranges(spark, name, above=above, **wanted), above)

    return {table: read(table) for table in SOURCE_TABLES}


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session()
    lake = Lake(spark, args.lake, args.id_type)
    marks = Watermarks(spark, f"{args.lake}/state/watermarks")
    run = RunContext.at(datetime.now(UTC))
    if args.stage == "bronze":
        daily.run_bronze(lake, marks, _sources(spark, args, marks), run)
    elif args.stage == "silver":
        daily.run_silver(lake, run)
    elif args.stage == "gold":
        daily.run_gold(lake, run)
    elif args.stage == "daily":
        daily.run_daily(lake, marks, _sources(spark, args, marks), run)
    else:
        for table in SOURCE_TABLES:
            register(lake, "bronze", table, f"{args.database}_bronze")
        for table in daily.SILVER_TABLES:
            register(lake, "silver", table, f"{args.database}_silver")
        for table in daily.gold_tables(lake, run):
            register(lake, "gold", table, f"{args.database}_gold")


if __name__ == "__main__":
    main()
