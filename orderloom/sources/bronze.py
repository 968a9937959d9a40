"""Bronze loads: incremental by high-water mark, or full."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from orderloom.context import RunContext
from orderloom.sources.lake import Lake
from orderloom.sources.watermarks import Watermarks, from_micros


class WriteValidationError(RuntimeError):
    """Rows read back from Bronze differ from rows written; the mark has not moved."""


@dataclass(frozen=True)
class LoadResult:
    rows: int
    mark: datetime | None


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*(name.lower() for name in df.columns))


def incremental_batch(source: DataFrame, watermark: str, mark: Column | None) -> DataFrame:
    """Rows strictly above the mark, with the day columns Bronze is partitioned by.

    The predicate is a plain column comparison, so a JDBC or Parquet source
    evaluates it itself. Rows at or below the mark, or without a time, are not
    loaded, however late they appear.
    """
    column = F.col(watermark.lower())
    rows = lower_names(source)
    newer = rows.filter(column.isNotNull()) if mark is None else rows.filter(column > mark)
    return newer.withColumns({"year": F.year(column), "month": F.month(column), "day": F.dayofmonth(column)})


def incremental_load(
    lake: Lake, marks: Watermarks, source: DataFrame, table: str, watermark: str, run: RunContext
) -> LoadResult:
    """Append the new rows, check them, then move the mark.

    The source is read once: the row count and new mark are observed on the rows
    as they are written. The check reads this run's rows from the partitions the
    batch can have touched, less those that a failed attempt of the same run left there.
    If it fails the mark stays, and the rows left behind are repeats that Silver
    deduplication removes after the next load.
    """
    last = marks.get(table)
    column = F.col(watermark.lower())
    rows_type = dict(lower_names(source).dtypes)[watermark.lower()]
    if rows_type == "string":  # texts of one instant may differ, and then compare as different
        raise TypeError(f"{watermark} of {table} is text; a mark needs a date or timestamp")
    mark = None if last is None else F.lit(last).cast(rows_type)
    left = 0
    if lake.exists("bronze", table):
        since = date.min if last is None else last.date() - timedelta(days=1)
        left = lake.count_run_rows(table, run, since, date.max)
    batch = run.stamp_bronze(incremental_batch(source, watermark, mark))
    seen = Observation()
    lake.append_days(
        batch,
        table,
        lambda df: df.observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.min(F.to_date(column)).alias("first_day"),
            F.max(F.to_date(column)).alias("last_day"),
            F.max(F.unix_micros(column.cast("timestamp"))).alias("high_micros"),
        ),
    )
    observed = seen.get
    rows = observed["rows"]
    if rows == 0:
        return LoadResult(0, last)
    written = lake.count_run_rows(table, run, observed["first_day"], observed["last_day"])
    if written - left != rows:
        raise WriteValidationError(f"{table}: wrote {rows} rows but found {written - left}; mark not moved")
    high = from_micros(observed["high_micros"])
    marks.advance(table, high)
    return LoadResult(rows, high)


def full_load(lake: Lake, source: DataFrame, table: str, run: RunContext) -> None:
    """Replace the Bronze copy of a reference table."""
    lake.replace_bronze(run.stamp_bronze(lower_names(source)), table)
