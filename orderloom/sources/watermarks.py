"""High-water marks kept as an append-only Spark table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

SCHEMA = "table_name string, last_loaded_ts timestamp"
EPOCH = datetime(1970, 1, 1, tzinfo=UTC)


def from_micros(micros: int) -> datetime:
    return EPOCH + timedelta(microseconds=micros)


@dataclass(frozen=True)
class Watermarks:
    """One row per committed load. Marks only move forward, so the largest one is current.

    Appending a row is atomic, whereas an in-place update would have to read and
    overwrite the same files. Marks are instants with a time zone, so the time
    zone of the driver's machine does not shift them.
    """

    spark: SparkSession
    path: str

    def get(self, table: str) -> datetime | None:
        self.spark.createDataFrame([], SCHEMA).write.mode("ignore").parquet(self.path)
        marks = self.spark.read.schema(SCHEMA).parquet(self.path)
        newest = marks.filter(F.col("table_name") == table).agg(F.unix_micros(F.max("last_loaded_ts")))
        micros = newest.first()[0]
        return None if micros is None else from_micros(micros)

    def advance(self, table: str, mark: datetime) -> None:
        current = self.get(table)
        if current is not None and mark < current:
            raise ValueError(f"{table}: mark {mark} is behind {current}")
        row = self.spark.createDataFrame([(table, mark)], SCHEMA)
        row.coalesce(1).write.mode("append").parquet(self.path)
