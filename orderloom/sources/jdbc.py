"""Relational sources over JDBC."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Split:
    """Parallel reading by ranges of a numeric, date or timestamp column."""

    column: str
    lower: str
    upper: str
    partitions: int

    @staticmethod
    def bounds_query(table: str, column: str) -> str:
        """Subquery of one row whose values bound the ranges; the outer ranges are open, so it drops no row."""
        return f"(SELECT MIN({column}) AS lower_bound, MAX({column}) AS upper_bound FROM {table}) bounds"

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": self.lower,
            "upperBound": self.upper,
            "numPartitions": str(self.partitions),
        }


def _literal(value) -> str:
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    text = value.isoformat(" ") if hasattr(value, "hour") else value.isoformat() if isinstance(value, date) else str(value)
    return "'" + text.replace("'", "''") + "'"


@dataclass(frozen=True)
class Ranges:
    """Parallel reading by ranges of a column that hold about equally many rows, however its values are spread.

    ``edges`` are where the second and later ranges begin. Rows without a value belong to the first range. A value
    that more rows share than a range should hold cannot be split by its own column: choose one with many values.
    """

    column: str
    edges: tuple = ()

    @staticmethod
    def edges_query(table: str, column: str, partitions: int, above: str | None = None) -> str:
        """Subquery of the least value of each of ``partitions`` equal parts of the rows, sorted by the column.

        ``above`` keeps to the rows that will be read, such as those above a mark.
        """
        wanted = f"{column} IS NOT NULL" + (f" AND ({above})" if above else "")
        parts = f"SELECT {column} AS value, NTILE({partitions}) OVER (ORDER BY {column}) AS part FROM {table} WHERE {wanted}"
        return f"(SELECT part, MIN(value) AS low FROM ({parts}) ranked GROUP BY part) edges"

    @classmethod
    def of(cls, column: str, lows: Iterable) -> Ranges:
        """Ranges from the least values of the parts, in any order; the first part needs no edge, equal ones are one."""
        return cls(column, tuple(sorted(set(lows))[1:]))

    def predicates(self, above: str | None = None) -> list[str]:
        """One condition for each range: every row meets exactly one of them."""
        c, edges = self.column, [_literal(e) for e in self.edges]
        parts = [f"{c} < {edges[0]} OR {c} IS NULL"] if edges else ["1 = 1"]
        parts += [f"{c} >= {low} AND {c} < {high}" for low, high in zip(edges, edges[1:])]
        parts += [f"{c} >= {edges[-1]}"] if edges else []
        return [f"({part}) AND ({above})" if above else part for part in parts]


@dataclass(frozen=True)
class JdbcSource:
    """Connection options are parameters; where they come from is up to the caller."""

    url: str
    driver: str
    user: str
    password: str = field(repr=False)
    fetch_size: int = 1000

    def options(self, table: str, split: Split | None = None) -> dict[str, str]:
        base = {
            "url": self.url,
            "driver": self.driver,
            "user": self.user,
            "password": self.password,
            "fetchsize": str(self.fetch_size),
            "dbtable": table,
        }
        return base | (split.options() if split else {})

    def table(self, spark: SparkSession, table: str, split: Split | None = None) -> DataFrame:
        """Lazy relation; filters and column choices on it are evaluated by the database."""
        return spark.read.format("jdbc").options(**self.options(table, split)).load()

    def split(self, spark: SparkSession, table: str, column: str, partitions: int) -> Split | None:
        """Ranges between the least and largest value, asked of the database; None for an empty table."""
        row = self.table(spark, Split.bounds_query(table, column)).first()
        return None if row is None or row[0] is None else Split(column, str(row[0]), str(row[1]), partitions)

    def ranges(self, spark: SparkSession, table: str, column: str, partitions: int, above: str | None = None) -> Ranges:
        """Ranges of equal row counts, asked of the database: as many rows come back as there are partitions."""
        lows = self.table(spark, Ranges.edges_query(table, column, partitions, above)).select("low").collect()
        return Ranges.of(column, (r["low"] for r in lows))

    def read_ranges(self, spark: SparkSession, table: str, ranges: Ranges, above: str | None = None) -> DataFrame:
        """Lazy relation with one partition for each range; ``above`` is evaluated by the database as well."""
        options = self.options(table)
        properties = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
        return spark.read.jdbc(self.url, table, predicates=ranges.predicates(above), properties=properties)
