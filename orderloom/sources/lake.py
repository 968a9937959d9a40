"""Layered Parquet tables: where they live and how they are written and read."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderloom import schemas
from orderloom.context import RunContext, cut_lineage
from orderloom.operators import quality
from orderloom.operators.changes import newest_generation
from orderloom.sources.published import VERSION, Buckets, Published, State

DAY = ("year", "month", "day")

#: Tables kept as a base and generations of changed keys, and their keys.
GENERATIONS = {"priced_items": "order_id", "order_facts": "order_id"}
DELETED = "_deleted"
#: Tables in buckets, and the columns that deal them out. An order may hold very many lines, so options are dealt by line.
BUCKETED = {"order_item_options": ("order_id", "lineitem_id"), "order_facts": ("order_id",)}
#: Rows of a bucket, where the table is larger than the session's shuffle partitions are meant for.
BUCKET_ROWS = 5_000_000
#: Generations, and rows in them as a share of the base, beyond which the next write is a new base.
MOST_GENERATIONS, LARGEST_SHARE = 16, 0.25

# How each Gold table is partitioned.
PERIOD_TABLES = {
    "sales_trends_daily": ("year", "month"),
    "sales_trends_weekly": ("year",),
    "sales_trends_monthly": ("year",),
    "loyalty_monthly_trend": ("year",),
    "location_monthly_performance": ("year",),
}
SNAPSHOT = "snapshot_date"


def gold_partitions(table: str) -> tuple[str, ...]:
    return PERIOD_TABLES.get(table, (SNAPSHOT,))


def balanced(df: DataFrame, *columns: str) -> DataFrame:
    """Bring rows of one partition value together, in files of even size.

    Adaptive execution merges small pieces and splits a value that holds a large
    share of the rows, so a hot day is written by many tasks.
    """
    return df.hint("rebalance", *map(F.col, columns))


def day_part(year: int | None, month: int | None, day: int | None) -> str:
    """A day as a partition folder."""
    values = ("__HIVE_DEFAULT_PARTITION__" if v is None else v for v in (year, month, day))
    return "/".join(f"{name}={value}" for name, value in zip(DAY, values, strict=True))


def _base(state: State) -> int:
    """The first of a table's generations."""
    return min(int(folder.partition("=")[2]) for folder in state.folders)


@dataclass(frozen=True)
class Lake:
    """Table paths under one root; ``id_type`` is the type of the source's keys."""

    spark: SparkSession
    root: str
    id_type: str = "bigint"

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def _place(self, path: str):
        """The file system of a path and the path in its terms."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def exists(self, layer: str, table: str) -> bool:
        files, place = self._place(self.path(layer, table))
        return files.exists(place)

    def published(self, layer: str, table: str) -> Published:
        """A table that is published as a whole: all but Bronze, which is appended to, and the calendar."""
        days = {"order_items": DAY} if layer == "silver" else {}
        by = {"gold": gold_partitions(table), "dlq": ("run_date",), "quality": ("run_date",)}.get(layer, days.get(table, ()))
        return Published(self.spark, self.path(layer, table), by)

    def _schema(self, table: str):
        return schemas.struct(schemas.SILVER[table], self.id_type)

    # Bronze

    def append_days(
        self, df: DataFrame, table: str, watch: Callable[[DataFrame], DataFrame] = lambda df: df
    ) -> None:
        """Append by day. ``watch`` sees the rows in the writing stage, where a
        retried task is counted once."""
        rows = watch(balanced(df, *DAY))
        rows.write.mode("append").partitionBy(*DAY).parquet(self.path("bronze", table))

    def replace_bronze(self, df: DataFrame, table: str) -> None:
        df.write.mode("overwrite").parquet(self.path("bronze", table))

    def bronze(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path("bronze", table))

    def day_folders(self, layer: str, table: str) -> set[str]:
        """Names of the day partitions of a table that is appended to, from one listing of folders."""
        root = self.path(layer, table)
        files, place = self._place("/".join([root, *("*=*" for _ in DAY)]))
        return {"/".join(f.getPath().toString().split("/")[-len(DAY) :]) for f in files.globStatus(place)}

    def count_run_rows(self, table: str, run: RunContext, first: date, last: date) -> int:
        """Rows of one run, read only from the day partitions it can have written."""
        day = F.make_date("year", "month", "day")
        return (
            self.bronze(table)
            .filter(day.between(F.lit(first), F.lit(last)))
            .filter(F.col("pipeline_run_ts") == run.run_stamp)
            .count()
        )

    # Silver

    def write_silver_days(self, df: DataFrame, table: str, rebuild: bool = False, notes: dict | None = None) -> None:
        """Replace the days present in ``df``; with ``rebuild``, the whole table.

        Replacing days only never removes a day that has vanished from the input.
        """
        rows, seen = self._tallied(balanced(schemas.conform(df, schemas.SILVER[table]), *DAY), table)
        target = self.published("silver", table)
        state = target.state()
        version, folders = target.stage(rows)
        notes = (state.notes if state else {}) if notes is None else notes
        if rebuild or state is None:
            target.publish(version, folders, notes | {"quality": seen()})
        else:  # what the replaced days had counted is not known
            parts = state.parts() | State(folders=tuple(folders)).parts()
            target.publish(version, parts.values(), {k: v for k, v in notes.items() if k != "quality"})

    def _tallied(self, df: DataFrame, table: str) -> tuple[DataFrame, Callable[[], dict[str, int] | None]]:
        """Rows on their way into a flagged table, and, after they are written, their quality counts.

        They are observed in the writing stage, where a retried task is counted once.
        """
        if table not in quality.RULES:
            return df, lambda: None
        seen = Observation()
        return df.observe(seen, *self._tally(table)), lambda: dict(seen.get)

    def _tally(self, table: str):
        return quality.tally([name for name, _ in schemas.SILVER[table]], quality.RULES[table])

    def merge_silver_days(self, arriving: DataFrame, table: str, key: str, notes: dict | None = None) -> None:
        """Put arriving rows, one for each key, in place of what the table holds for these keys.

        Only the days are rewritten on which the keys' rows were or now are; a day that is left without
        rows ends with the same publication. Repeating it changes nothing. The days are bounded by the calendar.
        """
        target = self.published("silver", table)
        state = target.state() or State()
        schema = self._schema(table)
        rows = cut_lineage(schemas.conform(arriving, schemas.SILVER[table]))
        keys = rows.select(key)
        before = target.read(schema, state.folders).join(keys, key, "left_semi").select(*DAY)
        touched = {day_part(*r) for r in before.union(rows.select(*DAY)).distinct().collect()}
        held = [folder for part, folder in state.parts().items() if part in touched]
        kept = target.read(schema, held).join(keys, key, "left_anti")
        merged, seen = self._tallied(balanced(kept.unionByName(rows.select(kept.columns)), *DAY), table)
        version, folders = target.stage(merged)
        parts = {part: folder for part, folder in state.parts().items() if part not in touched}
        notes, before = state.notes if notes is None else notes, state.notes.get("quality")
        if before:  # the days written anew are counted twice, before and after, and no others
            out = target.read(schema, held).agg(*self._tally(table)).first().asDict()
            notes = notes | {"quality": quality.combined((1, before), (-1, out), (1, seen()))}
        target.publish(version, [*parts.values(), *folders], notes)

    def write_silver(self, df: DataFrame, table: str, notes: dict | None = None) -> None:
        """Replace a table that comes out of a shuffle: its partitions are the files, merged by adaptive execution."""
        target = self.published("silver", table)
        state = target.state() or State()
        buckets = self._buckets(table, sum(state.notes.get("rows", {}).values()))
        conformed = schemas.conform(df, schemas.SILVER[table])
        counted, seen = self._tallied(buckets.dealt(conformed) if buckets else conformed, table)
        version, folders = target.stage(counted, buckets)
        rows = self.spark.read.parquet(f"{target.root}/{folders[0]}").count()  # from the file footers
        notes = (notes or {}) | {"rows": {str(version): rows}, "quality": seen(), "buckets": buckets and buckets.number}
        target.publish(version, folders, notes)

    def _buckets(self, table: str, rows: int = 0, number: int | None = None) -> Buckets | None:
        """How a table is dealt out: as it was (``number``), or as its last known size asks for."""
        if table not in BUCKETED:
            return None
        least = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return Buckets(BUCKETED[table], number or max(least, -(-rows // BUCKET_ROWS)))

    def write_changed(self, df: DataFrame, touched: DataFrame, table: str, notes: dict) -> None:
        """Replace the rows of the touched keys by ``df``, writing only them: the next generation of the table.

        Where there are many generations, or they hold a good part of the rows, the whole table is written as
        a new base instead, so that readers never have much to set aside.
        """
        key, target = GENERATIONS[table], self.published("silver", table)
        state = target.state()
        rows = schemas.conform(df, schemas.SILVER[table])
        gone = touched.select(key).distinct().join(rows.select(key).distinct(), key, "left_anti")
        marked = rows.withColumn(DELETED, F.lit(False)).unionByName(
            gone.withColumn(DELETED, F.lit(True)), allowMissingColumns=True
        )
        number = state.notes.get("buckets")
        buckets = self._buckets(table, number=number) if number else None
        version, folders = target.stage(buckets.dealt(marked) if buckets else marked, buckets)
        counts = state.notes["rows"] | {str(version): self.spark.read.parquet(f"{target.root}/{folders[0]}").count()}
        changed = sum(counts.values()) - counts[str(_base(state))]
        if len(counts) <= MOST_GENERATIONS and changed <= LARGEST_SHARE * counts[str(_base(state))]:
            target.publish(version, [*state.folders, *folders], notes | {"rows": counts, "buckets": number})
        else:
            self.write_silver(self._generations(table, State(version, (*state.folders, *folders), state.notes)), table, notes)

    def note(self, table: str, notes: dict) -> None:
        """Publish the same rows with new notes."""
        target = self.published("silver", table)
        state = target.state()
        target.publish(state.version + 1, state.folders, state.notes | notes)

    def _generations(self, table: str, state: State) -> DataFrame:
        """Live rows; dealt as the buckets are, if the table is in buckets."""
        schema, target = self._schema(table), self.published("silver", table)
        if len(state.folders) > 1:
            schema = schema.add(DELETED, "boolean")
        number = state.notes.get("buckets")
        rows = (
            target.read_buckets(schema, state.folders, self._buckets(table, number=number))
            if number
            else target.read(schema, state.folders, versions=True)
        )
        if len(state.folders) > 1:
            rows = newest_generation(rows, GENERATIONS[table], VERSION, _base(state), DELETED)
        return rows.select(*(name for name, _ in schemas.SILVER[table]))

    def write_silver_single_file(self, df: DataFrame, table: str) -> None:
        """For a calendar-sized dimension only: everything goes through one task."""
        rows = schemas.conform(df, schemas.SILVER[table])
        rows.coalesce(1).write.mode("overwrite").parquet(self.path("silver", table))

    def silver(self, table: str, state: State | None = None) -> DataFrame:
        """Rows of a table as it is now, or as it was in a state that is still kept."""
        target = self.published("silver", table)
        state = state or target.state()
        if state is None:  # the calendar is a plain folder; a table never written fails as one
            return self.spark.read.schema(self._schema(table)).parquet(target.root)
        if table in GENERATIONS or table in BUCKETED:
            return self._generations(table, state)
        return target.read(self._schema(table), state.folders)

    def write_rejected(self, df: DataFrame, table: str) -> None:
        """Dead-letter rows under the date of the run that loaded them, in place of those it had."""
        rows = df.withColumn("run_date", F.col("pipeline_run_date"))
        self.published("dlq", table).replace_partitions(rows)

    def rejected(self, table: str) -> DataFrame:
        return self._dated("dlq", table)

    def write_quality(self, df: DataFrame, name: str, run: RunContext) -> None:
        """A quality table of one run, in place of what an earlier attempt of it wrote."""
        rows = df.withColumn("run_date", F.lit(run.snapshot_date)).coalesce(1)  # a few rows
        self.published("quality", name).replace_partitions(rows)

    def quality(self, name: str) -> DataFrame:
        return self._dated("quality", name)

    def _dated(self, layer: str, table: str) -> DataFrame:
        """A table by date of run whose columns are those of its files."""
        target = self.published(layer, table)
        folders = (target.state() or State()).folders
        if not folders:
            return self.spark.createDataFrame([], "run_date date")
        paths = [f"{target.root}/{folder}" for folder in folders]
        return self.spark.read.option("basePath", target.root).option("mergeSchema", "true").parquet(*paths).drop(VERSION)

    # Gold

    def write_gold(self, df: DataFrame, table: str, run: RunContext) -> None:
        """Replace only the snapshot, or the periods, present in ``df``."""
        rows = schemas.conform(run.stamp_gold(df), schemas.GOLD[table])
        partitions = gold_partitions(table)
        spread = balanced(rows) if partitions == (SNAPSHOT,) else balanced(rows, *partitions)
        self.published("gold", table).replace_partitions(spread)

    def gold(self, table: str) -> DataFrame:
        """All snapshots or periods of a table."""
        schema = schemas.struct(schemas.GOLD[table], self.id_type)
        return self.published("gold", table).read(schema)

    def latest(self, table: str, snapshot: str | None = None) -> DataFrame:
        """The rows reports read: the newest (or named) snapshot, or all periods.

        The newest is found by the names of the published folders, so no other snapshot's files are opened.
        """
        if gold_partitions(table) != (SNAPSHOT,):
            return self.gold(table)
        target = self.published("gold", table)
        parts = (target.state() or State()).parts()
        wanted = f"{SNAPSHOT}={snapshot}" if snapshot else max(parts, default="")
        schema = schemas.struct(schemas.GOLD[table], self.id_type)
        rows = target.read(schema, [parts[wanted]] if wanted in parts else [])
        return rows.filter(F.col(SNAPSHOT) == F.lit(wanted.partition("=")[2]))
