"""Run identity, session defaults and the lineage cut used between heavy stages."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RunContext:
    """One daily run: its clock reading and the snapshot it produces."""

    run_ts: datetime
    snapshot_date: str

    @classmethod
    def at(cls, run_ts: datetime) -> RunContext:
        return cls(run_ts, run_ts.strftime("%Y-%m-%d"))

    @property
    def run_stamp(self) -> str:
        return self.run_ts.isoformat()

    def stamp_bronze(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                "ingestion_ts": F.lit(self.run_stamp),
                "pipeline_run_ts": F.lit(self.run_stamp),
                "pipeline_run_date": F.lit(self.snapshot_date),
            }
        )

    def stamp_silver(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                "pipeline_run_ts": F.lit(self.run_stamp),
                "pipeline_run_date": F.lit(self.snapshot_date),
                "silver_loaded_at": F.lit(self.run_stamp).cast("timestamp"),
            }
        )

    def stamp_gold(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                "snapshot_date": F.lit(self.snapshot_date),
                "pipeline_run_ts": F.lit(self.run_stamp),
                "pipeline_run_date": F.lit(self.snapshot_date),
            }
        )


def build_session(app_name: str = "orderloom", **conf: str) -> SparkSession:
    """Session with the settings the plans count on; cluster sizing stays with the cluster."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # Day folders are listed by this many tasks, not by one task for each folder.
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", "64")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate data that the driver and all executors see.

    It is the one named in ``spark.checkpoint.dir``. Where that is unset, as in tests, a
    folder inside the warehouse is used if everything runs on this machine; on a cluster the
    warehouse may be a folder of the driver alone, so there the setting is required.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder.

    Used where a small aggregate is read several times (scores, ranks): the rows
    are computed once, and losing an executor afterwards costs a file read.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Parquet in the shared folder, for tables that several parts of a plan read.

    Like ``cut_lineage``, but columns are packed and readers take only those they need, so it fits rows of lines or
    orders. Rows may come back in other partitions. The files go with ``release``, or else when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    kept = spark.read.schema(df.schema).parquet(path)
    kept.stored_at = path
    return kept


def drop_shuffles(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of what has been stored: it does so once the driver's JVM has collected them.

    Listeners hold on to the last query's plan until another one ends, so a tiny one is run before.
    """
    spark.range(1).collect()
    spark._jvm.System.gc()


def release(*frames: DataFrame) -> None:
    """Removes the files of ``stored`` frames that nothing reads any more, and the shuffles they were made with."""
    for df in frames:
        place = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        place.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(place, True)
    drop_shuffles(frames[0].sparkSession)
