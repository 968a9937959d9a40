"""Tables whose readers see one published state, whole.

A write stages its files in a folder of its own version; nothing reads them until a pointer file that names the
folders of the new state is renamed into place. A write that dies before that leaves the old state as it was, and its
folder is removed by the next one. Pointers are numbered; the newest is the table. Folders that neither it nor the pointer
before it names are removed, so a reader that began before a write can still finish.

A folder is ``version=<n>`` or a partition below it, such as ``version=<n>/year=2024/month=1/day=5``. Partition values come from
the calendar or the list of runs, so a pointer stays small. One writer per table is assumed; of two at once, one fails.
Partition folders that were written without a pointer, straight under the table, are its state until the first write.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION = "version"
POINTERS = "_pointers"
KEPT = 2


class ConcurrentWrite(RuntimeError):
    """Another writer published the same version first."""


def _versioned(folder: str) -> bool:
    return folder.startswith(f"{VERSION}=")


@dataclass(frozen=True)
class State:
    """What one pointer file says: live folders, and notes that were published with them."""

    version: int = 0
    folders: tuple[str, ...] = ()
    notes: dict = field(default_factory=dict)

    def parts(self) -> dict[str, str]:
        """Partition -> folder that holds it."""
        return {folder.partition("/")[2] if _versioned(folder) else folder: folder for folder in self.folders}


@dataclass(frozen=True)
class Buckets:
    """Files by hash of some columns, sorted by them: a join or aggregation on these columns reads them without a shuffle.

    Spark keeps buckets of catalog tables only. The entry is needed while a frame is made and dropped at once: the files
    are the table's own, and a frame that has been resolved no longer asks the catalog.
    """

    columns: tuple[str, ...]
    number: int

    def dealt(self, df: DataFrame) -> DataFrame:
        """Rows of a bucket in one task, so that it becomes one file."""
        return df.repartition(self.number, *self.columns)

    def write(self, df: DataFrame, path: str) -> None:
        name = f"orderloom_{uuid.uuid4().hex}"
        writer = df.write.format("parquet").bucketBy(self.number, *self.columns).sortBy(*self.columns)
        try:
            writer.option("path", path).saveAsTable(name)
        finally:
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")

    def read(self, spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
        name, by = f"orderloom_{uuid.uuid4().hex}", ", ".join(self.columns)
        fields = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
        spark.sql(
            f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {self.number} BUCKETS LOCATION '{path}'"
        )
        try:
            return spark.table(name)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


@dataclass(frozen=True)
class Published:
    spark: SparkSession
    root: str
    partitions: tuple[str, ...] = ()

    # Files

    def _place(self, path: str = ""):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{path}".rstrip("/"))
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _names(self, path: str) -> list[str]:
        files, place = self._place(path)
        return [f.getPath().getName() for f in files.listStatus(place)] if files.exists(place) else []

    def _remove(self, path: str) -> None:
        files, place = self._place(path)
        files.delete(place, True)

    def _pointer(self, version: int) -> State:
        files, place = self._place(f"{POINTERS}/{version:09d}.json")
        stream = files.open(place)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        said = json.loads(text)
        return State(version, tuple(said["folders"]), said["notes"])

    def _pointers(self) -> list[int]:
        return sorted(int(name.split(".")[0]) for name in self._names(POINTERS) if name.endswith(".json") and name[0] != ".")

    # States

    def state(self, version: int | None = None) -> State | None:
        """The newest state, or an older one that is still kept; None where there is none."""
        known = self._pointers()
        if version is not None:
            return self._pointer(version) if version in known else None
        if known:
            return self._pointer(known[-1])
        plain = tuple(folder for folder in self._folders("") if not _versioned(folder))
        return State(folders=plain) if plain else None

    def _folders(self, top: str) -> list[str]:
        """Partition folders below a folder of the table."""
        if not self.partitions:
            return [top] if top else []
        files, place = self._place("/".join([*filter(None, [top]), *("*=*" for _ in self.partitions)]))
        levels = len(self.partitions) + bool(top)
        return sorted("/".join(f.getPath().toString().split("/")[-levels:]) for f in files.globStatus(place) or ())

    def stage(self, df: DataFrame, buckets: Buckets | None = None) -> tuple[int, list[str]]:
        """Writes ``df``, dealt out already if into buckets, as the next version, which nobody reads yet; the version and its folders."""
        taken = [int(name.partition("=")[2]) for name in self._names("") if _versioned(name)]
        version = max([0, *taken, *self._pointers()]) + 1
        top = f"{VERSION}={version}"
        writer = df.write.partitionBy(*self.partitions) if self.partitions else df.write
        if buckets:
            buckets.write(df, f"{self.root}/{top}")
        else:
            writer.parquet(f"{self.root}/{top}")
        return version, self._folders(top)

    def publish(self, version: int, folders: Iterable[str], notes: dict) -> State:
        """Makes the folders the table, at once, and removes what the last states no longer need."""
        state = State(version, tuple(sorted(folders)), notes)
        files, hidden = self._place(f"{POINTERS}/.{uuid.uuid4().hex}")
        stream = files.create(hidden)
        try:
            stream.write(bytearray(json.dumps({"folders": state.folders, "notes": notes}).encode()))
        finally:
            stream.close()
        files, place = self._place(f"{POINTERS}/{version:09d}.json")
        if files.exists(place) or not files.rename(hidden, place):
            files.delete(hidden, False)
            raise ConcurrentWrite(f"{self.root}: version {version} is published already")
        self._clean()
        return state

    def _clean(self) -> None:
        known = self._pointers()
        kept = [self._pointer(v) for v in known[-KEPT:]]
        needed = {folder for state in kept for folder in state.folders}
        versions = {folder.split("/")[0] for folder in needed}
        for version in known[:-KEPT]:
            for folder in set(self._pointer(version).folders) - needed:
                if folder.split("/")[0] in versions or not _versioned(folder):
                    self._remove(folder)
            self._remove(f"{POINTERS}/{version:09d}.json")
        for name in self._names(""):
            if _versioned(name) and name not in versions and int(name.partition("=")[2]) < known[-1]:
                self._remove(name)

    # Writes

    def replace(self, df: DataFrame, notes: dict | None = None) -> State:
        """The table becomes ``df``."""
        version, folders = self.stage(df)
        return self.publish(version, folders, notes or {})

    def replace_partitions(self, df: DataFrame, notes: dict | None = None) -> State:
        """The partitions that ``df`` has take its rows, all others stay."""
        version, folders = self.stage(df)
        before = self.state() or State()
        parts = before.parts() | State(folders=tuple(folders)).parts()
        return self.publish(version, parts.values(), before.notes if notes is None else notes)

    # Reads

    def read_buckets(self, schema: T.StructType, folders: Iterable[str], buckets: Buckets) -> DataFrame:
        """Rows of versions written in buckets, and the version of each; still dealt by the bucket columns."""
        parts = (
            buckets.read(self.spark, schema, f"{self.root}/{f}").withColumn(VERSION, F.lit(int(f.partition("=")[2]))) for f in folders
        )
        return reduce(DataFrame.unionByName, parts)

    def read(self, schema: T.StructType, folders: Iterable[str] | None = None, versions: bool = False) -> DataFrame:
        """Rows of the newest state, or of the folders given; with ``versions``, the version that wrote each as well."""
        if folders is None:
            state = self.state()
            if state is None:
                raise FileNotFoundError(f"{self.root} has not been published")
            folders = state.folders
        whole = T.StructType([*schema.fields, T.StructField(VERSION, T.IntegerType())])
        rows = self.spark.createDataFrame([], whole)
        paths = {kind: [f"{self.root}/{f}" for f in folders if _versioned(f) == kind] for kind in (True, False)}
        if paths[True]:
            rows = self.spark.read.schema(whole).option("basePath", self.root).parquet(*paths[True])
        if paths[False]:
            plain = self.spark.read.schema(schema).option("basePath", self.root).parquet(*paths[False])
            plain = plain.withColumn(VERSION, F.lit(0))
            rows = rows.unionByName(plain) if paths[True] else plain
        return rows if versions else rows.select(*schema.names)
