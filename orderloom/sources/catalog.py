"""Registering lake tables, and the partitions found in them, in the session catalog."""

from __future__ import annotations

from collections.abc import Iterable

from orderloom import schemas
from orderloom.sources.lake import DAY, DELETED, GENERATIONS, Lake, gold_partitions
from orderloom.sources.published import VERSION, Published, State

#: Table property: the published version that the catalog knows.
KNOWN = "orderloom.version"
EMPTY = "__HIVE_DEFAULT_PARTITION__"


def _declared(lake: Lake, layer: str, table: str) -> tuple[tuple[tuple[str, str], ...], tuple[str, ...]]:
    if layer == "gold":
        return schemas.GOLD[table], gold_partitions(table)
    if layer == "bronze":  # typed by the source
        columns = lake.bronze(table).dtypes
        return tuple(columns), DAY if {*DAY} <= {name for name, _ in columns} and table == "order_items" else ()
    return schemas.SILVER[table], DAY if table == "order_items" else ()


def _spec(part: str) -> str:
    """A partition folder as SQL: year=2024/month=1 -> PARTITION (`year`='2024', `month`='1')."""
    pairs = (level.partition("=")[::2] for level in part.split("/"))
    return "PARTITION (" + ", ".join(f"`{k}`=null" if v == EMPTY else f"`{k}`='{v}'" for k, v in pairs) + ")"


class _Entry:
    """One catalog table, and the statements that bring it up to date."""

    def __init__(self, lake: Lake, name: str, columns: Iterable[tuple[str, str]], partitions: tuple[str, ...], location: str):
        self.spark, self.name = lake.spark, name
        self.new = not lake.spark.catalog.tableExists(name.replace("`", ""))
        if self.new:
            fields = ", ".join(f"`{column}` {lake.id_type if kind == schemas.ID else kind}" for column, kind in columns)
            by = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
            self.sql(f"CREATE TABLE {name} ({fields}) USING parquet {by} LOCATION '{location}'")

    def sql(self, statement: str):
        return self.spark.sql(statement)

    def known(self) -> int:
        if self.new:
            return 0
        return int({r["key"]: r["value"] for r in self.sql(f"SHOW TBLPROPERTIES {self.name}").collect()}.get(KNOWN, 0))

    def note(self, version: int) -> None:
        self.sql(f"ALTER TABLE {self.name} SET TBLPROPERTIES ('{KNOWN}' = '{version}')")

    def add(self, located: dict[str, str]) -> None:
        if located:
            parts = " ".join(f"{_spec(part)} LOCATION '{path}'" for part, path in sorted(located.items()))
            self.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS {parts}")

    def drop(self, parts: Iterable[str]) -> None:
        if parts:
            self.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {', '.join(map(_spec, sorted(parts)))}")

    def move(self, part: str, path: str) -> None:
        self.sql(f"ALTER TABLE {self.name} {_spec(part) if part else ''} SET LOCATION '{path}'")

    def partitions(self) -> set[str]:
        return {r[0] for r in self.sql(f"SHOW PARTITIONS {self.name}").collect()}

    def follow(self, target: Published, state: State, part_of=lambda folder: folder.partition("/")[2]) -> None:
        """Changes only the partitions that differ between the state the catalog knows and the present one.

        Where the known state is no longer kept, all partitions are named again.
        """
        version = self.known()
        if version == state.version:
            return
        old = target.state(version) if version else State()
        if old is None:
            self.drop(self.partitions())
            old = State()
        before, now = ({part_of(f): f"{target.root}/{f}" for f in s.folders} for s in (old, state))
        self.drop(before.keys() - now.keys())
        for part in now.keys() & before.keys():
            if now[part] != before[part]:
                self.move(part, now[part])
        self.add({part: path for part, path in now.items() if part not in before})
        self.note(state.version)


def register(lake: Lake, layer: str, table: str, database: str) -> str:
    """Create ``database.table`` over the stored files, or bring it up to date with what was written since.

    Published tables are compared by their pointers, Bronze by the names of its folders: the statements are as many as
    partitions have changed, not as there are. A table kept in generations is a view of them.
    """
    columns, partitions = _declared(lake, layer, table)
    name = f"`{database}`.`{table}`"
    lake.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    target = lake.published(layer, table)
    state = target.state() if layer != "bronze" else None
    if layer == "silver" and table in GENERATIONS:
        _view(lake, table, database, columns, target, state)
        return f"{database}.{table}"
    if state and not partitions:
        path = f"{target.root}/{state.folders[0]}"
        entry = _Entry(lake, name, columns, (), path)
        if not entry.new and entry.known() != state.version:
            entry.move("", path)
        entry.note(state.version)
    else:
        entry = _Entry(lake, name, columns, partitions, lake.path(layer, table))
        if state:
            entry.follow(target, state)
        elif partitions:
            entry.add({part: f"{lake.path(layer, table)}/{part}" for part in lake.day_folders(layer, table) - entry.partitions()})
    lake.spark.catalog.refreshTable(f"{database}.{table}")
    return f"{database}.{table}"


def _view(lake: Lake, table: str, database: str, columns, target: Published, state: State) -> None:
    """A table of all generations, and a view of the rows that count."""
    generations, key = f"`{database}`.`{table}_generations`", GENERATIONS[table]
    entry = _Entry(lake, generations, (*columns, (DELETED, "boolean"), (VERSION, "int")), (VERSION,), target.root)
    entry.follow(target, state, part_of=lambda folder: folder)
    lake.spark.catalog.refreshTable(generations.replace("`", ""))
    base = min(int(folder.partition("=")[2]) for folder in state.folders)
    names = ", ".join(f"g.`{column}`" for column, _ in columns)
    lake.spark.sql(
        f"""CREATE OR REPLACE VIEW `{database}`.`{table}` AS SELECT {names} FROM {generations} g LEFT JOIN
        (SELECT {key}, MAX({VERSION}) AS last FROM {generations} WHERE {VERSION} > {base} GROUP BY {key}) c ON g.{key} = c.{key}
        WHERE (c.last IS NULL OR c.last = g.{VERSION}) AND NOT COALESCE(g.{DELETED}, FALSE)"""
    )
