"""Derived-table sinks.

A table is a folder of load folders, each partitioned by day:
``<root>/<table>/load=<name>/<date column>=<day>/``. Loads never touch each
other's folders. Which folder holds a table's day is said by the newest commit
record, ``<root>/_commits/<number>.json``, one for all tables of the root. So

* a load writes its tables aside and then switches all of them at once, by adding
  one record; readers see the old tables whole until then and the new ones after,
  and a reader that has begun keeps the folders it has listed;
* a load that fails leaves the old version current. Each finished table of it is
  noted in ``<root>/_loads/<load>/``, and a repeat of the same load over the same
  input (same key) goes on after the last finished table;
* ``Load.replace`` (create or replace) takes over all days of a table,
  ``Load.replace_day`` (the daily insert) one day, also when it has no rows, so
  that re-running a day leaves exactly its new rows;
* old folders stay until ``vacuum``.

One load at a time writes to a root: a second one that began on the same version
fails at its commit. Reading a table lists the folders of its record and nothing
else, in contract column order, with the declared schema, which keeps a table or
day without rows readable; day predicates prune folders.

``rebalance=True`` is for outputs of a shuffle (joins, aggregations), whose
tasks each hold rows of every day: without it a date-partitioned write makes
tasks x days small files. The REBALANCE hint lets AQE cluster rows by the
partition column and split a large day into advisory-sized partitions, so
each task writes a few reasonably sized files of one day. Outputs of a plain
scan of day shards are already day-aligned and skip the extra exchange.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from touchline.sources.files import delete_folder, list_names, read_record, write_record

COMMITS = "_commits"
LOADS = "_loads"
LOAD_COLUMN = "load"


def _prepare(df: DataFrame, partition_col: str, rebalance: bool) -> DataFrame:
    return df.hint("rebalance", partition_col) if rebalance else df


@dataclass(frozen=True)
class Version:
    """``parts``: per table, the load folder of each day folder."""

    number: int = 0
    parts: dict[str, dict[str, str]] = field(default_factory=dict)
    notes: dict = field(default_factory=dict)


def versions(spark: SparkSession, root: str) -> list[int]:
    return [int(n.removesuffix(".json")) for n in list_names(spark, f"{root}/{COMMITS}") if n.endswith(".json")
            and not n.startswith(".")]


def version(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """The newest committed version of the tables below ``root``, or that of the
    given number; number 0 has no tables."""
    number = max(versions(spark, root), default=0) if number is None else number
    if number == 0:
        return Version()
    record = read_record(spark, f"{root}/{COMMITS}/{number:010d}.json")
    return Version(number, record["parts"], record["notes"])


def read_table(spark: SparkSession, root: str, table: str, schema: T.StructType, of: Version) -> DataFrame:
    parts = of.parts.get(table, {})
    if not parts:
        return spark.createDataFrame([], schema)
    folders = sorted(f"{root}/{table}/{load}/{day}" for day, load in parts.items())
    whole = T.StructType([*schema, T.StructField(LOAD_COLUMN, T.StringType())])
    return spark.read.schema(whole).option("basePath", f"{root}/{table}").parquet(*folders).select(*schema.names)


class Load:
    """One load of the tables below ``root``. ``key`` says what it loads; a
    repeat with an equal key goes on where one that failed left off."""

    def __init__(self, spark: SparkSession, root: str, key: list):
        self.spark, self.root = spark, root.rstrip("/")
        self.base = version(spark, self.root)
        self.parts = {table: dict(days) for table, days in self.base.parts.items()}
        self.notes: dict = {}
        digest = hashlib.sha256(json.dumps(key, default=str, sort_keys=True).encode()).hexdigest()[:12]
        self.name = f"{self.base.number + 1:010d}-{digest}"
        self.folder = f"{self.root}/{LOADS}/{self.name}"
        finished = [n for n in list_names(spark, self.folder) if n.endswith(".json") and not n.startswith(".")]
        self.finished = {n.removesuffix(".json"): read_record(spark, f"{self.folder}/{n}") for n in finished}

    def replace(self, table: str, partition_col: str, make: Callable[[], DataFrame], rebalance: bool = False,
                note: Callable[[], dict] = dict) -> None:
        """Let ``table`` hold the rows of ``make()`` only. ``note`` is asked
        after the rows are written, and kept with the record."""
        def write(path: str) -> list[str]:
            _prepare(make(), partition_col, rebalance).write.partitionBy(partition_col).parquet(path)
            return [n for n in list_names(self.spark, path) if n.startswith(f"{partition_col}=")]

        self._write(table, write, note, whole=True)

    def replace_day(self, table: str, partition_col: str, day: dt.date, make: Callable[[], DataFrame],
                    rebalance: bool = False, note: Callable[[], dict] = dict) -> None:
        """Replace one day; ``make()`` gives rows of that day only."""
        name = f"{partition_col}={day.isoformat()}"

        def write(path: str) -> list[str]:
            rows = make().drop(partition_col)
            (rows.hint("rebalance") if rebalance else rows).write.parquet(f"{path}/{name}")
            return [name]

        self._write(table, write, note, whole=False)

    def _write(self, table: str, write: Callable[[str], list[str]], note: Callable[[], dict], whole: bool) -> None:
        if table not in self.finished:
            load = f"{LOAD_COLUMN}={self.name}-{uuid.uuid4().hex[:8]}"  # a failed attempt's folder stays unused
            days = write(f"{self.root}/{table}/{load}")
            self.finished[table] = {"load": load, "days": days, "note": note()}
            write_record(self.spark, f"{self.folder}/{table}.json", self.finished[table])
        done = self.finished[table]
        kept = {} if whole else self.parts.get(table, {})
        self.parts[table] = {**kept, **{day: done["load"] for day in done["days"]}}
        self.notes.update(done["note"])

    def read(self, table: str, schema: T.StructType) -> DataFrame:
        """The table as this load leaves it."""
        return read_table(self.spark, self.root, table, schema, Version(parts=self.parts))

    def commit(self) -> Version:
        """Switch all tables of the root to what this load has written."""
        made = Version(self.base.number + 1, self.parts, self.notes)
        try:
            write_record(self.spark, f"{self.root}/{COMMITS}/{made.number:010d}.json",
                         {"load": self.name, "parts": made.parts, "notes": made.notes})
        except FileExistsError:
            raise RuntimeError(f"another load of {self.root} was committed meanwhile; run this one again") from None
        delete_folder(self.spark, self.folder)
        return made


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove the load folders that the newest ``keep`` versions don't name,
    and older commit records; returns the folders. Not while a load runs, nor
    while a reader still uses an older version."""
    root, numbers = root.rstrip("/"), versions(spark, root.rstrip("/"))
    kept = [version(spark, root, n) for n in numbers[-max(1, keep):]]
    used = {(table, load) for v in kept for table, days in v.parts.items() for load in days.values()}
    gone = []
    for table in list_names(spark, root) if kept else []:
        if table not in (COMMITS, LOADS):
            gone += [f"{root}/{table}/{n}" for n in list_names(spark, f"{root}/{table}")
                     if n.startswith(f"{LOAD_COLUMN}=") and (table, n) not in used]
    older = [f"{root}/{COMMITS}/{n:010d}.json" for n in numbers[:-max(1, keep)]]
    for path in [*gone, *older, *([f"{root}/{LOADS}"] if kept else [])]:
        delete_folder(spark, path)
    return gone
