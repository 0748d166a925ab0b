"""Tables whose versions are published in one step.

A store is a folder with `data/<table>/load=<id>/...` and `_manifests/<number>.json`. Data files are written under a
new load id and mean nothing until a manifest names them. A manifest lists all files of one version of all tables of
the store, so a reader that holds one sees that version whole, whatever is written meanwhile, and a load that breaks off
leaves only files that no manifest names; `vacuum` removes those, and what only old versions need.

A manifest holds names, row counts and the least and greatest values of a few columns by file. It grows with the number of files,
not with their rows; compaction keeps that number down.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from playtally.sources import files

LOAD = "load"


def new_load() -> str:
    return uuid4().hex


class ConflictError(RuntimeError):
    """Another writer has published a version in the meantime."""


@dataclass(frozen=True)
class DataFile:
    """A file of a table: its path below the table's folder, the date of its rows (where files are split by date), how
    many they are, and the least and greatest values of some columns."""

    table: str
    path: str
    date: str | None
    rows: int
    low: Mapping[str, object] = field(default_factory=dict, hash=False)
    high: Mapping[str, object] = field(default_factory=dict, hash=False)

    @property
    def load(self) -> str:
        return self.path.split("/")[0].removeprefix(f"{LOAD}=")

    def may_hold(self, column: str, value: object) -> bool:
        return column not in self.low or (self.low[column] is not None and self.low[column] <= value <= self.high[column])


@dataclass(frozen=True)
class Snapshot:
    """One published version. `dead` names, by table, load and date, rows that are no longer valid though their file
    is: those of the listed keys, or all of that date where the list is empty."""

    version: int = 0
    files: tuple[DataFile, ...] = ()
    dead: Mapping[str, Mapping[str, Mapping[str, list[str]]]] = field(default_factory=dict, hash=False)
    notes: Mapping[str, object] = field(default_factory=dict, hash=False)

    def of(self, table: str, dates: Iterable[str] | None = None) -> list[DataFile]:
        wanted = None if dates is None else {*dates}
        return [one for one in self.files if one.table == table and (wanted is None or one.date in wanted)]

    def dates(self, table: str) -> list[str]:
        return sorted({one.date for one in self.of(table) if one.date is not None})


@dataclass(frozen=True)
class Store:
    root: str

    def _folder(self, table: str) -> str:
        return f"{self.root}/data/{table}"

    def _manifest(self, version: int) -> str:
        return f"{self.root}/_manifests/{version:012d}.json"

    # ---- Reading

    def versions(self, spark: SparkSession) -> list[int]:
        names = files.names(spark, f"{self.root}/_manifests")
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json") and name[0].isdigit())

    def snapshot(self, spark: SparkSession, version: int | None = None) -> Snapshot:
        """The newest version, or the one asked for; version 0 is the empty store."""
        if version is None:
            version = max(self.versions(spark), default=0)
        if version == 0:
            return Snapshot()
        stored = json.loads(files.read_text(spark, self._manifest(version)))
        return Snapshot(version, tuple(DataFile(**one) for one in stored["files"]), stored["dead"], stored["notes"])

    def read(self, spark: SparkSession, snapshot: Snapshot, table: str, schema: StructType, dates: Iterable[str] | None = None,
             chosen: Callable[[DataFile], bool] | None = None, date: str = "date", key: str | None = None, with_load: bool = False) -> DataFrame:
        """The valid rows of a table: of some dates, or of the files that `chosen` accepts. Other files are not opened."""
        wanted = [one for one in snapshot.of(table, dates) if chosen is None or chosen(one)]
        columns = schema.fieldNames()
        if not wanted:
            empty = spark.createDataFrame([], schema)
            return empty.withColumn(LOAD, F.lit(None).cast("string")) if with_load else empty
        folder = self._folder(table)
        # Whole folders where all of a date is wanted, single files where statistics chose them.
        paths = sorted({f"{folder}/{one.path if chosen else one.path.rpartition('/')[0]}" for one in wanted})
        full = StructType([*schema.fields, StructField(LOAD, StringType())])
        read = spark.read.schema(full).option("basePath", folder).parquet(*paths)
        invalid = self._invalid(snapshot, table, {one.load for one in wanted}, date, key)
        if invalid is not None:
            read = read.where(~invalid)
        return read.select(*columns, *([LOAD] if with_load else []))

    @staticmethod
    def _invalid(snapshot: Snapshot, table: str, loads: set[str], date: str, key: str | None) -> Column | None:
        found = None
        for load, by_date in snapshot.dead.get(table, {}).items():
            whole = [day for day, keys in by_date.items() if not keys]
            parts = [(F.col(LOAD) == load) & F.col(date).isin(*whole)] if whole else []
            parts += [(F.col(LOAD) == load) & (F.col(date) == day) & F.col(key).isin(keys) for day, keys in by_date.items() if keys]
            for part in parts if load in loads else []:
                found = part if found is None else found | part
        return found

    # ---- Writing

    def write(self, df: DataFrame, table: str, date: str | None = None, order: Iterable[str] = (),
              statistics: Iterable[str] = (), load: str | None = None) -> list[DataFile]:
        """Store rows under a new load (or one's own new id, for tables that belong together); nobody reads them until the
        files that this returns are published. With `date` the files are split by that column, small dates share a task
        and large ones are split."""
        spark, statistics = df.sparkSession, [*statistics]
        place = f"{self._folder(table)}/{LOAD}={load or new_load()}"
        if date is not None:
            df = df.hint("rebalance", F.col(date))
            order = [date, *[name for name in order if name != date]]
        order = [*order]
        if order:
            df = df.sortWithinPartitions(*order)
        writer = df.write.mode("errorifexists")
        (writer.partitionBy(date) if date is not None else writer).parquet(place)
        written = spark.read.schema(df.schema).option("basePath", place).parquet(place)
        prefix = files.folder_prefix(spark, self._folder(table))
        path = F.substring_index(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), prefix, -1)
        found = written.groupBy(path.alias("__path")).agg(
            F.count(F.lit(1)).alias("__rows"), *([F.min(date).alias("__date")] if date is not None else []),
            *[F.min(name).alias(f"__low_{name}") for name in statistics], *[F.max(name).alias(f"__high_{name}") for name in statistics]).collect()
        return [DataFile(table, row["__path"], row["__date"] if date is not None else None, row["__rows"],
                         {name: row[f"__low_{name}"] for name in statistics}, {name: row[f"__high_{name}"] for name in statistics})
                for row in sorted(found, key=lambda row: row["__path"])]

    def publish(self, spark: SparkSession, base: Snapshot, new_files: Iterable[DataFile],
                dead: Mapping[str, Mapping[str, Mapping[str, list[str]]]] | None = None, notes: Mapping[str, object] | None = None) -> Snapshot:
        """Make `new_files` (all of them, of all tables) the next version after `base`, in one step. What `dead` says of
        loads without files is dropped."""
        new_files = tuple(new_files)
        kept = {(one.table, one.load) for one in new_files}
        dead = {table: {load: by_date for load, by_date in loads.items() if (table, load) in kept}
                for table, loads in (base.dead if dead is None else dead).items()}
        made = Snapshot(base.version + 1, new_files, dead, base.notes if notes is None else notes)
        text = json.dumps({"files": [vars(one) for one in new_files], "dead": dead, "notes": made.notes})
        if not files.create_text(spark, self._manifest(made.version), text):
            raise ConflictError(f"version {made.version} of {self.root} exists already")
        return made

    def vacuum(self, spark: SparkSession, keep: int = 2) -> list[str]:
        """Remove the manifests before the last `keep`, and the loads that none of these names; returns those loads. Only
        while no load is under way, as its files are not named yet."""
        versions = self.versions(spark)
        named = {(one.table, one.load) for version in versions[-keep:] for one in self.snapshot(spark, version).files}
        for version in versions[:-keep]:
            files.delete(spark, self._manifest(version))
        gone = []
        for table in files.names(spark, f"{self.root}/data"):
            for name in files.names(spark, self._folder(table)):
                if name.startswith(f"{LOAD}=") and (table, name.removeprefix(f"{LOAD}=")) not in named:
                    files.delete(spark, f"{self._folder(table)}/{name}")
                    gone.append(f"{table}/{name}")
        return sorted(gone)


def marked_dead(dead: Mapping, table: str, marks: Iterable[tuple[str, str, list[str]]]) -> dict:
    """`dead` with more (load, date, keys) of a table; no keys mean all rows of that date."""
    made = {name: {load: dict(by_date) for load, by_date in loads.items()} for name, loads in dead.items()}
    for load, date, keys in marks:
        by_date = made.setdefault(table, {}).setdefault(load, {})
        whole = not keys or by_date.get(date) == []
        by_date[date] = [] if whole else sorted({*by_date.get(date, []), *keys})
    return made
