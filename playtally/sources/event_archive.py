"""Typed events kept by date and source file, merged when they are read.

Every batch of files adds one load of its own, so it writes as much as it brings. A file that comes again, or is withdrawn,
is marked dead in the loads that held it; readers leave these rows out. `members` lists which file has rows on which
date of which load, so that earlier versions of a file are found without looking at events. `compact` folds the loads of a
date into one, apart from arrivals.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from playtally import schemas
from playtally.functions.durable import durable
from playtally.sources.manifest import LOAD, DataFile, Snapshot, Store, marked_dead, new_load

EVENTS, MEMBERS = "events", "members"
MOST_LOADS = 16
ARCHIVED = StructType([
    *schemas.EVENTS.fields,
    StructField("file_name", StringType()),
    StructField("listen_date", StringType()),
])
_MEMBERS = StructType([StructField("file_name", StringType()), StructField("listen_date", StringType())])


def read_archived(spark: SparkSession, store: Store, snapshot: Snapshot, dates: Iterable[str] | None) -> DataFrame:
    """The valid events of some dates of a version, with their file; only folders of these dates are listed."""
    return store.read(spark, snapshot, EVENTS, ARCHIVED, dates, date="listen_date", key="file_name")


def read_events(spark: SparkSession, root: str, dates: Iterable[str]) -> DataFrame:
    """The archived events of some dates, in the newest version."""
    store = Store(root)
    return read_archived(spark, store, store.snapshot(spark), dates).select(*schemas.EVENTS.fieldNames())


def members(spark: SparkSession, store: Store, snapshot: Snapshot) -> DataFrame:
    """(file_name, listen_date, load) of all files that have valid events."""
    return store.read(spark, snapshot, MEMBERS, _MEMBERS, date="listen_date", key="file_name", with_load=True)


def earlier(spark: SparkSession, store: Store, snapshot: Snapshot, names: Iterable[str]) -> list[tuple[str, str, str]]:
    """(load, date, file name) that earlier versions of some files are held by."""
    held = members(spark, store, snapshot).where(F.col("file_name").isin([*names]))
    return sorted((row[LOAD], row["listen_date"], row["file_name"]) for row in held.collect())


def append(store: Store, new: DataFrame) -> list[DataFile]:
    """Store the events of a batch (columns of ARCHIVED, a stored frame) under a load of their own; published by the caller."""
    load = new_load()
    held = new.select(*_MEMBERS.fieldNames()).distinct().coalesce(1)
    return store.write(new.select(*ARCHIVED.fieldNames()), EVENTS, "listen_date", load=load) + store.write(held, MEMBERS, load=load)


def without(dead: dict, held: Iterable[tuple[str, str, str]]) -> dict:
    """`dead` with the rows of some files in the loads that hold them."""
    marks = [(load, date, [name]) for load, date, name in held]
    return marked_dead(marked_dead(dead, EVENTS, marks), MEMBERS, marks)


def crowded_dates(snapshot: Snapshot, table: str, most_loads: int) -> list[str]:
    loads: dict[str, set[str]] = {}
    for one in snapshot.of(table):
        loads.setdefault(one.date, set()).add(one.load)
    return sorted(date for date, held in loads.items() if len(held) > most_loads)


def compact(spark: SparkSession, store: Store, checkpoints: str, most_loads: int = MOST_LOADS) -> Snapshot:
    """The next version, in which each date of more than `most_loads` loads has its valid events in one."""
    base = store.snapshot(spark)
    dates = crowded_dates(base, EVENTS, most_loads)
    if not dates:
        return base
    rows = durable(read_archived(spark, store, base, dates), checkpoints)
    folded = {one for one in base.of(EVENTS, dates)}
    marks = [(load, date, []) for load, date in {(one.load, one.date) for one in folded}]
    dead = marked_dead(base.dead, MEMBERS, marks)
    kept = [one for one in base.files if one not in folded]
    return store.publish(spark, base, kept + append(store, rows), dead)
