"""The serving store: items by date, the same items by genre, and the ranking of each date, published together.

* `kpi_items` and `top_genre_items` are split by date; a load rewrites the dates that it touches.
* `items_by_genre` holds the KPI items sorted and ranged by (genre, date). A load adds the items of its dates in a load of their
  own and marks these dates dead in older loads; `compact_by_genre` folds the loads into one.
* `ranking` holds, by date, the RANKED items with the most plays, sorted. It is made from the merged items of the date, so
  it is right also where a load lowers a count.

All four change in one step (`manifest.Store.publish`). Each file's least and greatest expiry, genre and date stand in the
manifest: lookups open the files that can hold their rows, expiry those that hold live and expired rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playtally import schemas
from playtally.functions.clock import epoch_seconds
from playtally.functions.durable import durable
from playtally.operators import serving
from playtally.operators.merging import merge_latest
from playtally.sources.manifest import DataFile, Snapshot, Store, marked_dead

KPI, TOP, BY_GENRE, RANKING = "kpi_items", "top_genre_items", "items_by_genre", "ranking"
RANKED = 50
MOST_GENRE_LOADS, GENRE_FILE_ROWS = 16, 50_000
EXPIRY = "ttl_expiry"
STATISTICS = {KPI: ("genre", EXPIRY), TOP: (EXPIRY,), BY_GENRE: ("genre", "date", EXPIRY), RANKING: (EXPIRY,)}
SCHEMAS = {KPI: schemas.KPI_ITEMS, TOP: schemas.TOP_GENRE_ITEMS, BY_GENRE: schemas.KPI_ITEMS, RANKING: schemas.KPI_ITEMS}
KEYS = {KPI: schemas.KPI_KEY, TOP: schemas.TOP_GENRE_KEY}


def _write(store: Store, table: str, rows: DataFrame) -> list[DataFile]:
    if table == BY_GENRE:
        # So many files whatever adaptive execution thinks of their sizes: a lookup of one genre opens few of few rows.
        parts = max(1, -(-rows.count() // GENRE_FILE_ROWS))
        return store.write(rows.repartitionByRange(parts, "genre", "date"), table, order=("genre", "date"), statistics=STATISTICS[table])
    if table == RANKING:
        return store.write(rows, table, "date", ("listen_count", "genre"), STATISTICS[table])
    return store.write(rows, table, "date", KEYS[table], STATISTICS[table])


def _ranking(items: DataFrame) -> DataFrame:
    order = Window.partitionBy("date").orderBy(F.desc("listen_count"), "genre")
    return items.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= RANKED).drop("_place")


def _dates_of(*frames: DataFrame) -> list[str]:
    """The dates of some items: a calendar's worth of names, whatever the rows."""
    return sorted({row[0] for frame in frames for row in frame.select("date").distinct().collect()})


def publish_items(spark: SparkSession, store: Store, kpi: DataFrame, top: DataFrame, now: datetime, checkpoints: str,
                  replaced: Iterable[str] = (), notes: dict | None = None) -> Snapshot:
    """The next version, with `kpi` and `top` put by key: genres of touched dates that `kpi` lacks stay, unless their date is one of
    `replaced`, which then holds nothing but the new rows (none, where there are none). Expired rows of touched dates go."""
    base, replaced = store.snapshot(spark), {*replaced}
    merged: dict[str, DataFrame] = {}
    touched: dict[str, set[str]] = {}
    for table, new in ((KPI, kpi), (TOP, top)):
        new = durable(new.select(*SCHEMAS[table].fieldNames()), checkpoints)
        touched[table] = {*_dates_of(new)} | replaced
        kept = store.read(spark, base, table, SCHEMAS[table], touched[table] - replaced)
        merged[table] = durable(merge_latest(serving.live(kept, now), new, KEYS[table]), checkpoints)
    made = [one for one in base.files if one.table == BY_GENRE or one.date not in touched[TOP if one.table == TOP else KPI]]
    # The ranking of a date and its items by genre are made from all items that the date now has.
    for table, rows in ((KPI, merged[KPI]), (TOP, merged[TOP]), (BY_GENRE, merged[KPI]), (RANKING, _ranking(merged[KPI]))):
        made += _write(store, table, rows)
    old = {one.load for one in base.of(BY_GENRE)}
    dead = marked_dead(base.dead, BY_GENRE, [(load, date, []) for load in old for date in touched[KPI]])
    return store.publish(spark, base, made, dead, notes)


# ---- Lookups: each opens only the files that can hold its rows

def items(spark: SparkSession, store: Store, now: datetime, snapshot: Snapshot | None = None, table: str = KPI) -> DataFrame:
    """The unexpired items of the version that the caller holds, or of the newest."""
    return serving.live(store.read(spark, snapshot or store.snapshot(spark), table, SCHEMAS[table]), now)


def _live(file: DataFile, now: datetime) -> bool:
    return file.high[EXPIRY] > epoch_seconds(now)


def point(spark: SparkSession, store: Store, genre: str, date: str, now: datetime, snapshot: Snapshot | None = None) -> DataFrame:
    snapshot = snapshot or store.snapshot(spark)
    found = store.read(spark, snapshot, KPI, SCHEMAS[KPI], [date], lambda file: file.may_hold("genre", genre) and _live(file, now))
    return serving.point(serving.live(found, now), genre, date)


def between(spark: SparkSession, store: Store, genre: str, now: datetime, first: str | None = None, last: str | None = None,
            snapshot: Snapshot | None = None) -> DataFrame:
    """One genre, oldest first, from the files of its range; all of its dates without `first` and `last`."""
    snapshot = snapshot or store.snapshot(spark)

    def may_hold(file: DataFile) -> bool:
        in_range = (first is None or file.high["date"] >= first) and (last is None or file.low["date"] <= last)
        return file.may_hold("genre", genre) and in_range and _live(file, now)

    found = serving.live(store.read(spark, snapshot, BY_GENRE, SCHEMAS[BY_GENRE], None, may_hold), now)
    found = found if first is None else found.where(F.col("date") >= first)
    return serving.trend(found if last is None else found.where(F.col("date") <= last), genre)


def top_on(spark: SparkSession, store: Store, date: str, now: datetime, n: int = schemas.TOP_GENRES, snapshot: Snapshot | None = None) -> DataFrame:
    """The `n` genres with the most plays on a date, from the ranking alone where it reaches so far."""
    snapshot = snapshot or store.snapshot(spark)
    table = RANKING if n <= RANKED else KPI
    # Rows that were put at different times expire at different times: then the ranking may lack some that move up.
    if any(file.low[EXPIRY] <= epoch_seconds(now) for file in snapshot.of(RANKING, [date])):
        table = KPI
    return serving.top_on(serving.live(store.read(spark, snapshot, table, SCHEMAS[table], [date]), now), date, n)


def snapshot_on(spark: SparkSession, store: Store, date: str, now: datetime, snapshot: Snapshot | None = None) -> DataFrame:
    """The stored top genres of a date, one row per rank."""
    found = store.read(spark, snapshot or store.snapshot(spark), TOP, SCHEMAS[TOP], [date])
    return serving.snapshot(serving.live(found, now), date)


# ---- Upkeep

def expire(spark: SparkSession, store: Store, now: datetime) -> tuple[Snapshot, list[str]]:
    """The next version, without expired rows, and the files that had to be opened for it: those that hold live rows too.
    Files of expired rows only leave by name, all others stay as they are."""
    base, limit = store.snapshot(spark), epoch_seconds(now)
    mixed = [one for one in base.files if one.low[EXPIRY] <= limit < one.high[EXPIRY]]
    made = [one for one in base.files if one.low[EXPIRY] > limit]
    if len(made) == len(base.files):
        return base, []
    dead = base.dead
    for table in SCHEMAS:
        opened = {one for one in mixed if one.table == table}
        if not opened:
            continue
        rows = serving.live(store.read(spark, base, table, SCHEMAS[table], None, lambda file: file in opened), now)
        if table == RANKING:
            # Items that move up are found among all live items of the date.
            dates = {one.date for one in opened}
            made = [one for one in made if one.table != RANKING or one.date not in dates]
            rows = _ranking(serving.live(store.read(spark, base, KPI, SCHEMAS[KPI], dates), now))
        made += _write(store, table, rows)
    return store.publish(spark, base, made, dead), sorted(one.path for one in mixed)


def compact_by_genre(spark: SparkSession, store: Store, now: datetime, checkpoints: str, most_loads: int = MOST_GENRE_LOADS) -> Snapshot:
    """The next version, with the loads of the layout by genre folded into one, if they are more than `most_loads`."""
    base = store.snapshot(spark)
    if len({one.load for one in base.of(BY_GENRE)}) <= most_loads:
        return base
    rows = durable(serving.live(store.read(spark, base, BY_GENRE, SCHEMAS[BY_GENRE]), now), checkpoints)
    others = [one for one in base.files if one.table != BY_GENRE]
    return store.publish(spark, base, others + _write(store, BY_GENRE, rows))
