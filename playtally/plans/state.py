"""Daily KPIs kept as sums, so that a late file adds to them and a replaced one subtracts.

Two grains are stored by date next to the events: plays and listening time by (user, genre, day), and plays by (track, day). A
batch changes a distinct play only if no other file holds it: the plays of its files (new and earlier versions) are
compared with the rest of the archive on the touched dates, +1 for those that appear, -1 for those that vanish. Only
the grains of these few plays are written; reading adds up. Sums over a whole number of plays are exact, so
the KPIs equal those of a computation from all files, whatever the order of arrival.

Genres and lengths come from the references. The version of these is noted by date; where it has changed, the date's
grains are made anew from its archived events.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtally import schemas
from playtally.functions import parsing
from playtally.functions.durable import durable
from playtally.operators import kpis
from playtally.operators.joins import fits_broadcast, measured_bytes
from playtally.plans.daily import repeated_users, titled_plays, track_days, user_grain, with_copies
from playtally.sources import event_archive
from playtally.sources.event_archive import crowded_dates
from playtally.sources.manifest import Snapshot, Store, marked_dead

USER_GRAIN, TRACK_DAYS = "user_grain", "track_days"
PLAY = (*schemas.REQUIRED_COLUMNS, "listen_date")
_GRAINS = {
    USER_GRAIN: T.StructType([T.StructField("user_id", T.IntegerType()), T.StructField("track_genre", T.StringType()),
                              T.StructField("listen_date", T.StringType()), T.StructField("plays", T.LongType()), T.StructField("listened_ms", T.LongType())]),
    TRACK_DAYS: T.StructType([T.StructField("track_id", T.StringType()), T.StructField("listen_date", T.StringType()), T.StructField("plays", T.LongType())]),
}


def songs_for_kpis(songs: DataFrame) -> DataFrame:
    return songs.select("track_id", "track_name", "track_genre", "duration_ms")


@dataclass(frozen=True)
class References:
    """Songs and users, and a name for their version. Sizes are measured once, here."""

    songs: DataFrame
    users: DataFrame
    version: str
    broadcast_songs: bool
    repeated: DataFrame
    repeated_bytes: int

    @classmethod
    def measured(cls, songs: DataFrame, users: DataFrame, version: str, songs_bytes: int, repeated: DataFrame, repeated_bytes: int) -> References:
        return cls(songs_for_kpis(songs), users, version, fits_broadcast(songs_bytes), repeated, repeated_bytes)

    @classmethod
    def of(cls, songs: DataFrame, users: DataFrame, version: str) -> References:
        repeated = repeated_users(users)
        songs_bytes, repeated_bytes = measured_bytes(songs_for_kpis(songs), repeated)
        return cls.measured(songs, users, version, songs_bytes, repeated, repeated_bytes)


@dataclass(frozen=True)
class Change:
    """What a batch did: the dates by file, all dates whose KPIs can differ, and those that are left without events."""

    snapshot: Snapshot
    by_file: dict[str, list[str]]
    touched: list[str]
    emptied: list[str]


def _same_play(left: DataFrame, right: DataFrame, broadcast_right: bool, how: str) -> DataFrame:
    right = right.select(*[F.col(name).alias(f"_{name}") for name in PLAY])
    # The day takes part as a plain key; absent users and tracks are equal to each other.
    same = [left["listen_date"] == right["_listen_date"], left["listen_time"] == right["_listen_time"],
            left["user_id"].eqNullSafe(right["_user_id"]), left["track_id"].eqNullSafe(right["_track_id"])]
    return left.join(F.broadcast(right) if broadcast_right else right, same, how)


def play_changes(new: DataFrame, old: DataFrame, others: DataFrame, checkpoints: str) -> DataFrame:
    """The distinct plays that appear (sign 1) or vanish (sign -1) when files that held `old` hold `new`; plays that `others` hold too
    stay. Few changed plays are sent to the rest of the archive, which is then read without a shuffle."""
    both = new.select(*PLAY, F.lit(1).alias("sign")).unionByName(old.select(*PLAY, F.lit(-1).alias("sign")))
    # Copies within one side count once; a play on both sides stays as it is.
    changed = durable(both.distinct().groupBy(*PLAY).agg(F.sum("sign").cast("int").alias("sign")).where("sign <> 0"), checkpoints)
    small = fits_broadcast(*measured_bytes(changed))
    held = others.select(*PLAY)
    if small:
        held = durable(_same_play(held, changed, True, "left_semi").distinct(), checkpoints)
    return _same_play(changed, held, False, "left_anti")


def _grains_of(plays: DataFrame, refs: References) -> dict[str, DataFrame]:
    """Both grains of signed distinct plays."""
    counted = with_copies(plays, refs.repeated, refs.repeated_bytes).withColumn("copies", F.col("copies") * F.col("sign")).drop("sign")
    return {USER_GRAIN: user_grain(counted, refs.songs, refs.broadcast_songs, lambda _, df: df).where("plays <> 0 or listened_ms <> 0"),
            TRACK_DAYS: track_days(counted).where("plays <> 0")}


def take_in(spark: SparkSession, store: Store, events: DataFrame, names: Iterable[str], refs: References, checkpoints: str,
            also: Iterable[str] = ()) -> Change:
    """Put the events (typed, with file_name) of some files in place of what these files held before; files without events
    are withdrawn. Dates of `also` count as touched too. Published in one step; a repeat changes nothing."""
    names, base = [*names], store.snapshot(spark)
    dated = events.withColumn("listen_date", parsing.listen_date(F.col("listen_time")))
    new = durable(dated.select(*event_archive.ARCHIVED.fieldNames()), checkpoints)
    by_file = {row["file_name"]: row["dates"] for row in new.groupBy("file_name").agg(
        F.array_sort(F.collect_set("listen_date")).alias("dates")).collect()}
    held = event_archive.earlier(spark, store, base, names)
    old_dates = {date for _, date, _ in held}
    touched = sorted({date for dates in by_file.values() for date in dates} | old_dates | {*also})
    mine = F.col("file_name").isin(names)
    old = event_archive.read_archived(spark, store, base, old_dates).where(mine)
    others = event_archive.read_archived(spark, store, base, touched).where(~mine)
    noted = dict(base.notes.get("references", {}))
    stale = [date for date in touched if noted.get(date, refs.version) != refs.version]
    fresh = ~F.col("listen_date").isin(stale) if stale else F.lit(True)
    signed = play_changes(new.where(fresh), old.where(fresh), others.where(fresh), checkpoints)
    if stale:
        anew = new.select(*PLAY).unionByName(others.select(*PLAY)).where(~fresh).distinct().withColumn("sign", F.lit(1))
        signed = signed.unionByName(anew)
    signed = durable(signed, checkpoints)
    made, dead = [*base.files, *event_archive.append(store, new)], event_archive.without(base.dead, held)
    for table, grain in _grains_of(signed, refs).items():
        dead = marked_dead(dead, table, [(one.load, one.date, []) for one in base.of(table, stale)])
        made += store.write(grain.select(*_GRAINS[table].fieldNames()), table, "listen_date")
    rest = event_archive.members(spark, store, base).where(F.col("listen_date").isin(touched) & ~mine)
    left = {row[0] for row in rest.select("listen_date").distinct().collect()} | {d for dates in by_file.values() for d in dates}
    notes = {**base.notes, "references": {date: noted for date, noted in (noted | dict.fromkeys(touched, refs.version)).items() if date in left or date not in touched}}
    return Change(store.publish(spark, base, made, dead, notes), by_file, [d for d in touched if d in left], [d for d in touched if d not in left])


def _sums(spark: SparkSession, store: Store, snapshot: Snapshot, table: str, dates: Iterable[str] | None) -> DataFrame:
    stored = store.read(spark, snapshot, table, _GRAINS[table], dates, date="listen_date")
    keys = [name for name in stored.columns if name not in ("plays", "listened_ms")]
    sums = [F.sum(name).alias(name) for name in stored.columns if name not in keys]
    return stored.groupBy(*keys).agg(*sums).where("plays <> 0")


def state_kpis(spark: SparkSession, store: Store, refs: References, dates: Iterable[str] | None = None, snapshot: Snapshot | None = None) -> DataFrame:
    """All KPIs of some dates (or all) from the stored sums; the same rows as `daily_kpis` over the valid events of all files."""
    snapshot, dates = snapshot or store.snapshot(spark), None if dates is None else [*dates]
    metrics = kpis.genre_metrics(_sums(spark, store, snapshot, USER_GRAIN, dates))
    plays = titled_plays(_sums(spark, store, snapshot, TRACK_DAYS, dates), refs.songs, refs.broadcast_songs)
    return kpis.merge_kpis(metrics, kpis.top_songs_json(kpis.top_songs(plays)))


def compact(spark: SparkSession, store: Store, checkpoints: str, most_loads: int = event_archive.MOST_LOADS) -> Snapshot:
    """The next version, in which the events and the sums of each date of more than `most_loads` loads are in one."""
    base = event_archive.compact(spark, store, checkpoints, most_loads)
    made, dead = [*base.files], base.dead
    for table in _GRAINS:
        dates = crowded_dates(base, table, most_loads)
        if dates:
            rows = durable(_sums(spark, store, base, table, dates), checkpoints)
            made = [one for one in made if one.table != table or one.date not in dates]
            made += store.write(rows.select(*_GRAINS[table].fieldNames()), table, "listen_date")
    return base if len(made) == len(base.files) and made == [*base.files] else store.publish(spark, base, made, dead)
