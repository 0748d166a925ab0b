"""The daily KPI plan over raw inputs, shaped for very large event sets.

Events shuffle twice: once to remove copies, once to the grain (user, genre, day). The rest is small:

* Only the user grain needs the event-sized song join. Song plays are counted per (track, day) first and
  joined afterwards, so a hot track is one row per day there.
* Country is in no KPI. A user listed k times would still multiply that user's plays by k, so the plan
  carries that factor instead of joining the users; it is 1 for everybody when users are unique.
* Days are dates while the data moves, and become text in the result only.
* Both branches read the same deduplicating shuffle. For that they must filter alike, so the input says that
  a play has a day; the optimizer would otherwise add this to one side of the final left join only.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtally.functions import parsing
from playtally.functions.counts import StageCounts
from playtally.operators import kpis
from playtally.operators.enrich import dedup_events, duration_or_zero, genre_or_unknown
from playtally.operators.joins import fits_broadcast, hot_keys, left_join_reference, measured_bytes

_Watch = Callable[[str, DataFrame], DataFrame]


def repeated_users(users: DataFrame) -> DataFrame:
    """The users listed more than once, with how often."""
    return (
        users.where(F.col("user_id").isNotNull())
        .groupBy("user_id").agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )


def with_copies(plays: DataFrame, repeated: DataFrame, repeated_bytes: int, hot: list | None = None) -> DataFrame:
    if repeated_bytes == 0:
        return plays.withColumn("copies", F.lit(1).cast("bigint"))
    joined = left_join_reference(plays, repeated, "user_id", fits_broadcast(repeated_bytes), hot=hot)
    return joined.withColumn("copies", F.coalesce("copies", F.lit(1).cast("bigint")))


def user_grain(plays: DataFrame, songs: DataFrame, broadcast: bool, watch: _Watch, hot: list | None = None) -> DataFrame:
    by_track = watch("songs", songs.select("track_id", "track_genre", "duration_ms"))
    joined = watch("enriched", left_join_reference(plays, by_track, "track_id", broadcast, hot=hot))
    return joined.groupBy("user_id", genre_or_unknown().alias("track_genre"), "listen_date").agg(
        F.sum("copies").alias("plays"),
        F.sum(duration_or_zero() * F.col("copies")).alias("listened_ms"),
    )


def track_days(plays: DataFrame) -> DataFrame:
    return plays.groupBy("track_id", "listen_date").agg(F.sum("copies").alias("plays"))


def titled_plays(track_days: DataFrame, songs: DataFrame, broadcast: bool) -> DataFrame:
    """Plays per genre, day and song. Equal listings of a track are merged beforehand, so the joined rows
    are already one per group."""
    titles = songs.groupBy("track_id", genre_or_unknown().alias("track_genre"), "track_name").agg(
        F.count(F.lit(1)).alias("listings"))
    joined = left_join_reference(track_days, titles, "track_id", broadcast, salts=1)
    return joined.select(
        genre_or_unknown().alias("track_genre"), "listen_date", "track_id", "track_name",
        (F.col("plays") * F.coalesce("listings", F.lit(1).cast("bigint"))).alias("song_listen_count"),
    )


def daily_kpis(events: DataFrame, songs: DataFrame, users: DataFrame,
               counts: StageCounts | None = None) -> DataFrame:
    """All KPIs of each (genre, day); the same rows as `genre_kpis(enrich(dedup_events(...)))`.

    `counts` receives the rows of the streams (deduplicated), songs, users and enriched stages, without a
    job of its own; users that are listed repeatedly do not add to the enriched rows it reports.
    """
    watch: _Watch = (lambda name, df: df) if counts is None else counts.watch
    deduplicated = dedup_events(events.where(F.to_date("listen_time").isNotNull()))
    repeated = repeated_users(watch("users", users))
    songs_bytes, repeated_bytes = measured_bytes(
        songs.select("track_id", "track_name", "track_genre", "duration_ms"), repeated)
    broadcast = fits_broadcast(songs_bytes)
    # Hot keys are counted before the copies are removed: that needs the key column only, not the shuffle of the plays.
    hot_tracks = [] if broadcast else hot_keys(events, "track_id")
    hot_users = [] if fits_broadcast(repeated_bytes) else hot_keys(events, "user_id")

    def by_day(plays: DataFrame) -> DataFrame:
        # The time stays only to spread a hot (track, user, day) over the salts of the song join.
        dated = plays.select("user_id", "track_id", F.to_date("listen_time").alias("listen_date"), "listen_time")
        return with_copies(dated, repeated, repeated_bytes, hot_users)

    # Only one branch is watched; the shuffle below stays common to both.
    grain = user_grain(by_day(watch("streams", deduplicated)), songs, broadcast, watch, hot_tracks)
    plays = titled_plays(track_days(by_day(deduplicated)), songs, broadcast)
    merged = kpis.merge_kpis(kpis.genre_metrics(grain), kpis.top_songs_json(kpis.top_songs(plays)))
    return merged.withColumn("listen_date", parsing.listen_date(F.col("listen_date")))
