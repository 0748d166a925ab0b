"""Daily KPIs per genre.

One pass leads to the grain (user, genre, day), from which every number of a (genre, day) follows. Plays and total time
by themselves need no grain and are counted by (genre, day) directly.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playtally import schemas

GENRE_DAY = ("track_genre", "listen_date")


def listen_count(enriched: DataFrame) -> DataFrame:
    """Plays per genre and day: one small shuffle, whatever the listeners."""
    return enriched.groupBy(*GENRE_DAY).agg(F.count(F.lit(1)).alias("listen_count"))


def unique_listeners(enriched: DataFrame) -> DataFrame:
    return genre_metrics(user_grain(enriched)).select(*GENRE_DAY, "unique_listeners")


def total_listen_time(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy(*GENRE_DAY).agg(F.sum("duration_ms").alias("total_listen_time_ms"))


def user_totals(enriched: DataFrame) -> DataFrame:
    """Listening time per user, genre and day; plays without a user form one group."""
    return user_grain(enriched).select("user_id", *GENRE_DAY, F.col("listened_ms").alias("user_total_ms"))


def avg_listen_time(enriched: DataFrame) -> DataFrame:
    return genre_metrics(user_grain(enriched)).select(*GENRE_DAY, "avg_listen_time_ms")


def user_grain(enriched: DataFrame) -> DataFrame:
    """Plays and listening time per user, genre and day. A hot genre is spread over its listeners."""
    return enriched.groupBy("user_id", *GENRE_DAY).agg(
        F.count(F.lit(1)).alias("plays"),
        F.sum("duration_ms").alias("listened_ms"),
    )


def genre_metrics(grain: DataFrame) -> DataFrame:
    """The four numbers of a (genre, day). Plays without a user count in the average as one listener."""
    return grain.groupBy(*GENRE_DAY).agg(
        F.sum("plays").alias("listen_count"),
        F.count("user_id").alias("unique_listeners"),
        F.sum("listened_ms").alias("total_listen_time_ms"),
        # A sum of whole numbers is exact in any order, an average of doubles is not.
        F.round(F.try_divide(F.sum("listened_ms"), F.count("listened_ms")), 2).alias("avg_listen_time_ms"),
    )


def song_plays(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy(*GENRE_DAY, "track_id", "track_name").agg(
        F.count(F.lit(1)).alias("song_listen_count"))


def top_songs(plays: DataFrame, n: int = schemas.TOP_SONGS) -> DataFrame:
    """The `n` most played songs of each (genre, day), ties by track id.

    The rank filter sits directly on the window, so each task passes on at most `n` rows per group.
    """
    order = Window.partitionBy(*GENRE_DAY).orderBy(F.desc("song_listen_count"), "track_id", "track_name")
    return plays.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def top_songs_json(top: DataFrame) -> DataFrame:
    """The ranked songs of each (genre, day) as one JSON list in rank order; absent names are left out."""
    song = F.struct("rank", "track_id", "track_name", "song_listen_count")
    ranked = F.array_sort(F.collect_list(song))
    return top.groupBy(*GENRE_DAY).agg(
        F.to_json(ranked, {"ignoreNullFields": "true"}).alias("top_3_songs"))


def genre_plays(counts: DataFrame) -> DataFrame:
    """Plays per day and genre, from any frame that already has listen_count."""
    return counts.select("listen_date", "track_genre", F.col("listen_count").alias("genre_listen_count"))


def top_genres(counts: DataFrame, n: int = schemas.TOP_GENRES) -> DataFrame:
    """The `n` most played genres of each day, ties by genre name."""
    order = Window.partitionBy("listen_date").orderBy(F.desc("genre_listen_count"), "track_genre")
    return genre_plays(counts).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def merge_kpis(metrics: DataFrame, songs_json: DataFrame) -> DataFrame:
    """The full KPI row of each (genre, day)."""
    merged = metrics.join(songs_json, list(GENRE_DAY), "left")
    return merged.withColumn("top_3_songs", F.coalesce("top_3_songs", F.lit(schemas.NO_SONGS))).select(
        *schemas.GENRE_KPIS.fieldNames())


def genre_kpis(enriched: DataFrame) -> DataFrame:
    """All KPIs of each (genre, day) from enriched events; those without a day belong to no row."""
    enriched = enriched.where(F.col("listen_date").isNotNull())
    return merge_kpis(genre_metrics(user_grain(enriched)), top_songs_json(top_songs(song_plays(enriched))))


def distinct_dates(kpis: DataFrame) -> DataFrame:
    return kpis.select("listen_date").distinct()
