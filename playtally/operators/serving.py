"""Serving items, their expiry, and the lookups over them."""

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtally import schemas
from playtally.functions.clock import epoch_seconds, iso_text


def _count_or_zero(name: str):
    return F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name)


def _stamps(now: datetime, ttl_days: int) -> list:
    return [
        F.lit(iso_text(now)).alias("processed_at"),
        F.lit(epoch_seconds(now, ttl_days)).cast("bigint").alias("ttl_expiry"),
    ]


def kpi_items(kpis: DataFrame, now: datetime, ttl_days: int = schemas.TTL_DAYS) -> DataFrame:
    """One item per (genre, date); absent numbers are 0, the average has two decimals rounded half up."""
    average = F.coalesce(F.col("avg_listen_time_ms").try_cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)"))
    songs = F.col("top_3_songs")
    if kpis.schema["top_3_songs"].dataType.typeName() != "string":
        songs = F.to_json(songs)
    return kpis.select(
        F.col("track_genre").alias("genre"),
        F.col("listen_date").alias("date"),
        _count_or_zero("listen_count"),
        _count_or_zero("unique_listeners"),
        _count_or_zero("total_listen_time_ms"),
        average.alias("avg_listen_time_ms"),
        F.coalesce(songs, F.lit(schemas.NO_SONGS)).alias("top_3_songs"),
        *_stamps(now, ttl_days),
    )


def top_genre_items(top: DataFrame, now: datetime, ttl_days: int = schemas.TTL_DAYS) -> DataFrame:
    """One item per date: its ranked genres as a JSON list in rank order."""
    genre = F.struct(
        F.col("rank").cast("bigint").alias("rank"),
        F.col("track_genre").alias("genre"),
        F.col("genre_listen_count").alias("listen_count"),
    )
    by_date = top.groupBy(F.col("listen_date").alias("date")).agg(
        F.to_json(F.array_sort(F.collect_list(genre))).alias("top_5_genres"))
    return by_date.select(
        F.lit(schemas.TOP_GENRES_RECORD).alias("record_type"), "date", "top_5_genres", *_stamps(now, ttl_days))


def live(items: DataFrame, now: datetime) -> DataFrame:
    """The items that have not expired."""
    return items.where(F.col("ttl_expiry") > F.lit(epoch_seconds(now)))


def point(items: DataFrame, genre: str, date: str) -> DataFrame:
    """The KPIs of one genre on one date."""
    return items.where((F.col("genre") == genre) & (F.col("date") == date))


def trend(items: DataFrame, genre: str) -> DataFrame:
    """All dates of one genre, oldest first."""
    return items.where(F.col("genre") == genre).orderBy("date")


def top_on(items: DataFrame, date: str, n: int = schemas.TOP_GENRES) -> DataFrame:
    """The `n` genres with the most plays on a date, ties by genre name."""
    return items.where(F.col("date") == date).orderBy(F.desc("listen_count"), "genre").limit(n)


def snapshot(items: DataFrame, date: str) -> DataFrame:
    """The stored top genres of a date, decoded to one row per rank."""
    decoded = F.from_json("top_5_genres", schemas.RANKED_GENRES)
    return (
        items.where((F.col("record_type") == schemas.TOP_GENRES_RECORD) & (F.col("date") == date))
        .select("date", F.inline(decoded))
    )


def between(items: DataFrame, genre: str, first: str, last: str) -> DataFrame:
    """One genre over a range of dates, both ends included."""
    return items.where((F.col("genre") == genre) & F.col("date").between(first, last))
