"""CSV inputs. Columns are found by header name and read as text, so nothing depends on inference."""

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playtally.functions import parsing


def read_raw_events(spark: SparkSession, path: str) -> DataFrame:
    """Every column of an event file as text, with the null texts as nulls. Files stay splittable."""
    raw = spark.read.csv(path, header=True, escape='"')
    return raw.select([parsing.null_if_token(F.col(f"`{name}`")).alias(name) for name in raw.columns])


def header_of(line: str | None) -> list[str]:
    """The column names in a header line."""
    return next(csv.reader([line.lstrip("\ufeff")]), []) if line else []


def read_raw_files(spark: SparkSession, paths: list[str], header: list[str], file: str, extra: str) -> DataFrame:
    """Several event files with one and the same header: every column as text, the file's path in column `file`,
    and in `extra` whether the row has more cells than the header. Missing cells are null; files stay splittable."""
    names = [f"_{i}" for i in range(len(header))]
    schema = ", ".join(f"{name} string" for name in [*names, "_more"])
    # Empty cells stay texts while they are read, so that an empty cell too many differs from none.
    raw = spark.read.schema(schema).csv(paths, header=True, escape='"', nullValue="\0", emptyValue="")
    cells = [parsing.null_if_token(F.col(name)).alias(title) for name, title in zip(names, header)]
    # The reader hands out names as in a URL, where a plain plus would mean a blank.
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return raw.select(*cells, path.alias(file), F.col("_more").isNotNull().alias(extra))


def type_events(raw: DataFrame, *others: str) -> DataFrame:
    """The three event columns with their types, and `others` as they are; text that does not parse
    becomes null."""
    return raw.select(
        parsing.parse_int(F.col("user_id")).alias("user_id"),
        F.col("track_id"),
        parsing.parse_listen_time(F.col("listen_time")).alias("listen_time"),
        *others,
    )


def usable_rows(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The raw rows that belong to a day, and those that have no usable listen_time."""
    usable = parsing.parse_listen_time(F.col("listen_time")).isNotNull()
    return raw.where(usable), raw.where(~usable)


def split_events(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed events, and the raw rows that have no usable listen_time and so belong to no day."""
    usable, rejects = usable_rows(raw)
    return type_events(usable), rejects


def read_streams(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(events, rejects) of one event file or folder; the events are not yet deduplicated."""
    return split_events(read_raw_events(spark, path))


def _read_reference(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    return spark.read.csv(path, header=True, escape='"', multiLine=multi_line)


def read_songs(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """The song reference. Titles may hold line breaks, which ties each file to one task; a very large
    reference without them reads in parallel with `multi_line=False`."""
    return _read_reference(spark, path, multi_line).select(
        "track_id",
        "track_name",
        "track_genre",
        parsing.parse_long(F.col("duration_ms")).alias("duration_ms"),
        "artists",
        "album_name",
    )


def read_users(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return _read_reference(spark, path, multi_line).select(
        parsing.parse_int(F.col("user_id")).alias("user_id"),
        "user_country",
    )


def read_users_with_key(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """The user reference, and the text of each user_id as it stands there."""
    return _read_reference(spark, path, multi_line).select(
        parsing.parse_int(F.col("user_id")).alias("user_id"), "user_country", F.col("user_id").alias("user_key"))


def read_reference_keys(spark: SparkSession, path: str, key: str, multi_line: bool = True) -> DataFrame:
    """The key column of a reference file as raw text, for validation."""
    return _read_reference(spark, path, multi_line).select(key)
