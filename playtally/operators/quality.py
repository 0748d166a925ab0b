"""Validation of a batch of raw events: exact counts over the whole input, then one verdict.

Inputs are raw text columns with null texts already turned into nulls. Two passes over the input give
every number: one grouped by whole rows, one over the distinct keys.
"""

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtally import schemas
from playtally.functions import parsing
from playtally.functions.clock import iso_text

COUNTED_ONLY = ("off_format_time", "off_type_user_id")
NULL_COUNTS = {name: f"null_{name}" for name in schemas.REQUIRED_COLUMNS}


def missing_columns(raw: DataFrame) -> list[str]:
    return sorted(set(schemas.REQUIRED_COLUMNS) - set(raw.columns))


def _rows_where(condition: Column, weight: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, weight)), F.lit(0)).cast("bigint")


def _metric_columns(weight: Column) -> list[Column]:
    null_counts = [_rows_where(F.col(name).isNull(), weight).alias(alias)
                   for name, alias in NULL_COUNTS.items()]
    time = F.col("listen_time")
    return [
        F.coalesce(F.sum(weight), F.lit(0)).cast("bigint").alias("record_count"),
        *null_counts,
        _rows_where(~parsing.is_number(F.col("user_id")), weight).alias("invalid_user_id"),
        _rows_where(parsing.is_number(F.col("user_id")) & parsing.parse_int(F.col("user_id")).isNull(), weight).alias(
            "off_type_user_id"),
        _rows_where(~parsing.is_track_id(F.col("track_id")), weight).alias("invalid_track_id"),
        _rows_where(parsing.parse_any_datetime(time).isNull(), weight).alias("unparseable_time"),
        _rows_where(parsing.parse_listen_time(time).isNull(), weight).alias("off_format_time"),
    ]


def quality_metrics(raw: DataFrame) -> DataFrame:
    """One row: record count, nulls per column, and badly typed values, from one scan."""
    return raw.agg(*_metric_columns(F.lit(1)))


def _distinct_rows(raw: DataFrame) -> DataFrame:
    """Each different row once, with how often it occurs; copies merge before the shuffle."""
    return raw.groupBy(*[F.col(f"`{name}`") for name in raw.columns]).agg(F.count(F.lit(1)).alias("_copies"))


def _repeats() -> Column:
    return F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows")


def duplicate_rows(raw: DataFrame) -> DataFrame:
    """One row: how many rows repeat an earlier row in all columns."""
    return _distinct_rows(raw).agg(_repeats())


def _agg(df: DataFrame, by: tuple[str, ...], columns: list[Column]) -> DataFrame:
    return df.groupBy(*by).agg(*columns) if by else df.agg(*columns)


def row_metrics(raw: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """`quality_metrics` and `duplicate_rows` together, parsing each different row once."""
    return _agg(_distinct_rows(raw), by, [*_metric_columns(F.col("_copies")), _repeats()])


def _tagged_keys(df: DataFrame, keys: dict[str, str], by: tuple[str, ...] = ()) -> DataFrame:
    """Distinct (kind, key) pairs of `df` as comparable text; absent keys are left out."""
    texts = {kind: F.col(key).cast("string") for kind, key in keys.items()}
    if "user" in texts:
        texts["user"] = parsing.key_text(texts["user"])
    pairs = F.array(*[F.struct(F.lit(kind).alias("kind"), text.alias("key")) for kind, text in texts.items()])
    return df.select(*by, F.inline(pairs)).where(F.col("key").isNotNull()).distinct()


def _share(unknown: Column, distinct: Column) -> Column:
    return F.when(distinct > 0, unknown / distinct).otherwise(F.lit(0.0))


def key_coverage(events: DataFrame, references: dict[str, tuple[str, DataFrame]],
                 by: tuple[str, ...] = ()) -> DataFrame:
    """Per kind: `distinct_<kind>s` keys in the events and how many of them (`unknown_<kind>s`) its
    reference lacks. `references` maps a kind to (key column, reference frame).

    All kinds share one pass. Both sides are distinct before they meet, so no key is hot in the join.
    """
    ours = _tagged_keys(events, {kind: key for kind, (key, _) in references.items()}, by)
    known = reduce(DataFrame.unionByName, [_tagged_keys(ref, {kind: key}) for kind, (key, ref) in references.items()])
    matched = ours.join(known.withColumn("_known", F.lit(True)), ["kind", "key"], "left")
    columns = []
    for kind in references:
        of_kind = F.col("kind") == kind
        columns.append(F.count_if(of_kind).alias(f"distinct_{kind}s"))
        columns.append(F.count_if(of_kind & F.col("_known").isNull()).alias(f"unknown_{kind}s"))
    return _agg(matched, by, columns)


def unknown_users(events: DataFrame, users: DataFrame) -> DataFrame:
    """One row: distinct users, those the reference lacks, and their share."""
    return key_coverage(events, {"user": ("user_id", users)}).withColumn(
        "unknown_user_pct", F.bround(_share(F.col("unknown_users"), F.col("distinct_users")), 4))


def unknown_tracks(events: DataFrame, songs: DataFrame) -> DataFrame:
    """One row: distinct tracks, those the reference lacks, and their share."""
    return key_coverage(events, {"track": ("track_id", songs)}).withColumn(
        "unknown_track_pct", F.bround(_share(F.col("unknown_tracks"), F.col("distinct_tracks")), 4))


def validation_metrics(raw: DataFrame, songs: DataFrame | None, users: DataFrame | None,
                       by: tuple[str, ...] = ()) -> DataFrame:
    """One row (per value of `by`) with every number the verdict needs. Without reference tables the
    coverage is null."""
    rows = row_metrics(raw, by)
    coverage_columns = ["distinct_users", "unknown_users", "distinct_tracks", "unknown_tracks"]
    if songs is None or users is None:
        return rows.select("*", *[F.lit(None).cast("bigint").alias(name) for name in coverage_columns])
    coverage = key_coverage(raw, {"user": ("user_id", users), "track": ("track_id", songs)}, by)
    # Each part has a single row with its own columns, so taking the maximum lays them side by side.
    parts = rows.unionByName(coverage, allowMissingColumns=True)
    names = [name for name in rows.columns + coverage_columns if name not in by]
    return _agg(parts, by, [F.coalesce(F.max(name), F.lit(0)).alias(name) for name in names])


def _percent(share: Column, decimals: int) -> Column:
    return F.bround(share * 100, decimals)


def _error_texts(bad_time_share: Column, user_share: Column, track_share: Column) -> Column:
    """The messages of the checks that failed, in check order."""
    checks = [(F.col(alias) > 0, F.format_string(schemas.NULLS_TEXT, F.lit(name), F.col(alias)))
              for name, alias in NULL_COUNTS.items()]
    checks += [
        (F.col("invalid_user_id") > 0, F.format_string(schemas.USER_ID_TEXT, F.col("invalid_user_id"))),
        (F.col("invalid_track_id") > 0, F.format_string(schemas.TRACK_ID_TEXT, F.col("invalid_track_id"))),
        (bad_time_share > schemas.UNPARSEABLE_TIME_LIMIT, F.format_string(
            schemas.LISTEN_TIME_TEXT, F.col("unparseable_time"), _percent(bad_time_share, 2))),
        (user_share > schemas.UNKNOWN_KEY_LIMIT, F.format_string(
            schemas.UNKNOWN_USERS_TEXT, _percent(user_share, 1), F.col("unknown_users"))),
        (track_share > schemas.UNKNOWN_KEY_LIMIT, F.format_string(
            schemas.UNKNOWN_TRACKS_TEXT, _percent(track_share, 1), F.col("unknown_tracks"))),
    ]
    return F.array_compact(F.array(*[F.when(failed, text) for failed, text in checks]))


def _schema_report(raw: DataFrame, missing: list[str], now: datetime) -> DataFrame:
    message = schemas.MISSING_COLUMNS_TEXT.format(missing)
    return raw.agg(F.count(F.lit(1)).alias("record_count")).select(
        F.lit(schemas.FAILED).alias("status"),
        "record_count",
        F.array(F.lit(message)).alias("errors"),
        F.lit(iso_text(now)).alias("validated_at"),
    )


def _judge(metrics: DataFrame, input_key: Column, now: datetime) -> DataFrame:
    counts = F.create_map(*[part for name, alias in NULL_COUNTS.items() for part in (F.lit(name), F.col(alias))])
    bad_time_share = _share(F.col("unparseable_time"), F.col("record_count"))
    # The share of unknown keys is null, and so never above the limit, without reference tables.
    user_share = F.when(F.col("distinct_users").isNotNull(), _share(F.col("unknown_users"), F.col("distinct_users")))
    track_share = F.when(F.col("distinct_tracks").isNotNull(),
                         _share(F.col("unknown_tracks"), F.col("distinct_tracks")))
    judged = metrics.withColumn("errors", _error_texts(bad_time_share, user_share, track_share))
    return judged.select(
        F.when(F.size("errors") > 0, schemas.FAILED).otherwise(schemas.PASSED).alias("status"),
        input_key.alias("input_key"),
        "record_count",
        counts.alias("null_counts"),
        F.bround(user_share, 4).alias("unknown_user_pct"),
        F.bround(track_share, 4).alias("unknown_track_pct"),
        "duplicate_rows",
        "errors",
        F.lit(iso_text(now)).alias("validated_at"),
        "off_format_time",
        "off_type_user_id",
    )


def validation_verdict(raw: DataFrame, songs: DataFrame | None, users: DataFrame | None, now: datetime,
                       input_key: str) -> DataFrame:
    """One row: the report columns, and COUNTED_ONLY: accepted rows that will belong to no day, and numeric user
    ids that are no int (1.5, 3000000000) and so become absent users.

    Missing columns end the checks. Duplicates and absent reference tables are reported, not failed.
    """
    missing = missing_columns(raw)
    if missing:
        return _schema_report(raw, missing, now)
    return _judge(validation_metrics(raw, songs, users), F.lit(input_key), now)


def file_verdicts(raw: DataFrame, songs: DataFrame | None, users: DataFrame | None, now: datetime,
                  file: str) -> DataFrame:
    """The verdict on each file of a batch, told apart by column `file`, in one job for all of them."""
    return _judge(validation_metrics(raw, songs, users, (file,)), F.col(file), now)


def validation_report(raw: DataFrame, songs: DataFrame | None, users: DataFrame | None, now: datetime,
                      input_key: str) -> DataFrame:
    """One row: the verdict over the whole batch with its numbers and messages."""
    return validation_verdict(raw, songs, users, now, input_key).drop(*COUNTED_ONLY)
