"""Keyed serving tables: Parquet partitioned by date, one row per key, last write wins."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from playtally.functions.clock import epoch_seconds
from playtally.functions.durable import durable
from playtally.operators.merging import merge_latest
from playtally.operators.serving import live
from playtally.sources.files import delete
from playtally.sources.tables import read_table, write_by_date


def _touched(existing: DataFrame, new: DataFrame, first: str, last: str, date: str) -> DataFrame:
    """The rows of `existing` that share a date with `new`, whose dates lie between `first` and `last`.

    The range prunes partitions when the plan is made; the semi join keeps exactly the touched dates.
    """
    in_span = existing.where(F.col(date).between(first, last))
    return in_span.join(new.select(date).distinct(), date, "left_semi")


def upsert(new: DataFrame, root: str, schema: StructType, keys: tuple[str, ...], now: datetime,
           checkpoints: str, version: str = "processed_at", date: str = "date") -> None:
    """Put every row of `new` by key. Keys of the same dates that `new` lacks stay; expired ones go.

    `new` is read more than once, so it should come from a stored table. The merged rows are made durable
    before the table is touched, so a write that fails half-way can be repeated from them.
    """
    new = new.select(*schema.fieldNames())
    span = new.agg(F.min(date).alias("first"), F.max(date).alias("last")).first()
    if span["first"] is None:
        return
    existing = live(read_table(new.sparkSession, root, schema), now)
    touched = _touched(existing, new, span["first"], span["last"], date)
    merged = durable(merge_latest(touched, new, keys, version), checkpoints)
    write_by_date(merged, root, date=date, order=keys)


def compact(spark: SparkSession, root: str, schema: StructType, keys: tuple[str, ...], now: datetime,
            checkpoints: str, date: str = "date") -> None:
    """Rewrite the dates that hold both expired and live rows, and remove those that hold expired ones only.

    Reads skip expired rows in any case. A run that breaks off can be repeated.
    """
    stored = read_table(spark, root, schema)
    stale = stored.where(F.col("ttl_expiry") <= F.lit(epoch_seconds(now))).select(date).distinct()
    kept = durable(live(stored, now).join(stale, date, "left_semi"), checkpoints)
    # Dates are a calendar's worth of names, whatever the rows. Both are known before any file is replaced.
    last = stored.groupBy(date).agg(F.max("ttl_expiry").alias("last")).where(F.col("last") <= F.lit(epoch_seconds(now)))
    gone = [row[0] for row in last.select(date).collect()]
    write_by_date(kept, root, date=date, order=keys)
    for day in gone:
        delete(spark, f"{root}/{date}={day}")
