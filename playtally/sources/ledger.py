"""Which version of which file was taken, and what came of it. A version is a path, a time and a length."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playtally.sources.files import Source
from playtally.sources.tables import read_table

SCHEMA = "path string, modified bigint, length bigint, outcome string, dates array<string>"
DONE, WITHDRAWN = "done", "withdrawn"


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, SCHEMA)


def append(spark: SparkSession, root: str, entries: list[tuple[Source, str, list[str]]]) -> None:
    """Record the outcome of a batch in one file, so that it counts as a whole or not at all."""
    rows = [(*source, outcome, dates) for source, outcome, dates in entries]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(root)


def outcomes(spark: SparkSession, root: str, sources: list[Source]) -> dict[Source, str]:
    """What came of those of `sources` that were taken before; a withdrawn version stays withdrawn."""
    if not sources:
        return {}
    listed = spark.createDataFrame([tuple(source) for source in sources], "path string, modified bigint, length bigint")
    known = read_ledger(spark, root).join(listed, ["path", "modified", "length"], "left_semi")
    found: dict[Source, str] = {}
    for row in known.collect():
        source = Source(row["path"], row["modified"], row["length"])
        if found.get(source) != WITHDRAWN:
            found[source] = row["outcome"]
    return found


def earlier_dates(spark: SparkSession, root: str, paths: list[str]) -> list[str]:
    """The dates that earlier versions of some files had plays on."""
    of_paths = read_ledger(spark, root).where(F.col("path").isin(paths))
    return of_paths.agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("dates")))).alias("dates")).first()["dates"] or []


def withdraw(spark: SparkSession, root: str, paths: list[str]) -> None:
    """Record, in one file, that all versions of some paths taken so far were withdrawn."""
    taken = read_ledger(spark, root).where(F.col("path").isin(paths)).select("path", "modified", "length").distinct()
    append(spark, root, [(Source(*row), WITHDRAWN, []) for row in taken.collect()])
