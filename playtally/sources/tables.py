"""Date-partitioned tables on shared storage."""

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from playtally import schemas
from playtally.functions import parsing
from playtally.sources.files import exists


def replace_partitions(df: DataFrame, root: str, *partitions: str, fmt: str = "parquet") -> None:
    """Replace exactly the partitions of `root` that `df` has rows for."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .format(fmt)
        .save(root)
    )


def write_by_date(df: DataFrame, root: str, fmt: str = "parquet", date: str = "listen_date",
                  order: Iterable[str] = ()) -> None:
    """Replace the partitions of `root` for the dates in `df`; other dates stay untouched.

    Rebalancing gives each date a few well-sized files: small dates share a task, large ones are split.
    `order` sorts the rows within each file, so that lookups by those columns can skip row groups.
    """
    rebalanced = df.hint("rebalance", F.col(date))
    if order:
        rebalanced = rebalanced.sortWithinPartitions(date, *[name for name in order if name != date])
    replace_partitions(rebalanced, root, date, fmt=fmt)


def read_table(spark: SparkSession, root: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """The table at `root`, or an empty one when nothing was written yet.

    The schema is given, so a partition column of date text stays text.
    """
    try:
        return spark.read.schema(schema).format(fmt).load(root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def on_dates(df: DataFrame, dates: Iterable[str] | None, date: str = "listen_date") -> DataFrame:
    """Rows under date-shaped partitions, or only under the given dates; prunes partitions."""
    shaped = df.where(parsing.is_date_text(F.col(date)))
    return shaped if dates is None else shaped.where(F.col(date).isin(*dates))


def read_dates(spark: SparkSession, root: str, schema: StructType, dates: Iterable[str],
               date: str = "listen_date") -> DataFrame:
    """The rows of some dates of the table at `root`; no other date's folder is listed."""
    paths = [path for path in (f"{root}/{date}={one}" for one in dates) if exists(spark, path)]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*paths)


def read_kpis(spark: SparkSession, root: str, dates: Iterable[str] | None = None,
              fmt: str = "parquet") -> DataFrame:
    return on_dates(read_table(spark, root, schemas.GENRE_KPIS, fmt), dates)


def read_top_genres(spark: SparkSession, root: str, dates: Iterable[str] | None = None,
                    fmt: str = "parquet") -> DataFrame:
    return on_dates(read_table(spark, root, schemas.TOP_GENRE_ROWS, fmt), dates)
