"""Where failed files and unusable rows go. Every write can be repeated without duplicating anything."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playtally import schemas
from playtally.sources.tables import replace_partitions


def write_dead_letters(lines: DataFrame, errors: dict[str, list[str]], stage: str, root: str) -> None:
    """Keep every line of some failed files (columns `value` and `file_name`), with the stage that failed and why.

    `errors` has the whole error texts by file. A file without a line gets one without text, so that it is seen.
    """
    spark = lines.sparkSession
    why = spark.createDataFrame([*errors.items()], "file_name string, errors array<string>")
    kept = why.join(lines, "file_name", "left").select(
        F.col("value").alias("line"), "errors", F.lit(stage).alias("stage"), "file_name")
    replace_partitions(kept, root, "stage", "file_name")


def read_dead_letters(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(schemas.DEAD_LETTER).parquet(root)


def write_rejects(rejects: DataFrame, file_name: Column, root: str) -> None:
    """Keep the rows of accepted files that belong to no day."""
    replace_partitions(rejects.select(*schemas.REQUIRED_COLUMNS, file_name.alias("file_name")), root, "file_name")
