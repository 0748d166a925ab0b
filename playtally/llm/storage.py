"""Cutting lineage in the cluster's shared folder."""

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of this application; a session that names none (a test) gets one below its warehouse."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or (
            spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """`df` written once to the folder of spark.checkpoint.dir and read from there.

    A lost executor then costs a re-read of that folder, not the work before it.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
