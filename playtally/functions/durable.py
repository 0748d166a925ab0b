"""Cutting lineage on shared storage."""

from pyspark.sql import DataFrame


def durable(df: DataFrame, fallback_dir: str) -> DataFrame:
    """Materialise `df` once in the cluster's checkpoint folder and continue from there.

    The folder is the one the session names in spark.checkpoint.dir; `fallback_dir` (next to the data,
    hence on the same shared storage) serves sessions that name none. Later jobs then read the
    checkpoint files, so a lost executor costs a re-read and not a recomputation from the raw events.
    """
    context = df.sparkSession.sparkContext
    named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
    # Without a named folder each caller's own counts, also after another deployment of the session set one.
    if context.getCheckpointDir() is None or named is None:
        context.setCheckpointDir(named or fallback_dir)
    return df.checkpoint(eager=True)
