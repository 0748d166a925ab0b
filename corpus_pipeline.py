"""From raw documents to token ids: five stages, each a training-data operator whose decisions take effect.

Every stage takes (spark, docs, sf_dir) and returns a frame; all but the last return the columns of
documents. Between stages the frame is written as Parquet and read again, so a lost executor never costs more
than the stage at hand; it is deleted once the next stage is written.

Defined results: an empty table stays empty through all stages; a null or empty text has no words, so the first stage
drops it; rows with a null doc_id go through like others; of repeated rows one stays; a null lang, source or n_chars
is kept or made anew; further columns go along up to the last stage, whatever their names, which returns doc_id, lang and
source with the pieces.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playtally.llm import decontaminate, neardup, pieces, pii, quality, storage
from playtally.sources import files

#: SQL has no piece lattice: the stages are tested one by one instead.
ORACLE_SQL = None


def _sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without their failing lines."""
    judged = quality.judge(docs, "__quality").where("__quality.kept")
    return _sized(judged.withColumn("text", F.col("__quality.cleaned"))).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    return neardup.first_of_each(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.match(docs, benchmark, "__leak").where("__leak.n_hit = 0").select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return _sized(pii.redact(docs, pii.fit(docs))).select(docs.columns)


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the best segmentation, its score and its distance from the second."""
    return pieces.encode(docs.select("doc_id", "text", "lang", "source")).select("doc_id", "lang", "source", "pieces.*")


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_leaks),
    ("personal data", personal_data),
    ("sentencepiece", piece_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written to the shared checkpoint folder for the next."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        folder = f"{storage.shared_folder(spark)}/pipeline-{uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
        if before:
            files.delete(spark, before)
        before = folder
    return STAGES[-1][1](spark, docs, sf_dir)
