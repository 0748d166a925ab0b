"""JSON reports, one folder per source file, all reports of a batch from one job."""

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from playtally import schemas
from playtally.sources.files import move

_STAGED = "_report"


def report_name(input_key: str) -> str:
    """The file's path without its suffix, in characters that any store takes; different files get different names."""
    return quote(input_key[:-4] if input_key.lower().endswith(".csv") else input_key, safe=" +()[]%,=@")


def _write(spark: SparkSession, reports: DataFrame, staging: str, targets: dict[str, str]) -> None:
    """Write `reports` by column `input_key`'s place in `targets`; the folders are then put under their names."""
    places = {key: str(i) for i, key in enumerate(targets)}
    numbered = spark.createDataFrame([*places.items()], f"_key string, {_STAGED} string")
    (reports.join(F.broadcast(numbered), F.col("_key") == F.col("_of")).drop("_key", "_of").coalesce(1)
     .write.mode("overwrite").partitionBy(_STAGED).json(staging))
    for key, target in targets.items():
        move(spark, f"{staging}/{_STAGED}={places[key]}", target)


def write_validation_reports(spark: SparkSession, verdicts: list[dict], root: str, staging: str) -> dict[str, str]:
    """One report per verdict under the processed or the dead-letter area, by its status; the path of each."""
    targets = {verdict["input_key"]: f"{root}/{'processed' if verdict['status'] == schemas.PASSED else 'dead-letter'}"
                                     f"/reports/validation_{report_name(verdict['input_key'])}.json" for verdict in verdicts}
    # A report on a file whose columns are missing does not name the file.
    rows = [(*[None if name == "input_key" and "null_counts" not in verdict else verdict.get(name)
               for name in schemas.VALIDATION_REPORT.fieldNames()], verdict["input_key"]) for verdict in verdicts]
    schema = StructType([*schemas.VALIDATION_REPORT.fields, StructField("_of", StringType())])
    _write(spark, spark.createDataFrame(rows, schema), staging, targets)
    return targets


def write_load_reports(spark: SparkSession, report: DataFrame, root: str, input_keys: list[str], staging: str) -> None:
    """The report of the load of a batch, for each of its files."""
    targets = {key: f"{root}/processed/reports/ingestion_{report_name(key)}.json" for key in input_keys}
    each = report.withColumn("_of", F.explode(F.array(*map(F.lit, input_keys))))
    _write(spark, each, staging, targets)
