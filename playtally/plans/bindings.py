"""The driver's tables read as songs, users and event streams; every binding uses whole tables.

Plays of unlisted tracks and users arise from the data: parts of size 50 are listed under a withdrawn
track id, and customers deep in debt under a closed account number.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns that the bindings read. Declaring them saves a schema-inference job per table.
COLUMNS = {
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double",
    "nation": "n_nationkey int, n_name string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _padded(number, width: int = 12):
    return F.lpad(number.cast("string"), width, "0")


def songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    withdrawn = F.concat(F.lit("W"), _padded(key, 11))
    return table(spark, sf_dir, "part").select(
        F.when(F.col("p_size") == 50, withdrawn).otherwise(_padded(key)).alias("track_id"),
        F.col("p_name").alias("track_name"),
        F.col("p_brand").alias("track_genre"),
        (F.col("p_size").cast("bigint") * 1000).alias("duration_ms"),
        F.col("p_type").alias("artists"),
        F.lit(None).cast("string").alias("album_name"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey").cast("int")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.when(F.col("c_acctbal") < -900, -1 - key).otherwise(key).alias("user_id"),
        F.col("n_name").alias("user_country"),
    )


def lineitem_streams(spark: SparkSession, sf_dir: str, time: str = "o_orderdate") -> DataFrame:
    """The large stream: one play per order line, with exact copies; lines of pending orders have no user."""
    lineitem = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast("int")).alias("user_id"),
        _padded(F.col("l_partkey")).alias("track_id"),
        F.col(time).cast("timestamp").alias("listen_time"),
    )


def event_streams(spark: SparkSession, sf_dir: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The 30-day stream: one play per event. Of some days only, `first` to `last`, it is read by a range of times."""
    events = table(spark, sf_dir, "events")
    if first is not None:
        events = events.where((F.col("ts") >= F.lit(first).cast("timestamp_ntz")) &
                              (F.col("ts") < F.date_add(F.lit(last or first).cast("date"), 1).cast("timestamp_ntz")))
    return events.select(
        F.col("user_id").cast("int").alias("user_id"),
        _padded(F.get_json_object("props", "$.k")).alias("track_id"),
        F.col("ts").cast("timestamp").alias("listen_time"),
    )


def event_files(spark: SparkSession, sf_dir: str, days_later: int = 0) -> DataFrame:
    """The 30-day stream as files, one for each type of event, with the file's name; `days_later` moves all plays."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("int").alias("user_id"),
        _padded(F.get_json_object("props", "$.k")).alias("track_id"),
        (F.col("ts") + F.make_interval(days=F.lit(days_later))).cast("timestamp").alias("listen_time"),
        F.concat("event_type", F.lit(".csv")).alias("file_name"),
    )


def _text(columns: DataFrame) -> DataFrame:
    return columns.select(
        F.col("user_id").cast("string").alias("user_id"),
        "track_id",
        F.date_format("listen_time", "yyyy-MM-dd HH:mm:ss").alias("listen_time"),
    )


def clean_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 30-day stream as CSV text that passes validation."""
    return _text(event_streams(spark, sf_dir))


def repeated_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The large stream as CSV text, with repeated rows."""
    return _text(lineitem_streams(spark, sf_dir))


def dirty_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 30-day stream as CSV text with flaws in every column, by event type and value."""
    value, kind = F.col("value"), F.col("event_type")
    user = F.col("user_id").cast("string")
    track = _padded(F.get_json_object("props", "$.k"))
    time = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf_dir, "events").select(
        F.when((kind == "signup") & (value < 5), F.lit(None))
        .when((kind == "signup") & (value < 10), F.concat(F.lit("u"), user)).otherwise(user).alias("user_id"),
        F.when((kind == "error") & (value < 5), F.lit(None))
        .when((kind == "error") & (value < 10), F.lit("bad id")).otherwise(track).alias("track_id"),
        F.when((kind == "view") & (value < 2), F.lit("not a time")).otherwise(time).alias("listen_time"),
    )
