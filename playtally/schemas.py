"""Table schemas, and the values that every implementation of these reports must share."""

from pyspark.sql import types as T

# --- Fixed values: column names, patterns, limits, defaults and message texts of the data contract.
REQUIRED_COLUMNS = ("user_id", "track_id", "listen_time")
TRACK_ID_PATTERN = "^[A-Za-z0-9]{10,30}$"
LISTEN_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
LISTEN_DATE_FORMAT = "yyyy-MM-dd"
UNPARSEABLE_TIME_LIMIT = 0.001
UNKNOWN_KEY_LIMIT = 0.05
UNKNOWN_GENRE = "unknown"
NO_SONGS = "[]"
TOP_SONGS = 3
TOP_GENRES = 5
TTL_DAYS = 90
TOP_GENRES_RECORD = "TOP_GENRES"
PASSED = "PASSED"
FAILED = "FAILED"
SUCCEEDED = "SUCCEEDED"
MISSING_COLUMNS_TEXT = "Missing required columns: {}"
NULLS_TEXT = "Column '%s' has %d null value(s)"
USER_ID_TEXT = "user_id has %d non-numeric value(s)"
TRACK_ID_TEXT = "track_id has %d invalid value(s)"
LISTEN_TIME_TEXT = "listen_time has %d unparseable value(s) (%.2f%%)"
UNKNOWN_USERS_TEXT = "%.1f%% of user_ids not found in users reference (%d distinct users)"
UNKNOWN_TRACKS_TEXT = "%.1f%% of track_ids not found in songs reference (%d distinct tracks)"
# Texts a CSV cell may hold to mean "no value" (the public pandas defaults).
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# --- End of fixed values.

EVENTS = T.StructType([
    T.StructField("user_id", T.IntegerType()),
    T.StructField("track_id", T.StringType()),
    T.StructField("listen_time", T.TimestampType()),
])

SONGS = T.StructType([
    T.StructField("track_id", T.StringType()),
    T.StructField("track_name", T.StringType()),
    T.StructField("track_genre", T.StringType()),
    T.StructField("duration_ms", T.LongType()),
    T.StructField("artists", T.StringType()),
    T.StructField("album_name", T.StringType()),
])

USERS = T.StructType([
    T.StructField("user_id", T.IntegerType()),
    T.StructField("user_country", T.StringType()),
])

GENRE_KPIS = T.StructType([
    T.StructField("track_genre", T.StringType()),
    T.StructField("listen_date", T.StringType()),
    T.StructField("listen_count", T.LongType()),
    T.StructField("unique_listeners", T.LongType()),
    T.StructField("total_listen_time_ms", T.LongType()),
    T.StructField("avg_listen_time_ms", T.DoubleType()),
    T.StructField("top_3_songs", T.StringType()),
])

TOP_GENRE_ROWS = T.StructType([
    T.StructField("listen_date", T.StringType()),
    T.StructField("track_genre", T.StringType()),
    T.StructField("genre_listen_count", T.LongType()),
    T.StructField("rank", T.IntegerType()),
])

KPI_ITEMS = T.StructType([
    T.StructField("genre", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("listen_count", T.LongType()),
    T.StructField("unique_listeners", T.LongType()),
    T.StructField("total_listen_time_ms", T.LongType()),
    T.StructField("avg_listen_time_ms", T.DecimalType(18, 2)),
    T.StructField("top_3_songs", T.StringType()),
    T.StructField("processed_at", T.StringType()),
    T.StructField("ttl_expiry", T.LongType()),
])
KPI_KEY = ("genre", "date")

TOP_GENRE_ITEMS = T.StructType([
    T.StructField("record_type", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("top_5_genres", T.StringType()),
    T.StructField("processed_at", T.StringType()),
    T.StructField("ttl_expiry", T.LongType()),
])
TOP_GENRE_KEY = ("record_type", "date")

RANKED_GENRES = T.ArrayType(T.StructType([
    T.StructField("rank", T.LongType()),
    T.StructField("genre", T.StringType()),
    T.StructField("listen_count", T.LongType()),
]))

VALIDATION_REPORT = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("input_key", T.StringType()),
    T.StructField("record_count", T.LongType()),
    T.StructField("null_counts", T.MapType(T.StringType(), T.LongType())),
    T.StructField("unknown_user_pct", T.DoubleType()),
    T.StructField("unknown_track_pct", T.DoubleType()),
    T.StructField("duplicate_rows", T.LongType()),
    T.StructField("errors", T.ArrayType(T.StringType())),
    T.StructField("validated_at", T.StringType()),
])

LOAD_REPORT = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("kpi_items_written", T.LongType()),
    T.StructField("top_genre_items_written", T.LongType()),
    T.StructField("partitions", T.ArrayType(T.StringType())),
    T.StructField("completed_at", T.StringType()),
])

DEAD_LETTER = T.StructType([
    T.StructField("line", T.StringType()),
    T.StructField("errors", T.ArrayType(T.StringType())),
    T.StructField("stage", T.StringType()),
    T.StructField("file_name", T.StringType()),
])
