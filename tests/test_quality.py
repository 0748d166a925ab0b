"""Parsing and validation on small tables."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from playtally import schemas
from playtally.functions import parsing
from playtally.operators import quality
from playtally.operators.enrich import dedup_events
from playtally.operators.serving import kpi_items, top_genre_items
from playtally.sources import inputs

NOW = datetime(2024, 6, 25, 10, tzinfo=timezone.utc)
RAW = "user_id string, track_id string, listen_time string"
TIME = "2024-06-25 10:00:00"


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


def good(n):
    return [(str(i % 40), f"track{i % 40:05}", TIME) for i in range(n)]


@pytest.fixture(scope="module")
def references(spark):
    return (spark.createDataFrame([(f"track{i:05}",) for i in range(40)], "track_id string"),
            spark.createDataFrame([(str(i),) for i in range(40)], "user_id string"))


def report(spark, rows, references):
    return quality.validation_report(raw(spark, rows), *references, NOW, "in/x.csv").first()


def parsed(spark, parse, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [row.value for row in frame.select("i", parse(F.col("text")).alias("value")).orderBy("i").collect()]


def test_casts_that_fail_give_null(spark):
    texts = ["abc", "1.5", "1e3", "3000000000", " 7 ", None]
    assert parsed(spark, parsing.parse_int, texts) == [None, None, None, None, 7, None]
    assert parsed(spark, parsing.parse_listen_time, ["2024-06-25", "2024-06-25T10:00:00", TIME, "2024-13-01 00:00:00"]) == [
        None, None, datetime(2024, 6, 25, 10), None]


def test_validation_accepts_more_time_layouts_than_the_kpis(spark):
    texts = ["2024-06-25", "2024-06-25T10:00:00", TIME, "06/25/2024", "25/06/2024 10:00:00", "June 25, 2024", "x", None]
    assert [value is not None for value in parsed(spark, parsing.parse_any_datetime, texts)] == [True] * 6 + [False] * 2


def test_numbers_and_keys_in_text(spark):
    assert parsed(spark, parsing.is_number, ["1", "1.5", "1e3", " 7 ", "-2", "u1", "1d", "2.f", "", None]) == [
        True, True, True, True, True, False, False, False, False, False]
    assert parsed(spark, parsing.key_text, ["7", " 7 ", "007", "1.5", "u7", None]) == ["7", "7", "7", "1.5", "u7", None]
    assert parsed(spark, parsing.is_track_id, ["a" * 10, "a" * 30, "a" * 9, "a" * 31, "a-b" * 4, None]) == [
        True, True, False, False, False, False]
    assert parsed(spark, parsing.is_date_text, ["2024-06-25", "unknown", "2024/06/25", None]) == [
        True, False, False, None]


def test_events_are_deduplicated_after_casting(spark):
    typed = inputs.type_events(raw(spark, [("7", "t", TIME), (" 7 ", "t", TIME)]))
    assert dedup_events(typed).count() == 1


def test_numeric_ids_that_are_no_int_are_counted(spark):
    rows = raw(spark, [("1.5", "track00000", TIME), ("3000000000", "track00000", TIME), ("7", "track00000", TIME), ("x", "track00000", TIME)])
    counted = quality.quality_metrics(rows).first()
    assert (counted.off_type_user_id, counted.invalid_user_id) == (2, 1)


def test_rows_without_a_day_are_split_off(spark):
    events, rejects = inputs.split_events(raw(spark, [("1", "t", TIME), ("1", "t", "2024-06-25"), ("1", "t", None)]))
    assert events.count() == 1 and rejects.count() == 2


def test_null_texts_are_nulls(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("user_id,track_id,listen_time\nNA,nan,\n1,\"\",NULL\n2,nans,null \n")
    rows = inputs.read_raw_events(spark, str(path)).orderBy(F.col("user_id")).collect()
    assert [tuple(row) for row in rows] == [(None, None, None), ("1", None, None), ("2", "nans", "null ")]


def test_clean_file_passes(spark, references):
    row = report(spark, good(80), references)
    assert row.asDict(recursive=True) == {
        "status": "PASSED", "input_key": "in/x.csv", "record_count": 80,
        "null_counts": {"user_id": 0, "track_id": 0, "listen_time": 0},
        "unknown_user_pct": 0.0, "unknown_track_pct": 0.0, "duplicate_rows": 40, "errors": [],
        "validated_at": "2024-06-25T10:00:00.000000+00:00"}


def test_every_failed_check_is_reported_in_order(spark, references):
    rows = good(30) + [(None, None, None), ("u1", "bad id", "never"), ("99", "track00099", TIME), ("98", "track00098", TIME)]
    row = report(spark, rows, references)
    assert row.status == "FAILED" and row.errors == [
        "Column 'user_id' has 1 null value(s)",
        "Column 'track_id' has 1 null value(s)",
        "Column 'listen_time' has 1 null value(s)",
        "user_id has 2 non-numeric value(s)",
        "track_id has 2 invalid value(s)",
        "listen_time has 2 unparseable value(s) (5.88%)",
        "9.1% of user_ids not found in users reference (3 distinct users)",
        "9.1% of track_ids not found in songs reference (3 distinct tracks)"]
    assert row.unknown_user_pct == 0.0909 and row.null_counts == {"user_id": 1, "track_id": 1, "listen_time": 1}


@pytest.mark.parametrize("bad, of, status", [(1, 1000, "PASSED"), (2, 1999, "FAILED")])
def test_time_limit_is_strict(spark, references, bad, of, status):
    rows = good(of - bad) + [("1", "track00001", "never")] * bad
    assert report(spark, rows, references).status == status


@pytest.mark.parametrize("known, status", [(19, "PASSED"), (18, "FAILED")])
def test_unknown_key_limit_is_strict(spark, references, known, status):
    rows = [(str(i), "track00001", TIME) for i in range(known)] + [("77", "track00001", TIME)]
    assert report(spark, rows, references).status == status


def test_without_references_the_shares_are_null(spark):
    row = report(spark, [("77", "track00099", TIME)], (None, None))
    assert row.status == "PASSED" and row.unknown_user_pct is None and row.unknown_track_pct is None


def test_empty_input_passes(spark, references):
    row = report(spark, [], references)
    assert (row.status, row.record_count, row.unknown_user_pct, row.duplicate_rows) == ("PASSED", 0, 0.0, 0)


def test_missing_columns_end_the_checks(spark):
    frame = spark.createDataFrame([("1",)], "user_id string")
    row = quality.validation_report(frame, None, None, NOW, "x.csv").first()
    assert row.asDict() == {"status": "FAILED", "record_count": 1,
                            "errors": ["Missing required columns: ['listen_time', 'track_id']"],
                            "validated_at": "2024-06-25T10:00:00.000000+00:00"}


def test_duplicates_compare_every_column(spark):
    frame = spark.createDataFrame([("1", "a", None)] * 3 + [("1", "b", None), ("1", "a", "x")], "a string, b string, c string")
    assert quality.duplicate_rows(frame).first().duplicate_rows == 2


def test_pieces_agree_with_the_whole(spark, references):
    rows = good(50) + [("u1", None, "never")] * 3
    whole = quality.validation_metrics(raw(spark, rows), *references).first().asDict()
    one_scan = quality.quality_metrics(raw(spark, rows)).first().asDict()
    assert {name: whole[name] for name in one_scan} == one_scan
    users = quality.unknown_users(raw(spark, rows), references[1]).first()
    assert (users.distinct_users, users.unknown_users) == (whole["distinct_users"], whole["unknown_users"]) == (41, 1)


def test_items_fill_what_is_absent(spark):
    rows = [("g", "2024-06-25", None, None, None, None, None), ("h", "2024-06-25", 1, 1, 2, 0.125, "[1]")]
    items = kpi_items(spark.createDataFrame(rows, schemas.GENRE_KPIS), NOW, ttl_days=1).orderBy("genre").collect()
    assert [str(item.avg_listen_time_ms) for item in items] == ["0.00", "0.13"]
    assert tuple(items[0])[2:5] == (0, 0, 0) and items[0].top_3_songs == "[]"
    assert items[0].ttl_expiry == int(NOW.timestamp()) + 86400
    assert items[0].processed_at == "2024-06-25T10:00:00.000000+00:00"


def test_songs_that_are_not_text_are_written_as_text(spark):
    nested = spark.createDataFrame([("g", "2024-06-25", [(1, "t")])], "track_genre string, listen_date string, "
                                   "top_3_songs array<struct<rank: int, track_id: string>>")
    for name in ("listen_count", "unique_listeners", "total_listen_time_ms", "avg_listen_time_ms"):
        nested = nested.withColumn(name, F.lit(1))
    assert kpi_items(nested, NOW).first().top_3_songs == '[{"rank":1,"track_id":"t"}]'


def test_top_genre_item_lists_by_rank(spark):
    rows = [("2024-06-25", "b", 3, 2), ("2024-06-25", "a", 5, 1)]
    item = top_genre_items(spark.createDataFrame(rows, schemas.TOP_GENRE_ROWS), NOW).first()
    assert item.record_type == "TOP_GENRES" and item.top_5_genres == (
        '[{"rank":1,"genre":"a","listen_count":5},{"rank":2,"genre":"b","listen_count":3}]')
