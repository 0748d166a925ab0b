"""Dated archives, keyed tables and reports, on temporary folders."""

from datetime import datetime, timedelta, timezone

import pytest
from playtally import schemas
from playtally.operators import kpis as k
from playtally.operators import serving
from playtally.plans.load import (Layout, NoDatesError, archive_kpis, load_serving, stored_kpi_items,
                                  stored_top_genre_items)
from playtally.sources import inputs, keyed, tables

NOW = datetime(2024, 6, 26, 12, tzinfo=timezone.utc)

def kpi_row(genre, date, plays=1):
    return (genre, date, plays, 1, 100, 100.0, "[]")


def rows(df):
    return sorted(tuple(row) for row in df.collect())


@pytest.fixture
def layout(tmp_path):
    return Layout(str(tmp_path))


def test_archive_splits_dates_and_keeps_others(spark, layout):
    first = spark.createDataFrame([kpi_row("a", "2024-06-25"), kpi_row("b", "2024-06-26")], schemas.GENRE_KPIS)
    assert archive_kpis(first, layout, json_export=True) == ["2024-06-25", "2024-06-26"]
    assert archive_kpis(spark.createDataFrame([kpi_row("c", "2024-06-26")], schemas.GENRE_KPIS), layout,
                        json_export=True) == ["2024-06-26"]
    for fmt in ("parquet", "json"):
        stored = tables.read_kpis(spark, layout.archive("genre_kpis", fmt), fmt=fmt)
        assert dict(stored.dtypes)["listen_date"] == "string"
        assert [(r.track_genre, r.listen_date) for r in stored.orderBy("listen_date").collect()] == [
            ("a", "2024-06-25"), ("c", "2024-06-26")]
    only = tables.read_top_genres(spark, layout.archive("top_genres"), dates=["2024-06-25"])
    assert rows(only.select("track_genre", "rank")) == [("a", 1)]
    # Either format feeds the serving tables.
    report = load_serving(spark, layout, NOW, fmt="json").first()
    assert (report.kpi_items_written, report.top_genre_items_written) == (2, 2)
    assert rows(serving.trend(stored_kpi_items(spark, layout, NOW), "c").select("date", "top_3_songs")) == [
        ("2024-06-26", "[]")]


def test_dates_are_found_by_their_shape(spark, layout):
    odd = spark.createDataFrame([kpi_row("a", "2024-06-25"), kpi_row("b", "unknown"), kpi_row("c", None)],
                                schemas.GENRE_KPIS)
    tables.write_by_date(odd, layout.archive("genre_kpis"))
    assert [r.track_genre for r in tables.read_kpis(spark, layout.archive("genre_kpis")).collect()] == ["a"]


def test_read_prunes_partitions(spark, layout):
    archive_kpis(spark.createDataFrame([kpi_row("a", f"2024-06-{day}") for day in range(10, 20)],
                                       schemas.GENRE_KPIS), layout)
    pruned = tables.read_kpis(spark, layout.archive("genre_kpis"), dates=["2024-06-12"])
    assert len(pruned.inputFiles()) == 10
    scan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "2024-06-12" in scan.split("PartitionFilters")[1]


def test_json_lines_are_read_back_without_blank_lines(spark, tmp_path, layout):
    part = tmp_path / "processed" / "genre_kpis" / "json" / "listen_date=2024-06-25"
    part.mkdir(parents=True)
    lines = ['{"track_genre": "a", "listen_count": 2}', "", '{"track_genre": "b", "top_3_songs": "[]"}', "  "]
    (part / "part-0.json").write_text("\n".join(lines) + "\n")
    (part / "_SUCCESS").write_text("")
    items = serving.kpi_items(tables.read_kpis(spark, layout.archive("genre_kpis", "json"), fmt="json"), NOW)
    assert rows(items.select("genre", "date", "listen_count", "top_3_songs")) == [
        ("a", "2024-06-25", 2, "[]"), ("b", "2024-06-25", 0, "[]")]


def test_lookups_prune_dates_and_push_the_genre_down(spark, layout):
    put(spark, layout, NOW, kpi_row("a", "2024-06-25"), kpi_row("b", "2024-06-26"))
    found = serving.point(stored_kpi_items(spark, layout, NOW), "a", "2024-06-25")
    assert found.count() == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "2024-06-25" in plan.split("PartitionFilters")[1].split("]")[0]
    assert "EqualTo(genre,a)" in plan.split("PushedFilters")[1]


def test_load_writes_both_tables_and_reports(spark, layout):
    archive_kpis(spark.createDataFrame(
        [kpi_row("a", "2024-06-25", 3), kpi_row("b", "2024-06-25", 5), kpi_row("a", "2024-06-26")],
        schemas.GENRE_KPIS), layout)
    report = load_serving(spark, layout, NOW).first()
    assert tuple(report) == ("SUCCEEDED", 3, 2, ["2024-06-25", "2024-06-26"], "2024-06-26T12:00:00.000000+00:00")
    items = stored_kpi_items(spark, layout, NOW)
    assert rows(serving.top_on(items, "2024-06-25").select("genre", "listen_count")) == [("a", 3), ("b", 5)]
    top = serving.snapshot(stored_top_genre_items(spark, layout, NOW), "2024-06-25")
    assert rows(top.select("rank", "genre", "listen_count")) == [(1, "b", 5), (2, "a", 3)]
    assert items.first().ttl_expiry == int((NOW + timedelta(days=90)).timestamp())


def test_load_of_given_dates_leaves_others(spark, layout):
    archive_kpis(spark.createDataFrame([kpi_row("a", "2024-06-25"), kpi_row("a", "2024-06-26")],
                                       schemas.GENRE_KPIS), layout)
    load_serving(spark, layout, NOW)
    report = load_serving(spark, layout, NOW + timedelta(days=1), dates=["2024-06-26"]).first()
    assert report.kpi_items_written == 1 and report.partitions == ["2024-06-26"]
    stamps = {r.date: r.processed_at[:10] for r in stored_kpi_items(spark, layout, NOW).collect()}
    assert stamps == {"2024-06-25": "2024-06-26", "2024-06-26": "2024-06-27"}


def test_load_without_dates_is_an_error(spark, layout):
    with pytest.raises(NoDatesError):
        load_serving(spark, layout, NOW)


def put(spark, layout, when, *rows_):
    frame = serving.kpi_items(spark.createDataFrame(list(rows_), schemas.GENRE_KPIS), when)
    keyed.upsert(frame, layout.kpi_items, schemas.KPI_ITEMS, schemas.KPI_KEY, when, layout.checkpoints)


def test_second_load_replaces_by_key_and_keeps_the_rest(spark, layout):
    put(spark, layout, NOW, kpi_row("a", "2024-06-25", 1), kpi_row("b", "2024-06-25", 2),
        kpi_row("a", "2024-06-20", 7))
    for _ in range(2):  # repeating a load changes nothing
        put(spark, layout, NOW + timedelta(hours=1), kpi_row("a", "2024-06-25", 9))
        stored = stored_kpi_items(spark, layout, NOW)
        assert rows(stored.select("genre", "date", "listen_count")) == [
            ("a", "2024-06-20", 7), ("a", "2024-06-25", 9), ("b", "2024-06-25", 2)]


def test_compaction_removes_dates_without_live_rows(spark, layout):
    put(spark, layout, NOW, kpi_row("old", "2024-06-24"))
    put(spark, layout, NOW + timedelta(days=1), kpi_row("new", "2024-06-25"))
    keyed.compact(spark, layout.kpi_items, schemas.KPI_ITEMS, schemas.KPI_KEY, NOW + timedelta(days=90), layout.checkpoints)
    assert not tables.read_table(spark, layout.kpi_items, schemas.KPI_ITEMS).where("date = '2024-06-24'").count()
    assert len(tables.read_table(spark, layout.kpi_items, schemas.KPI_ITEMS).inputFiles()) == 1


def test_expired_items_are_neither_read_nor_kept(spark, layout):
    put(spark, layout, NOW, kpi_row("old", "2024-06-25"))
    later = NOW + timedelta(days=90)
    assert stored_kpi_items(spark, layout, later - timedelta(seconds=1)).count() == 1
    assert stored_kpi_items(spark, layout, later).count() == 0
    put(spark, layout, later, kpi_row("new", "2024-06-25"))
    assert rows(tables.read_table(spark, layout.kpi_items, schemas.KPI_ITEMS).select("genre")) == [("new",)]


def test_compaction_drops_expired_rows(spark, layout):
    put(spark, layout, NOW, kpi_row("old", "2024-06-25"))
    put(spark, layout, NOW + timedelta(days=1), kpi_row("new", "2024-06-25"))
    keyed.compact(spark, layout.kpi_items, schemas.KPI_ITEMS, schemas.KPI_KEY, NOW + timedelta(days=90),
                  layout.checkpoints)
    assert rows(tables.read_table(spark, layout.kpi_items, schemas.KPI_ITEMS).select("genre")) == [("new",)]


def test_quoted_text_is_read_right(spark, tmp_path):
    path = tmp_path / "songs.csv"
    path.write_text('track_id,track_name,track_genre,duration_ms,artists,album_name\n'
                    't1,"He said ""hi"", ok",5,7,a,b\nt2,"two\nlines",x,bad,a,b\n')
    assert rows(inputs.read_songs(spark, str(path)).select("track_id", "track_name", "track_genre", "duration_ms")) == [
        ("t1", 'He said "hi", ok', "5", 7), ("t2", "two\nlines", "x", None)]
    assert k.GENRE_DAY == ("track_genre", "listen_date")
