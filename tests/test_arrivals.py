"""Files that arrive in a folder, on temporary folders."""

import json
import os
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest

from playtally.operators import serving
from playtally.plans.load import Layout, stored_kpi_items
from playtally.sources import dead_letters, event_archive, inputs, ledger, references
from playtally.streaming import arrivals
from playtally.streaming.arrivals import Settings, run_arrivals

NOW = datetime(2024, 6, 26, 12, tzinfo=timezone.utc)
SONGS = 'track_id,track_name,track_genre,duration_ms,artists,album_name,tempo\n' + "".join(
    f'track00000{i},"Song ""{i}"", live",{genre},100,a,b,1.5\n' for i, genre in enumerate(["pop", "rock", "jazz"]))
USERS = "user_id,user_name,user_country\n1,x,DE\n2,y,FR\n"


class Deployment:
    def __init__(self, spark, folder):
        self.spark, self.source, self.out = spark, folder / "in", folder / "out"
        self.source.mkdir()
        (folder / "songs.csv").write_text(SONGS)
        (folder / "users.csv").write_text(USERS)
        self.layout = Layout(str(self.out))
        self.folder, self.options = folder, {"clock": lambda: NOW}

    @property
    def settings(self):
        return Settings(str(self.folder / "songs.csv"), str(self.folder / "users.csv"), self.layout, **self.options)

    def put(self, name, *lines, header="user_id,track_id,listen_time", at=None):
        path = self.source / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join([header, *lines]) + "\n" if header is not None else "")
        if at is not None:
            os.utime(path, (at, at))
        return path

    def run(self, **options):
        return run_arrivals(self.spark, str(self.source), self.settings, **options)

    def items(self, *columns):
        frame = stored_kpi_items(self.spark, self.layout, NOW).select(*columns or ("genre", "date", "listen_count"))
        return sorted(tuple(row) for row in frame.collect())

    def report(self, name, area="processed", kind="validation"):
        return json.loads(next((self.out / area / "reports" / f"{kind}_{name}.json").glob("part-*")).read_text())

    def left(self, folder):
        return {str(path.relative_to(folder)) for path in Path(folder).rglob("*") if path.is_file() and path.name[0] not in "._"}


@pytest.fixture
def deployment(spark, tmp_path):
    return Deployment(spark, tmp_path)


def play(track=0, user=1, day=25, hour=10, minute=0):
    return f"{user},track00000{track},2024-06-{day} {hour:02}:{minute:02}:00"


def test_a_batch_is_validated_computed_and_stored(deployment):
    deployment.put("one.csv", play(), play(user=2), play(), play(1, day=26))
    deployment.put("two [x] 100%+.csv", "2024-06-27 09:00:00,track000002,2,x", header="listen_time,track_id,user_id,extra")
    (deployment.source / ".keep").write_text("")
    assert deployment.run() == {"one.csv": "done", "two [x] 100%+.csv": "done"}
    assert deployment.items("genre", "date", "listen_count", "unique_listeners") == [
        ("jazz", "2024-06-27", 1, 1), ("pop", "2024-06-25", 2, 2), ("rock", "2024-06-26", 1, 1)]
    songs = json.loads(serving.point(stored_kpi_items(deployment.spark, deployment.layout, NOW), "pop", "2024-06-25").first().top_3_songs)
    assert songs == [{"rank": 1, "track_id": "track000000", "track_name": 'Song "0", live', "song_listen_count": 2}]
    report = deployment.report("one")
    assert (report["status"], report["record_count"], report["duplicate_rows"], report["input_key"]) == ("PASSED", 4, 1, "one.csv")
    for name in ("one", "two [x] 100%25+".replace("%25", "%")):
        assert deployment.report(name, kind="ingestion")["partitions"] == ["2024-06-25", "2024-06-26", "2024-06-27"]
    # The last file is archived too, and nothing is taken twice.
    assert deployment.left(deployment.source) == set()
    assert deployment.left(deployment.out / "archive") == {"one.csv", "two [x] 100%+.csv"}
    assert deployment.run() == {}


def test_a_second_upload_under_one_name_is_computed(deployment):
    deployment.put("a.csv", *[play(minute=m) for m in range(5)], play(day=24))
    deployment.run()
    assert deployment.items() == [("pop", "2024-06-24", 1), ("pop", "2024-06-25", 5)]
    deployment.put("b.csv", play(hour=12))
    deployment.run()
    deployment.put("a.csv", *[play(minute=m) for m in range(10)])
    assert deployment.run() == {"a.csv": "done"}
    # The new version replaces the old one, also on the date that it no longer has.
    assert deployment.items() == [("pop", "2024-06-25", 11)]
    archived = deployment.left(deployment.out / "archive")
    assert len(archived) == 3 and {"a.csv", "b.csv"} < archived


def test_old_nested_equal_and_oddly_named_files_are_taken(deployment):
    deployment.put("new.csv", play())
    deployment.put("old.csv", play(1), at=(datetime.now() - timedelta(days=10)).timestamp())
    deployment.put("h=1/s.csv", play(2))
    deployment.put("h=2/s.CSV", play(2, hour=11))
    assert set(deployment.run().values()) == {"done"}
    assert deployment.items() == [("jazz", "2024-06-25", 2), ("pop", "2024-06-25", 1), ("rock", "2024-06-25", 1)]
    assert deployment.report("h=1%2Fs")["input_key"] == "h=1/s.csv" and deployment.report("h=2%2Fs")["record_count"] == 1
    assert deployment.left(deployment.out / "archive") == {"new.csv", "old.csv", "h=1/s.csv", "h=2/s.CSV"}


def test_failed_files_go_to_dead_letter_by_path(deployment):
    bad = ["x,track000000,2024-06-25 10:00:00", "1,nope,2024-06-25 10:00:00"]
    deployment.put("d/bad.csv", *bad)
    deployment.put("bad.csv", play(), "1,track000000,2024-06-25 10:00:00,more")
    deployment.put("short.csv", "1,track000000", header="user_id,track_id")
    deployment.put("zero.csv", header=None)
    deployment.put("few.csv", "1,track000000")
    deployment.put("good.csv", play())
    found = deployment.run()
    assert found == dict.fromkeys(("d/bad.csv", "bad.csv", "short.csv", "zero.csv", "few.csv"), "validation") | {"good.csv": "done"}
    assert deployment.items() == [("pop", "2024-06-25", 1)]
    letters = dead_letters.read_dead_letters(deployment.spark, deployment.layout.dead_letters).collect()
    assert {row.file_name for row in letters} == set(found) - {"good.csv"} and {row.stage for row in letters} == {"validation"}
    kept = [row for row in letters if row.file_name == "d/bad.csv"]
    assert {row.line for row in kept} == {"user_id,track_id,listen_time", *bad}
    assert kept[0].errors[:2] == ["user_id has 1 non-numeric value(s)", "track_id has 1 invalid value(s)"]
    assert [row.line for row in letters if row.file_name == "zero.csv"] == [None]
    assert deployment.report("bad", "dead-letter")["errors"][0] == "1 row(s) have more cells than the header"
    assert deployment.report("few", "dead-letter")["errors"][0].startswith("Column 'listen_time' has 1")
    for name in ("short", "zero"):
        report = deployment.report(name, "dead-letter")
        assert set(report) == {"status", "record_count", "errors", "validated_at"} and report["status"] == "FAILED"
    assert deployment.left(deployment.out / "archive") == {"good.csv"} and deployment.left(deployment.source) == set()
    assert deployment.left(deployment.out / "dead-letter" / "sources") == set(found) - {"good.csv"}


def test_header_only_file_passes_in_a_batch_too(deployment):
    deployment.put("none.csv")
    deployment.put("one.csv", play())
    assert set(deployment.run().values()) == {"done"}
    report = deployment.report("none")
    assert (report["status"], report["record_count"], report["unknown_user_pct"], report["null_counts"]["user_id"]) == ("PASSED", 0, 0.0, 0)
    assert deployment.report("none", kind="ingestion")["kpi_items_written"] == 1


def test_a_run_that_breaks_off_is_repeated(deployment, monkeypatch):
    deployment.put("one.csv", play(), play(1, user=2, day=26))

    def crash(*_):
        raise RuntimeError("driver lost before the outcome was recorded")

    monkeypatch.setattr(ledger, "append", crash)
    with pytest.raises(RuntimeError):
        deployment.run()
    before = deployment.items()
    monkeypatch.undo()
    assert len(before) == 2 and deployment.left(deployment.source) == {"one.csv"}
    # Recorded but not yet moved: the next run moves it and computes nothing.
    monkeypatch.setattr(arrivals, "_put_away", lambda *_: None)
    assert deployment.run() == {"one.csv": "done"} and deployment.left(deployment.source) == {"one.csv"}
    monkeypatch.undo()
    assert deployment.run() == {} and deployment.left(deployment.source) == set()
    assert deployment.items() == before


def test_storage_errors_end_the_run_and_lose_nothing(deployment, monkeypatch):
    deployment.put("one.csv", play())

    def broken(*_):
        raise OSError("storage is away")

    monkeypatch.setattr(arrivals, "_store", broken)
    with pytest.raises(OSError):
        deployment.run()
    monkeypatch.undo()
    assert not (deployment.out / "dead-letter").exists() and deployment.run() == {"one.csv": "done"}


def test_missing_reference_skips_the_check_then_fails_the_transform(deployment):
    deployment.put("one.csv", play())
    (deployment.folder / "songs.csv").unlink()
    assert deployment.run() == {"one.csv": "transform"}
    assert deployment.report("one")["status"] == "PASSED" and "unknown_user_pct" not in deployment.report("one")
    letter = dead_letters.read_dead_letters(deployment.spark, deployment.layout.dead_letters).first()
    assert letter.stage == "transform" and "songs.csv" in letter.errors[0]


@pytest.mark.parametrize("accumulate, plays", [(False, 1), (True, 3)])
def test_files_that_share_a_date_replace_or_add_up(deployment, accumulate, plays):
    deployment.options["accumulate"] = accumulate
    deployment.put("a.csv", play(), play(user=2, hour=11), at=10)
    deployment.put("b.csv", play(hour=12), at=20)
    deployment.run()
    assert deployment.items() == [("pop", "2024-06-25", plays)]


def test_rows_without_a_day_are_set_aside(deployment):
    deployment.put("s/one.csv", *[play(hour=h, minute=m) for h in range(20) for m in range(60)], "2,track000000,later")
    deployment.run()
    assert [tuple(row) for row in deployment.spark.read.parquet(deployment.layout.rejects).collect()] == [
        ("2", "track000000", "later", "s/one.csv")]
    assert deployment.items() == [("pop", "2024-06-25", 1200)]


def test_reload_renews_every_date(deployment):
    deployment.put("a.csv", play(), play(day=26))
    deployment.run()
    deployment.options["clock"] = lambda: NOW + timedelta(days=1)
    assert arrivals.reload_all(deployment.spark, deployment.settings).first().partitions == ["2024-06-25", "2024-06-26"]
    assert {row[0][:10] for row in deployment.items("processed_at")} == {"2024-06-27"}


def test_a_date_is_read_without_listing_others(deployment):
    deployment.put("a.csv", *[play(day=day) for day in range(10, 20)])
    deployment.run()
    read = event_archive.read_events(deployment.spark, deployment.layout.events, ["2024-06-12"])
    assert read.count() == 1 and all("listen_date=2024-06-12" in path for path in read.inputFiles())


def test_jobs_do_not_grow_with_the_files_of_a_batch(deployment):
    tracker = deployment.spark.sparkContext.statusTracker()

    def jobs(files):
        for i in range(files):
            deployment.put(f"{files}/{i}.csv", play(minute=i))
        deployment.spark.sparkContext.setJobGroup(f"batch of {files}", "")
        assert len(deployment.run()) == files
        return len(tracker.getJobIdsForGroup(f"batch of {files}"))

    jobs(2)  # the first batch finds no tables yet
    few, many = jobs(3), jobs(30)
    # Ten times the files; adaptive execution may split a stage or two into jobs of their own.
    assert many <= few + 5, (few, many)


def test_withdrawn_files_leave_archive_kpis_and_serving(deployment):
    deployment.put("a.csv", play(), play(user=2, hour=11))
    deployment.put("b.csv", play(), play(1, day=26))
    deployment.run()
    assert deployment.items() == [("pop", "2024-06-25", 2), ("rock", "2024-06-26", 1)]
    assert arrivals.withdraw(deployment.spark, ["b.csv"], deployment.settings) == ["2024-06-25", "2024-06-26"]
    # The play that both files hold stays.
    assert deployment.items() == [("pop", "2024-06-25", 2)]
    assert event_archive.read_events(deployment.spark, deployment.layout.events, ["2024-06-26"]).count() == 0
    assert not list((deployment.out / "processed" / "genre_kpis").rglob("listen_date=2024-06-26"))
    entries = ledger.read_ledger(deployment.spark, deployment.layout.ledger).where("path = 'b.csv'").collect()
    assert {row.outcome for row in entries} == {"done", "withdrawn"}
    assert arrivals.withdraw(deployment.spark, ["b.csv"], deployment.settings) == ["2024-06-25", "2024-06-26"]
    assert deployment.items() == [("pop", "2024-06-25", 2)]


def test_a_genre_that_a_new_version_lacks_is_gone(deployment):
    deployment.put("a.csv", play(), play(1))
    deployment.run()
    deployment.put("a.csv", play(1, hour=12))
    deployment.run()
    assert deployment.items() == [("rock", "2024-06-25", 1)]


def test_references_are_parsed_once_per_version(deployment, monkeypatch):
    parsed = []
    read = inputs._read_reference

    def counted(spark, path, multi_line):
        parsed.append(path)
        return read(spark, path, multi_line)

    monkeypatch.setattr(inputs, "_read_reference", counted)
    deployment.put("one.csv", play())
    deployment.put("two.csv", "2024-06-27 09:00:00,track000002,2,x", header="listen_time,track_id,user_id,extra")
    deployment.run()
    assert len(parsed) == 2  # two headers, two stages, one parse of songs and of users
    deployment.put("three.csv", play(hour=20))
    deployment.run()
    assert len(parsed) == 2
    songs = deployment.folder / "songs.csv"
    songs.write_text(songs.read_text().replace("pop", "folk"))
    os.utime(songs, (1, 1))
    deployment.put("four.csv", play(user=2, hour=21))
    deployment.run()
    assert len(parsed) == 4
    # The touched date is computed anew with the new version only; the other keeps what it had.
    assert deployment.items() == [("folk", "2024-06-25", 3), ("jazz", "2024-06-27", 1)]


def test_a_pinned_reference_does_not_change(deployment):
    spark, store = deployment.spark, deployment.layout.references
    args = (str(deployment.folder / "songs.csv"), str(deployment.folder / "users.csv"))
    held = references.current(spark, store, *args)
    (deployment.folder / "songs.csv").write_text(SONGS.replace("rock", "soul"))
    (deployment.folder / "users.csv").write_text(USERS + "2,z,IT\n")
    newer = references.current(spark, store, *args)
    assert {row.track_genre for row in held.songs.collect()} == {"pop", "rock", "jazz"} and held.users.count() == 2
    assert {row.track_genre for row in newer.songs.collect()} == {"pop", "soul", "jazz"} and newer.users.count() == 3
    assert (held.for_kpis.repeated_bytes, newer.for_kpis.repeated_bytes > 0) == (0, True)
    assert [tuple(row) for row in newer.for_kpis.repeated.collect()] == [(2, 2)]
    assert held.for_kpis.version != newer.for_kpis.version and newer.for_kpis.broadcast_songs
