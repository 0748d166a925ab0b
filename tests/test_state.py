"""Archive merged on read and KPIs kept as sums: any order of arrival equals a computation from all files."""

import random
from datetime import datetime
from pathlib import Path

import pytest
from playtally import schemas
from playtally.plans import state
from playtally.plans.daily import daily_kpis
from playtally.sources import event_archive
from playtally.sources.event_archive import ARCHIVED
from playtally.sources.manifest import Store

SONGS = [(f"t{i}", f"song {i}", genre, 100 + i, "a", "b") for i, genre in enumerate(["pop", "rock", None, "pop", "jazz"])] + [("t0", "song 0 again", "soul", 7, "a", "b")]
USERS = [(1, "DE"), (2, "FR"), (3, "IT"), (3, "ES")]


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


class Archive:
    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.store, self.checkpoints = Store(str(folder / "events")), str(folder / "checkpoints")
        self.refs = self.references(SONGS, "v1")
        self.live = {}

    def references(self, songs, version):
        return state.References.of(self.spark.createDataFrame(songs, schemas.SONGS), self.spark.createDataFrame(USERS, schemas.USERS), version)

    def events(self, plays_by_file):
        held = [(*play, name) for name, plays in plays_by_file.items() for play in plays]
        return self.spark.createDataFrame(held, "user_id int, track_id string, listen_time timestamp, file_name string")

    def put(self, plays_by_file, withdrawn=(), refs=None):
        self.live = {name: plays for name, plays in {**self.live, **plays_by_file}.items() if name not in withdrawn}
        return state.take_in(self.spark, self.store, self.events(plays_by_file), [*plays_by_file, *withdrawn], refs or self.refs, self.checkpoints)

    def expected(self, refs=None):
        return rows(daily_kpis(self.events(self.live).drop("file_name"), (refs or self.refs).songs.selectExpr("*", "'a' as artists", "'b' as album_name"), (refs or self.refs).users))

    def found(self, refs=None):
        return rows(state.state_kpis(self.spark, self.store, refs or self.refs))

    def bytes(self):
        return sum(path.stat().st_size for path in Path(self.folder, "events", "data").rglob("*.parquet"))


@pytest.fixture
def archive(spark, tmp_path):
    return Archive(spark, tmp_path)


def play(pick):
    return (pick.choice([1, 2, 3, 4, None]), f"t{pick.randrange(7)}", datetime(2024, 6, pick.randrange(20, 24), pick.randrange(2), pick.randrange(2)))


def steps(pick, n):
    """Batches of new, changed and repeated files, and withdrawals."""
    names = [f"f{i}.csv" for i in range(6)]
    for _ in range(n):
        batch = {name: [play(pick) for _ in range(pick.randrange(0, 12))] for name in pick.sample(names, pick.randrange(0, 3))}
        withdrawn = [name for name in pick.sample(names, pick.randrange(0, 2)) if name not in batch]
        yield batch, withdrawn


def test_hundred_random_orders_equal_a_full_computation(archive):
    """A hundred small worlds of their own users, songs and files, each with its own order of arrivals, replacements and
    withdrawals, go through one archive; every world's KPIs must equal those of all its valid files."""
    worlds = range(100)
    songs = [(f"w{w}{track}", name, f"{genre}{w}", ms, "a", "b") for w in worlds for track, name, genre, ms, _, _ in SONGS if genre]
    refs = archive.references(songs, "worlds")
    orders = [list(steps(random.Random(w), 6)) for w in worlds]
    own = lambda w, plays: [(user and user + 10 * w, f"w{w}{track}", time) for user, track, time in plays]
    for step in range(6):
        batch = {f"{w}/{name}": own(w, plays) for w in worlds for name, plays in orders[w][step][0].items()}
        archive.put(batch, [f"{w}/{name}" for w in worlds for name in orders[w][step][1]], refs)
        if step == 3:
            state.compact(archive.spark, archive.store, archive.checkpoints, 1)
    found = archive.found(refs)
    assert found == archive.expected(refs) and len({row[0] for row in found}) > 200
    events = rows(event_archive.read_archived(archive.spark, archive.store, archive.store.snapshot(archive.spark), None).drop("listen_date"))
    assert events == rows(archive.events(archive.live))


def test_play_changes_against_sets(spark, tmp_path):
    schema = "user_id int, track_id string, listen_time timestamp, listen_date string"
    for seed in range(6):
        pick = random.Random(seed)
        new, old, others = ([(*one, str(one[2].date())) for one in (play(pick) for _ in range(pick.randrange(30)))] for _ in range(3))
        frames = [spark.createDataFrame(part, schema) for part in (new, old, others)]
        got = {tuple(row) for row in state.play_changes(*frames, str(tmp_path / "c")).collect()}
        assert got == {(*one, 1) for one in {*new} - {*old} - {*others}} | {(*one, -1) for one in {*old} - {*new} - {*others}}


def test_a_late_file_writes_in_proportion_to_itself(archive):
    pick = random.Random(9)
    many = [(pick.randrange(5000), f"t{pick.randrange(5)}", datetime(2024, 6, 20, pick.randrange(24), pick.randrange(60), pick.randrange(60))) for _ in range(30_000)]
    archive.put({"big.csv": many})
    first = archive.bytes()
    archive.put({"late.csv": many[:3] + [(1, "t0", datetime(2024, 6, 20, 1))]})
    assert archive.bytes() - first < first / 20
    assert archive.found() == archive.expected()


@pytest.mark.parametrize("written", range(5))
def test_replay_after_a_crash_at_any_write_changes_nothing(archive, monkeypatch, written):
    pick = random.Random(written)
    archive.put({"a.csv": [play(pick) for _ in range(20)], "b.csv": [play(pick) for _ in range(20)]})
    before, events = archive.found(), archive.store.snapshot(archive.spark)
    batch = {"a.csv": [play(pick) for _ in range(10)], "c.csv": [play(pick) for _ in range(10)]}
    write, publish, count = Store.write, Store.publish, []

    def broken(self, *args, **options):
        if len(count) == written:
            raise OSError("lost")
        count.append(1)
        return write(self, *args, **options)

    def lost(self, *args, **options):
        raise OSError("lost before the version was published")

    monkeypatch.setattr(Store, "write", broken)
    monkeypatch.setattr(Store, "publish", lost)
    with pytest.raises(OSError):
        archive.put(batch)
    assert archive.found() == before and archive.store.snapshot(archive.spark) == events
    monkeypatch.setattr(Store, "write", write)
    monkeypatch.setattr(Store, "publish", publish)
    archive.put(batch)
    once = archive.found()
    assert once == archive.expected()
    # The batch is repeated though it was published, as when the run breaks off before the ledger is written.
    assert archive.put(batch).emptied == [] and archive.found() == once


def test_withdrawn_dates_are_emptied(archive):
    archive.put({"a.csv": [(1, "t0", datetime(2024, 6, 20))], "b.csv": [(1, "t0", datetime(2024, 6, 20)), (2, "t1", datetime(2024, 6, 21))]})
    change = archive.put({}, ["b.csv"])
    assert (change.touched, change.emptied) == (["2024-06-20"], ["2024-06-21"])
    assert archive.found() == archive.expected() and len(archive.found()) == 2  # t0 is listed under two genres


def test_changed_references_renew_the_touched_dates(archive):
    archive.put({"a.csv": [(1, "t0", datetime(2024, 6, 20)), (1, "t1", datetime(2024, 6, 21))]})
    refs = archive.references([("t0", "renamed", "folk", 5, "a", "b")], "v2")
    archive.put({"b.csv": [(2, "t0", datetime(2024, 6, 20, 3))]}, refs=refs)
    found = {(row[0], row[1]): row[2] for row in archive.found(refs)}
    assert found == {("folk", "2024-06-20"): 2, ("rock", "2024-06-21"): 1}


def test_empty_batches(archive):
    assert archive.put({}).touched == [] and archive.put({}, ["never.csv"]).emptied == [] and archive.found() == []
    assert archive.spark.createDataFrame([], ARCHIVED).schema == ARCHIVED
