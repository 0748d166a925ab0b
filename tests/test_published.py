"""Versions that are published in one step: readers, crashes, layouts, expiry."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from playtally import schemas
from playtally.operators import serving
from playtally.sources import manifest, published
from playtally.sources.manifest import ConflictError, Store

NOW = datetime(2024, 6, 26, 12, tzinfo=timezone.utc)


def rows(df):
    return sorted(tuple(row) for row in df.collect())


def frames(spark, when, plays):
    """Items of {(genre, date): plays}, and the top genres of their dates."""
    kpis = spark.createDataFrame([(genre, date, n, 1, 100, 100.0, "[]") for (genre, date), n in plays.items()], schemas.GENRE_KPIS)
    by_date = {}
    for (genre, date), n in sorted(plays.items(), key=lambda one: (-one[1], one[0])):
        by_date.setdefault(date, []).append((genre, n))
    top = spark.createDataFrame([(date, genre, n, i + 1) for date, ranked in by_date.items() for i, (genre, n) in enumerate(ranked[:5])], schemas.TOP_GENRE_ROWS)
    return serving.kpi_items(kpis, when), serving.top_genre_items(top, when)


class Deployment:
    def __init__(self, spark, folder):
        self.spark, self.store, self.checkpoints = spark, Store(str(folder / "serving")), str(folder / "checkpoints")

    def put(self, plays, when=NOW, **options):
        return published.publish_items(self.spark, self.store, *frames(self.spark, when, plays), when, self.checkpoints, **options)

    def held(self, snapshot=None, now=NOW):
        return {(row.genre, row.date): row.listen_count for row in published.items(self.spark, self.store, now, snapshot).collect()}


@pytest.fixture
def deployment(spark, tmp_path):
    return Deployment(spark, tmp_path)


def test_a_reader_sees_one_version_whole_during_a_load(deployment, monkeypatch):
    old = {("a", "2024-06-24"): 1, ("a", "2024-06-25"): 2, ("b", "2024-06-25"): 3}
    deployment.put(old)
    held = deployment.store.snapshot(deployment.spark)
    seen = []
    write = Store.write

    def watched(self, *args, **options):
        made = write(self, *args, **options)
        seen.append(deployment.held())  # a new reader, after each table that the load has written
        return made

    monkeypatch.setattr(Store, "write", watched)
    deployment.put({("a", "2024-06-24"): 10, ("a", "2024-06-25"): 20, ("c", "2024-06-26"): 30}, NOW + timedelta(hours=1))
    assert len(seen) == 4 and all(one == old for one in seen)
    assert deployment.held() == {("a", "2024-06-24"): 10, ("a", "2024-06-25"): 20, ("b", "2024-06-25"): 3, ("c", "2024-06-26"): 30}
    assert deployment.held(held) == old


@pytest.mark.parametrize("written", [0, 1, 2, 3, 4])
def test_an_interrupted_load_is_invisible_and_can_be_repeated(deployment, monkeypatch, written):
    old, new = {("a", "2024-06-25"): 2, ("b", "2024-06-25"): 3}, {("a", "2024-06-25"): 7}
    deployment.put(old)
    write, publish, count = Store.write, Store.publish, []

    def broken(self, *args, **options):
        if len(count) == written:
            raise OSError("executors are lost")
        count.append(1)
        return write(self, *args, **options)

    def never(self, *args, **options):
        raise OSError("driver is lost")

    monkeypatch.setattr(Store, "write", broken)
    monkeypatch.setattr(Store, "publish", never)
    with pytest.raises(OSError):
        deployment.put(new, NOW + timedelta(hours=1))
    assert deployment.held() == old
    monkeypatch.setattr(Store, "write", write)
    monkeypatch.setattr(Store, "publish", publish)
    deployment.put(new, NOW + timedelta(hours=1))
    assert deployment.held() == {("a", "2024-06-25"): 7, ("b", "2024-06-25"): 3}
    gone = deployment.store.vacuum(deployment.spark)
    assert len(gone) == written and deployment.held() == {("a", "2024-06-25"): 7, ("b", "2024-06-25"): 3}


def test_of_two_writers_one_wins(deployment):
    deployment.put({("a", "2024-06-25"): 1})
    base = deployment.store.snapshot(deployment.spark)
    deployment.store.publish(deployment.spark, base, base.files)
    with pytest.raises(ConflictError):
        deployment.store.publish(deployment.spark, base, [])
    assert deployment.held() == {("a", "2024-06-25"): 1}


def test_replaced_dates_hold_only_the_new_rows(deployment):
    deployment.put({("a", "2024-06-24"): 1, ("b", "2024-06-24"): 2, ("a", "2024-06-25"): 3, ("a", "2024-06-26"): 4})
    deployment.put({("b", "2024-06-24"): 5}, NOW + timedelta(hours=1), replaced=["2024-06-24", "2024-06-25"])
    assert deployment.held() == {("b", "2024-06-24"): 5, ("a", "2024-06-26"): 4}
    later = NOW + timedelta(hours=2)
    assert [row.date for row in published.between(deployment.spark, deployment.store, "a", later).collect()] == ["2024-06-26"]
    assert published.top_on(deployment.spark, deployment.store, "2024-06-25", later).collect() == []
    assert published.snapshot_on(deployment.spark, deployment.store, "2024-06-25", later).collect() == []


def test_random_loads_answer_every_lookup_like_a_plain_table(deployment):
    pick, plain, spark, store = random.Random(3), {}, deployment.spark, deployment.store
    genres, dates = [f"g{i}" for i in range(8)], [f"2024-06-{day}" for day in range(10, 16)]
    for step in range(8):
        new = {(pick.choice(genres), pick.choice(dates)): pick.randrange(100) for _ in range(pick.randrange(1, 20))}
        replaced = {date for _, date in new} if step % 3 == 2 else set()
        plain = {key: n for key, n in plain.items() if key[1] not in replaced} | new
        deployment.put(new, NOW + timedelta(minutes=step), replaced=replaced)
        if step == 5:
            assert len({one.load for one in published.compact_by_genre(spark, store, NOW, deployment.checkpoints, 3).of(published.BY_GENRE)}) == 1
        assert deployment.held() == plain
    for genre in genres[:4]:
        found = [(row.date, row.listen_count) for row in published.between(spark, store, genre, NOW).collect()]
        assert found == sorted((date, n) for (g, date), n in plain.items() if g == genre)
        part = [(row.date, row.listen_count) for row in published.between(spark, store, genre, NOW, dates[1], dates[3]).collect()]
        assert part == [one for one in found if dates[1] <= one[0] <= dates[3]]
    for date in dates[:3]:
        found = [(row.genre, row.listen_count) for row in published.top_on(spark, store, date, NOW).collect()]
        assert found == [(g, n) for n, g in sorted(((n, g) for (g, d), n in plain.items() if d == date), key=lambda one: (-one[0], one[1]))][:5]
        assert rows(published.point(spark, store, "g1", date, NOW).select("listen_count")) == [(plain.get(("g1", date)),)] * (("g1", date) in plain)


def test_trend_opens_the_files_of_its_genre(deployment, monkeypatch):
    monkeypatch.setattr(published, "GENRE_FILE_ROWS", 20)
    dates = [f"2024-06-{day}" for day in range(10, 20)]
    deployment.put({(f"g{i:02}", date): i for i in range(40) for date in dates})
    snapshot = deployment.store.snapshot(deployment.spark)
    every = snapshot.of(published.BY_GENRE)
    trend = published.between(deployment.spark, deployment.store, "g17", NOW)
    opened = {path.rpartition("/")[2] for path in trend.inputFiles()}
    assert trend.count() == 10 and len(every) > 4
    assert opened == {one.path.rpartition("/")[2] for one in every if one.low["genre"] <= "g17" <= one.high["genre"]} and len(opened) <= 2
    assert all(f"/data/{published.BY_GENRE}/" in path for path in trend.inputFiles())


def test_top_reads_the_ranking_alone_also_after_a_count_fell(deployment):
    date = "2024-06-25"
    deployment.put({(f"g{i:02}", date): 100 - i for i in range(60)} | {("g00", "2024-06-24"): 1})
    top = published.top_on(deployment.spark, deployment.store, date, NOW)
    assert [row.genre for row in top.collect()] == ["g00", "g01", "g02", "g03", "g04"]
    deployment.put({("g00", date): 0, ("g02", date): 1}, NOW + timedelta(hours=1))
    top = published.top_on(deployment.spark, deployment.store, date, NOW)
    assert [row.genre for row in top.collect()] == ["g01", "g03", "g04", "g05", "g06"]
    assert all(f"/data/{published.RANKING}/" in path and date in path for path in top.inputFiles())
    # Below the ranking's depth the items themselves are read.
    assert published.top_on(deployment.spark, deployment.store, date, NOW, 60).count() == 60


def test_expiry_opens_only_mixed_files(deployment):
    spark, store = deployment.spark, deployment.store
    deployment.put({("old", "2024-06-23"): 1, ("x", "2024-06-24"): 2, ("y", "2024-06-24"): 5})
    deployment.put({("x", "2024-06-24"): 3, ("new", "2024-06-25"): 4}, NOW + timedelta(days=1))
    now = NOW + timedelta(days=90)
    live = {("x", "2024-06-24"): 3, ("new", "2024-06-25"): 4}
    assert deployment.held(now=now) == live
    assert [row.genre for row in published.top_on(spark, store, "2024-06-24", now).collect()] == ["x"]
    before = store.snapshot(spark)
    made, opened = published.expire(spark, store, now)
    assert opened and all("2024-06-24" in path or f"{manifest.LOAD}=" in path for path in opened)
    kpi = {one.date for one in before.of(published.KPI) if one.path in opened}
    assert kpi == {"2024-06-24"} and made.dates(published.KPI) == ["2024-06-24", "2024-06-25"]
    untouched = [one for one in before.of(published.KPI) if one.date == "2024-06-25"]
    assert {*untouched} <= {*made.files}
    assert deployment.held(now=NOW) == live and all(one.low["ttl_expiry"] > now.timestamp() for one in made.files)
    assert published.expire(spark, store, now) == (made, [])
    assert [row.date for row in published.between(spark, store, "x", now).collect()] == ["2024-06-24"]


def test_vacuum_keeps_what_recent_versions_need(deployment):
    for hour in range(5):
        deployment.put({("a", "2024-06-25"): hour}, NOW + timedelta(hours=hour))
    held = deployment.store.snapshot(deployment.spark, 4)
    assert deployment.store.vacuum(deployment.spark, keep=2)
    assert deployment.store.versions(deployment.spark) == [4, 5]
    assert deployment.held(held) == {("a", "2024-06-25"): 3} and deployment.held() == {("a", "2024-06-25"): 4}


def test_an_empty_store_and_empty_loads(deployment):
    spark, store = deployment.spark, deployment.store
    assert deployment.held() == {} and published.expire(spark, store, NOW)[1] == []
    assert published.between(spark, store, "a", NOW).collect() == [] and published.top_on(spark, store, "2024-06-25", NOW).collect() == []
    deployment.put({})
    assert deployment.held() == {} and store.versions(spark) == [1]
