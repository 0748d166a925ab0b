"""KPI operators on small tables, against plain Python, and the shape of their plans."""

import json
import random
import re
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from playtally import schemas
from playtally.functions.counts import StageCounts
from playtally.operators import kpis
from playtally.operators.enrich import dedup_events, enrich
from playtally.operators.joins import left_join_reference, measured_bytes
from playtally.operators.merging import merge_latest
from playtally.plans import daily
from playtally.plans.daily import daily_kpis

DAY = datetime(2024, 6, 25, 10)


def events(spark, rows):
    return spark.createDataFrame(rows, schemas.EVENTS)


def songs(spark, rows):
    return spark.createDataFrame([(*row, None, None) for row in rows], schemas.SONGS)


def users(spark, rows):
    return spark.createDataFrame(rows, schemas.USERS)


def both_plans(spark, play_rows, song_rows, user_rows):
    """The KPI rows from the two ways to compute them, after checking that they agree."""
    parts = events(spark, play_rows), songs(spark, song_rows), users(spark, user_rows)
    shaped = {tuple(row) for row in daily_kpis(*parts).collect()}
    enriched = enrich(dedup_events(parts[0]), *parts[1:])
    assert shaped == {tuple(row) for row in kpis.genre_kpis(enriched).collect()}
    return {(row[0], row[1]): row[2:] for row in shaped}


def brute_force(play_rows, song_rows, user_rows):
    by_track, by_user = defaultdict(list), Counter()
    for track, name, genre, duration in song_rows:
        by_track[track].append((name, genre or "unknown", duration or 0))
    for user, _ in user_rows:
        by_user[user] += user is not None
    groups = defaultdict(list)
    for user, track, time in set(play_rows):
        if time is None:
            continue
        for name, genre, duration in by_track.get(track) or [(None, "unknown", 0)]:
            for _ in range(max(1, by_user[user] if user is not None else 1)):
                groups[genre, time.strftime("%Y-%m-%d")].append((user, track, name, duration))
    result = {}
    for key, plays in groups.items():
        totals = Counter()
        for user, _, _, duration in plays:
            totals[user] += duration
        listeners = {user for user, *_ in plays} - {None}
        counted = Counter((track, name) for _, track, name, _ in plays)
        ranked = sorted(counted.items(), key=lambda e: (-e[1], e[0][0] or "", e[0][1] or ""))[:3]
        top = [{"rank": i, "track_id": t, "track_name": n, "song_listen_count": c}
               for i, ((t, n), c) in enumerate(ranked, 1)]
        top = [{k: v for k, v in song.items() if v is not None} for song in top]
        total = sum(totals.values())
        result[key] = (len(plays), len(listeners), total, total / len(totals), top)
    return result


@pytest.mark.parametrize("seed, repeated_users", [(1, False), (2, True)])
def test_random_tables_agree_with_plain_python(spark, seed, repeated_users):
    rng = random.Random(seed)
    tracks = [f"track{i:05}" for i in range(12)]
    song_rows = [(t, f"name {t[-1]}" if rng.random() < .9 else None, rng.choice(["pop", "rock", None]),
                  rng.choice([100, 250, None])) for t in tracks[:9]]
    song_rows.append((tracks[0], "again", "jazz", 70))  # a track listed twice fans out
    user_rows = [(u, "DE") for u in range(6)] + ([(3, "FR"), (3, "IT"), (None, "XX"), (None, "XX")]
                                                 if repeated_users else [])
    # A third of the plays are of one track, a third come without a user, and many are exact copies.
    play_rows = [(rng.choice([None, None, *range(8)]), rng.choice([tracks[0]] * 4 + tracks + [None]),
                  rng.choice([None] + [DAY + timedelta(hours=9 * h) for h in range(6)])) for _ in range(600)]
    got = both_plans(spark, play_rows, song_rows, user_rows)
    expected = brute_force(play_rows, song_rows, user_rows)
    assert set(got) == set(expected)
    for key, (count, unique, total, average, top) in expected.items():
        assert got[key][:3] == (count, unique, total)
        assert got[key][3] == pytest.approx(average, abs=0.0051)
        assert json.loads(got[key][4]) == top


def test_orphan_track(spark):
    got = both_plans(spark, [(1, "gone", DAY)], [("t", "n", "pop", 5)], [(1, "DE")])
    assert got == {("unknown", "2024-06-25"): (1, 1, 0, 0.0,
                   '[{"rank":1,"track_id":"gone","song_listen_count":1}]')}


def test_listeners_and_average(spark):
    plays = [(1, "t", DAY), (1, "t", DAY + timedelta(seconds=1)), (2, "t", DAY)]
    got = both_plans(spark, plays, [("t", "n", "pop", 100)], [(1, "DE"), (2, "DE")])
    assert got["pop", "2024-06-25"][:4] == (3, 2, 300, 150.0)


def test_absent_user_counts_once_in_the_average_only(spark):
    got = both_plans(spark, [(None, "t", DAY), (1, "t", DAY)], [("t", "n", "pop", 50)], [(1, "DE")])
    assert got["pop", "2024-06-25"][:4] == (2, 1, 100, 50.0)


def test_plays_without_a_day_are_in_no_row(spark):
    assert both_plans(spark, [(1, "t", None)], [("t", "n", "pop", 50)], [(1, "DE")]) == {}


def test_ties_break_by_id_and_by_name(spark):
    plays = [(1, f"t{i}", DAY) for i in (3, 1, 4, 2)]
    got = both_plans(spark, plays, [(f"t{i}", "n", "pop", 1) for i in range(5)], [])
    top = json.loads(got["pop", "2024-06-25"][4])
    assert [(song["rank"], song["track_id"]) for song in top] == [(1, "t1"), (2, "t2"), (3, "t3")]
    counts = spark.createDataFrame([(g, "d", 7) for g in "fbdaec"], "track_genre string, listen_date string, "
                                                                    "listen_count long")
    ranked = kpis.top_genres(counts).orderBy("rank").collect()
    assert [(row["rank"], row["track_genre"]) for row in ranked] == list(enumerate("abcde", 1))


def test_listen_counts_add_up_to_the_deduplicated_plays(spark):
    plays = [(u, f"t{u % 3}", DAY + timedelta(hours=h % 5)) for u in range(20) for h in range(10)]
    frame = events(spark, plays)
    counts = StageCounts()
    rows = daily_kpis(frame, songs(spark, [("t1", "n", "pop", 1)]), users(spark, [(1, "DE")]), counts).collect()
    assert sum(row.listen_count for row in rows) == 100 == dedup_events(frame).count()
    assert counts.all() == {"users": 1, "streams": 100, "songs": 1, "enriched": 100}


def test_dedup_is_idempotent_and_ignores_order(spark):
    plays = [(None, "t", DAY), (None, "t", DAY), (1, None, DAY), (1, None, DAY), (1, "t", None)]
    once = dedup_events(events(spark, plays))
    assert once.count() == 3 == dedup_events(once).count()
    assert sorted(map(repr, once.collect())) == sorted(map(repr, dedup_events(events(spark, plays[::-1])).collect()))


def test_shuffled_salted_join_equals_the_broadcast_join(spark):
    # One key holds most rows, some rows have no key, one reference key is listed twice.
    plays = [(n, "hot" if n % 3 else ["cold", None, "gone"][n % 9 // 3], DAY) for n in range(300)]
    listed = songs(spark, [("hot", "a", "pop", 1), ("hot", "b", "rock", 2), ("cold", "c", "pop", 3), (None, "x", "y", 4)])
    frame = events(spark, plays)
    small = sorted(map(repr, left_join_reference(frame, listed, "track_id", broadcast=True).collect()))
    for salts in (1, 8):
        joined = left_join_reference(frame, listed, "track_id", broadcast=False, salts=salts)
        assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.columns == left_join_reference(frame, listed, "track_id", broadcast=True).columns
        assert sorted(map(repr, joined.collect())) == small


def test_large_reference_is_shuffled_with_the_same_result(spark, monkeypatch):
    plays = [(n % 7, f"t{n % 5}", DAY + timedelta(minutes=n)) for n in range(60)]
    listed = [(f"t{n}", f"n{n}", "pop" if n % 2 else "rock", n) for n in range(4)]
    parts = events(spark, plays), songs(spark, listed), users(spark, [(1, "DE"), (1, "FR")])
    small = {tuple(row) for row in daily_kpis(*parts).collect()}
    assert measured_bytes(parts[1])[0] > 10
    monkeypatch.setattr(daily, "fits_broadcast", lambda size: False)
    assert {tuple(row) for row in daily_kpis(*parts).collect()} == small


def test_salt_spreads_a_hot_key(spark):
    plays = events(spark, [(n, "hot", DAY + timedelta(seconds=n)) for n in range(2000)])
    joined = left_join_reference(plays, songs(spark, [("hot", "a", "pop", 1)]), "track_id", broadcast=False, salts=64)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in plan and "rand(" not in plan  # a recomputed task must draw the same salt


def test_plays_of_one_track_without_a_user_on_one_day_spread(spark, monkeypatch):
    from playtally.operators import joins

    monkeypatch.setattr(joins, "fits_broadcast", lambda size: False)
    plays = events(spark, [(None, "hot", DAY + timedelta(milliseconds=n)) for n in range(20_000)])
    dated = plays.select("user_id", "track_id", F.to_date("listen_time").alias("listen_date"), "listen_time")
    salts = dated.select(F.pmod(F.xxhash64("user_id", "listen_date", "listen_time"), F.lit(64)).alias("s")).groupBy("s").count()
    assert salts.count() == 64 and salts.agg(F.max("count")).first()[0] < 2 * 20_000 / 64
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = left_join_reference(dated, songs(spark, [("hot", "a", "pop", 1)]), "track_id")
        per_task = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(per_task) >= 6 and max(row["count"] for row in per_task) < 8000


def test_measured_bytes_cover_rows_of_nulls(spark):
    sparse = spark.createDataFrame([(None, None, None)] * 1000, "a string, b bigint, c string")
    assert measured_bytes(sparse) == [1000 * (40 + 8 + 24)]
    texts = spark.createDataFrame([("x" * 100, 1, "é" * 50)] * 10, "a string, b bigint, c string")
    assert measured_bytes(texts, sparse.limit(0)) == [10 * (40 + 8 + 24 + 107 + 107), 0]


def test_average_is_exact_beyond_doubles(spark):
    grain = spark.createDataFrame([(n, "pop", "2024-06-25", 1, ms) for n, ms in enumerate((2**53, 1, 1))],
                                  "user_id int, track_genre string, listen_date string, plays bigint, listened_ms bigint")
    assert kpis.genre_metrics(grain).first().avg_listen_time_ms == round((2**53 + 2) / 3, 2)


def test_lookup_reads_a_range_of_times_and_shares_the_shuffle(spark):
    from playtally.plans import bindings
    from tests.conftest import TESTDATA

    scale = str(TESTDATA / "sf0.001")
    day = bindings.event_streams(spark, scale, "2024-01-15")
    plan = daily_kpis(day, bindings.songs(spark, scale), bindings.users(spark, scale))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts,2024-01-15", text) and "LessThan(ts,2024-01-16" in text
    plan.collect()
    assert "ReusedExchange" in plan._jdf.queryExecution().executedPlan().toString()


def test_merge_keeps_the_latest_of_each_key(spark):
    schema = "genre string, date string, n int, processed_at string"
    old = spark.createDataFrame([("a", "d", 1, "2024-01-01"), ("b", "d", 2, "2024-01-01"), ("c", "d", 3, "2024-01-09")],
                                schema)
    new = spark.createDataFrame([("a", "d", 9, "2024-01-02"), ("b", "d", 8, "2024-01-01"), ("c", "d", 7, "2024-01-02")],
                                schema)
    merged = merge_latest(old, new, ("genre", "date"))
    assert sorted((r.genre, r.n) for r in merged.collect()) == [("a", 9), ("b", 8), ("c", 3)]
    again = merge_latest(merged, new, ("genre", "date"))
    assert sorted(map(repr, again.collect())) == sorted(map(repr, merged.collect()))


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("counts", [None, StageCounts()])
def test_plan_shuffles_events_once_for_copies_and_limits_groups_early(spark, counts):
    from tests.conftest import TESTDATA
    from playtally.plans import bindings
    sf = str(TESTDATA / "sf0.001")
    plan = executed(daily_kpis(bindings.lineitem_streams(spark, sf), bindings.songs(spark, sf),
                               bindings.users(spark, sf), counts))
    assert "ReusedExchange" in plan
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    deduplicating = [key for key in keys if "listen_time" in key]
    # The exchange itself, and the reference to it from the other branch.
    assert len(deduplicating) == 2 and len(set(re.sub(r"#\d+", "", key) for key in deduplicating)) == 1
    assert plan.count("WindowGroupLimit") == 2
    for expensive in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython"):
        assert expensive not in plan
    assert "l_extendedprice" not in plan and "p_retailprice" not in plan


def test_only_hot_keys_repeat_the_reference(spark):
    from playtally.operators.joins import SALTS, hot_keys, spread_reference

    # A third of the plays on one track, a third without a track, the rest over 3,000 tracks.
    plays = spark.range(30_000).select(F.col("id").alias("n"), F.when(F.col("id") % 3 == 0, F.lit("hot")).when(
        F.col("id") % 3 == 2, F.concat(F.lit("t"), F.floor(F.col("id") / 3) % 3000)).alias("track_id"))
    listed = spark.range(3000).select(F.concat(F.lit("t"), "id").alias("track_id"), F.col("id").alias("ms")).unionByName(
        spark.createDataFrame([("hot", -1), ("hot", -2)], "track_id string, ms bigint"))
    hot = hot_keys(plays, "track_id")
    assert hot == ["hot"]
    spread = spread_reference(listed, "track_id", hot, SALTS)
    assert spread.count() <= 1.1 * listed.count() and spread.where("track_id = 'hot'").count() == 2 * SALTS
    joined = left_join_reference(plays, listed, "track_id", broadcast=False)
    expected = plays.join(F.broadcast(listed), "track_id", "left")
    assert joined.count() == 40_000 and joined.exceptAll(expected.select(joined.columns)).count() == 0
    # Both the hot track and the plays without one are dealt out over all salts.
    salts = joined._jdf.queryExecution().analyzed().toString()
    assert "_salt" in salts
    for part in (plays.where("track_id = 'hot'"), plays.where("track_id is null")):
        drawn = part.select(F.pmod(F.xxhash64("n"), F.lit(SALTS)).alias("s")).groupBy("s").count()
        assert drawn.count() == SALTS


def test_hot_keys_are_bounded_and_may_be_none(spark):
    from playtally.operators.joins import hot_keys

    even = spark.range(10_000).select((F.col("id") % 5000).alias("k"))
    assert hot_keys(even, "k") == [] and hot_keys(even.limit(0), "k") == []
    assert hot_keys(spark.createDataFrame([(None,)] * 5, "k int"), "k") == []
    assert len(hot_keys(spark.range(100).select((F.col("id") % 3).alias("k")), "k", most=2)) <= 2
