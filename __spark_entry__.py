
from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from importlib import import_module
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playtally import schemas
from playtally.functions import parsing
from playtally.functions.durable import durable
from playtally.operators import enrich, kpis, quality, serving
from playtally.operators.merging import merge_latest
from playtally.plans import bindings, state
from playtally.plans.daily import daily_kpis
from playtally.sources import event_archive, published
from playtally.sources.inputs import type_events
from playtally.sources.manifest import Store

FLAGSHIP_DIR = "/root/testdata/sf0.001"
LOADED = datetime(2024, 2, 1, tzinfo=timezone.utc)
RELOADED = datetime(2024, 2, 2, tzinfo=timezone.utc)
# A read clock between the expiry of the two loads.
READ = datetime(2024, 5, 1, 12, tzinfo=timezone.utc)
DAY, FIRST_DAY, LAST_DAY = "2024-01-15", "2024-01-05", "2024-01-20"
GENRE = "Brand#11"


# ---- Spark side -----------------------------------------------------------------------------------

def _enriched(spark: SparkSession, d: str, streams: DataFrame) -> DataFrame:
    return enrich.enrich(enrich.dedup_events(streams), bindings.songs(spark, d), bindings.users(spark, d))


def _lineitem(spark: SparkSession, d: str) -> DataFrame:
    return _enriched(spark, d, bindings.lineitem_streams(spark, d))


def _with_genre(spark: SparkSession, d: str, streams: DataFrame | None = None, *song_columns: str) -> DataFrame:
    """Deduplicated plays, as many as `enrich` gives, with user, genre, duration and day only: the users' country is not joined."""
    streams = bindings.lineitem_streams(spark, d) if streams is None else streams
    return enrich.genre_days(enrich.dedup_events(streams), bindings.songs(spark, d), bindings.users(spark, d), *song_columns)


def _songs_of_days(spark: SparkSession, d: str) -> DataFrame:
    return _with_genre(spark, d, None, "track_id", "track_name")


def _daily(spark: SparkSession, d: str, streams: DataFrame) -> DataFrame:
    return daily_kpis(streams, bindings.songs(spark, d), bindings.users(spark, d))


def _lineitem_kpis(spark: SparkSession, d: str) -> DataFrame:
    return _daily(spark, d, bindings.lineitem_streams(spark, d))


def _event_kpis(spark: SparkSession, d: str) -> DataFrame:
    return _daily(spark, d, bindings.event_streams(spark, d))


def _event_items(spark: SparkSession, d: str) -> DataFrame:
    return serving.kpi_items(_event_kpis(spark, d), LOADED)


def _looked_up(spark: SparkSession, d: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Stored items of some days: lookups filter what was computed once, from a range of the events."""
    kpi_rows = _daily(spark, d, bindings.event_streams(spark, d, first, last))
    return serving.kpi_items(durable(kpi_rows, spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints"), LOADED)


def _top_items(spark: SparkSession, d: str, streams: DataFrame, now: datetime) -> DataFrame:
    return serving.top_genre_items(kpis.top_genres(kpis.listen_count(_with_genre(spark, d, streams))), now)


def _event_top_items(spark: SparkSession, d: str, day: str | None = None) -> DataFrame:
    return _top_items(spark, d, bindings.event_streams(spark, d, day), LOADED)


def _shown(df: DataFrame) -> DataFrame:
    """Values that the two engines hand out differently: timestamps and integers that can be absent
    become text, decimals doubles, ranks bigint."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if field.dataType.typeName() == "timestamp":
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif field.dataType.typeName() == "decimal":
            column = column.cast("double")
        elif field.name == "rank":
            column = column.cast("bigint")
        elif field.name in ("user_id", "duration_ms"):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _report(spark: SparkSession, d: str, raw: DataFrame) -> DataFrame:
    report = quality.validation_report(raw, bindings.songs(spark, d), bindings.users(spark, d), LOADED, "plays.csv")
    return report.select(
        "status", "record_count",
        *[F.col("null_counts")[name].alias(f"null_{name}") for name in ("user_id", "track_id", "listen_time")],
        "unknown_user_pct", "unknown_track_pct", "duplicate_rows",
        F.concat_ws("; ", "errors").alias("errors"),
    )


def _merged_kpi_items(spark: SparkSession, d: str) -> DataFrame:
    """Items by order date, then a second load by ship date: shared keys are replaced, others kept."""
    first = _daily(spark, d, bindings.lineitem_streams(spark, d))
    second = _daily(spark, d, bindings.lineitem_streams(spark, d, "l_shipdate"))
    return merge_latest(serving.kpi_items(first, LOADED), serving.kpi_items(second, RELOADED), ("genre", "date"))


def _merged_top_items(spark: SparkSession, d: str) -> DataFrame:
    first = _top_items(spark, d, bindings.lineitem_streams(spark, d), LOADED)
    second = _top_items(spark, d, bindings.lineitem_streams(spark, d, "l_shipdate"), RELOADED)
    return merge_latest(first, second, ("record_type", "date"))


def _stores(spark: SparkSession) -> str:
    """A new folder on the storage that all executors share."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints"
    return f"{shared}/store-{uuid4().hex}"


def _arrived(spark: SparkSession, d: str) -> tuple[Store, state.References]:
    """An archive that every event reached in the end: in four batches, among them a file whose first version had all its plays
    a day late, and one that is withdrawn."""
    root = _stores(spark)
    store, checkpoints = Store(f"{root}/events"), f"{root}/_checkpoints"
    refs = state.References.of(bindings.songs(spark, d), bindings.users(spark, d), "1")
    files, late = bindings.event_files(spark, d), bindings.event_files(spark, d, 1)
    named = lambda df, *kinds: df.where(F.col("file_name").isin([f"{kind}.csv" for kind in kinds]))
    trial = named(late, "purchase").withColumn("file_name", F.lit("trial.csv"))
    for batch, names in (
            (named(files, "view", "error").unionByName(named(late, "click")).unionByName(trial), ["view.csv", "error.csv", "click.csv", "trial.csv"]),
            (named(files, "click"), ["click.csv"]),
            (named(files, "signup"), ["signup.csv", "trial.csv"]),
            (named(files, "purchase"), ["purchase.csv"])):
        state.take_in(spark, store, batch, names, refs, checkpoints)
    return store, refs


def _arrived_kpis(spark: SparkSession, d: str) -> DataFrame:
    store, refs = _arrived(spark, d)
    return state.state_kpis(spark, store, refs)


def _arrived_events(spark: SparkSession, d: str) -> DataFrame:
    store, _ = _arrived(spark, d)
    return event_archive.read_archived(spark, store, store.snapshot(spark), None).select("user_id", "track_id", "listen_time", "file_name")


def _published(spark: SparkSession, d: str) -> Store:
    """Two loads of the serving store: all events, and all events a day later, which replace the items of shared keys."""
    root = _stores(spark)
    store = Store(f"{root}/serving")
    for days, loaded in ((0, LOADED), (1, RELOADED)):
        kpi_rows = durable(_daily(spark, d, bindings.event_files(spark, d, days).drop("file_name")), f"{root}/_checkpoints")
        published.publish_items(spark, store, serving.kpi_items(kpi_rows, loaded), serving.top_genre_items(kpis.top_genres(kpi_rows), loaded),
                                loaded, f"{root}/_checkpoints")
    return store


def _published_expired(spark: SparkSession, d: str) -> DataFrame:
    store = _published(spark, d)
    snapshot, _ = published.expire(spark, store, READ)
    return store.read(spark, snapshot, published.BY_GENRE, schemas.KPI_ITEMS)


def entry(spark: SparkSession) -> DataFrame:
    """All KPIs of each genre and day over the large stream."""
    return _lineitem_kpis(spark, FLAGSHIP_DIR)


def _training_data(what: str) -> dict:
    """Queries or SQL of the training-data operators, nothing where they cannot be imported."""
    try:
        registry = import_module("playtally.llm.registry")
    except ImportError:
        return {}
    return getattr(registry, what)()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return own_queries() | _training_data("queries")


def oracle_sql() -> dict[str, str]:
    return own_sql() | _training_data("oracle_sql")


def own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "typed_parse": lambda s, d: _shown(type_events(bindings.dirty_raw(s, d))),
        "dedup_events": lambda s, d: _shown(enrich.dedup_events(bindings.lineitem_streams(s, d))),
        "project_songs": lambda s, d: _shown(enrich.project_songs(bindings.songs(s, d))),
        "project_users": lambda s, d: _shown(enrich.project_users(bindings.users(s, d))),
        "join_songs_left": lambda s, d: _shown(enrich.join_songs(
            bindings.lineitem_streams(s, d), bindings.songs(s, d))),
        "join_users_left": lambda s, d: _shown(enrich.join_users(
            bindings.lineitem_streams(s, d), bindings.users(s, d))),
        "enrich": lambda s, d: _shown(_lineitem(s, d)),
        "null_counts": lambda s, d: quality.quality_metrics(bindings.dirty_raw(s, d)).select(
            "null_user_id", "null_track_id", "null_listen_time"),
        "invalid_user_id": lambda s, d: quality.quality_metrics(bindings.dirty_raw(s, d)).select("invalid_user_id"),
        "invalid_track_id": lambda s, d: quality.quality_metrics(bindings.dirty_raw(s, d)).select("invalid_track_id"),
        "unparseable_time": lambda s, d: quality.quality_metrics(bindings.dirty_raw(s, d)).select(
            "record_count", "unparseable_time", "off_format_time"),
        "unknown_users": lambda s, d: quality.unknown_users(bindings.dirty_raw(s, d), bindings.users(s, d)),
        "unknown_tracks": lambda s, d: quality.unknown_tracks(bindings.dirty_raw(s, d), bindings.songs(s, d)),
        "duplicate_rows": lambda s, d: quality.duplicate_rows(bindings.repeated_raw(s, d)),
        "validation_report": lambda s, d: _report(s, d, bindings.dirty_raw(s, d)),
        "validation_report_clean": lambda s, d: _report(s, d, bindings.clean_raw(s, d)),
        "validation_report_repeated": lambda s, d: _report(s, d, bindings.repeated_raw(s, d)),
        "listen_count": lambda s, d: kpis.listen_count(_with_genre(s, d)),
        "unique_listeners": lambda s, d: kpis.unique_listeners(_with_genre(s, d)),
        "total_listen_time": lambda s, d: kpis.total_listen_time(_with_genre(s, d)),
        "user_totals": lambda s, d: _shown(kpis.user_totals(_with_genre(s, d))),
        "avg_listen_time": lambda s, d: kpis.avg_listen_time(_with_genre(s, d)).withColumn(
            "avg_listen_time_ms", F.round("avg_listen_time_ms", 2)),
        "song_plays": lambda s, d: kpis.song_plays(_songs_of_days(s, d)),
        "top3_songs_rows": lambda s, d: _shown(kpis.top_songs(kpis.song_plays(_songs_of_days(s, d)))),
        "top3_songs_json": lambda s, d: kpis.top_songs_json(kpis.top_songs(kpis.song_plays(_songs_of_days(s, d)))),
        "genre_plays": lambda s, d: kpis.genre_plays(kpis.listen_count(_with_genre(s, d))),
        "top5_genres": lambda s, d: _shown(
            kpis.top_genres(kpis.listen_count(_with_genre(s, d)))).orderBy("listen_date", "rank"),
        "distinct_dates": lambda s, d: kpis.distinct_dates(kpis.listen_count(_with_genre(s, d))),
        "distinct_genres": lambda s, d: kpis.listen_count(_with_genre(s, d)).select("track_genre").distinct(),
        "genre_kpis": _lineitem_kpis,
        "genre_kpis_events": _event_kpis,
        "genre_kpis_from_enriched": lambda s, d: kpis.genre_kpis(
            _enriched(s, d, bindings.event_streams(s, d))),
        "kpi_items": lambda s, d: _shown(_event_items(s, d)),
        "top_genre_items": _event_top_items,
        "expiry_filter": lambda s, d: _shown(serving.live(_merged_kpi_items(s, d), READ)),
        "upsert_kpis": lambda s, d: _shown(_merged_kpi_items(s, d)),
        "upsert_top_genres": _merged_top_items,
        "lookup_point": lambda s, d: _shown(serving.point(_looked_up(s, d, DAY), GENRE, DAY)),
        "lookup_genre_trend": lambda s, d: _shown(serving.trend(_looked_up(s, d), GENRE)),
        "lookup_top5_by_index": lambda s, d: _shown(serving.top_on(_looked_up(s, d, DAY), DAY)),
        "lookup_snapshot": lambda s, d: serving.snapshot(_event_top_items(s, d, DAY), DAY),
        "lookup_date_range": lambda s, d: _shown(serving.between(
            _looked_up(s, d, FIRST_DAY, LAST_DAY), GENRE, FIRST_DAY, LAST_DAY)),
        "state_kpis": _arrived_kpis,
        "archive_merged_on_read": lambda s, d: _shown(_arrived_events(s, d)),
        "published_trend": lambda s, d: _shown(published.between(s, _published(s, d), GENRE, RELOADED)),
        "published_top5": lambda s, d: _shown(published.top_on(s, _published(s, d), DAY, RELOADED)),
        "published_expired": lambda s, d: _shown(_published_expired(s, d)),
    }


# ---- SQL side -------------------------------------------------------------------------------------

_SONGS = """songs as (
  select case when p_size = 50 then 'W' || lpad(cast(p_partkey as varchar), 11, '0')
              else lpad(cast(p_partkey as varchar), 12, '0') end as track_id,
         p_name as track_name, p_brand as track_genre, cast(p_size as bigint) * 1000 as duration_ms,
         p_type as artists, cast(null as varchar) as album_name
  from part)"""

_USERS = """users as (
  select cast(case when c_acctbal < -900 then -1 - c_custkey else c_custkey end as integer) as user_id,
         n_name as user_country
  from customer join nation on c_nationkey = n_nationkey)"""


def _line(name: str = "streams", time: str = "o_orderdate") -> str:
    return f"""{name} as (
  select cast(case when o_orderstatus <> 'P' then o_custkey end as integer) as user_id,
         lpad(cast(l_partkey as varchar), 12, '0') as track_id, {time} as listen_time
  from lineitem join orders on l_orderkey = o_orderkey)"""


_EVENTS = """streams as (
  select cast(user_id as integer) as user_id, lpad(props->>'$.k', 12, '0') as track_id, ts as listen_time
  from events)"""

_DIRTY = """raw as (
  select case when event_type = 'signup' and value < 5 then null
              when event_type = 'signup' and value < 10 then 'u' || cast(user_id as varchar)
              else cast(user_id as varchar) end as user_id,
         case when event_type = 'error' and value < 5 then null
              when event_type = 'error' and value < 10 then 'bad id'
              else lpad(props->>'$.k', 12, '0') end as track_id,
         case when event_type = 'view' and value < 2 then 'not a time'
              else strftime(ts, '%Y-%m-%d %H:%M:%S') end as listen_time
  from events)"""

_TEXT = """raw as (
  select cast(user_id as varchar) as user_id, track_id,
         strftime(listen_time, '%Y-%m-%d %H:%M:%S') as listen_time from streams)"""


def _enriched_sql(suffix: str = "") -> str:
    """CTEs from streams<suffix> to enriched<suffix>."""
    return f"""deduped{suffix} as (select distinct user_id, track_id, listen_time from streams{suffix}),
enriched{suffix} as (
  select d.user_id, d.track_id, d.listen_time, s.track_name, s.artists, s.album_name, u.user_country,
         coalesce(s.track_genre, 'unknown') as track_genre,
         coalesce(s.duration_ms, 0) as duration_ms,
         strftime(d.listen_time, '%Y-%m-%d') as listen_date
  from deduped{suffix} d left join songs s on d.track_id = s.track_id
  left join users u on d.user_id = u.user_id)"""


def _kpi_sql(suffix: str = "") -> str:
    """CTEs from enriched<suffix>: each KPI on its own, merged by left joins."""
    e = f"enriched{suffix}"
    return f"""plays{suffix} as (
  select track_genre, listen_date, count(*) as listen_count, count(distinct user_id) as unique_listeners,
         cast(sum(duration_ms) as bigint) as total_listen_time_ms
  from {e} group by 1, 2),
user_totals{suffix} as (
  select user_id, track_genre, listen_date, cast(sum(duration_ms) as bigint) as user_total_ms
  from {e} group by 1, 2, 3),
averages{suffix} as (
  select track_genre, listen_date, round(avg(user_total_ms), 2) as avg_listen_time_ms
  from user_totals{suffix} group by 1, 2),
song_plays{suffix} as (
  select track_genre, listen_date, track_id, track_name, count(*) as song_listen_count
  from {e} group by 1, 2, 3, 4),
ranked_songs{suffix} as (
  select * from (
    select *, row_number() over (partition by track_genre, listen_date
      order by song_listen_count desc, track_id nulls first, track_name nulls first) as rank
    from song_plays{suffix})
  where rank <= 3),
songs_json{suffix} as (
  select track_genre, listen_date, '[' || string_agg(
    case when track_name is null
         then cast(to_json({{rank: rank, track_id: track_id, song_listen_count: song_listen_count}}) as varchar)
         else cast(to_json({{rank: rank, track_id: track_id, track_name: track_name,
                             song_listen_count: song_listen_count}}) as varchar) end,
    ',' order by rank) || ']' as top_3_songs
  from ranked_songs{suffix} group by 1, 2),
kpis{suffix} as (
  select p.track_genre, p.listen_date, p.listen_count, p.unique_listeners, p.total_listen_time_ms,
         a.avg_listen_time_ms, coalesce(j.top_3_songs, '[]') as top_3_songs
  from plays{suffix} p
  left join averages{suffix} a on p.track_genre = a.track_genre and p.listen_date = a.listen_date
  left join songs_json{suffix} j on p.track_genre = j.track_genre and p.listen_date = j.listen_date),
top_genres{suffix} as (
  select * from (
    select listen_date, track_genre, listen_count as genre_listen_count,
           row_number() over (partition by listen_date order by listen_count desc, track_genre) as rank
    from plays{suffix})
  where rank <= 5)"""


def _items_sql(suffix: str = "", loaded: datetime = LOADED) -> str:
    """CTEs from kpis<suffix> and top_genres<suffix> to serving items."""
    stamps = (f"'{loaded.isoformat(timespec='microseconds')}' as processed_at, "
              f"cast({int(loaded.timestamp())} + 90 * 86400 as bigint) as ttl_expiry")
    return f"""items{suffix} as (
  select track_genre as genre, listen_date as date, listen_count, unique_listeners, total_listen_time_ms,
         cast(cast(avg_listen_time_ms as decimal(18, 2)) as double) as avg_listen_time_ms, top_3_songs, {stamps}
  from kpis{suffix}),
top_items{suffix} as (
  select 'TOP_GENRES' as record_type, listen_date as date, '[' || string_agg(cast(to_json(
    {{rank: rank, genre: track_genre, listen_count: genre_listen_count}}) as varchar), ',' order by rank) || ']'
    as top_5_genres, {stamps}
  from top_genres{suffix} group by listen_date)"""


def _unknown_sql(kind: str, key: str, reference: str) -> str:
    return f"""{kind}_coverage as (
  select count(*) as distinct_{kind}s,
         count(*) filter (where not exists (
           select 1 from {reference} r where cast(r.{key} as varchar) = k.{key})) as unknown_{kind}s
  from (select distinct {key} from raw where {key} is not null) k)"""


_METRICS = """metrics as (
  select count(*) as record_count,
         count(*) filter (where user_id is null) as null_user_id,
         count(*) filter (where track_id is null) as null_track_id,
         count(*) filter (where listen_time is null) as null_listen_time,
         count(*) filter (where try_cast(user_id as double) is null) as invalid_user_id,
         count(*) filter (where not coalesce(regexp_full_match(track_id, '[A-Za-z0-9]{10,30}'), false))
           as invalid_track_id,
         count(*) filter (where try_strptime(listen_time, '%Y-%m-%d %H:%M:%S') is null) as unparseable_time
  from raw),
repeats as (
  select cast(coalesce(sum(n - 1), 0) as bigint) as duplicate_rows
  from (select count(*) as n from raw group by user_id, track_id, listen_time))"""

_REPORT = """judged as (
  select *, unparseable_time / record_count as bad_time, unknown_users / distinct_users as bad_users,
         unknown_tracks / distinct_tracks as bad_tracks
  from metrics, repeats, user_coverage, track_coverage),
texts as (
  select *, concat_ws('; ',
    case when null_user_id > 0 then printf('Column ''user_id'' has %d null value(s)', null_user_id) end,
    case when null_track_id > 0 then printf('Column ''track_id'' has %d null value(s)', null_track_id) end,
    case when null_listen_time > 0 then printf('Column ''listen_time'' has %d null value(s)', null_listen_time) end,
    case when invalid_user_id > 0 then printf('user_id has %d non-numeric value(s)', invalid_user_id) end,
    case when invalid_track_id > 0 then printf('track_id has %d invalid value(s)', invalid_track_id) end,
    case when bad_time > 0.001 then printf('listen_time has %d unparseable value(s) (%.2f%%)',
      unparseable_time, bad_time * 100) end,
    case when bad_users > 0.05 then printf('%.1f%% of user_ids not found in users reference (%d distinct users)',
      bad_users * 100, unknown_users) end,
    case when bad_tracks > 0.05 then printf('%.1f%% of track_ids not found in songs reference (%d distinct tracks)',
      bad_tracks * 100, unknown_tracks) end) as errors
  from judged)
select case when errors = '' then 'PASSED' else 'FAILED' end as status, record_count,
       null_user_id, null_track_id, null_listen_time, round_even(bad_users, 4) as unknown_user_pct,
       round_even(bad_tracks, 4) as unknown_track_pct, duplicate_rows, errors
from texts"""


def _with(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


def own_sql() -> dict[str, str]:
    user = "cast(user_id as varchar) as user_id"
    stamp = "strftime(listen_time, '%Y-%m-%d %H:%M:%S.%f') as listen_time"
    line = _with(_SONGS, _USERS, _line(), _enriched_sql())
    line_kpis = _with(_SONGS, _USERS, _line(), _enriched_sql(), _kpi_sql())
    event_kpis = _with(_SONGS, _USERS, _EVENTS, _enriched_sql(), _kpi_sql())
    event_items = _with(_SONGS, _USERS, _EVENTS, _enriched_sql(), _kpi_sql(), _items_sql())
    two_loads = _with(
        _SONGS, _USERS, _line("streams"), _enriched_sql(), _kpi_sql(), _items_sql(),
        _line("streams_2", "l_shipdate"), _enriched_sql("_2"), _kpi_sql("_2"), _items_sql("_2", RELOADED),
        """merged as (
  select * from items_2 union all
  select * from items a where not exists (
    select 1 from items_2 b where a.genre = b.genre and a.date = b.date)),
merged_top as (
  select * from top_items_2 union all
  select * from top_items a where not exists (select 1 from top_items_2 b where a.date = b.date))""")
    two_days = _with(
        _SONGS, _USERS, _EVENTS, _enriched_sql(), _kpi_sql(), _items_sql(),
        _EVENTS.replace("streams as", "streams_2 as").replace("ts as listen_time", "ts + interval 1 day as listen_time"),
        _enriched_sql("_2"), _kpi_sql("_2"), _items_sql("_2", RELOADED), """merged as (
  select * from items_2 union all
  select * from items a where not exists (select 1 from items_2 b where a.genre = b.genre and a.date = b.date))""")
    coverage = (_unknown_sql("user", "user_id", "users"), _unknown_sql("track", "track_id", "songs"))
    return {
        "typed_parse": _with(_DIRTY) + """select cast(try_cast(user_id as integer) as varchar) as user_id, track_id,
  strftime(try_strptime(listen_time, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S.%f') as listen_time from raw""",
        "dedup_events": _with(_line()) + f"""select {user}, track_id, {stamp}
from (select distinct user_id, track_id, listen_time from streams)""",
        "project_songs": _with(_SONGS) + """select track_id, track_name, track_genre,
  cast(duration_ms as varchar) as duration_ms, artists, album_name from songs""",
        "project_users": _with(_USERS) + f"select {user}, user_country from users",
        "join_songs_left": _with(_SONGS, _line()) + f"""select t.track_id, {user}, {stamp}, s.track_name,
  s.track_genre, cast(s.duration_ms as varchar) as duration_ms, s.artists, s.album_name
from streams t left join songs s on t.track_id = s.track_id""",
        "join_users_left": _with(_USERS, _line()) + f"""select cast(t.user_id as varchar) as user_id, t.track_id, {stamp}, u.user_country
from streams t left join users u on t.user_id = u.user_id""",
        "enrich": line + f"""select {user}, track_id, {stamp}, track_name, track_genre,
  cast(duration_ms as varchar) as duration_ms, artists,
  album_name, user_country, listen_date from enriched""",
        "null_counts": _with(_DIRTY, _METRICS) + "select null_user_id, null_track_id, null_listen_time from metrics",
        "invalid_user_id": _with(_DIRTY, _METRICS) + "select invalid_user_id from metrics",
        "invalid_track_id": _with(_DIRTY, _METRICS) + "select invalid_track_id from metrics",
        "unparseable_time": _with(_DIRTY, _METRICS) + """select record_count, unparseable_time,
  unparseable_time as off_format_time from metrics""",
        "unknown_users": _with(_USERS, _DIRTY, coverage[0]) + """select *,
  round_even(unknown_users / distinct_users, 4) as unknown_user_pct from user_coverage""",
        "unknown_tracks": _with(_SONGS, _DIRTY, coverage[1]) + """select *,
  round_even(unknown_tracks / distinct_tracks, 4) as unknown_track_pct from track_coverage""",
        "duplicate_rows": _with(_line(), _TEXT, _METRICS) + "select duplicate_rows from repeats",
        "validation_report": _with(_SONGS, _USERS, _DIRTY, _METRICS, *coverage, _REPORT),
        "validation_report_clean": _with(_SONGS, _USERS, _EVENTS, _TEXT, _METRICS, *coverage, _REPORT),
        "validation_report_repeated": _with(_SONGS, _USERS, _line(), _TEXT, _METRICS, *coverage, _REPORT),
        "listen_count": line + "select track_genre, listen_date, count(*) as listen_count from enriched group by 1, 2",
        "unique_listeners": line + """select track_genre, listen_date, count(distinct user_id) as unique_listeners
from enriched group by 1, 2""",
        "total_listen_time": line + """select track_genre, listen_date,
  cast(sum(duration_ms) as bigint) as total_listen_time_ms from enriched group by 1, 2""",
        "user_totals": line_kpis + f"select {user}, track_genre, listen_date, user_total_ms from user_totals",
        "avg_listen_time": line_kpis + "select * from averages",
        "song_plays": line_kpis + "select * from song_plays",
        "top3_songs_rows": line_kpis + "select * from ranked_songs",
        "top3_songs_json": line_kpis + "select * from songs_json",
        "genre_plays": line_kpis + "select listen_date, track_genre, listen_count as genre_listen_count from plays",
        "top5_genres": line_kpis + "select * from top_genres order by listen_date, rank",
        "distinct_dates": line + "select distinct listen_date from enriched",
        "distinct_genres": line + "select distinct track_genre from enriched",
        "genre_kpis": line_kpis + "select * from kpis",
        "genre_kpis_events": event_kpis + "select * from kpis",
        "genre_kpis_from_enriched": event_kpis + "select * from kpis",
        "kpi_items": event_items + "select * from items",
        "top_genre_items": event_items + "select * from top_items",
        "expiry_filter": two_loads + f"select * from merged where ttl_expiry > {int(READ.timestamp())}",
        "upsert_kpis": two_loads + "select * from merged",
        "upsert_top_genres": two_loads + "select * from merged_top",
        "lookup_point": event_items + f"select * from items where genre = '{GENRE}' and date = '{DAY}'",
        "lookup_genre_trend": event_items + f"select * from items where genre = '{GENRE}' order by date",
        "lookup_top5_by_index": event_items + f"""select * from items where date = '{DAY}'
order by listen_count desc, genre limit 5""",
        "lookup_snapshot": event_items + f"""select listen_date as date, rank, track_genre as genre,
  genre_listen_count as listen_count from top_genres where listen_date = '{DAY}'""",
        "lookup_date_range": event_items + f"""select * from items
where genre = '{GENRE}' and date between '{FIRST_DAY}' and '{LAST_DAY}'""",
        "state_kpis": event_kpis + "select * from kpis",
        "archive_merged_on_read": f"""select {user}, lpad(props->>'$.k', 12, '0') as track_id,
  strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as listen_time, event_type || '.csv' as file_name from events""",
        "published_trend": two_days + f"select * from merged where genre = '{GENRE}' order by date",
        "published_top5": two_days + f"select * from merged where date = '{DAY}' order by listen_count desc, genre limit 5",
        "published_expired": two_days + f"select * from merged where ttl_expiry > {int(READ.timestamp())}",
    }
