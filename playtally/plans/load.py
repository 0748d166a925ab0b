"""Storing KPIs: the dated archive of a run, and the load of the keyed serving tables from it."""

import logging
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playtally import schemas
from playtally.functions.clock import iso_text
from playtally.functions.durable import durable
from playtally.operators import serving
from playtally.operators.kpis import top_genres
from playtally.plans.daily import daily_kpis
from playtally.sources import published
from playtally.sources.event_archive import read_events
from playtally.sources.manifest import Store
from playtally.sources.tables import read_kpis, read_table, read_top_genres, write_by_date

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Layout:
    """Where a deployment keeps its data, below one root on shared storage."""

    root: str

    def archive(self, table: str, fmt: str = "parquet") -> str:
        return f"{self.root}/processed/{table}/{fmt}"

    @property
    def events(self) -> str:
        return f"{self.root}/events"

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejects"

    @property
    def dead_letters(self) -> str:
        return f"{self.root}/dead-letter/files"

    @property
    def archived_sources(self) -> str:
        return f"{self.root}/archive"

    @property
    def dead_sources(self) -> str:
        return f"{self.root}/dead-letter/sources"

    @property
    def ledger(self) -> str:
        return f"{self.root}/ledger"

    @property
    def event_store(self) -> Store:
        return Store(self.events)

    @property
    def references(self) -> Store:
        return Store(f"{self.root}/references")

    @property
    def serving(self) -> Store:
        return Store(f"{self.root}/serving/published")

    @property
    def kpi_items(self) -> str:
        return f"{self.root}/serving/kpis"

    @property
    def top_genre_items(self) -> str:
        return f"{self.root}/serving/top_genres"

    @property
    def checkpoints(self) -> str:
        return f"{self.root}/_checkpoints"


class NoDatesError(ValueError):
    """The archive holds no date partition to load."""


def archive_kpis(kpis: DataFrame, layout: Layout, json_export: bool = False) -> list[str]:
    """Replace the archive partitions of the dates in `kpis`; returns those dates.

    The KPIs are made durable first: every further frame and write starts from these few rows per day.
    """
    kpis = durable(kpis, layout.checkpoints)
    span = kpis.agg(
        F.array_sort(F.collect_set("listen_date")).alias("dates"),
        F.count_distinct("track_genre").alias("genres"),
    ).first()
    log.info("KPIs of %d genres on %d dates", span["genres"], len(span["dates"]))
    if not span["dates"]:
        return []
    top = top_genres(kpis)
    for fmt in ("parquet", "json") if json_export else ("parquet",):
        write_by_date(kpis, layout.archive("genre_kpis", fmt), fmt)
        write_by_date(top, layout.archive("top_genres", fmt), fmt)
    return span["dates"]


def recompute_dates(spark: SparkSession, layout: Layout, songs: DataFrame, users: DataFrame,
                    dates: Iterable[str], json_export: bool = False) -> list[str]:
    """Rebuild the archive of some dates from all archived events of those dates, whichever file they
    came in; exact accumulation over files that share a date."""
    stored = read_events(spark, layout.events, dates)
    return archive_kpis(daily_kpis(stored, songs, users), layout, json_export)


def load_serving(spark: SparkSession, layout: Layout, now: datetime, ttl_days: int = schemas.TTL_DAYS,
                 dates: Iterable[str] | None = None, fmt: str = "parquet", replaced: Iterable[str] = ()) -> DataFrame:
    """Put the archived KPIs into the serving store, in one step, and return the one-row load report.

    Without `dates` every archived date is loaded again, which also renews its expiry. Dates in `replaced` then hold what
    the archive holds and nothing else; on other dates genres that the archive lacks stay.
    """
    kpis = read_kpis(spark, layout.archive("genre_kpis", fmt), dates, fmt)
    top = read_top_genres(spark, layout.archive("top_genres", fmt), dates, fmt)
    found = kpis.agg(F.array_sort(F.collect_set("listen_date")).alias("dates"), F.count(F.lit(1)).alias("items")).first()
    loaded, replaced = found["dates"], [*replaced]
    if not loaded and not replaced:
        raise NoDatesError(f"no date partitions under {layout.archive('genre_kpis', fmt)}")
    published.publish_items(spark, layout.serving, serving.kpi_items(kpis, now, ttl_days), serving.top_genre_items(top, now, ttl_days),
                            now, layout.checkpoints, replaced)
    ranked = top.select("listen_date").distinct().count()
    return spark.createDataFrame([(schemas.SUCCEEDED, found["items"], ranked, loaded, iso_text(now))], schemas.LOAD_REPORT)


def _stored(spark: SparkSession, layout: Layout, now: datetime, table: str, plain: str) -> DataFrame:
    """The published items; those of a plain keyed table where nothing was published yet."""
    snapshot = layout.serving.snapshot(spark)
    if snapshot.version:
        return published.items(spark, layout.serving, now, snapshot, table)
    return serving.live(read_table(spark, plain, published.SCHEMAS[table]), now)


def stored_kpi_items(spark: SparkSession, layout: Layout, now: datetime) -> DataFrame:
    """The unexpired KPI items, for the lookups of `operators.serving`; those of `sources.published` open fewer files."""
    return _stored(spark, layout, now, published.KPI, layout.kpi_items)


def stored_top_genre_items(spark: SparkSession, layout: Layout, now: datetime) -> DataFrame:
    return _stored(spark, layout, now, published.TOP, layout.top_genre_items)
