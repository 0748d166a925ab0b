"""Files that arrive in a folder: validate, compute, store.

A run lists the folder and takes every file version (path, time, length) that the ledger does not name: of any age,
in nested folders, empty ones, and a new file under a used name too. The files of a batch go through together, a job per
stage and header, with a verdict and a load report on each, and one load over the dates that they touch. Then the
ledger records what came of them, and only what it names leaves the folder: to the archive after success, else to
the dead letter. A run that breaks off before the ledger is written is repeated as a whole; every write replaces what
it wrote before. Only verdicts on data send a file to dead letter; errors of storage or cluster end the run.
"""

import logging
import re
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from playtally import schemas
from playtally.functions.clock import iso_text, system_clock
from playtally.operators.quality import file_verdicts
from playtally.plans.daily import daily_kpis
from playtally.plans.load import Layout, archive_kpis, load_serving
from playtally.plans.state import References, state_kpis, take_in
from playtally.sources import dead_letters, event_archive, files, inputs, ledger, references, reports
from playtally.sources.files import Source

log = logging.getLogger(__name__)

_FILE, _EXTRA = "_file", "_extra_cells"
VALIDATION, TRANSFORM = "validation", "transform"
EXTRA_CELLS_TEXT = "{} row(s) have more cells than the header"


@dataclass(frozen=True)
class Settings:
    """What a run needs to know. With `accumulate` files that share a date add up, and a new version of a file replaces
    its old one; without, files go one by one and the last one's KPIs replace those of its genres and dates.
    `multi_line_references` allows line breaks in song and user texts, at the price of one task per reference file."""

    songs_path: str
    users_path: str
    layout: Layout
    clock: Callable[[], datetime] = system_clock
    ttl_days: int = schemas.TTL_DAYS
    accumulate: bool = True
    json_export: bool = False
    multi_line_references: bool = True


def _literal(path: str) -> str:
    """The path with pattern characters escaped, so that a reader takes it as the name of one file."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _references(spark: SparkSession, settings: Settings) -> references.ReferenceSnapshot:
    return references.current(spark, settings.layout.references, settings.songs_path, settings.users_path, settings.multi_line_references)


def _reference_keys(spark: SparkSession, settings: Settings) -> tuple[DataFrame | None, DataFrame | None]:
    """Track and user keys for validation, or nothing when the reference cannot be found."""
    try:
        return _references(spark, settings).keys
    except AnalysisException as error:
        log.warning("the reference cannot be parsed as a whole: %s", error)
    try:
        return (
            inputs.read_reference_keys(spark, settings.songs_path, "track_id", settings.multi_line_references),
            inputs.read_reference_keys(spark, settings.users_path, "user_id", settings.multi_line_references),
        )
    except AnalysisException as error:
        log.warning("no integrity check, reference data is unreadable: %s", error)
        return None, None


def _by_header(spark: SparkSession, source: str, batch: list[Source]) -> dict[tuple, list[str]]:
    groups: dict[tuple, list[str]] = {}
    for file in batch:
        header = inputs.header_of(files.first_line(spark, f"{source}/{file.path}"))
        groups.setdefault(tuple(header), []).append(file.path)
    return groups


def _read(spark: SparkSession, source: str, header: tuple, paths: list[str]) -> DataFrame:
    """The rows of files that share a header, each with its file's path below the source in _FILE."""
    raw = inputs.read_raw_files(spark, [_literal(f"{source}/{path}") for path in paths], [*header], _FILE, _EXTRA)
    return raw.withColumn(_FILE, F.substring_index(F.col(_FILE), files.folder_prefix(spark, source), -1))


def _verdicts(spark: SparkSession, raw: DataFrame | None, header: tuple, paths: list[str], settings: Settings,
              keys: tuple[DataFrame | None, DataFrame | None]) -> list[dict]:
    """The verdict on each file of a group, in one job; a file without rows gets one of zero counts."""
    now = settings.clock()
    missing = sorted(set(schemas.REQUIRED_COLUMNS) - set(header))
    if missing:
        counts = {} if raw is None else {row[_FILE]: row["count"] for row in raw.groupBy(_FILE).count().collect()}
        return [{"status": schemas.FAILED, "input_key": path, "record_count": counts.get(path, 0),
                 "errors": [schemas.MISSING_COLUMNS_TEXT.format(missing)], "validated_at": iso_text(now)} for path in paths]
    songs, users = keys
    judged = file_verdicts(raw.drop(_EXTRA), songs, users, now, _FILE)
    extra = raw.groupBy(_FILE).agg(F.count_if(_EXTRA).alias("extra")).withColumnRenamed(_FILE, "input_key")
    found = {row["input_key"]: row.asDict() for row in judged.join(extra, "input_key").collect()}
    share = None if songs is None else 0.0
    verdicts = []
    for path in paths:
        verdict = found.get(path) or {
            "status": schemas.PASSED, "input_key": path, "record_count": 0, "null_counts": dict.fromkeys(schemas.REQUIRED_COLUMNS, 0),
            "unknown_user_pct": share, "unknown_track_pct": share, "duplicate_rows": 0, "errors": [],
            "validated_at": iso_text(now), "off_format_time": 0, "off_type_user_id": 0, "extra": 0}
        if verdict["extra"]:
            verdict |= {"status": schemas.FAILED, "errors": [EXTRA_CELLS_TEXT.format(verdict["extra"]), *verdict["errors"]]}
        for name in ("duplicate_rows", "off_type_user_id"):
            if verdict[name]:
                log.warning("%s: %d %s", path, verdict[name], name)
        verdicts.append(verdict)
    return verdicts


def _to_dead_letter(spark: SparkSession, source: str, failed: dict[str, list[str]], stage: str, layout: Layout) -> None:
    if failed:
        paths = [_literal(f"{source}/{path}") for path in failed]
        path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        lines = spark.read.text(paths).select("value", F.substring_index(path, files.folder_prefix(spark, source), -1).alias("file_name"))
        dead_letters.write_dead_letters(lines, failed, stage, layout.dead_letters)


def _store(spark: SparkSession, accepted: list[tuple[DataFrame, list[str]]], off_format: bool,
           settings: Settings) -> tuple[dict[str, list[str]], list[str], list[str]]:
    """Archive the plays of accepted files and the KPIs of the dates they touch; the dates by file, the dates with new KPIs,
    and those that hold nothing but what is archived now."""
    layout = settings.layout
    known = _references(spark, settings)
    raw = None
    for rows, paths in accepted:
        part = rows.where(F.col(_FILE).isin(paths)).select(*schemas.REQUIRED_COLUMNS, _FILE)
        raw = part if raw is None else raw.unionByName(part)
    names = [path for _, paths in accepted for path in paths]
    usable, rejects = inputs.usable_rows(raw)
    if off_format:
        dead_letters.write_rejects(rejects, F.col(_FILE), layout.rejects)
    events = inputs.type_events(usable, _FILE)
    if not settings.accumulate:
        dates = archive_kpis(daily_kpis(events.drop(_FILE), known.songs, known.users), layout, settings.json_export)
        return dict.fromkeys(names, dates), dates, []
    return _accumulate(spark, events.withColumnRenamed(_FILE, "file_name"), names, known.for_kpis, settings)


def _accumulate(spark: SparkSession, events: DataFrame, names: list[str], refs: References,
                settings: Settings) -> tuple[dict[str, list[str]], list[str], list[str]]:
    layout = settings.layout
    earlier = ledger.earlier_dates(spark, layout.ledger, names)
    change = take_in(spark, layout.event_store, events, names, refs, layout.checkpoints, earlier)
    for date in change.emptied:
        for table in ("genre_kpis", "top_genres"):
            for fmt in ("parquet", "json"):
                files.delete(spark, f"{layout.archive(table, fmt)}/listen_date={date}")
    if change.touched:
        archive_kpis(state_kpis(spark, layout.event_store, refs, change.touched), layout, settings.json_export)
    return change.by_file, change.touched, [*change.touched, *change.emptied]


def withdraw(spark: SparkSession, paths: list[str], settings: Settings) -> list[str]:
    """Take back what some files (paths below the source) have brought: their plays leave the archive, the KPIs and the
    serving store; returns the dates that changed. The ledger notes it, so the same file versions are not taken again."""
    empty = spark.createDataFrame([], event_archive.ARCHIVED).drop("listen_date")
    _, dates, replaced = _accumulate(spark, empty, paths, _references(spark, settings).for_kpis, settings)
    if replaced:
        load_serving(spark, settings.layout, settings.clock(), settings.ttl_days, dates, replaced=replaced)
    ledger.withdraw(spark, settings.layout.ledger, paths)
    return replaced


def process_batch(spark: SparkSession, source: str, batch: list[Source], settings: Settings) -> dict[str, str]:
    """Take some files through all stages; what came of each by path: "done", or the stage that it failed."""
    layout, staging = settings.layout, f"{settings.layout.checkpoints}/reports-{uuid4().hex}"
    verdicts, accepted, off_format = [], [], False
    keys = _reference_keys(spark, settings)
    for header, paths in _by_header(spark, source, batch).items():
        raw = _read(spark, source, header, paths) if header else None
        judged = _verdicts(spark, raw, header, paths, settings, keys)
        verdicts += judged
        passed = [verdict["input_key"] for verdict in judged if verdict["status"] == schemas.PASSED]
        off_format |= any(verdict.get("off_format_time") for verdict in judged if verdict["input_key"] in passed)
        if passed:
            accepted.append((raw, passed))
    reports.write_validation_reports(spark, verdicts, layout.root, staging)
    failed = {verdict["input_key"]: verdict["errors"] for verdict in verdicts if verdict["status"] == schemas.FAILED}
    _to_dead_letter(spark, source, failed, VALIDATION, layout)
    names = [path for _, paths in accepted for path in paths]
    outcome = dict.fromkeys(failed, VALIDATION) | dict.fromkeys(names, ledger.DONE)
    by_file: dict[str, list[str]] = {}
    try:
        by_file, dates, replaced = _store(spark, accepted, off_format, settings) if accepted else ({}, [], [])
    except AnalysisException as error:
        # The reference is missing or lacks columns: these files cannot be computed. Anything else ends the run.
        log.exception("a batch failed in stage %s", TRANSFORM)
        _to_dead_letter(spark, source, {name: [f"{type(error).__name__}: {error}"] for name in names}, TRANSFORM, layout)
        outcome |= dict.fromkeys(names, TRANSFORM)
        dates = replaced = []
    if dates or replaced:
        report = load_serving(spark, layout, settings.clock(), settings.ttl_days, dates, replaced=replaced)
        reports.write_load_reports(spark, report, layout.root, names, staging)
    files.delete(spark, staging)
    ledger.append(spark, layout.ledger, [(file, outcome[file.path], by_file.get(file.path, [])) for file in batch])
    return outcome


def _put_away(spark: SparkSession, source: str, taken: dict[Source, str], layout: Layout) -> None:
    """Move what the ledger names out of the source, by outcome. A file that has changed since stays."""
    for file, outcome in taken.items():
        if files.is_unchanged(spark, source, file):
            area = layout.archived_sources if outcome == ledger.DONE else layout.dead_sources
            target = f"{area}/{file.path}"
            if files.exists(spark, target):
                target += f".{file.modified}"
            files.move(spark, f"{source}/{file.path}", target)


def run_arrivals(spark: SparkSession, source: str, settings: Settings, files_per_batch: int = 1000) -> dict[str, str]:
    """Handle every file version in `source` that the ledger does not name; what came of each by path."""
    layout = settings.layout
    listed = files.list_sources(spark, source)
    taken = ledger.outcomes(spark, layout.ledger, listed)
    _put_away(spark, source, taken, layout)
    waiting = [file for file in listed if file not in taken]
    size = files_per_batch if settings.accumulate else 1
    outcome: dict[str, str] = {}
    for first in range(0, len(waiting), size):
        batch = waiting[first:first + size]
        found = process_batch(spark, source, batch, settings)
        log.info("%d files: %s", len(batch), found)
        _put_away(spark, source, {file: found[file.path] for file in batch}, layout)
        outcome |= found
    return outcome


def reload_all(spark: SparkSession, settings: Settings) -> DataFrame:
    """Load every archived date again, which renews its expiry: a call of its own, on a schedule of its own."""
    return load_serving(spark, settings.layout, settings.clock(), settings.ttl_days)


def watch_arrivals(spark: SparkSession, source: str, settings: Settings, checkpoint: str, seconds: int = 10,
                   files_per_batch: int = 1000) -> StreamingQuery:
    """`run_arrivals` again and again, paced by a stream of ticks."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()

    def handle(_: DataFrame, __: int) -> None:
        run_arrivals(spark, source, settings, files_per_batch)

    return (ticks.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(processingTime=f"{seconds} seconds").start())
