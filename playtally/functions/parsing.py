"""Typed parsing of CSV text. A value that does not parse becomes null; nothing raises under ANSI mode."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from playtally import schemas

# Layouts a free-form datetime reader accepts besides ISO 8601, most specific first.
_OTHER_DATETIME_LAYOUTS = (
    "yyyy/M/d H:mm:ss", "yyyy/M/d H:mm", "yyyy/M/d",
    "M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy",
    "d/M/yyyy H:mm:ss", "d/M/yyyy H:mm", "d/M/yyyy",
    "yyyyMMdd HHmmss", "yyyyMMdd",
    "MMM d, yyyy H:mm:ss", "MMM d, yyyy", "d MMM yyyy H:mm:ss", "d MMM yyyy",
    "MMMM d, yyyy", "d MMMM yyyy",
)


def null_if_token(text: Column) -> Column:
    """Null for the cell texts that mean "no value"."""
    return F.when(~text.isin(*schemas.NULL_TOKENS), text)


def parse_int(text: Column) -> Column:
    return text.try_cast("int")


def parse_long(text: Column) -> Column:
    return text.try_cast("bigint")


def parse_listen_time(text: Column) -> Column:
    """Timestamp in the one layout that the KPIs accept."""
    return F.try_to_timestamp(text, F.lit(schemas.LISTEN_TIME_FORMAT))


def parse_any_datetime(text: Column) -> Column:
    """Timestamp in any layout that validation tolerates."""
    attempts = [parse_listen_time(text), text.try_cast("timestamp")]
    attempts += [F.try_to_timestamp(text, F.lit(layout)) for layout in _OTHER_DATETIME_LAYOUTS]
    return F.coalesce(*attempts)


def is_number(text: Column) -> Column:
    """True for numeric text, false for anything else and for null."""
    # The JVM also reads a type suffix ("1d", "2f") as part of a number; no CSV reader does.
    suffixed = text.rlike("[0-9.][dDfF]\\s*$")
    return F.coalesce(text.try_cast("double").isNotNull() & ~suffixed, F.lit(False))


def is_track_id(text: Column) -> Column:
    """True for a well-formed track id, false for anything else and for null."""
    return F.coalesce(text.rlike(schemas.TRACK_ID_PATTERN), F.lit(False))


def key_text(text: Column) -> Column:
    """Comparable key text: whole numbers lose padding and leading zeros, other text stays as it is."""
    return F.coalesce(text.try_cast("bigint").cast("string"), text)


def listen_date(listen_time: Column) -> Column:
    return F.date_format(listen_time, schemas.LISTEN_DATE_FORMAT)


def is_date_text(text: Column) -> Column:
    """True for text shaped like a date: ten characters with dashes after the year and the month."""
    return (F.length(text) == 10) & (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)
