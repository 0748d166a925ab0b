"""The clock is always an argument, so that a run can be repeated exactly."""

from datetime import datetime, timedelta, timezone


def utc(now: datetime) -> datetime:
    return now.replace(tzinfo=timezone.utc) if now.tzinfo is None else now.astimezone(timezone.utc)


def iso_text(now: datetime) -> str:
    """ISO 8601 with fixed microseconds, so that texts sort in time order."""
    return utc(now).isoformat(timespec="microseconds")


def epoch_seconds(now: datetime, days: int = 0) -> int:
    return int((utc(now) + timedelta(days=days)).timestamp())


def system_clock() -> datetime:
    return datetime.now(timezone.utc)
