"""The ``as_of`` moment as literals.

Every operator that depends on the current time takes ``as_of``. It is turned into a literal on the driver, so that
Catalyst can prune partitions and row groups with it, and so that every step of one run sees the same moment.
"""

from __future__ import annotations

from datetime import UTC, date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = datetime | date | str | None

_EPOCH = datetime(1970, 1, 1, tzinfo=UTC)


def as_instant(as_of: AsOf) -> datetime:
    """``as_of`` as an aware UTC datetime; a value without a zone is taken as UTC, None is now."""
    if as_of is None:
        return datetime.now(UTC)
    if isinstance(as_of, str):
        as_of = datetime.fromisoformat(as_of)
    if not isinstance(as_of, datetime):
        as_of = datetime(as_of.year, as_of.month, as_of.day)
    return as_of.replace(tzinfo=UTC) if as_of.tzinfo is None else as_of.astimezone(UTC)


def as_micros(as_of: AsOf, minus_days: int = 0) -> int:
    return (as_instant(as_of) - timedelta(days=minus_days) - _EPOCH) // timedelta(microseconds=1)


def as_date(as_of: AsOf, minus_days: int = 0) -> date:
    return (as_instant(as_of) - timedelta(days=minus_days)).date()


def micros_lit(micros: int) -> Column:
    return F.timestamp_micros(F.lit(micros).cast("bigint"))


def instant_lit(as_of: AsOf, minus_days: int = 0) -> Column:
    # Through epoch microseconds: a naive Python datetime would be read in the zone of the driver machine.
    return micros_lit(as_micros(as_of, minus_days))


def date_lit(as_of: AsOf, minus_days: int = 0) -> Column:
    return F.lit(as_date(as_of, minus_days))


def micros_to_date(micros: int) -> date:
    return (_EPOCH + timedelta(microseconds=micros)).date()
