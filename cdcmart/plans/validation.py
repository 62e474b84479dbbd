"""What the incremental tables would contain, reconstructed from the source."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcmart.functions.casts import cast_columns, safe_cast
from cdcmart.functions.times import AsOf, as_date, as_micros, date_lit, micros_to_date
from cdcmart.operators.dedup import SOURCE_TS, latest_by_key, with_source_ts
from cdcmart.operators.windows import since, since_date
from cdcmart.plans.silver import order_items_clean
from cdcmart.sources.schemas import ITEMS_SPEC


def simulate_incremental(
    raw: DataFrame,
    as_of: AsOf,
    total_days: int = 90,
    tie_breakers: Sequence[str] | None = None,
    *,
    whole_days: bool = True,
) -> DataFrame:
    """Table B: one pass over all events of the last ``total_days`` days.

    With ``whole_days`` the window starts at midnight, like the baseline it is compared with; without, at the
    time of day of ``as_of``, which makes rows early on the first day look lost.
    """
    window = since_date if whole_days else since
    return order_items_clean(window(raw, as_of, total_days), tie_breakers)


def replay_incremental(
    raw: DataFrame,
    first_day: AsOf,
    last_day: AsOf,
    window_days: int = 7,
    tie_breakers: Sequence[str] | None = None,
) -> DataFrame:
    """The items table after one incremental run at the end of every day from ``first_day`` to ``last_day``.

    The run of day d merges the latest version per key among events that have arrived by d and were created not
    earlier than ``window_days`` before d. There is no loop over the days: an event takes part in the runs from its
    day of arrival to its day of creation plus the window, so its last run is known from the event alone, and what a
    key holds at the end is the latest version among the events of the key's last run.
    """
    arrived = F.to_date(safe_cast(SOURCE_TS, "timestamp"))
    created = F.to_date(safe_cast("created_at", "timestamp"))
    first_run = F.greatest(arrived, date_lit(first_day))
    last_run = F.least(F.date_add(created, window_days), date_lit(last_day))
    # greatest and least skip NULLs; without a creation time an event is in no window.
    events = with_source_ts(raw).where(created.isNotNull() & (first_run <= last_run))
    if tie_breakers is None:
        tie_breakers = [c for c in raw.columns if c != "id"]
    ranked = latest_by_key(events.withColumn("__last_run", last_run), ["id"], "__last_run", [SOURCE_TS, *tie_breakers])
    return cast_columns(ranked, ITEMS_SPEC)


def _window_starts(events: DataFrame, first: date, last: date, cap: bool) -> list[tuple[date, int | None]]:
    """(day, newest creation time in the target before the run of that day), for every day; None is an empty target.

    What has arrived by a day is either in the window of that day's run or older than what the target holds already,
    so the newest moment merged is a running maximum over the days of arrival. One row per day is fetched at most.
    """
    daily = events.groupBy("__first_run").agg(F.unix_micros(F.max("__created")).alias("top")).where("top IS NOT NULL")
    tops = {row["__first_run"]: row["top"] for row in daily.collect()}
    out: list[tuple[date, int | None]] = []
    held = None
    for n in range((last - first).days + 1):
        run = first + timedelta(days=n)
        out.append((run, min(held, as_micros(run, -1)) if cap and held is not None else held))
        if run in tops:
            held = max(tops[run], held) if held is not None else tops[run]
    return out


def _runs_by_moment(spark: SparkSession, starts: list[tuple[date, int | None]], horizon: date) -> tuple[date, DataFrame]:
    """The last run whose window reaches back to a moment, as intervals of moments, each listed under every calendar day
    it touches, so that it is found by an equality. Days before the first start, which is returned too, and behind the
    horizon are listed as those two."""
    bounds = {top: run for run, top in starts if top is not None}  # of equal starts the last run
    low = min(micros_to_date(min(bounds)), horizon) if bounds else horizon
    edges = [(None, max(run for run, top in starts if top is None)), *sorted(bounds.items())]
    rows = []
    for (begin, run), end in zip(edges, [*(top for top, _ in edges[1:]), None]):
        day = low if begin is None else min(max(micros_to_date(begin), low), horizon)
        until = horizon if end is None else min(micros_to_date(end), horizon)
        while day <= until:
            rows.append((day, begin, end, run))
            day += timedelta(days=1)
    return low, spark.createDataFrame(rows, "__day date, __from bigint, __to bigint, __last_run date")


def replay_to_target(
    raw: DataFrame,
    first_day: AsOf,
    last_day: AsOf,
    window_days: int = 7,
    tie_breakers: Sequence[str] | None = None,
    *,
    cap_future: bool = False,
) -> DataFrame:
    """The items table after one run of the job at the end of every day from ``first_day`` to ``last_day``.

    The first run loads all events that have arrived. Every later one merges the latest version per key among the
    arrived events that were created not earlier than ``window_days`` before the newest row the *target* holds, as the
    job does; after a gap in the feed that window lies further back than one counted from the day of the run.

    There is no loop over merges. Windows only move on, so an event takes part in all runs from the day of its arrival
    to the last one whose window reaches back to its creation. That run is looked up by moment in a table of one row
    per day, and what a key holds at the end is the latest version among the events of its last run.

    The creation time of a key must not differ between its versions, or a merge could lower the newest moment. Events
    without a creation time are only in runs that find an empty target. ``cap_future`` lets no row dated after a run
    move its window beyond the run.
    """
    spark = raw.sparkSession
    first, last = as_date(first_day), as_date(last_day)
    if last < first:
        return cast_columns(raw.where(F.lit(False)), ITEMS_SPEC)
    arrived = F.to_date(safe_cast(SOURCE_TS, "timestamp"))
    events = with_source_ts(raw).withColumns(
        {"__created": safe_cast("created_at", "timestamp"), "__first_run": F.greatest(arrived, F.lit(first))}
    )
    events = events.where(F.col("__first_run") <= F.lit(last))

    starts = _window_starts(events, first, last, cap_future)
    horizon = last + timedelta(days=window_days + 2)
    low, runs = _runs_by_moment(spark, starts, horizon)
    only_empty = max(run for run, top in starts if top is None)
    behind = F.unix_micros("__created") + window_days * 86_400_000_000
    day = F.least(F.to_date(F.timestamp_micros(behind)), F.lit(horizon))
    events = events.withColumns({"__behind": behind, "__at": F.greatest(day, F.lit(low))})
    inside = (
        (F.col("__at") == F.col("__day"))
        & (F.col("__from").isNull() | (F.col("__behind") >= F.col("__from")))
        & (F.col("__to").isNull() | (F.col("__behind") < F.col("__to")))
    )
    # At most one row for each day of the replay and each start, whatever the feed holds.
    placed = events.join(F.broadcast(runs), inside, "left")
    placed = placed.withColumn("__last_run", F.coalesce("__last_run", F.lit(only_empty)))
    if tie_breakers is None:
        tie_breakers = [c for c in raw.columns if c != "id"]
    taking_part = placed.where(F.col("__first_run") <= F.col("__last_run"))
    return cast_columns(latest_by_key(taking_part, ["id"], "__last_run", [SOURCE_TS, *tie_breakers]), ITEMS_SPEC)
