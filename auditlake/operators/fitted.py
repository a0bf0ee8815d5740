"""Counts fitted on one part of the events and applied to another.

A model that is judged on later events must not have seen them: user, event-name
and address counts come from the part it was fitted on. Counts of the event's own minute and
hour, and the gap to the event before, describe the present, so they come from the
part that is scored.

Keys that the fitted part lacks have count 0 and ratios 0.0 (a new user, a rare event);
a null key keeps null counts, as within one table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlake.operators.event_stats import EventStats, event_stats
from auditlake.operators.ordered import kth_smallest

# counts by the key that they belong to
KEY_COUNTS = {
    "user_name": ["user_total_events", "user_unique_ips", "user_unique_event_types", "user_error_count"],
    "event_name": ["event_type_frequency"],
    "source_ip": ["ip_event_count", "ip_unique_users"],
}


@dataclass
class FittedStats(EventStats):
    """Key counts of the fitted part, window counts of the part that they are applied to."""
    own: EventStats | None = None

    def minutes(self) -> tuple[DataFrame, int]:
        return self.own.minutes()

    def user_hours(self) -> tuple[DataFrame, int]:
        return self.own.user_hours()

    def unseen(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.when(F.col(key).isNotNull(), F.coalesce(c, F.lit(0).cast("long")))
                               for key, counts in KEY_COUNTS.items() for c in counts})


def applied(fit: EventStats, scored: DataFrame) -> FittedStats:
    own = event_stats(scored)
    return FittedStats(fit.table, fit.rows, own.total_rows, own.timed_rows, fit.exact, own)


def split_by_time(flat: DataFrame, test_percent: int = 20) -> tuple[DataFrame, DataFrame]:
    """(earlier, later) events: the cut is the time at rank (n - 1) * (100 - test_percent) // 100 of
    the n times, from 0; that time itself and events without a time are earlier."""
    at = F.unix_micros("event_time")
    times = flat.select(at.alias("t")).where(F.col("t").isNotNull())
    rows = times.count()
    if not rows:
        return flat, flat.where(F.lit(False))
    rank = (rows - 1) * (100 - test_percent) // 100
    late = F.coalesce(at > int(kth_smallest(times, "t", [rank])[rank]), F.lit(False))
    return flat.where(~late), flat.where(late)
