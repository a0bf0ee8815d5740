"""Whole-table per-key statistics behind the aggregate-back features.

The reference runs nine separate group-bys and maps each back onto the rows.
Here one `GROUPING SETS` aggregate over a five-column projection produces all
of them in a single scan and a single (partially aggregated, so skew-proof)
shuffle:

    (user_name, source_ip)   -> user totals, user distinct IPs, IP totals, IP distinct users
    (user_name, event_name)  -> user distinct event names, event-name totals
    (minute)                 -> events per calendar minute
    (hour, user_name)        -> events per calendar hour and user

The result is written as a table into the shared checkpoint folder; the exact row
count of each set is the proven bound used to decide broadcast vs shuffle for
each lookup derived from it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from auditlake.functions import columns as C
from auditlake.operators.lookup import fits_broadcast, materialize

KEYS = ["user_name", "source_ip", "event_name", "_minute", "_hour"]
SETS = {
    "user_ip": ["user_name", "source_ip"],
    "user_event": ["user_name", "event_name"],
    "minute": ["_minute"],
    "hour_user": ["_hour", "user_name"],
}


def _gid(members: list[str]) -> int:
    n = len(KEYS)
    return sum(1 << (n - 1 - i) for i, k in enumerate(KEYS) if k not in members)


GID = {name: _gid(cols) for name, cols in SETS.items()}


def minute_key(time_col: str = "event_time"):
    return F.date_trunc("minute", F.col(time_col))


def hour_key(time_col: str = "event_time"):
    return F.date_trunc("hour", F.col(time_col))


@dataclass
class EventStats:
    table: DataFrame          # grouping-sets result, written to the checkpoint folder
    rows: dict                # set name -> exact row count
    total_rows: int = 0       # rows of the input
    timed_rows: int = 0       # rows of the input with a time
    exact: dict = field(default_factory=dict)   # key -> distinct keys, where counted

    def key_count(self, key: str, pairs: str, lookup: DataFrame) -> int:
        """Rows of a single-key lookup. The number of pairs it is made from is a bound;
        where that is too loose for a broadcast, its own rows are counted (a small
        aggregate of the written table)."""
        loose = self.rows[pairs]
        if fits_broadcast(self.table.sparkSession, lookup.schema, loose):
            return loose
        if key not in self.exact:
            self.exact[key] = self._set(pairs).select(key).distinct().count()
        return self.exact[key]

    # ---------------------------------------------------------- lookups
    def _set(self, name: str) -> DataFrame:
        return self.table.where(F.col("_gid") == GID[name])

    def users(self, semantics: str = C.ERROR_PRESENT) -> tuple[DataFrame, int]:
        err = "err_present" if semantics == C.ERROR_PRESENT else "err_reference"
        if semantics not in C.ERROR_SEMANTICS:
            raise ValueError(semantics)
        ui, ue = F.col("_gid") == GID["user_ip"], F.col("_gid") == GID["user_event"]
        lk = (self.table.where((ui | ue) & F.col("user_name").isNotNull())
              .groupBy("user_name")
              .agg(F.sum(F.when(ui, F.col("n"))).alias("user_total_events"),
                   F.count(F.when(ui, F.col("source_ip"))).alias("user_unique_ips"),
                   F.count(F.when(ue, F.col("event_name"))).alias("user_unique_event_types"),
                   F.sum(F.when(ui, F.col(err))).alias("user_error_count")))
        return lk, self.key_count("user_name", "user_ip", lk)

    def ips(self) -> tuple[DataFrame, int]:
        lk = (self._set("user_ip").where(F.col("source_ip").isNotNull())
              .groupBy("source_ip")
              .agg(F.sum("n").alias("ip_event_count"),
                   F.count("user_name").alias("ip_unique_users")))
        return lk, self.key_count("source_ip", "user_ip", lk)

    def event_names(self) -> tuple[DataFrame, int]:
        lk = (self._set("user_event").where(F.col("event_name").isNotNull())
              .groupBy("event_name").agg(F.sum("n").alias("event_type_frequency")))
        return lk, self.key_count("event_name", "user_event", lk)

    def minutes(self) -> tuple[DataFrame, int]:
        lk = (self._set("minute").where(F.col("_minute").isNotNull())
              .select("_minute", F.col("n").alias("events_this_minute")))
        return lk, self.rows["minute"]

    def user_hours(self) -> tuple[DataFrame, int]:
        lk = (self._set("hour_user").where(F.col("user_name").isNotNull())
              .select("_hour", "user_name", F.col("n").alias("user_events_this_hour")))
        return lk, self.rows["hour_user"]

    def unseen(self, df: DataFrame) -> DataFrame:
        """What keys without counts get. Counts of the table itself have every key."""
        return df


def event_stats(df: DataFrame, time_col: str = "event_time") -> EventStats:
    """One scan, one shuffle: all per-key counts, materialised."""
    base = df.select(
        "user_name", "source_ip", "event_name",
        minute_key(time_col).alias("_minute"), hour_key(time_col).alias("_hour"),
        C.has_error("error_code", C.ERROR_PRESENT).alias("_ep"),
        C.has_error("error_code", C.ERROR_REFERENCE).alias("_er"),
    )
    counted = base.observe(
        obs := Observation("event_rows"), F.count(F.lit(1)).alias("rows"),
        F.count("_minute").alias("timed"))
    grouped = counted.groupingSets([SETS[s] for s in SETS], *KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("_ep").alias("err_present"),
        F.count_if("_er").alias("err_reference"),
        F.grouping_id().alias("_gid"),
    )
    table, counts = materialize(grouped, "event_stats", **{
        name: F.count_if(F.col("_gid") == g) for name, g in GID.items()})
    rows = {name: int(counts.get(name) or 0) for name in GID}
    if not any(rows.values()):     # an empty input is planned without the observation
        return EventStats(table, rows)
    seen = obs.get
    return EventStats(table, rows, int(seen["rows"] or 0), int(seen["timed"] or 0))
