"""Baselines that outlive a job: daily mergeable counts under numbered versions.

A store is a folder with three Parquet tables:

* `counts`: the grouping-sets counts of `event_stats`, by run and day. Counts of days add
  up, and pairs of keys (user and address, user and event name) keep distinct counts exact
  after any merge.
* `sketches`: per day and key one HyperLogLog sketch in place of its pairs, so distinct counts
  over any range of days cost a row a day and key (`LG_K` = 12: a standard error of
  1.04 / sqrt(4096) = 1.6 %).
* `commits`: which run holds each day, once for each version.

A commit writes its days under a run of its own first, then appends one file of commit rows. That
file is the pointer: before it nobody sees the run, after it everybody sees
all of it; a job that dies in between leaves rows that no version names. A version
takes over the days that it doesn't replace. One writer at a time; readers need no lock.

`enrich_stream` looks the version up for each micro-batch, so a restarted stream
goes on with the newest committed version.

Defined cases: events without a time belong to the day `none`; a store without a commit is version 0, in
which all counts are null; an empty commit makes a version that changes nothing.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.functions import columns as C
from auditlake.operators.event_stats import GID, KEYS, SETS, EventStats, hour_key, minute_key
from auditlake.operators.lookup import broadcast_or_shuffle, materialize

LG_K = 12
NO_DAY = "none"
COMMIT = "version long, day string, run string"
COUNT = ("user_name string, source_ip string, event_name string, _minute timestamp, _hour timestamp, n long, err_present long, "
         "err_reference long, _gid long, run string, day string")
SKETCH = ("kind string, key string, n long, err_present long, err_reference long, ips binary, event_names binary, users binary, "
          "run string, day string")


def day_of(time_col: str = "event_time"):
    return F.coalesce(F.to_date(time_col).cast("string"), F.lit(NO_DAY))


def daily_counts(flat: DataFrame) -> DataFrame:
    """The counts of `event_stats` by day: one scan, one shuffle."""
    base = flat.select(
        day_of().alias("day"), "user_name", "source_ip", "event_name", minute_key().alias("_minute"), hour_key().alias("_hour"),
        C.has_error("error_code", C.ERROR_PRESENT).alias("_ep"), C.has_error("error_code", C.ERROR_REFERENCE).alias("_er"))
    # the day is in every set, so its bit of the grouping id is 0 and the ids are those of `event_stats`
    return base.groupingSets([["day", *members] for members in SETS.values()], "day", *KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("_ep").alias("err_present"), F.count_if("_er").alias("err_reference"),
        F.grouping_id().alias("_gid"))


def daily_sketches(counts: DataFrame) -> DataFrame:
    """One row for each day and user, address or event name, with sketches of what it met."""
    by_ip, by_name = F.col("_gid") == GID["user_ip"], F.col("_gid") == GID["user_event"]

    def of(kind: str, key: str, rows, ips=None, names=None, users=None) -> DataFrame:
        none = F.lit(None).cast("binary")
        whole = by_name if kind == "event" else by_ip       # the set that counts each event once
        sums = [F.sum(F.when(whole, F.col(c))).alias(c) for c in ("n", "err_present", "err_reference")]
        # a sketch leaves out empty text, which counts here: every value gets a first letter
        sketch = [(none if x is None else F.hll_sketch_agg(F.concat(F.lit("="), x), LG_K)).alias(c) for c, x in (("ips", ips), ("event_names", names), ("users", users))]
        held = counts.where(rows & F.col(key).isNotNull())
        return held.groupBy("day", F.lit(kind).alias("kind"), F.col(key).alias("key")).agg(*sums, *sketch)

    return (of("user", "user_name", by_ip | by_name, F.when(by_ip, F.col("source_ip")), F.when(by_name, F.col("event_name")))
            .unionByName(of("ip", "source_ip", by_ip, users=F.col("user_name")))
            .unionByName(of("event", "event_name", by_name, users=F.col("user_name"))))


@dataclass
class BaselineStore:
    spark: SparkSession
    base: str
    held: dict = field(default_factory=dict)       # the merged counts of the version asked for last

    def _read(self, table: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.base}/{table}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def version(self) -> int:
        """The newest committed version; 0 before the first."""
        return self._read("commits", COMMIT).agg(F.max("version")).first()[0] or 0

    def days(self, version: int | None = None) -> DataFrame:
        """(day, run) of a version."""
        version = self.version() if version is None else version
        return self._read("commits", COMMIT).where(F.col("version") == version).where("day is not null").select("day", "run")

    def commit(self, flat: DataFrame) -> int:
        """Counts of the days of `flat` become part of the next version, in place of what it held of these days.
        `flat` has to hold its days whole. Returns the version."""
        run = uuid.uuid4().hex
        for table, made in (("counts", daily_counts), ("sketches", daily_sketches)):
            rows = made(flat) if table == "counts" else made(self._read("counts", COUNT).where(F.col("run") == run))
            (rows.withColumn("run", F.lit(run)).hint("rebalance", F.col("day"))
             .write.mode("append").partitionBy("run", "day").parquet(f"{self.base}/{table}"))
        before = self.version()
        new = self._read("counts", COUNT).where(F.col("run") == run).select("day", "run").distinct()
        old = self.days(before).join(new.select("day"), "day", "left_anti")
        rows, seen = materialize(new.unionByName(old), "baseline-days", n=F.count(F.lit(1)))
        if not seen["n"]:                          # a version of no days is still a version
            rows = self.spark.createDataFrame([(None, run)], "day string, run string")
        # a row a day in one file: it appears as a whole or not at all
        rows.select(F.lit(before + 1).cast("long").alias("version"), "day", "run").coalesce(1).write.mode("append").parquet(f"{self.base}/commits")
        return before + 1

    def _of(self, table: str, schema: str, version: int | None, first: str | None, last: str | None) -> DataFrame:
        days = self.days(version)
        if first is not None:
            days = days.where(F.col("day") >= first)
        if last is not None:
            days = days.where(F.col("day") <= last)
        days, seen = materialize(days, "baseline-range", n=F.count(F.lit(1)))
        return self._read(table, schema).join(broadcast_or_shuffle(days, int(seen["n"] or 0)), ["run", "day"], "left_semi")

    def stats(self, version: int | None = None, first: str | None = None, last: str | None = None) -> EventStats:
        """Exact counts of a version, or of its days from `first` to `last`, as `event_stats` gives them
        for one table."""
        version = self.version() if version is None else version
        key = (version, first, last)
        if key not in self.held:
            merged = (self._of("counts", COUNT, version, first, last).groupBy("_gid", *KEYS)
                      .agg(*[F.sum(c).alias(c) for c in ("n", "err_present", "err_reference")]))
            here = {name: F.col("_gid") == g for name, g in GID.items()}
            table, seen = materialize(merged, "baseline-merged", **{name: F.count_if(c) for name, c in here.items()},
                                      total=F.sum(F.when(here["user_ip"], F.col("n"))),
                                      timed=F.sum(F.when(here["minute"] & F.col("_minute").isNotNull(), F.col("n"))))
            self.held = {key: EventStats(table, {name: int(seen.get(name) or 0) for name in GID},
                                         int(seen.get("total") or 0), int(seen.get("timed") or 0))}
        return self.held[key]

    def approximate(self, kind: str, version: int | None = None, first: str | None = None, last: str | None = None) -> DataFrame:
        """(key, n, err_present, err_reference, ips, event_names, users) of `user`, `ip` or `event` keys: exact sums, and
        distinct counts estimated from united sketches (0 where the kind has none)."""
        rows = self._of("sketches", SKETCH, version, first, last).where(F.col("kind") == kind)
        return rows.groupBy("key").agg(
            *[F.sum(c).alias(c) for c in ("n", "err_present", "err_reference")],
            *[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in ("ips", "event_names", "users")])
