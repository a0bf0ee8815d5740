"""The full 59-column feature plan (time -> user -> event -> network ->
temporal -> risk) and the partial plans used by single-feature queries."""

from __future__ import annotations

from pyspark.sql import DataFrame

from auditlake.functions import columns as C
from auditlake.operators import features as FT
from auditlake.operators.event_stats import EventStats, event_stats, hour_key, minute_key
from auditlake.operators.lookup import attach_many
from auditlake.schema import FEATURE_COLUMNS


def build_features(flat: DataFrame, semantics: str = C.ERROR_PRESENT,
                   stats: EventStats | None = None) -> DataFrame:
    """Flat 15-column events -> 59 feature columns in the reference order.

    Every whole-table lookup in one step first (`attach_many`: broadcast where the
    exact bound allows, the rest through a narrow projection and a single join back on
    the row id, for which the rows go with no more than their own columns); then the
    row-local rules and those that read the looked-up counts.
    """
    df = FT.spread_narrow_input(FT.with_row_id(flat))
    stats = stats or event_stats(df)
    df = df.withColumns({"_minute": minute_key(), "_hour": hour_key()})
    gaps, gap_bound, _ = FT.gap_lookup(df, tiebreak=["event_id", FT.ROW_ID], rows_bound=stats.timed_rows)
    specs = [
        (*stats.users(semantics), ["user_name"], ()),
        (*stats.event_names(), ["event_name"], ()),
        (*stats.ips(), ["source_ip"], ()),
        (*stats.minutes(), ["_minute"], ()),
        (*stats.user_hours(), ["_hour", "user_name"], ("_hour",)),
        # the first row of each time has the gap: its row id is the key, and so that of the join back
        (gaps.select(FT.ROW_ID, "_gap"), gap_bound, [FT.ROW_ID], ()),
    ]
    df = attach_many(df, specs, FT.ROW_ID)
    df = FT.add_network_flags(FT.add_event_flags(FT.add_time_features(df), semantics))
    df = FT.add_lookup_rules(stats.unseen(df))
    df = FT.add_risk(df)
    return df.select(*FEATURE_COLUMNS)


def with_user_features(flat: DataFrame, semantics: str = C.ERROR_PRESENT) -> DataFrame:
    return FT.add_user_features(flat, event_stats(flat), semantics)


def with_event_features(flat: DataFrame, semantics: str = C.ERROR_PRESENT) -> DataFrame:
    return FT.add_event_features(flat, event_stats(flat), semantics)


def with_network_features(flat: DataFrame) -> DataFrame:
    return FT.add_network_features(flat, event_stats(flat))


def with_temporal_features(flat: DataFrame) -> DataFrame:
    df = FT.with_row_id(flat)
    return FT.add_temporal_features(df, event_stats(df), tiebreak=["event_id", FT.ROW_ID])
