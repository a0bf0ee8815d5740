"""Registered queries: one callable per operator key, `(spark, sf_dir) -> DataFrame`.

Every query starts from the driver tables (the `trail` fixture over `events`)
or from data Spark derives from them, over the whole table. Timestamps leave
as TIMESTAMP_NTZ (wall clock of the UTC session).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlake.functions import columns as C
from auditlake.functions import lists as L
from auditlake.ml import evaluate as EV
from auditlake.ml import prepare as PR
from auditlake.operators import features as FT
from auditlake.operators import summaries as SM
from auditlake.operators import threats as TH
from auditlake.operators.event_stats import event_stats
from auditlake.operators.feeds import match_feed
from auditlake.operators.lookup import attach, materialize
from auditlake.operators.parse import parse_events
from auditlake.plans import catalog as CAT
from auditlake.plans import detection as DET
from auditlake.plans import stored
from auditlake.plans.features import (build_features, with_event_features, with_network_features,
                                      with_temporal_features, with_user_features)
from auditlake.schema import FEATURE_COLUMNS, PARSED_COLUMNS
from auditlake.session import prepare, scratch_path
from auditlake.sources import publish as PB
from auditlake.sources import sinks as K
from auditlake.sources import variant as V
from auditlake.sources.fixture import trail
from auditlake.sources.raw import flat_to_raw, flatten_events, read_raw_records, write_raw_files
from auditlake.streaming import ingest as ST

Query = Callable[[SparkSession, str], DataFrame]

HOLDOUT_COLUMNS = ["user_total_events", "user_unique_ips", "user_unique_event_types", "user_error_count", "user_error_rate",
                   "user_activity_diversity", "is_new_user", "event_type_frequency", "is_rare_event", "ip_event_count", "ip_unique_users",
                   "events_this_minute", "user_events_this_hour"]

# HotSpot never compiles a method of more bytes than this: a stage over the 59 columns that
# Spark generates as one such method runs interpreted, so Spark is to run it operator by operator
COMPILED_BYTES = "8000"


def out(df: DataFrame) -> DataFrame:
    """Emit TIMESTAMP columns as TIMESTAMP_NTZ."""
    cols = [F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


def _pick(df: DataFrame, *cols: str) -> DataFrame:
    return out(df.select("event_id", *cols))


# ---------------------------------------------------------------- inputs
def flat(spark: SparkSession, sf: str) -> DataFrame:
    return trail(spark, sf)


def raw_dir(spark: SparkSession, sf: str) -> str:
    """Raw `{"Records": [...]}` files written from the fixture (raw zone)."""
    path = scratch_path(spark, "raw")
    fl = flat(spark, sf)
    write_raw_files(flat_to_raw(fl), path)
    return path


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return read_raw_records(spark, raw_dir(spark, sf))


def parsed(spark: SparkSession, sf: str) -> DataFrame:
    return parse_events(raw(spark, sf))


def features(spark: SparkSession, sf: str, semantics: str = C.ERROR_PRESENT) -> DataFrame:
    return build_features(flat(spark, sf), semantics)


def rule_scored(spark: SparkSession, sf: str) -> tuple[DataFrame, dict]:
    """Features with a deterministic decision column (-risk_score_normalized,
    higher = more normal) for exact checks of the detector's operators."""
    return scored_by_rule(features(spark, sf))


def scored_by_rule(table: DataFrame) -> tuple[DataFrame, dict]:
    f, m = materialize(table.withColumn("_decision", -F.col("risk_score_normalized")),
                       "rule-scored", dmin=F.min("_decision"), dmax=F.max("_decision"))
    st = EV.decision_stats(f.select("_decision"), "_decision", L.CONTAMINATION)
    return f, {**st, "dmin": m["dmin"], "dmax": m["dmax"]}


def rule_predictions(spark: SparkSession, sf: str) -> DataFrame:
    return decided(*rule_scored(spark, sf))


def decided(f: DataFrame, st: dict) -> DataFrame:
    raw_score = EV.minmax_score("_decision", st["dmin"], st["dmax"])
    return (f.withColumn("ml_anomaly_prediction", EV.flag("_decision", st["offset"]))
            .withColumn("_score_raw", raw_score)
            .withColumn("ml_anomaly_score", F.bround("_score_raw", 2))
            .withColumn("ml_severity", EV.severity("ml_anomaly_score"))
            .withColumn("y", PR.ground_truth(f)))


# --------------------------------------------------------------- helpers
def _time(col):
    return lambda s, sf: _pick(FT.add_time_features(flat(s, sf)), col)


def _user(col, sem=C.ERROR_PRESENT):
    return lambda s, sf: _pick(with_user_features(flat(s, sf), sem), col)


# flags that need nothing but their own row: no statistics job
ROW_EVENT = {"is_sensitive_action", "is_recon_action", "is_data_access", "has_error", "is_access_denied",
             "service_category", "service_category_encoded"}
ROW_NETWORK = {"is_suspicious_ip", "is_internal_ip", "is_aws_internal", "is_suspicious_user_agent", "is_console_access"}


def _event(col, sem=C.ERROR_PRESENT):
    if col in ROW_EVENT:
        return lambda s, sf: _pick(FT.add_event_flags(flat(s, sf), sem), col)
    return lambda s, sf: _pick(with_event_features(flat(s, sf), sem), col)


def _net(col):
    if col in ROW_NETWORK:
        return lambda s, sf: _pick(FT.add_agent_flags(FT.add_network_flags(flat(s, sf))), col)
    return lambda s, sf: _pick(with_network_features(flat(s, sf)), col)


def _temp(col):
    return lambda s, sf: _pick(with_temporal_features(flat(s, sf)), col)


def _feat(col, sem=C.ERROR_PRESENT):
    return lambda s, sf: _pick(features(s, sf, sem), col)


def _sql(name):
    if name in CAT.ROW_LOCAL:
        return lambda s, sf: out(CAT.run_query(s, name, FT.row_features(flat(s, sf))))
    return lambda s, sf: out(CAT.run_query(s, name, features(s, sf)))


def _parsed(*cols):
    return lambda s, sf: parsed(s, sf).select("event_id", *cols)


# ---------------------------------------------------------- sources/sinks
def q_src_raw_records(s, sf):
    r = raw(s, sf)
    return r.select(F.col("eventID").alias("event_id"), "eventTime", "eventName",
                    F.col("userIdentity.userName").alias("user_name"), "sourceIPAddress", "errorCode")


def q_sink_parsed_csv(s, sf):
    p = parsed(s, sf)
    path = K.write_parsed_csv(p, scratch_path(s, "parsed-csv"))
    return K.read_parsed_csv(s, path, p).select("event_id", "event_time", "risk_level", "has_error")


def q_sink_parsed_json(s, sf):
    p = parsed(s, sf)
    path = K.write_parsed_json(p, scratch_path(s, "parsed-json"))
    back = s.read.schema(p.schema).json(path) if path else p
    return back.select("event_id", "event_time", "risk_level", "has_error")


def q_sink_parsed_csv_all(s, sf):
    """K1: every column of the parsed rows, through CSV."""
    p = parsed(s, sf)
    return K.read_parsed_csv(s, K.write_parsed_csv(p, scratch_path(s, "parsed-csv")), p).select(*PARSED_COLUMNS)


def q_sink_parsed_json_all(s, sf):
    """K2: every column of the parsed rows, through JSON lines."""
    p = parsed(s, sf)
    path = K.write_parsed_json(p, scratch_path(s, "parsed-json"))
    return (s.read.schema(p.schema).json(path) if path else p).select(*PARSED_COLUMNS)


def q_sink_features_all(s, sf):
    """K3: all 59 columns of the feature table, through date-partitioned Parquet."""
    return out(K.read_features(s, K.write_features(features(s, sf), scratch_path(s, "features"))))


def q_src_features_all(s, sf):
    """All 59 columns of the feature source, read from CSV."""
    path = K.write_features(features(s, sf), scratch_path(s, "features-csv"), fmt="csv")
    return out(K.read_features(s, path, fmt="csv"))


def q_sink_features(s, sf):
    path = K.write_features(features(s, sf), scratch_path(s, "features"))
    return out(K.read_features(s, path).select("event_id", "event_time", "risk_score", "risk_level"))


def q_src_features(s, sf):
    path = K.write_features(features(s, sf), scratch_path(s, "features-csv"), fmt="csv")
    return out(K.read_features(s, path, fmt="csv").select(
        "event_id", "event_time", "user_total_events", "time_since_prev_event", "risk_level"))


def q_sink_zones(s, sf):
    fl = flat(s, sf)
    f = build_features(fl)
    base = scratch_path(s, "zones")
    paths = K.write_zones(base, raw=flat_to_raw(fl), features=f,
                          feature_summary=K.feature_summary_document(SM.feature_summary(f)))
    parts = [read_raw_records(s, paths["raw"]).agg(F.count(F.lit(1)).alias("rows")).select(
                 F.lit("raw").alias("zone"), "rows"),
             K.read_features(s, paths["features"]).agg(F.count(F.lit(1)).alias("rows")).select(
                 F.lit("processed").alias("zone"), "rows")]
    return parts[0].unionByName(parts[1])


def q_feature_summary(s, sf):
    return SM.feature_summary(features(s, sf))


def q_sink_feature_summary(s, sf):
    """K4: the nested summary document written as JSON and read back."""
    doc = K.feature_summary_document(SM.feature_summary(features(s, sf)))
    path = K.write_one_row_json(doc, scratch_path(s, "feature-summary"))
    back = s.read.schema(doc.schema).json(path)
    return back.select("total_events", "total_features", F.size("features").alias("n_feature_names"),
                       F.col("risk_distribution")["low"].alias("risk_low"),
                       F.col("risk_distribution")["medium"].alias("risk_medium"),
                       "unique_users", "unique_ips", "error_count")


# ------------------------------------------------------------- ml (rules)
def q_ml_select_features(s, sf):
    X, names = PR.select_features(features(s, sf))
    return X


def q_ml_ground_truth(s, sf):
    f = flat(s, sf)
    return f.select("event_id", PR.ground_truth(f).alias("y"))


def q_ml_scale(s, sf):
    X, names = PR.select_features(features(s, sf))
    X, _ = materialize(X, "ml-matrix")          # computed once, read by both passes
    st = PR.scaler_stats(X, names)
    sc = PR.scale(X, names, st)
    return sc.select("event_id", *[F.round(c, 6).alias(c) for c in names])


def q_ml_threshold_flag(s, sf):
    return rule_predictions(s, sf).select("event_id", "ml_anomaly_prediction")


def q_ml_minmax_score(s, sf):
    return rule_predictions(s, sf).select("event_id", "ml_anomaly_score")


def q_ml_severity(s, sf):
    return rule_predictions(s, sf).select("event_id", "ml_severity")


def q_ml_confusion(s, sf):
    return EV.confusion(rule_predictions(s, sf), "y", "ml_anomaly_prediction")


def q_ml_metrics(s, sf):
    return EV.metrics_from_confusion(EV.confusion(rule_predictions(s, sf), "y", "ml_anomaly_prediction"))


def q_ml_roc_auc(s, sf):
    return EV.roc_auc(rule_predictions(s, sf), "y", "_score_raw")


def q_ml_severity_distribution(s, sf):
    return EV.severity_distribution(rule_predictions(s, sf))


def q_ml_final_summary(s, sf):
    return EV.final_summary(rule_predictions(s, sf))


def q_ml_top_risk_events(s, sf):
    return EV.top_risk_events(rule_predictions(s, sf))


# ------------------------------------------------------------ ml (forest)
def _detect(s, sf, trees=L.FOREST_TREES):
    return DET.detect(features(s, sf), trees=trees)


def q_ml_forest_nodes(s, sf):
    d = _detect(s, sf)
    return s.createDataFrame(d.nodes)


def q_ml_predictions(s, sf):
    d = _detect(s, sf)
    return out(d.decisions.select("event_id", "ml_anomaly_prediction", "ml_anomaly_score", "ml_severity"))


def q_ml_forest_metrics(s, sf):
    return _detect(s, sf).evaluation()


def q_sink_predictions(s, sf):
    d = _detect(s, sf)
    path = K.write_features(DET.prediction_table(d), scratch_path(s, "predictions"))
    return out(s.read.parquet(path).select("event_id", "ml_anomaly_prediction", "ml_severity"))


def q_ml_permutation_importance(s, sf):
    return DET.importance(_detect(s, sf))


def q_model_roundtrip(s, sf):
    d = _detect(s, sf)
    path = K.save_model(s, d.nodes, d.scaler, d.params, scratch_path(s, "model"))
    forest, _, names, _ = K.load_model(s, path)
    return d.table.select("event_id", forest.score(DET.vector(names, d.table.schema)).alias("score_samples"))


def q_detection_summary(s, sf):
    return DET.summary_frame(s, _detect(s, sf))


def q_ml_ocsvm(s, sf):
    return DET.one_class_svm(_detect(s, sf))[0]


def q_ml_consensus(s, sf):
    return DET.consensus(_detect(s, sf))


def q_ml_holdout_metrics(s, sf):
    return DET.holdout_metrics(features(s, sf))


def q_ml_holdout_by_time(s, sf):
    return DET.holdout_by_time(flat(s, sf))


def q_holdout_features(s, sf):
    """Key counts of both parts, all fitted on the earlier one; window counts of the part itself."""
    parts = DET.holdout_features(flat(s, sf))
    named = [p.select("event_id", F.lit(n).alias("part"), *HOLDOUT_COLUMNS) for n, p in zip(("train", "test"), parts)]
    return named[0].unionByName(named[1])


def q_sink_published(s, sf):
    """K7, K8: all five zones published under one manifest and checked against it: a version of every
    other event, then one of all."""
    base, rows = scratch_path(s, "published"), flat(s, sf)
    for part in (rows.where(F.col("event_id").cast("long") % 2 == 1), rows):
        table, found = build_and_decide(part)
        doc = found.agg(F.count(F.lit(1)).alias("total_events"), F.coalesce(F.sum("ml_anomaly_prediction"), F.lit(0)).alias("anomalies"),
                        *[F.count_if(F.col("ml_severity") == x).alias(f"severity_{x}") for x in L.SEVERITY_ORDER])
        landing = scratch_path(s, "landing")
        stored.land(part, landing)
        PB.publish(s, base, {"raw": V.read_variant_events(s, landing, multi_line=False), "features": table, "predictions": found,
                             "feature_summary": K.feature_summary_document(SM.feature_summary(table)), "detection_summary": doc})
    return PB.verify(s, base)


def build_and_decide(part: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Features of some events, and with them the decisions of the rule detector."""
    found = decided(*scored_by_rule(build_features(part)))
    return found.select(*FEATURE_COLUMNS), found.select(*FEATURE_COLUMNS, "ml_anomaly_prediction", "ml_anomaly_score", "ml_severity")


def _stored(name):
    """S3: the features written once as a date-partitioned table; a report's text runs on it."""
    return lambda s, sf: s.sql(CAT.get_query(name, CAT.store_events(features(s, sf), scratch_path(s, "security-events"))))


# --------------------------------------------------------------- threats
def q_join_threat_feed(s, sf):
    fl = flat(s, sf)
    feed = s.createDataFrame([(ip,) for ip in L.SUSPICIOUS_IPS], "feed_ip string")
    # the feed is a small list here; a large feed goes through the same size-checked join
    joined = attach(fl.select("event_id", "source_ip"), feed.withColumnRenamed("feed_ip", "source_ip")
                    .withColumn("_hit", F.lit(1)), len(L.SUSPICIOUS_IPS), ["source_ip"])
    return joined.select("event_id", F.coalesce("_hit", F.lit(0)).alias("is_suspicious_ip"))


def q_join_feed_ranges(s, sf):
    """J3, P6 against a feed that grows with the events: every address with an error, and the /24
    network of every address that created a user."""
    fl = flat(s, sf)
    failed = fl.where("error_code <> ''").select(F.col("source_ip").alias("entry"))
    wide = fl.where("event_name = 'CreateUser'").select(F.concat("source_ip", F.lit("/24")).alias("entry"))
    return match_feed(fl.select("event_id", "source_ip"), failed.unionByName(wide), "entry").select("event_id", "feed_network")


def q_threat_exfiltration_burst(s, sf):
    """D4 over events in which the downloads of one hour are there sixty times."""
    burst = ("event_name = 'GetObject' AND date_trunc('hour', event_time) = "
             "(SELECT date_trunc('day', max(event_time)) - INTERVAL 9 DAYS FROM trail_of_burst)")
    fl = flat(s, sf)
    fl.createOrReplaceTempView("trail_of_burst")
    times = s.sql(f"SELECT *, explode(sequence(1, CASE WHEN {burst} THEN 60 ELSE 1 END)) AS copy FROM trail_of_burst")
    return out(TH.exfiltration(times))


# ------------------------------------------------------------- streaming
def q_stream_flatten(s, sf):
    src = raw_dir(s, sf)
    rows = ST.row_local_stream(ST.read_raw_stream(s, src))
    path = ST.run_to_parquet(rows, "stream-flat")
    return out(s.read.schema(rows.schema).parquet(path).select("event_id", "event_time", "hour", "is_sensitive_action",
                                           "is_suspicious_ip", "parser_risk_level"))


def q_stream_minute_counts(s, sf):
    src = raw_dir(s, sf)
    events = ST.read_raw_stream(s, src).select(*ST.flat_columns())
    counts = ST.minute_counts(events)
    return s.read.schema(counts.schema).parquet(ST.run_to_parquet(counts, "stream-minutes"))


def q_stream_user_hour_counts(s, sf):
    src = raw_dir(s, sf)
    events = ST.read_raw_stream(s, src).select(*ST.flat_columns())
    counts = ST.user_hour_counts(events)
    return s.read.schema(counts.schema).parquet(ST.run_to_parquet(counts, "stream-user-hours"))


def q_alerts_high_severity(s, sf):
    src = raw_dir(s, sf)
    stream = ST.row_local_stream(ST.read_raw_stream(s, src))
    found = ST.alerts(stream)
    path = ST.run_foreach_batch(found, "alerts")
    return out(ST.read_batches(s, path, found).select("event_id", "parser_risk_level"))


def q_baseline_tables(s, sf):
    fl = flat(s, sf)
    stats = event_stats(fl)              # batch job writes the baselines
    src = raw_dir(s, sf)
    stream = ST.read_raw_stream(s, src).select(*ST.flat_columns())
    enriched = ST.enrich_with_baselines(stream, stats)
    rows = enriched.select("event_id", "user_total_events", "event_type_frequency", "ip_event_count")
    return s.read.schema(rows.schema).parquet(ST.run_to_parquet(rows, "stream-enriched"))


# ------------------------------------------------------------- registry
def registry() -> dict[str, Query]:
    q: dict[str, Query] = {}
    # sources and sinks
    q["src_raw_records"] = q_src_raw_records
    q["src_features"] = q_src_features
    q["sink_parsed_csv"] = q_sink_parsed_csv
    q["sink_parsed_json"] = q_sink_parsed_json
    q["sink_features"] = q_sink_features
    q["sink_zones"] = q_sink_zones
    q["sink_parsed_csv_all"] = q_sink_parsed_csv_all
    q["sink_parsed_json_all"] = q_sink_parsed_json_all
    q["sink_features_all"] = q_sink_features_all
    q["src_features_all"] = q_src_features_all
    q["feature_summary"] = q_feature_summary
    q["sink_feature_summary"] = q_sink_feature_summary
    # parser
    q["safe_get"] = _parsed("user_name", "source_ip", "error_code")
    q["flatten_parsed"] = lambda s, sf: parsed(s, sf).select(*PARSED_COLUMNS)
    q["flatten_events"] = lambda s, sf: out(flatten_events(raw(s, sf)))
    q["parse_timestamp"] = _parsed("hour_of_day", "day_of_week", "is_business_hours", "is_weekend")
    q["parsed_sensitive"] = _parsed("is_sensitive_action")
    q["parsed_suspicious_ip"] = _parsed("is_suspicious_ip")
    q["parsed_has_error"] = _parsed("has_error")
    q["parsed_risk_level"] = _parsed("risk_level")
    # time
    for key, col in [("time_hour", "hour"), ("time_day_of_week", "day_of_week"),
                     ("time_day_of_month", "day_of_month"), ("time_month", "month"),
                     ("time_minute", "minute"), ("time_is_business_hours", "is_business_hours"),
                     ("time_is_weekend", "is_weekend"), ("time_is_late_night", "is_late_night"),
                     ("time_period", "time_period"), ("time_period_encoded", "time_period_encoded")]:
        q[key] = _time(col)
    # user
    for key, col in [("user_total_events", "user_total_events"), ("user_unique_ips", "user_unique_ips"),
                     ("user_unique_event_types", "user_unique_event_types"),
                     ("user_error_count", "user_error_count"), ("user_error_rate", "user_error_rate"),
                     ("user_is_new", "is_new_user"), ("user_activity_diversity", "user_activity_diversity")]:
        q[key] = _user(col)
    q["user_error_count_ref"] = _user("user_error_count", C.ERROR_REFERENCE)
    # event
    for key, col in [("event_is_sensitive", "is_sensitive_action"), ("event_is_recon", "is_recon_action"),
                     ("event_is_data_access", "is_data_access"), ("event_has_error", "has_error"),
                     ("event_is_access_denied", "is_access_denied"),
                     ("event_service_category", "service_category"),
                     ("event_service_encoded", "service_category_encoded"),
                     ("event_type_frequency", "event_type_frequency"), ("event_is_rare", "is_rare_event")]:
        q[key] = _event(col)
    q["event_has_error_ref"] = _event("has_error", C.ERROR_REFERENCE)
    # network
    for key, col in [("net_is_suspicious_ip", "is_suspicious_ip"), ("net_is_internal_ip", "is_internal_ip"),
                     ("net_is_aws_internal", "is_aws_internal"), ("net_ip_event_count", "ip_event_count"),
                     ("net_ip_unique_users", "ip_unique_users"), ("net_is_shared_ip", "is_shared_ip"),
                     ("net_is_suspicious_ua", "is_suspicious_user_agent"),
                     ("net_is_console", "is_console_access")]:
        q[key] = _net(col)
    # temporal
    for key, col in [("temp_time_since_prev", "time_since_prev_event"), ("temp_is_rapid", "is_rapid_event"),
                     ("temp_events_this_minute", "events_this_minute"), ("temp_is_burst", "is_burst_activity"),
                     ("temp_user_events_this_hour", "user_events_this_hour"),
                     ("temp_is_unusual_user", "is_unusual_user_activity")]:
        q[key] = _temp(col)
    # risk
    q["risk_score"] = _feat("risk_score")
    q["risk_score_ref"] = _feat("risk_score", C.ERROR_REFERENCE)
    q["risk_score_normalized"] = _feat("risk_score_normalized")
    q["risk_level"] = _feat("risk_level")
    q["risk_level_encoded"] = _feat("risk_level_encoded")
    q["features_full"] = lambda s, sf: out(features(s, sf))
    q["features_after_dedup"] = lambda s, sf: out(build_features(flat(s, sf).dropDuplicates(["event_id"])))
    q["features_full_ref"] = lambda s, sf: out(features(s, sf, C.ERROR_REFERENCE))
    q["join_threat_feed"] = q_join_threat_feed
    q["join_feed_ranges"] = q_join_feed_ranges
    q["threat_exfiltration_burst"] = q_threat_exfiltration_burst
    # summaries
    q["parse_risk_distribution"] = lambda s, sf: SM.level_distribution(
        parsed(s, sf), "risk_level", L.RISK_LEVEL_ORDER)
    q["parse_anomaly_distribution"] = lambda s, sf: SM.parse_anomaly_distribution(parsed(s, sf))
    q["parse_top_event_types"] = lambda s, sf: SM.parse_top_event_types(parsed(s, sf))
    q["parse_events_per_user"] = lambda s, sf: SM.parse_events_per_user(parsed(s, sf))
    q["parse_totals"] = lambda s, sf: SM.parse_totals(parsed(s, sf))
    q["feat_risk_distribution"] = lambda s, sf: SM.level_distribution(
        features(s, sf), "risk_level", L.RISK_LEVEL_ORDER)
    q["feat_label_distribution"] = lambda s, sf: SM.label_distribution(flat(s, sf))
    q["feat_top_users"] = lambda s, sf: SM.top_users(flat(s, sf))
    q["feat_statistics"] = lambda s, sf: SM.feature_statistics(features(s, sf))
    # named SQL
    for name in CAT.list_queries():
        q[f"sql_{name}"] = _sql(name)
        q[f"stored_{name}"] = _stored(name)
    # detector operators over a rule decision (exact oracles)
    q["ml_select_features"] = q_ml_select_features
    q["ml_ground_truth"] = q_ml_ground_truth
    q["ml_scale"] = q_ml_scale
    q["ml_threshold_flag"] = q_ml_threshold_flag
    q["ml_minmax_score"] = q_ml_minmax_score
    q["ml_severity"] = q_ml_severity
    q["ml_confusion"] = q_ml_confusion
    q["ml_metrics"] = q_ml_metrics
    q["ml_roc_auc"] = q_ml_roc_auc
    q["ml_severity_distribution"] = q_ml_severity_distribution
    q["ml_final_summary"] = q_ml_final_summary
    q["ml_top_risk_events"] = q_ml_top_risk_events
    # forest (no SQL oracle: randomised model; checked by properties in tests)
    q["ml_forest_nodes"] = q_ml_forest_nodes
    q["ml_predictions"] = q_ml_predictions
    q["ml_forest_metrics"] = q_ml_forest_metrics
    q["sink_predictions"] = q_sink_predictions
    q["ml_permutation_importance"] = q_ml_permutation_importance
    q["model_roundtrip"] = q_model_roundtrip
    q["detection_summary"] = q_detection_summary
    q["ml_ocsvm"] = q_ml_ocsvm
    q["ml_consensus"] = q_ml_consensus
    q["ml_holdout_metrics"] = q_ml_holdout_metrics
    q["ml_holdout_by_time"] = q_ml_holdout_by_time
    q["holdout_features"] = q_holdout_features
    q["sink_published"] = q_sink_published
    # threats
    q["threat_privilege_escalation"] = lambda s, sf: TH.privilege_escalation(flat(s, sf))
    q["threat_unusual_access"] = lambda s, sf: TH.unusual_access(
        FT.add_network_flags(FT.add_time_features(flat(s, sf))))
    q["threat_failed_attacks"] = lambda s, sf: TH.failed_attacks(FT.add_event_flags(flat(s, sf)))
    q["threat_exfiltration"] = lambda s, sf: TH.exfiltration(flat(s, sf))
    q["threat_log_tampering"] = lambda s, sf: TH.log_tampering(flat(s, sf))
    q["user_events_last_hour"] = lambda s, sf: TH.user_events_last_hour(flat(s, sf))
    q["ip_first_seen"] = lambda s, sf: TH.ip_first_seen(flat(s, sf))
    # streaming
    q["stream_flatten"] = q_stream_flatten
    q["stream_minute_counts"] = q_stream_minute_counts
    q["stream_user_hour_counts"] = q_stream_user_hour_counts
    q["alerts_high_severity"] = q_alerts_high_severity
    q["baseline_tables"] = q_baseline_tables
    # the lossless raw zone, stored baselines, closed and late streams
    q |= stored.registry()

    def wrap(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            spark.conf.set("spark.sql.codegen.hugeMethodLimit", COMPILED_BYTES)
            return fn(spark, sf_dir)
        run.__name__ = getattr(fn, "__name__", "query")
        return run

    return {k: wrap(v) for k, v in q.items()}

