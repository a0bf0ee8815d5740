"""Publication of a whole run: all zones or none.

A run's zones are written under `runs/<run>`; then one file of manifest rows (a row per zone with
its path, schema, row count and content hashes) makes them the current version. A file appears as a whole,
so a reader sees the version before or all of the new one; a run that dies earlier leaves
files that no manifest names. One writer at a time; if two still took the same version number, readers take the
run that sorts last, whole.

`checksum` adds up the first 8 hex digits of the MD5 of a zone's `KEYS` columns joined by `|` (nulls as empty
text), which any engine can recompute; `row_hash` adds up a hash of whole rows. Neither
depends on the order of rows. An empty zone has sums of 0.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlake.sources import sinks as K
from auditlake.sources import variant as V

MANIFEST = "version long, run string, zone string, path string, schema string, rows long, checksum long, row_hash string"
KEYS = {
    "raw": ["event_id"],
    "features": ["event_id", "risk_score", "risk_level"],
    "feature_summary": ["total_events", "sensitive_action_count", "error_count"],
    "predictions": ["event_id", "ml_anomaly_prediction", "ml_severity"],
    "detection_summary": ["total_events", "anomalies"],
}


def write_run(base: str, run: str, zones: dict[str, DataFrame]) -> dict[str, str]:
    """Writes every zone of `KEYS` under the run's folder; their paths below `base`."""
    if set(zones) != set(KEYS):
        raise ValueError(f"a run has the zones {sorted(KEYS)}")
    writers = {"raw": V.write_variant_zone, "features": K.write_features, "predictions": K.write_features}
    paths = {zone: f"runs/{run}/{K.ZONES[zone]}" for zone in KEYS}
    for zone, path in paths.items():
        writers.get(zone, K.write_one_row_json)(zones[zone], f"{base}/{path}")
    return paths


def _read(spark: SparkSession, base: str, zone: str, path: str, schema: str) -> DataFrame:
    if zone == "raw":
        return V.read_variant_zone(spark, f"{base}/{path}")
    kept = T.StructType.fromJson(json.loads(schema))
    if zone.endswith("summary"):
        return spark.read.schema(kept).json(f"{base}/{path}")
    stored = T.StructType([*kept.fields, T.StructField("event_date", T.DateType())])
    return spark.read.schema(stored).parquet(f"{base}/{path}").select(*kept.names)


def contents(df: DataFrame, zone: str) -> tuple[int, int, str]:
    """(rows, checksum, row_hash) of a zone, in one pass."""
    keyed = df.withColumn("event_id", F.expr("variant_get(event, '$.eventID', 'string')")) if zone == "raw" else df
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in KEYS[zone]])
    digits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")
    whole = F.xxhash64(F.to_json(F.struct(*sorted(df.columns)))).cast("decimal(38,0)")
    row = keyed.agg(F.count(F.lit(1)), F.coalesce(F.sum(digits), F.lit(0)),
                    F.coalesce(F.sum(whole), F.lit(0)).cast("string")).first()
    return row[0], row[1], row[2]


def manifest(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """The manifest rows of a version (the newest by default); none before the first."""
    try:
        rows = spark.read.schema(MANIFEST).parquet(f"{base}/manifests")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)
    if version is not None:
        rows = rows.where(F.col("version") == version)
    last = rows.agg(F.max(F.struct("version", "run"))).first()[0]
    if last is None:
        return rows
    return rows.where((F.col("version") == last["version"]) & (F.col("run") == last["run"]))


def publish(spark: SparkSession, base: str, zones: dict[str, DataFrame]) -> int:
    """Writes a run and makes it the current version, whose number is returned."""
    run = uuid.uuid4().hex
    paths = write_run(base, run, zones)
    before = manifest(spark, base).agg(F.max("version")).first()[0] or 0
    rows = []
    for zone, path in paths.items():
        schema = zones[zone].schema.json()
        rows.append((before + 1, run, zone, path, schema, *contents(_read(spark, base, zone, path, schema), zone)))
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{base}/manifests")
    return before + 1


def read_zone(spark: SparkSession, base: str, zone: str, version: int | None = None) -> DataFrame:
    found = manifest(spark, base, version).where(F.col("zone") == zone).first()
    if found is None:
        raise LookupError(f"no published {zone}")
    return _read(spark, base, zone, found["path"], found["schema"])


def verify(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """(zone, rows, checksum, intact): whether what lies in each zone is what the manifest says."""
    rows = [(r["zone"], r["rows"], r["checksum"],
             contents(_read(spark, base, r["zone"], r["path"], r["schema"]), r["zone"]) == (r["rows"], r["checksum"], r["row_hash"]))
            for r in manifest(spark, base, version).collect()]      # one row a zone
    return spark.createDataFrame(rows, "zone string, rows long, checksum long, intact boolean")
