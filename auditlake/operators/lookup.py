"""Size-checked lookup joins.

Aggregate-back features join a small per-key table onto every event. The
lookup is broadcast only when a *proven* row bound (an exact count of a
materialised table) times an estimated row width fits the broadcast budget;
beyond it the join is a plain shuffle join that AQE may still convert, and whose
hot keys AQE's skew-join handling splits.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_CONF = "auditlake.broadcast.maxBytes"
# session setting, in force during our own writes: a job's shuffle files go when it ends
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
COUNTED_BYTES = 64 << 20        # a lookup's rows are counted, not guessed: it may be larger than the planner's guesses

_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
          "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}


def parse_bytes(text: str | None) -> int:
    if text is None:
        return -1
    m = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]*)\s*", str(text))
    if not m:
        return -1
    return int(m.group(1)) * _UNITS.get(m.group(2).lower(), 1)


def broadcast_budget(spark: SparkSession) -> int:
    """Bytes a lookup may take to be broadcast (-1: never)."""
    own = spark.conf.get(BROADCAST_CONF, None)
    if own is not None:
        return parse_bytes(own)
    planner = parse_bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB"))
    return max(planner, COUNTED_BYTES) if planner >= 0 else planner


def estimated_row_bytes(schema: T.StructType) -> int:
    width = 16
    for f in schema.fields:
        t = f.dataType
        if isinstance(t, (T.StringType, T.BinaryType)):
            width += 48
        elif isinstance(t, (T.StructType, T.ArrayType, T.MapType)):
            width += 64
        else:
            width += 8
    return width


def fits_broadcast(spark: SparkSession, schema: T.StructType, rows_bound: int) -> bool:
    budget = broadcast_budget(spark)
    return budget >= 0 and rows_bound * estimated_row_bytes(schema) <= budget


def broadcast_or_shuffle(lookup: DataFrame, rows_bound: int) -> DataFrame:
    """Broadcast hint under the proven bound; otherwise a sort-merge join hint: it
    spills, and the planner does not broadcast on its own (possibly
    compressed-size) estimate. AQE still splits skewed partitions."""
    if fits_broadcast(lookup.sparkSession, lookup.schema, rows_bound):
        return F.broadcast(lookup)
    return lookup.hint("merge")


def attach(df: DataFrame, lookup: DataFrame, rows_bound: int, keys: list[str],
           null_safe: tuple[str, ...] = ()) -> DataFrame:
    """Left-join `lookup` onto `df` on equal `keys`.

    Key columns named in `null_safe` match null to null (`<=>`). Lookup key
    columns are dropped from the result; its other columns are added.
    """
    renamed = lookup.select(*[F.col(c).alias(f"__lk_{c}") if c in keys else F.col(c)
                              for c in lookup.columns])
    renamed = broadcast_or_shuffle(renamed, rows_bound)
    cond: Column | None = None
    for k in keys:
        c = (F.col(k).eqNullSafe(F.col(f"__lk_{k}")) if k in null_safe
             else F.col(k) == F.col(f"__lk_{k}"))
        cond = c if cond is None else cond & c
    out = df.join(renamed, cond, "left")
    return out.drop(*[f"__lk_{k}" for k in keys])


def materialize(df: DataFrame, name: str = "tbl", **metrics: Column) -> tuple[DataFrame, dict]:
    """Write `df` as a Parquet table under the shared checkpoint folder and
    read it back: the lineage is cut, the data survive executor loss, and the
    planner sees the real size. `metrics` (aggregate columns) are observed
    during the same write job and returned as a dict of exact values. The job's
    shuffle files go with it, not when the driver next collects its garbage."""
    from pyspark.sql import Observation

    from auditlake.session import scratch_path
    spark = df.sparkSession
    path = scratch_path(spark, name)
    obs = Observation(f"{name}_metrics") if metrics else None
    src = df.observe(obs, *[c.alias(k) for k, c in metrics.items()]) if obs else df
    before = spark.conf.get(CLEANUP_CONF, None)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        src.write.mode("error").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_CONF)
        else:
            spark.conf.set(CLEANUP_CONF, before)
    back = spark.read.schema(df.schema).parquet(path)
    if not obs:
        return back, {}
    try:
        return back, dict(obs.get)
    except Exception:  # noqa: BLE001  an input known to be empty is planned without the observation
        return back, back.agg(*[c.alias(k) for k, c in metrics.items()]).first().asDict()


def free(*tables: DataFrame) -> None:
    """Delete tables that `materialize` wrote, once what was made of them is written too.
    Files outside the checkpoint folder stay."""
    from auditlake.session import checkpoint_dir
    for table in tables:
        spark = table.sparkSession
        path_of = spark._jvm.org.apache.hadoop.fs.Path
        shared = path_of(checkpoint_dir(spark)).getName()
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = path_of(folder)
            if path.getParent().getName() == shared:
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def attach_many(df: DataFrame, specs: list, row_id: str) -> DataFrame:
    """Left-join several lookups onto `df`.

    `specs` holds (lookup, rows_bound, keys, null_safe) tuples. Lookups within
    the broadcast budget are broadcast onto the rows directly. The others are
    joined (shuffled hash joins) onto a narrow projection of `row_id` and
    their keys, and that narrow result comes back in one join on the unique
    `row_id`: the wide rows are shuffled once however many lookups are large.
    """
    spark = df.sparkSession
    small = [s for s in specs if fits_broadcast(spark, s[0].schema, s[1])]
    big = [s for s in specs if not fits_broadcast(spark, s[0].schema, s[1])]
    for lk, bound, keys, null_safe in small:
        df = attach(df, lk, bound, keys, tuple(null_safe))
    if big:
        key_cols = sorted({k for _, _, keys, _ in big for k in keys} - {row_id})
        narrow = df.select(row_id, *key_cols)
        for lk, bound, keys, null_safe in big:
            narrow = attach(narrow, lk, bound, keys, tuple(null_safe))
        extras = narrow.drop(*key_cols).withColumnRenamed(row_id, "__row")
        # two large sides on a unique key: sort-merge (spills) rather than a hash build
        df = df.join(extras.hint("merge"), F.col(row_id) == F.col("__row"), "left").drop("__row")
    return df

