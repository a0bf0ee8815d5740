"""Order-dependent operators over the whole table without a single partition.

A global `lag` or running sum written as ``Window.orderBy(...)`` makes Spark
move every row into one partition. Here the ordered key is first made unique
(ties are collapsed by a partial aggregate before any shuffle), then cut into
equal-count ranges from approximate quantiles. Each range is one window
partition; a summary with one row per range (a bounded table: its size is the
bucket count, a parameter) stitches the ranges together and is broadcast back.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET_CONF = "auditlake.ordered.buckets"
MAX_BUCKETS = 20000


def bucket_count(df: DataFrame, requested: int | None = None) -> int:
    if requested:
        return max(1, min(MAX_BUCKETS, int(requested)))
    spark = df.sparkSession
    own = spark.conf.get(BUCKET_CONF, None)
    if own:
        return max(1, min(MAX_BUCKETS, int(own)))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200") or 200)
    return max(1, min(MAX_BUCKETS, 4 * parts))


def _order_value(df: DataFrame, key: str):
    dtype = df.schema[key].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(key).cast("timestamp")).cast("double")
    return F.col(key).cast("double")


SAMPLES_PER_BUCKET = 200


def range_cuts(df: DataFrame, key: str, n_buckets: int | None = None,
               rows: int | None = None, per_row: bool = False) -> list[float]:
    """Cut points splitting `key` into about equal-count ranges.

    Computed from a hash sample of about SAMPLES_PER_BUCKET values per range
    (the hash is of the key value, so equal keys are sampled together), so the
    per-task sketches stay small at any table size. Only the cut list (at most
    `n_buckets - 1` numbers) reaches the driver.
    """
    b = bucket_count(df, n_buckets)
    if b <= 1:
        return []
    value = _order_value(df, key)
    if rows is None:
        rows = df.count()
    rate = min(1.0, SAMPLES_PER_BUCKET * b / max(1, rows))
    # per_row: sample rows independently (a hash of the value and the row id),
    # so a value repeated many times is sampled in proportion
    h = F.xxhash64(value, F.monotonically_increasing_id()) if per_row else F.xxhash64(value)
    src = df if rate >= 1.0 else df.where(F.pmod(h, F.lit(1 << 30)) < F.lit(int(rate * (1 << 30))))
    probs = [i / b for i in range(1, b)]
    row = src.agg(F.percentile_approx(value, probs, max(10000, 20 * b)).alias("q")).first()
    return sorted({float(q) for q in (row["q"] or []) if q is not None
                   and not math.isinf(q) and not math.isnan(q)})


def with_range_bucket(df: DataFrame, key: str, n_buckets: int | None = None,
                      out: str = "_bkt", cuts: list[float] | None = None) -> DataFrame:
    """Add `out`: index of the range holding `key` (monotone in key)."""
    if cuts is None:
        cuts = range_cuts(df, key, n_buckets)
    if not cuts:                       # a single range
        return df.withColumn(out, F.lit(0))
    splits = [-math.inf] + sorted(set(cuts)) + [math.inf]
    with_val = df.withColumn("_ordv", _order_value(df, key))
    bucketed = Bucketizer(splits=splits, inputCol="_ordv", outputCol="_bktd",
                          handleInvalid="keep").transform(with_val)
    return bucketed.withColumn(out, F.col("_bktd").cast("int")).drop("_ordv", "_bktd")


def lag_over_unique(df: DataFrame, key: str, out: str = "_prev",
                    n_buckets: int | None = None, cuts: list[float] | None = None) -> DataFrame:
    """Previous value of `key` in ascending global order; `key` unique, non-null."""
    b = with_range_bucket(df, key, n_buckets, cuts=cuts)
    local = Window.partitionBy("_bkt").orderBy(key)
    x = b.withColumn("_local_prev", F.lag(key).over(local))
    summary = b.groupBy("_bkt").agg(F.max(key).alias("_bmax"))
    # one row per range: a bounded table
    summary = summary.withColumn("_bprev", F.lag("_bmax").over(Window.orderBy("_bkt")))
    x = x.join(F.broadcast(summary.select("_bkt", "_bprev")), "_bkt", "left")
    return (x.withColumn(out, F.coalesce("_local_prev", "_bprev"))
             .drop("_bkt", "_local_prev", "_bprev"))


def prefix_sums_over_unique(df: DataFrame, key: str, values: list[str],
                            inclusive: bool = False, prefix: str = "cum_",
                            n_buckets: int | None = None) -> DataFrame:
    """Running sums of `values` in ascending `key` order (key unique, non-null).

    Exclusive by default: the sum over strictly smaller keys.
    """
    b = with_range_bucket(df, key, n_buckets)
    end = 0 if inclusive else -1
    local = Window.partitionBy("_bkt").orderBy(key).rowsBetween(Window.unboundedPreceding, end)
    x = b
    for v in values:
        x = x.withColumn(f"_loc_{v}", F.coalesce(F.sum(v).over(local), F.lit(0)))
    summary = b.groupBy("_bkt").agg(*[F.sum(v).alias(f"_tot_{v}") for v in values])
    before = Window.orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    for v in values:
        summary = summary.withColumn(f"_off_{v}", F.coalesce(F.sum(f"_tot_{v}").over(before), F.lit(0)))
    summary = summary.select("_bkt", *[f"_off_{v}" for v in values])
    x = x.join(F.broadcast(summary), "_bkt", "left")
    for v in values:
        x = x.withColumn(f"{prefix}{v}", F.col(f"_loc_{v}") + F.col(f"_off_{v}"))
    return x.drop("_bkt", *[f"_loc_{v}" for v in values], *[f"_off_{v}" for v in values])


SELECT_FINAL_ROWS = 50_000
SELECT_BUCKETS = 1000


def kth_smallest(df: DataFrame, col: str, ks: list[int]) -> dict[int, float]:
    """Exact order statistics (0-based ranks `ks`) of a numeric column; nulls and
    NaN are not ranked, infinities are. A rank beyond the rows is an error.

    Each round cuts the current closed value range into about SELECT_BUCKETS ranges
    from a hash sample, counts rows per range in one aggregate (count, min,
    max per range: a table of at most SELECT_BUCKETS rows) and keeps the range
    holding the wanted rank; once the range holds at most SELECT_FINAL_ROWS
    rows the answer comes from a bounded top-k. Every round is one scan of one
    column, and ranks in the same range share it; nothing unbounded meets in one task or on the driver.
    """
    vals = df.select(F.col(col).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    rows = vals.count()
    out: dict[int, float] = {}
    counted: dict[tuple, list] = {}            # closed value range -> rows per part of it
    for k in ks:
        if not 0 <= k < rows:
            raise ValueError(f"rank {k} of {rows} rows")
        rng, below, n_in, at = vals, 0, rows, None
        while k not in out:
            if n_in <= SELECT_FINAL_ROWS:
                out[k] = float(rng.orderBy("_v").offset(k - below).limit(1).collect()[0]["_v"])
                break
            if at not in counted:
                cuts = range_cuts(rng, "_v", n_buckets=SELECT_BUCKETS, rows=n_in, per_row=True)
                counted[at] = (with_range_bucket(rng, "_v", cuts=cuts).groupBy("_bkt")
                               .agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("mn"), F.max("_v").alias("mx"))
                               .orderBy("_bkt").collect())
            hist = counted[at]
            for h in hist:
                if below + h["n"] > k:
                    break
                below += h["n"]
            if h["mn"] == h["mx"]:               # one value fills the range
                out[k] = float(h["mn"])
                break
            lo, hi, n = h["mn"], h["mx"], h["n"]
            if n == n_in:                        # no progress: peel off the smallest value
                n_eq = rng.where(F.col("_v") == F.lit(lo)).count()
                if below + n_eq > k:
                    out[k] = float(lo)
                    break
                lo, below, n = math.nextafter(lo, math.inf), below + n_eq, n - n_eq
            rng, n_in, at = vals.where((F.col("_v") >= F.lit(lo)) & (F.col("_v") <= F.lit(hi))), n, (lo, hi)
    return out


def exact_quantile(df: DataFrame, col: str, q: float) -> float | None:
    """Quantile with linear interpolation between order statistics (numpy's
    default), exact at any table size (see `kth_smallest`); null without rows."""
    rows = df.where(F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double"))).count()
    if not rows:
        return None
    pos = q * (rows - 1)
    lo = int(math.floor(pos))
    hi = min(lo + 1, rows - 1)
    got = kth_smallest(df, col, sorted({lo, hi}))
    return got[lo] if got[lo] == got[hi] else got[lo] + (pos - lo) * (got[hi] - got[lo])
