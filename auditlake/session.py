"""Session setup shared by the library, tests and the bench."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock (calendar features are defined on
# the text time of the log), AQE for runtime re-planning and skew-join splitting.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # no Python call-site capture on every DataFrame/Column call (plan-building cost)
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "auditlake", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session; UI off, progress bars off."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **SESSION_CONF,
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Per-call session prerequisites (idempotent)."""
    for k, v in SESSION_CONF.items():
        if k == "spark.sql.execution.arrow.pyspark.enabled":
            continue
        # only runtime settings; static ones apply when we build the session
        if spark.conf.get(k, None) != v and spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by Python workers (like `--py-files`):
    zip it once per SparkContext and add it with `addPyFile`. The zip is read
    only by the driver; Spark's file server ships it to every executor, so no
    executor reads a driver-local path. Deployments that already ship the
    package (e.g. with `--py-files`) simply get a second copy."""
    sc = spark.sparkContext
    key = (id(sc), sc.applicationId)
    if key in _SHIPPED:
        return
    import zipfile
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="auditlake-pyfiles-"), "auditlake.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg_dir):
            if "__pycache__" in d:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(key)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used for checkpoints and written intermediate tables.

    Taken from ``spark.checkpoint.dir``. Only a local-mode session without the
    setting (tests, bench) gets a private scratch folder; a cluster session
    without it is an error, since a machine-local folder does not survive the
    loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        if not sc.master.startswith("local") and conf_dir.split(":")[0] in ("file", conf_dir):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder, not a path of one machine")
        sc.setCheckpointDir(conf_dir)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="auditlake-ckpt-"))
    else:
        raise RuntimeError("spark.checkpoint.dir must name a shared folder")
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def local_path(uri: str) -> str:
    """Strip a ``file:`` scheme (for tests that inspect written files)."""
    if uri.startswith("file:"):
        uri = uri[len("file:"):]
        while uri.startswith("//"):
            uri = uri[1:]
    return os.path.abspath(uri)
