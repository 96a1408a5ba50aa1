"""Session construction and shared execution settings."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every job relies on. Only applied when the cluster has not set
# them already, so a production spark-defaults.conf always wins.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "vialflow",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Return (or create) a session with the library defaults.

    ``master``/``shuffle_partitions`` are for local runs and tests; on a
    cluster leave them unset and size ``spark.sql.shuffle.partitions`` in
    the cluster config (AQE coalesces small partitions at runtime).
    """
    b = SparkSession.builder.appName(app)
    if master:
        # local runs: the driver JVM is the only executor
        b = b.master(master).config("spark.driver.memory", os.environ.get("VIALFLOW_DRIVER_MEMORY", "12g"))
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Make ``DataFrame.checkpoint()`` usable and return the shared folder.

    The folder named by ``spark.checkpoint.dir`` is used when the cluster
    sets it. Only when it is unset (local tests) is ``fallback`` or a fresh
    temporary folder used.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = fallback or tempfile.mkdtemp(prefix="vialflow-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application.

    Python workers then import it whatever their working directory or
    PYTHONPATH is; the zip travels through ``addPyFile``.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="vialflow-ship-"), "vialflow-package.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("vialflow", os.path.relpath(full, root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex[:12]}")


#: Rows that may be broadcast.
SMALL = 20_000


def small(df, limit: int = SMALL):
    """``df`` with a broadcast hint if it is counted to be small, else as it is."""
    from pyspark.sql import functions as F
    return F.broadcast(df) if df.count() <= limit else df


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df, name: str):
    """``df`` as a table in the shared folder: lineage is cut, and later reads
    prune columns (a checkpoint keeps whole serialised rows). Shuffle files of the
    write go with it, as nothing reads them again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
