"""Session construction and the shared checkpoint folder.

Library code never creates a session of its own; it takes the caller's.
``build_session`` is for tests, the benchmark and the driver entry.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this package is written against.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "tessera", driver_memory: str = "16g") -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on, UTC)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tessera`` importable in Python workers: functions given to
    ``mapInPandas`` are pickled by reference to their module. The package is
    zipped once per application and handed to ``addPyFile``, which
    distributes it with the job (as ``--py-files`` would)."""
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    fd, path = tempfile.mkstemp(prefix="tessera-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, taken from ``spark.checkpoint.dir``.

    On a cluster the folder must be set by the cluster (shared storage). Only a
    local-mode session with no setting gets a fresh folder under /tmp.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster job needs a shared folder")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tessera-scratch", f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder.

    Used where a later step must see exactly the rows an earlier step saw
    (partition ids, positions) even if executors are lost in between.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def write_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table under the shared checkpoint folder. For wide tables
    that are read several times: columns are compressed and read alone, a checkpoint
    holds whole plain rows."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Repartition only when a scan yields fewer partitions than the cluster
    has cores (e.g. a small file with one row group), so that heavy per-row
    work (regexes over whole texts) runs in parallel. A large input already
    has enough splits and is returned unchanged: no extra shuffle at scale."""
    n = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= n:
        return df
    return df.repartition(n, key) if key else df.repartition(n)
