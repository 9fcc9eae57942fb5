"""Session helpers: a configured SparkSession and a shared scratch location.

Library code never creates a session of its own; these helpers are for
scripts, the bench and tests.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on.  Partition counts are left to the
# cluster's defaults plus AQE, which coalesces small shuffle partitions and
# splits skewed ones at run time.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # Runtime Bloom filters (operators/mentions.py): from a side of up to 4 GB, in
    # front of the shuffle of a side that scans 1 GB or more.
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "4GB",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1GB",
    # Analyses run side by side share the executors fairly (plans/runner.py).
    "spark.scheduler.mode": "FAIR",
    # Generated methods above this size (bytes of bytecode) are never compiled
    # by the JVM; such stages then run through smaller generated functions.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(
    master: str | None = None,
    app_name: str = "eventlens",
    conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    value = spark.conf.get("spark.checkpoint.dir", None)
    if value:
        return value
    try:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        return found.get() if found.isDefined() else None
    except Exception:  # Spark Connect has no JVM handle
        return None


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process on one machine."""
    master = spark.conf.get("spark.master", "")
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the configured ``spark.checkpoint.dir``; only in local mode, when
    none is set (tests), create one under the system temp folder."""
    found = checkpoint_dir(spark)
    if found:
        return found
    if not is_local(spark):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="eventlens-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def stream_checkpoint_root(spark: SparkSession) -> str:
    """Where stream checkpoints may live: the configured folder, which stays the
    same from run to run; in local mode without one, the session's own."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not is_local(spark):
        raise ValueError("name a stream checkpoint folder, or set spark.checkpoint.dir")
    return ensure_checkpoint_dir(spark).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location, for data a job
    writes and reads back (never a machine-local temp folder on a cluster);
    removed when the application ends."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/eventlens/{name}-{uuid.uuid4().hex[:12]}"
    try:  # lazy results read it until the application ends
        hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        hpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    except AttributeError:  # Spark Connect has no JVM handle
        pass
    for made in _made:
        made.append(path)
    return path


#: Lists of the scratch folders made inside each open ``scratch_scope``.
_made: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch folders made inside, for work whose result is written
    elsewhere before the end."""
    paths: list[str] = []
    _made.append(paths)
    try:
        yield
    finally:
        _made[:] = [m for m in _made if m is not paths]
        for path in paths:
            remove_path(spark, path)


def write_and_read(df: DataFrame, path: str, **options: str) -> DataFrame:
    """``df`` written to ``path`` and read back, its schema kept: later plans see
    its measured size, and a lost executor costs a re-read.  ``options`` are the
    writer's."""
    df.write.mode("overwrite").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder through the Hadoop file system."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)

