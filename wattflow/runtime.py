"""Session-level helpers: shared scratch folders and hand-off tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and hand-off tables.

    Read from ``spark.checkpoint.dir`` (setting or context). Where the session has
    none: on a ``local`` master, one machine, a folder of its own; on a cluster the
    warehouse, and an error if that is a machine's own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if re.fullmatch(r"local(\[[^\]]*\])?", master):
            root = tempfile.mkdtemp(prefix="wattflow-ckpt-")
        else:
            root = _join(spark.conf.get("spark.sql.warehouse.dir", "file:"), "_wattflow")
            if root.startswith(("file:", "/")):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None for a Spark Connect client."""
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect sessions have no driver-side context
        return None


def _join(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/")] + [p.strip("/") for p in parts])


def sanitise(name: str) -> str:
    """Make a query name safe as one path segment."""
    return re.sub(r"[^A-Za-z0-9_.-]+", "_", name).strip("._") or "query"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared root for one run."""
    return _join(shared_root(spark), "wattflow", f"{sanitise(name)}-{uuid.uuid4().hex[:12]}")


def checkpoint_for(spark: SparkSession, query_name: str, root: str | None = None) -> str:
    """One checkpoint directory per streaming query, sanitised name."""
    base = root or _join(shared_root(spark), "wattflow", "checkpoints")
    return _join(base, sanitise(query_name))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's FileSystem (works for any scheme).

    Without a driver-side context (Spark Connect) it asks the data source: a
    folder with readable Parquet files exists.
    """
    sc = _context(spark)
    if sc is None:
        try:
            spark.read.parquet(path).schema
            return True
        except Exception:
            return False
    hpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(sc._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def hand_off(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    What follows re-reads files instead of recomputing ``df``, also after a lost
    executor, and the planner knows the table's size in bytes: it broadcasts it
    only below ``spark.sql.autoBroadcastJoinThreshold`` (also in a stream-static
    join, where adaptive execution does not run).
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "wattflow") -> SparkSession:
    """A local session for tests, tools and the bench (the cluster supplies its own)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("WATTFLOW_DRIVER_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", os.environ.get("WATTFLOW_TZ", "UTC"))
        .config("spark.sql.parquet.datetimeRebaseModeInWrite", "CORRECTED")
        .config("spark.sql.parquet.int96RebaseModeInWrite", "CORRECTED")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    return spark
