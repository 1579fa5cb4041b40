"""Session helpers: a tuned local session for tests and the bench, and the
shared checkpoint folder every write-heavy operator works under."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cpus: int | str = 8, shuffle_partitions: int | None = None,
                  app: str = "lakeshore") -> SparkSession:
    """Session for tests and the bench. On a cluster, build the session with the
    cluster's own settings and only call :func:`checkpoint_root` on it."""
    parts = shuffle_partitions or (int(cpus) if str(cpus).isdigit() else 8)
    builder = SparkSession.builder
    event_log = os.environ.get("LAKESHORE_EVENT_LOG")
    if event_log:  # stage and task times, read with tools/stage_times.py
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_log))
    spark = (
        builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LAKESHORE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster names it; only when it is unset on a local master (tests, the
    bench) a fresh folder is made and set on the session and the context. A
    machine-local folder is useless to a cluster, so there it must be set."""
    sc = spark.sparkContext
    root = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError(f"set {_CHECKPOINT_KEY} to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="lakeshore-ckpt-")
        spark.conf.set(_CHECKPOINT_KEY, root)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


_scratch: list = []
_names: list = []


def _remove_scratch() -> None:
    """At the driver's end: drop and delete what :func:`scratch_name` and
    :func:`scratch_path` named, if it is there."""
    while _names:
        spark, kind, name = _names.pop()
        try:
            spark.sql(f"DROP {kind} IF EXISTS {name}{' CASCADE' if kind == 'SCHEMA' else ''}")
        except Exception:  # the session has gone, and its own catalog with it
            _names.clear()
    while _scratch:
        fs, path = _scratch.pop()
        try:
            fs.delete(path, True)
        except Exception:  # the JVM has gone: nothing can be done from here
            _scratch.clear()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder, deleted when the
    driver's Python ends (results that read it are lazy, so not before)."""
    if not _scratch and not _names:
        atexit.register(_remove_scratch)
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    _scratch.append((where.getFileSystem(spark._jsc.hadoopConfiguration()), where))
    return path


def scratch_name(spark: SparkSession, prefix: str, kind: str = "TABLE") -> str:
    """A fresh name for a table or schema, dropped when the driver's Python ends."""
    if not _scratch and not _names:
        atexit.register(_remove_scratch)
    name = f"{prefix}_{uuid.uuid4().hex}"
    _names.append((spark, kind, name))
    return name
