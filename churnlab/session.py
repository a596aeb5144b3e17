"""Session construction, shared scratch tables and packaging.

On a cluster the session is created by the launcher; ``get_session`` is for
tests, benchmarks and local runs. ``checkpoint_dir`` reads the shared folder
the cluster names in ``spark.checkpoint.dir``. Only a local master, where the
driver and the executors are one process, may do without that setting.
"""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import threading
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
#: Removes the shuffle files of a SQL execution when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Writers inside ``shuffle_cleanup`` for each session, and the setting before the first.
_CLEANING: dict[int, tuple[int, str | None]] = {}
_CLEANING_LOCK = threading.Lock()
#: Scratch tables written by this process: (session, path).
_SCRATCH: list[tuple[SparkSession, str]] = []


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "churnlab", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _LOCAL_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def _is_local(master: str | None) -> bool:
    return bool(re.fullmatch(r"local(\[[^\]]*\])?", master or ""))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables.

    The cluster's ``spark.checkpoint.dir`` (or a folder already registered with
    the context) wins. Without it a scratch folder is made only under a local
    master; any other master raises, since a machine-local folder would hold
    a part of the data on each executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect sessions expose no SparkContext
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(sc.master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share (master {sc.master})")
        configured = tempfile.mkdtemp(prefix="churnlab-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, deleted by ``drop_scratch`` or at exit."""
    path = os.path.join(checkpoint_dir(spark), "tables", f"{name}-{uuid.uuid4().hex}")
    _SCRATCH.append((spark, path))
    return path


@contextmanager
def shuffle_cleanup(spark: SparkSession):
    """Free the shuffle files of the executions inside as soon as each ends.
    Only for executions whose result is written out. Threads may write at once:
    the setting goes back when the last of them is done."""
    with _CLEANING_LOCK:
        writers, before = _CLEANING.get(id(spark), (0, None))
        if not writers:
            before = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _CLEANING[id(spark)] = (writers + 1, before)
    try:
        yield
    finally:
        with _CLEANING_LOCK:
            writers, before = _CLEANING.pop(id(spark))
            if writers > 1:
                _CLEANING[id(spark)] = (writers - 1, before)
            elif before is None:
                spark.conf.unset(_CLEANUP)
            else:
                spark.conf.set(_CLEANUP, before)


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder and
    read it back: the lineage is cut (a lost executor re-reads files instead
    of recomputing joins), the input is computed in ONE pass (an eager RDD
    checkpoint runs it twice unless cached), and later reads of the table get
    column pruning and filter pushdown. Never a local checkpoint."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffle_cleanup(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables of this session; frames that read them must be
    finished with. Jobs call it at their end, and it runs at exit."""
    mine = [p for s, p in _SCRATCH if s is spark]
    _SCRATCH[:] = [(s, p) for s, p in _SCRATCH if s is not spark]
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in mine:
        path = hadoop.Path(p)
        path.getFileSystem(conf).delete(path, True)
    return len(mine)


@atexit.register
def _drop_all() -> None:
    for spark in {id(s): s for s, _ in _SCRATCH}.values():
        try:
            if spark.sparkContext._jsc is not None:
                drop_scratch(spark)
        except Exception:  # the JVM is gone; nothing can be deleted through it
            pass


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, so that functions of its modules can
    be unpickled there. Once per context."""
    sc = spark.sparkContext
    if getattr(sc, "_churnlab_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="churnlab-pkg-"), "churnlab.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("churnlab", os.path.relpath(full, root)))
    sc.addPyFile(target)
    sc._churnlab_shipped = True
