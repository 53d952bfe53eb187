"""Session helpers.

The library never creates a session implicitly; callers pass one in. The
helpers here are for tests, ``bench.py`` and scripts.
"""

from __future__ import annotations

import atexit
import gc
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "panelforge") -> SparkSession:
    """A local session configured like the cluster profile (UTC, ANSI on, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("PANELFORGE_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, preferring the shared one named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is used as is. When
    it is unset, a folder already registered with the SparkContext is reused.
    Only a local master may fall back to a private temporary folder, which is
    removed when the driver ends; any other master without a shared folder is an
    error, because executors could not read each other's files. The setting
    itself is a core config and is not modified.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Spark Connect session has no SparkContext; the conf is all there is
        sc = None
    registered = sc.getCheckpointDir() if sc is not None else None
    if current:
        if sc is not None and not registered:
            sc.setCheckpointDir(current)
        return current
    if registered:
        return registered
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="panelforge-ckpt-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    if sc is not None:
        sc.setCheckpointDir(folder)
    return folder


def materialize(df):
    """Cut the lineage of ``df`` with a reliable checkpoint in ``spark.checkpoint.dir``.

    Used before iterative work (model fits, sequential fences) so that each
    iteration reads the written rows instead of recomputing the aggregation
    chain, and so that a lost executor does not force recomputation from the
    raw tables.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared ``spark.checkpoint.dir`` (never a machine-local
    temporary folder, which other executors of a cluster could not read).

    The folder is deleted when the driver's file system is closed at its end.
    """
    root = ensure_checkpoint_dir(spark).rstrip("/")
    folder = f"{root}/panelforge-exchange/{name}-{uuid.uuid4().hex}"
    try:
        jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:  # noqa: BLE001 - a Spark Connect session has no JVM; the folder stays
        return folder
    path = jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(hadoop)
    files.mkdirs(path)  # only an existing path can be marked
    files.deleteOnExit(path)
    return f"{folder}/data"


def release_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished queries now, not when the driver happens to collect its garbage.

    For use between a large preparation, whose result is written, and long work on that result.
    """
    gc.collect()
    try:
        spark.sparkContext._jvm.System.gc()
    except Exception:  # noqa: BLE001 - a Spark Connect session has no JVM; its server cleans up by itself
        pass


def write_once(df, name: str):
    """Write ``df`` as Parquet in a scratch folder and read it back.

    Like ``materialize``, but readers prune columns, and Spark knows the size of
    what it reads: a small table is broadcast by its threshold, a large one is not.
    """
    path = shared_scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
