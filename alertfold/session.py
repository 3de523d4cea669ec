"""Session helpers: timezone pinning, scratch space in the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every pipeline relies on. Timestamps are handled as TIMESTAMP_NTZ and
# parsed through session-zone functions, so the zone is pinned to UTC to make
# parse -> NTZ a pure wall-clock operation (no DST gaps).
_RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "alertfold") -> SparkSession:
    """Build (or reuse) a session. On a cluster pass master=None and let spark-submit decide."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in _RUNTIME_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (idempotent)."""
    for k, v in _RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only when it is unset (local runs, tests)
    a private folder is created and registered, so that executors and the driver
    agree on one location.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        existing = spark.sparkContext.getCheckpointDir()
        if existing:
            return existing.rstrip("/")
        if not spark.sparkContext.master.startswith("local"):
            # executors on other machines cannot see a folder of the driver's disk
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, object store) "
                               "before running on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="alertfold-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if not spark.sparkContext.getCheckpointDir():
        # DataFrame.checkpoint() needs the context-level setting (it adds a sub-folder)
        spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir.rstrip("/")


def scratch_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh sub-folder of the shared checkpoint root (never a machine-local path on a cluster)."""
    root = checkpoint_root(spark)
    suffix = uuid.uuid4().hex
    return f"{root}/alertfold/scratch/{name}-{suffix}" if name else f"{root}/alertfold/scratch/{suffix}"


def stable_dir(spark: SparkSession, *parts: str) -> str:
    """A deterministic sub-folder of the shared root, for staged data reused across calls."""
    root = checkpoint_root(spark)
    safe = [p.strip("/").replace("/", "_") for p in parts]
    return os.path.join(root, "alertfold", "staged", *safe)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of all executors: a zip of its
    sources goes out with the session's files, once per Spark context."""
    context = spark.sparkContext
    if getattr(context, "_alertfold_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="alertfold-zip-")  # read by the driver's own file service
    archive = os.path.join(folder, "alertfold_src.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for at, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(at, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    context._alertfold_shipped = True
