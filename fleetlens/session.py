"""Session settings the plans rely on."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Recording the Python call site of every expression slows planning down.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app: str = "fleetlens", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's checkpoint dir, or on a local master a folder of this process, which
    is removed when it ends."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError(f"name a shared folder in spark.checkpoint.dir: executors of {master} do not share local folders")
    local = tempfile.mkdtemp(prefix="fleetlens-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    spark.sparkContext.setCheckpointDir("file://" + os.path.abspath(local))
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable without replacing a folder the cluster already named."""
    folder = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package, unless their search path has it already. Done once per Spark context."""
    context, home = spark.sparkContext, os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(home)
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(context, "_fleetlens_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="fleetlens-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "fleetlens.zip")
    with zipfile.ZipFile(archive, "w") as packed:
        for path, _, names in os.walk(home):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(path, name)
                    packed.write(full, os.path.relpath(full, root))
    context.addPyFile(archive)
    context._fleetlens_shipped = True
