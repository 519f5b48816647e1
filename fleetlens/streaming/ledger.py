"""Which jobs have finished a micro-batch: one empty file for each, below a folder of the batch."""

from __future__ import annotations

from pyspark.sql import SparkSession

from fleetlens.operators.upsert import BatchId


def _folder(spark: SparkSession, path: str):
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return root, root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def finished(spark: SparkSession, ledger: str, batch: BatchId) -> set[str]:
    root, fs = _folder(spark, f"{ledger}/{batch}")
    return {status.getPath().getName() for status in fs.listStatus(root)} if fs.exists(root) else set()


def finish(spark: SparkSession, ledger: str, batch: BatchId, job: str) -> None:
    file, fs = _folder(spark, f"{ledger}/{batch}/{job}")
    fs.create(file, True).close()


def forget(spark: SparkSession, ledger: str, batch: BatchId) -> None:
    """Drop the entries of other batches of the same query: a batch that comes after them has finished."""
    root, fs = _folder(spark, ledger)
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith(f"{batch.query}_") and name != str(batch):
            fs.delete(status.getPath(), True)
