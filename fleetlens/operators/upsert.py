"""Keyed upsert of result tables.

Result tables hold one row per line or vehicle. On Parquet an upsert writes the merged table as the table's own next
version and readers take the newest complete one. A version is marked with the batch it came from, the id of the streaming
query and the number of the batch: a batch repeated after a failure finds its version and changes nothing, and a query
that starts afresh merges on top of what is stored. On a database the batch goes to a staging table and one
``INSERT .. ON CONFLICT`` merges it.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.operators.constraints import check_constraints
from fleetlens.operators.latest import newest_rows
from fleetlens.schemas import TableSpec

# Seconds that a version stays readable after a newer one has replaced it.
KEEP_SECONDS = 900


class BatchId(NamedTuple):
    """A micro-batch: the id that a streaming query keeps over restarts, and its number."""

    query: str
    number: int

    def __str__(self) -> str:
        return f"{self.query}_{self.number}"


class Version(NamedTuple):
    number: int
    batch: str
    written_ms: int
    folder: str


def merge_latest(target: DataFrame, batch: DataFrame, keys: Sequence[str], updated: str) -> DataFrame:
    """One row per key from both frames: the newest by ``updated``, and the batch's row when equally new."""
    both = target.withColumn("_source", F.lit(0)).unionByName(batch.withColumn("_source", F.lit(1)))
    return newest_rows(both, keys, [updated, "_source"]).drop("_source")


def _folder(spark: SparkSession, path: str):
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return root, root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, path: str) -> list[Version]:
    """Complete versions under ``path``, oldest first, from one listing. Their folders are named
    ``version=<number>_<query>_<batch>``; the marker that Spark writes last tells that one is complete, and when."""
    root, fs = _folder(spark, path)
    if not fs.exists(root):
        return []
    found, files = [], fs.listFiles(root, True)
    while files.hasNext():
        status = files.next()
        file = status.getPath()
        name = file.getParent().getName()
        if file.getName() == "_SUCCESS" and name.startswith("version="):
            number, _, batch = name.removeprefix("version=").partition("_")
            found.append(Version(int(number), batch, status.getModificationTime(), f"{path}/{name}"))
    return sorted(found)


def has_version(spark: SparkSession, path: str, batch: BatchId) -> bool:
    """Whether a batch has been written already."""
    return any(version.batch == str(batch) for version in _versions(spark, path))


def read_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """The newest complete version of a table, or an empty frame."""
    versions = _versions(spark, path)
    if not versions:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(versions[-1].folder)


def write_version(table: DataFrame, path: str, batch: BatchId, keep_seconds: int = KEEP_SECONDS) -> None:
    """Write the next version, sorted by line inside its files so that a lookup by line skips row groups, and drop versions
    that were replaced more than ``keep_seconds`` ago. The newest two always stay."""
    spark = table.sparkSession
    versions = _versions(spark, path)
    number = versions[-1].number + 1 if versions else 0
    ordered = table.sortWithinPartitions("linha") if "linha" in table.columns else table
    ordered.write.mode("overwrite").parquet(f"{path}/version={number:012d}_{batch}")
    written = _versions(spark, path)
    for old, newer in zip(written[:-2], written[1:-1], strict=True):
        if written[-1].written_ms - newer.written_ms > 1000 * keep_seconds:
            outdated, fs = _folder(spark, old.folder)
            fs.delete(outdated, True)


def keep_valid(rows: DataFrame, batch: BatchId, path: str, spec: TableSpec) -> DataFrame:
    """Rows that keep the table's rules. If there are others, they go to ``<path>_rejects`` with the rules they break, in a
    folder of their batch, which a repeated batch overwrites."""
    good, bad = check_constraints(rows, spec)
    if not bad.isEmpty():
        bad.write.mode("overwrite").parquet(f"{path}_rejects/batch={batch}")
    return good


def read_rejects(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """All rejected rows of a table, with ``broken`` and ``batch``; none, if there were none yet."""
    schema = f"{_ddl(spec)}, broken array<string>, batch string"
    root, fs = _folder(spark, f"{path}_rejects")
    if not fs.exists(root):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}_rejects")


def upsert(rows: DataFrame, batch: BatchId, path: str, spec: TableSpec, keep_seconds: int = KEEP_SECONDS) -> None:
    """Merge the valid rows of a batch into a Parquet table. A batch that has been merged already changes nothing."""
    spark = rows.sparkSession
    if has_version(spark, path, batch):
        return
    valid = keep_valid(rows.select(*spec.columns), batch, path, spec)
    current = read_table(spark, path, spec.schema)
    write_version(merge_latest(current, valid, spec.keys, spec.updated), path, batch, keep_seconds)


def conflict_sql(spec: TableSpec, staging: str) -> str:
    """Statement that merges a staging table into the target by primary key; a newer row is never replaced by an older."""
    columns, keys = ", ".join(spec.columns), ", ".join(spec.keys)
    dated = spec.updated not in spec.keys
    newest = f"{keys}, {spec.updated} DESC" if dated else keys
    changed = [c for c in spec.columns if c not in spec.keys]
    assignments = ", ".join(f"{c} = EXCLUDED.{c}" for c in changed)
    unless_newer = f" WHERE {spec.name}.{spec.updated} <= EXCLUDED.{spec.updated}" if dated else ""
    return (
        f"INSERT INTO {spec.name} ({columns}) "
        f"SELECT DISTINCT ON ({keys}) {columns} FROM {staging} ORDER BY {newest} "
        f"ON CONFLICT ({keys}) DO UPDATE SET {assignments}{unless_newer}"
    )


def upsert_jdbc(rows: DataFrame, batch: BatchId, spec: TableSpec, url: str, properties: dict[str, str]) -> None:
    """Stage rows over JDBC and merge them in one transaction. Every query has its own staging table, replaced by each
    batch, so repeats are safe and writers do not meet."""
    staging = f"{spec.name}_staging_{batch.query.replace('-', '')}"
    rows.select(*spec.columns).write.mode("overwrite").jdbc(url, staging, properties=properties)
    jvm = rows.sparkSession.sparkContext._jvm
    settings = jvm.java.util.Properties()
    for key, value in properties.items():
        settings.setProperty(key, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, settings)
    try:
        connection.createStatement().executeUpdate(conflict_sql(spec, staging))
    finally:
        connection.close()


# When a history row was written, in microseconds of the writing driver's clock.
WRITTEN = "written_us"


def append_history(rows: DataFrame, batch: BatchId, path: str, spec: TableSpec) -> None:
    """Add windows to a history table laid out by date, so that a query on a span of time reads only its days.

    Every batch owns one folder below each date, which a repeated batch overwrites. Rows carry the time of writing; rows
    that have one already, as those that are compacted, keep it.
    """
    written = F.col(WRITTEN) if WRITTEN in rows.columns else F.lit(time.time_ns() // 1000)
    dated = rows.select(*spec.columns, written.alias(WRITTEN)).withColumns(
        {"window_date": F.to_date(spec.updated), "batch": F.lit(str(batch))})
    (
        dated.hint("rebalance", "window_date")
        .sortWithinPartitions("window_date", *spec.keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("window_date", "batch")
        .parquet(path)
    )


def _last_written(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    found = spark.read.schema(f"{_ddl(spec)}, {WRITTEN} long, window_date date, batch string").parquet(path)
    keys = [*spec.keys, "window_date"]
    others = [c for c in spec.columns if c not in keys]
    order = F.struct(F.coalesce(WRITTEN, F.lit(0)), "batch", *others)
    last = F.max_by(F.struct(*others, WRITTEN), order).alias("_last")
    return found.groupBy(*keys).agg(last).select(*keys, "_last.*")


def read_history(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """History rows, one per key: the one written last, whole. Filters on keys and dates reach the files."""
    return _last_written(spark, path, spec).select(*spec.columns, "window_date")


def _ddl(spec: TableSpec) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spec.schema.fields)


def compact_history(spark: SparkSession, path: str, spec: TableSpec, before: str) -> None:
    """Rewrite the folders of each day before ``before`` (a date) into one.

    The new folder is complete before the old ones go, and readers take one row per key, so nothing is lost or doubled if
    this stops half way. Call it for days whose batches will not be repeated any more.
    """
    root, fs = _folder(spark, path)
    for day in [status.getPath() for status in fs.listStatus(root)]:
        date = day.getName().removeprefix("window_date=")
        parts = [status.getPath() for status in fs.listStatus(day)] if date != day.getName() and date < before else []
        if len(parts) > 1:
            rows = _last_written(spark, path, spec).where(F.col("window_date") == F.lit(date).cast("date"))
            append_history(rows, BatchId(f"compacted-{uuid.uuid4().hex}", 0), path, spec)
            for part in parts:
                fs.delete(part, True)
