"""Row and key rules of a result table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.schemas import TableSpec


def broken_rules(spec: TableSpec) -> Column:
    """Names of the NOT NULL and length rules a row breaks, as an array."""
    checks = [F.when(F.col(c).isNull(), F.lit(f"not_null:{c}")) for c in spec.required]
    checks += [
        F.when(F.char_length(c) > width, F.lit(f"max_length:{c}")) for c, width in spec.max_length.items()
    ]
    return F.array_compact(F.array(*checks))


def check_constraints(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """Split rows into those that keep the row rules and those that do not, the latter with ``broken``."""
    checked = df.withColumn("broken", broken_rules(spec))
    return checked.where(F.size("broken") == 0).drop("broken"), checked.where(F.size("broken") > 0)


def duplicate_keys(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Keys held by more than one row, with their number of rows. Counted before the shuffle, so hot keys are cheap."""
    keyed = df.where(" AND ".join(f"{k} IS NOT NULL" for k in spec.keys))
    return keyed.groupBy(*spec.keys).agg(F.count(F.lit(1)).alias("total")).where(F.col("total") > 1)


def violation_report(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows per broken rule, and surplus rows per primary key."""
    _, broken = check_constraints(df, spec)
    rows = broken.select(F.explode("broken").alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("total"))
    surplus = duplicate_keys(df, spec).agg(F.coalesce(F.sum(F.col("total") - 1), F.lit(0)).alias("total"))
    keys = surplus.where(F.col("total") > 0).select(F.lit("primary_key:" + ",".join(spec.keys)).alias("rule"), "total")
    return rows.unionByName(keys)
