"""A training corpus from raw documents: five stages, each written to the shared folder and read again.

Every stage but the last returns rows with the columns of ``documents``; ``text`` and ``n_chars`` follow what a stage cuts.
Rows may have further columns, which go along until packing. Null and empty texts pass through every stage (they are of
the quality that the model gives a text without words); an empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import decontaminate, near_duplicates, packing, quality, secrets
from fleetlens.session import shared_dir


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the texts as they are now."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier accepts; it learns from the labels of the rows given."""
    return quality.keep_good(docs, quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates (similarity of 0.85 or more), that with the least key. Rows without words
    all stay."""
    return near_duplicates.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without the passages of test items; rows that are mostly test items go."""
    return _recounted(decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with their secrets replaced by a mark."""
    return _recounted(secrets.redact_secrets(docs, secrets.learn(docs)))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full training sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("packing", packed),
]

# The classifiers cannot be said in SQL; tests hold the stages to plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. A stage's table goes once the next one is written in full."""
    home = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for number, (name, stage) in enumerate(STAGES):
        path = f"{home}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(before)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
        before = path
    return docs
