"""Helpers shared by the operators: shared-folder tables, deterministic splits, whole-table readers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that separate words everywhere in this package: space and TAB to CR.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; only a session without ``spark.checkpoint.dir`` (a local test) gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = "file://" + tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: its lineage ends in files every executor sees."""
    path = f"{shared_dir(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """Number of partitions for work that grows far beyond its input rows, which Spark would otherwise coalesce."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession) -> None:
    """Rows of texts per Arrow batch: Spark's default of 10,000 rows holds tens of megabytes of text, on both sides of
    every worker.  A value that the session sets itself stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, "1000")


def crc_is_one(doc_id: Column, mod: int) -> Column:
    """The held-out split: crc32 of the id as text leaves remainder 1 (a null id never does)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % mod == 1, F.lit(False))
