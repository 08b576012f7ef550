"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brewlens.session import scratch_path

BATCH_ROWS = 1000   # rows of an Arrow batch: whole texts, so batches are kept small


def prepare(spark: SparkSession) -> None:
    """Session settings the Arrow stages rely on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crc_of_id(doc_id: Column) -> Column:
    """crc32 of the id written as text (null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def qualified(spark: SparkSession, path: str) -> str:
    """The path as a URI with its file system (``hdfs://...``, ``file:///...``), as Spark would read it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    uri = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()
    return "file:///" + uri[5:].lstrip("/") if uri.startswith("file:") else uri


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to a fresh folder under the shared checkpoint folder and read it back:
    cuts the lineage, survives lost executors, and is computed once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
