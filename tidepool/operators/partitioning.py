"""Partitioning, persistence and inspection."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..session import ensure_checkpoint_dir, remove_path

LEVELS = {
    "memory": StorageLevel.MEMORY_ONLY,
    "disk": StorageLevel.DISK_ONLY,
    "memory_and_disk": StorageLevel.MEMORY_AND_DISK,
}


def bucket_of(df: DataFrame, key: str, n: int) -> Column:
    """The own partition function: ``key mod n`` (non-negative) as an int.

    Integer keys are used as they are, any other key by the first 8 hex
    digits of the MD5 of its text. A null key goes to bucket 0.
    """
    if isinstance(df.schema[key].dataType, IntegralType):
        number = F.col(key).cast("long")
    else:
        number = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long")
    return F.coalesce(F.pmod(number, F.lit(n)), F.lit(0)).cast("int")


def place_in_buckets(df: DataFrame, bucket: str, n: int) -> DataFrame:
    """Rows of bucket i in partition i, of ``n`` partitions."""
    return df.repartitionById(n, F.col(bucket))


def partition_by_key(df: DataFrame, n: int, *keys: str | Column) -> DataFrame:
    """Hash-partition into ``n`` partitions on ``keys`` (a shuffle).

    Later joins and aggregations on the same keys with the same partition
    count reuse this partitioning instead of exchanging again.
    """
    return df.repartition(n, *keys)


def persist_at(df: DataFrame, level: str = "memory_and_disk") -> DataFrame:
    return df.persist(LEVELS[level])


def storage_level(df: DataFrame) -> StorageLevel:
    return df.storageLevel


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per partition (empty partitions do not appear)."""
    return (df.select(F.spark_partition_id().alias("partition"))
            .groupBy("partition").agg(F.count(F.lit(1)).alias("rows")))


def num_partitions(df: DataFrame) -> int:
    return df.rdd.getNumPartitions()


def write_bucketed(df: DataFrame, n: int, key: str, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` as a table bucketed (and sorted) on ``key`` into ``n`` files.

    The files go under the shared checkpoint folder, so they survive the
    loss of any executor; reading them back reports hash partitioning on
    ``key`` with ``n`` partitions, so joins and aggregations on ``key`` with
    the same count need no exchange (Spark's bucket hash is the shuffle hash).
    The rows are dealt by the same hash first: each task writes one bucket.

    Returns the frame and the name to give to ``drop_table`` when done.
    """
    spark = df.sparkSession
    name = f"tidepool_{label}_{uuid.uuid4().hex[:12]}"
    (df.repartition(n, key).write.format("parquet").bucketBy(n, key).sortBy(key)
     .option("path", table_path(spark, name)).saveAsTable(name))
    return spark.table(name), name


def table_path(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}"


def drop_table(spark: SparkSession, name: str) -> None:
    """Remove a table written by ``write_bucketed`` and its files."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    remove_path(spark, table_path(spark, name))
