"""Driver tables (one Parquet file each) and the table names they carry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def numbered_table(spark: SparkSession, sf_dir: str, name: str, index: str = "row_no") -> DataFrame:
    """The table with dense 0-based row numbers in stored order, found without an exchange of rows.

    Parquet tells each row's place in its file; the counts of the files (one
    row each), in the order of their names, give each file its first number.
    """
    rows = table(spark, sf_dir, name).select("*", F.col("_metadata.file_path").alias("_tp_file"), F.col("_metadata.row_index").alias("_tp_row"))
    counts = rows.groupBy("_tp_file").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_tp_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_tp_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_tp_before"))
    return rows.join(offsets, "_tp_file").withColumn(index, F.col("_tp_before") + F.col("_tp_row")).drop("_tp_file", "_tp_row", "_tp_before")


# Schema of serving-run records that are given in line; measures of runs that
# failed are null (not-a-number values become null).
RUN_RECORD = ("model_name string, num_layers int, num_heads int, tp_size int, pp_size int, batch_size int, "
              "input_length int, output_length int, total_latency_s double, token_per_second double, "
              "total_output_tokens double")


def records(spark: SparkSession, rows: list[dict], schema: str = RUN_RECORD) -> DataFrame:
    """A frame of in-line records; absent fields and not-a-number values are null."""
    frame = spark.createDataFrame(rows, schema)
    numbers = [c for c, t in frame.dtypes if t in ("double", "float")]
    return frame.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in numbers})
