"""CSV sources: all-string tables (no inference) and typed reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv_strings(spark: SparkSession, path: str, header: bool = True,
                     sep: str = ",") -> DataFrame:
    """Every column a string; an empty field reads as NULL (Spark default)."""
    return spark.read.option("header", header).option("sep", sep).csv(path)


def read_csv_typed(spark: SparkSession, path: str, schema: StructType | str,
                   header: bool = True, mode: str = "strict", sep: str = ",") -> DataFrame:
    """Header row, explicit schema. ``strict`` fails on bad text; ``drop`` skips the row.

    Both apply to rows as they are parsed; a bare ``count()`` may skip
    parsing altogether (CSV column pruning) and so count a bad row.
    """
    spark_mode = {"strict": "FAILFAST", "drop": "DROPMALFORMED"}[mode]
    return (spark.read.schema(schema).option("header", header).option("sep", sep)
            .option("mode", spark_mode).csv(path))
