"""Sinks: CSV part files, tuple-text lines, request lines."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def write_csv(df: DataFrame, path: str, header: bool = False, mode: str = "errorifexists") -> None:
    """Directory of part files. For a sorted frame, part order is the sort order.

    Fails if the path exists unless ``mode`` says otherwise (Spark default).
    """
    (df.write.mode(mode).option("header", header)
     .option("timestampFormat", TS_FORMAT).option("timestampNTZFormat", TS_FORMAT)
     .csv(path))


def tuple_lines(df: DataFrame, key: str = "id", value: str = "rank") -> DataFrame:
    """``('key', value)`` text, the printed form of a Python (str, float) pair.

    Python's own notation of numbers and quoting of text, in Arrow batches.
    """
    @F.pandas_udf("string")
    def printed(keys: pd.Series, values: pd.Series) -> pd.Series:
        return pd.Series([repr(p) for p in zip(keys.tolist(), values.tolist(), strict=True)], dtype=object)

    return df.select(printed(F.col(key).cast("string"), F.col(value).cast("double")).alias("value"))


def write_lines(df: DataFrame, path: str, column: str = "value",
                mode: str = "errorifexists") -> None:
    """One text line per row."""
    df.select(F.col(column).cast("string").alias("value")).write.mode(mode).text(path)
