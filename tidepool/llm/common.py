"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

# Rows of a Python output batch are sent on when their payload passes this.
BATCH_BYTES = 4 << 20


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, which the cluster sizes to its input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc32_mod(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))), F.lit(n))


def in_batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 20_000,
               weight=None) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``size`` rows, or of about BATCH_BYTES of ``weight(row)``."""
    kept: list[tuple] = []
    load = 0
    for row in rows:
        kept.append(row)
        load += weight(row) if weight else 0
        if len(kept) >= size or load >= BATCH_BYTES:
            yield to_batch(kept, schema)
            kept, load = [], 0
    if kept:
        yield to_batch(kept, schema)


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def utf8_values(column: pa.Array) -> Iterator[memoryview]:
    """The UTF-8 bytes of each string of an Arrow column, without copies; null is empty."""
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.large_string())
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    ends = memoryview(offsets).cast("q" if wide else "i") if offsets is not None else [0]
    body = memoryview(data) if data is not None else memoryview(b"")
    nulls = column.is_null().to_pylist() if column.null_count else None
    for i in range(len(column)):
        k = column.offset + i
        yield memoryview(b"") if nulls and nulls[i] else body[ends[k]:ends[k + 1]]
