"""Rows named by a key table, without moving the rows that it does not name."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import in_batches
from tidepool.llm.repeats import KEYED, KEYED_DDL, bits_for, place_rows, repeated


def parted(rows: DataFrame, named: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows whose ``keys`` are surely not in ``named``, and the others.

    A bitmap of the keys of ``named`` (sized to their number, bounded) goes
    to every task; it may say yes for a key that is not there, never no for
    one that is. So the first part can pass as it is and only the second,
    about as large as ``named``, needs a join. ``named`` is read twice and
    should be stored. Null keys are like any other value.
    """
    bits = bits_for(named.count())

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            for batch in batches:
                own = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                yield from place_rows(np.repeat(own, 2), bits)

        yield from in_batches(out(), KEYED)

    bitmap = repeated(named.select(F.xxhash64(*keys).alias("k")).mapInArrow(places, KEYED_DDL), bits)
    shared = rows.sparkSession.sparkContext.broadcast(bitmap)

    @F.pandas_udf("boolean")
    def listed(key: pd.Series) -> pd.Series:
        return pd.Series(shared.value.has(key.to_numpy().astype(np.int64).view(np.uint64)))

    flag = listed(F.xxhash64(*keys))
    return rows.where(~flag), rows.where(flag)
