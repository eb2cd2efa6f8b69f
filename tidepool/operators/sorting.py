"""Global sorts and ordered output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import with_ordinal


def sort_with_position(df: DataFrame, keys: Sequence[str | Column],
                       name: str = "position") -> DataFrame:
    """Global sort that also numbers the rows 0, 1, 2, ... in sort order.

    Ties in ``keys`` get a fixed but arbitrary order; give a unique key for a
    reproducible numbering. Rows of equal keys are spread over several ranges.
    """
    return with_ordinal(df, keys, name, split_ties=True)


def sorted_parts(df: DataFrame, keys: Sequence[str | Column], num_partitions: int | None = None) -> DataFrame:
    """A global sort for a sink: partition i holds what comes before partition i + 1.

    Ranges are cut by the keys and, within equal keys, by input split and
    place in it: a key pair with a third of all rows fills a third of the
    partitions, not one.
    """
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    tied = df.withColumn("_tp_tie", F.monotonically_increasing_id())
    order = [*cols, F.col("_tp_tie")]
    ranged = tied.repartitionByRange(num_partitions, *order) if num_partitions else tied.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order).drop("_tp_tie")


def first_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """``head()``: the first n rows of a frame (in its current order)."""
    return df.limit(n)


def ranks_by_id(ranks: DataFrame, id_col: str = "id", rank: str = "rank") -> DataFrame:
    """(id, rank) sorted as printed tuples: by id as a string, then by rank."""
    return ranks.orderBy(F.col(id_col).cast("string"), F.col(rank))
