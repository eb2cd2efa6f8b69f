"""Order-dependent operators that stay balanced when one key is hot.

A window ``PARTITION BY key ORDER BY ...`` sends every row of a key to one
task; if one key holds a third of the data, that task holds a third of the
data. The helpers here avoid that:

* ``with_ordinal`` gives every row its dense 0-based position in a global
  sort. A range exchange spreads a hot key over many partitions; the
  position comes from per-partition counts (one row per partition, so the
  offsets table is bounded by the partition count and safe to broadcast).
* ``with_next`` and ``with_prev`` pair each row with its neighbour of the same
  key through windows over blocks of positions and a one-row-per-block table.
* ``with_group_start`` gives the position of the first row of each key from
  windows over fixed-size blocks of positions plus a one-row-per-block
  table, so a hot key never meets a join on its own key.
* ``fill_forward`` carries the last non-null value down within a key; it is a
  recurrence, which ``scan`` works out in levels of blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .scan import SIZES, Recurrence, scan

_PID = "_tp_pid"
_MID = "_tp_mid"
_OFF = "_tp_off"
_TIE = "_tp_tie"

DEFAULT_BLOCK_ROWS = 1 << 16


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def with_ordinal(df: DataFrame, order_by: Sequence[str | Column], name: str = "pos",
                 num_partitions: int | None = None, split_ties: bool = False) -> DataFrame:
    """Add ``name``: dense 0-based position of each row in ``ORDER BY order_by``.

    ``order_by`` should be a unique key; ties get an arbitrary but fixed order
    (the sorted frame is checkpointed, so every later read sees the same one).
    ``split_ties`` orders equal keys by input split and place in it, so that
    many rows of one key are spread over several ranges.
    """
    keys = _cols(order_by)
    if split_ties:
        df, keys = df.withColumn(_TIE, F.monotonically_increasing_id()), [*keys, F.col(_TIE)]
    # Without an explicit count AQE may merge adjacent ranges (order kept);
    # spark_partition_id below is read after that, on the final layout.
    ranged = (df.repartitionByRange(num_partitions, *keys) if num_partitions
              else df.repartitionByRange(*keys)).sortWithinPartitions(*keys)
    tagged = materialize(ranged.withColumn(_PID, F.spark_partition_id())
                         .withColumn(_MID, F.monotonically_increasing_id()))
    counts = tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias("_tp_n"))
    # One row per partition: the unpartitioned running sum is bounded.
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PID, F.coalesce(F.sum("_tp_n").over(before), F.lit(0))
                            .cast("long").alias(_OFF))
    local = F.col(_MID) - F.shiftleft(F.col(_PID).cast("long"), 33)
    return (tagged.join(F.broadcast(offsets), _PID)
            .withColumn(name, F.col(_OFF) + local)
            .drop(_PID, _MID, _OFF, _TIE))


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match each other; keeps the left key columns."""
    named = right.select(*[F.col(k).alias(f"_tp_r_{k}") for k in keys],
                         *[c for c in right.columns if c not in keys])
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_tp_r_{k}"))
    return left.join(named, cond, how).drop(*[f"_tp_r_{k}" for k in keys])


def _with_neighbour(df: DataFrame, keys: Sequence[str], pos: str, cols: Sequence[str],
                    suffix: str, step: int, block_rows: int) -> DataFrame:
    """Attach ``cols`` of the row at ``pos + step`` (step 1 or -1) when it has the same ``keys``.

    Windows over blocks of positions find the neighbour inside a block; the
    row at a block's edge takes it from a table with one row per block. The
    rows are exchanged once, by block.
    """
    row = F.struct(F.col(pos).alias("p"), F.struct(*[F.col(k) for k in keys]).alias("k"),
                   *[F.col(c).alias(f"c{i}") for i, c in enumerate(cols)])
    blk = F.floor(F.col(pos) / F.lit(block_rows)).cast("long")
    in_block = Window.partitionBy("_tp_nblk").orderBy(pos)
    near = F.lead(row) if step > 0 else F.lag(row)
    edge = F.min_by(row, F.col(pos)) if step > 0 else F.max_by(row, F.col(pos))
    edges = df.groupBy((blk - step).alias("_tp_nblk")).agg(edge.alias("_tp_edge"))
    t = df.withColumn("_tp_nblk", blk).withColumn("_tp_near", near.over(in_block))
    t = t.join(edges, "_tp_nblk", "left").withColumn("_tp_near", F.coalesce("_tp_near", "_tp_edge"))
    same = F.struct(*[F.col(k) for k in keys])
    fits = (F.col("_tp_near.p") == F.col(pos) + step) & (F.col("_tp_near.k") == same)
    return t.select(*df.columns, *[F.when(fits, F.col(f"_tp_near.c{i}")).alias(c + suffix)
                                   for i, c in enumerate(cols)], F.coalesce(fits, F.lit(False)).alias("_tp_fits"))


def with_next(df: DataFrame, keys: Sequence[str], pos: str, cols: Sequence[str],
              suffix: str = "_next", how: str = "left",
              block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Attach ``cols`` of the row at ``pos + 1`` when it has the same ``keys``.

    ``df`` must carry a dense ordinal ``pos`` over an order whose leading
    columns are ``keys`` (so each key's rows are contiguous). ``how="inner"``
    leaves out rows without a next one. Null keys equal each other.
    """
    out = _with_neighbour(df, keys, pos, cols, suffix, 1, block_rows)
    return (out.where("_tp_fits") if how == "inner" else out).drop("_tp_fits")


def with_prev(df: DataFrame, keys: Sequence[str], pos: str, cols: Sequence[str],
              suffix: str = "_prev", block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Attach ``cols`` of the row at ``pos - 1`` when it has the same ``keys``."""
    return _with_neighbour(df, keys, pos, cols, suffix, -1, block_rows).drop("_tp_fits")


def with_group_start(df: DataFrame, keys: Sequence[str], pos: str,
                     name: str = "group_start",
                     block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Add the position of the first row of each key (``row_number = pos - start + 1``).

    ``pos`` must be unique and increase along an order led by ``keys``.
    Balanced by construction: rows are cut into blocks of ``block_rows``
    positions; a window inside each block finds where keys change, so a key
    that starts inside a block gets its start there. Only the first key of a
    block can have started earlier; its start comes from a two-phase
    ``min(pos)`` per key, joined to the one-row-per-block table.
    """
    key = F.struct(*[F.col(k) for k in keys])
    blk = F.floor(F.col(pos) / F.lit(block_rows)).cast("long")
    in_block = Window.partitionBy("_tp_gblk").orderBy(pos)
    t = df.withColumn("_tp_gblk", blk).withColumn("_tp_gkey", key)
    prev_key = F.lag("_tp_gkey").over(in_block)
    t = t.withColumn("_tp_gmark", F.when(prev_key.isNull() | (prev_key != F.col("_tp_gkey")),
                                         F.col(pos)))
    t = t.withColumn("_tp_glocal", F.last("_tp_gmark", ignorenulls=True).over(
        in_block.rowsBetween(Window.unboundedPreceding, 0)))
    starts = df.groupBy(key.alias("_tp_gkey")).agg(F.min(pos).alias("_tp_gstart"))
    firsts = (t.groupBy("_tp_gblk").agg(F.min_by("_tp_gkey", F.col(pos)).alias("_tp_gkey"))
              .join(starts, "_tp_gkey")
              .select("_tp_gblk", F.col("_tp_gkey").alias("_tp_gfirst"), "_tp_gstart"))
    out = t.join(firsts, "_tp_gblk")
    start = F.when(F.col("_tp_gkey") == F.col("_tp_gfirst"), F.col("_tp_gstart")).otherwise(
        F.col("_tp_glocal"))
    return out.withColumn(name, start).drop("_tp_gblk", "_tp_gkey", "_tp_gmark", "_tp_glocal",
                                            "_tp_gfirst", "_tp_gstart")


def fill_forward(df: DataFrame, keys: Sequence[str], pos: str, value: str,
                 name: str, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """``name`` = last non-null ``value`` at or before ``pos`` within the same key.

    Same as ``last(value, true) OVER (PARTITION BY keys ORDER BY pos ROWS
    UNBOUNDED PRECEDING)``, as a scan in levels. ``pos`` must be unique
    within each key (gaps allowed).
    """
    return scan(df, keys, pos, {name: Recurrence(reset=F.col(value))}, (block_rows, SIZES[1]))


def with_row_number(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column],
                    name: str = "rn") -> DataFrame:
    """0-based position of each row within its key, in ``order_by`` order.

    ``row_number() OVER (PARTITION BY keys ORDER BY order_by) - 1`` without
    putting a key's rows in one task. Also keeps the global ordinal ``pos``.
    """
    o = with_ordinal(df, [*keys, *order_by], "pos")
    s = with_group_start(o, keys, "pos", "_tp_start")
    return s.withColumn(name, F.col("pos") - F.col("_tp_start")).drop("_tp_start")


def attach_by_key(rows: DataFrame, keys: Sequence[str], pos: str, values: DataFrame,
                  block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Join one-row-per-key ``values`` onto ``rows`` without a join on the key alone.

    ``pos`` must be unique and increase along an order led by ``keys`` (each
    key's rows contiguous). Rows are cut into blocks of ``block_rows``
    positions; the (block, key) pairs present (at most blocks + keys of them,
    since keys are contiguous) pick up their values, and rows join the pairs
    on (block, key): every join group holds at most ``block_rows`` rows, so
    a hot key is spread over its blocks.
    """
    blk = F.floor(F.col(pos) / F.lit(block_rows)).cast("long").alias("_tp_ablk")
    tagged = rows.withColumn("_tp_ablk", blk)
    pairs = join_null_safe(tagged.select("_tp_ablk", *keys).distinct(), values, list(keys))
    return join_null_safe(tagged, pairs, ["_tp_ablk", *keys]).drop("_tp_ablk")


def zip_by_position(left: DataFrame, right: DataFrame, left_order: Sequence[str | Column],
                    right_order: Sequence[str | Column], name: str = "position") -> DataFrame:
    """Two frames side by side: row i of the one, in its order, with row i of the other.

    Each frame is numbered by itself; positions are unique, so the join has
    one row a position and no key to be hot. Frames of different lengths
    raise. Columns must have different names.
    """
    a, b = with_ordinal(left, left_order, name), with_ordinal(right, right_order, name)
    n, m = a.count(), b.count()  # of the stored frames
    if n != m:
        raise ValueError(f"cannot zip {n} rows with {m}")
    return a.join(b, name)
