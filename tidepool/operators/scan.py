"""Recurrences over ordered rows, as associative scans in levels.

A recurrence takes the state before a row to the state after it:

    state = reset                 where the row has one (it is not null)
    state = state before + add    elsewhere

Running sums (``add`` alone), the last value seen (``reset`` alone) and
counters or parities that start over at some rows (both) are of this form,
and so is any run of rows: it either ends in a known state or adds a known
amount. So rows are cut into blocks of positions; each block becomes one row
of the same form, the blocks are scanned likewise in larger blocks, and every
block then runs from its true start. Nothing is ordered in one task but
blocks of a fixed number of rows: with ``SIZES`` a key of 2^63 positions has
2^27 rows on the last level.

Rows of a key need not be neighbours: blocks are of (position block, key).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

# Rows of a block, blocks of a block of blocks. A key's blocks are one window
# where all blocks together are no more than the second number.
SIZES = (1 << 16, 1 << 20)

# Block tables of up to so many rows are sent to every task.
BROADCAST_ROWS = 1 << 16

_BLK = "_tp_sblk"
_KEY = "_tp_skey"


@dataclass(frozen=True)
class Recurrence:
    """``reset`` and ``add`` of each row, the state before a key's first row, and which state to return.

    Without ``add`` states may be of any type. ``before`` asks for the state
    before the row instead of that after it.
    """

    reset: Column | None = None
    add: Column | None = None
    start: Column | None = None
    before: bool = False


def _block_summary(rows: DataFrame, by: list[str], pos: str, states: list[Recurrence]) -> DataFrame:
    """One row per block: the state that it ends in, if known, and what it adds otherwise."""
    out = []
    for i, s in enumerate(states):
        at = F.when(F.col(f"_r{i}").isNotNull(), F.col(pos)) if s.reset is not None else None
        if s.add is None:
            out.append(F.max_by(f"_r{i}", at).alias(f"_r{i}"))
            continue
        total = F.sum(f"_a{i}")
        out.append(total.alias(f"_a{i}"))
        if s.reset is not None:
            last = F.max_by(F.struct(F.col(f"_r{i}").alias("r"), F.col(f"_n{i}").alias("n")), at)
            out.append((last["r"] + total - last["n"]).alias(f"_r{i}"))
    return rows.groupBy(*by).agg(*out)


def _states_before(rows: DataFrame, pos: str, states: list[Recurrence], sizes: Sequence[int], level: int = 0) -> DataFrame:
    """Adds ``_b{i}``, the state before each row; rows have ``_key``, ``pos``, ``_r{i}`` and ``_a{i}``.

    Without ``sizes`` the rows of a key are one window.
    """
    blk = f"{_BLK}{level}"
    by = [blk, _KEY] if sizes else [_KEY]
    window = Window.partitionBy(*by).orderBy(pos)
    sums = [F.sum(f"_a{i}").over(window.rowsBetween(Window.unboundedPreceding, 0)).alias(f"_n{i}")
            for i, s in enumerate(states) if s.add is not None]
    here = rows.select("*", *sums)
    carry = [s.start if s.start is not None else F.lit(0 if s.add is not None else None) for s in states]
    if sizes:
        # A row a block, stored: rows above it are planned once for it and once for their result.
        blocks = materialize(_block_summary(here, by, pos, states))
        n, rest = blocks.count(), sizes[1:]
        if not rest or n <= sizes[1]:
            rest = ()
        else:
            blocks = blocks.withColumn(f"{_BLK}{level + 1}", F.expr(f"`{blk}` div {sizes[1]}L"))
        blocks = _states_before(blocks, blk, states, rest, level + 1)
        blocks = blocks.select(*by, *[F.col(f"_b{i}").alias(f"_c{i}") for i in range(len(states))])
        here = here.join(F.broadcast(blocks) if n <= BROADCAST_ROWS else blocks, by)
        carry = [F.col(f"_c{i}") for i in range(len(states))]
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    found = []
    for i, s in enumerate(states):
        if s.add is None:
            state = F.coalesce(F.last(f"_r{i}", ignorenulls=True).over(earlier), carry[i])
        else:
            so_far = F.col(f"_n{i}") - F.col(f"_a{i}")
            state = carry[i] + so_far
            if s.reset is not None:
                mark = F.when(F.col(f"_r{i}").isNotNull(), F.struct(F.col(f"_r{i}").alias("r"), F.col(f"_n{i}").alias("n")))
                last = F.last(mark, ignorenulls=True).over(earlier)
                state = F.when(last.isNotNull(), last["r"] + so_far - last["n"]).otherwise(state)
        found.append(state.alias(f"_b{i}"))
    gone = {f"_{x}{i}" for i in range(len(states)) for x in "nc"}
    return here.select(*[c for c in here.columns if c not in gone], *found)


def scan(df: DataFrame, keys: Sequence[str], pos: str, states: dict[str, Recurrence],
         sizes: Sequence[int] = SIZES, chain: bool = False) -> DataFrame:
    """Add a column for each of ``states``: the recurrence over the rows of each key in order of ``pos``.

    ``pos`` must be a number from 0 on, unique within each key (gaps are
    fine). Null keys equal each other. Rows are exchanged once, by block and
    key; the table of blocks, one row each, is stored. With ``chain`` the
    block columns stay, and a later ``scan`` of the result (by the same keys,
    position and sizes) does not exchange the rows again. The last ``scan``
    of a chain drops them.
    """
    names, specs = list(states), list(states.values())
    rows = df
    if _KEY not in df.columns:
        rows = rows.withColumn(_KEY, F.struct(*[F.col(k) for k in keys]))
        rows = rows.withColumn(f"{_BLK}0", F.expr(f"`{pos}` div {sizes[0]}L"))
    inputs = []
    for i, s in enumerate(specs):
        if s.reset is not None:
            inputs.append(s.reset.alias(f"_r{i}"))
        if s.add is not None:
            inputs.append(F.coalesce(s.add, F.lit(0)).cast("long").alias(f"_a{i}"))
    rows = rows.select("*", *inputs)
    out = _states_before(rows, pos, specs, sizes)
    found = []
    for i, (name, s) in enumerate(zip(names, specs, strict=True)):
        state = F.col(f"_b{i}")
        if not s.before:
            after = state + F.col(f"_a{i}") if s.add is not None else state
            state = F.coalesce(F.col(f"_r{i}"), after) if s.reset is not None else after
        found.append(state.alias(name))
    left = [c for c in df.columns if chain or not c.startswith((_KEY, _BLK))]
    if chain and _KEY not in df.columns:
        left += [_KEY, f"{_BLK}0"]
    return out.select(*[c for c in left if c not in names], *found)
