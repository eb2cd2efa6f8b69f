"""Serving-run and kernel-time analytics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import col, trunc_int


def parallelism_label(tp: str | Column, pp: str | Column) -> Column:
    """``"(tp, pp)"``."""
    return F.format_string("(%d, %d)", col(tp), col(pp))


# The class labels TP, PP, Baseline and ``TP + PP``.
def parallelism_class(tp: str | Column, pp: str | Column) -> Column:
    """In order: tp > pp → TP; pp > tp → PP; both 1 → Baseline; else ``TP + PP``."""
    t, p = col(tp), col(pp)
    return (F.when(t > p, "TP").when(p > t, "PP")
            .when((t == 1) & (p == 1), "Baseline").otherwise("TP + PP"))


def class_by_label(label: str | Column) -> Column:
    """``(1, 4)`` → PP, ``(4, 1)`` → TP, ``(1, 1)`` → Baseline, anything else ``TP + PP``."""
    lab = col(label)
    return (F.when(lab == "(1, 4)", "PP").when(lab == "(4, 1)", "TP")
            .when(lab == "(1, 1)", "Baseline").otherwise("TP + PP"))


# Latency divisors by batch size (batch 1 → 64, 16 → 4, 32 → 2);
# other batch sizes keep their latency.
LATENCY_DIVISORS = {1: 64.0, 16: 4.0, 32: 2.0}


def batch_adjusted_latency(latency: str | Column, batch: str | Column) -> Column:
    lat, b = col(latency), col(batch)
    expr = None
    for size, div in LATENCY_DIVISORS.items():
        expr = (F.when(b == size, lat / div) if expr is None
                else expr.when(b == size, lat / div))
    return expr.otherwise(lat)


def ms_per_token(latency: str | Column, tokens: str | Column) -> Column:
    """latency / tokens × 1e3, from the unadjusted latency."""
    return col(latency) / col(tokens) * F.lit(1e3)


def kernel_totals(time_ns: str | Column, iterations: str | Column, pct: str | Column,
                  run_length: int = 40) -> tuple[Column, Column]:
    """Scale a communication time to ``run_length`` iterations and derive the total.

    Returns (comm_ns, total_ns), both truncated towards zero like ``int()``:
    scaled = time × run_length / iterations, total = scaled × 100 / pct.
    """
    scaled = col(time_ns) * F.lit(run_length) / col(iterations)
    total = scaled * F.lit(100.0) / col(pct)
    return trunc_int(scaled), trunc_int(total)


def keep_last(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
              values: Sequence[str]) -> DataFrame:
    """Per key, the values of the row that comes last in ``order_by`` order.

    Dict-assignment semantics (later rows replace earlier ones) as a
    two-phase ``max_by`` aggregate, so a hot key is pre-reduced map-side.
    """
    order = F.struct(*[F.col(c) for c in order_by])
    picked = F.max_by(F.struct(*[F.col(v) for v in values]), order).alias("_last")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col(f"_last.{v}").alias(v)
                                                         for v in values])


def kernel_rollup(df: DataFrame, run: str, name: str, order_by: Sequence[str],
                  pct: str, time_ns: str, sep: str = "|") -> DataFrame:
    """Per run: sum of pct, sum of time, distinct kernel names joined in order of first appearance.

    Names are first reduced per (run, name), so the joined list holds one
    entry per distinct name, not one per row.
    """
    first = F.min(F.struct(*[F.col(c) for c in order_by])).alias("_first")
    per_name = df.groupBy(run, name).agg(first, F.sum(pct).alias("_pct"),
                                         F.sum(time_ns).alias("_ns"))
    names = F.array_sort(F.collect_list(F.struct(F.col("_first"), F.col(name))))
    return per_name.groupBy(run).agg(
        F.sum("_pct").alias("total_pct"), F.sum("_ns").alias("total_ns"),
        F.array_join(F.transform(names, lambda x: x[name]), sep).alias("kernels"))


def layer_stats(df: DataFrame, group: Sequence[str], layer: str, value: str) -> DataFrame:
    """Sum the components of each layer, then mean and population std over layers."""
    per_layer = df.groupBy(*group, layer).agg(F.sum(value).alias("_v"))
    return per_layer.groupBy(*group).agg(F.avg("_v").alias("mean"),
                                         F.stddev_pop("_v").alias("std"))


def stats_wide(stats: DataFrame, key: str, stage: str, stages: Sequence[str]) -> DataFrame:
    """One row per ``key``: ``<stage>`` (mean) and ``<stage>_std`` for each fixed stage.

    A stage with no rows gets 0.0, as the reference fills missing
    communication stages.
    """
    wide = stats.groupBy(key).pivot(stage, list(stages)).agg(
        F.first("mean").alias("m"), F.first("std").alias("s"))
    cols = [F.col(key)]
    for s in stages:
        cols.append(F.coalesce(F.col(f"{s}_m"), F.lit(0.0)).alias(s))
        cols.append(F.coalesce(F.col(f"{s}_s"), F.lit(0.0)).alias(f"{s}_std"))
    return wide.select(*cols)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames, columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def minutes_excluding(total_s: str | Column, part_s: str | Column) -> Column:
    """(total - part) / 60: a run's time without its output phase, in minutes."""
    return (col(total_s) - col(part_s)) / F.lit(60.0)
