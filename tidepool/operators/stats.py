"""Training-log and evaluation statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import argmax


def interval_loss(df: DataFrame, keys: Sequence[str], batch: str, loss: str,
                  every: int = 20) -> DataFrame:
    """Running loss printed every ``every`` batches, always divided by ``every``.

    The report at batch 0 holds one loss; the report at batch k·every holds
    batches (k-1)·every+1 … k·every; a trailing group without its reporting
    batch is never printed. Output: keys, ``batch`` (the reporting batch),
    ``loss``.
    """
    grp = F.ceil(F.col(batch) / F.lit(every)).cast("long")
    return (df.groupBy(*keys, grp.alias("_grp"))
            .agg(F.sum(loss).alias("_sum"), F.max(batch).alias("_last"))
            .where(F.col("_last") == F.col("_grp") * every)
            .select(*keys, F.col("_last").alias(batch),
                    (F.col("_sum") / F.lit(float(every))).alias(loss)))


def window_stats(df: DataFrame, keys: Sequence[str], index: str, value: str,
                 first: int = 1, last: int = 39) -> DataFrame:
    """Mean and population std of ``value`` over rows with ``first <= index <= last``.

    The reference keeps the first 40 step times and drops the first (warm-up):
    positions 1…39. Population std (ddof 0), as numpy's default.
    """
    kept = df.where((F.col(index) >= first) & (F.col(index) <= last))
    return kept.groupBy(*keys).agg(F.avg(value).alias("mean"),
                                   F.stddev_pop(value).alias("std"),
                                   F.count(F.lit(1)).alias("n"))


def mean_of_means(df: DataFrame, outer: Sequence[str], inner: Sequence[str],
                  value: str, name: str = "mean") -> DataFrame:
    """Mean over ``inner`` groups of each group's mean: a short group weighs as much as a full one."""
    first = df.groupBy(*outer, *inner).agg(F.avg(value).alias("_m"))
    return first.groupBy(*outer).agg(F.avg("_m").alias(name))


def cross_entropy(scores: Column, label: Column) -> Column:
    """-log softmax(scores)[label] with the max subtracted for stability."""
    m = F.array_max(scores)
    lse = m + F.log(F.aggregate(scores, F.lit(0.0), lambda acc, x: acc + F.exp(x - m)))
    return lse - F.element_at(scores, label + 1)


def classifier_summary(df: DataFrame, scores: str, label: str, batch: str) -> DataFrame:
    """Arg-max accuracy and mean of per-batch mean cross-entropy, one row.

    Columns: correct, total, accuracy_pct (0 decimals), avg_loss.
    """
    s = F.col(scores)
    scored = df.select(F.col(batch), (argmax(s) == F.col(label)).cast("long").alias("_ok"),
                       cross_entropy(s, F.col(label)).alias("_loss"))
    return summarise_batches(scored, "_ok", "_loss", batch)


def summarise_batches(scored: DataFrame, hit: str, loss: str, batch: str) -> DataFrame:
    """Accuracy over all rows and mean of per-batch mean losses, one row."""
    per_batch = scored.groupBy(batch).agg(F.sum(hit).alias("_ok"),
                                          F.count(F.lit(1)).alias("_n"),
                                          F.avg(loss).alias("_loss"))
    return per_batch.agg(F.sum("_ok").alias("correct"), F.sum("_n").alias("total"),
                         F.avg("_loss").alias("avg_loss")).select(
        "correct", "total",
        F.round(F.lit(100.0) * F.col("correct") / F.col("total"), 0).alias("accuracy_pct"),
        "avg_loss")
