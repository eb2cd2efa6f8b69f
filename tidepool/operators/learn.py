"""Vector preprocessing, evaluation and synchronous data-parallel SGD."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# Per-channel mean and std of the image data, on the 0-255
# scale, divided by 255 before use.
CHANNEL_MEAN_255 = (125.3, 123.0, 113.9)
CHANNEL_STD_255 = (63.0, 62.1, 66.7)


def normalise_channels(arr: Column, mean=CHANNEL_MEAN_255, std=CHANNEL_STD_255,
                       plane: int = 1) -> Column:
    """(x - mean[c]) / std[c] element-wise, channel c = (index div plane) mod len(mean).

    ``plane`` is the number of values a channel holds in a row: 1 for
    interleaved channels, height x width for channel-major images.
    """
    k = len(mean)
    m = F.array(*[F.lit(v / 255.0) for v in mean])
    s = F.array(*[F.lit(v / 255.0) for v in std])

    def scaled(x: Column, i: Column) -> Column:
        channel = F.pmod(F.floor(i / F.lit(plane)).cast("int"), F.lit(k)) + 1
        return (x - F.element_at(m, channel)) / F.element_at(s, channel)

    return F.transform(arr, scaled)


# Optimiser settings of the reference's training runs.
LEARNING_RATE = 0.1
MOMENTUM = 0.9
WEIGHT_DECAY = 0.0001


def shard_gradients(rows: DataFrame, weights, shard: str = "shard", label: str = "label",
                    vec: str = "embedding") -> DataFrame:
    """Mean cross-entropy gradient of a linear softmax classifier, averaged over shards.

    Each shard's gradient is the mean over its rows; the result is the mean
    of those shard means (a short shard weighs as much as a full one), as
    when every worker averages its own batch and the gradients are then
    averaged across workers. Partial sums are computed per partition with
    NumPy (``mapInPandas``), then reduced by Spark in two phases. Returns
    (cls, dim, grad).
    """
    w = np.asarray(weights, dtype=np.float64)
    k, d = w.shape

    def partial(batches):
        acc: dict[int, list] = {}
        for pdf in batches:
            if pdf.empty:
                continue
            x = np.stack(pdf[vec].to_numpy()).astype(np.float64)
            y = pdf[label].to_numpy().astype(np.int64)
            z = x @ w.T
            z -= z.max(axis=1, keepdims=True)
            p = np.exp(z)
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(y)), y] -= 1.0
            shards = pdf[shard].to_numpy()
            for s in np.unique(shards):
                m = shards == s
                g = p[m].T @ x[m]
                if s in acc:
                    acc[s][0] += g
                    acc[s][1] += int(m.sum())
                else:
                    acc[s] = [g, int(m.sum())]
        for s, (g, n) in acc.items():
            yield pd.DataFrame({shard: np.full(k * d, s, dtype=np.int64),
                                "cls": np.repeat(np.arange(k, dtype=np.int32), d),
                                "dim": np.tile(np.arange(d, dtype=np.int32), k),
                                "gsum": g.ravel(), "n": np.full(k * d, n, dtype=np.int64)})

    schema = f"{shard} long, cls int, dim int, gsum double, n long"
    parts = rows.select(shard, label, vec).mapInPandas(partial, schema)
    per_shard = parts.groupBy(shard, "cls", "dim").agg(
        (F.sum("gsum") / F.sum("n")).alias("g"))
    return per_shard.groupBy("cls", "dim").agg(F.avg("g").alias("grad"))


def collect_matrix(long_df: DataFrame, value: str, k: int, d: int) -> np.ndarray:
    """(cls, dim, value) rows → k×d array. Size is the model's, not the data's."""
    out = np.zeros((k, d))
    for r in long_df.collect():
        out[r["cls"], r["dim"]] = r[value]
    return out


def by_step(rows: DataFrame, step_col: str = "step") -> DataFrame:
    """Rows stored once in folders by step, so that each step scans only its own."""
    spark = rows.sparkSession
    path = scratch_path(spark, "sgd_steps")
    rows.write.partitionBy(step_col).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def softmax_sgd(rows: DataFrame, steps: int, classes: int, dims: int, step_col: str = "step",
                lr: float = LEARNING_RATE, momentum: float = MOMENTUM,
                weight_decay: float = WEIGHT_DECAY, shard: str = "shard",
                label: str = "label", vec: str = "embedding"):
    """Synchronous data-parallel SGD with momentum and weight decay, one Spark job per step.

    Step t uses rows with ``step_col == t`` (stored by step, a step reads its
    own part, see ``by_step``). Update (first step: buf = g):
    g += wd·w; buf = momentum·buf + g; w -= lr·buf. Only the weights
    (classes × dims) live on the driver. Returns the final weight matrix.
    """
    w = np.zeros((classes, dims))
    buf = None
    for t in range(steps):
        g = collect_matrix(shard_gradients(rows.where(F.col(step_col) == t), w, shard, label, vec),
                           "grad", classes, dims)
        g = g + weight_decay * w
        buf = g if buf is None else momentum * buf + g
        w = w - lr * buf
    return w


def score_rows(rows: DataFrame, weights, label: str = "label", vec: str = "embedding",
               keep: tuple[str, ...] = ()) -> DataFrame:
    """Linear class scores of whole vectors: ``keep``, ``hit`` (arg-max is the label), ``loss``.

    The vectors do not leave the task that reads them: later steps only see
    two narrow columns.
    """
    w = np.asarray(weights, dtype=np.float64)

    def score(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            z = np.stack(pdf[vec].to_numpy()).astype(np.float64) @ w.T
            y = pdf[label].to_numpy().astype(np.int64)
            top = z.max(axis=1)
            out = pdf[list(keep)].copy()
            out["hit"] = (z.argmax(axis=1) == y).astype(np.int64)
            out["loss"] = top + np.log(np.exp(z - top[:, None]).sum(axis=1)) - z[np.arange(len(y)), y]
            yield out

    fields = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep]
    return rows.select(*keep, label, vec).mapInPandas(score, ", ".join([*fields, "hit long", "loss double"]))


def evaluate(rows: DataFrame, weights, order: str, batch_size: int = 256, label: str = "label",
             vec: str = "embedding") -> DataFrame:
    """Arg-max accuracy and mean of batch mean losses of a linear classifier, one row.

    Batches are ``batch_size`` rows in ``order``; the last may be short.
    """
    from .ordered import with_ordinal
    from .stats import summarise_batches

    scored = with_ordinal(score_rows(rows, weights, label, vec, (order,)), [order], "_pos")
    return summarise_batches(scored.withColumn("batch", F.floor(F.col("_pos") / batch_size)), "hit", "loss", "batch")


def matrix_frame(spark: SparkSession, m: np.ndarray, value: str = "w") -> DataFrame:
    """k×d array → (cls, dim, value) frame."""
    rows = [(int(c), int(j), float(m[c, j])) for c in range(m.shape[0]) for j in range(m.shape[1])]
    return spark.createDataFrame(rows, f"cls int, dim int, {value} double")
