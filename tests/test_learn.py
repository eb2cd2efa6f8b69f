import numpy as np
from pyspark.sql import functions as F

from tidepool.operators import learn as T


def _data(spark, n=37, d=5, k=3, shards=4):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, d)).astype(np.float32)
    y = rng.integers(0, k, size=n)
    rows = [(int(i % shards), int(y[i]), [float(v) for v in x[i]], int(i // shards % 2)) for i in range(n)]
    df = spark.createDataFrame(rows, "shard long, label int, embedding array<float>, step long")
    return df, x.astype(np.float64), y


def _grad(x, y, w, shard_ids):
    out = []
    for s in sorted(set(shard_ids)):
        m = shard_ids == s
        z = x[m] @ w.T
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(m.sum()), y[m]] -= 1
        out.append(p.T @ x[m] / m.sum())
    return np.mean(out, axis=0)


def test_mean_of_shard_means(spark):
    df, x, y = _data(spark)
    w = np.random.default_rng(1).normal(size=(3, 5)) * 0.1
    g = T.collect_matrix(T.shard_gradients(df, w), "grad", 3, 5)
    shard_ids = np.arange(len(y)) % 4
    assert np.allclose(g, _grad(x, y, w, shard_ids), atol=1e-12)


def test_sgd_two_steps(spark):
    df, x, y = _data(spark)
    w_got = T.softmax_sgd(df, 2, 3, 5)
    w, buf = np.zeros((3, 5)), None
    steps = (np.arange(len(y)) // 4) % 2
    shard_ids = np.arange(len(y)) % 4
    for t in range(2):
        m = steps == t
        g = _grad(x[m], y[m], w, shard_ids[m]) + 1e-4 * w
        buf = g if buf is None else 0.9 * buf + g
        w = w - 0.1 * buf
    assert np.allclose(w_got, w, atol=1e-12)


def test_normalise_channels(spark):
    df = spark.createDataFrame([([125.3 / 255, 123.0 / 255, 113.9 / 255, 1.0],)], "v array<double>")
    got = df.select(T.normalise_channels(F.col("v")).alias("n")).first()["n"]
    assert [round(v, 9) for v in got[:3]] == [0.0, 0.0, 0.0]
    assert abs(got[3] - (1.0 - 125.3 / 255) / (63.0 / 255)) < 1e-12


def test_channel_major_layout(spark):
    v = [125.3 / 255] * 4 + [123.0 / 255] * 4 + [113.9 / 255] * 4
    got = spark.createDataFrame([(v,)], "v array<double>").select(
        T.normalise_channels(F.col("v"), plane=4).alias("n")).first()["n"]
    assert [round(x, 9) for x in got] == [0.0] * 12


def test_evaluate_scores_whole_vectors(spark):
    rng = np.random.default_rng(4)
    x, y, w = rng.normal(size=(53, 7)), rng.integers(0, 3, 53), rng.normal(size=(3, 7))
    df = spark.createDataFrame([(i, int(y[i]), x[i].tolist()) for i in range(53)],
                               "i long, label int, embedding array<double>").repartition(3)
    r = T.evaluate(df, w, "i", batch_size=10).first()
    z = x @ w.T
    loss = np.log(np.exp(z).sum(1)) - z[np.arange(53), y]
    assert (r.correct, r.total) == (int((z.argmax(1) == y).sum()), 53)
    assert np.isclose(r.avg_loss, np.mean([loss[k:k + 10].mean() for k in range(0, 53, 10)]))


def test_steps_are_stored_apart(spark):
    df, _, _ = _data(spark)
    stored = T.by_step(df)
    plan = stored.where("step = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(step" in plan
    assert stored.count() == 37 and len({f.split("step=")[1][0] for f in stored.inputFiles()}) == 2
