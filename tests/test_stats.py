import math

import numpy as np

from tidepool.operators import stats as S


def test_interval_loss_fixture(spark):
    rows = [(0, i, float((7 * i) % 11 + 1)) for i in range(47)]
    df = spark.createDataFrame(rows, "u int, batch long, loss double")
    got = sorted((r.batch, round(r.loss, 6)) for r in S.interval_loss(df, ["u"], "batch", "loss").collect())
    assert got == [(0, 0.05), (20, 6.3), (40, 6.05)]


def test_step_timing_fixture(spark):
    df = spark.createDataFrame([(0, i, t) for i, t in enumerate([9.0, 1.0, 2.0, 3.0])],
                               "u int, idx long, t double")
    r = S.window_stats(df, ["u"], "idx", "t").first()
    assert r["mean"] == 2.0 and round(r["std"], 6) == 0.816497


def test_mean_of_means(spark):
    df = spark.createDataFrame([("g1", 1.0), ("g1", 3.0), ("g2", 5.0)], "g string, v double")
    assert S.mean_of_means(df, [], ["g"], "v").first()["mean"] == 3.5


def test_classifier_summary(spark):
    rows = [(0, [0.1, 0.9, 0.9], 1), (0, [2.0, 1.0, 0.0], 0), (1, [0.0, 0.0, 3.0], 0)]
    df = spark.createDataFrame(rows, "b long, s array<double>, y int")
    r = S.classifier_summary(df, "s", "y", "b").first()
    assert (r.correct, r.total, r.accuracy_pct) == (2, 3, 67.0)

    def ce(s, y):
        s = np.array(s)
        return math.log(np.exp(s).sum()) - s[y]
    b0 = (ce(*rows[0][1:]) + ce(*rows[1][1:])) / 2
    assert abs(r.avg_loss - (b0 + ce(*rows[2][1:])) / 2) < 1e-12
