import hashlib
import math
import random

import numpy as np
import pytest

from tidepool.llm.centroids import Tournament, cluster_vectors, digits


def brute(rows, k=16, rounds=3, dims=64, scale=64):
    """Plain Python integers, all distances to all centroids."""
    kept = [(key, [math.floor(scale * float(v)) for v in x]) for key, x in rows
            if x is not None and len(x) == dims and all(v is not None and math.isfinite(v) for v in x)]
    named = sorted((hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest(), x) for key, x in kept)
    centroids = [x for _, x in named[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(nearest(x)[1], []).append(x)
        centroids = [[sum(v) // len(groups[i]) for v in zip(*groups[i], strict=True)] if i in groups else c
                     for i, c in enumerate(centroids)]
    found = [(key, *nearest(x)) for key, x in kept]
    inertia = {}
    for _, d, c in found:
        inertia[c] = inertia.get(c, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((key, c, d, inertia[c], sum(inertia.values()), digest[c]) for key, d, c in found), key=repr)


def result(df, id_col="vec_id"):
    return sorted(((r[id_col], r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect()), key=repr)


def vectors(n, seed, dims=64, spread=1.0):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, spread) + i % 5 for _ in range(dims)]) for i in range(n)]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_equals_brute_force(spark, kind):
    rows = [(i, [float(np.float32(v)) for v in x]) for i, x in vectors(300, 1)]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(5)
    assert result(cluster_vectors(df)) == brute(rows)


def test_left_out_vectors_and_ties(spark):
    rng = random.Random(2)
    few = [[float(rng.randint(-1, 1)) for _ in range(64)] for _ in range(6)]
    rows = [(i, few[i % 6]) for i in range(120)]  # repeated vectors: centroids are equal, empty clusters stay
    odd = [(200, None), (201, []), (202, [1.0] * 63), (203, [1.0] * 65), (204, [1.0] * 63 + [None]),
           (205, [1.0] * 63 + [float("nan")]), (206, [1.0] * 63 + [float("inf")]), (None, [0.5] * 64), (7, [0.25] * 64), (7, [0.5] * 64)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").repartition(3)
    assert result(cluster_vectors(df)) == brute(rows + odd)


@pytest.mark.parametrize("spread", [1e9, 1e16, 1e30])
def test_large_components_stay_exact(spark, spread):
    rows = vectors(40, 3, dims=4, spread=spread)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
    want = brute(rows, k=3, dims=4)
    got = result(cluster_vectors(df, k=3, dims=4))
    assert [(g[0], g[1], g[5]) for g in got] == [(w[0], w[1], w[5]) for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[2:5] == tuple(v if v < 1 << 63 else None for v in w[2:5]) or spread > 1e8


def test_few_vectors_empty_table_and_clashing_names(spark):
    rows = vectors(5, 4)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, cluster int, id string")
    assert result(cluster_vectors(df)) == brute(rows)
    named = df.select("vec_id", "embedding").toDF("x", "distance")
    assert result(cluster_vectors(named, "x", "distance"), "x") == brute(rows)
    none = cluster_vectors(df.where("vec_id < 0"))
    assert none.count() == 0
    assert none.columns == cluster_vectors(df).columns
    assert cluster_vectors(df.where("vec_id < 0").repartition(3).select("vec_id", "embedding")).count() == 0


def test_hash_ties_at_the_last_centroid(spark):
    rows = [(1, [float(v)] * 64) for v in range(40, 0, -1)]  # one id: all hashes are equal
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)
    assert result(cluster_vectors(df)) == brute(rows)


def test_tournament_favours_the_smaller_number():
    planes = Tournament([[0, 0], [2, 0], [0, 0], [2, 0], [1, 5]])
    x = np.array([[1, 0], [2, 0], [0, 0], [1, 5]])
    assert planes.winners(x).tolist() == [0, 1, 0, 4]
    big = (np.array(x, object) + 10**30)
    assert Tournament([[10**30, 10**30], [10**30 + 2, 10**30]]).winners(big).tolist() == [0, 1, 0, 0]


def test_digits_add_up():
    for v in (0, 1, -1, 1 << 39, -(1 << 40), 3**100, -(5**90)):
        assert sum(d << 40 * i for i, d in enumerate(digits(v))) == v
