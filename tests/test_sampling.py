from pyspark.sql import functions as F

from tidepool.functions.scalar import md5_unit
from tidepool.operators import sampling as X


def test_shards_padded(spark):
    df = spark.range(10).withColumnRenamed("id", "i")
    s = X.assign_shards(df, "i", 4, shuffle=False).collect()
    by_rank = {}
    for r in s:
        by_rank.setdefault(r["rank"], []).append((r["pos_in_shard"], r["i"]))
    got = {k: [i for _, i in sorted(v)] for k, v in by_rank.items()}
    assert got == {0: [0, 4, 8], 1: [1, 5, 9], 2: [2, 6, 0], 3: [3, 7, 1]}


def test_shuffle_is_a_permutation(spark):
    df = spark.range(100).withColumnRenamed("id", "i")
    got = X.shuffle_positions(df, "i", seed=0).collect()
    assert sorted(r["perm_pos"] for r in got) == list(range(100))
    assert [r["i"] for r in sorted(got, key=lambda r: r["perm_pos"])] != list(range(100))


def test_zipf_law(spark):
    cdf = X.zipf_cdf()
    assert len(cdf) == 179 and cdf[-1] == 1.0
    probs = [cdf[0]] + [b - a for a, b in zip(cdf, cdf[1:])]
    mean = sum((21 + i) * p for i, p in enumerate(probs))
    assert round(mean, 3) == 69.575
    lens = spark.range(20000).select(md5_unit("1", "id").alias("u")).select(X.zipf_length("u").alias("n"))
    stats = lens.agg(F.min("n"), F.max("n"), F.avg("n")).first()
    assert stats[0] >= 21 and stats[1] <= 199 and abs(stats[2] - 69.575) < 2.0


def test_word_window(spark):
    df = spark.createDataFrame([("a b c d",)], "t string").select(X.words("t").alias("w"))
    starts = set()
    for u in [0.0, 0.3, 0.49, 0.5, 0.99]:
        start, text = X.word_window("w", F.lit(3), F.lit(u))
        r = df.select(start.alias("s"), text.alias("x")).first()
        starts.add(r.s)
        assert r.x == ["a b c", "b c d"][r.s]
    assert starts == {0, 1}
    empty = spark.createDataFrame([("",), ("\n x  y\t",)], "t string").select(X.words("t").alias("w"))
    assert [r.w for r in empty.collect()] == [[], ["x", "y"]]


def test_short_list_is_repeated_for_many_ranks(spark):
    df = spark.range(1).withColumnRenamed("id", "i")
    got = sorted((r["rank"], r["pos_in_shard"], r["i"]) for r in X.assign_shards(df, "i", 4).collect())
    assert got == [(0, 0, 0), (1, 0, 0), (2, 0, 0), (3, 0, 0)]
    three = spark.range(3).withColumnRenamed("id", "i")
    got = sorted((r["rank"], r["pos_in_shard"], r["i"]) for r in X.assign_shards(three, "i", 7, shuffle=False).collect())
    assert got == [(k, 0, k % 3) for k in range(7)]
    assert X.assign_shards(three.limit(0), "i", 4).collect() == []


def test_words_part_at_every_blank(spark):
    df = spark.createDataFrame([("a\u00a0b\x0cc d\x0b",)], "t string").select(X.words("t").alias("w"))
    assert df.first().w == ["a", "b", "c", "d"]
