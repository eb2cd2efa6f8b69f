import random


from tidepool.operators.ordered import fill_forward, with_next, with_ordinal, with_row_number


def test_ordinal_dense_and_sorted(spark):
    rows = [(random.Random(i).randint(0, 50), i) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, i int")
    got = with_ordinal(df, ["k", "i"], "pos", num_partitions=7).orderBy("pos").collect()
    assert [r["pos"] for r in got] == list(range(500))
    assert [(r["k"], r["i"]) for r in got] == sorted(rows)


def test_next_and_row_number(spark):
    rows = [("x", 3), ("x", 1), ("y", 5), ("x", 2), ("y", 4)]
    df = spark.createDataFrame(rows, "k string, t int")
    rn = with_row_number(df, ["k"], ["t"], "rn")
    got = {(r.k, r.t): r.rn for r in rn.collect()}
    assert got == {("x", 1): 0, ("x", 2): 1, ("x", 3): 2, ("y", 4): 0, ("y", 5): 1}
    nxt = with_next(rn, ["k"], "pos", ["t"]).collect()
    assert {(r.k, r.t): r.t_next for r in nxt} == {("x", 1): 2, ("x", 2): 3, ("x", 3): None,
                                                   ("y", 4): 5, ("y", 5): None}


def test_fill_forward_small_blocks(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(300):
        k = "hot" if i < 200 else f"k{i // 17}"
        v = rnd.randint(0, 9) if rnd.random() < 0.2 else None
        rows.append((k, i, v))
    df = spark.createDataFrame(rows, "k string, t int, v int")
    o = with_ordinal(df, ["k", "t"], "pos", num_partitions=5)
    got = {r.t: r.f for r in fill_forward(o, ["k"], "pos", "v", "f", block_rows=7).collect()}
    want, last = {}, {}
    for k, t, v in sorted(rows):
        if v is not None:
            last[k] = v
        want[t] = last.get(k)
    assert got == want


def test_group_start_small_blocks(spark):
    rnd = random.Random(11)
    keys = ["hot"] * 120 + [f"k{i // 5}" for i in range(60)] + ["tail"] * 20
    rows = [(k, i, rnd.random()) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "k string, t int, x double")
    from tidepool.operators.ordered import with_group_start
    o = with_ordinal(df, ["k", "t"], "pos", num_partitions=6)
    for block in (1, 4, 7, 1000):
        got = {r.t: r.pos - r.gs for r in with_group_start(o, ["k"], "pos", "gs", block_rows=block).collect()}
        want, seen = {}, {}
        for k, t, _ in sorted(rows):
            seen[k] = seen.get(k, -1) + 1
            want[t] = seen[k]
        assert got == want, block


def test_attach_by_key_small_blocks(spark):
    from tidepool.operators.ordered import attach_by_key

    keys = ["hot"] * 50 + ["a"] * 3 + ["b"] * 9
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, p long")
    vals = spark.createDataFrame([("hot", 1.0), ("a", 2.0), ("b", 3.0)], "k string, v double")
    for block in (1, 4, 1000):
        got = sorted((r.p, r.v) for r in attach_by_key(rows, ["k"], "p", vals, block).collect())
        assert got == [(i, {"hot": 1.0, "a": 2.0, "b": 3.0}[k]) for i, k in enumerate(keys)]


def test_neighbours_across_blocks_and_null_keys(spark):
    from tidepool.operators.ordered import with_next, with_prev
    keys = [None] * 5 + ["a"] * 7 + ["b"] + ["c"] * 9
    rows = [(i, k, i * 10) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "pos long, k string, v long").repartition(3)
    for block in (1, 3, 4, 100):
        nxt = {r.pos: r.v_next for r in with_next(df, ["k"], "pos", ["v"], block_rows=block).collect()}
        prv = {r.pos: r.v_prev for r in with_prev(df, ["k"], "pos", ["v"], block_rows=block).collect()}
        for i, k in enumerate(keys):
            assert nxt[i] == ((i + 1) * 10 if i + 1 < len(keys) and keys[i + 1] == k else None)
            assert prv[i] == ((i - 1) * 10 if i and keys[i - 1] == k else None)
        inner = with_next(df, ["k"], "pos", ["v"], how="inner", block_rows=block).count()
        assert inner == sum(a == b for a, b in zip(keys, keys[1:], strict=False))
