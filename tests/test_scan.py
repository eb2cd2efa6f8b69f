import random

import pytest
from pyspark.sql import functions as F

from tidepool.operators.scan import Recurrence, scan


def rows_of(seed, n=240):
    rng = random.Random(seed)
    keys = ["hot"] * 4 + ["a", "b", None]
    places = {}
    out = []
    for _ in range(n):
        k = rng.choice(keys)
        places[k] = places.get(k, -1) + rng.randint(1, 4)
        out.append((k, places[k], rng.randrange(10) if rng.random() < 0.2 else None, rng.randrange(-5, 5) if rng.random() < 0.9 else None))
    return out


def literal(rows, start, reset, add):
    """State before and after each row."""
    now, out = {}, {}
    for k, p, r, a in sorted(rows, key=lambda x: x[1]):
        before = now.get(k, start)
        after = before
        if add:
            after = None if before is None else before + (a or 0)
        if reset and r is not None:
            after = r
        now[k] = after
        out[k, p] = (before, after)
    return out


@pytest.mark.parametrize("sizes", [(1, 1), (3, 2), (7, 3), (1 << 16, 1 << 20)])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_the_literal_loop(spark, seed, sizes):
    rows = rows_of(seed)
    df = spark.createDataFrame(rows, "k string, p long, r long, a long").repartition(5)
    r, a = F.col("r"), F.col("a")
    kinds = {"both": (r, a, 3), "last": (r, None, None), "sum": (None, a, 0)}
    states = {}
    for name, (reset, add, start) in kinds.items():
        lit = F.lit(start).cast("long")
        states[name] = Recurrence(reset, add, lit)
        states[name + "_before"] = Recurrence(reset, add, lit, before=True)
    got = scan(df, ["k"], "p", states, sizes).collect()
    for name, (reset, add, start) in kinds.items():
        want = literal(rows, start, reset is not None, add is not None)
        assert {(x.k, x.p): (x[name + "_before"], x[name]) for x in got} == want, name


def test_a_chain_exchanges_rows_once_and_drops_its_columns(spark):
    df = spark.createDataFrame(rows_of(3), "k string, p long, r long, a long").repartition(5)
    one = scan(df, ["k"], "p", {"x": Recurrence(reset=F.col("r"))}, (4, 2), chain=True)
    two = scan(one, ["k"], "p", {"y": Recurrence(add=F.coalesce("x", F.lit(0)))}, (4, 2))
    assert two.columns == ["k", "p", "r", "a", "x", "y"]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = two._jdf.queryExecution().executedPlan().toString()
        got = {(r.k, r.p): r.y for r in two.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SinglePartition" not in plan
    last = literal(rows_of(3), None, True, False)
    want = literal([(k, p, None, last[k, p][1]) for k, p, *_ in rows_of(3)], 0, False, True)
    assert got == {at: after for at, (_, after) in want.items()}


def test_no_exchange_to_a_single_task(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id", F.col("id").alias("v"))
    plan = scan(df, ["k"], "id", {"s": Recurrence(add=F.col("v"))})._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_struct_states_and_an_empty_table(spark):
    df = spark.createDataFrame([("a", 5, 1), ("a", 2, None), ("a", 9, None)], "k string, p long, v int")
    own = F.when(F.col("v").isNotNull(), F.struct("p", "v"))
    got = {r.p: r.s for r in scan(df, ["k"], "p", {"s": Recurrence(reset=own)}).collect()}
    assert got == {2: None, 5: (5, 1), 9: (5, 1)}
    assert scan(df.where("p > 100"), ["k"], "p", {"s": Recurrence(add=F.col("v"))}).count() == 0
