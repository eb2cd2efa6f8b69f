"""Hot keys: one key holding a third of the rows must not land in one task."""

from collections import defaultdict

from pyspark.sql import functions as F

from tidepool.operators import graph as G
from tidepool.operators.ordered import with_ordinal, with_row_number
from tidepool.operators.partitioning import partition_sizes


def hot_frame(spark, n=30000):
    # key 0 holds every third row
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("t"))


def test_ordinal_spreads_a_hot_key(spark):
    o = with_ordinal(hot_frame(spark), ["k", "t"], "pos", num_partitions=8)
    sizes = [r["rows"] for r in partition_sizes(o).collect()]
    assert sum(sizes) == 30000
    assert max(sizes) <= 2 * 30000 / 8          # the hot key is split across partitions
    hot_parts = o.where("k = 0").select(F.spark_partition_id()).distinct().count()
    assert hot_parts >= 2


def test_row_number_in_a_hot_key(spark):
    rn = with_row_number(hot_frame(spark), ["k"], ["t"], "rn").where("k = 0")
    got = sorted((r.t, r.rn) for r in rn.collect())
    assert [x for _, x in got] == list(range(10000))


def brute_pagerank(edges, rounds, d=0.85):
    """Literal row rule: join links with ranks, emit rank/len per listed target,
    full outer join with links (0.0 default), sum, then (1-d) + d*sum."""
    links = defaultdict(list)
    for s, t in edges:
        links[s].append(t)
    ranks = {s: 1.0 for s in links}
    for _ in range(rounds):
        contrib = defaultdict(float)
        for s, urls in links.items():
            if s in ranks:
                for u in urls:
                    contrib[u] += ranks[s] / len(urls)
        keys = set(links) | set(contrib)
        ranks = {k: (1 - d) + d * contrib.get(k, 0.0) for k in keys}
    return ranks


def test_pagerank_with_a_hub_matches_row_rule(spark):
    edges = [("h", f"t{i}") for i in range(400)]               # hub: 400 distinct targets
    edges += [(f"t{i}", f"t{(i * 7 + 1) % 400}") for i in range(400)]
    edges += [("t1", "h"), ("t1", "h"), ("x", "h")]           # multi-edge, no-in-edge source
    df = spark.createDataFrame(edges, "src string, dst string")
    got = {r.id: r.rank for r in G.pagerank(df, 5, num_partitions=8).collect()}
    want = brute_pagerank(edges, 5)
    assert set(got) == set(want)
    assert max(abs(got[k] - want[k]) for k in want) < 1e-9


def test_contributions_with_a_hub(spark):
    edges = [("h", f"t{i}") for i in range(300)] + [("h", "t0"), ("t1", "h"), ("t2", "t3")]
    df = spark.createDataFrame(edges, "src string, dst string")
    got = {(r.src, r.dst): r.contribution
           for r in G.contributions(df, G.initial_ranks(df), num_partitions=8).collect()}
    deg = defaultdict(int)
    mult = defaultdict(int)
    for s, t in edges:
        deg[s] += 1
        mult[(s, t)] += 1
    want = {k: m / deg[k[0]] for k, m in mult.items()}
    assert got.keys() == want.keys()
    assert max(abs(got[k] - want[k]) for k in want) < 1e-12
