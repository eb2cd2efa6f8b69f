import pathlib
import re

import pytest
from pyspark.sql import functions as F

from tidepool.operators import graph as G
from tidepool.operators.partitioning import (bucket_of, drop_table, num_partitions, partition_by_key,
                                             partition_sizes, persist_at, place_in_buckets, storage_level,
                                             table_path, write_bucketed)
from tidepool.sources.sinks import tuple_lines
from tidepool.sources.text import parse_edges, scan_edges, scan_text

TOY = "a→b a→b a→c b→c c→a d→d d→c c→e f→a"
EXPECTED = {  # FIXTURES.md, hand-worked
    1: {"a": 1.425, "b": 0.716667, "c": 1.708333, "d": 0.575, "e": 0.575, "f": 0.15},
    2: {"a": 1.003542, "b": 0.9575, "c": 1.407292, "d": 0.394375, "e": 0.876042, "f": 0.15},
    10: {"a": 0.672168, "b": 0.534769, "c": 0.912198, "d": 0.261012, "e": 0.544668, "f": 0.15},
}


def toy_edges(spark):
    pairs = [tuple(e.split("→")) for e in TOY.split()]
    return spark.createDataFrame(pairs, "src string, dst string")


@pytest.mark.parametrize("rounds", [1, 2, 10])
@pytest.mark.parametrize("parts", [2, 16])
def test_pagerank_toy(spark, rounds, parts):
    ranks = G.pagerank(toy_edges(spark), iterations=rounds, num_partitions=parts)
    got = {r["id"]: round(r["rank"], 6) for r in ranks.collect()}
    assert got == EXPECTED[rounds]


def test_pagerank_counts_and_multi_edges(spark):
    e = toy_edges(spark)
    assert G.source_count(e) == 5
    assert G.pagerank(e, 3).count() == 6
    single = e.distinct()
    r1 = {r["id"]: r["rank"] for r in G.pagerank(single, 1).collect()}
    assert round(r1["b"], 6) == 0.575  # 0.15 + 0.85 * 1/2
    zero = G.pagerank(e, 0).collect()
    assert sorted(r["id"] for r in zero) == ["a", "b", "c", "d", "f"]


def test_primitives(spark):
    e = toy_edges(spark)
    deg = {r["src"]: r["out_degree"] for r in G.out_degree(e).collect()}
    assert deg == {"a": 3, "b": 1, "c": 2, "d": 2, "f": 1}
    adj = {(r["src"], r["dst"]): r["multiplicity"] for r in G.adjacency(e).collect()}
    assert adj[("a", "b")] == 2
    assert sorted(r["id"] for r in G.vertices(e).collect()) == list("abcdef")
    tot = {r["id"]: round(r["contribution"], 6)
           for r in G.contribution_totals(e, G.initial_ranks(e)).collect()}
    assert tot["f"] == 0.0 and tot["e"] == 0.5 and tot["b"] == round(2 / 3, 6)


def test_top_and_normalise(spark):
    e = toy_edges(spark)
    top = G.top_ranks(G.normalise(G.pagerank(e, 1), 5), 2).orderBy("position").collect()
    assert [r["id"] for r in top] == ["c", "a"]
    assert round(top[0]["rank"], 6) == round(1.708333333 / 5, 6)


def test_sequence_edges_match_lead(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    got = G.edges_from_sequences(li, "l_orderkey", ["l_linenumber", "l_partkey"], "l_partkey",
                                 num_partitions=7)
    li.createOrReplaceTempView("li")
    want = spark.sql("""SELECT src, dst FROM (SELECT l_partkey AS src, lead(l_partkey) OVER
        (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS dst FROM li) WHERE dst IS NOT NULL""")
    assert sorted(got.collect()) == sorted(want.collect())


def test_parse_edges_modes(spark):
    lines = spark.createDataFrame([("# header",), ("1\t2\textra",), ("3\t4",), ("lonely",)], "value string")
    got = parse_edges(lines, mode="drop").collect()
    assert [(r.src, r.dst) for r in got] == [("1", "2"), ("3", "4")]
    with pytest.raises(Exception):
        parse_edges(lines).collect()


def test_scan_edges_file(spark, tmp_path):
    p = tmp_path / "edges.tsv"
    p.write_text("# comment\n" + "\n".join(f"{i}\t{i + 1}" for i in range(1000)) + "\n")
    e = scan_edges(spark, str(p))
    assert e.count() == 1000 and e.schema.simpleString() == "struct<src:string,dst:string>"
    assert scan_text(spark, str(p)).count() == 1001


def test_tuple_lines(spark):
    df = spark.createDataFrame([("a", 1.425)], "id string, rank double")
    assert tuple_lines(df).first()["value"] == "('a', 1.425)"
    odd = spark.createDataFrame([("it's", 1e7), ("b", 1e-9)], "id string, rank double")
    assert sorted(r["value"] for r in tuple_lines(odd).collect()) == ['("it\'s", 10000000.0)', "('b', 1e-09)"]


def test_partitioning_and_persistence(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 7)
    p = partition_by_key(df, 5, "k")
    assert num_partitions(p) == 5
    sizes = partition_sizes(p).collect()
    assert sum(r["rows"] for r in sizes) == 1000
    cached = persist_at(p, "memory_and_disk")
    assert storage_level(cached).useDisk and storage_level(cached).useMemory
    cached.unpersist()


def test_pagerank_one_exchange_per_round(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
        e = G.edges_from_sequences(li, "l_orderkey", ["l_linenumber", "l_partkey"], "l_partkey")
        ranks, _, _ = G.pagerank_plan(e, 3, checkpoint_every=0)
        plan = ranks._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"Exchange hashpartitioning", plan)) == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pagerank_checkpoint_keeps_partitioning(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
        e = G.edges_from_sequences(li, "l_orderkey", ["l_linenumber", "l_partkey"], "l_partkey")
        ranks, _, _ = G.pagerank_plan(e, 4, checkpoint_every=3)
        plan = ranks._jdf.queryExecution().executedPlan().toString()
        # round 4 reads round 3 from a checkpoint: the ranks are re-hashed once,
        # then the round's own aggregate is the only other exchange
        assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def hub_edges(spark, targets=400):
    rows = [("hub", f"v{i}") for i in range(targets)] + [(f"v{i}", "hub") for i in range(0, targets, 3)]
    rows += [(f"v{i}", f"v{(i * 7) % targets}") for i in range(targets)]
    return spark.createDataFrame(rows, "src string, dst string")


@pytest.mark.parametrize("rounds", [1, 2, 3])
def test_hub_plans_do_not_grow_with_rounds(spark, rounds):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        e = hub_edges(spark)
        assert G.hub_sources(G.source_stats(G.adjacency(e)), 4)[0] is not None
        ranks, _, tables = G.pagerank_plan(e, rounds)
        plan = ranks._jdf.queryExecution().executedPlan().toString()
        # a round: the contributions by target, and the ranks once after a checkpoint
        assert len(re.findall(r"Exchange hashpartitioning", plan)) <= 2
        assert plan.count("BroadcastExchange") <= 3
        for t in tables:
            drop_table(spark, t)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hub_ranks_equal_the_plain_rule(spark):
    e = hub_edges(spark)
    pairs = [tuple(r) for r in e.collect()]
    ids = {x for p in pairs for x in p}
    degree = {s: sum(1 for a, _ in pairs if a == s) for s in {a for a, _ in pairs}}
    want = dict.fromkeys(ids, 1.0)
    for _ in range(3):
        new = dict.fromkeys(ids, 0.15)
        for a, b in pairs:
            new[b] += 0.85 * want[a] / degree[a]
        want = new
    got = {r["id"]: r["rank"] for r in G.pagerank(e, 3, num_partitions=8).collect()}
    assert got == pytest.approx(want)


def data_files(spark, name):
    return list(pathlib.Path(table_path(spark, name).removeprefix("file:")).glob("part-*.parquet"))


def test_bucketed_tables_have_a_file_a_bucket_and_go(spark):
    df = spark.range(5000).repartition(13).withColumn("k", F.col("id") % 97)
    frame, name = write_bucketed(df, 4, "k", "test")
    assert frame.count() == 5000 and len(data_files(spark, name)) == 4
    drop_table(spark, name)
    assert data_files(spark, name) == [] and not pathlib.Path(table_path(spark, name)[5:]).exists()
    with pytest.raises(Exception):
        write_bucketed(df, 4, "no_such_column", "test")


def test_pagerank_leaves_only_its_checkpoint(spark):
    folder = pathlib.Path(table_path(spark, "x").removeprefix("file:")).parent
    before = set(folder.glob("*")) if folder.exists() else set()
    G.pagerank(toy_edges(spark), 2).count()
    assert set(folder.glob("*")) == before


def test_own_partition_function(spark):
    ints = spark.createDataFrame([(7,), (-1,), (None,)], "k long")
    assert [r.b for r in ints.select(bucket_of(ints, "k", 5).alias("b")).collect()] == [2, 4, 0]
    text = spark.createDataFrame([(f"n{i}",) for i in range(200)] + [(None,)], "k string")
    placed = place_in_buckets(text.withColumn("b", bucket_of(text, "k", 6)), "b", 6)
    rows = placed.withColumn("p", F.spark_partition_id()).collect()
    assert all(r.b == r.p for r in rows) and {r.b for r in rows} == set(range(6))


def test_prepartitioned_join_moves_nothing(spark):
    from tidepool.plans.graph_plans import prepartitioned_join
    pairs = G.adjacency(toy_edges(spark))
    joined, tables = prepartitioned_join(spark, pairs)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert {(r.src, r.dst): r.multiplicity / r.degree for r in joined.collect()}[("a", "b")] == 2 / 3
    for t in tables:
        drop_table(spark, t)
