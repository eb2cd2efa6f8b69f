"""Graph primitives and PageRank on edge tables (src, dst).

Ids may be strings (as in text edge lists) or integers; nothing here
casts them. An edge table keeps multi-edges: they count towards the
out-degree and give a larger share of the source's rank.

PageRank plan, per round (see ``pagerank``):

    contrib = weights ⋈ ranks (src = id)  -> partial sum by dst -> exchange -> sum
    ranks   = vertices ⟕ contrib (id = dst) -> (1-d) + d * coalesce(contrib, 0)

``weights`` (one row per distinct (src, dst) with share m/deg) and
``vertices`` are written once as tables bucketed by src and id with the same
partition count, so the join with ranks needs no exchange and the left join
with the aggregate needs none either: one exchange per round, plus one of
the vertex-sized ranks after each lineage cut (every round with hubs).
Sources with more distinct targets than an average partition holds
("hubs", at most one per partition by construction) are kept apart: their
edges stay spread out and meet their ranks through a broadcast of at most
``num_partitions`` rows, so a hub never lands in one task.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..session import materialize
from .ordered import with_next, with_ordinal, with_row_number
from .partitioning import drop_table, write_bucketed


def edges_from_sequences(df: DataFrame, group: str, order_by: list[str], node: str,
                         num_partitions: int | None = None) -> DataFrame:
    """Edges node -> next node within each ``group`` in ``order_by`` order.

    Same as ``lead(node) OVER (PARTITION BY group ORDER BY order_by)`` with
    the last row of each group dropped, but built from a global ordinal and
    an equi-join on position, so a group with a third of all rows is still
    spread over every task.
    """
    keep = list(dict.fromkeys([group, *order_by, node]))
    o = with_ordinal(df.select(*keep), [group, *order_by], "pos", num_partitions)
    paired = with_next(o, [group], "pos", [node], suffix="_next", how="inner")
    return paired.select(F.col(node).alias("src"), F.col(node + "_next").alias("dst"))


def vertices(edges: DataFrame) -> DataFrame:
    """Distinct endpoints of all edges (sources and targets)."""
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def out_degree(edges: DataFrame) -> DataFrame:
    """Out-degree per source, multi-edges counted."""
    return edges.groupBy("src").agg(F.count(F.lit(1)).alias("out_degree"))


def adjacency(edges: DataFrame) -> DataFrame:
    """Adjacency in long form: one row per (src, dst) with its multiplicity.

    This is the bounded form of "all targets per source, duplicates kept":
    a hub's list is spread over rows instead of held in one array value.
    """
    return edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("multiplicity"))


# Targets of a source that one row holds.
LIST_LENGTH = 64


def adjacency_lists(edges: DataFrame, length: int = LIST_LENGTH) -> DataFrame:
    """All targets per source, duplicates kept, as ``src, chunk, targets`` with at most ``length`` targets a row.

    Targets are in order, over the chunks 0, 1, ... of a source too. A hub's
    list is cut by positions in a global sort, so it is spread over tasks and
    no array grows with the input.
    """
    numbered = with_row_number(edges, ["src"], ["dst"], "_rn")
    chunk = F.expr(f"_rn div {length}").alias("chunk")
    return numbered.groupBy("src", chunk).agg(F.array_sort(F.collect_list("dst")).alias("targets"))


def source_stats(pairs: DataFrame) -> DataFrame:
    """Per source: out-degree (multi-edges counted) and number of distinct targets."""
    return pairs.groupBy("src").agg(F.sum("multiplicity").alias("_deg"),
                                    F.count(F.lit(1)).alias("_fan"))


def hub_sources(stats: DataFrame, n: int):
    """Sources with more distinct targets than an average partition holds.

    At most ``n`` sources can each hold more than (pairs / n) targets, so
    the returned frame (column ``id``) is bounded by the partition count.
    Returns (hubs or None, number of pairs, number of sources).
    """
    n_pairs, max_fan, n_sources = stats.agg(F.sum("_fan"), F.max("_fan"),
                                            F.count(F.lit(1))).first()
    n_pairs, max_fan = n_pairs or 0, max_fan or 0
    threshold = max(1, -(-n_pairs // n))
    if max_fan <= threshold:
        return None, n_pairs, n_sources or 0
    ids = [r[0] for r in stats.where(F.col("_fan") > threshold).select("src").collect()]
    schema = StructType([StructField("id", stats.schema["src"].dataType)])
    return stats.sparkSession.createDataFrame([(i,) for i in ids], schema), n_pairs, n_sources


def split_weights(pairs: DataFrame, stats: DataFrame,
                  hubs: DataFrame | None) -> tuple[DataFrame | None, DataFrame]:
    """(src, dst, multiplicity, weight = multiplicity / out-degree) of hub pairs and of all others.

    Hub pairs meet their degree through a broadcast of the hubs' stats (at
    most one row per partition); every other source holds at most an
    average partition's worth of pairs, so the plain join is balanced.
    """
    def shares(joined: DataFrame) -> DataFrame:
        return joined.select("src", "dst", "multiplicity",
                             (F.col("multiplicity") / F.col("_deg")).alias("weight"))

    if hubs is None:
        return None, shares(pairs.join(stats, "src"))
    hub_stats = stats.join(F.broadcast(hubs), stats.src == hubs.id, "left_semi")
    on_hub = pairs.join(F.broadcast(hub_stats), "src")
    rest = pairs.join(F.broadcast(hubs), pairs.src == hubs.id, "left_anti").join(stats, "src")
    return shares(on_hub), shares(rest)


def contributions(edges: DataFrame, ranks: DataFrame,
                  num_partitions: int | None = None) -> DataFrame:
    """One row per distinct edge: contribution = multiplicity * rank(src) / deg(src).

    Inner join on the source: vertices without out-edges contribute nothing.
    Hub sources (at most one per partition) meet their ranks through a
    bounded broadcast; the rest join normally. The pairs are checkpointed, as
    the choice of hubs reads them too.
    """
    n = num_partitions or int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = materialize(adjacency(edges))
    stats = materialize(source_stats(pairs))
    hubs, _, _ = hub_sources(stats, n)
    on_hub, rest = split_weights(pairs, stats, hubs)
    joined = rest.join(ranks, rest.src == ranks.id)
    if hubs is not None:
        hub_ranks = ranks.join(F.broadcast(hubs), "id", "left_semi")
        joined = joined.unionByName(on_hub.join(F.broadcast(hub_ranks), on_hub.src == hub_ranks.id))
    return joined.select("src", "dst", (F.col("weight") * F.col("rank")).alias("contribution"))


def contribution_totals(edges: DataFrame, ranks: DataFrame) -> DataFrame:
    """Per vertex: sum of incoming contributions, 0.0 for a vertex with none."""
    c = (contributions(edges, ranks).groupBy("dst")
         .agg(F.sum("contribution").alias("_c")))
    v = vertices(edges)
    return (v.join(c, v.id == c.dst, "left")
            .select("id", F.coalesce(F.col("_c"), F.lit(0.0)).alias("contribution")))


def initial_ranks(edges: DataFrame) -> DataFrame:
    """Every source vertex starts at 1.0."""
    return edges.select(F.col("src").alias("id")).distinct().withColumn("rank", F.lit(1.0))


def pagerank(edges: DataFrame, iterations: int = 10, damping: float = 0.85,
             checkpoint_every: int = 3, num_partitions: int | None = None) -> DataFrame:
    """Unnormalised PageRank: rank = (1 - d) + d * sum of contributions.

    Start 1.0 on every source; sinks keep what they receive and pass
    nothing on (their mass leaves the system). After ≥ 1 round every
    endpoint has a rank; a vertex with no in-edges has exactly 1 - d.
    The result is checkpointed, so it does not depend on the caches used
    by the loop, which are released before returning.
    """
    return pagerank_with_sources(edges, iterations, damping, checkpoint_every,
                                 num_partitions)[0]


def pagerank_with_sources(edges: DataFrame, iterations: int = 10, damping: float = 0.85,
                          checkpoint_every: int = 3, num_partitions: int | None = None):
    """``pagerank`` plus the number of source vertices (the normaliser), which
    falls out of the same aggregate that sizes the hubs."""
    if iterations <= 0:
        return initial_ranks(edges), source_count(edges)
    ranks, cached, tables, n_sources = pagerank_plan(edges, iterations, damping,
                                                     checkpoint_every, num_partitions,
                                                     with_sources=True)
    ranks = materialize(ranks)
    for c in cached:
        c.unpersist()
    for t in tables:
        drop_table(edges.sparkSession, t)
    return ranks, n_sources


def pagerank_plan(edges: DataFrame, iterations: int, damping: float = 0.85,
                  checkpoint_every: int = 3, num_partitions: int | None = None,
                  with_sources: bool = False):
    """The lazy PageRank plan, the frames it caches and the tables it wrote (for ``explain``)."""
    spark = edges.sparkSession
    # The per-round aggregate exchanges into spark.sql.shuffle.partitions
    # partitions; the bucketed tables use the same count so that the joins
    # with it stay co-partitioned (a different count would make Spark move
    # the edge side every round).
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keep = StorageLevel.MEMORY_AND_DISK
    pairs = adjacency(edges).persist(keep)
    stats = source_stats(pairs).persist(keep)
    hubs, n_pairs, n_sources = hub_sources(stats, n)
    on_hub, rest = split_weights(pairs, stats, hubs)
    # Loop invariants are written once as bucketed tables in the shared
    # checkpoint folder: they survive executor loss, and their scans report
    # hash partitioning on the join key, so the per-round joins with ranks
    # (hash partitioned on id, same count) need no exchange.
    normal, t_w = write_bucketed(rest.select("src", "dst", "weight"), n, "src", "pr_weights")
    hub_edges = None if on_hub is None else materialize(
        on_hub.select("src", "dst", "weight").repartition(n, "dst"))
    verts, t_v = write_bucketed(vertices(edges), n, "id", "pr_vertices")
    tables = [t_w, t_v]

    ranks = stored = verts.withColumn("rank", F.lit(1.0))
    for i in range(iterations):
        parts = normal.join(ranks, normal.src == ranks.id).select(
            "dst", (F.col("weight") * F.col("rank")).alias("c"))
        if hub_edges is not None:
            hub_ranks = stored.join(F.broadcast(hubs), "id", "left_semi")
            parts = parts.unionByName(
                hub_edges.join(F.broadcast(hub_ranks), hub_edges.src == hub_ranks.id)
                .select("dst", (F.col("weight") * F.col("rank")).alias("c")))
        contrib = parts.groupBy("dst").agg(F.sum("c").alias("_c"))
        ranks = verts.join(contrib, verts.id == contrib.dst, "left").select(
            "id", (F.lit(1.0 - damping) + F.lit(damping) * F.coalesce(F.col("_c"), F.lit(0.0)))
            .alias("rank"))
        # Cut the growing lineage (reliable checkpoint in the shared folder).
        # With hubs a round reads the ranks twice, so they are stored every
        # round and the plan of a round begins at a leaf. The checkpoint
        # forgets its partitioning, so the ranks (one row per vertex, far
        # fewer than edges) are hashed by id once more; the edge side never
        # moves.
        every = 1 if hub_edges is not None else checkpoint_every
        if every and (i + 1) % every == 0 and i + 1 < iterations:
            stored = materialize(ranks)
            ranks = stored.repartition(n, "id")
    if with_sources:
        return ranks, [pairs, stats], tables, n_sources
    return ranks, [pairs, stats], tables


def source_count(edges: DataFrame) -> int:
    """Number of distinct source vertices (the reference's "total pages")."""
    return edges.select("src").distinct().count()


def normalise(ranks: DataFrame, n_sources: int) -> DataFrame:
    """rank / number of source vertices; the values need not sum to 1."""
    return ranks.withColumn("rank", F.col("rank") / F.lit(float(n_sources)))


def top_ranks(ranks: DataFrame, k: int) -> DataFrame:
    """k highest ranks, ties broken by id; carries the 1-based position."""
    w = Window.orderBy(F.col("rank").desc(), F.col("id").asc())
    top = ranks.orderBy(F.col("rank").desc(), F.col("id").asc()).limit(k)
    return top.withColumn("position", F.row_number().over(w))
