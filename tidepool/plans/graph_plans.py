"""Graph queries over the part-to-next-part graph of ``lineitem``.

Within each order, each part points to the next part in line order
(``l_linenumber`` then ``l_partkey``, since line numbers repeat in this
data). Ids stay ``bigint``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import graph as G
from ..operators.partitioning import bucket_of, drop_table, place_in_buckets, write_bucketed
from ..operators.sorting import sort_with_position
from ..session import materialize, remove_path, scratch_path
from ..sources.sinks import write_lines
from ..sources.tables import table
from ..sources.text import parse_edges, scan_edges


def lineitem_graph(spark: SparkSession, sf_dir: str, reused: bool = True) -> DataFrame:
    """The part-to-next-part edge table.

    ``reused``: the caller reads the edges more than once (weights, vertices,
    sources), so they are checkpointed and each read is a scan of two narrow
    columns instead of a rerun of the ordinal join. Single-read queries skip
    the extra write.
    """
    li = table(spark, sf_dir, "lineitem")
    edges = G.edges_from_sequences(li, "l_orderkey", ["l_linenumber", "l_partkey"], "l_partkey")
    return materialize(edges) if reused else edges


def r6(c: str):
    return F.round(F.col(c), 6).alias(c)


def _edge_lines(spark, sf_dir):
    """Edge lines rendered from lineitem: TAB fields, '#' lines between them."""
    li = table(spark, sf_dir, "lineitem")
    # The first line of each order comes with a comment line, from the same scan.
    edge = F.concat_ws("\t", "l_partkey", "l_suppkey", "l_orderkey")
    comment = F.concat(F.lit("# order\t"), F.col("l_orderkey").cast("string"))
    return li.select(F.explode(F.when(F.col("l_linenumber") == 1, F.array(comment, edge))
                               .otherwise(F.array(edge))).alias("value"))


def edge_parse(spark, sf_dir):
    """Edge lines rendered from lineitem, parsed back."""
    return parse_edges(_edge_lines(spark, sf_dir))


def edge_file_scan(spark, sf_dir, min_partitions: int = 10):
    """The edge lines as a stored text file, read in at least 10 splits."""
    path = scratch_path(spark, "edges")
    write_lines(_edge_lines(spark, sf_dir), path)
    out = materialize(scan_edges(spark, path, min_partitions=min_partitions))
    remove_path(spark, path)
    return out


def graph_vertices(spark, sf_dir):
    return G.vertices(lineitem_graph(spark, sf_dir, reused=False))


def graph_out_degree(spark, sf_dir):
    return G.out_degree(lineitem_graph(spark, sf_dir, reused=False))


def graph_adjacency(spark, sf_dir):
    return G.adjacency(lineitem_graph(spark, sf_dir, reused=False))


def graph_adjacency_lists(spark, sf_dir):
    """All targets per part, duplicates kept, in lists of at most 64."""
    return G.adjacency_lists(lineitem_graph(spark, sf_dir, reused=False))


def graph_contributions(spark, sf_dir):
    e = lineitem_graph(spark, sf_dir)
    return G.contributions(e, G.initial_ranks(e)).select("src", "dst", r6("contribution"))


def graph_outer_default(spark, sf_dir):
    e = lineitem_graph(spark, sf_dir)
    return G.contribution_totals(e, G.initial_ranks(e)).select("id", r6("contribution"))


def pagerank_iter1(spark, sf_dir):
    return G.pagerank(lineitem_graph(spark, sf_dir), iterations=1).select("id", r6("rank"))


def pagerank_iter10(spark, sf_dir):
    return G.pagerank(lineitem_graph(spark, sf_dir), iterations=10).select("id", r6("rank"))


def dangling_graph(spark, sf_dir):
    """supplier -> its nation -> its region, as prefixed string ids."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    a = s.select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("src"),
                 F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("dst"))
    b = n.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("src"),
                 F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("dst"))
    return a.unionByName(b)


def pagerank_dangling(spark, sf_dir):
    return G.pagerank(dangling_graph(spark, sf_dir), iterations=10).select("id", r6("rank"))


def _normalised(spark, sf_dir):
    ranks, n_sources = G.pagerank_with_sources(lineitem_graph(spark, sf_dir), iterations=10)
    return G.normalise(ranks, n_sources)


def pagerank_normalised(spark, sf_dir):
    return _normalised(spark, sf_dir).select("id", r6("rank"))


def pagerank_topk(spark, sf_dir, k: int = 20):
    top = G.top_ranks(_normalised(spark, sf_dir), k)
    return top.select("position", "id", r6("rank"))


def partition_balance(spark, sf_dir, n: int = 105):
    """Sources placed by the own partition function ``src mod 105``: bucket i is partition i.

    Edges are counted by source before they are dealt, so a hub is one row.
    """
    e = lineitem_graph(spark, sf_dir, reused=False)
    return _bucket_sizes(G.out_degree(e), n)


def _bucket_sizes(degrees: DataFrame, n: int) -> DataFrame:
    placed = place_in_buckets(degrees.withColumn("bucket", bucket_of(degrees, "src", n)), "bucket", n)
    return (placed.groupBy("bucket", F.spark_partition_id().alias("partition"))
            .agg(F.sum("out_degree").alias("n_edges"), F.count(F.lit(1)).alias("n_sources")))


def flag_graph(spark, sf_dir):
    """Return flag -> part and part -> return flag, string ids: the flags are hubs."""
    li = table(spark, sf_dir, "lineitem")
    flag = F.concat(F.lit("f"), F.col("l_returnflag"))
    part = F.concat(F.lit("p"), F.col("l_partkey").cast("string"))
    ends = F.array(F.struct(flag.alias("src"), part.alias("dst")), F.struct(part.alias("src"), flag.alias("dst")))
    return li.select(F.explode(ends).alias("e")).select("e.src", "e.dst")


def partition_balance_text(spark, sf_dir, n: int = 105):
    """The own partition function on string ids, which it hashes first."""
    return _bucket_sizes(G.out_degree(flag_graph(spark, sf_dir)), n)


def pagerank_hub(spark, sf_dir):
    """Three rounds over a graph whose hubs touch nearly every vertex."""
    edges = materialize(flag_graph(spark, sf_dir))
    return G.pagerank(edges, iterations=3).select("id", r6("rank"))


def prepartitioned_shares(spark, sf_dir):
    """Edge pairs and out-degrees stored by source alike, joined without moving either.

    String ids; the share of a source's edges that each of its targets gets.
    """
    pairs = G.adjacency(lineitem_graph(spark, sf_dir, reused=False))
    named = pairs.select(F.concat(F.lit("p"), F.col("src").cast("string")).alias("src"),
                         F.concat(F.lit("p"), F.col("dst").cast("string")).alias("dst"), "multiplicity")
    joined, tables = prepartitioned_join(spark, named)
    out = materialize(joined.select("src", "dst", F.round(F.col("multiplicity") / F.col("degree"), 9).alias("share")))
    for t in tables:
        drop_table(spark, t)
    return out


def prepartitioned_join(spark, pairs: DataFrame) -> tuple[DataFrame, list[str]]:
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    left, t_left = write_bucketed(pairs, n, "src", "pairs")
    degrees = left.groupBy("src").agg(F.sum("multiplicity").alias("degree"))
    right, t_right = write_bucketed(degrees, n, "src", "degrees")
    return left.join(right.hint("merge"), "src"), [t_left, t_right]


def ranks_by_id(spark, sf_dir):
    """Normalised ranks in the order of their ids as text, as printed tuples are."""
    ranks = _normalised(spark, sf_dir).select(F.col("id").cast("string").alias("id"), r6("rank"))
    return sort_with_position(ranks, ["id"])


QUERIES = {
    "edge_parse": edge_parse,
    "edge_file_scan": edge_file_scan,
    "graph_adjacency_lists": graph_adjacency_lists,
    "graph_vertices": graph_vertices,
    "graph_out_degree": graph_out_degree,
    "graph_adjacency": graph_adjacency,
    "graph_contributions": graph_contributions,
    "graph_outer_default": graph_outer_default,
    "pagerank_iter1": pagerank_iter1,
    "pagerank_iter10": pagerank_iter10,
    "pagerank_dangling": pagerank_dangling,
    "pagerank_normalised": pagerank_normalised,
    "pagerank_topk": pagerank_topk,
    "partition_balance": partition_balance,
    "partition_balance_text": partition_balance_text,
    "pagerank_hub": pagerank_hub,
    "prepartitioned_shares": prepartitioned_shares,
    "ranks_by_id": ranks_by_id,
}

# ---------------------------------------------------------------- oracle SQL

EDGES_SQL = """e AS MATERIALIZED (
  SELECT src, dst FROM (
    SELECT l_partkey AS src,
           lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS dst
    FROM lineitem) t
  WHERE dst IS NOT NULL)"""

DANGLING_SQL = """e AS MATERIALIZED (
  SELECT 's' || CAST(s_suppkey AS VARCHAR) AS src, 'n' || CAST(s_nationkey AS VARCHAR) AS dst FROM supplier
  UNION ALL
  SELECT 'n' || CAST(n_nationkey AS VARCHAR), 'r' || CAST(n_regionkey AS VARCHAR) FROM nation)"""


FLAG_SQL = """e AS MATERIALIZED (
  SELECT 'f' || l_returnflag AS src, 'p' || l_partkey AS dst FROM lineitem
  UNION ALL SELECT 'p' || l_partkey, 'f' || l_returnflag FROM lineitem)"""


def pagerank_sql(edges_cte: str, rounds: int, final: str) -> str:
    """Unrolled PageRank: one materialised CTE per round."""
    parts = [edges_cte,
             """w AS MATERIALIZED (
  SELECT src, dst, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY src) AS weight
  FROM e GROUP BY src, dst)""",
             """v AS MATERIALIZED (SELECT DISTINCT id FROM (SELECT src AS id FROM e UNION ALL SELECT dst FROM e) t)""",
             "r0 AS MATERIALIZED (SELECT id, CAST(1.0 AS DOUBLE) AS rank FROM v)"]
    for i in range(1, rounds + 1):
        parts.append(f"""r{i} AS MATERIALIZED (
  SELECT v.id, 0.15 + 0.85 * coalesce(c.s, 0.0) AS rank
  FROM v LEFT JOIN (SELECT w.dst, sum(w.weight * r.rank) AS s
                    FROM w JOIN r{i - 1} r ON w.src = r.id GROUP BY w.dst) c
  ON v.id = c.dst)""")
    return "WITH " + ",\n".join(parts) + "\n" + final.format(r=f"r{rounds}")


SQL = {
    "edge_parse": """
SELECT CAST(l_partkey AS VARCHAR) AS src, CAST(l_suppkey AS VARCHAR) AS dst FROM lineitem""",
    "edge_file_scan": """
SELECT CAST(l_partkey AS VARCHAR) AS src, CAST(l_suppkey AS VARCHAR) AS dst FROM lineitem""",
    "graph_adjacency_lists": f"""WITH {EDGES_SQL},
n AS (SELECT src, dst, (row_number() OVER (PARTITION BY src ORDER BY dst) - 1) // 64 AS chunk FROM e)
SELECT src, chunk, list(dst ORDER BY dst) AS targets FROM n GROUP BY src, chunk""",
    "graph_vertices": f"""WITH {EDGES_SQL}
SELECT DISTINCT id FROM (SELECT src AS id FROM e UNION ALL SELECT dst FROM e) t""",
    "graph_out_degree": f"""WITH {EDGES_SQL}
SELECT src, count(*) AS out_degree FROM e GROUP BY src""",
    "graph_adjacency": f"""WITH {EDGES_SQL}
SELECT src, dst, count(*) AS multiplicity FROM e GROUP BY src, dst""",
    "graph_contributions": f"""WITH {EDGES_SQL},
d AS (SELECT src, count(*) AS deg FROM e GROUP BY src)
SELECT e.src, e.dst, round(CAST(count(*) AS DOUBLE) / any_value(d.deg) * 1.0, 6) AS contribution
FROM e JOIN d ON e.src = d.src GROUP BY e.src, e.dst""",
    "graph_outer_default": f"""WITH {EDGES_SQL},
d AS (SELECT src, count(*) AS deg FROM e GROUP BY src),
c AS (SELECT e.dst, sum(1.0 / d.deg) AS s FROM e JOIN d ON e.src = d.src GROUP BY e.dst),
v AS (SELECT DISTINCT id FROM (SELECT src AS id FROM e UNION ALL SELECT dst FROM e) t)
SELECT v.id, round(coalesce(c.s, 0.0), 6) AS contribution FROM v LEFT JOIN c ON v.id = c.dst""",
    "pagerank_iter1": pagerank_sql(EDGES_SQL, 1, "SELECT id, round(rank, 6) AS rank FROM {r}"),
    "pagerank_iter10": pagerank_sql(EDGES_SQL, 10, "SELECT id, round(rank, 6) AS rank FROM {r}"),
    "pagerank_dangling": pagerank_sql(DANGLING_SQL, 10, "SELECT id, round(rank, 6) AS rank FROM {r}"),
    "pagerank_normalised": pagerank_sql(
        EDGES_SQL, 10,
        "SELECT id, round(rank / (SELECT count(DISTINCT src) FROM e), 6) AS rank FROM {r}"),
    "pagerank_topk": pagerank_sql(
        EDGES_SQL, 10,
        """SELECT CAST(row_number() OVER (ORDER BY rank DESC, id) AS INTEGER) AS position, id,
       round(rank, 6) AS rank
FROM (SELECT id, rank / (SELECT count(DISTINCT src) FROM e) AS rank FROM {r}) t
ORDER BY rank DESC, id LIMIT 20"""),
    "partition_balance": f"""WITH {EDGES_SQL}
SELECT CAST(src % 105 AS INTEGER) AS bucket, CAST(src % 105 AS INTEGER) AS partition, count(*) AS n_edges,
       count(DISTINCT src) AS n_sources
FROM e GROUP BY 1""",
    "partition_balance_text": f"""WITH {FLAG_SQL},
b AS (SELECT src, CAST(('0x' || substr(md5(src), 1, 8))::BIGINT % 105 AS INTEGER) AS bucket FROM e)
SELECT bucket, bucket AS partition, count(*) AS n_edges, count(DISTINCT src) AS n_sources FROM b GROUP BY 1""",
    "pagerank_hub": pagerank_sql(FLAG_SQL, 3, "SELECT id, round(rank, 6) AS rank FROM {r}"),
    "prepartitioned_shares": f"""WITH {EDGES_SQL}
SELECT 'p' || src AS src, 'p' || dst AS dst,
       round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY src), 9) AS share
FROM e GROUP BY src, dst""",
    "ranks_by_id": pagerank_sql(
        EDGES_SQL, 10,
        """SELECT row_number() OVER (ORDER BY CAST(id AS VARCHAR)) - 1 AS position, CAST(id AS VARCHAR) AS id,
       round(rank / (SELECT count(DISTINCT src) FROM e), 6) AS rank FROM {r}"""),
}
