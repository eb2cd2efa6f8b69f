"""Data-parallel training queries over ``embeddings``.

Rows are dealt to 4 ranks like a distributed sampler (seed 0, padded);
each rank's shard is cut into ``steps`` batches, so the steps together
cover the whole table once.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import learn as T
from ..operators.sampling import assign_shards
from ..sources.tables import table

RANKS = 4
CLASSES = 10


def training_rows(spark, sf_dir, steps: int, ranks: int = RANKS):
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    s = assign_shards(emb, "vec_id", ranks, seed=0)
    shard_len = -(-emb.count() // ranks)
    per_step = max(1, -(-shard_len // steps))
    dims = len((emb.select("embedding").first() or ([],))[0])
    rows = s.select(F.col("rank").alias("shard"), "label", "embedding",
                    F.expr(f"pos_in_shard div {per_step}").alias("step"))
    return rows, dims


def gradient_mean(spark, sf_dir):
    """Averaged gradient of all rows, at zero weights: mean of shard means."""
    rows, dims = training_rows(spark, sf_dir, steps=1)
    g = T.shard_gradients(rows, [[0.0] * dims] * CLASSES)
    return g.select("cls", "dim", F.round("grad", 9).alias("grad"))


def softmax_sgd_3(spark, sf_dir, steps: int = 3):
    """Weights of a linear softmax classifier after 3 synchronous SGD steps."""
    rows, dims = training_rows(spark, sf_dir, steps)
    w = T.softmax_sgd(T.by_step(rows), steps, CLASSES, dims)
    return T.matrix_frame(spark, w).select("cls", "dim", F.round("w", 9).alias("w"))


QUERIES = {
    "gradient_mean": gradient_mean,
    "softmax_sgd_3": softmax_sgd_3,
}


def _sgd_sql(steps: int, final: str, only_gradient: bool = False) -> str:
    parts = [f"""p AS (SELECT vec_id, row_number() OVER (ORDER BY md5('0:' || CAST(vec_id AS VARCHAR)), vec_id) - 1 AS p
      FROM embeddings)""",
             "c AS (SELECT count(*) AS n FROM embeddings)",
             """q AS (SELECT vec_id, p AS q FROM p
      UNION ALL SELECT vec_id, p + c.n FROM p, c WHERE p < (4 - c.n % 4) % 4)""",
             "sh AS (SELECT vec_id, q % 4 AS shard, q // 4 AS pis FROM q)",
             f"bs AS (SELECT CAST(ceil((max(pis) + 1) / {steps}.0) AS BIGINT) AS b FROM sh)",
             """r AS MATERIALIZED (SELECT sh.shard, sh.pis, sh.pis // bs.b AS step, e.label, e.embedding
      FROM sh JOIN embeddings e ON sh.vec_id = e.vec_id, bs)""",
             """x AS MATERIALIZED (SELECT shard, pis, step, generate_subscripts(embedding, 1) - 1 AS dim,
             unnest(embedding) AS xv FROM r)""",
             """w0 AS (SELECT c.range AS cls, d.range AS dim, CAST(0.0 AS DOUBLE) AS w
       FROM range(10) c, range(64) d)"""]
    for t in range(steps):
        parts += [
            f"""z{t} AS (SELECT x.shard, x.pis, w.cls, sum(w.w * x.xv) AS z
        FROM x JOIN w{t} w ON x.dim = w.dim WHERE x.step = {t} GROUP BY 1, 2, 3)""",
            f"m{t} AS (SELECT *, z - max(z) OVER (PARTITION BY shard, pis) AS zc FROM z{t})",
            f"""p{t} AS (SELECT shard, pis, cls, exp(zc) / sum(exp(zc)) OVER (PARTITION BY shard, pis) AS pr
        FROM m{t})""",
            f"""a{t} AS (SELECT p.shard, p.pis, p.cls,
               p.pr - CASE WHEN r.label = p.cls THEN 1.0 ELSE 0.0 END AS a
        FROM p{t} p JOIN r ON r.shard = p.shard AND r.pis = p.pis)""",
            f"""gs{t} AS (SELECT a.shard, a.cls, x.dim, sum(a.a * x.xv) / count(*) AS g
         FROM a{t} a JOIN x ON x.shard = a.shard AND x.pis = a.pis GROUP BY 1, 2, 3)""",
            f"g{t} AS MATERIALIZED (SELECT cls, dim, avg(g) AS g FROM gs{t} GROUP BY 1, 2)",
        ]
        if only_gradient:
            break
        parts += [
            f"d{t} AS (SELECT g.cls, g.dim, g.g + 0.0001 * w.w AS d FROM g{t} g JOIN w{t} w USING (cls, dim))",
            (f"b{t} AS MATERIALIZED (SELECT cls, dim, d AS b FROM d{t})" if t == 0 else
             f"""b{t} AS MATERIALIZED (SELECT d.cls, d.dim, 0.9 * b.b + d.d AS b
        FROM d{t} d JOIN b{t - 1} b USING (cls, dim))"""),
            f"""w{t + 1} AS MATERIALIZED (SELECT w.cls, w.dim, w.w - 0.1 * b.b AS w
        FROM w{t} w JOIN b{t} b USING (cls, dim))""",
        ]
    return "WITH " + ",\n".join(parts) + "\n" + final


SQL = {
    "gradient_mean": _sgd_sql(1, "SELECT CAST(cls AS INTEGER) AS cls, CAST(dim AS INTEGER) AS dim, "
                                 "round(g, 9) AS grad FROM g0", only_gradient=True),
    "softmax_sgd_3": _sgd_sql(3, "SELECT CAST(cls AS INTEGER) AS cls, CAST(dim AS INTEGER) AS dim, "
                                 "round(w, 9) AS w FROM w3"),
}
