"""Sort, timing and evaluation queries over ``events`` and ``embeddings``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import seconds_between, zip_sum
from ..operators import stats as S
from ..operators.learn import evaluate, normalise_channels
from ..operators.ordered import with_next, with_row_number, zip_by_position
from ..operators.sorting import sort_with_position, sorted_parts
from ..session import remove_path, scratch_path
from ..sources.csv import read_csv_strings
from ..sources.sinks import write_csv
from ..sources.tables import table
from ..sources.text import scan_lines


def r6(c: str, name: str | None = None):
    return F.round(F.col(c), 6).alias(name or c)


def csv_two_key_sort(spark, sf_dir):
    """events written as CSV with a header, read back as strings, globally sorted.

    Keys event_type, ts, then event_id (all strings: '10' sorts before '9').
    """
    path = scratch_path(spark, "events_csv")
    write_csv(table(spark, sf_dir, "events"), path, header=True)
    rows = read_csv_strings(spark, path)
    out = sort_with_position(rows, ["event_type", "ts", "event_id"])  # checkpointed
    remove_path(spark, path)
    return out


def csv_sorted_parts(spark, sf_dir):
    """events sorted by type and day (many ties), written as CSV without a header, read back in part order."""
    path = scratch_path(spark, "sorted_csv")
    keyed = table(spark, sf_dir, "events").select("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    write_csv(sorted_parts(keyed, ["event_type", "day"]), f"{path}/sink=1")
    lines = scan_lines(spark, path, by=("sink",))  # checkpointed
    remove_path(spark, path)
    cells = F.split("value", ",")
    return lines.select(F.col("line_no").alias("position"), F.get(cells, 0).alias("event_type"), F.get(cells, 1).alias("day"))


def series_zip(spark, sf_dir):
    """Event values in order of time beside event values in order of user: two series, joined by position."""
    ev = table(spark, sf_dir, "events")
    by_time = ev.select(F.col("event_id").alias("time_id"), F.col("value").alias("by_time"), F.col("ts").alias("time_ts"))
    by_user = ev.select(F.col("event_id").alias("user_event"), F.col("value").alias("by_user"), "user_id", F.col("ts").alias("user_ts"))
    both = zip_by_position(by_time, by_user, ["time_ts", "time_id"], ["user_id", "user_ts", "user_event"])
    total = zip_sum(F.array("by_time"), F.array("by_user"))[0]
    return both.select("position", "by_time", "by_user", F.round(total, 6).alias("total"))


def _user_batches(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    return with_row_number(ev, ["user_id"], ["ts", "event_id"], "batch")


def interval_loss(spark, sf_dir):
    """Each user's events as training batches (loss = value), reported every 20."""
    out = S.interval_loss(_user_batches(spark, sf_dir), ["user_id"], "batch", "value")
    return out.select("user_id", "batch", r6("value", "loss"))


def step_timing(spark, sf_dir):
    """Seconds between a user's consecutive events; steps 1..39 kept; mean and population std."""
    b = _user_batches(spark, sf_dir)
    steps = with_next(b, ["user_id"], "pos", ["ts"], how="inner").select(
        "user_id", "batch", seconds_between("ts", "ts_next").alias("step"))
    st = S.window_stats(steps, ["user_id"], "batch", "step", 1, 39)
    return st.select("user_id", r6("mean", "mean_s"), r6("std", "std_s"), "n")


def stage_time_sum(spark, sf_dir, a: str = "view", b: str = "click"):
    """Two per-type daily series zipped by day: a, b and their element-wise sum."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type").isin(a, b))
    daily = ev.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(
        F.sum(F.when(F.col("event_type") == a, F.col("value"))).alias("_a"),
        F.sum(F.when(F.col("event_type") == b, F.col("value"))).alias("_b"))
    zipped = daily.where(F.col("_a").isNotNull() & F.col("_b").isNotNull())
    return zipped.select("day", r6("_a", f"{a}_s"), r6("_b", f"{b}_s"),
                         F.round(F.col("_a") + F.col("_b"), 6).alias("total_s"))


CLASSES, DIMS = 10, 64
# Weights of the evaluated classifier: small multiples of 0.1 by class and dim.
WEIGHTS = [[((7 * c + 3 * d) % 11 - 5) / 10.0 for d in range(DIMS)] for c in range(CLASSES)]


def classifier_eval(spark, sf_dir, batch_size: int = 256):
    """A linear classifier over all dims of each embedding; batches of 256 in vec_id order."""
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    out = evaluate(emb, WEIGHTS, "vec_id", batch_size)
    return out.select("correct", "total", "accuracy_pct", r6("avg_loss"))


def vector_normalise(spark, sf_dir):
    """Per-channel normalisation, channel = dim mod 3; long form (vec_id, dim, value)."""
    emb = table(spark, sf_dir, "embeddings")
    n = emb.select("vec_id", normalise_channels(F.col("embedding")).alias("v"))
    return n.select("vec_id", F.posexplode("v").alias("dim", "value")).select(
        "vec_id", F.col("dim").cast("long").alias("dim"), r6("value"))


QUERIES = {
    "csv_two_key_sort": csv_two_key_sort,
    "csv_sorted_parts": csv_sorted_parts,
    "series_zip": series_zip,
    "interval_loss": interval_loss,
    "step_timing": step_timing,
    "stage_time_sum": stage_time_sum,
    "classifier_eval": classifier_eval,
    "vector_normalise": vector_normalise,
}

SQL = {
    "csv_two_key_sort": """
WITH s AS (SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
                  CAST(user_id AS VARCHAR) AS user_id, event_type, CAST(value AS VARCHAR) AS value, props
           FROM events)
SELECT row_number() OVER (ORDER BY event_type NULLS FIRST, ts NULLS FIRST, event_id NULLS FIRST) - 1 AS position,
       event_id, ts, user_id, event_type, value, props
FROM s""",
    "csv_sorted_parts": """
SELECT row_number() OVER (ORDER BY event_type NULLS FIRST, strftime(ts, '%Y-%m-%d') NULLS FIRST) - 1 AS position,
       event_type, strftime(ts, '%Y-%m-%d') AS day
FROM events""",
    "series_zip": """
WITH a AS (SELECT value AS by_time, row_number() OVER (ORDER BY ts, event_id) - 1 AS position FROM events),
b AS (SELECT value AS by_user, row_number() OVER (ORDER BY user_id, ts, event_id) - 1 AS position FROM events)
SELECT a.position, by_time, by_user, round(by_time + by_user, 6) AS total FROM a JOIN b ON a.position = b.position""",
    "interval_loss": """
WITH b AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS batch, value
           FROM events),
g AS (SELECT user_id, CAST(ceil(batch / 20.0) AS BIGINT) AS grp, sum(value) AS s, max(batch) AS last
      FROM b GROUP BY 1, 2)
SELECT user_id, last AS batch, round(s / 20.0, 6) AS loss FROM g WHERE last = grp * 20""",
    "step_timing": """
WITH s AS (SELECT user_id, row_number() OVER w - 1 AS idx,
                  (epoch_us(lead(ts) OVER w) - epoch_us(ts)) / 1e6 AS step
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, round(avg(step), 6) AS mean_s, round(stddev_pop(step), 6) AS std_s, count(*) AS n
FROM s WHERE step IS NOT NULL AND idx BETWEEN 1 AND 39 GROUP BY user_id""",
    "stage_time_sum": """
WITH d AS (SELECT strftime(ts, '%Y-%m-%d') AS day,
                  sum(CASE WHEN event_type = 'view' THEN value END) AS a,
                  sum(CASE WHEN event_type = 'click' THEN value END) AS b
           FROM events WHERE event_type IN ('view', 'click') GROUP BY 1)
SELECT day, round(a, 6) AS view_s, round(b, 6) AS click_s, round(a + b, 6) AS total_s
FROM d WHERE a IS NOT NULL AND b IS NOT NULL""",
    "classifier_eval": """
WITH u AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS dim, unnest(embedding)::double AS x
           FROM embeddings),
z AS (SELECT vec_id, c.range AS cls, sum(x * (((7 * c.range + 3 * dim) % 11 - 5) / 10.0)::double) AS z
      FROM u, range(10) c GROUP BY 1, 2),
l AS (SELECT vec_id, list(z ORDER BY cls) AS sc FROM z GROUP BY vec_id),
s AS (SELECT (row_number() OVER (ORDER BY vec_id) - 1) // 256 AS batch, sc, label
      FROM l JOIN embeddings USING (vec_id)),
r AS (SELECT batch, CAST(list_position(sc, list_max(sc)) - 1 = label AS BIGINT) AS ok,
             list_max(sc) + ln(list_sum(list_transform(sc, lambda x: exp(x - list_max(sc))))) - sc[label + 1] AS loss
      FROM s),
b AS (SELECT batch, sum(ok) AS ok, count(*) AS n, avg(loss) AS loss FROM r GROUP BY batch)
SELECT CAST(sum(ok) AS BIGINT) AS correct, CAST(sum(n) AS BIGINT) AS total,
       round(100.0 * sum(ok) / sum(n), 0) AS accuracy_pct, round(avg(loss), 6) AS avg_loss
FROM b""",
    "vector_normalise": """
WITH u AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS dim, unnest(embedding) AS x FROM embeddings)
SELECT vec_id, CAST(dim AS BIGINT) AS dim,
       round((x - [125.3 / 255.0, 123.0 / 255.0, 113.9 / 255.0][dim % 3 + 1])
             / [63.0 / 255.0, 62.1 / 255.0, 66.7 / 255.0][dim % 3 + 1], 6) AS value
FROM u""",
}
