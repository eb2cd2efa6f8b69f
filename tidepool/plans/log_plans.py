"""Utilisation-log and field-log queries over logs rendered from ``events``.

Each event type is one log source; events in (ts, event_id) order are GPU
samples (GPU = user_id mod 4, utilisation = floor(value)). A sampling round
opens with a stamp line whenever the GPU id does not rise, so each round
lists rising GPU ids; the stamp is the event's hour (``HH:00:00``), so equal
stamps in a row are common and exercise the de-duplication rule.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import logs as L
from ..operators.ordered import with_ordinal, with_row_number
from ..operators.scan import Recurrence, scan
from ..session import materialize, remove_path, scratch_path
from ..sources.tables import table
from ..sources.text import field, field_lines, lines_by_token, scan_lines


def _rendered(spark, sf_dir, opens: Callable) -> DataFrame:
    """(source, pos, event_index, value): each event's sample line, under a stamp line where ``opens`` says.

    ``pos`` = 2·(event ordinal) + (0 for a stamp line, 1 for a sample line):
    unique and increasing in line order; ``event_index`` is the event's
    0-based place within its source (used to number lines).
    """
    ev = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("source"), "ts", "event_id",
        F.pmod(F.col("user_id"), F.lit(4)).alias("gpu"),
        F.floor("value").cast("long").alias("util"))
    o = with_ordinal(ev, ["source", "ts", "event_id"], "epos")
    o = scan(o, ["source"], "epos", {
        "above": Recurrence(reset=F.struct("gpu", "ts"), before=True),
        "event_index": Recurrence(add=F.lit(1), before=True)})
    stamp = F.concat(F.lit("node1 "), F.date_format("ts", "EEE MMM dd HH:00:00 yyyy"))
    sample = F.format_string("[%d] root, %d %%, x", "gpu", "util")
    pos = F.col("epos") * 2
    lines = F.array_compact(F.array(
        F.when(F.col("above").isNull() | opens(F.col("above")), F.struct(pos.alias("pos"), stamp.alias("value"))),
        F.struct((pos + 1).alias("pos"), sample.alias("value"))))
    return o.select("source", "event_index", F.inline(lines))


def util_log_lines(spark, sf_dir) -> DataFrame:
    """A round opens whenever the GPU id does not rise."""
    return _rendered(spark, sf_dir, lambda above: F.col("gpu") <= above["gpu"])


def hourly_log_lines(spark, sf_dir) -> DataFrame:
    """A stamp line at each new hour: GPU ids of a round come in any order."""
    return _rendered(spark, sf_dir, lambda above: F.date_trunc("hour", "ts") != F.date_trunc("hour", above["ts"]))


def _parsed(lines):
    """The typed columns of the lines, stored: each scan reads them."""
    return materialize(L.parse_util_lines(lines, keep=("event_index",)).drop("value"))


def stamp_bump(spark, sf_dir):
    """Stamp lines with their raw and de-duplicated times (ms since midnight)."""
    adj = L.stamped_lines(_parsed(util_log_lines(spark, sf_dir))).where(F.col("kind") == "stamp")
    # Lines above a stamp: one sample per earlier event plus one per earlier stamp.
    return adj.select("source", (F.col("event_index") + F.col("stamp_index")).alias("line_no"),
                      "raw_ms", F.col("stamp_ms").alias("adjusted_ms"))


def stamp_bump_fine(spark, sf_dir):
    """Stamps of 100 ms grain, a step of 300 ms: moved stamps meet later raw ones."""
    ev = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("source"), "ts", "event_id",
        (F.hour("ts") * F.lit(3600000).cast("long") + F.pmod("user_id", F.lit(5)) * 100).alias("raw_ms"))
    stamps = with_ordinal(ev, ["source", "ts", "event_id"], "epos")
    return L.bump_equal_stamps(stamps, "source", "raw_ms", "epos", index="position").select(
        "source", "position", "raw_ms", "adjusted_ms")


def log_forward_fill(spark, sf_dir):
    """Sample lines with the newest stamp above them carried down."""
    samples = L.stamped_samples(_parsed(util_log_lines(spark, sf_dir)))
    line_no = F.col("event_index") + F.col("stamp_index") + 1
    return samples.select("source", line_no.alias("line_no"), "gpu", "util", "stamp_ms")


def gpu_gap_fill(spark, sf_dir):
    """Per round: seconds since the first stamp and one utilisation column per GPU."""
    filled = L.gap_fill(L.stamped_samples(_parsed(util_log_lines(spark, sf_dir))))
    return filled.select("source", F.round("t_s", 6).alias("t_s"),
                         "gpu0", "gpu1", "gpu2", "gpu3")


def gpu_cycle_fill(spark, sf_dir):
    """The literal cycle over GPUs 0 to 3 on a log whose GPU ids come in any order."""
    filled = L.gpu_cycle_fill(L.stamped_samples(_parsed(hourly_log_lines(spark, sf_dir))))
    return filled.select("source", "position", F.round("t_s", 6).alias("t_s"),
                         "gpu0", "gpu1", "gpu2", "gpu3")


def util_log_file(spark, sf_dir):
    """The log of ``gpu_gap_fill`` as stored files: a folder a source, line numbers from the files' splits."""
    path = scratch_path(spark, "util_log")
    lines = util_log_lines(spark, sf_dir).select("source", "pos", "value")
    # Part files in the order of the lines; a source may have several.
    lines.repartitionByRange("source", "pos").sortWithinPartitions("source", "pos").drop("pos").write.partitionBy("source").text(path)
    stored = scan_lines(spark, path, by=("source",))  # checkpointed
    remove_path(spark, path)
    filled = L.gap_fill(L.stamped_samples(materialize(L.parse_util_lines(stored, pos="line_no").drop("value")), pos="line_no"), pos="line_no")
    return filled.select("source", F.round("t_s", 6).alias("t_s"), "gpu0", "gpu1", "gpu2", "gpu3")


def field_log_lines(spark, sf_dir) -> DataFrame:
    """Network-counter lines ``time iface id rx tx`` rendered from events."""
    ev = table(spark, sf_dir, "events")
    iface = (F.when(F.col("event_type") == "click", "eth0")
             .when(F.col("event_type") == "view", "eth1").otherwise("lo"))
    return ev.select("ts", "event_id", F.concat_ws(
        " ", F.date_format("ts", "HH:mm:ss"), iface, F.col("event_id").cast("string"),
        F.col("value").cast("string"), F.get_json_object("props", "$.k")).alias("value"))


def field_log_series(spark, sf_dir, tokens: tuple[str, ...] = ("eth0", "eth1")):
    """Per interface: packets/s = field 3 + field 4 of each of its lines, in line order.

    One pass over the lines: a line counts for every token it contains.
    """
    kept = lines_by_token(field_log_lines(spark, sf_dir), tokens, "iface")
    series = kept.select("iface", "ts", "event_id", field(0).alias("time"),
                         (field(3, "double") + field(4, "double")).alias("pkts"))
    numbered = with_row_number(series, ["iface"], ["ts", "event_id"], "position")
    return numbered.select("iface", "position", "time", F.round("pkts", 6).alias("pkts"))


def cpu_series(spark, sf_dir):
    """User share (field 3) of the lines for all CPUs, in line order."""
    ev = table(spark, sf_dir, "events")
    cpu = F.when(F.col("event_type") == "purchase", "0").otherwise("all")
    lines = ev.select("ts", "event_id", F.concat_ws(
        "  ", F.concat(F.lit("\t"), F.date_format("ts", "HH:mm:ss")), F.lit("PM"), cpu,
        F.col("value").cast("string"), F.lit("0.00")).alias("value"))
    kept = field_lines(lines, "all").select("ts", "event_id", field(3, "double").alias("user_pct"))
    return with_ordinal(kept, ["ts", "event_id"], "position").select(
        "position", F.round("user_pct", 6).alias("user_pct"))


QUERIES = {
    "cpu_series": cpu_series,
    "stamp_bump": stamp_bump,
    "stamp_bump_fine": stamp_bump_fine,
    "log_forward_fill": log_forward_fill,
    "gpu_gap_fill": gpu_gap_fill,
    "gpu_cycle_fill": gpu_cycle_fill,
    "util_log_file": util_log_file,
    "field_log_series": field_log_series,
}

LOG_SQL = """e AS (
  SELECT event_type AS source, ts, event_id, CAST(user_id % 4 AS INTEGER) AS gpu,
         CAST(floor(value) AS BIGINT) AS util, CAST(hour(ts) AS BIGINT) * 3600000 AS raw_ms,
         lag(user_id % 4) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS prev_gpu
  FROM events),
r AS (SELECT *, CASE WHEN prev_gpu IS NULL OR gpu <= prev_gpu THEN 1 ELSE 0 END AS nr FROM e),
l AS (SELECT *, CAST(sum(1 + nr) OVER (PARTITION BY source ORDER BY ts, event_id
                                       ROWS UNBOUNDED PRECEDING) - (1 + nr) AS BIGINT) AS first_line
      FROM r),
s AS (SELECT source, ts, event_id, first_line AS line_no, raw_ms,
             row_number() OVER (PARTITION BY source ORDER BY ts, event_id) AS k,
             lag(raw_ms) OVER (PARTITION BY source ORDER BY ts, event_id) AS prev_raw
      FROM l WHERE nr = 1),
i AS (SELECT *, max(CASE WHEN prev_raw IS NULL OR prev_raw <> raw_ms THEN k END)
                  OVER (PARTITION BY source ORDER BY k ROWS UNBOUNDED PRECEDING) AS start_k
      FROM s),
a AS (SELECT source, ts, event_id, line_no, raw_ms,
             raw_ms + 300 * ((k - start_k + CASE WHEN start_k = 1 AND raw_ms = 0 THEN 1 ELSE 0 END) % 2)
               AS adjusted_ms
      FROM i),
f AS (SELECT l.source, l.first_line + l.nr AS line_no, l.gpu, l.util,
             last_value(a.adjusted_ms IGNORE NULLS) OVER w AS stamp_ms,
             last_value(a.line_no IGNORE NULLS) OVER w AS stamp_line
      FROM l LEFT JOIN a ON l.source = a.source AND l.ts = a.ts AND l.event_id = a.event_id
      WINDOW w AS (PARTITION BY l.source ORDER BY l.ts, l.event_id ROWS UNBOUNDED PRECEDING))"""

# The adjusted stamps by the literal loop: one step of the recursion per line.
def bump_sql(stamps: str, out: str, step: int) -> str:
    return f"""{out} AS (
  SELECT source, k, raw_ms, raw_ms + CASE WHEN raw_ms = 0 THEN {step} ELSE 0 END AS adjusted_ms FROM {stamps} WHERE k = 0
  UNION ALL
  SELECT s.source, s.k, s.raw_ms, s.raw_ms + CASE WHEN s.raw_ms = a.adjusted_ms THEN {step} ELSE 0 END
  FROM {out} a JOIN {stamps} s ON s.source = a.source AND s.k = a.k + 1)"""


HOURLY_SQL = f"""e AS MATERIALIZED (
  SELECT event_type AS source, ts, event_id, CAST(user_id % 4 AS INTEGER) AS gpu, CAST(floor(value) AS BIGINT) AS util,
         CAST(hour(ts) AS BIGINT) * 3600000 AS raw_ms, row_number() OVER w AS n,
         lag(date_trunc('hour', ts)) OVER w IS DISTINCT FROM date_trunc('hour', ts) AS opens,
         coalesce((lag(user_id % 4) OVER w + 1) % 4, 0) AS expected
  FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)),
st AS MATERIALIZED (SELECT source, n, raw_ms, row_number() OVER (PARTITION BY source ORDER BY n) - 1 AS k FROM e WHERE opens),
{bump_sql('st', 'adj', 300)},
f AS (SELECT e.source, e.n, e.gpu, e.util, e.expected,
             last_value(adj.adjusted_ms IGNORE NULLS) OVER (PARTITION BY e.source ORDER BY e.n ROWS UNBOUNDED PRECEDING) AS stamp_ms
      FROM e LEFT JOIN st ON e.source = st.source AND e.n = st.n
             LEFT JOIN adj ON st.source = adj.source AND st.k = adj.k),
g AS (SELECT *, (sum((gpu - expected + 4) % 4 + 1) OVER w - 1) // 4 AS cycle,
             coalesce(lag(stamp_ms) OVER w <> stamp_ms, true) AS fresh
      FROM f WINDOW w AS (PARTITION BY source ORDER BY n ROWS UNBOUNDED PRECEDING)),
h AS MATERIALIZED (SELECT *, sum(fresh::int) OVER (PARTITION BY source ORDER BY n ROWS UNBOUNDED PRECEDING) - 1 AS t FROM g),
b AS (SELECT source, min(stamp_ms) AS lo, max(stamp_ms) AS hi, max(cycle) + 1 AS cycles, max(t) + 1 AS times FROM h GROUP BY source),
c AS (SELECT source, cycle AS position, """ + ", ".join(
    f"coalesce(max(CASE WHEN gpu = {i} THEN util END), 0) AS gpu{i}" for i in range(4)) + """
      FROM h GROUP BY source, cycle UNION ALL SELECT source, cycles, 0, 0, 0, 0 FROM b),
x AS (SELECT h.source, t AS position, (stamp_ms - lo) / 1000.0 AS t_s FROM h JOIN b ON h.source = b.source WHERE fresh
      UNION ALL SELECT source, times, CAST((hi - lo) // 1000 + 1 AS DOUBLE) FROM b)"""

GAP_SQL = f"""WITH {LOG_SQL},
rd AS (SELECT source, stamp_line, stamp_ms,
              coalesce(max(CASE WHEN gpu = 0 THEN util END), 0) AS gpu0,
              coalesce(max(CASE WHEN gpu = 1 THEN util END), 0) AS gpu1,
              coalesce(max(CASE WHEN gpu = 2 THEN util END), 0) AS gpu2,
              coalesce(max(CASE WHEN gpu = 3 THEN util END), 0) AS gpu3
       FROM f GROUP BY 1, 2, 3),
b AS (SELECT source, min(stamp_ms) AS lo, max(stamp_ms) AS hi FROM rd GROUP BY source)
SELECT rd.source, round((stamp_ms - lo) / 1000.0, 6) AS t_s, gpu0, gpu1, gpu2, gpu3
FROM rd JOIN b ON rd.source = b.source
UNION ALL
SELECT source, CAST((hi - lo) // 1000 + 1 AS DOUBLE), 0, 0, 0, 0 FROM b"""

SQL = {
    "stamp_bump_fine": f"""
WITH RECURSIVE st AS MATERIALIZED (
  SELECT event_type AS source, CAST(hour(ts) AS BIGINT) * 3600000 + user_id % 5 * 100 AS raw_ms,
         row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS k
  FROM events),
{bump_sql('st', 'adj', 300)}
SELECT source, k AS position, raw_ms, adjusted_ms FROM adj""",
    "gpu_cycle_fill": f"""
WITH RECURSIVE {HOURLY_SQL}
SELECT coalesce(x.source, c.source) AS source, CAST(coalesce(x.position, c.position) AS BIGINT) AS position,
       round(t_s, 6) AS t_s, gpu0, gpu1, gpu2, gpu3
FROM x FULL JOIN c ON x.source = c.source AND x.position = c.position""",
    "cpu_series": """
SELECT row_number() OVER (ORDER BY ts, event_id) - 1 AS position, round(value, 6) AS user_pct
FROM events WHERE event_type IS NULL OR event_type <> 'purchase'""",
    "stamp_bump": f"WITH {LOG_SQL}\nSELECT source, line_no, raw_ms, adjusted_ms FROM a",
    "log_forward_fill": f"WITH {LOG_SQL}\nSELECT source, line_no, gpu, util, stamp_ms FROM f",
    "gpu_gap_fill": GAP_SQL,
    "util_log_file": GAP_SQL,
    "field_log_series": """
WITH s AS (
  SELECT CASE event_type WHEN 'click' THEN 'eth0' ELSE 'eth1' END AS iface, ts, event_id,
         strftime(ts, '%H:%M:%S') AS time,
         value + CAST(json_extract_string(props, '$.k') AS DOUBLE) AS pkts
  FROM events WHERE event_type IN ('click', 'view'))
SELECT iface, row_number() OVER (PARTITION BY iface ORDER BY ts, event_id) - 1 AS position, time,
       round(pkts, 6) AS pkts
FROM s""",
}
