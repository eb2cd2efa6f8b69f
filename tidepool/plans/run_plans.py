"""Serving-run analytics over records derived from the driver tables.

``lineitem`` rows stand in for serving runs and kernel summaries, ``events``
for kernel-summary lines, ``orders`` for latency/throughput points. The
derivations are fixed CASE mappings of non-key columns, so every row of the
table takes part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import runs as R
from ..operators.ordered import with_ordinal
from ..operators.sorting import sort_with_position
from ..session import materialize, remove_path, scratch_path
from ..sources.csv import read_csv_typed
from ..sources.sinks import write_csv
from ..sources.tables import table
from ..sources.text import parse_kernel_summary

LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def r6(c, name: str | None = None):
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, 6).alias(name) if name else F.round(c, 6)


def run_records(spark, sf_dir, failed=None) -> DataFrame:
    """One serving-run record per lineitem row; rows that are ``failed`` have null measures."""
    li = table(spark, sf_dir, "lineitem")
    measured = ~failed if failed is not None else F.lit(True)
    q, d, n = F.col("l_quantity"), F.col("l_discount"), F.col("l_linenumber")
    return li.select(
        F.col("l_returnflag").alias("model_name"),
        F.when((n - 1) % 3 == 0, 1).when((n - 1) % 3 == 1, 2).otherwise(4).alias("tp_size"),
        F.when(d < 0.04, 1).when(d < 0.07, 2).otherwise(4).alias("pp_size"),
        F.when(q <= 12, 1).when(q <= 25, 16).when(q <= 38, 32).otherwise(64).alias("batch_size"),
        F.when(F.col("l_linestatus") == "O", 128).otherwise(2048).alias("input_length"),
        F.when(measured, F.col("l_extendedprice") / 100.0).alias("total_latency_s"),
        F.when(measured, q.cast("long") * 1000).alias("total_output_tokens"),
    ).withColumn("token_per_second", F.col("total_output_tokens") / F.col("total_latency_s"))


def run_summary(spark, sf_dir, model: str = "N", input_length: int = 2048):
    """Latency and throughput by batch size and parallelism class (GPU count 2 left out)."""
    d = run_records(spark, sf_dir)
    d = (d.withColumn("TP_PP", R.parallelism_label("tp_size", "pp_size"))
         .withColumn("parallelism_type", R.parallelism_class("tp_size", "pp_size"))
         .withColumn("num_GPU", F.col("tp_size") * F.col("pp_size"))
         # The per-token ratio comes from the unadjusted latency.
         .withColumn("average_latency_per_token_ms",
                     R.ms_per_token("total_latency_s", "total_output_tokens"))
         .drop("tp_size", "pp_size"))
    d = d.where((F.col("model_name") == model) & (F.col("input_length") == input_length))
    d = d.where(F.col("num_GPU") != 2)
    d = d.withColumn("total_latency_s", R.batch_adjusted_latency("total_latency_s", "batch_size"))
    g = d.groupBy("batch_size", "parallelism_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("total_latency_s").alias("latency_s"),
        F.avg("average_latency_per_token_ms").alias("ms_per_token"),
        F.avg("token_per_second").alias("tokens_per_s"))
    g = g.select("batch_size", "parallelism_type", "n", r6("latency_s", "latency_s"),
                 r6("ms_per_token", "ms_per_token"), r6("tokens_per_s", "tokens_per_s"))
    return sort_with_position(g, ["batch_size", "parallelism_type"])


def throughput_bars(spark, sf_dir, batch_size: int = 32, input_length: int = 2048):
    """Throughput by configuration and model for one batch size and input length.

    Runs without a throughput (a return flag R with a tax of zero stands for
    a failed run) have null measures and are dropped.
    """
    failed = (F.col("l_returnflag") == "R") & (F.col("l_tax") == 0)
    d = run_records(spark, sf_dir, failed)
    d = (d.withColumn("TP_PP", R.parallelism_label("tp_size", "pp_size"))
         .drop("tp_size", "pp_size", "total_output_tokens", "total_latency_s"))
    d = d.where((F.col("input_length") == input_length) & (F.col("batch_size") == batch_size)).dropna("any")
    g = d.groupBy("TP_PP", "model_name").agg(F.avg("token_per_second").alias("t"), F.count(F.lit(1)).alias("n"))
    return sort_with_position(g.select("TP_PP", "model_name", "n", r6("t", "tokens_per_s")),
                              ["TP_PP", "model_name"])


def latency_vs_throughput(spark, sf_dir, model: str = "N", input_length: int = 2048):
    """Mean adjusted latency at each throughput, a curve for each parallelism class."""
    d = run_records(spark, sf_dir)
    d = d.withColumn("parallelism_type", R.parallelism_class("tp_size", "pp_size"))
    d = d.where((F.col("model_name") == model) & (F.col("input_length") == input_length)
                & (F.col("tp_size") * F.col("pp_size") != 2))
    d = d.withColumn("total_latency_s", R.batch_adjusted_latency("total_latency_s", "batch_size"))
    g = d.groupBy("parallelism_type", F.round("token_per_second", 0).alias("tokens_per_s")).agg(
        F.avg("total_latency_s").alias("l"))
    return g.select("parallelism_type", "tokens_per_s", r6("l", "latency_s"))


def kernel_records(spark, sf_dir) -> DataFrame:
    """Communication-kernel summary rows (BS, TP, PP, Iterations, pct, time) from lineitem."""
    li = table(spark, sf_dir, "lineitem")
    q, d, n = F.col("l_quantity"), F.col("l_discount"), F.col("l_linenumber")
    return li.select(
        *LINE_ORDER,
        F.when(q <= 12, 8).when(q <= 25, 16).when(q <= 38, 32).otherwise(64).alias("BS"),
        F.when((n - 1) % 3 == 0, 0).when((n - 1) % 3 == 1, 2).otherwise(4).alias("TP"),
        F.when(d < 0.04, 2).when(d < 0.07, 3).otherwise(4).alias("PP"),
        (n * 5).alias("Iterations"),
        F.round(F.col("l_tax") * 100 + 1, 1).alias("CommKernelPct"),
        F.round(F.col("l_extendedprice") * 100000).cast("long").alias("CommKernelTime"))


def stored_kernel_records(spark, sf_dir) -> tuple[DataFrame, str]:
    """The kernel summary written as CSV and read back with its types, and its folder."""
    records = kernel_records(spark, sf_dir)
    path = scratch_path(spark, "kernel_csv")
    write_csv(records, path, header=True)
    return read_csv_typed(spark, path, records.schema), path


def _kernel_mix(spark, sf_dir, batch: int = 32) -> DataFrame:
    records, path = stored_kernel_records(spark, sf_dir)
    k = records.where(F.col("BS") == batch)  # P5 before P20
    comm_ns, total_ns = R.kernel_totals("CommKernelTime", "Iterations", "CommKernelPct")
    k = k.select(*LINE_ORDER, F.format_string("(TP=%d,PP=%d)", "TP", "PP").alias("label"),
                 comm_ns.alias("comm_ns"), total_ns.alias("total_ns"))
    last = materialize(R.keep_last(k, ["label"], LINE_ORDER, ["comm_ns", "total_ns"]))
    remove_path(spark, path)
    return last


def kernel_mix(spark, sf_dir):
    """Per configuration: communication and other kernel time (s), scaled to 40 iterations."""
    m = _kernel_mix(spark, sf_dir)
    return m.select("label", "comm_ns", "total_ns",
                    r6(F.col("comm_ns") / 1e9, "comm_s"),
                    r6((F.col("total_ns") - F.col("comm_ns")) / 1e9, "other_s"))


def pipeline_load(spark, sf_dir):
    """Pipeline-only configurations (label holds TP=0): load per pipeline GPU."""
    m = _kernel_mix(spark, sf_dir).where(F.col("label").contains("TP=0"))
    inner = F.expr("substring(label, 2, length(label) - 2)")
    pp = F.split(F.split(inner, ",").getItem(1), "=").getItem(1)
    return m.select(pp.alias("pp"),
                    r6((F.col("total_ns") - F.col("comm_ns")) / 1e9, "other_s"),
                    r6(F.col("comm_ns") / 1e9, "comm_s"),
                    r6(F.col("comm_ns") / 1e9 / pp.cast("int"), "per_gpu_s"))


def kernel_lines(spark, sf_dir) -> DataFrame:
    """Kernel-summary text rows rendered from events, one file per event type.

    Each event is a row ``pct total instances avg med min max stddev name``;
    the kernel name is a qualified template function built from the event's
    ``k`` property. (ts, event_id) is the row's place in its file.
    """
    ev = table(spark, sf_dir, "events")
    ns = F.round(F.col("value") * 1e6).cast("long")
    name = F.concat(F.lit("void lib::kernels::kernel_"), F.get_json_object("props", "$.k"),
                    F.lit("<__half, (int)2>(float *, unsigned long)"))
    text = F.concat_ws("  ", F.col("value").cast("string"), ns.cast("string"), F.lit("1"),
                       ns.cast("string"), ns.cast("string"), ns.cast("string"), ns.cast("string"),
                       F.lit("0.0"), name)
    return ev.select(F.concat(F.lit("/runs/"), F.col("event_type"), F.lit("_bs32_ite5.txt"))
                     .alias("file"), "ts", "event_id", text.alias("value"))


def kernel_rollup(spark, sf_dir):
    """Per run: total share, total time, kernel names in order of first appearance."""
    rows = parse_kernel_summary(kernel_lines(spark, sf_dir))
    rows = rows.withColumn("run", F.regexp_extract("file", r"([^/_]+)_[^/]*$", 1))
    k = R.kernel_rollup(rows, "run", "kernel", ["ts", "event_id"], "pct", "total_ns")
    return k.select("run", r6("total_pct", "total_pct"), "total_ns", "kernels")


def last_per_key(spark, sf_dir):
    """Latest event of each type (later rows replace earlier ones)."""
    ev = table(spark, sf_dir, "events")
    return R.keep_last(ev, ["event_type"], ["ts", "event_id"], ["event_id", "user_id", "value"])


def latency_curve(spark, sf_dir):
    """Orders as (throughput, latency, batch) points in file (order key) order."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("throughput"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("batch"))
    pts = with_ordinal(o, ["o_orderkey"], "position")
    return pts.select("position", "throughput",
                      r6(F.col("batch") * 1000.0 / F.col("throughput"), "latency_s"), "batch")


# Stage names in the order of the reference's wide table.
STAGES = ["qkv_compute", "mha_compute", "ffn_compute", "qkv_comm", "mha_comm", "ffn_comm"]


def _stage_rows(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    tax, disc = F.col("l_tax"), F.col("l_discount")
    part = F.when(tax < 0.03, "qkv").when(tax < 0.06, "mha").otherwise("ffn")
    # Configurations of one tensor shard compute only: all their rows are compute stages.
    alone = (F.col("l_returnflag") == "A") | ((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"))
    kind = F.when(alone | (disc < 0.05), "compute").otherwise("comm")
    return li.select("l_returnflag", "l_linestatus",
                     F.concat(part, F.lit("_"), kind).alias("stage"),
                     F.col("l_linenumber").alias("layer"),
                     (F.col("l_extendedprice") / 1000.0).alias("us"))


def stage_stats(spark, sf_dir):
    """Mean and population std of per-layer kernel time for four configurations, wide.

    The reference builds one frame per configuration and concatenates them;
    here one scan tags each row with its configuration (a CASE over the
    same predicates), so the table is read once instead of four times.
    """
    rows = _stage_rows(spark, sf_dir)
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    config = (F.when(flag == "A", "(1, 4)").when(flag == "R", "(2, 2)")
              .when(status == "O", "(4, 1)").otherwise("(1, 1)"))
    tagged = rows.withColumn("TP_PP", config)
    st = R.layer_stats(tagged, ["TP_PP", "stage"], "layer", "us")
    wide = R.stats_wide(st, "TP_PP", "stage", STAGES)
    out = [F.col("TP_PP"), R.class_by_label("TP_PP").alias("parallelism_type")]
    for s in STAGES:
        out += [r6(s, s), r6(f"{s}_std", f"{s}_std")]
    return sort_with_position(wide.select(*out), ["TP_PP"])


def stage_share_union(spark, sf_dir):
    """One frame of stage shares for each line status and return flag, united and sorted."""
    rows = _stage_rows(spark, sf_dir)
    frames = [_shares(rows.where(where), name) for name, where in (
        ("(1, 4)", F.col("l_returnflag") == "A"), ("(2, 2)", F.col("l_returnflag") == "R"),
        ("(4, 1)", (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O")),
        ("(1, 1)", (F.col("l_returnflag") == "N") & (F.col("l_linestatus") != "O")))]
    return sort_with_position(R.union_all(frames), ["TP_PP", "stage"])


def _shares(rows: DataFrame, name: str) -> DataFrame:
    """Share of each stage in the time of one configuration; at most one row a stage."""
    per_stage = rows.groupBy("stage").agg(F.sum("us").alias("us")).withColumn("TP_PP", F.lit(name))
    whole = F.sum("us").over(Window.partitionBy("TP_PP"))
    return per_stage.select("TP_PP", "stage", r6(F.col("us") / whole, "share"))


def minutes_without_output(spark, sf_dir) -> DataFrame:
    """Minutes of each order as a run, without its open lines as the output phase; quantities are seconds."""
    seconds = F.col("l_quantity").cast("double")
    runs = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.sum(seconds).alias("total_s"),
        F.sum(F.when(F.col("l_linestatus") == "O", seconds).otherwise(0.0)).alias("output_s"))
    return runs.select("l_orderkey", "total_s", "output_s",
                       r6(R.minutes_excluding("total_s", "output_s"), "minutes"))


QUERIES = {
    "minutes_without_output": minutes_without_output,
    "throughput_bars": throughput_bars,
    "latency_vs_throughput": latency_vs_throughput,
    "stage_share_union": stage_share_union,
    "run_summary": run_summary,
    "kernel_mix": kernel_mix,
    "pipeline_load": pipeline_load,
    "kernel_rollup": kernel_rollup,
    "last_per_key": last_per_key,
    "latency_curve": latency_curve,
    "stage_stats": stage_stats,
}

RUNS_SQL = """runs AS (
  SELECT l_returnflag AS model_name,
         CASE (l_linenumber - 1) % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 4 END AS tp_size,
         CASE WHEN l_discount < 0.04 THEN 1 WHEN l_discount < 0.07 THEN 2 ELSE 4 END AS pp_size,
         CASE WHEN l_quantity <= 12 THEN 1 WHEN l_quantity <= 25 THEN 16 WHEN l_quantity <= 38 THEN 32
              ELSE 64 END AS batch_size,
         CASE WHEN l_linestatus = 'O' THEN 128 ELSE 2048 END AS input_length,
         l_extendedprice / 100.0 AS total_latency_s,
         CAST(l_quantity AS BIGINT) * 1000 AS total_output_tokens, l_tax AS tax
  FROM lineitem)"""

KERNEL_SQL = """k AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CASE WHEN l_quantity <= 12 THEN 8 WHEN l_quantity <= 25 THEN 16 WHEN l_quantity <= 38 THEN 32
              ELSE 64 END AS BS,
         CASE (l_linenumber - 1) % 3 WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 4 END AS TP,
         CASE WHEN l_discount < 0.04 THEN 2 WHEN l_discount < 0.07 THEN 3 ELSE 4 END AS PP,
         l_linenumber * 5 AS Iterations,
         round(l_tax * 100 + 1, 1) AS CommKernelPct,
         CAST(round(l_extendedprice * 100000) AS BIGINT) AS CommKernelTime
  FROM lineitem),
m AS (
  SELECT printf('(TP=%d,PP=%d)', TP, PP) AS label,
         arg_max(CAST(trunc(CommKernelTime * 40 / Iterations) AS BIGINT),
                 (l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS comm_ns,
         arg_max(CAST(trunc(CommKernelTime * 40 / Iterations * 100.0 / CommKernelPct) AS BIGINT),
                 (l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS total_ns
  FROM k WHERE BS = 32 GROUP BY 1)"""

STAGE_SQL = """rows AS (
  SELECT l_returnflag, l_linestatus,
         CASE WHEN l_tax < 0.03 THEN 'qkv' WHEN l_tax < 0.06 THEN 'mha' ELSE 'ffn' END || '_' ||
         CASE WHEN l_returnflag = 'A' OR (l_returnflag = 'N' AND l_linestatus = 'F') OR l_discount < 0.05
              THEN 'compute' ELSE 'comm' END AS stage,
         l_linenumber AS layer, l_extendedprice / 1000.0 AS us
  FROM lineitem),
u AS (
  SELECT CASE l_returnflag WHEN 'A' THEN '(1, 4)' WHEN 'R' THEN '(2, 2)'
         ELSE CASE l_linestatus WHEN 'O' THEN '(4, 1)' ELSE '(1, 1)' END END AS TP_PP, * FROM rows),
pl AS (SELECT TP_PP, stage, layer, sum(us) AS v FROM u GROUP BY 1, 2, 3),
st AS (SELECT TP_PP, stage, avg(v) AS m, stddev_pop(v) AS s FROM pl GROUP BY 1, 2)"""


def _stage_select() -> str:
    cols = []
    for s in STAGES:
        cols.append(f"round(coalesce(max(CASE WHEN stage = '{s}' THEN m END), 0.0), 6) AS {s}")
        cols.append(f"round(coalesce(max(CASE WHEN stage = '{s}' THEN s END), 0.0), 6) AS {s}_std")
    return ",\n       ".join(cols)


SQL = {
    "minutes_without_output": """
WITH r AS (SELECT l_orderkey, sum(CAST(l_quantity AS DOUBLE)) AS total_s,
                  sum(CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS DOUBLE) ELSE 0.0 END) AS output_s
           FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, total_s, output_s, round((total_s - output_s) / 60.0, 6) AS minutes FROM r""",
    "run_summary": f"""WITH {RUNS_SQL},
d AS (
  SELECT batch_size,
         CASE WHEN tp_size > pp_size THEN 'TP' WHEN pp_size > tp_size THEN 'PP'
              WHEN tp_size = 1 AND pp_size = 1 THEN 'Baseline' ELSE 'TP + PP' END AS parallelism_type,
         total_latency_s / total_output_tokens * 1e3 AS ms,
         total_output_tokens / total_latency_s AS tps,
         CASE batch_size WHEN 1 THEN total_latency_s / 64.0 WHEN 16 THEN total_latency_s / 4.0
              WHEN 32 THEN total_latency_s / 2.0 ELSE total_latency_s END AS lat
  FROM runs
  WHERE model_name = 'N' AND input_length = 2048 AND tp_size * pp_size <> 2)
SELECT row_number() OVER (ORDER BY batch_size, parallelism_type) - 1 AS position, *
FROM (SELECT batch_size, parallelism_type, count(*) AS n, round(avg(lat), 6) AS latency_s,
             round(avg(ms), 6) AS ms_per_token, round(avg(tps), 6) AS tokens_per_s
      FROM d GROUP BY 1, 2) t""",
    "throughput_bars": f"""WITH {RUNS_SQL},
d AS (SELECT printf('(%d, %d)', tp_size, pp_size) AS TP_PP, model_name, total_output_tokens / total_latency_s AS t
      FROM runs WHERE batch_size = 32 AND input_length = 2048 AND NOT (model_name = 'R' AND tax = 0))
SELECT row_number() OVER (ORDER BY TP_PP, model_name) - 1 AS position, *
FROM (SELECT TP_PP, model_name, count(*) AS n, round(avg(t), 6) AS tokens_per_s FROM d GROUP BY 1, 2) x""",
    "latency_vs_throughput": f"""WITH {RUNS_SQL},
d AS (SELECT CASE WHEN tp_size > pp_size THEN 'TP' WHEN pp_size > tp_size THEN 'PP'
                  WHEN tp_size = 1 AND pp_size = 1 THEN 'Baseline' ELSE 'TP + PP' END AS parallelism_type,
             round(total_output_tokens / total_latency_s, 0) AS tokens_per_s,
             CASE batch_size WHEN 1 THEN total_latency_s / 64.0 WHEN 16 THEN total_latency_s / 4.0
                  WHEN 32 THEN total_latency_s / 2.0 ELSE total_latency_s END AS lat
      FROM runs WHERE model_name = 'N' AND input_length = 2048 AND tp_size * pp_size <> 2)
SELECT parallelism_type, tokens_per_s, round(avg(lat), 6) AS latency_s FROM d GROUP BY 1, 2""",
    "stage_share_union": f"""WITH {STAGE_SQL},
g AS (SELECT TP_PP, stage, sum(us) AS us FROM u GROUP BY 1, 2)
SELECT row_number() OVER (ORDER BY TP_PP, stage) - 1 AS position, TP_PP, stage,
       round(us / sum(us) OVER (PARTITION BY TP_PP), 6) AS share FROM g""",
    "kernel_mix": f"""WITH {KERNEL_SQL}
SELECT label, comm_ns, total_ns, round(comm_ns / 1e9, 6) AS comm_s,
       round((total_ns - comm_ns) / 1e9, 6) AS other_s
FROM m""",
    "pipeline_load": f"""WITH {KERNEL_SQL},
p AS (SELECT *, split_part(split_part(label[2:-2], ',', 2), '=', 2) AS pp FROM m WHERE label LIKE '%TP=0%')
SELECT pp, round((total_ns - comm_ns) / 1e9, 6) AS other_s, round(comm_ns / 1e9, 6) AS comm_s,
       round(comm_ns / 1e9 / CAST(pp AS INTEGER), 6) AS per_gpu_s
FROM p""",
    "kernel_rollup": """
WITH k AS (SELECT event_type AS run, ts, event_id,
                  'kernel_' || json_extract_string(props, '$.k') AS name, value AS pct,
                  CAST(round(value * 1e6) AS BIGINT) AS time_ns FROM events),
n AS (SELECT run, name, min((ts, event_id)) AS first, sum(pct) AS pct, sum(time_ns) AS ns
      FROM k GROUP BY run, name)
SELECT run, round(sum(pct), 6) AS total_pct, CAST(sum(ns) AS BIGINT) AS total_ns,
       string_agg(name, '|' ORDER BY first) AS kernels
FROM n GROUP BY run""",
    "last_per_key": """
SELECT event_type, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(user_id, (ts, event_id)) AS user_id,
       arg_max(value, (ts, event_id)) AS value
FROM events GROUP BY event_type""",
    "latency_curve": """
SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS position, o_totalprice AS throughput,
       round(CAST(substring(o_orderpriority, 1, 1) AS INTEGER) * 1000.0 / o_totalprice, 6) AS latency_s,
       CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS batch
FROM orders""",
    "stage_stats": f"""WITH {STAGE_SQL}
SELECT row_number() OVER (ORDER BY TP_PP) - 1 AS position, TP_PP,
       CASE TP_PP WHEN '(1, 4)' THEN 'PP' WHEN '(4, 1)' THEN 'TP' WHEN '(1, 1)' THEN 'Baseline'
            ELSE 'TP + PP' END AS parallelism_type,
       {_stage_select()}
FROM st GROUP BY TP_PP""",
}
