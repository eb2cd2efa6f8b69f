from pyspark.sql import functions as F

from tidepool.operators import runs as R
from tidepool.sources.tables import records


def test_kernel_mix_row(spark):
    df = spark.createDataFrame([(32, 2, 2, 0, 5, 12.5, 1000000003)],
                               "BS int, GPU int, TP int, PP int, Iterations int, pct double, t long")
    comm, total = R.kernel_totals("t", "Iterations", "pct")
    r = df.select(comm.alias("c"), total.alias("x")).first()
    assert (r.c, r.x) == (8000000024, 64000000192)


def test_run_record_derivations(spark):
    df = spark.createDataFrame([(1, 1, 16, 80.0, 100000), (2, 2, 1, 1.0, 1), (2, 1, 1, 1.0, 1),
                                (1, 2, 1, 1.0, 1)],
                               "tp int, pp int, batch int, lat double, tok long")
    out = df.select(R.parallelism_label("tp", "pp").alias("label"),
                    R.parallelism_class("tp", "pp").alias("cls"),
                    (F.col("tp") * F.col("pp")).alias("gpus"),
                    R.batch_adjusted_latency("lat", "batch").alias("adj"),
                    R.ms_per_token("lat", "tok").alias("ms")).collect()
    first = out[0]
    assert (first.label, first.cls, first.gpus, first.adj) == ("(1, 1)", "Baseline", 1, 20.0)
    assert round(first.ms, 6) == 0.8
    assert [r.cls for r in out[1:]] == ["TP + PP", "TP", "PP"]
    labels = spark.createDataFrame([("(1, 4)",), ("(4, 1)",), ("(1, 1)",), ("(2, 2)",)], "l string")
    assert [r.c for r in labels.select(R.class_by_label("l").alias("c")).collect()] == \
        ["PP", "TP", "Baseline", "TP + PP"]


def test_kernel_rollup_and_keep_last(spark):
    rows = [("r", 0, "moveKernel", 10.0, 100), ("r", 1, "foldKernel", 3.0, 30),
            ("r", 2, "gatherKernel", 0.7, 7), ("r", 3, "foldKernel", 0.0, 1)]
    df = spark.createDataFrame(rows, "run string, o int, name string, pct double, ns long")
    r = R.kernel_rollup(df, "run", "name", ["o"], "pct", "ns").first()
    assert r.kernels == "moveKernel|foldKernel|gatherKernel"
    assert round(r.total_pct, 6) == 13.7 and r.total_ns == 138
    last = R.keep_last(df, ["run"], ["o"], ["name"]).first()
    assert last.name == "foldKernel"


def test_stats_wide_fills_missing(spark):
    df = spark.createDataFrame([("(1, 4)", "qkv_compute", 1, 2.0), ("(1, 4)", "qkv_compute", 2, 4.0)],
                               "cfg string, stage string, layer int, us double")
    st = R.layer_stats(df, ["cfg", "stage"], "layer", "us")
    w = R.stats_wide(st, "cfg", "stage", ["qkv_compute", "mha_comm"]).first()
    assert (w.qkv_compute, w.qkv_compute_std, w.mha_comm, w.mha_comm_std) == (3.0, 1.0, 0.0, 0.0)


def test_records_with_their_schema(spark):
    rows = [{"model_name": "m", "tp_size": 2, "pp_size": 1, "batch_size": 16, "total_latency_s": 4.0,
             "token_per_second": float("nan")}, {"model_name": "n", "total_latency_s": 1.5}]
    got = records(spark, rows).orderBy("model_name").collect()
    assert (got[0].total_latency_s, got[0].token_per_second, got[0].num_layers) == (4.0, None, None)
    assert records(spark, rows).dropna(subset=["total_latency_s"]).count() == 2


def test_union_matches_names(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([("y", 2)], "v string, k int")
    assert sorted((r.k, r.v) for r in R.union_all([a, b]).collect()) == [(1, "x"), (2, "y")]
