import random

import pytest
from tidepool.operators import logs as L
from tidepool.operators.ordered import with_ordinal
from tidepool.sources.text import field, field_lines, lines_by_token, scan_lines

UTIL_LOG = """node1 Thu Apr 18 10:00:01 2024
[0] root, 10 %, x
[1] root, 20 %, x
node1 Thu Apr 18 10:00:01 2024
[0] root, 30 %, x
[3] root, 5 %, x
node1 Thu Apr 18 10:00:02 2024
[2] root, 7 %, x
"""


def test_stamp_parity(spark):
    raw = [1000, 1000, 1000, 1000, 2000, 2000, 3000, 4000, 4000, 4000]
    df = spark.createDataFrame([("s", i, v) for i, v in enumerate(raw)], "source string, pos long, raw_ms long")
    got = [r.adjusted_ms for r in L.bump_equal_stamps(df, "source", "raw_ms", "pos").orderBy("pos").collect()]
    assert got == [1000, 1300, 1000, 1300, 2000, 2300, 3000, 4000, 4300, 4000]
    zeros = spark.createDataFrame([("s", 0, 0), ("s", 1, 0), ("s", 2, 0)], "source string, pos long, raw_ms long")
    got = [r.adjusted_ms for r in L.bump_equal_stamps(zeros, "source", "raw_ms", "pos").orderBy("pos").collect()]
    assert got == [300, 0, 300]


def test_util_log_gap_fill(spark, tmp_path):
    p = tmp_path / "a.stats.log"
    p.write_text(UTIL_LOG)
    lines = scan_lines(spark, str(p))
    assert [r.line_no for r in lines.orderBy("line_no").collect()] == list(range(8))
    o = with_ordinal(lines.withColumnRenamed("file", "source"), ["source", "line_no"], "pos")
    parsed = L.parse_util_lines(o)
    samples = L.stamped_samples(parsed)
    got = sorted((r.t_s, r.gpu0, r.gpu1, r.gpu2, r.gpu3) for r in L.gap_fill(samples).collect())
    assert got == [(0.0, 10, 20, 0, 0), (0.3, 30, 0, 0, 5), (1.0, 0, 0, 7, 0), (2.0, 0, 0, 0, 0)]


def test_scan_lines_many_splits_and_files(spark, tmp_path):
    # small split size: each file is read by several tasks
    for name, n in (("a.log", 30000), ("b.log", 17000)):
        (tmp_path / name).write_text("".join(f"{name}:{i:06d}\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 2
        rows = scan_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    by_file = {}
    for r in rows:
        by_file.setdefault(r.file.rsplit("/", 1)[-1], []).append((r.line_no, r.value))
    for name, n in (("a.log", 30000), ("b.log", 17000)):
        got = sorted(by_file[name])
        assert [ln for ln, _ in got] == list(range(n))
        assert [v for _, v in got] == [f"{name}:{i:06d}" for i in range(n)]


def parsed_log(spark, rows):
    o = with_ordinal(spark.createDataFrame(rows, "source string, n int, value string"), ["source", "n"], "pos")
    return L.parse_util_lines(o)


def carried(parsed):
    return L.stamped_samples(parsed)


def test_null_source_keeps_stamps_and_rounds(spark):
    rows = [(s, i, v) for s in (None, "a") for i, v in enumerate(
        ["node1 Thu Apr 18 10:00:01 2024", "[0] root, 10 %, x", "node1 Thu Apr 18 10:00:05 2024", "[1] root, 7 %, x"])]
    samples = carried(parsed_log(spark, rows))
    assert all(r.stamp_ms is not None for r in samples.collect())
    got = sorted((r.source or "", r.t_s, r.gpu0, r.gpu1) for r in L.gap_fill(samples).collect())
    assert got == [(s, *x) for s in ("", "a") for x in [(0.0, 10, 0), (4.0, 0, 7), (5.0, 0, 0)]]


def test_line_with_both_tokens_is_a_stamp_and_a_sample(spark):
    rows = [("a", 0, "[2] node1 root 18 10:00:01 2024, 44 %, x")]
    r = parsed_log(spark, rows).first()
    assert (r.kind, r.raw_ms, r.gpu, r.util) == ("both", 36001000, 2, 44)
    assert [(x.stamp_ms, x.util) for x in carried(parsed_log(spark, rows)).collect()] == [(36001000, 44)]


def test_sample_above_the_first_stamp_raises(spark):
    rows = [("a", 0, "[0] root, 10 %, x"), ("a", 1, "node1 Thu Apr 18 10:00:01 2024")]
    with pytest.raises(Exception, match="no stamp above"):
        carried(parsed_log(spark, rows)).collect()


def test_all_white_space_is_stripped(spark):
    lines = spark.createDataFrame([("\t10:00 eth0 7 1.5\u00a02.5\n",)], "value string")
    r = field_lines(lines, "eth0").select(field(0).alias("a"), field(3, "double").alias("b"),
                                          field(4, "double").alias("c")).first()
    assert (r.a, r.b, r.c) == ("10:00", 1.5, 2.5)


def test_line_with_two_interfaces_counts_for_both(spark):
    lines = spark.createDataFrame([("t eth0 eth1 1 2",), ("t eth1 x 3 4",), ("t lo x 5 6",)], "value string")
    got = sorted((r.iface, r.fields[3]) for r in lines_by_token(lines, ("eth0", "eth1"), "iface").collect())
    assert got == [("eth0", "1"), ("eth1", "1"), ("eth1", "3")]


def test_strict_mode_does_not_rest_on_ansi(spark):
    from tidepool.sources.text import parse_edges
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        short = spark.createDataFrame([("lonely",)], "value string")
        with pytest.raises(Exception, match="fewer than two"):
            parse_edges(short).collect()
        with pytest.raises(Exception, match="no field 4"):
            field_lines(short, "lon").select(field(4)).collect()
        with pytest.raises(Exception, match="not a double"):
            field_lines(short, "lon").select(field(0, "double")).collect()
        assert field_lines(short, "lon").select(field(0, "double", mode="drop").alias("x")).first().x is None
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("step", [0, 100, 300, 1000])
def test_any_step_and_grain_equal_the_literal_loop(spark, step):
    rng = random.Random(step)
    rows = [(s, i, rng.randrange(5) * 100) for s in ("a", "b", None) for i in range(300)]
    df = spark.createDataFrame(rows, "source string, pos long, raw_ms long").repartition(5)
    got = {(r.source, r.pos): (r.adjusted_ms, r.k) for r in L.bump_equal_stamps(
        df, "source", "raw_ms", "pos", step=step, index="k").collect()}
    want, before = {}, {}
    for s, i, raw in rows:
        ts = raw + step if raw == before.get(s, 0) else raw
        before[s] = ts
        want[s, i] = (ts, i)
    assert got == want


def literal_cycle(samples, gpus=4):
    """(times, one list per GPU) as a reader makes them who expects the GPUs in turn."""
    times, lists, turn, at = [], [[] for _ in range(gpus)], 0, 0
    while at < len(samples):
        ms, gpu, util = samples[at]
        if not times or times[-1] != ms:
            times.append(ms)
        lists[turn].append(util if gpu == turn else 0)
        at += gpu == turn
        turn = (turn + 1) % gpus
    for g in range(turn, gpus) if turn else ():
        lists[g].append(0)
    low, high = min(times), max(times)
    return [(t - low) / 1000 for t in times] + [(high - low) // 1000 + 1], [x + [0] for x in lists]


@pytest.mark.parametrize("seed", range(3))
def test_cycle_fill_equals_the_literal_loop(spark, seed):
    rng = random.Random(seed)
    rows, want = [], {}
    for source in ("a", "b", None):
        ms, own = rng.randrange(5) * 1000, []
        for i in range(rng.choice([1, 7, 200])):
            if rng.random() < 0.4:
                ms = rng.randrange(86400) * 1000
            own.append((ms, rng.randrange(4), rng.randrange(1, 100)))
            rows.append((source, 3 * i, *own[-1]))
        want[source] = literal_cycle(own)
    df = spark.createDataFrame(rows, "source string, pos long, stamp_ms long, gpu int, util long").repartition(4)
    got = L.gpu_cycle_fill(df).collect()
    for source, (times, lists) in want.items():
        mine = sorted((r for r in got if r.source == source), key=lambda r: r.position)
        assert [r.position for r in mine] == list(range(max(len(times), len(lists[0]))))
        assert [r.t_s for r in mine if r.t_s is not None] == times
        for g in range(4):
            assert [r[f"gpu{g}"] for r in mine if r[f"gpu{g}"] is not None] == lists[g]


def test_cycle_fill_of_no_such_gpu_raises(spark):
    df = spark.createDataFrame([("a", 0, 0, 4, 1)], "source string, pos long, stamp_ms long, gpu int, util long")
    with pytest.raises(Exception, match="no such GPU: 4"):
        L.gpu_cycle_fill(df).collect()
    assert L.gpu_cycle_fill(df.where("pos > 0")).count() == 0


@pytest.mark.parametrize("line", ["node1 Thu Apr 18", "node1 Thu Apr 18 10:x:01 2024", "[x] root, 10 %, x", "[0] root", "[0] root, , x"])
def test_bad_fields_raise(spark, line):
    with pytest.raises(Exception, match="no (time|GPU|share)"):
        parsed_log(spark, [("a", 0, line)]).collect()
