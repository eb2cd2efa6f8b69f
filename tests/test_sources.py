import pytest
from pyspark.sql import functions as F

from tidepool.functions.scalar import zip_sum
from tidepool.operators.runs import minutes_excluding
from tidepool.operators.sampling import sample_rows
from tidepool.operators.sorting import first_rows, ranks_by_id
from tidepool.sources.csv import read_csv_typed
from tidepool.sources.sinks import write_lines
from tidepool.sources.text import parse_kernel_summary, scan_documents, scan_text

KERNEL_TXT = (
    "      6.5           400000        200     2000.0     1900.5      1500      9000        310.2  "
    "moveKernel_Sum_wide(Comm *, unsigned long, Work *)   \n"
    "      4.25          250000        500      500.0      480.0       300      2500         75.0  "
    "void lib::deep::foldKernel<half, (int)4, (bool)0>(x, y\n"
    "      1.25           50000        100      500.0      510.0       400       900         20.9  "
    "gatherKernel_narrow(Comm *, unsigned long)\n")


def test_kernel_summary_parse(spark, tmp_path):
    p = tmp_path / "bs32_tp2_ite5.txt"
    p.write_text(KERNEL_TXT)
    lines = spark.read.text(str(p)).select(F.col("_metadata.file_path").alias("file"), "value")
    rows = parse_kernel_summary(lines).collect()
    assert [r.kernel for r in rows] == ["moveKernel_Sum_wide", "foldKernel", "gatherKernel_narrow"]
    assert rows[1].name == "void lib::deep::foldKernel<half, (int)4, (bool)0>(x, y"
    assert round(sum(r.pct for r in rows), 6) == 12.0
    assert sum(r.total_ns for r in rows) == 700000
    assert {(r.bs, r.tp, r.pp, r.ite) for r in rows} == {(32, 2, 0, 5)}


def test_min_partitions(spark, tmp_path):
    p = tmp_path / "big.txt"
    p.write_text("\n".join("x" * 100 for _ in range(40000)))
    assert scan_text(spark, str(p), min_partitions=3).rdd.getNumPartitions() >= 3


def test_typed_csv_modes(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("BS,Throughput\n32,1.5\nx,2.0\n64,3.0\n")
    schema = "BS int, Throughput double"
    assert len(read_csv_typed(spark, str(p), schema, mode="drop").collect()) == 2
    with pytest.raises(Exception):
        read_csv_typed(spark, str(p), schema).collect()


def test_whole_documents_and_request_sink(spark, tmp_path):
    (tmp_path / "doc.txt").write_text("one two\nthree  four\n")
    docs = scan_documents(spark, str(tmp_path / "doc.txt")).collect()
    assert len(docs) == 1 and docs[0].text == "one two\nthree  four\n"
    reqs = spark.createDataFrame([("a b c",), ("d e",)], "value string")
    out = tmp_path / "requests"
    write_lines(reqs, str(out))
    lines = sorted(line for f in out.glob("part-*") for line in f.read_text().splitlines())
    assert lines == ["a b c", "d e"]


def test_small_operators(spark):
    ranks = spark.createDataFrame([("10", 0.5), ("9", 0.2), ("10", 0.1)], "id string, rank double")
    assert [(r.id, r.rank) for r in ranks_by_id(ranks).collect()] == [("10", 0.1), ("10", 0.5), ("9", 0.2)]
    assert first_rows(spark.range(100), 5).count() == 5
    df = spark.createDataFrame([([10, 20], [3, 4], 720.0, 120.0)], "a array<int>, b array<int>, t double, o double")
    r = df.select(zip_sum("a", "b").alias("s"), minutes_excluding("t", "o").alias("m")).first()
    assert r.s == [13, 24] and r.m == 10.0
    s1 = [r.id for r in sample_rows(spark.range(1000), "id", 10, seed=3).collect()]
    s2 = [r.id for r in sample_rows(spark.range(1000).repartition(7), "id", 10, seed=3).collect()]
    assert s1 == s2 and len(set(s1)) == 10
