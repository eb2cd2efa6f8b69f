import random
from collections import defaultdict

from pyspark.sql import functions as F

from tidepool.llm.exact_dedup import exact_dedup, mark_repeated, repeated_keys

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[(text or "").translate(LOW)].append(key)
    return {(k, t): (max(ks), len(ks)) for t, ks in groups.items() for k in ks}


def test_matches_brute_force(spark):
    rng = random.Random(3)
    texts = ["", None, "a", "A", "É", "é", "same length 1", "same length 2", "x" * 300 + "tail1",
             "x" * 300 + "tail2", "X" * 300 + "TAIL2", "z" * 50_000]
    rows = [(i, rng.choice(texts)) for i in range(300)] + [(1000, "alone")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = exact_dedup(df, carry={"t": F.coalesce("text", F.lit(""))}).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.keep_id, r.group_size) == want[(r.doc_id, r.t.translate(LOW))]
        assert r.kept == (r.doc_id == r.keep_id)


def test_narrow_bitmap_only_costs_work(spark):
    rows = [(i, f"text {i % 40}") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup(df, bits=32768).collect()}
    want = brute(rows)
    assert got == {k: want[(k, t)] for k, t in rows}


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    rows = [(1, "dup", "a"), (1, "dup", "b"), (None, "dup", "c"), (None, None, "d"), (None, "", "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, keep_id string")
    got = exact_dedup(df).collect()
    assert got[0].asDict().keys() == {"doc_id", "keep_id", "group_size", "kept"}
    dup = [r for r in got if r.group_size == 3]
    assert len(dup) == 3 and all(r.keep_id == 1 for r in dup) and sum(r.kept for r in dup) == 1
    empty = [r for r in got if r.group_size == 2]
    assert [r.keep_id for r in empty] == [None, None] and sum(r.kept for r in empty) == 1


def test_very_long_texts_that_differ_at_their_end(spark):
    long = "Lorem é " * 250_000
    rows = [(1, long + "a"), (2, long + "A"), (3, long + "b"), (4, long + "a" * 2), (5, long.lower() + "a")]
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in
           exact_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (5, 3, False), 2: (5, 3, False), 5: (5, 3, True), 3: (3, 1, True), 4: (4, 1, True)}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup(df).collect() == []


def test_bitmap_has_no_false_misses(spark):
    df = spark.range(4000).select((F.col("id") % 2500).alias("k"))
    slices = repeated_keys(df, ["k"], 1 << 16)
    assert slices.count() <= 2
    hit = {r.k for r in mark_repeated(df, slices, ["k"], "f", 1 << 16).where("f").collect()}
    assert set(range(1500)) <= hit
    assert len(hit) < 1700
