import random
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidepool.functions.scalar import md5_unit
from tidepool.operators import sampling as X
from tidepool.sources.text import joined_runs, scan_document_chunks, scan_edges, scan_lines, scan_text


@pytest.mark.parametrize("n", [1, 7, 10, 64])
def test_minimum_splits_without_an_exchange(spark, tmp_path, n):
    for name, rows in (("a.txt", 3000), ("b.txt", 10)):
        (tmp_path / name).write_text("# comment\n" + "".join(f"{name}{i}\t{i}\tmore\n" for i in range(rows)))
    df = scan_text(spark, str(tmp_path), min_partitions=n)
    assert df.rdd.getNumPartitions() >= n
    edges = scan_edges(spark, str(tmp_path), min_partitions=n)
    assert "Exchange" not in edges._jdf.queryExecution().executedPlan().toString()
    got = sorted((r.src, r.dst) for r in edges.collect())
    assert got == sorted((f"{name}{i}", str(i)) for name, k in (("a.txt", 3000), ("b.txt", 10)) for i in range(k))


def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")


def whole_splits(spark):
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_lines_of_several_files_are_numbered_as_one_text(spark, tmp_path):
    want = {}
    for folder in ("x", "y"):
        (tmp_path / f"k={folder}").mkdir()
        for part in range(3):
            own = [f"{folder}{part}-{i}" for i in range(random.Random(part).randint(0, 1500))]
            want.setdefault(folder, []).extend(own)
            (tmp_path / f"k={folder}" / f"part-{part}.txt").write_text("".join(v + "\n" for v in own))
    small_splits(spark)
    try:
        rows = scan_lines(spark, str(tmp_path), by=("k",)).collect()
    finally:
        whole_splits(spark)
    for folder, lines in want.items():
        assert [r.value for r in sorted((r for r in rows if r.k == folder), key=lambda r: r.line_no)] == lines
        assert sorted(r.line_no for r in rows if r.k == folder) == list(range(len(lines)))


def document(seed, n):
    rng = random.Random(seed)
    return "".join(rng.choice(["a", "word", "\u00e9t\u00e9", "x" * rng.randint(1, 300)]) + rng.choice([" ", " ", "  ", "\n", " \t", "\u00a0", "\r\n "])
                   for _ in range(n))


@pytest.mark.parametrize("chunk", [1, 50, 10_000])
def test_chunks_hold_the_words_of_the_whole_document(spark, tmp_path, chunk):
    texts = {"a.txt": document(1, 4000), "b.txt": document(2, 30), "c.txt": ""}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    small_splits(spark)
    try:
        rows = scan_document_chunks(spark, str(tmp_path), chunk_chars=chunk).collect()
    finally:
        whole_splits(spark)
    assert max(len(r.text) for r in rows) <= chunk + 1200
    assert len({r.split for r in rows}) > 3
    for name, text in texts.items():
        own = sorted((r for r in rows if r.part.endswith(name)), key=lambda r: (r.split, r.chunk))
        assert [w for r in own for w in r.text.split()] == text.split()
        assert all(r.n_words == len(r.text.split()) for r in own)


def test_windows_of_chunked_documents(spark, tmp_path):
    words = {}
    for lang in ("de", "fr"):
        (tmp_path / f"lang={lang}").mkdir()
        texts = [document(len(lang) + i, 700) for i in range(3)]
        words[lang] = [w for t in texts for w in t.split()]
        for i, t in enumerate(texts):
            (tmp_path / f"lang={lang}" / f"part-{i}.txt").write_bytes(t.encode())
    rows = [(i, "de" if i % 3 else "fr", 1 + i % 150) for i in range(300)] + [(900, "de", len(words["de"])), (901, "de", len(words["de"]) - 1), (902, "it", 3)]
    requests = spark.createDataFrame(rows, "req long, lang string, n int").withColumn("u", md5_unit("5", "req"))
    small_splits(spark)
    try:
        scan_document_chunks(spark, str(tmp_path), by=("lang",), chunk_chars=200).write.parquet(str(tmp_path / "chunks"))
    finally:
        whole_splits(spark)
    chunks = spark.read.parquet(str(tmp_path / "chunks"))
    units = {r.req: r.u for r in requests.collect()}
    for block in (16, 4096):
        got = {r.req: (r.start, r.window) for r in X.chunk_windows(chunks, requests, ["lang"], "req", "n", "u", block_words=block).collect()}
        want = {}
        for req, lang, n in rows:
            own = words.get(lang, [])
            if n < len(own):
                start = int(units[req] * (len(own) - n + 1))
                want[req] = (start, " ".join(own[start:start + n]))
        assert got == want


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 10, 17, 1000, 4097])
@pytest.mark.parametrize("seed", [0, 9])
def test_feistel_is_a_seeded_permutation_without_exchange(spark, n, seed):
    df = X.feistel_positions(spark.range(n), "id", n, seed)
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    got = [r.perm_pos for r in sorted(df.collect(), key=lambda r: r.id)]
    assert sorted(got) == list(range(n))
    if n >= 1000:
        other = [r.perm_pos for r in sorted(X.feistel_positions(spark.range(n), "id", n, seed + 1).collect(), key=lambda r: r.id)]
        assert sum(a == b for a, b in zip(got, other, strict=True)) < n / 20
        assert sum(b == a + 1 for a, b in zip(got, got[1:], strict=False)) < n / 20


@pytest.mark.parametrize("n", [0, 1, 40, 500, 900])
def test_sample_is_the_first_rows_in_hash_order(spark, n):
    import hashlib

    df = spark.range(500).withColumnRenamed("id", "i")
    got = {r.i for r in X.sample_rows(df, "i", n, 3).collect()}
    order = sorted(range(500), key=lambda i: hashlib.md5(f"3:{i}".encode()).hexdigest())
    assert got == set(order[:n])


def test_rows_are_numbered_in_stored_order(spark, tmp_path):
    from tidepool.sources.tables import numbered_table

    spark.range(1000, numPartitions=7).write.parquet(str(tmp_path / "t.parquet"))
    got = sorted((r.row_no, r.id) for r in numbered_table(spark, str(tmp_path), "t").collect())
    assert got == [(i, i) for i in range(1000)]


def test_sorted_parts_split_a_tied_key(spark, tmp_path):
    from tidepool.sources.sinks import write_csv
    from tidepool.operators.sorting import sorted_parts

    df = spark.range(30_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string"))).alias("a"),
        F.when(F.col("id") % 3 == 0, F.lit("x")).otherwise((F.col("id") % 7).cast("string")).alias("b"))
    parts = sorted_parts(df, ["a", "b"], 8)
    sizes = [r["count"] for r in parts.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 1.5 * 30_000 / 8
    write_csv(parts, str(tmp_path / "out"))
    lines = [x for f in sorted((tmp_path / "out").glob("part-*")) for x in f.read_text().splitlines()]
    assert lines == sorted(f"{r.a},{r.b}" for r in df.collect())


def test_zip_by_position_and_unequal_lengths(spark):
    from tidepool.operators.ordered import zip_by_position

    a = spark.range(500).select(F.col("id").alias("x"))
    b = spark.range(500).select((499 - F.col("id")).alias("y"), F.col("id").alias("o"))
    got = sorted((r.position, r.x, r.y) for r in zip_by_position(a, b, ["x"], ["o"]).collect())
    assert got == [(i, i, 499 - i) for i in range(500)]
    with pytest.raises(ValueError, match="cannot zip 500 rows with 499"):
        zip_by_position(a, b.where("o > 0"), ["x"], ["o"])


def test_adjacency_lists_cut_a_hub(spark):
    from tidepool.operators import graph as G

    edges = [("h", i % 50) for i in range(300)] + [("a", 2), ("a", 1), (None, 7)]
    df = spark.createDataFrame(edges, "src string, dst long").repartition(5)
    lists = G.adjacency_lists(df, 16).collect()
    assert max(len(r.targets) for r in lists) == 16
    got = {}
    for r in sorted(lists, key=lambda r: r.chunk):
        got.setdefault(r.src, []).extend(r.targets)
    assert got == {"h": sorted(i % 50 for i in range(300)), "a": [1, 2], None: [7]}


def one_by_one(batches, chunk_chars, sep):
    now, held, size, number = None, [], 0, 0
    for batch in batches:
        for *head, value in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if held and (head != now or size >= chunk_chars):
                yield now, number, sep.join(held)
                held, size = [], 0
                number = number + 1 if head == now else 0
            elif head != now:
                number = 0
            now = head
            held.append(value)
            size += len(value) + 1
    if held:
        yield now, number, sep.join(held)


@pytest.mark.parametrize("chunk", [1, 7, 60, 100_000])
def test_runs_are_joined_as_one_by_one(chunk):
    rng = random.Random(chunk)
    heads = [(lang, part, split) for lang in ("de", None, "fr") for part in ("a", "b") for split in (0, 64)]
    rows = [(*h, rng.choice(["", "a", "\u00e9t\u00e9", "x" * rng.randint(1, 90)])) for h in heads for _ in range(rng.randint(1, 40))]
    batches, at = [], 0
    while at < len(rows):
        n = rng.randint(0, 25)
        columns = list(zip(*rows[at:at + n], strict=True)) or [[]] * 4
        batches.append(pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            columns, [pa.string(), pa.string(), pa.int64(), pa.string()], strict=True)], names=list("lpsv")))
        at += n
    assert list(joined_runs(iter(batches), chunk, " ")) == list(one_by_one(batches, chunk, " "))


def test_words_are_not_handled_one_by_one():
    n = 200_000
    batch = pa.RecordBatch.from_arrays([pa.array(["folder/part"] * n), pa.array([0] * n), pa.array(["word"] * n)], names=list("psv"))
    took = []
    for way in (one_by_one, joined_runs):
        begin = time.process_time()
        assert sum(len(text) + 1 for _, _, text in way([batch], 1 << 14, " ")) == 5 * n
        took.append(time.process_time() - begin)
    assert took[1] < took[0] / 2
