import base64
import gzip
import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidepool.llm import warc
from tidepool.llm.warc import payload_chunks, read_archives, write_archives


def payloads(chunks):
    out = defaultdict(list)
    for r in sorted(chunks.collect(), key=lambda r: (r.id or "", r.chunk)):
        if r.record_type == "response":
            out[r.id].append(bytes(r.data))
    return {k: b"".join(v) for k, v in out.items()}


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_round_trip_with_small_chunks(spark):
    texts = ["", None, "a", "é" * 1000, "x\r\n\r\ny" * 777, "big " * 50_000, "same", "same", "Same", "😀" * 9]
    rows = [(i, f"http://h/{i}?q=é\r\n x", t) for i, t in enumerate(texts)]
    files = write_archives(pages(spark, rows).repartition(3), "page_id", "url", "html", chunk_bytes=1000)
    back = read_archives(files, chunk_bytes=333).cache()
    got = {int(r.id): r for r in back.where("last").collect()}
    want = {i: (t or "").encode() for i, t in enumerate(texts)}
    assert set(got) == set(want)
    for i, data in want.items():
        assert got[i].payload_bytes == len(data)
        assert got[i].digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
    assert {i for i, r in got.items() if r.record_type == "revisit"} == {0, 6}
    assert got[0].refers_to == "1" and got[6].refers_to == "7" and got[1].refers_to is None
    data = payloads(back)
    assert all(data[str(i)] == want[i] for i, r in got.items() if r.record_type == "response")
    assert back.agg(F.max(F.length("data"))).first()[0] <= 333


def test_running_digests_and_chunk_rows(spark):
    df = pages(spark, [(1, "u", "abcdefghij"), (2, None, None)])
    rows = payload_chunks(df, "page_id", "url", "html", chunk_bytes=4).orderBy("record", "chunk").collect()
    assert [(r.id, r.chunk, r.start, r.last) for r in rows] == [
        ("1", 0, 0, False), ("1", 1, 4, False), ("1", 2, 8, True), ("2", 0, 0, True)]
    assert bytes(rows[1].sha1) == hashlib.sha1(b"abcdefgh").digest()


def test_files_are_plain_gzip_members(spark):
    files = write_archives(pages(spark, [(1, "http://h/", "payload")]), "page_id", "url", "html").collect()
    assert len(files) == 1 and files[0].records == 1
    text = gzip.open(files[0].file.removeprefix("file:")).read()
    assert text.count(b"WARC/1.1\r\n") == 3 and b"\r\n\r\npayload\r\n\r\n" in text  # one is warcinfo's body


def test_damaged_payload_raises(spark):
    files = write_archives(pages(spark, [(1, "http://h/", "payload")]), "page_id", "url", "html")
    name = files.first().file.removeprefix("file:")
    data = gzip.open(name).read().replace(b"payload\r\n", b"pAyload\r\n")
    cut = data.index(b"WARC/1.1\r\nWARC-Type: response")
    with open(name, "wb") as f:
        f.write(gzip.compress(data[:cut]) + gzip.compress(data[cut:]))
    with pytest.raises(Exception, match="payload and digest differ"):
        read_archives(files).collect()


def test_rolls_files_and_rereads_all(spark):
    folder = warc.scratch_path(spark, "warc-test")
    writer_rows = [(i, "u", f"text {i}") for i in range(40)]
    files = write_archives(pages(spark, writer_rows), "page_id", "url", "html", folder=folder,
                           file_bytes=1)
    assert files.count() == 40
    assert sorted(int(r.id) for r in read_archives(files).where("last").collect()) == list(range(40))


def test_minimum_size_repeated_rows_null_ids(spark):
    rows = [(5, "u", "ab"), (5, "v", "ab"), (None, "w", "ab"), (3, "u", "x"), (4, "u", "x"), (None, None, None)]
    df = pages(spark, rows).withColumn("digest", F.lit(1)).withColumn("record", F.lit(2))
    got = read_archives(write_archives(df, "page_id", "url", "html", min_bytes=2)).where("last").collect()
    kinds = sorted((r.id or "-", r.record_type, r.refers_to) for r in got if r.payload_bytes == 2)
    assert [k[:2] for k in kinds] == [("-", "revisit"), ("5", "response"), ("5", "revisit")]
    assert {k[2] for k in kinds if k[1] == "revisit"} == {"5"}
    assert all(r.record_type == "response" for r in got if r.payload_bytes < 2) and len(got) == 6


def test_empty_table(spark):
    files = write_archives(pages(spark, []), "page_id", "url", "html")
    assert files.collect() == [] and read_archives(files).collect() == []
