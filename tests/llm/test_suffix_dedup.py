import hashlib
import random

import numpy as np
import pytest

from tidepool.llm.suffix_dedup import (
    chunk_segments, least_owners, merged_spans, remove_repeats, segments_of, smaller_than_next, suffix_array)


def brute(rows, size):
    """Every window of every text in one dictionary."""
    least = {}
    data = [(k, (t or "").encode()) for k, t in rows]
    for key, text in data:
        for p in range(len(text) - size + 1):
            w = text[p:p + size]
            least[w] = min(least.get(w, 1 << 70), 1 << 69 if key is None else key)
    out = []
    for key, text in data:
        gone = np.zeros(len(text), bool)
        for p in range(len(text) - size + 1):
            if least[text[p:p + size]] < (1 << 69 if key is None else key):
                gone[p:p + size] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        spans = [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2], strict=True)]
        out.append((key, spans, bytes(np.frombuffer(text, np.uint8)[~gone])))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(60))
def test_suffix_array_is_the_sorted_order(seed):
    rng = random.Random(seed)
    letters = rng.choice([2, 3, 5, 200])
    segments = [bytes(rng.randint(1, letters) for _ in range(rng.randint(1, 80))) for _ in range(rng.randint(1, 6))]
    text = np.frombuffer(b"\xff".join(segments) + b"\xff", np.uint8) + np.uint8(1)
    data = text.tobytes()
    ends = [data.index(0, i) for i in range(len(data))]
    want = sorted(range(len(data)), key=lambda i: (data[i:ends[i]], ends[i]))
    assert suffix_array(text, 96).tolist() == want
    suffixes = [(data[i:ends[i]], ends[i]) for i in range(len(data))]
    small = smaller_than_next(text)
    assert all(small[i] == (suffixes[i] < suffixes[i + 1]) for i in range(len(data) - 1) if data[i] and data[i + 1])


@pytest.mark.parametrize("seed", range(20))
def test_windows_have_the_anchor_of_their_content(seed):
    rng = random.Random(seed)
    texts = [bytes(rng.randint(97, 98) for _ in range(rng.randint(0, 300))) for _ in range(5)]
    number, start, stop, anchor = segments_of(texts, 50)
    known = {}
    for i, text in enumerate(texts):
        mine = np.flatnonzero(number == i)
        assert [p for k in mine for p in range(start[k], stop[k])] == list(range(max(0, len(text) - 49)))
        for k in mine:
            for p in range(start[k], stop[k]):
                assert known.setdefault(text[p:p + 50], anchor[k]) == anchor[k]


def test_least_owners():
    rng = random.Random(4)
    segments = list({bytes(rng.randint(97, 98) for _ in range(rng.randint(16, 60))) for _ in range(80)})
    owners = np.array([rng.randint(0, 20) for _ in segments])
    least = {}
    for s, o in zip(segments, owners, strict=True):
        for p in range(len(s) - 15):
            least[s[p:p + 16]] = min(least.get(s[p:p + 16], 99), o)
    for s, own in zip(segments, least_owners(segments, owners, 16), strict=True):
        assert own.tolist() == [least[s[p:p + 16]] for p in range(len(s) - 15)]


def test_long_texts_in_parts(monkeypatch):
    from tidepool.llm import suffix_dedup
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 200)
    rng = random.Random(3)
    text = bytes(rng.randint(97, 99) for _ in range(3000))
    number, start, stop, anchor = chunk_segments([b"short", text], 50)
    assert set(number.tolist()) == {1}
    assert [p for a, b in zip(start, stop, strict=True) for p in range(a, b)] == list(range(len(text) - 49))
    whole = dict(zip(*segments_of([text], 50)[1::2], strict=True))
    assert set(anchor.tolist()) == set(whole.values())


def repeating(seed, n=150):
    rng = random.Random(seed)
    syllables = ["ta", "né", "or", "ing ", "sh", "e ", "lü", "x"]
    passages = ["".join(rng.choice(syllables) for _ in range(rng.randint(20, 60))) for _ in range(6)]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(syllables) for _ in range(rng.randint(0, 120)))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(text))
            text = text[:at] + rng.choice(passages) + text[at:]
        if i % 9 == 0 and rows:
            text = rng.choice(rows)[1] or ""
        if i % 10 == 0:
            text = "same line\n" * rng.randint(0, 30) + text
        rows.append((i * 37 % 1009, text))
    return rows


@pytest.mark.parametrize(("seed", "size"), [(1, 50), (2, 20), (3, 16)])
def test_matches_brute_force(spark, seed, size):
    rows = repeating(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = result(remove_repeats(df, size=size))
    assert got == brute(rows, size)
    assert sum(len(s) for _, s, _ in got) > 100


def test_documents_of_the_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert result(remove_repeats(docs)) == brute(rows, 50)


def test_registered_query_digests(spark):
    from tidepool.llm.queries import op10_suffix_dedup
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {k: (spans, kept) for k, spans, kept in brute([(r.doc_id, r.text) for r in docs.collect()], 50)}
    rows = op10_suffix_dedup(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(want)
    for r in rows:
        spans, kept = want[r.doc_id]
        gone = sum(b - a for a, b in spans)
        assert (r.n_removed, r.n_spans, r.n_bytes) == (gone, len(spans), gone + len(kept))
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_edges(spark):
    long = "".join(chr(97 + i * i % 23) + str(i) for i in range(30_000))
    rows = [(1, None), (2, ""), (3, "a" * 200), (4, "a" * 60), (4, "a" * 60), (None, "a" * 70), (None, "b" * 80),
            (None, "b" * 80), (5, "short"), (6, long), (7, long), (8, "a" * 49)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "2 as spans", "3 as h")
    assert result(remove_repeats(df)) == brute(rows, 50)
    assert remove_repeats(df.limit(0)).collect() == []
    assert merged_spans([[5, 9, 0, 2], [2, 3, 8, 12]]) == [(0, 3), (5, 12)]


def test_texts_are_cut_in_runs_that_fit_a_cache():
    import pyarrow as pa

    from tidepool.llm import suffix_dedup
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcd ") for _ in range(rng.randint(0, 9000))) for _ in range(200)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(200)), pa.array(texts)], names=["h", "text"])
    runs = list(suffix_dedup.text_chunks(iter([batch]), 1, suffix_dedup.CHUNK_BYTES))
    assert max(8 * sum(map(len, run)) for _, run in runs) <= 2 << 20  # bytes of one array of numbers
    assert [t for _, run in runs for t in run] == [t.encode() for t in texts]


def test_masked_words_end_at_their_first_zero():
    from tidepool.llm.suffix_dedup import masked
    rng = random.Random(6)
    words = [bytes(rng.choice([0, 1, 2, 128, 255]) for _ in range(8)) for _ in range(3000)]
    got = masked(np.array([int.from_bytes(w) for w in words], np.uint64)).tolist()
    assert got == [int.from_bytes(w.split(b"\0")[0].ljust(8, b"\0")) for w in words]
