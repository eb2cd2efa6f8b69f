import random
import tracemalloc
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from tidepool.llm import jaccard_join
from tidepool.llm.components import components
from tidepool.llm.jaccard_join import Signer, choose_boundary, jaccard_components, need, shingle_sets
from tidepool.llm.repeats import Bitmap, bits_for, place_rows, repeated, unpack, unpack_sorted
from tidepool.llm.words import ANY_WORD, WordHasher, mixed


def brute(rows, n, threshold):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append(set() if not w else {tuple(w)} if len(w) < n else
                    set(zip(*[w[k:] for k in range(n)], strict=False)))
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= threshold * (len(sets[i]) + len(sets[j]) - both) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for (key, _), g in zip(rows, group, strict=True):
        least[g] = min(least.get(g, key), key)
    return {key: (len(s), least[g]) for (key, _), s, g in zip(rows, sets, group, strict=True)}


def near_copies(seed, n=220):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(150)]
    rows = []
    for i in range(n):
        if i > 10 and rng.random() < 0.6:
            text = rng.choice(rows)[1].split()
            for _ in range(rng.randint(0, max(1, len(text) // 25))):
                if text:
                    k = rng.randrange(len(text))
                    text[k:k + 1] = rng.choice([[], ["new%d" % rng.randint(0, 9)], [text[k], rng.choice(words)]])
        else:
            common = words[:30] * rng.randint(0, 1)  # a passage that many share
            text = [rng.choice(words) for _ in range(rng.choice([1, 3, 6, 9, 20, 60, 150]))] + common
        rows.append((i * 7 % 1000, " ".join(text)))
    return rows


@pytest.mark.parametrize(("seed", "n", "threshold"), [(1, 4, 85), (3, 5, 80), (4, 1, 70)])
def test_components_match_brute_force(spark, seed, n, threshold):
    rows = near_copies(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           jaccard_components(df, n=n, threshold=threshold).collect()}
    want = brute(rows, n, threshold)
    assert got == want
    assert len(set(c for _, c in want.values())) < len(rows) - 20


@pytest.mark.parametrize("boundary", [0, 400])
def test_any_boundary_gives_the_same(spark, monkeypatch, boundary):
    monkeypatch.setattr(jaccard_join, "choose_boundary", lambda *a: boundary)
    rows = near_copies(9, 150)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(df).collect()}
    assert got == brute(rows, 4, 85)


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(0)
    ranks = rng.integers(0, 100, 1 << jaccard_join.SKETCH_BITS).astype(np.uint8)
    every = Bitmap(16)
    every.data[:] = 255  # says yes for all
    for trial in range(400):
        boundary = int(rng.integers(0, 60))
        some = Bitmap(20)  # says yes for the shared elements and some others
        signer = Signer(every if trial % 2 else some, ranks, boundary, 85)
        a = np.unique(rng.integers(0, 2**63, int(rng.integers(2, 90)), dtype=np.uint64))
        keep = a[rng.random(len(a)) > 0.1]
        extra = rng.integers(0, 2**63, int(rng.integers(0, 6)), dtype=np.uint64)
        b = np.unique(np.concatenate([keep, extra]))
        both = len(np.intersect1d(a, b))
        half = len(some.data) // 2
        for at, keys in ((0, np.intersect1d(a, b)), (half, mixed(np.intersect1d(a, b)))):
            place = keys >> np.uint64(64 - some.bits)
            np.bitwise_or.at(some.data, at + (place >> np.uint64(3)).astype(np.int64),
                             np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))
        if len(b) > 1 and 100 * both >= 85 * (len(a) + len(b) - both) and both < max(len(a), len(b)):
            of_a, of_b = (dict(zip(*(x.tolist() for x in signer.of(v)), strict=True)) for v in (a, b))
            met = of_a.keys() & of_b.keys()
            assert met, trial
            # in one list at least the bounds of both leave room for what they share
            assert any(min(of_a[k], of_b[k]) >= both for k in met), trial


def test_sets_and_need():
    sets = list(shingle_sets([b"", b"a b", b"b a", b"A\tB", b"a b c d e a b c d"], WordHasher(ANY_WORD), 4))
    assert [len(s) for s in sets] == [0, 1, 1, 1, 5]
    assert sets[1] != sets[2] and sets[1] == sets[3]
    assert need(20, 85) == 17 and need(7, 85) == 6
    assert choose_boundary(np.zeros(401, np.int64), 1.0, 85) == 0
    assert 10 < choose_boundary(np.full(401, 5), 1.5, 85) < 200


def test_a_large_group_of_near_copies_is_one_component(spark):
    rng = random.Random(5)
    base = [f"v{rng.randint(0, 5000)}" for _ in range(200)]
    rows = []
    for i in range(300):
        text = list(base)
        text[rng.randrange(200)] = f"edit{i}"
        rows.append((i + 5, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert Counter(r.component_id for r in jaccard_components(df).collect()) == {5: 300}


def test_edited_copies_of_a_base_meet_through_it(spark):
    rng = random.Random(6)
    base = [f"v{rng.randint(0, 9000)}" for _ in range(300)]
    rows = [(500, " ".join(base))]
    for i in range(120):  # 5 spread edits: 0.87 to the base, 0.77 to each other
        text = list(base)
        for k in range(5):
            text[k * 60 + rng.randrange(50)] = f"edit{i}_{k}"
        rows.append((i + 900, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(df).collect()}
    assert got == brute(rows, 4, 85)
    assert Counter(c for _, c in got.values())[500] > 60


@pytest.mark.parametrize(("n", "threshold", "edits"), [(4, 85, 6), (5, 80, 6)])
def test_copies_just_under_the_threshold(spark, n, threshold, edits):
    """Edited copies of a base on both sides of the threshold, and copies of copies; few candidates are made."""
    rng = random.Random(edits)
    base = [f"v{rng.randint(0, 9000)}" for _ in range(200)]
    rows = [(0, " ".join(base))]
    for i in range(1, 240):
        text = list(base) if i % 8 else rows[rng.randrange(len(rows))][1].split()
        for k in rng.sample(range(10), edits + rng.randint(-2, 2)):
            at = min(len(text) - 1, k * 20 + rng.randrange(16))
            text[at:at + 1] = rng.choice([[f"e{i}_{k}"], [], [f"e{rng.randrange(5)}", "e"], [f"e{i}_{k}", "e"]])
        rows.append((i, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(df, n=n, threshold=threshold).collect()}
    want = brute(rows, n, threshold)
    assert got == want
    sizes = Counter(c for _, c in want.values())
    assert sizes[0] > 20 and sum(v == 1 for v in sizes.values()) > 20


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n "), (4, "a b"), (4, "a b"), (9, "A B"), (None, "a b"), (None, None),
            (7, "x " * 30_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n", "2 as component_id")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard_components(df).collect()
                 if r.component_id is not None)
    assert got == [(0, 1, 4), (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (4, 1, 4), (7, 1, 7), (9, 1, 4)]
    assert jaccard_components(df.limit(0)).collect() == []


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(1000, k) for k in range(1001, 1040)] + [(5000, 4000), (-3, 2)]
    rng = random.Random(1)
    links = [p if rng.random() < 0.5 else p[::-1] for p in links]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == -3 for i in range(61)) and all(got[k] == 1000 for k in range(1000, 1040))
    assert got[5000] == got[4000] == 4000
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_repeated_bitmap(spark):
    import pyarrow as pa
    keys = np.random.default_rng(1).integers(0, 2**64, 3000, dtype=np.uint64)

    def run(batches):
        for batch in batches:
            for lo in batch.column(0).to_pylist():
                own = np.concatenate([keys[lo:lo + 1500], keys[:50] if lo else keys[100:150]])
                rows = list(place_rows(own, 20))
                yield pa.RecordBatch.from_pydict({"key": [k for k, _ in rows], "data": [d for _, d in rows]})

    df = spark.createDataFrame([(0,), (1500,)], "lo long").repartition(2, "lo").mapInArrow(run, "key bigint, data binary")
    bitmap = repeated(df, 20)
    assert isinstance(bitmap, Bitmap) and bitmap.has(keys[:50]).all() and bitmap.has(keys[100:150]).all()
    assert bitmap.has(keys[200:]).mean() < 0.02
    assert bits_for(0) == 16 and bits_for(10**12) == 28


def peak_mb(rows):
    """Most that reading ``rows`` holds at once, in MB, and the rows."""
    tracemalloc.start()
    try:
        out = list(rows)
        return tracemalloc.get_traced_memory()[1] / 1e6, out
    finally:
        tracemalloc.stop()


def test_places_of_many_keys_take_little_memory():
    keys = np.random.default_rng(3).integers(0, 2**64, 1_000_000, dtype=np.uint64)
    keys[:1000] = keys[-1000:]
    most, rows = peak_mb(place_rows(keys, 22))
    assert most < 30  # the keys are 8 MB more
    once, twice = ({}, {})
    for key, data in rows:
        (twice if data[0] else once).setdefault(key, []).extend(unpack_sorted(data[1:], np.uint32).tolist())
    for which, own in enumerate((keys, mixed(keys))):
        at, n = np.unique(own >> np.uint64(42), return_counts=True)
        for found, want in ((once, at[n == 1]), (twice, at[n > 1])):
            got = [(k & 63) << 16 | p for k in sorted(found) if k >> 6 == which for p in found[k]]
            assert got == want.tolist()
    assert list(place_rows(keys[:0], 22)) == []


class Scan:
    """Stands for a frame ``id, text``; keeps the function that reads it."""

    schema = [SimpleNamespace(dataType=SimpleNamespace(simpleString=lambda: "bigint"))]

    def mapInArrow(self, run, schema):
        self.run = run
        return self


def test_scans_of_many_words_take_little_memory(monkeypatch):
    rng = np.random.default_rng(4)
    schema = pa.schema([("id", pa.int64()), ("text", pa.string())])

    def batches():
        for i in range(60):
            yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([" ".join(map(str, rng.integers(0, 9**9, 50_000)))])],
                                             schema=schema)

    scan = Scan()
    jaccard_join.documents_and_places(scan, 4, 24)
    most, rows = peak_mb(scan.run(batches()))
    assert sum(b.column(2).drop_null().__len__() for b in rows) == 60
    assert most < 130  # 3,000,000 words

    every = Bitmap(24)
    every.data[:] = 255
    monkeypatch.setattr(jaccard_join, "folded", lambda *a: SimpleNamespace(collect=lambda: []))
    jaccard_join.set_statistics(scan, 4, SimpleNamespace(value=every))
    most, rows = peak_mb(scan.run(batches()))
    assert most < 100
    found = dict(r for b in rows for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
    assert unpack(found[jaccard_join.TOTAL << 32], np.int64).tolist() == [60 * 49_997]
    assert sum(unpack(found[k], np.int64).sum() for k in range(jaccard_join.SKETCH_SLICES)) == 60 * 49_997


def test_statistics_are_exact(monkeypatch):
    rng = random.Random(6)
    texts = [" ".join(rng.choice("abcdefghij") for _ in range(rng.randint(0, 700))) for _ in range(200)]
    sets = list(shingle_sets([t.encode() for t in texts], WordHasher(ANY_WORD), 4))
    some = Bitmap(16)
    some.data[:] = np.random.default_rng(1).integers(0, 256, len(some.data)).astype(np.uint8)
    scan = Scan()
    monkeypatch.setattr(jaccard_join, "folded", lambda *a: SimpleNamespace(collect=lambda: []))
    jaccard_join.set_statistics(scan, 4, SimpleNamespace(value=some))
    rows = [r for b in scan.run(iter([pa.RecordBatch.from_pydict({"id": list(range(200)), "text": texts})]))
            for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
    found, whole = dict(rows), np.concatenate(sets)
    whole = whole[some.has(whole)]
    width = (1 << jaccard_join.SKETCH_BITS) // jaccard_join.SKETCH_SLICES
    counts = np.concatenate([unpack(found[k], np.int64) for k in range(jaccard_join.SKETCH_SLICES)])
    assert len(counts) == width * jaccard_join.SKETCH_SLICES
    assert (counts == np.bincount((whole >> np.uint64(64 - jaccard_join.SKETCH_BITS)).astype(np.int64),
                                  minlength=len(counts))).all()
    assert (unpack(found[jaccard_join.SMALLEST << 32], np.uint64)
            == np.unique(whole)[:jaccard_join.SMALLEST_HASHES]).all()
    assert unpack(found[jaccard_join.TOTAL << 32], np.int64).tolist() == [len(whole)]
    sizes = np.bincount([len(s) for s in sets if 0 < len(s) <= jaccard_join.MOST_LIGHT],
                        minlength=jaccard_join.MOST_LIGHT + 1)
    assert (unpack(found[jaccard_join.SIZES << 32], np.int64) == sizes).all()


def test_signatures_that_none_shares_do_not_travel(spark):
    rows = [(k, k, 9, 8) for k in range(2000)] + [(k, -k - 1, 9, 8) for k in range(0, 2000, 40)]
    signed = spark.createDataFrame(rows, "sig long, ck long, n int, reach int").repartition(3)
    got = [tuple(r) for r in jaccard_join.meeting(signed).collect()]
    assert len(got) == len(set(got)) and set(got) <= set(rows)
    assert {r for r in rows if r[0] % 40 == 0} <= set(got)
    assert len(got) < 500
    assert jaccard_join.meeting(signed.where("sig < 0")).count() == 0


def test_centres_too_far_away_are_not_read(spark, monkeypatch):
    """Texts of two halves, each of which another text has too: neighbours meet, but have no room for a link."""
    halves = [" ".join(f"h{i}w{k}" for k in range(40)) for i in range(61)]
    rows = [(i, f"{halves[i]} {halves[i + 1]}") for i in range(60)] + [(99, f"{halves[7]} {halves[8]} end")]
    asked = []
    whole = jaccard_join.verified

    def spy(texts, pairs, *rest):
        asked.append(pairs.count())
        return whole(texts, pairs, *rest)

    monkeypatch.setattr(jaccard_join, "verified", spy)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(df, n=4, threshold=85).collect()}
    assert got == brute(rows, 4, 85)
    assert got[99][1] == 7
    assert asked[0] < 45


def test_one_document_signs_for_its_copies(spark, monkeypatch):
    """Copies in many tasks meet nothing, so no signature of theirs comes through."""
    rng = random.Random(8)
    texts = [" ".join(f"t{i}w{rng.randrange(999)}" for _ in range(40)) for i in range(12)]
    rows = [(100 * c + i, t) for i, t in enumerate(texts) for c in range(8)]
    counts = []
    whole = jaccard_join.meeting

    def spy(signed):
        counts.append(signed.count())
        found = whole(signed)
        counts.append(found.count())
        return found

    monkeypatch.setattr(jaccard_join, "meeting", spy)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(df, n=4, threshold=85).collect()}
    assert got == brute(rows, 4, 85)
    assert counts[0] and counts[1] < counts[0] / 10


def test_documents_that_are_not_wanted_stay(spark):
    copies = spark.createDataFrame([(k, k) for k in range(500)], "ck long, id long").localCheckpoint()
    bitmap = jaccard_join.copies_bitmap(copies)
    keys = np.array([jaccard_join.copy_key(k, k) for k in range(20_500)], np.uint64)
    named = bitmap.has(keys)
    assert named[:500].all() and named[500:].sum() < 100
