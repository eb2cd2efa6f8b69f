import glob
import math
import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepool.llm import context_tree as ct
from tidepool.llm.common import crc32_mod
from tidepool.llm.context_tree import score_texts


def kt(n0, n1):
    """The estimator's product, one symbol after another."""
    p = 1.0
    for i in range(n0):
        p *= (i + 0.5) / (i + 1)
    for j in range(n1):
        p *= (j + 0.5) / (n0 + j + 1)
    return p


class BruteTree:
    """Context trees held as plain recursion over all training positions."""

    def __init__(self, texts, depth):
        self.depth = depth
        self.count = defaultdict(lambda: [0, 0])
        self.children = defaultdict(set)
        for t in texts:
            data = b"\xff" * depth + t
            for i in range(depth, len(data)):
                for k in range(8):
                    node = (1 << k) | (data[i] >> (8 - k))
                    bit = data[i] >> (7 - k) & 1
                    for d in range(depth + 1):
                        context = data[i - d:i]
                        self.count[context, node][bit] += 1
                        if d < depth:
                            self.children[context, node].add(data[i - d - 1:i])

    def weighted(self, context, node):
        own = kt(*self.count[context, node])
        if len(context) == self.depth:
            return own
        product = math.prod(self.weighted(c, node) for c in self.children[context, node])
        return (own + product) / 2

    def probability(self, data, i):
        p = 1.0
        for k in range(8):
            node, bit = (1 << k) | (data[i] >> (8 - k)), data[i] >> (7 - k) & 1
            p *= self.decision(data, i, 0, node, bit)
        return p

    def decision(self, data, i, d, node, bit):
        context = data[i - d:i]
        n = self.count.get((context, node), [0, 0])
        here = (n[bit] + 0.5) / (sum(n) + 1)
        longer = data[i - d - 1:i]
        if d == self.depth or sum(self.count.get((longer, node), [0, 0])) == 0:
            return here
        stop = kt(*n) / 2 / self.weighted(context, node)
        return stop * here + (1 - stop) * self.decision(data, i, d + 1, node, bit)


def texts(rng, n, letters=b"abc d"):
    return [bytes(rng.choice(letters) for _ in range(rng.randint(0, 12))) + b"\xff" for _ in range(n)]


def model(training, others, depth, hot=()):
    """Log probabilities of all grams by trees of two buckets: contexts of two bytes, and of three below ``hot`` ones."""
    counts = ct.Counts()
    for part, learn in ((training, True), (others, False)):
        counts.add(ct.grams_of(part, depth)[0], learn)
    keys, n = counts.merge()
    pairs = np.zeros(1 << 16, np.int64)
    hot = np.array(sorted(hot), np.int64)
    places = ct.Placement(pairs, hot, np.zeros(256 * len(hot), np.int64), 1)
    trees = list(ct.bucket_trees(keys, n.astype(float), depth, places))
    top = ct.top_levels([row for _, tree in trees for row in tree.summary()])
    logs = np.zeros(len(keys))
    for at, tree in trees:
        logs[at] = tree.log10_bytes(top)
    return dict(zip(keys.tolist(), logs.tolist(), strict=True))


@pytest.mark.parametrize("depth, hot", [(2, ""), (3, ""), (3, "ab"), (4, "ab"), (4, "abc d")])
def test_probabilities_match_plain_recursion(depth, hot):
    rng = random.Random(depth)
    training, others = texts(rng, 9), texts(rng, 6, b"abcde ")
    brute = BruteTree(training, depth)
    logs = model(training, others, depth, {ord(a) << 8 | ord(b) for a in hot for b in hot})
    for t in training + others:
        data = b"\xff" * depth + t
        grams, _ = ct.grams_of([t], depth)
        for i, g in enumerate(grams.tolist()):
            assert logs[g] == pytest.approx(math.log10(brute.probability(data, i + depth)), abs=1e-9)


def test_bytes_after_a_context_sum_to_one():
    rng = random.Random(1)
    asked = [context + bytes([s]) for context in (b"abc", b"zzz", b"\xff\xff\xff", b" ab") for s in range(256)]
    logs = model(texts(rng, 20), asked, 3)
    last = ct.grams_of(asked, 3)[0].reshape(-1, 256, 4)[:, :, 3]
    for grams in last.tolist():
        assert sum(10 ** logs[g] for g in grams) == pytest.approx(1)


def test_contexts_are_dealt_evenly_and_hot_ones_by_three_bytes():
    rng = np.random.default_rng(2)
    pairs = np.zeros(1 << 16, np.int64)
    pairs[rng.integers(0, 1 << 16, 3000)] = rng.integers(1, 40_000, 3000)
    hot = np.array([7, 70, 700])
    pairs[hot] = pairs.sum() // 3
    triples = np.zeros(3 * 256, np.int64)
    for i in range(3):
        triples[i * 256:i * 256 + 200] = pairs[hot[i]] // 200
    places = ct.Placement(pairs, hot, triples, 40)
    keys = np.concatenate([np.repeat(np.arange(1 << 16), pairs // 1000) << 48,
                           np.repeat(hot, 200) << 48 | np.tile(np.arange(200), 3) << 40]).astype(np.uint64)
    assert places.is_hot(keys, 7).sum() >= 600
    weights = np.zeros(places.buckets)
    cold = ~places.is_hot(np.arange(1 << 16, dtype=np.uint64) << np.uint64(48), 7)
    np.add.at(weights, places.pair[cold], pairs[cold])
    np.add.at(weights, places.triple, triples)
    assert weights.sum() == pytest.approx(pairs.sum(), rel=1e-3)
    tasks = weights.reshape(40, -1).sum(axis=1)
    assert tasks.max() < 1.1 * tasks.mean()
    assert ((places.of(ct.GRAMS, keys, 7) >= 0) & (places.of(ct.GRAMS, keys, 7) < places.buckets)).all()


def test_long_texts_are_read_in_parts(monkeypatch):
    monkeypatch.setattr(ct, "BLOCK_TEXT", 20)
    rng = random.Random(4)
    vocabulary = ["a", "bcd", "efghijk", "x" * 30, "y" * 20, "y" * 21]
    found = [ct.spelled(" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 30))).encode())
             for _ in range(60)] + [ct.spelled(b"x" * 30), ct.spelled(b"")]
    hasher = ct.WordHasher(ct.ANY_WORD)

    def hashes(text):
        return [ct.word_hash(w) if len(w) > 20 else int(hasher.of(w)[0]) for w in text[:-1].split()] + [int(ct.END_HASH)]

    for parts, of in ((ct.gram_parts(found, 3), lambda t: ct.grams_of([t], 3)[0].tolist()),
                      (ct.token_parts(found, hasher), hashes)):
        got = defaultdict(list)
        for owners, keys, first in parts:
            assert len(keys) <= 60
            for owner, own in zip(owners, np.split(keys, first[1:]), strict=True):
                got[owner] += own.tolist()
        assert [got[i] for i in range(len(found))] == [of(t) for t in found]
    sums = ct.summed(len(found), ct.token_parts(found, hasher), lambda keys: [np.ones(len(keys))])[0]
    assert sums.tolist() == [len(hashes(t)) for t in found]


def test_log_kt_and_packing():
    for n0, n1 in [(0, 0), (1, 0), (3, 5), (20, 1)]:
        got = ct.log_kt(np.array([float(n0)]), np.array([float(n1)]))[0]
        assert got == pytest.approx(math.log(kt(n0, n1)), abs=1e-9)
    keys = np.unique(np.random.default_rng(0).integers(0, 2**64, 1000, dtype=np.uint64))
    assert (ct.unpack_keys(ct.pack_keys(keys)) == keys).all()
    assert len(ct.unpack_keys(ct.pack_keys(keys[:0]))) == 0


def corpus(n):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6))) for _ in range(60)]
    rows = [(i, rng.choice([" ", "\n\t", "  "]).join(rng.choice(vocabulary).title()
                                                  for _ in range(rng.randint(0, 40)))) for i in range(n)]
    return [*rows, (n, None), (n + 1, ""), (n + 2, "  A\x1cb")]


def test_scores_of_a_corpus(spark):
    rows = corpus(150)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in score_texts(df, crc32_mod(F.col("doc_id"), 10) == 0, depth=3).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows}
    words = {i: [*(t or "").encode().lower().split(), b""] for i, t in rows}
    counts = Counter(w for i, ws in words.items() if not held[i] for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    spelled = {i: b" ".join(ws[:-1]) + b"\xff" for i, ws in words.items()}
    logs = model([t for i, t in spelled.items() if not held[i]], [t for i, t in spelled.items() if held[i]], 3)
    assert set(got) == set(held)
    for i, ws in words.items():
        r = got[i]
        assert r.held_out == held[i] and r.n_tokens == len(ws) and r.train_tokens == total
        assert r.n_known == sum(counts[w] > 0 for w in ws)
        assert r.base_score == pytest.approx(
            sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in ws))
        grams, _ = ct.grams_of([spelled[i]], 3)
        assert r.score == pytest.approx(sum(logs[g] for g in grams.tolist()), rel=1e-5)
        assert r.bits_per_byte == pytest.approx(-r.score * math.log2(10) / len(spelled[i]))


def test_beats_token_counts_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = score_texts(docs, crc32_mod(F.col("doc_id"), 10) == 0).where("held_out").agg(
        F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def test_repeated_rows_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a b"), (2, "x" * 100_000)],
                               "doc_id long, text string").withColumn("score", F.lit(0))
    got = score_texts(df, F.col("doc_id") == 2).collect()
    assert len(got) == 4 and len({r.score for r in got if r.n_tokens == 3}) == 1
    assert {r.train_tokens for r in got} == {9}
    lone = score_texts(df, F.lit(True)).collect()
    assert [r.score for r in lone if r.doc_id == 1] == pytest.approx([-4 * math.log10(256)] * 2)
    assert score_texts(df.limit(0), F.lit(False)).collect() == []
    extra = df.select("doc_id", "text", *[F.lit(1).alias(c) for c in ("batch", "keys", "held_out", "_id", "n", "data")])
    assert [r.score for r in score_texts(extra, F.lit(True)).where("doc_id = 1").collect()] == [
        r.score for r in lone if r.doc_id == 1]


def test_grams_are_stored_once(spark):
    sc = spark.sparkContext
    local = os.path.dirname(os.path.dirname(sc._temp_dir))

    def shuffled():
        return {f: os.path.getsize(f) for f in glob.glob(f"{local}/blockmgr-*/*/shuffle_*.data")}

    blocks = ct.text_blocks(spark.createDataFrame(corpus(300), "doc_id long, text string").repartition(3),
                            "doc_id", "text", F.col("doc_id") % 10 == 0)
    places = ct.placement(blocks, 3, 4)
    before = shuffled()
    keyed = ct.batch_keys(blocks, 3, places)
    left = sum(size for f, size in shuffled().items() if f not in before)
    stored = keyed.agg(F.sum(F.octet_length("keys") + F.octet_length("counts"))).first()[0]
    assert 0 < stored and left < stored / 4
    assert keyed.agg(F.countDistinct("batch")).first()[0] == 3


def test_depths_that_do_not_fit_raise(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    for depth in (1, ct.MAX_DEPTH + 1):
        with pytest.raises(ValueError, match="depth"):
            score_texts(df, F.lit(False), depth=depth)
