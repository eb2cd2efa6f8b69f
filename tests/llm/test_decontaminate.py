import random
import re

import numpy as np
import pytest

from tidepool.llm import decontaminate
from tidepool.llm.decontaminate import GAP, MATCH, MISMATCH, align, drop_leaks, find_leaks, smith_waterman
from tidepool.llm.words import ANY_WORD, PLAIN_WORD, WordHasher, ngram_hashes, plain_text


def table_score(a, b):
    """The textbook table, cell by cell."""
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            pair = MATCH if a[i - 1] == b[j - 1] else MISMATCH
            h[i][j] = max(0, h[i - 1][j - 1] + pair, h[i - 1][j] + GAP, h[i][j - 1] + GAP)
    return max(max(r) for r in h)


@pytest.mark.parametrize("seed", range(40))
def test_alignment_matches_the_table(seed):
    rng = random.Random(seed)
    a = np.array([rng.randint(0, 5) for _ in range(rng.randint(1, 20))], np.uint64)
    b = np.array([rng.randint(0, 5) for _ in range(rng.randint(1, 30))], np.uint64)
    assert smith_waterman(a, b)[0] == table_score(a.tolist(), b.tolist())
    got = align(a, b, 0.5)
    want = table_score(a.tolist(), b.tolist()) / (MATCH * len(a))
    assert (got is None) == (want < 0.5)
    if got:
        assert got[0] == want
        assert table_score(a.tolist(), b[got[1]:got[2]].tolist()) / (MATCH * len(a)) == want


def words(rng, n, vocabulary=400):
    return [f"w{rng.randint(0, vocabulary)}" for _ in range(n)]


def planted(rng):
    items = [words(rng, rng.randint(15, 40)) for _ in range(12)]
    docs, want = [], set()
    for d in range(200):
        text = words(rng, rng.randint(0, 150))
        if d % 4 == 0:
            item = rng.randrange(len(items))
            copy = list(items[item])
            if d % 8 == 0:  # an edited copy: words replaced, dropped and added
                for _ in range(len(copy) // 8):
                    k = rng.randrange(len(copy))
                    rng.choice([lambda k=k: copy.__setitem__(k, "edit"), lambda k=k: copy.pop(k),
                                lambda k=k: copy.insert(k, "extra")])()
            at = rng.randint(0, len(text))
            text = text[:at] + copy + text[at:]
            want.add((d, item))
        docs.append((d, ", ".join(text).upper() if d % 3 == 0 else " ".join(text)))
    return docs, [(i, " ".join(t) + ".") for i, t in enumerate(items)], want


def test_planted_copies_and_nothing_else(spark):
    docs, items, want = planted(random.Random(4))
    got = find_leaks(spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
                     spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    hasher = WordHasher(PLAIN_WORD)
    for r in got:
        text = hasher.of(plain_text(docs[r.doc_id][1]))
        item = hasher.of(plain_text(items[r.item_id][1]))
        full = smith_waterman(item, text)[0] / (MATCH * len(item))
        assert r.score == pytest.approx(full)
        assert 0 <= r.start_word < r.end_word <= len(text)


def test_a_passage_in_most_documents_is_still_found(spark):
    rng = random.Random(9)
    item = words(rng, 20)
    docs = [(d, " ".join(words(rng, 30) + (item if d % 10 else []))) for d in range(60)]
    got = find_leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                     spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")).collect()
    assert {r.doc_id for r in got} == {d for d in range(60) if d % 10}


@pytest.mark.parametrize("every", [4, 5, 6])
@pytest.mark.parametrize("copies", [1, 25])
@pytest.mark.parametrize("others", [50, 12_000])
def test_edited_copies_are_found_in_tables_of_any_size(spark, every, copies, others):
    rng = random.Random(every)
    items = [words(rng, 30) for _ in range(8)]
    edited = [[f"new{every}" if k % every == every - 1 else w for k, w in enumerate(t)] for t in items]
    docs = [(d, " ".join(words(rng, 10, 10**6) + (edited[d % 8] if d < 8 * copies else words(rng, 20, 10**6))))
            for d in range(8 * copies + others)]
    got = find_leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                     spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)],
                                           "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(d, d % 8) for d in range(8 * copies)}
    assert all(r.score >= 0.5 for r in got)


def test_a_copy_with_words_put_in_is_found_from_one_seed(spark):
    rng = random.Random(3)
    item = [f"v{k}" for k in range(24)]
    copy = [w for k, w in enumerate(item) for w in ([w, "new"] if k % 2 and k < 21 else [w])]
    docs = spark.createDataFrame([(1, " ".join(words(rng, 40) + copy + words(rng, 40)))], "doc_id long, text string")
    r, = find_leaks(docs, spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).collect()
    assert (r.score, r.start_word, r.end_word) == ((2 * 24 - 10) / 48, 40, 40 + len(copy))


def all_pairs(docs, items, least=0.5):
    """Every item aligned to every whole document."""
    hasher = WordHasher(PLAIN_WORD)
    texts = [(k, hasher.of(plain_text(t or ""))) for k, t in docs]
    out = {}
    for item, text in items:
        own = hasher.of(plain_text(text))
        for doc, held in texts:
            score = smith_waterman(own, held)[0] / (MATCH * len(own)) if len(own) > 2 else 0
            if score >= least:
                out[doc, item] = score
    return out


def every(step):
    return lambda rng, t: [f"e{rng.random()}" if k % step == step - 1 else w for k, w in enumerate(t)]


def at_random(rng, t):
    share = rng.uniform(0.1, 0.35)
    return [f"e{rng.random()}" if rng.random() < share else w for w in t]


def dropped(rng, t):
    return [w for w in t if rng.random() > 0.4]


def put_in(rng, t):
    return [x for w in t for x in ((w,) if rng.random() < 0.5 else (w, f"e{rng.random()}"))]


def after_each(rng, t):
    return [x for w in t for x in (w, f"e{rng.random()}")]


@pytest.mark.parametrize("edit", [every(2), every(3), every(4), every(5), every(6), at_random, dropped, put_in, after_each],
                         ids=["every2", "every3", "every4", "every5", "every6", "at_random", "dropped", "put_in", "after_each"])
def test_no_copy_of_the_least_score_is_lost(spark, edit):
    rng = random.Random(11)
    items = [(i, " ".join(words(rng, rng.randint(3, 40)))) for i in range(40)]
    docs = [(d, " ".join(words(rng, 20) + edit(rng, items[d % 40][1].split()) + words(rng, 20))) for d in range(80)]
    docs += [(d, " ".join(words(rng, 200, 30))) for d in range(80, 100)]  # few words, many pairs
    want = all_pairs(docs, items)
    got = {(r.doc_id, r.item_id): r.score for r in find_leaks(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == pytest.approx(want)


def test_given_tables_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text")
    want = all_pairs([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()])
    found = find_leaks(docs, items).collect()
    assert {(r.doc_id, r.item_id): r.score for r in found} == pytest.approx(want)
    stay = {r.doc_id for r in drop_leaks(docs, items).collect()}
    assert stay == {r.doc_id for r in docs.collect()} - {d for d, _ in want}


def test_items_that_share_a_common_phrase_are_not_aligned_to_all_that_hold_it():
    from tidepool.llm.decontaminate import STEPS, needed, pair_hashes

    rng = random.Random(2)
    hasher = WordHasher(PLAIN_WORD)
    phrase = "which of the following is true"
    items = [hasher.of(plain_text(phrase + " " + " ".join(words(rng, 20, 10**6)))) for _ in range(500)]
    doc = hasher.of(plain_text(" ".join(words(rng, 50, 10**6) + phrase.split() + words(rng, 50, 10**6))))

    def documents_with(texts, pairs):
        return np.isin(pairs, np.concatenate([pair_hashes(doc, s) for s in STEPS])).astype(np.int64) * 1000

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(decontaminate, "_documents_with", documents_with)
        index = decontaminate._rare_seeds(None, items, 0.5)
    assert needed(26, 0.5) == 12
    assert list(index.windows(doc, [pair_hashes(doc, s) for s in STEPS])) == []


def test_hits_in_pieces_make_the_same_windows(monkeypatch):
    from tidepool.llm.decontaminate import STEPS, SeedIndex, pair_hashes

    rng = np.random.default_rng(5)
    items = [rng.integers(0, 6, n).astype(np.uint64) for n in (5, 9, 20, 3)]
    seeds = [(pair_hashes(w, s), i) for i, w in enumerate(items) for s in STEPS]
    index = SeedIndex(items, np.concatenate([g for g, _ in seeds]), np.concatenate([np.full(len(g), i) for g, i in seeds]),
                      np.concatenate([np.arange(len(g)) for g, _ in seeds]), 0.5)
    doc = np.concatenate([p for i in range(12) for p in (items[i % 4][:6], np.full(90, 99, np.uint64))])
    pairs = [pair_hashes(doc, s) for s in STEPS]
    want = list(index.windows(doc, pairs))
    assert len(want) > 4
    for hits in (1, 7):
        monkeypatch.setattr(decontaminate, "HITS", hits)
        assert list(index.windows(doc, pairs)) == want


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    docs, items, want = planted(random.Random(5))
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 100)
    got = find_leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                     spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 0), (2, "", 0), (None, "a b c d e", 0), (3, "A, b c D e!", 0),
                                  (3, "A, b c D e!", 0), (4, "x " * 30_000 + "a b c d e", 0)],
                                 "doc_id long, text string, score int")
    items = spark.createDataFrame([(1, "a b c d e"), (1, "a b c d e"), (2, "a b"), (3, None), (None, "")],
                                  "item_id long, text string")
    got = sorted((r.doc_id or 0, r.item_id, r.score) for r in find_leaks(docs, items).collect())
    assert got == [(0, 1, 1.0), (3, 1, 1.0), (3, 1, 1.0), (4, 1, 1.0)]
    assert find_leaks(docs.limit(0), items).collect() == []
    assert find_leaks(docs, items.limit(0)).collect() == []


def test_ngram_hashes_follow_order():
    h = WordHasher(ANY_WORD).of(b"a b c a b c b a")
    g = ngram_hashes(h, 3)
    assert g[0] == g[3] and len(set(g.tolist())) == 5 and len(ngram_hashes(h[:2], 3)) == 0


@pytest.mark.parametrize("seed", range(10))
def test_word_hashes_depend_on_words_alone(seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(["a", "B", "é", "9", " ", "\t", "\n", ",", "-", "\x0b"]) for _ in range(rng.randint(0, 60)))
             for _ in range(20)] + ["", " ", "x" * 5000]
    for letters, split in ((ANY_WORD, lambda t: t.encode().lower().split()),
                           (PLAIN_WORD, lambda t: re.findall(rb"[a-z0-9\x80-\xff]+", t.lower().encode()))):
        hashes, bounds = WordHasher(letters).group([plain_text(t) if letters is PLAIN_WORD else t.encode() for t in texts])
        names = {}
        assert len(bounds) == len(texts) + 1
        for text, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
            words = split(text)
            assert len(words) == b - a
            for w, h in zip(words, hashes[a:b].tolist(), strict=True):
                assert names.setdefault(w, h) == h
        assert len(set(names.values())) == len(names)
        alone = WordHasher(letters)
        assert all(alone.of(w).tolist() == [h] for w, h in names.items())
