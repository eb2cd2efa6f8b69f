import hashlib
import random
import re

import numpy as np
import pytest

from tidepool.llm import phrase_dedup as P
from tidepool.llm.phrase_dedup import (
    compiled, merged, passages, remove_phrases, segments_of, settle_equal, shard_spans, symbols, text_parts)
from tidepool.llm.words import ANY_WORD, WordHasher

WORD = re.compile("[^\x20\x09-\x0D]+")
LAST = 1 << 70


def brute(rows, size):
    """Every window of every text in one dictionary; equal rows are one document."""
    docs = {}
    for key, text in rows:
        docs[LAST if key is None else key, text or ""] = WORD.findall(text or "")
    first, seen = {}, {}
    for doc, words in sorted(docs.items()):
        for p in range(len(words) - size + 1):
            w = tuple(words[p:p + size])
            first[w] = min(first.get(w, LAST + 1), doc[0])
            seen.setdefault((w, doc), p)
    out = []
    for key, text in rows:
        doc = (LAST if key is None else key, text or "")
        words = docs[doc]
        gone = np.zeros(len(words), bool)
        for p in range(len(words) - size + 1):
            w = tuple(words[p:p + size])
            if first[w] < doc[0] or seen[w, doc] < p:
                gone[p:p + size] = True
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((key, len(words), int(gone.sum()), kept, hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept, r.kept_sha256) for r in df.collect()), key=repr)


def corpus(seed, n, letters, copies=0.5):
    """Texts that share passages of all lengths."""
    rng = random.Random(seed)
    texts = []
    for _ in range(n):
        words = [rng.choice(letters) for _ in range(rng.choice([0, 5, 19, 20, 21, 40, 150]))]
        while texts and rng.random() < copies:
            old = rng.choice(texts)
            a = rng.randint(0, len(old))
            at = rng.randint(0, len(words))
            words[at:at] = old[a:a + rng.randint(0, 80)]
        texts.append(words)
    blank = [" ", "\n", "\t ", "\r\n", "\x0b", "\x0c"]
    return [(i, "".join(w + rng.choice(blank) for w in t)) for i, t in enumerate(texts)]


MANY = [f"w{i}é" for i in range(400)] + [" x", "\x1c", "a"]


@pytest.mark.parametrize("seed, letters, size", [(1, MANY, 20), (2, MANY, 8), (3, ["a", "b"], 20), (4, ["a"], 20), (5, ["a", "b", "c"], 9)])
def test_equals_brute_force(spark, seed, letters, size):
    rows = corpus(seed, 150, letters)
    random.Random(seed).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert result(remove_phrases(df, size=size)) == brute(rows, size)


def test_repeated_rows_null_ids_empty_texts_and_clashing_names(spark):
    base = " ".join(MANY[:60])
    other = " ".join(["new"] * 3 + MANY[:60])
    rows = [(5, base), (5, base), (5, other), (None, base), (None, other), (9, base), (3, None), (4, ""), (1, "short text"),
            (None, None), (7, base + " " + base)]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, id int, h string, kept int")
    want = brute(rows, 20)
    assert result(remove_phrases(df.repartition(4))) == want
    assert result(remove_phrases(df.coalesce(1))) == want
    bare = remove_phrases(df, with_text=False)
    assert bare.columns == ["doc_id", "n_words", "n_removed", "kept_sha256", "spans"]
    assert sorted((r.doc_id or 0, r.n_removed, r.kept_sha256) for r in bare.collect()) == sorted((k or 0, n, d) for k, _, n, _, d in want)
    none = remove_phrases(df.where("doc_id < 0"))
    assert none.count() == 0 and none.columns == [*bare.columns, "kept"]
    renamed = df.select("doc_id", "text").toDF("text", "n_words")
    assert remove_phrases(renamed, "text", "n_words", with_text=False).where("n_removed > 0").count() == sum(n > 0 for _, _, n, *_ in want)


def test_very_long_text(spark):
    rng = random.Random(8)
    passage = [rng.choice(MANY) for _ in range(60)]
    long = [f"u{rng.randrange(10**7)}" for _ in range(900_000)]
    for at in (5, 300_000, 300_040, 899_990):
        long[at:at] = passage
    rows = [(1, " ".join(passage)), (2, " ".join(long))]
    got = result(remove_phrases(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == brute(rows, 20)


@pytest.mark.parametrize("hot", [0, 3])
def test_hot_anchors_travel_as_windows(spark, monkeypatch, hot):
    # one line of 12 words in every text: one anchor for very many segments
    rng = random.Random(hot)
    line = MANY[:12]
    rows = []
    for i in range(200):
        around = [rng.choice(MANY) for _ in range(30)] if i % 4 else rows[-1][1].split()[:15] if rows else ["z"] * 15
        rows.append((i, " ".join(around[:15] + line + around[15:])))
    monkeypatch.setattr(P, "HOT", hot)
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    assert result(remove_phrases(df)) == brute(rows, 20)


@pytest.mark.parametrize("seed", range(20))
def test_text_parts_overlap(seed):
    rng = random.Random(seed)
    text = "".join(rng.choice(["a", "bc", "é", " ", "\n", " ", "\x85"]) for _ in range(rng.randint(0, 200))).encode()
    words = text.split()
    overlap = rng.randint(0, 5)
    end = 0
    for first, part in text_parts(memoryview(text), overlap, rng.randint(1, 30)):
        assert first == max(0, end - overlap) and words[first:first + len(part)] == part
        end = first + len(part)
    assert end == len(words)


@pytest.mark.parametrize("seed", range(20))
def test_windows_have_the_anchor_of_their_words(seed):
    rng = random.Random(seed)
    texts = [[rng.choice(["a", "b", "c"]) for _ in range(rng.randint(0, 60))] for _ in range(6)]
    hashes, bounds = WordHasher(ANY_WORD).group([" ".join(t).encode() for t in texts])
    number, start, stop, anchor = segments_of(hashes, bounds, 20)
    known = {}
    for i, t in enumerate(texts):
        mine = np.flatnonzero(number == i)
        assert [p for k in mine for p in range(start[k], stop[k])] == list(range(max(0, len(t) - 19)))
        for k in mine:
            for p in range(start[k], stop[k]):
                assert known.setdefault(tuple(t[p:p + 20]), anchor[k]) == anchor[k]


@pytest.mark.parametrize("wide", [False, True])
def test_automaton_finds_every_copy_of_every_passage(monkeypatch, wide):
    rng = random.Random(4)
    contents = [[rng.choice("ab") for _ in range(rng.randint(4, 12))] for _ in range(60)]
    ids = np.array([ord(w) - 97 for c in contents for w in c])
    bounds = np.concatenate([[0], np.cumsum([len(c) for c in contents])])
    first, length = passages(ids, bounds, np.ones(len(contents), np.int64), 4)
    text, width = symbols(ids, 0x200000 if wide else 2)
    assert width == 1 + wide
    automaton = compiled(text, width, first, length)
    letters = "".join("ab"[i] for i in ids)
    copies = {}
    for k, (a, n) in enumerate(zip(first, length, strict=True)):
        copies[letters[a:a + n]] = k
    assert len(copies) == len(first)
    covered = set()
    for i, c in enumerate(contents):
        own = "".join(c)
        got = sorted(((end + 1) // width, p) for end, p in automaton.iter(text[bounds[i] * width:bounds[i + 1] * width]))
        assert got == sorted((e, p) for w, p in copies.items() for e in range(len(w), len(own) + 1) if own[e - len(w):e] == w)
        covered |= {(i, q) for e, p in got for q in range(e - int(length[p]), e - 3)}
    counts = {}
    for c in contents:
        for q in range(len(c) - 3):
            counts["".join(c[q:q + 4])] = counts.get("".join(c[q:q + 4]), 0) + 1
    assert covered == {(i, q) for i, c in enumerate(contents) for q in range(len(c) - 3) if counts["".join(c[q:q + 4])] > 1}


def test_small_helpers():
    assert settle_equal([(3, 1, 9), (2, 1, 7), (2, 1, 5), (2, 8, 6)]) == ([(2, 1, 5), (2, 8, 6)], [(3, 1, 9), (2, 1, 7)])
    assert merged([[5, 9, 1, 3], [3, 4], [8, 12]]) == [(1, 4), (5, 12)]
    assert list(shard_spans({}, 20)) == []
