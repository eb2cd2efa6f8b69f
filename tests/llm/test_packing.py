import os
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tidepool.llm import packing
from tidepool.llm.packing import best_fit_plan, pack_documents, sequences, token_pieces
from tidepool.llm.queries import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")


def best_fit_decreasing(lengths, capacity):
    """One piece at a time, by a scan of all open bins."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [(room, k) for k, room in enumerate(rooms) if room >= n]
        if fit:
            rooms[min(fit)[1]] -= n
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(30))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 16, 50, 100])
    lengths = [rng.randint(1, capacity) if rng.random() < 0.6 else rng.randint(1, 1 + capacity // 5)
               for _ in range(rng.randint(0, 400))]
    counts = defaultdict(int)
    for n in lengths:
        counts[n] += 1
    plan = best_fit_plan(counts, capacity)
    used = defaultdict(list)
    order = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    for n, c in counts.items():
        rows = order[order[:, 0] == n]
        assert (np.diff(rows[:, 1]) > 0).all() and rows[0, 1] == 0
        for rank in range(c):
            row = rows[np.searchsorted(rows[:, 1], rank, side="right") - 1]
            nth = rank - row[1]
            used[int(row[2] + nth // row[4])].append((int(row[3] + nth % row[4] * n), n))
    rooms = []
    for places in used.values():
        end = 0
        for at, n in sorted(places):
            assert at == end
            end += n
        rooms.append(capacity - end)
    assert sorted(rooms) == best_fit_decreasing(lengths, capacity)


def test_plan_size_does_not_follow_the_rows():
    rng = random.Random(1)
    few = {n: rng.randint(1, 9) for n in range(1, 4097)}
    many = {n: 10**9 + c for n, c in few.items()}
    assert len(best_fit_plan(many)) < 10 * 4096 and len(best_fit_plan(few)) < 10 * 4096


def test_rejects_a_length_that_cannot_fit():
    with pytest.raises(ValueError):
        best_fit_plan({9: 1}, 8)


TEXTS = ["", None, "Hello, World's  end.", "naïve Éclair don't we'll 1234", "<|endoftext|> x<|startoftext|>",
         "a\x1cb\x1d c d\u0085e", "ΣΑΣ Σ İstanbul ǅ ﬁ", "é å", "日本語 emoji 😀😀 ok", "'s 'S we'RE",
         "word " * 5000, "\n\t ", "x" * 3000]


def whole(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)
    return [t.encode(x or "", add_special_tokens=False).ids + [1] for x in texts]


def test_tokens_equal_the_whole_tokenizer(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = defaultdict(list)
    for r in token_pieces(docs, PATH, with_ids=True).orderBy("doc_id", "piece").collect():
        assert r.start == len(got[r.doc_id]) and r.length == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        got[r.doc_id] += r.ids
    assert [got[k] for k in range(len(TEXTS))] == whole(TEXTS)


def test_sampled_documents_equal_the_whole_tokenizer(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    want = {r.doc_id: ids for r, ids in zip(rows, whole([r.text for r in rows]), strict=True)}
    got = defaultdict(list)
    for r in token_pieces(docs, PATH, with_ids=True).orderBy("doc_id", "piece").collect():
        got[r.doc_id] += r.ids
    assert got == want


def check_gapless(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        end = 0
        for at, n in sorted(places):
            assert at == end
            end += n
        assert end <= capacity
    return [sum(n for _, n in p) for p in by.values()]


def test_packing_round_trip(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    packed = pack_documents(docs, PATH).cache()
    rows = packed.collect()
    filled = check_gapless(rows, 4096)
    assert len(filled) == len(best_fit_decreasing([r.length for r in rows], 4096))
    ids = {r.sequence_id: r.ids for r in sequences(docs, PATH, packed).collect()}
    for r in rows:
        cut = ids[r.sequence_id][r.offset:r.offset + r.length]
        assert zlib.crc32(np.array(cut, "<u4").tobytes()) == r.ids_crc32


def test_blocks_of_a_frequent_length(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_BLOCK", 50)
    docs = spark.range(900).selectExpr("id as doc_id", "case when id % 3 = 0 then 'one two' else repeat('w ', int(id % 40)) end as text")
    rows = pack_documents(docs, PATH, capacity=64).collect()
    assert len(rows) == 900
    filled = check_gapless(rows, 64)
    assert len(filled) == len(best_fit_decreasing([r.length for r in rows], 64))


def test_repeated_rows_nulls_and_empty_table(spark):
    rows = [(1, "a b"), (1, "a b"), (None, None), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as length", "2 as piece")
    got = pack_documents(docs, PATH).collect()
    assert len(got) == 4 and len(check_gapless(got, 4096)) == 1
    assert pack_documents(docs.limit(0), PATH).collect() == []
    assert os.path.exists(PATH)
