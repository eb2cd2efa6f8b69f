"""Benchmark decontamination: rare word-pair seeds, then Smith-Waterman alignment.

1. A seed is an n-gram of two words of a test item, next to each other or one
   word apart, with the place of its first word. All documents are counted
   for them, and an item keeps the seeds of its rarest places: the fewer
   documents and items hold a pair, the earlier it is taken.
2. Seeds join documents to items. Each hit places the item on the document,
   with room for all gaps that an alignment of the least score can have;
   places that overlap are one window.
3. The words of the item are aligned to those of the window by
   Smith-Waterman with linear gaps; the score is the share of the best
   possible one. A window is skipped if the pairs or the words that it lacks
   keep every alignment under the threshold, which loses nothing.

No alignment of the threshold t is lost. With M pairs of equal words and cost
E (mismatches and gaps) it scores 2M - E >= 2tm of an item of m words. Between
two equal pairs that follow each other, max(di, dj) - 1 is paid; steps that pay
two or more are at most E / 2 <= M - tm, so at least tm - 1 of the M - 1 steps
go on by one or two words on both sides. Each is a pair at a place of its own
of the item. Hence of the m - 1 places at least ceil(tm) - 1 have a hit, and
any m - ceil(tm) + 1 of them, the rarest too, have one.

The test items are a stated query set: they go to the tasks in blocks of at
most ``BLOCK_WORDS`` words (seeds included some 40 MB), two scans of the
documents for each block, one to count and one to align. Documents never move.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import in_batches, utf8_values
from tidepool.llm.words import PLAIN_WORD, STEP, WordHasher, grouped, mixed, plain_text

BLOCK_WORDS = 1 << 20
MIN_SCORE = 0.5

# Smith-Waterman scores of a pair of words.
MATCH, MISMATCH, GAP = 2, -1, -1

# The words of a seed are one or two places apart, in the item and in the document.
STEPS = (1, 2)

FILTER_BITS = 20
# Places of items on a document that are held at once.
HITS = 1 << 20


def pair_hashes(words: np.ndarray, step: int) -> np.ndarray:
    """One hash for each two words that are ``step`` places apart, whatever the step."""
    return mixed(words[:-step] * STEP + words[step:])


class PairTable:
    """Sorted distinct pair hashes and a bitmap of their first bits."""

    def __init__(self, pairs: np.ndarray):
        self.pairs = pairs
        self.table = np.zeros(1 << FILTER_BITS, bool)
        self.table[(pairs >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True

    def find(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``pairs`` of those in the table, and their rows of it."""
        at = np.flatnonzero(self.table[(pairs >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        if not len(at) or not len(self.pairs):
            return at[:0], at[:0]
        row = np.minimum(np.searchsorted(self.pairs, pairs[at]), len(self.pairs) - 1)
        same = self.pairs[row] == pairs[at]
        return at[same], row[same]


class SeedIndex:
    """Seeds of a block of items, with the places they have in them."""

    def __init__(self, words_of: list[np.ndarray], seeds: np.ndarray, items: np.ndarray, places: np.ndarray,
                 min_score: float):
        order = np.argsort(seeds, kind="stable")
        pairs, first = np.unique(seeds[order], return_index=True)
        self.table, self.first = PairTable(pairs), np.append(first, len(seeds))
        self.items, self.places = items[order].astype(np.int32), places[order].astype(np.int32)
        self.words_of, self.min_score = words_of, min_score
        self.sizes = np.array([len(w) for w in words_of], np.int64)
        self.pads = np.maximum(2, ((1 - min_score) * MATCH * self.sizes).astype(np.int64) // -GAP)
        self.needs = np.array([needed(len(w), min_score) for w in words_of], np.int64)

    def windows(self, words: np.ndarray, pairs: list[np.ndarray]) -> Iterator[tuple[int, int, int]]:
        """(item, begin, end) of the stretches of a document that an item may be aligned to."""
        if not len(self.sizes):
            return
        apart = len(words) + 1  # items stand behind each other on one line, no window reaches the next
        begin, end = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for at, row in map(self.table.find, pairs):
            count = self.first[row + 1] - self.first[row]
            before = np.concatenate([[0], np.cumsum(count)])
            lo = 0
            while lo < len(row):
                hi = max(lo + 1, int(np.searchsorted(before, before[lo] + HITS, "right")) - 1)
                n = count[lo:hi]
                entry = np.arange(before[hi] - before[lo]) + np.repeat(self.first[row[lo:hi]] - (before[lo:hi] - before[lo]), n)
                item = self.items[entry].astype(np.int64)
                place = np.repeat(at[lo:hi], n) - self.places[entry]
                line = item * apart
                begin = np.append(begin, line + np.maximum(0, place - self.pads[item]))
                end = np.append(end, line + np.minimum(len(words), place + self.sizes[item] + self.pads[item]))
                begin, end = merged(begin, end)
                lo = hi
        for b, e in zip(begin.tolist(), end.tolist(), strict=True):
            yield b // apart, b % apart, b % apart + e - b

    def may_hold(self, item: int, pairs: list[np.ndarray], begin: int, end: int) -> bool:
        """Whether enough places of the item have a pair within a window of the document."""
        target, need = self.words_of[item], self.needs[item]
        held = np.concatenate([p[begin:max(begin, end - s)] for s, p in zip(STEPS, pairs, strict=True)])
        good = np.zeros(len(target) - 1, bool)
        for step in STEPS:
            own = pair_hashes(target, step)
            good[:len(own)] |= np.isin(own, held)
        return int(good.sum()) >= need


def needed(size: int, min_score: float) -> int:
    """Places with a hit that an item of ``size`` words has in every alignment of the least score."""
    return math.ceil(min_score * size - 1e-9) - 1


def merged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges that touch made one, in order."""
    if not len(begin):
        return begin, end
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], begin[1:] > end[:-1]])
    return begin[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]


def smith_waterman(a: np.ndarray, b: np.ndarray) -> tuple[float, int, int]:
    """Best local alignment score of two word sequences and its last places (i, j)."""
    best, end = 0, (0, 0)
    gaps = np.arange(len(b) + 1) * -GAP
    last = np.zeros(len(b) + 1, np.int64)
    for i, word in enumerate(a):
        row = np.zeros(len(b) + 1, np.int64)
        row[1:] = np.maximum(last[:-1] + np.where(b == word, MATCH, MISMATCH), last[1:] + GAP)
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row + gaps) - gaps  # gaps along b
        j = int(row.argmax())
        if row[j] > best:
            best, end = int(row[j]), (i, j - 1)
        last = row
    return best, *end


def align(item: np.ndarray, words: np.ndarray, min_score: float) -> tuple[float, int, int] | None:
    """Score (0 to 1) and the aligned range of ``words``, or None below ``min_score``."""
    most = MATCH * len(item)
    # Each word of the aligned part of the item that ``words`` lacks is a mismatch or a gap.
    sums = np.concatenate([[0], np.cumsum(np.where(np.isin(item, words), MATCH, max(MISMATCH, GAP)))])
    if (sums - np.minimum.accumulate(sums)).max() < min_score * most:
        return None
    score, i, j = smith_waterman(item, words)
    if score < min_score * most:
        return None
    _, _, back = smith_waterman(item[i::-1], words[j::-1])
    return score / most, j - back, j + 1


def _item_words(items: DataFrame, id_col: str, text_col: str, blocks: int, block: int):
    """Words of a block's items, from its rows; the block is bounded by BLOCK_WORDS."""
    rows = (items.where(F.pmod(F.xxhash64(text_col), F.lit(blocks)) == block)
            .select(id_col, text_col).distinct().collect())
    hasher = WordHasher(PLAIN_WORD)
    return [(r[0], hasher.of(plain_text(r[1] or ""))) for r in rows]


def _text_words(batch: pa.RecordBatch, column: int, hasher: WordHasher) -> Iterator[np.ndarray]:
    """Word hashes of each text of a column; null texts have none."""
    texts = (plain_text(str(t, "utf-8", "replace")) for t in utf8_values(batch.column(column)))
    for group in grouped(((t,) for t in texts), lambda row: row[0]):
        words, bounds = hasher.group([t for t, in group])
        for start, end in zip(bounds[:-1], bounds[1:], strict=True):
            yield words[start:end]


def _blocks(docs: DataFrame, text_col: str, items: DataFrame, item_id_col: str, item_text_col: str,
            min_score: float) -> Iterator[tuple[SeedIndex, list]]:
    """Seed index and ids of each block of items."""
    size = items.agg(F.sum(F.length(item_text_col)), F.count("*")).first()
    blocks = 1 + int(size[0] or 0) // 4 // BLOCK_WORDS
    for block in range(blocks):
        entries = [(k, w) for k, w in _item_words(items, item_id_col, item_text_col, blocks, block)
                   if needed(len(w), min_score) > 0]
        if entries:
            keys, words_of = map(list, zip(*entries, strict=True))
            yield _rare_seeds(docs.select(F.col(text_col).cast("string")), words_of, min_score), keys


def _rare_seeds(texts: DataFrame, words_of: list[np.ndarray], min_score: float) -> SeedIndex:
    """Both pairs of the rarest places of each item, as many as the proof above asks for."""
    sizes = [len(w) for w in words_of]
    item = np.concatenate([np.repeat(np.arange(len(sizes)), [max(0, n - step) for n in sizes]) for step in STEPS])
    place = np.concatenate([np.arange(max(0, n - step)) for step in STEPS for n in sizes])
    seeds = np.concatenate([pair_hashes(w, step) for step in STEPS for w in words_of])
    pairs, row, in_items = np.unique(seeds, return_inverse=True, return_counts=True)
    # Windows that a seed opens: documents that hold it times places in items.
    cost = ((_documents_with(texts, pairs) + 1) * in_items)[row]
    first = np.concatenate([[0], np.cumsum(sizes)])
    total = np.zeros(first[-1], np.int64)
    np.add.at(total, first[item] + place, cost)
    chosen = np.zeros(first[-1], bool)
    for k, n in enumerate(sizes):
        rarest = np.argsort(total[first[k]:first[k] + n - 1], kind="stable")[:n - 1 - needed(n, min_score) + 1]
        chosen[first[k] + rarest] = True
    kept = chosen[first[item] + place]
    return SeedIndex(words_of, seeds[kept], item[kept], place[kept], min_score)


def _documents_with(texts: DataFrame, pairs: np.ndarray) -> np.ndarray:
    """How many of all texts hold each pair; one sum for each pair of a block of items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, table = WordHasher(PLAIN_WORD), PairTable(pairs)
        count = np.zeros(len(pairs), np.int64)
        for batch in batches:
            for words in _text_words(batch, 0, hasher):
                count[np.unique(np.concatenate([table.find(pair_hashes(words, s))[1] for s in STEPS]))] += 1
        row = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(count[row])], ["row", "n"])

    total = np.zeros(len(pairs), np.int64)
    counted = texts.mapInArrow(run, "row bigint, n bigint").groupBy("row").agg(F.sum("n").alias("n")).toArrow()
    total[counted["row"].to_numpy()] = counted["n"].to_numpy()
    return total


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id_col: str = "item_id", item_text_col: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """One row per document and test item that it holds: ``id_col, item_id_col, score, start_word, end_word``.

    ``score`` is the best alignment of the item to the document, 1 for an
    unchanged copy; words are lower-cased runs of letters and digits, and
    [start_word, end_word) counts them in the document. Every copy of
    ``min_score`` or more is found, whatever its edits. Defined cases: null
    and empty texts match nothing, nor do items of at most 1 / ``min_score``
    words; a null id stays null; repeated rows give a row each; repeated items
    count once; empty tables give an empty result; other columns are ignored;
    of equally good places in a document the first counts; a very long text is
    searched whole, with memory for its words.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    item_type = items.schema[item_id_col].dataType.simpleString()
    schema = f"_id {id_type}, _item {item_type}, score double, start_word bigint, end_word bigint"
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string"))
    found = docs.sparkSession.createDataFrame([], schema)
    for index, keys in _blocks(docs, text_col, items, item_id_col, item_text_col, min_score):

        def run(batches: Iterator[pa.RecordBatch], index=index, keys=keys) -> Iterator[pa.RecordBatch]:
            hasher, out = WordHasher(PLAIN_WORD), None

            def rows(batch):
                for key, words in zip(batch.column(0).to_pylist(), _text_words(batch, 1, hasher), strict=True):
                    best: dict[int, tuple] = {}
                    for item, *place in _leaks_of(words, index):
                        if item not in best or place[0] > best[item][0]:
                            best[item] = place
                    for item, place in best.items():
                        yield key, keys[item], *place

            for batch in batches:
                out = out or pa.schema([("_id", batch.schema.field(0).type), ("_item", pa.array(keys).type),
                                        ("score", pa.float64()), ("start_word", pa.int64()),
                                        ("end_word", pa.int64())])
                yield from in_batches(rows(batch), out)

        found = found.unionAll(texts.mapInArrow(run, schema))
    return found.withColumnRenamed("_id", id_col).withColumnRenamed("_item", item_id_col)


def drop_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
               item_text_col: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` that hold no test item by ``find_leaks``, with all their columns."""
    at = docs.columns.index(text_col)
    kept = docs
    for index, _ in _blocks(docs, text_col, items, item_id_col, item_text_col, min_score):

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            hasher = WordHasher(PLAIN_WORD)
            for batch in batches:
                clean = [next(_leaks_of(words, index), None) is None for words in _text_words(batch, at, hasher)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        kept = kept.mapInArrow(run, docs.schema)
    return kept


def _leaks_of(words: np.ndarray, index: SeedIndex) -> Iterator[tuple[int, float, int, int]]:
    """(item, score, start, end) of each window that holds an item."""
    pairs = [pair_hashes(words, step) for step in STEPS]
    for item, begin, end in index.windows(words, pairs):
        if index.may_hold(item, pairs, begin, end):
            got = align(index.words_of[item], words[begin:end], index.min_score)
            if got:
                yield item, got[0], begin + got[1], begin + got[2]
