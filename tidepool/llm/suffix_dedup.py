"""Removal of repeated byte strings through suffix arrays built in two stages.

Every ``size``-byte window of a text has one anchor: the least of its k-gram
hashes. Consecutive windows with one anchor are a segment, and equal windows
have equal anchors wherever they are, so all copies of a window meet in the
bucket of their anchor's hash. Segments whose anchor occurs once in the corpus
stay at home (a bitmap of fixed size tells). Of equal segments in one task
only the one of the least document travels; the others are known to go.

A bucket joins its segments to one text and sorts its suffixes in two stages:
those smaller than their successors are sorted directly, all others are
induced from them by scans of the byte buckets in order. Common prefixes of
neighbours then tell the classes of equal windows; a window goes where the
least document of its class is less than its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import in_batches, partitions, utf8_values
from tidepool.llm.repeats import KEYED_DDL, bits_for, pack, place_rows, repeated, unpack
from tidepool.llm.words import mixed

GRAM = 16
# Texts that are cut into segments together: their arrays of numbers stay in a core's cache.
CHUNK_BYTES = 1 << 18
TASK_BYTES = 12 << 20
NO_ID = (1 << 63) - 1


# ---- suffix arrays ----------------------------------------------------------

def words_at(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one big-endian number; zeros follow the text."""
    padded = np.concatenate([text, np.zeros(15, np.uint8)])
    out = np.empty(len(text) + 8, np.uint64)
    for k in range(8):
        part = padded[k:k + (len(padded) - k) // 8 * 8].view(">u8").astype(np.uint64)
        out[k::8] = part[:len(out[k::8])]
    return out[:len(text)]


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor; the last one, a separator, is."""
    ends = np.flatnonzero(np.append(text[1:] != text[:-1], True))  # last place of each run of equal bytes
    run = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=-1))
    rises = np.append(text[ends[:-1]] < text[ends[:-1] + 1], True)
    return rises[run]


def direct_sort(places: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of their first ``depth`` bytes; ties keep the order of the text.

    ``words`` are ``masked``: nothing is compared behind a separator.
    """
    first = words[places]
    by = np.argsort(first, kind="stable")
    order, word = places[by], first[by]
    alive = word & np.uint64(255) != 0  # no separator so far
    new = np.concatenate([[True], word[1:] != word[:-1]]) if len(order) else alive
    for at in range(8, depth, 8):
        tied = ~new & alive
        tied[:-1] |= ~new[1:] & alive[:-1]
        rows = np.flatnonzero(tied)
        if not len(rows):
            break
        group = np.cumsum(new)[rows]
        word = words[order[rows] + at]
        by = np.lexsort((word, group))
        order[rows], word = order[rows][by], word[by]
        alive[rows] = word & np.uint64(255) != 0
        differs = np.concatenate([[False], (group[1:] == group[:-1]) & (word[1:] != word[:-1])])
        new[rows] |= differs
    return order


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of a text in the order of at least their first ``depth`` bytes.

    Byte 0 separates; suffixes that are equal up to one follow the text. The
    suffixes smaller than their successors are sorted directly, the others
    induced: a scan of the buckets of first bytes, each from its least entry
    on, puts the predecessor of every entry at the head of its own bucket.
    """
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    small = smaller_than_next(text) | (text == 0)
    sizes = np.bincount(text, minlength=256)
    ends = np.cumsum(sizes)
    heads = ends - sizes
    array = np.full(n, -1, np.int64)

    separators = np.flatnonzero(text == 0)
    array[:len(separators)] = separators
    words = words_at(text)
    placed = direct_sort(np.flatnonzero(small & (text != 0)), masked(words), depth)
    counts = np.bincount(text[placed], minlength=256)
    first = np.concatenate([[0], np.cumsum(counts)])
    tails = ends - counts
    for c in np.flatnonzero(counts):
        array[tails[c]:ends[c]] = placed[first[c]:first[c + 1]]
    tails[0] = 0

    heads = heads.copy()
    for c in np.flatnonzero(sizes):
        done = ends[c] - sizes[c]
        while True:  # entries put here by smaller bytes, then those they put here themselves
            stop = heads[c] if c else 0
            if done >= stop:
                break
            _induce(array[done:stop], text, small, heads, array)
            done = stop
        _induce(array[tails[c]:ends[c]], text, small, heads, array)
    return array


def _induce(entries: np.ndarray, text: np.ndarray, small: np.ndarray, heads: np.ndarray, array: np.ndarray) -> None:
    before = entries[entries > 0] - 1
    before = before[~small[before]]
    if not len(before):
        return
    byte = text[before]
    order = np.argsort(byte, kind="stable")
    before, byte = before[order], byte[order]
    starts = np.flatnonzero(np.concatenate([[True], byte[1:] != byte[:-1]]))
    counts = np.diff(np.append(starts, len(byte)))
    at = np.repeat(heads[byte[starts]] - starts, counts) + np.arange(len(byte))
    array[at] = before
    heads[byte[starts]] += counts


def masked(words: np.ndarray) -> np.ndarray:
    """Words with all bytes behind their first zero byte zero too."""
    # Few words have a zero byte: a borrow into the top bit of a byte that had none tells.
    rows = np.flatnonzero((words - np.uint64(0x0101010101010101)) & ~words & np.uint64(0x8080808080808080))
    part = words[rows]
    alive = np.ones(len(rows), bool)
    for k in range(8):
        shift = np.uint64(56 - 8 * k)
        alive &= (part >> shift) & np.uint64(255) != 0
        part[~alive] &= ~(np.uint64(255) << shift)
    out = words.copy()
    out[rows] = part
    return out


def common_prefix(a: np.ndarray, b: np.ndarray, words: np.ndarray, size: int) -> np.ndarray:
    """Whether the suffixes at ``a`` and ``b`` share their first ``size`` bytes."""
    rows = np.arange(len(a))  # those that are equal so far
    for at in [*range(0, size - 7, 8), size - 8]:
        rows = rows[words[a[rows] + at] == words[b[rows] + at]]
    same = np.zeros(len(a), bool)
    same[rows] = True
    return same


def least_owners(segments: list[bytes], owners: np.ndarray, size: int) -> list[np.ndarray]:
    """For each segment, per window: the least owner of an equal window in any segment."""
    lengths = np.array([len(s) for s in segments], np.int64)
    # Bytes are raised by one, so that 0 separates; UTF-8 does not use 255.
    raw = np.frombuffer(b"\xff".join(segments) + b"\xff", np.uint8)
    text = raw + np.uint8(1)
    starts = np.cumsum(lengths + 1) - lengths - 1
    windows = lengths - size + 1
    owner = np.repeat(owners, lengths + 1)
    inside = np.arange(len(text)) - np.repeat(starts, lengths + 1)
    is_window = inside < np.repeat(windows, lengths + 1)
    array = suffix_array(text, size)
    order = array[is_window[array]]
    words = words_at(text)
    new = np.concatenate([[True], ~common_prefix(order[1:], order[:-1], words, size)])
    first = np.flatnonzero(new)
    least = np.empty(len(text), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(owner[order], first), np.diff(np.append(first, len(order))))
    return [least[s:s + w] for s, w in zip(starts, windows, strict=True)]


# ---- segments ---------------------------------------------------------------

def segments_of(texts: list[bytes], size: int) -> tuple[np.ndarray, ...]:
    """Segments of texts: text number, first window, one past the last window, anchor hash."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    lengths = np.array([len(t) for t in texts], np.int64)
    if len(data) < size:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty.astype(np.uint64)
    words = words_at(data)
    grams = mixed(words[:len(data) - GRAM + 1] * np.uint64(0x9E3779B97F4A7C15) ^ mixed(words[8:len(data) - GRAM + 9]))
    place = np.arange(len(grams), dtype=np.uint64)
    low = (grams >> np.uint64(24) << np.uint64(24)) | place  # chunks are under 2^24 bytes: ties go left
    width, reach = size - GRAM + 1, 1
    while 2 * reach <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if reach < width:
        low = np.minimum(low[:len(low) - (width - reach)], low[width - reach:])
    anchor = (low & np.uint64((1 << 24) - 1)).astype(np.int64)
    ends = np.cumsum(lengths)
    number = np.repeat(np.arange(len(texts)), lengths)[:len(anchor)]
    valid = np.arange(len(anchor)) + size <= ends[number]
    change = np.empty(len(anchor), bool)
    change[0] = True
    change[1:] = (anchor[1:] != anchor[:-1]) | (number[1:] != number[:-1])
    start = np.flatnonzero(change & valid)
    stop = np.flatnonzero(np.append((change[1:] | ~valid[1:]) & valid[:-1], valid[-1])) + 1
    base = (ends - lengths)[number[start]]
    return number[start], start - base, stop - base, grams[anchor[start]]


def text_chunks(batches: Iterator[pa.RecordBatch], text_column: int, limit: int) -> Iterator[tuple[list, list[bytes]]]:
    """Runs of rows (all columns before the text) with at most about ``limit`` bytes of text.

    A longer text is a run of its own.
    """
    rows, texts, size = [], [], 0
    for batch in batches:
        heads = list(zip(*[c.to_pylist() for c in batch.columns[:text_column]], strict=True))
        for head, text in zip(heads, utf8_values(batch.column(text_column)), strict=True):
            if texts and size + len(text) > limit:
                yield rows, texts
                rows, texts, size = [], [], 0
            rows.append(head)
            texts.append(bytes(text))
            size += len(text)
    if texts:
        yield rows, texts


def chunk_segments(texts: list[bytes], size: int) -> tuple[np.ndarray, ...]:
    """``segments_of`` for any lengths: long texts go in parts that overlap by a window."""
    if sum(map(len, texts)) <= 3 * CHUNK_BYTES:
        return segments_of(texts, size)
    found = []
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - size + 1), CHUNK_BYTES):
            number, start, stop, anchor = segments_of([text[at:at + CHUNK_BYTES + size - 1]], size)
            found.append((number + i, start + at, stop + at, anchor))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


# ---- Spark jobs -------------------------------------------------------------

def anchor_places(texts: DataFrame, size: int, bits: int) -> DataFrame:
    """Places of the anchors' hashes, each once a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            loose, held = [], 0
            for _, chunk in text_chunks(batches, 1, CHUNK_BYTES):
                number, _, _, anchor = chunk_segments(chunk, size)
                order = np.lexsort((number, anchor))
                number, anchor = number[order], anchor[order]
                keep = np.ones(len(anchor), bool)
                keep[1:] = (anchor[1:] != anchor[:-1]) | (number[1:] != number[:-1])
                loose.append(anchor[keep])
                held += len(loose[-1])
                if held > 4 << 20:
                    yield from place_rows(np.concatenate(loose), bits)
                    loose, held = [], 0
            if held:
                yield from place_rows(np.concatenate(loose), bits)

        yield from in_batches(rows(), pa.schema([("key", pa.int64()), ("data", pa.binary())]))

    return texts.select("h", "text").mapInArrow(run, KEYED_DDL)


# Parts of a bucket that are sorted one after another.
PARTS = 16

PACKED = pa.schema([("bucket", pa.int64()), *[(c, pa.binary()) for c in ("ids", "hs", "starts", "lengths", "parts", "data")]])


def packed_row(bucket: int, ids: list, hs: list, starts: list, lengths: list, parts: list, data: bytes | None) -> tuple:
    return (bucket, *[pack(np.array(x, np.int64)) for x in (ids, hs, starts, lengths)], pack(np.array(parts, np.uint32)),
            data if data is None else zstandard.ZstdCompressor(level=3).compress(data))


def local_rows(texts: DataFrame, size: int, bitmap, buckets: int) -> DataFrame:
    """Packed rows of a task for each bucket, and, without data, the spans that the task knows to go.

    A row holds segments of many texts, in the order of their bytes, which
    lie one after another in ``data``; the arrays tell whose they are, where
    they start, how long they are and 32 bits of their anchor's hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def resolve(held):
            """Least document of each segment here; its copies in other documents go."""
            least: dict[bytes, list] = {}  # content -> least document, the one copy of the content that is kept
            for (key, _), text, segments in held:
                for start, stop, _, _ in segments:
                    own = text[start:stop + size - 1]
                    found = least.get(own)
                    if found is None:
                        least[own] = [key, own]
                    elif key < found[0]:
                        found[0] = key
            sent: dict[int, list] = {}
            gone: list[tuple] = []
            while held:
                (key, h), text, segments = held.pop()
                for start, stop, bucket, part in segments:
                    best, own = least[text[start:stop + size - 1]]
                    if best == key:
                        sent.setdefault(bucket, []).append((own, key, h, start, part))
                    elif gone and gone[-1][:2] == (key, h) and gone[-1][2] + gone[-1][3] >= start:
                        gone[-1] = (key, h, gone[-1][2], stop + size - 1 - gone[-1][2])
                    else:
                        gone.append((key, h, start, len(own)))
            least.clear()
            for bucket in list(sent):
                rows = sorted(sent.pop(bucket))
                data, ids, hs, starts, parts = zip(*rows, strict=True)
                yield packed_row(bucket, ids, hs, starts, [len(x) for x in data], parts, b"".join(data))
            if gone:
                ids, hs, starts, lengths = zip(*gone, strict=True)
                yield packed_row(hs[0] % buckets, ids, hs, starts, lengths, [0], None)

        def rows():
            held, load = [], 0
            for heads, chunk in text_chunks(batches, 2, CHUNK_BYTES):
                number, start, stop, anchor = chunk_segments(chunk, size)
                chosen = np.flatnonzero(bitmap.value.has(anchor))
                place = mixed(anchor[chosen]) >> np.uint64(20)
                bucket = (place % np.uint64(buckets)).astype(np.int64)
                part = (place // np.uint64(buckets) & np.uint64(0xFFFFFFFF)).astype(np.int64)
                cuts = np.searchsorted(number[chosen], np.arange(len(chunk) + 1))
                for i, (head, text) in enumerate(zip(heads, chunk, strict=True)):
                    own = slice(cuts[i], cuts[i + 1])
                    if own.stop > own.start:
                        at = chosen[own]
                        held.append(((NO_ID if head[0] is None else head[0], head[1]), text,
                                     list(zip(start[at].tolist(), stop[at].tolist(), bucket[own].tolist(),
                                              part[own].tolist(), strict=True))))
                        load += len(text)
                if load > TASK_BYTES:
                    yield from resolve(held)
                    held, load = [], 0
            yield from resolve(held)

        yield from in_batches(rows(), PACKED, weight=lambda r: sum(len(x) for x in r[1:] if x))

    return texts.mapInArrow(run, "bucket bigint, ids binary, hs binary, starts binary, lengths binary, "
                                 "parts binary, data binary")


def bucket_spans(rows: DataFrame, size: int, buckets: int) -> DataFrame:
    """Spans ``id, h, spans`` that tasks know or the suffix arrays of the buckets tell to go."""
    schema = pa.schema([("id", pa.int64()), ("h", pa.int64()), ("spans", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settle(segments):
            """Spans that go of one part of a bucket: (content, id, h, start, anchor) of each segment.

            Windows of different contents can be equal only under one anchor:
            a content that has its anchor to itself needs no sorting.
            """
            known: dict[bytes, int] = {}
            least: list[int] = []
            anchors: list[int] = []
            uses = []
            for own, key, h, start, anchor in segments:
                k = known.setdefault(own, len(known))
                if k == len(least):
                    least.append(key)
                    anchors.append(anchor)
                elif key < least[k]:
                    least[k] = key
                uses.append((key, h, start, k))
            contents = list(known)
            known.clear()
            lengths = [len(x) for x in contents]
            _, group, n = np.unique(np.array(anchors, np.int64), return_inverse=True, return_counts=True)
            mixed_up = np.flatnonzero(n[group] > 1).tolist()
            # Runs of windows that go, for the owner of a segment; all others lose it whole.
            runs: dict[int, list] = {}
            if mixed_up:
                owners = least_owners([contents[k] for k in mixed_up], np.array([least[k] for k in mixed_up], np.int64), size)
                for k, own in zip(mixed_up, owners, strict=True):
                    gone = np.flatnonzero(own < least[k])
                    if len(gone):
                        cut = np.flatnonzero(np.diff(gone) > 1)
                        runs[k] = list(zip(gone[np.append(0, cut + 1)].tolist(),
                                           (gone[np.append(cut, len(gone) - 1)] + size).tolist(), strict=True))
            out: dict[tuple[int, int], list[int]] = {}
            for key, h, start, k in uses:
                for a, b in runs.get(k, ()) if key == least[k] else ((0, lengths[k]),):
                    out.setdefault((key, h), []).extend((start + a, start + b))
            for (key, h), spans in out.items():
                yield key, h, spans

        def finish(held):
            by_part: list[list] = [[] for _ in range(PARTS)]
            for ids, hs, starts, lengths, parts, data in held:
                text = zstandard.ZstdDecompressor().decompress(data)
                lengths = unpack(lengths, np.int64)
                ends = np.cumsum(lengths)
                for anchor, key, h, start, a, b in zip(
                        unpack(parts, np.uint32).tolist(), unpack(ids, np.int64).tolist(), unpack(hs, np.int64).tolist(),
                        unpack(starts, np.int64).tolist(), (ends - lengths).tolist(), ends.tolist(), strict=True):
                    by_part[anchor % PARTS].append((text[a:b], key, h, start, anchor))
            for k, segments in enumerate(by_part):
                if segments:
                    yield from settle(segments)
                by_part[k] = []

        def found():
            now, held = None, []
            for batch in batches:
                for bucket, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    if row[-1] is None:
                        ids, hs, starts, lengths = (unpack(x, np.int64).tolist() for x in row[:4])
                        for key, h, start, length in zip(ids, hs, starts, lengths, strict=True):
                            yield key, h, [start, start + length]
                        continue
                    if bucket != now:
                        if held:
                            yield from finish(held)
                        now, held = bucket, []
                    held.append(row)
            if held:
                yield from finish(held)

        yield from in_batches(found(), schema, weight=lambda r: 8 * len(r[2]))

    dealt = rows.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "id bigint, h bigint, spans array<bigint>")


def merged_spans(spans: list[list[int]]) -> list[tuple[int, int]]:
    """Maximal runs of bytes that any of the spans covers; spans that touch are one run."""
    flat = sorted((part[i], part[i + 1]) for part in spans for i in range(0, len(part), 2))
    out: list[tuple[int, int]] = []
    for a, b in flat:
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 50) -> DataFrame:
    """Per row ``id_col, spans, kept``: the byte runs that go, and the bytes that stay.

    A byte goes when a string of ``size`` bytes that covers it also starts in
    a document with a smaller id; strings are judged on the input. ``spans``
    are (start, end) of maximal runs in the UTF-8 text, ``kept`` the other
    bytes in order (binary, as a cut can part a character). Ids are integers.
    Defined cases: a null text is empty; a text shorter than ``size`` stays
    whole; a null id counts as larger than all others; rows with equal ids
    take nothing from each other; an empty table gives an empty result; other
    columns are ignored.
    """
    if size < GRAM:
        raise ValueError(f"strings are at least {GRAM} bytes long")
    spark = docs.sparkSession
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(body).alias("h"), body.alias("text"))
    expected = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = bits_for(expected // 18)
    buckets = 2 * partitions(spark)
    bitmap = spark.sparkContext.broadcast(repeated(anchor_places(texts, size, bits), bits))
    gone = bucket_spans(local_rows(texts, size, bitmap, buckets), size, buckets)
    gone = gone.groupBy("id", "h").agg(F.collect_list("spans").alias("all"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                            ("kept", pa.binary())])

        def out():
            for batch in batches:
                for key, text, spans in zip(batch.column(0).to_pylist(), utf8_values(batch.column(1)),
                                            batch.column(2).to_pylist(), strict=True):
                    runs = merged_spans(spans or [])
                    edges = [0, *[x for r in runs for x in r], len(text)]
                    kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                    yield key, [{"start": a, "end": b} for a, b in runs], kept

        yield from in_batches(out(), schema, weight=lambda r: len(r[2]) + 48 * len(r[1]))

    keyed = texts.withColumn("k", F.coalesce("id", F.lit(NO_ID)))
    named = gone.select(F.col("id").alias("k"), F.col("h"), "all")
    joined = keyed.join(named, ["k", "h"], "left").select("id", "text", "all")
    return joined.mapInArrow(cut, "id bigint, spans array<struct<start: bigint, end: bigint>>, kept binary").select(
        F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "spans", "kept")

