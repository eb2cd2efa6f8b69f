"""Removal of repeated word passages through sharded Aho-Corasick automata.

A window is ``size`` consecutive words of one text. Its anchor is the least of
the hashes of its ``GRAM``-word grams, so equal windows have equal anchors
wherever they are. Consecutive windows with one anchor are a segment.

1. A bitmap of fixed size tells which anchors recur in the corpus. Segments of
   the others stay at home, as do all but the first of equal segments that
   meet in one task: those are known to go.
2. The other segments travel to the shard of their anchor, so a shard sees
   every text that can hold one of its windows. Windows of an anchor that is
   hot travel one by one under their own hash.
3. A shard confirms the windows that recur among its segments and joins those
   that always follow each other to passages. It compiles an automaton of its
   passages and streams its segments through it; the automaton, which
   compares words and not hashes, locates every occurrence of every passage.
4. All occurrences but the first lose their words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import in_batches, partitions, utf8_values
from tidepool.llm.repeats import KEYED, KEYED_DDL, SLICE_BITS, Bitmap, bits_for, folded, pack, place_rows, unpack, unpack_sorted
from tidepool.llm.words import ANY_WORD, WordHasher, mixed, ngram_hashes
from tidepool.session import materialize

GRAM = 8

# Bytes of text that are hashed together; longer texts go in parts.
PART_BYTES = 2 << 20

# Bytes of text whose equal segments a task settles itself.
TASK_BYTES = 24 << 20

# An anchor with so many segments in one part of a task is counted; one that
# has ``HOT`` in all, or a share of 2^-16 of the corpus's words, is hot.
LOCAL_HOT = 16
HOT = 4096

# A null id counts as larger than all others.
NO_ID = (1 << 63) - 1

PLACE_BITS = np.uint64(24)


# ---- words and segments -----------------------------------------------------

def text_parts(text: memoryview | bytes, overlap: int, limit: int = PART_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(number of its first word, words) of parts of a text; a part starts ``overlap`` words before the last one's end."""
    at, before, tail = 0, 0, []
    while at < len(text):
        end = min(len(text), at + limit)
        piece = bytes(text[at:end])
        while end < len(text) and piece[-1:] not in b" \t\n\x0b\x0c\r":  # to the end of the word
            more = bytes(text[end:end + limit])
            cut = min((k for k in (more.find(c) for c in b" \t\n\x0b\x0c\r") if k >= 0), default=len(more) - 1) + 1
            piece += more[:cut]
            end += cut
        words = tail + piece.split()
        yield before - len(tail), words
        before += len(words) - len(tail)
        tail = words[max(0, len(words) - overlap):] if overlap else []
        at = end


def segments_of(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Segments of texts whose word hashes lie one after another, text i from ``bounds[i]`` on.

    Returns text number, first window, one past the last window (as words of
    the text) and the anchor's hash.
    """
    empty = np.zeros(0, np.int64)
    if len(hashes) < size:
        return empty, empty, empty, empty.astype(np.uint64)
    grams = ngram_hashes(hashes, GRAM)
    mask = (np.uint64(1) << PLACE_BITS) - np.uint64(1)
    low = (grams >> PLACE_BITS << PLACE_BITS) | np.arange(len(grams), dtype=np.uint64)  # ties go left
    width, reach = size - GRAM + 1, 1
    while 2 * reach <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if reach < width:
        low = np.minimum(low[:len(low) - (width - reach)], low[width - reach:])
    anchor = (low & mask).astype(np.int64)
    number = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:len(anchor)]
    valid = np.arange(len(anchor)) + size <= bounds[1:][number]
    change = np.ones(len(anchor), bool)
    change[1:] = (anchor[1:] != anchor[:-1]) | (number[1:] != number[:-1])
    start = np.flatnonzero(change & valid)
    stop = np.flatnonzero(np.append((change[1:] | ~valid[1:]) & valid[:-1], valid[-1])) + 1
    base = bounds[number[start]]
    return number[start], start - base, stop - base, grams[anchor[start]]


def part_groups(batches: Iterator[pa.RecordBatch], text_column: int, overlap: int) -> Iterator[list[tuple]]:
    """Runs of (head, first word, words, bytes) of parts of texts, with about PART_BYTES together."""
    held, load = [], 0
    for batch in batches:
        heads = list(zip(*[c.to_pylist() for c in batch.columns[:text_column]], strict=True))
        for head, text in zip(heads, utf8_values(batch.column(text_column)), strict=True):
            for first, words in text_parts(text, overlap):
                joined = b" ".join(words)
                if held and load + len(joined) > PART_BYTES:
                    yield held
                    held, load = [], 0
                held.append((head, first, words, joined))
                load += len(joined)
    if held:
        yield held


def group_segments(hasher: WordHasher, group: list[tuple], size: int) -> tuple[np.ndarray, ...]:
    """Word hashes, bounds and segments of a run of parts."""
    hashes, bounds = hasher.group([joined for *_, joined in group])
    return hashes, bounds, *segments_of(hashes, bounds, size)


# ---- recurring anchors ------------------------------------------------------

HOT_KEY = 2 << SLICE_BITS


def anchor_rows(texts: DataFrame, size: int, bits: int) -> DataFrame:
    """Places of the anchors' hashes, and counts of those that are frequent in a part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(ANY_WORD)

        def rows():
            loose, held = [], 0
            for group in part_groups(batches, 1, size - 1):
                *_, anchor = group_segments(hasher, group, size)
                loose.append(anchor)
                held += len(anchor)
                if held > 2 << 20:
                    yield from packed(np.concatenate(loose))
                    loose, held = [], 0
            if held:
                yield from packed(np.concatenate(loose))

        def packed(anchors):
            yield from place_rows(anchors, bits)
            found, n = np.unique(anchors, return_counts=True)
            found, n = found[n >= LOCAL_HOT], n[n >= LOCAL_HOT]
            place = (mixed(found) >> np.uint64(64 - SLICE_BITS)).astype(np.int64)
            for k in np.unique(place).tolist():
                own = place == k
                yield HOT_KEY + k, pack(np.concatenate([found[own], n[own].astype(np.uint64)]))

        yield from in_batches(rows(), KEYED)

    return texts.select("text").withColumn("head", F.lit(0)).select("head", "text").mapInArrow(run, KEYED_DDL)


def recurring_anchors(rows: DataFrame, bits: int, hot: int) -> tuple[Bitmap, np.ndarray]:
    """The bitmap of places named twice (twice 2^bits bits), and the sorted anchors that are hot."""
    width = bits - SLICE_BITS

    def start(key: int):
        return {} if key >= HOT_KEY else np.zeros(1 << width, np.uint8)

    def add(state, data: bytes):
        if isinstance(state, dict):
            found, n = np.split(unpack(data, np.uint64), 2)
            for a, k in zip(found.tolist(), n.tolist(), strict=True):
                state[a] = state.get(a, 0) + k
            return state
        at = unpack_sorted(data[1:], np.uint32)
        state[at] = 2 if data[0] else np.minimum(state[at] + 1, 2)
        return state

    def done(state) -> bytes:
        if isinstance(state, dict):
            return np.array([a for a, k in state.items() if k >= hot], np.uint64).tobytes()
        return np.packbits(state > 1, bitorder="little").tobytes()

    bitmap, often = Bitmap(bits), [np.zeros(0, np.uint64)]
    each = 1 << (width - 3)
    for r in folded(rows, start, add, done).collect():
        if r.key >= HOT_KEY:
            often.append(np.frombuffer(r.data, np.uint64))
        else:
            bitmap.data[r.key * each:(r.key + 1) * each] = np.frombuffer(r.data, np.uint8)
    return bitmap, np.sort(np.concatenate(often))


# ---- segments travel --------------------------------------------------------

PACKED = pa.schema([("shard", pa.int64()), *[(c, pa.binary()) for c in ("ids", "hs", "starts", "lengths", "data")]])
PACKED_DDL = "shard bigint, ids binary, hs binary, starts binary, lengths binary, data binary"


def packed_row(shard: int, ids, hs, starts, lengths, data: bytes | None) -> tuple:
    return (shard, *[pack(np.array(x, np.int64)) for x in (ids, hs, starts, lengths)],
            data if data is None else zstandard.ZstdCompressor(level=3).compress(data))


def sent_segments(group: list[tuple], found: tuple[np.ndarray, ...], size: int, bitmap: Bitmap, hot: np.ndarray):
    """(part number, first window, one past the last, routing hash) of the segments whose anchors recur."""
    hashes, bounds, number, start, stop, anchor = found
    kept = bitmap.has(anchor)
    number, start, stop, anchor = number[kept], start[kept], stop[kept], anchor[kept]
    if not len(hot) or not len(anchor):
        return number, start, stop, mixed(anchor)
    at = np.searchsorted(hot, anchor)
    is_hot = hot[np.minimum(at, len(hot) - 1)] == anchor
    n = (stop - start)[is_hot]
    each = np.repeat(start[is_hot], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    whose = np.repeat(number[is_hot], n)
    own = ngram_hashes(hashes, size)[bounds[whose] + each] if len(each) else np.zeros(0, np.uint64)
    cold = ~is_hot
    return (np.concatenate([number[cold], whose]), np.concatenate([start[cold], each]),
            np.concatenate([stop[cold], each + 1]), np.concatenate([mixed(anchor[cold]), own]))


def settle_equal(uses: list[tuple[int, int, int]]) -> tuple[list[tuple], list[tuple]]:
    """Of (id, hash, start) of one and the same words: those that stay, those that go.

    The least id stays; within each of its rows the first start does.
    """
    best = min(uses)[0]
    first: dict[int, int] = {}
    for key, h, start in uses:
        if key == best and start < first.get(h, NO_ID):
            first[h] = start
    stay, go = [], []
    for use in uses:
        (stay if use[0] == best and first[use[1]] == use[2] else go).append(use)
    return stay, go


def travelling(texts: DataFrame, size: int, shared, shards: int) -> DataFrame:
    """Packed rows of a task for each shard and, without data, the spans that the task knows to go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(ANY_WORD)
        bitmap, hot = shared.value

        def resolve(held: dict[bytes, list], route: dict[bytes, int]):
            sent: dict[int, list] = {}
            gone: list[tuple] = []
            for words, uses in held.items():
                if len(uses) > 1:
                    uses, go = settle_equal(uses)
                    n = words.count(b" ") + 1
                    gone += [(*use, n) for use in go]
                rows = sent.setdefault(route[words], [])
                rows += [(words, *use) for use in uses]
            for shard, rows in sent.items():
                rows.sort()
                data, ids, hs, starts = zip(*rows, strict=True)
                yield packed_row(shard, ids, hs, starts, [len(x) for x in data], b"".join(data))
            gone.sort()
            for at in range(0, len(gone), 1 << 16):
                ids, hs, starts, lengths = zip(*gone[at:at + (1 << 16)], strict=True)
                yield packed_row(hs[0] % shards, ids, hs, starts, lengths, None)

        def rows():
            held: dict[bytes, list] = {}
            route: dict[bytes, int] = {}
            load = 0
            for group in part_groups(batches, 2, size - 1):
                found = group_segments(hasher, group, size)
                number, start, stop, key = sent_segments(group, found, size, bitmap, hot)
                shard = (key >> np.uint64(20)) % np.uint64(shards)
                for i, a, b, s in zip(number.tolist(), start.tolist(), (stop + size - 1).tolist(), shard.tolist(), strict=True):
                    (key_id, h), first, words, _ = group[i]
                    own = b" ".join(words[a:b])
                    uses = held.get(own)
                    if uses is None:
                        uses = held[own] = []
                        route[own] = s
                        load += len(own) + 200
                    uses.append((NO_ID if key_id is None else key_id, h, first + a))
                    load += 100
                if load > TASK_BYTES:
                    yield from resolve(held, route)
                    held, route, load = {}, {}, 0
            yield from resolve(held, route)

        yield from in_batches(rows(), PACKED, weight=lambda r: sum(len(x) for x in r[1:] if x))

    return texts.mapInArrow(run, PACKED_DDL)


# ---- shards -----------------------------------------------------------------

def symbols(ids: np.ndarray, n: int) -> tuple[str, int]:
    """Words as text for the automaton: one character a word, or two of disjoint ranges."""
    if n < 0x10FFFF:
        return (ids + 1).astype("<u4").tobytes().decode("utf-32-le", "surrogatepass"), 1
    two = np.empty((len(ids), 2), "<u4")
    two[:, 0], two[:, 1] = 1 + (ids & 0xFFFF), 0x10001 + (ids >> 16)
    return two.tobytes().decode("utf-32-le", "surrogatepass"), 2


def passages(ids: np.ndarray, bounds: np.ndarray, uses: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and number of words of one copy of every passage that recurs.

    ``ids`` are the words of contents that lie one after another, content i
    from ``bounds[i]`` on, used ``uses[i]`` times. A passage is a run of
    windows that follow each other wherever one of them occurs.
    """
    none = np.zeros(0, np.int64)
    hashes = ngram_hashes(mixed(ids.astype(np.uint64) + np.uint64(1)), size)
    content = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:len(hashes)]
    place = np.flatnonzero(np.arange(len(hashes)) + size <= bounds[1:][content])
    if not len(place):
        return none, none
    content = content[place]
    _, kind = np.unique(hashes[place], return_inverse=True)
    n = np.bincount(kind, weights=uses[content])
    follows = np.append(content[1:] == content[:-1], False)  # the next window is of the same content
    after = np.where(follows, np.append(kind[1:], -1), -1)
    before = np.where(np.append(False, follows[:-1]), np.append(-1, kind[:-1]), -1)
    order = np.argsort(kind, kind="stable")
    starts = np.flatnonzero(np.diff(kind[order], prepend=-1))

    def only(other):
        """For each kind the one kind beside it, -1 if there are several or none at some place."""
        least, most = np.minimum.reduceat(other[order], starts), np.maximum.reduceat(other[order], starts)
        return np.where(least == most, least, -1)

    behind, ahead = only(after), only(before)
    joined = follows & (behind[kind] >= 0) & (behind[kind] == after)
    joined[:-1] &= ahead[kind[1:]] == kind[:-1]
    first = np.flatnonzero(~np.append(False, joined[:-1]))
    length = np.diff(np.append(first, len(kind)))
    copy = order[starts]  # the first place of each kind
    chosen = (copy[kind[first]] == first) & (n[kind[first]] > 1)
    return place[first[chosen]], length[chosen] + size - 1


def compiled(text: str, width: int, first: np.ndarray, length: np.ndarray) -> ahocorasick.Automaton:
    """The automaton of passages, given by their first words and lengths; values are their numbers."""
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for k, (a, n) in enumerate(zip((first * width).tolist(), (length * width).tolist(), strict=True)):
        automaton.add_word(text[a:a + n], k)
    automaton.make_automaton()
    return automaton


def shard_spans(held: dict[bytes, list], size: int) -> Iterator[tuple[int, int, list[int]]]:
    """(id, hash, starts and ends) of what goes, of one shard's words and their uses."""
    if not held:
        return
    contents = list(held)
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for c in contents for w in c.split(b" ")], np.int64)
    bounds = np.concatenate([[0], np.cumsum([c.count(b" ") + 1 for c in contents])])
    text, width = symbols(ids, len(known))
    known.clear()
    first, length = passages(ids, bounds, np.array([len(u) for u in held.values()]), size)
    if not len(first):
        return
    automaton = compiled(text, width, first, length)
    lengths = length.tolist()
    found: list[list[tuple[int, int]]] = [[] for _ in lengths]
    edges = (bounds * width).tolist()
    for k in range(len(contents)):
        for end, p in automaton.iter(text[edges[k]:edges[k + 1]]):
            found[p].append((k, (end + 1) // width - lengths[p]))
    out: dict[tuple[int, int], list[int]] = {}
    users = list(held.values())
    for n, places in zip(lengths, found, strict=True):
        uses = [(key, h, start + off) for k, off in places for key, h, start in users[k]]
        if len(uses) > 1:
            for key, h, start in settle_equal(uses)[1]:
                out.setdefault((key, h), []).extend((start, start + n))
    for (key, h), spans in out.items():
        yield key, h, spans


SPANS = pa.schema([("id", pa.int64()), ("h", pa.int64()), ("spans", pa.list_(pa.int64()))])
SPANS_DDL = "id bigint, h bigint, spans array<bigint>"


def located(rows: DataFrame, size: int, shards: int) -> DataFrame:
    """Spans (in words) that tasks know or the shards' automata tell to go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            now, held = None, {}
            for batch in batches:
                for shard, ids, hs, starts, lengths, data in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    ids, hs, starts, lengths = (unpack(x, np.int64).tolist() for x in (ids, hs, starts, lengths))
                    if data is None:
                        for key, h, start, n in zip(ids, hs, starts, lengths, strict=True):
                            yield key, h, [start, start + n]
                        continue
                    if shard != now:
                        yield from shard_spans(held, size)
                        now, held = shard, {}
                    data, at = zstandard.ZstdDecompressor().decompress(data), 0
                    for key, h, start, n in zip(ids, hs, starts, lengths, strict=True):
                        held.setdefault(data[at:at + n], []).append((key, h, start))
                        at += n
            yield from shard_spans(held, size)

        yield from in_batches(found(), SPANS, weight=lambda r: 8 * len(r[2]) + 16)

    dealt = rows.repartition(partitions(rows.sparkSession), "shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(run, SPANS_DDL)


# ---- texts ------------------------------------------------------------------

def merged(spans: list[list[int]]) -> list[tuple[int, int]]:
    """Maximal runs of words that any of the spans covers."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((part[i], part[i + 1]) for part in spans for i in range(0, len(part), 2)):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def kept_words(text: memoryview, runs: list[tuple[int, int]]) -> tuple[int, Iterator[bytes]]:
    """Parts of the words outside the runs, joined by blanks; the last item is the number of words, as bytes."""
    edges = [0, *[x for r in runs for x in r], NO_ID]
    kept = list(zip(edges[::2], edges[1::2], strict=True))
    n, at = 0, 0
    for first, words in text_parts(text, 0):
        end = first + len(words)
        n = end
        while at < len(kept) and kept[at][0] < end:
            a, b = kept[at]
            if a < b and max(a, first) < min(b, end):
                yield b" ".join(words[max(a, first) - first:min(b, end) - first])
            if b > end:
                break
            at += 1
    yield n


def remove_phrases(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, size: int = 20,
                   with_text: bool = True) -> DataFrame:
    """Per row ``id_col, n_words, n_removed, kept_sha256, spans`` and, if asked for, ``kept``.

    Words are runs of anything but ASCII white space. A word goes when a
    window of ``size`` words that covers it also starts earlier: in a
    document with a smaller id, or before in the same one; windows are judged
    on the input. ``spans`` are (start, end) of maximal runs that go, in
    words; ``kept`` the others joined by blanks. Ids are integers.

    Defined cases: a null or empty text has no words; one of fewer than
    ``size`` words stays whole; a null id counts as larger than all others;
    rows with equal ids take nothing from each other; equal rows have equal
    results; a very long text is read in parts of two megabytes that overlap
    by a window; an empty table gives an empty result; other columns are
    ignored.
    """
    if size < GRAM:
        raise ValueError(f"windows are at least {GRAM} words long")
    spark = docs.sparkSession
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(body).alias("h"), body.alias("text"))
    expected = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = bits_for(expected // 40)
    shards = 8 * partitions(spark)
    shared = spark.sparkContext.broadcast(
        recurring_anchors(anchor_rows(texts, size, bits), bits, max(HOT, expected // 6 >> 16)))
    gone = located(travelling(texts, size, shared, shards), size, shards)
    gone = materialize(gone.groupBy("id", "h").agg(F.collect_list("spans").alias("all")))
    return _cut(docs.schema[id_col].dataType, texts, gone, with_text).withColumnRenamed("id", id_col)


def _cut(id_type, texts: DataFrame, gone: DataFrame, with_text: bool) -> DataFrame:
    """Texts without their spans. Only texts that the bitmap of documents with spans names travel."""
    spark = texts.sparkSession
    row_key = F.xxhash64("id", "h")
    bits = bits_for(gone.count())

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                keys = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                yield from place_rows(np.concatenate([keys, keys]), bits)

        yield from in_batches(rows(), KEYED)

    bitmap, _ = recurring_anchors(gone.select(row_key.alias("k")).mapInArrow(places, KEYED_DDL), bits, HOT)
    shared = spark.sparkContext.broadcast(bitmap)

    def result(text, runs) -> tuple:
        digest, kept, n, between = hashlib.sha256(), [], 0, b""
        for part in kept_words(text, runs):
            if isinstance(part, int):
                n = part
                continue
            digest.update(between + part)
            if with_text:
                kept.append(between + part)
            between = b" "
        removed = sum(b - a for a, b in runs)
        return (n, removed, digest.hexdigest(), [{"start": a, "end": b} for a, b in runs],
                *([b"".join(kept).decode()] if with_text else []))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Results of texts that lose nothing; the others as they are."""
        def rows():
            for batch in batches:
                keys = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                ids, hs = batch.column(0).to_pylist(), batch.column(2).to_pylist()
                for key, h, cut, text in zip(ids, hs, shared.value.has(keys).tolist(), utf8_values(batch.column(3)), strict=True):
                    if cut:
                        yield key, h, str(text, "utf-8"), None
                    else:
                        yield key, h, None, dict(zip(names, result(text, []), strict=True))

        yield from in_batches(rows(), pa.schema([("id", pa.int64()), ("h", pa.int64()), ("text", pa.string()), ("done", made)]),
                              weight=lambda r: len(r[2] or "") + 100 + (len(r[3].get("kept", "")) if r[3] else 0))

    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    fields = [("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("spans", span),
              *([("kept", pa.string())] if with_text else [])]
    made, names = pa.struct(fields), [f[0] for f in fields]
    ddl = ["n_words bigint", "n_removed bigint", "kept_sha256 string", "spans array<struct<start: bigint, end: bigint>>",
           *(["kept string"] if with_text else [])]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for key, text, done, spans in zip(batch.column(0).to_pylist(), utf8_values(batch.column(1)),
                                                  batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                    yield key, *(done.values() if done else result(text, merged(spans or [])))

        yield from in_batches(rows(), pa.schema([("id", pa.int64()), *fields]), weight=lambda r: 200 + len(r[-1]))

    seen = texts.select("id", F.xxhash64(F.coalesce("id", F.lit(NO_ID)), "h").alias("k"), "h", "text").mapInArrow(
        whole, f"id bigint, h bigint, text string, done struct<{', '.join(d.replace(' ', ': ', 1) for d in ddl)}>")
    spans = gone.select(F.col("id").alias("k"), F.col("h").alias("g"), "all")
    on = (F.coalesce("id", F.lit(NO_ID)) == F.col("k")) & (F.col("h") == F.col("g"))
    joined = seen.join(spans, on, "left").select("id", "text", "done", "all")
    out = joined.mapInArrow(cut, f"id bigint, {', '.join(ddl)}")
    return out.withColumn("id", F.col("id").cast(id_type))
