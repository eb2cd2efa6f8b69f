"""Context-tree weighting over bytes: code lengths of whole texts.

A text is the sequence of its lower-cased words, joined by single spaces and
ended by byte 255, which UTF-8 never uses. Each byte is eight binary
decisions. A decision has a context tree over the ``depth`` bytes before it;
each node holds the Krichevsky-Trofimov estimate of its counts, and weighting
mixes the estimates of all depths: P(node) = (KT + product of P(children)) / 2.

The probability of a byte depends only on the (depth + 1)-gram that ends with
it, so Spark works on distinct grams:

1. documents become batches of about ``BATCH_TEXT`` bytes (stored compressed);
   their contexts of two bytes are counted, and those of three bytes where two
   hold more than ``HOT_SHARE`` of all places. These contexts are dealt to
   buckets of about ``BUCKET_TEXT`` places each, in order, and the buckets to
   the tasks, so that all have much the same to do;
2. a task sends each distinct gram of a batch once, to the bucket of its
   context. The nodes below a bucket's contexts lie in that bucket;
3. buckets weight their subtrees from the deepest contexts up. What the nodes
   above need of them is summed by Spark: for depth 1 at most 65,280 rows, for
   hot contexts of depth 2 at most 255 each, of which there are 1 / HOT_SHARE;
4. buckets go down again and give every gram its log probability, which goes
   back to the batches that asked, once each;
5. a second pass over the batches adds up the probabilities of each text.

Held-out texts add their grams with a count of zero. Word counts for the base
score travel the same way, by the words' hashes. No step holds more than a
batch or a bucket, and both exchanges follow the distinct grams of batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import in_batches, partitions, utf8_values
from tidepool.llm.words import ANY_WORD, WordHasher, mixed, word_hash
from tidepool.session import materialize

DEPTH = 7
END = 255
MAX_DEPTH = 7  # a gram of eight bytes is one 64-bit number
BATCH_TEXT = 32 << 20
BLOCK_TEXT = 1 << 20
BUCKET_TEXT = 2 << 20
MOST_BUCKETS = 1 << 14
HOT_SHARE = 1 / 512
MERGE_KEYS = 4 << 20
GRAMS, WORDS = 0, 1
END_HASH = np.uint64(word_hash(b""))


# ---- the tree ---------------------------------------------------------------

def log_gamma_half(n: np.ndarray) -> np.ndarray:
    """log of gamma(n + 1/2) / gamma(1/2) for counts."""
    x = n + 8.5
    stirling = (x - 0.5) * np.log(x) - x + 0.9189385332046727 + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    for k in range(8):
        stirling = stirling - np.log(n + 0.5 + k)
    return stirling - 0.5723649429247001


def log_factorial(n: np.ndarray) -> np.ndarray:
    x = n + 9.0
    stirling = (x - 0.5) * np.log(x) - x + 0.9189385332046727 + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    for k in range(8):
        stirling = stirling - np.log(n + 1.0 + k)
    return stirling


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """log probability that the Krichevsky-Trofimov estimator gives to the counts."""
    return log_gamma_half(n0) + log_gamma_half(n1) - log_factorial(n0 + n1)


class Level:
    """Nodes of one depth and one decision, by sorted id (context bytes, then decided bits)."""

    def __init__(self, ids: np.ndarray, n0: np.ndarray, n1: np.ndarray):
        self.ids, self.n0, self.n1 = ids, n0, n1
        self.kt = log_kt(n0, n1)
        self.weighted, self.stop = self.kt, np.ones(len(ids))

    def mix(self, children: np.ndarray) -> None:
        """Weight this level's estimates against ``children``, the log products below."""
        both = np.logaddexp(self.kt, children)
        self.weighted = both - np.log(2)
        self.stop = np.exp(self.kt - both)


def starts_of(ids: np.ndarray) -> np.ndarray:
    return np.concatenate([[True], ids[1:] != ids[:-1]]) if len(ids) else np.zeros(0, bool)


def shorten(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted (context, byte) ids without the farthest context byte, and the place of each old one."""
    short = (symbols >> np.uint64(16) << np.uint64(8)) | (symbols & np.uint64(255))
    return np.unique(short, return_inverse=True)


def parent_ids(ids: np.ndarray, k: int) -> np.ndarray:
    """Ids of the nodes one context byte shorter, for decision ``k``."""
    return (ids >> np.uint64(8 + k) << np.uint64(k)) | (ids & np.uint64((1 << k) - 1))


class Subtrees:
    """Weighted nodes of the depths ``depth`` to ``root`` over sorted distinct grams with counts."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, depth: int, root: int):
        self.depth, self.root = depth, root
        self.levels: dict[tuple[int, int], Level] = {}
        self.node: dict[tuple[int, int], np.ndarray] = {}  # of each symbol
        self.symbols, self.of_gram = {depth: grams}, {depth: None}
        up, n = None, counts
        for d in range(depth, root - 1, -1):
            if d < depth:
                self.symbols[d], up = shorten(self.symbols[d + 1])
                n = np.bincount(up, n, len(self.symbols[d]))
                below = self.of_gram[d + 1]
                self.of_gram[d] = up if below is None else up[below]
            symbols = self.symbols[d]
            for k in range(8):
                ids = symbols >> np.uint64(8 - k)
                first = starts_of(ids)
                node = self.node[d, k] = np.cumsum(first, dtype=np.int32) - np.int32(1)
                bit = ((symbols >> np.uint64(7 - k)) & np.uint64(1)).astype(bool)
                size = int(first.sum())
                n1 = np.bincount(node, np.where(bit, n, 0), size)
                level = self.levels[d, k] = Level(ids[first], np.bincount(node, n, size) - n1, n1)
                if d < depth:
                    child = self.levels[d + 1, k]
                    at = node[up[starts_of(self.node[d + 1, k])]]
                    level.mix(np.bincount(at, child.weighted, size))
                    child.weighted = child.kt = child.ids = None  # not read again

    def summary(self) -> list[tuple[int, int, int, float, float, float]]:
        """What the nodes above the root's need: (depth, decision, id, n0, n1, log product of children)."""
        rows = []
        for k in range(8):
            ids, *sums = parents(self.levels[self.root, k], k)
            rows += zip([self.root - 1] * len(ids), [k] * len(ids), ids.tolist(),
                        *[x.tolist() for x in sums], strict=True)
        return rows

    def log10_bytes(self, top: dict[tuple[int, int], Level]) -> np.ndarray:
        """log10 probability of each gram's last byte given the bytes before it.

        A context without training counts leaves the estimate to the node above.
        """
        product = np.ones(len(self.symbols[self.depth]))
        for k in range(8):
            p, seen_below = None, None
            for d in range(self.depth, -1, -1):
                own = self.symbols[max(d, self.root)]
                of_gram = self.of_gram[max(d, self.root)]
                if d >= self.root:
                    level, node = self.levels[d, k], self.node[d, k]
                else:
                    level = top[d, k]
                    context = own >> np.uint64(8 * (self.root - d + 1))
                    decided = (own & np.uint64(255)) >> np.uint64(8 - k)
                    node = np.searchsorted(level.ids, (context << np.uint64(k)) | decided)
                bit = ((own >> np.uint64(7 - k)) & np.uint64(1)).astype(bool)
                n0, n1 = level.n0[node], level.n1[node]
                kt = (np.where(bit, n1, n0) + 0.5) / (n0 + n1 + 1)
                seen, deeper = n0 + n1 > 0, 1 - level.stop[node]
                if of_gram is not None:
                    kt, seen, deeper = kt[of_gram], seen[of_gram], deeper[of_gram]
                p = kt if p is None else np.where(seen_below, kt + deeper * (p - kt), kt)
                seen_below = seen
            product *= p
        return np.log10(product)


def parents(level: Level, k: int) -> tuple[np.ndarray, ...]:
    """The nodes above those of a level: ids, n0, n1 and log products of children."""
    ids, at = np.unique(parent_ids(level.ids, k), return_inverse=True)
    return ids, *[np.bincount(at, x, len(ids)) for x in (level.n0, level.n1, level.weighted)]


def top_levels(rows: list[tuple[int, int, int, float, float, float]]) -> dict[tuple[int, int], Level]:
    """Levels of depth 1 and 0, and of depth 2 for hot contexts, from the ``summary`` rows of all buckets."""
    levels = {}
    for k in range(8):
        above = None
        for d in (2, 1, 0):
            own = np.array([r[2:] for r in rows if r[0] == d and r[1] == k], float).reshape(-1, 4)
            known = [own[:, 0].astype(np.uint64), own[:, 1], own[:, 2], own[:, 3]]
            if above is not None:
                known = [np.concatenate(x) for x in zip(known, above, strict=True)]
            ids, at = np.unique(known[0], return_inverse=True)
            n0, n1, below = (np.bincount(at, x, len(ids)) for x in known[1:])
            level = levels[d, k] = Level(ids, n0, n1)
            level.mix(below)
            above = parents(level, k)
    return levels


# ---- texts as grams ---------------------------------------------------------

def spelled(text: bytes) -> bytes:
    """The words with A-Z lower-cased, joined by single spaces, and the end."""
    return b" ".join(text.lower().split()) + b"\xff"


def grams_of(texts: list[bytes], depth: int, before: list[bytes] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The grams of texts and where each text's begin.

    Contexts start as the last bytes ``before`` each text, or as END bytes.
    """
    pad = b"\xff" * depth
    joined = b"".join(p + t for p, t in zip(before or [pad] * len(texts), texts, strict=True))
    data = np.frombuffer(joined, np.uint8).astype(np.uint64)
    gram = np.zeros(len(data) - depth if len(data) else 0, np.uint64)
    # The most recent context byte comes first, the predicted byte last.
    for j in range(1, depth + 1):
        gram |= data[depth - j:len(data) - j] << np.uint64(8 * (depth + 1 - j))
    gram |= data[depth:]
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes + depth) - sizes - depth  # in `gram`, which lacks the first `depth` places
    inside = np.ones(len(gram), bool)
    for s in starts[1:]:
        inside[s - depth:s] = False
    return gram[inside], np.cumsum(sizes) - sizes


def gram_parts(texts: list[bytes], depth: int) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Grams of texts, of some BLOCK_TEXT bytes at a time: the numbers of the texts, grams, where each begins."""
    owners, parts, before, size = [], [], [], 0
    pad = b"\xff" * depth
    for i, text in enumerate(texts):
        for at in range(0, len(text), BLOCK_TEXT):
            owners.append(i)
            parts.append(text[at:at + BLOCK_TEXT])
            before.append(text[at - depth:at] if at else pad)
            size += len(parts[-1])
            if size >= BLOCK_TEXT:
                yield owners, *grams_of(parts, depth, before)
                owners, parts, before, size = [], [], [], 0
    if parts:
        yield owners, *grams_of(parts, depth, before)


def word_parts(text: bytes) -> Iterator[bytes]:
    """A spelled text's words in parts of at most BLOCK_TEXT bytes, or of one longer word."""
    at, last = 0, len(text) - 1  # without the end
    while last - at > BLOCK_TEXT:
        cut = text.rfind(b" ", at, at + BLOCK_TEXT)
        if cut <= at:
            cut = text.find(b" ", at, last)
            if cut < 0:
                break
        yield text[at:cut]
        at = cut + 1
    yield text[at:last]


def token_parts(texts: list[bytes], hasher: WordHasher) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Hashes of the words of texts and of one end each, some BLOCK_TEXT bytes at a time, like ``gram_parts``.

    A word longer than that is hashed apart.
    """
    owners, parts, size = [], [], 0

    def hashed():
        words, bounds = hasher.group(parts)
        ends = np.flatnonzero(np.diff(owners, append=len(texts)))  # parts that end a text
        if owners[-1] == open_text:
            ends = ends[:-1]
        before = np.searchsorted(ends, np.arange(len(parts)))
        return owners, np.insert(words, bounds[1:][ends], END_HASH), bounds[:-1] + before

    for i, text in enumerate(texts):
        open_text = i
        for part in word_parts(text):
            if len(part) > BLOCK_TEXT:
                if parts:
                    yield hashed()
                    owners, parts, size = [], [], 0
                yield [i], np.array([word_hash(part)], np.uint64), np.zeros(1, np.int64)
                continue
            owners.append(i)
            parts.append(part)
            size += len(part)
            if size >= BLOCK_TEXT:
                yield hashed()
                owners, parts, size = [], [], 0
        if not owners or owners[-1] != i:  # its last part has gone
            owners.append(i)
            parts.append(b"")
        open_text = None
    if parts:
        yield hashed()


def summed(texts: int, parts: Iterator[tuple[list[int], np.ndarray, np.ndarray]], values) -> list[np.ndarray]:
    """Sums over the parts of each text of ``values(keys)``, a list of arrays."""
    sums = None
    for owners, keys, first in parts:
        found = values(keys)
        sums = sums or [np.zeros(texts) for _ in found]
        for total, value in zip(sums, found, strict=True):
            np.add.at(total, owners, np.add.reduceat(value, first))
    return sums


# ---- packed arrays ----------------------------------------------------------

def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as compressed differences, byte planes apart."""
    steps = np.diff(keys, prepend=np.zeros(1, np.uint64))
    return pack_plain(steps)


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpack_plain(data, np.uint64), dtype=np.uint64)


def pack_plain(values: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_plain(data: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(dtype).ravel()


class Counts:
    """Distinct keys with their counts, merged whenever many have come together."""

    def __init__(self):
        self.keys, self.counts, self.held = [], [], 0

    def add(self, keys: np.ndarray, training: bool) -> None:
        ids, n = np.unique(keys, return_counts=True)
        self.keys.append(ids)
        self.counts.append(n if training else np.zeros(len(ids), np.int64))
        self.held += len(ids)
        if self.held > MERGE_KEYS:
            self.merge()
            self.held = 0

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if len(self.keys) > 1:
            ids, at = np.unique(np.concatenate(self.keys), return_inverse=True)
            n = np.bincount(at, np.concatenate(self.counts), len(ids)).astype(np.int64)
            self.keys, self.counts = [ids], [n]
        return self.keys[0], self.counts[0]


class Placement:
    """Buckets of contexts: by two bytes, by three where two are hot. At most 2^16 + 256 / HOT_SHARE entries."""

    def __init__(self, pairs: np.ndarray, hot: np.ndarray, triples: np.ndarray, tasks: int):
        """From the places counted by context: all 2^16 ``pairs``, ``hot`` pairs, and 256 ``triples`` for each."""
        total = int(pairs.sum())
        self.per_task = -(-min(total // BUCKET_TEXT, MOST_BUCKETS) // tasks) or 1
        self.buckets, self.tasks = self.per_task * tasks, tasks
        weight = np.concatenate([pairs, triples]).astype(float)
        weight[hot] = 0
        order = np.argsort(np.concatenate([np.arange(1 << 16) << 8, (hot[:, None] << 8 | np.arange(256)).ravel()]),
                           kind="stable")
        middle = np.cumsum(weight[order]) - weight[order] / 2
        bucket = np.empty(len(weight), np.int32)
        bucket[order] = np.minimum(middle * self.buckets / max(total, 1), self.buckets - 1)
        self.pair, self.triple = bucket[:1 << 16], bucket[1 << 16:]
        self.pair[hot] = -1 - np.arange(len(hot))

    def is_hot(self, grams: np.ndarray, depth: int) -> np.ndarray:
        return self.pair[(grams >> np.uint64(8 * (depth - 1))).astype(np.int64)] < 0

    def of(self, space: int, keys: np.ndarray, depth: int) -> np.ndarray:
        if space == WORDS:
            return ((mixed(keys) >> np.uint64(32)) % np.uint64(self.buckets)).astype(np.int64)
        bucket = self.pair[(keys >> np.uint64(8 * (depth - 1))).astype(np.int64)].astype(np.int64)
        at = np.flatnonzero(bucket < 0)
        if len(at):
            third = (keys[at] >> np.uint64(8 * (depth - 2))) & np.uint64(255)
            bucket[at] = self.triple[(-1 - bucket[at]) * 256 + third.astype(np.int64)]
        return bucket


# ---- Spark jobs -------------------------------------------------------------

def text_blocks(docs: DataFrame, id_col: str, text_col: str, held_out: Column) -> DataFrame:
    """Spelled texts in compressed blocks: ``batch, ids, held, sizes, data``. Checkpointed."""
    from pyspark import TaskContext

    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, in_batch = TaskContext.get().partitionId() << 24, 0
        ids, held, texts, size, schema = [], [], [], 0, None
        pack = zstandard.ZstdCompressor(level=3)

        def block():
            rows = [(number, ids, held, [len(t) for t in texts], pack.compress(b"".join(texts)))]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        for batch in batches:
            schema = schema or pa.schema([
                ("batch", pa.int64()), ("ids", pa.list_(batch.schema.field(0).type)),
                ("held", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int64())), ("data", pa.binary())])
            for key, out, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                      utf8_values(batch.column(2)), strict=True):
                ids.append(key)
                held.append(out)
                texts.append(spelled(bytes(text)))
                size += len(texts[-1])
                if size >= BLOCK_TEXT:
                    yield block()
                    in_batch += size
                    if in_batch >= BATCH_TEXT:
                        number, in_batch = number + 1, 0
                    ids, held, texts, size = [], [], [], 0
        if ids:
            yield block()

    rows = docs.select(F.col(id_col), F.coalesce(held_out, F.lit(False)),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return materialize(rows.mapInArrow(
        run, f"batch bigint, ids array<{id_type}>, held array<boolean>, sizes array<bigint>, data binary"))


def block_texts(sizes: list[int], data: bytes) -> list[bytes]:
    whole = zstandard.ZstdDecompressor().decompress(data)
    ends = np.cumsum(sizes).tolist()
    return [whole[e - n:e] for e, n in zip(ends, sizes, strict=True)]


def place_counts(blocks: DataFrame, hot: np.ndarray | None = None) -> np.ndarray:
    """Places of all texts by the two bytes before, or by three for the ``hot`` pairs."""
    size = 1 << 16 if hot is None else 256 * len(hot)
    schema = pa.schema([("context", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(size, np.int64)
        number = np.full(1 << 16, -1, np.int64)
        if hot is not None:
            number[hot] = np.arange(len(hot))
        for batch in batches:
            for row in batch.to_pylist():
                whole = zstandard.ZstdDecompressor().decompress(row["data"])
                for at in range(0, len(whole), BLOCK_TEXT):  # the first of a text go by the text before, as weights may
                    data = np.frombuffer(b"\xff\xff\xff" + whole[at:at + BLOCK_TEXT], np.uint8)
                    pair = (data[2:-1].astype(np.uint16) << np.uint16(8)) | data[1:-2]
                    if hot is None:
                        found += np.bincount(pair, minlength=size)
                    else:
                        of_hot = number[pair]
                        in_hot = of_hot >= 0
                        found += np.bincount(of_hot[in_hot] * 256 + data[:-3][in_hot], minlength=size)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], schema=schema)

    rows = blocks.select("data").mapInArrow(run, "context bigint, n bigint").groupBy("context").agg(
        F.sum("n").alias("n"))
    out = np.zeros(size, np.int64)
    for context, n in rows.collect():  # at most 65,536, or 256 / HOT_SHARE
        out[context] = n
    return out


def placement(blocks: DataFrame, depth: int, tasks: int) -> Placement:
    pairs = place_counts(blocks)
    hot = np.flatnonzero(pairs > pairs.sum() * HOT_SHARE) if depth > 2 else np.zeros(0, np.int64)
    return Placement(pairs, hot, place_counts(blocks, hot) if len(hot) else np.zeros(0, np.int64), tasks)


def batch_keys(blocks: DataFrame, depth: int, places: Placement) -> DataFrame:
    """Distinct keys of each batch with training counts, dealt by bucket: ``bucket, space, batch, keys, counts``.

    Checkpointed; the shuffle files, as large, are removed.
    """
    schema = pa.schema([("bucket", pa.int64()), ("space", pa.int32()), ("batch", pa.int64()),
                        ("keys", pa.binary()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(ANY_WORD)
        number, found = None, None

        def flush():
            for space, counts in enumerate(found):
                keys, n = counts.merge()
                bucket = places.of(space, keys, depth)
                order = np.argsort(bucket, kind="stable")  # keys stay sorted within a bucket
                cuts = np.flatnonzero(np.diff(bucket[order])) + 1
                for at in np.split(order, cuts):
                    if len(at):
                        yield (int(bucket[at[0]]), space, number, pack_keys(keys[at]),
                               pack_plain(n[at].astype(np.uint32)))

        def rows():
            nonlocal number, found
            for batch in batches:
                for row in batch.to_pylist():
                    if row["batch"] != number:
                        if found:
                            yield from flush()
                        number, found = row["batch"], (Counts(), Counts())
                    texts = block_texts(row["sizes"], row["data"])
                    for held in (False, True):
                        part = [t for t, h in zip(texts, row["held"], strict=True) if h == held]
                        if part:
                            for _, keys, _ in gram_parts(part, depth):
                                found[GRAMS].add(keys, not held)
                            for _, keys, _ in token_parts(part, hasher):
                                found[WORDS].add(keys, not held)
            if found:
                yield from flush()

        yield from in_batches(rows(), schema, weight=lambda r: len(r[3]) + len(r[4]))

    keyed = blocks.mapInArrow(run, "bucket bigint, space int, batch bigint, keys binary, counts binary")
    task = F.floor(F.col("bucket") / places.per_task).cast("int")
    dealt = keyed.repartitionById(places.tasks, task).sortWithinPartitions("bucket", "space")
    kept = materialize(dealt)
    dealt.rdd.cleanShuffleDependencies(blocking=True)
    return kept


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, bytes]], np.ndarray, np.ndarray]]:
    """Per bucket and space: the batches' packed keys, all keys and their training counts."""
    now, asked, found = None, [], Counts()

    def whole():
        keys, n = found.merge()
        return now[1], now[0], asked, keys, n.astype(float)

    for batch in batches:
        for row in batch.to_pylist():
            if (row["bucket"], row["space"]) != now:
                if now:
                    yield whole()
                now, asked, found = (row["bucket"], row["space"]), [], Counts()
            asked.append((row["batch"], row["keys"]))
            found.keys.append(unpack_keys(row["keys"]))
            found.counts.append(unpack_plain(row["counts"], np.uint32).astype(np.int64))
            found.held += len(found.keys[-1])
            if found.held > MERGE_KEYS:
                found.merge()
                found.held = 0
    if now:
        yield whole()


def bucket_trees(keys: np.ndarray, n: np.ndarray, depth: int, places: Placement) -> Iterator[tuple[np.ndarray, Subtrees]]:
    """The trees of a bucket's grams: those below contexts of two bytes, and of three; with the places of the grams."""
    hot = places.is_hot(keys, depth)
    for root, at in ((2, np.flatnonzero(~hot)), (3, np.flatnonzero(hot))):
        if len(at):
            yield at, Subtrees(keys[at], n[at], depth, root)


def tree_top(keyed: DataFrame, depth: int, places: Placement) -> tuple[dict[tuple[int, int], Level], int, int]:
    """Levels above those of the buckets, and the number of training tokens and of distinct ones."""
    schema = pa.schema([("d", pa.int32()), ("k", pa.int32()), ("id", pa.int64()), ("n0", pa.float64()),
                        ("n1", pa.float64()), ("below", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for space, _, _, keys, n in by_bucket(batches):
                if space == WORDS:
                    yield -1, 0, 0, float(n.sum()), float((n > 0).sum()), 0.0
                else:
                    for _, tree in bucket_trees(keys, n, depth, places):
                        yield from tree.summary()

        yield from in_batches(rows(), schema)

    sums = keyed.mapInArrow(run, "d int, k int, id bigint, n0 double, n1 double, below double").groupBy(
        "d", "k", "id").agg(F.sum("n0"), F.sum("n1"), F.sum("below"))
    # 256 * 255 nodes of depth 1 at most, 255 / HOT_SHARE of depth 2, and one row of totals.
    rows = [tuple(r) for r in sums.collect()]
    tokens = next((r for r in rows if r[0] == -1), (-1, 0, 0, 0.0, 0.0, 0.0))
    return top_levels([r for r in rows if r[0] != -1]), int(tokens[3]), int(tokens[4])


def batch_answers(keyed: DataFrame, depth: int, places: Placement, top: dict[tuple[int, int], Level]) -> DataFrame:
    """For each batch its keys again with log10 probabilities (grams) or training counts (words)."""
    schema = pa.schema([("batch", pa.int64()), ("space", pa.int32()), ("keys", pa.binary()), ("values", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for space, _, asked, keys, n in by_bucket(batches):
                values = n
                if space == GRAMS:
                    values = np.zeros(len(keys))
                    for at, tree in bucket_trees(keys, n, depth, places):
                        values[at] = tree.log10_bytes(top)
                for number, own in asked:
                    at = np.searchsorted(keys, unpack_keys(own))
                    yield number, space, own, pack_plain(values[at].astype(np.float64 if space else np.float32))

        yield from in_batches(rows(), schema, weight=lambda r: len(r[2]) + len(r[3]))

    return keyed.mapInArrow(run, "batch bigint, space int, keys binary, values binary")


class Answers:
    """The values of a batch's keys."""

    def __init__(self):
        self.keys, self.values, self.index = [], [], None

    def add(self, keys: bytes, values: bytes, dtype) -> None:
        self.keys.append(unpack_keys(keys))
        self.values.append(unpack_plain(values, dtype))

    def of(self, keys: np.ndarray) -> np.ndarray:
        if self.index is None:
            self.index = pd.Index(np.concatenate(self.keys))
            self.all = np.concatenate(self.values).astype(np.float64)
        return self.all[self.index.get_indexer(keys)]


def score_texts(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
                depth: int = DEPTH, smoothing: float = 0.1) -> DataFrame:
    """Scores every text by a model of those that are not ``held_out``.

    Returns ``id_col, held_out, n_tokens, n_known, train_tokens, base_score,
    score, n_bytes, bits_per_byte``. Tokens are the words, split at ASCII
    white space with A-Z lower-cased, and one end. ``score`` is the log10
    probability that context-tree weighting gives to the words joined by
    single spaces, with the end; ``base_score`` that of the token counts with
    additive ``smoothing``. ``bits_per_byte`` is the code length by the bytes
    of that spelling. Defined cases: a null or empty text is its end alone;
    repeated rows count and are scored each; a null id stays null (and a null
    ``held_out`` counts as false); without training texts every byte has
    probability 1/256; an empty table gives an empty result; other columns,
    whatever their names, are ignored; nothing depends on the order of rows,
    so ties do not arise. A very long text is read some ``BLOCK_TEXT`` bytes
    at a time, besides its bytes and words themselves. ``depth`` is 2 to
    ``MAX_DEPTH``; others raise.
    """
    if not 2 <= depth <= MAX_DEPTH:
        raise ValueError(f"depth {depth} is not in 2 to {MAX_DEPTH}")
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    buckets = partitions(spark)
    blocks = text_blocks(docs, id_col, text_col, held_out)
    places = placement(blocks, depth, buckets)
    keyed = batch_keys(blocks, depth, places)
    top, total, distinct = tree_top(keyed, depth, places)
    answers = batch_answers(keyed, depth, places, top)
    floor = total + smoothing * (distinct + 1)

    asked = answers.select(
        "batch", F.lit(0).alias("kind"), "space", "keys", "values", F.lit(None).cast(f"array<{id_type}>").alias("ids"),
        F.lit(None).cast("array<boolean>").alias("held"), F.lit(None).cast("array<bigint>").alias("sizes"),
        F.lit(None).cast("binary").alias("data"))
    texts = blocks.select(
        "batch", F.lit(1).alias("kind"), F.lit(0).alias("space"), F.lit(None).cast("binary").alias("keys"),
        F.lit(None).cast("binary").alias("values"), "ids", "held", "sizes", "data")
    rows = asked.unionAll(texts).repartition(buckets, "batch").sortWithinPartitions("batch", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(ANY_WORD)
        number, known = None, None

        def token_values(keys):
            counts = known[WORDS].of(keys)
            return [np.ones(len(keys)), (counts > 0).astype(float), np.log10((counts + smoothing) / floor)]

        for batch in batches:
            id_field = batch.schema.field("ids").type.value_type
            for row in batch.to_pylist():
                if row["batch"] != number:
                    number, known = row["batch"], (Answers(), Answers())
                if row["kind"] == 0:
                    known[row["space"]].add(row["keys"], row["values"], np.float64 if row["space"] else np.float32)
                    continue
                spelling = block_texts(row["sizes"], row["data"])
                many = len(spelling)
                score, = summed(many, gram_parts(spelling, depth), lambda keys: [known[GRAMS].of(keys)])
                n, n_known, base = summed(many, token_parts(spelling, hasher), token_values)
                size = np.array(row["sizes"], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], id_field), pa.array(row["held"], pa.bool_()), pa.array(n.astype(np.int64)),
                     pa.array(n_known.astype(np.int64)), pa.array(np.full(many, total, np.int64)), pa.array(base), pa.array(score), pa.array(size),
                     pa.array(-score * np.log2(10) / size)],
                    names=["_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score",
                           "n_bytes", "bits_per_byte"])

    return rows.mapInArrow(
        run, f"_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
             "base_score double, score double, n_bytes bigint, bits_per_byte double").withColumnRenamed("_id", id_col)
