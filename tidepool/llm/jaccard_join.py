"""Size-aware n-gram Jaccard join, and the components of its links.

A document is the set of its word n-grams; documents with equal sets are one
class, represented once. Two classes link when their Jaccard similarity
reaches ``threshold`` hundredths. Elements are ordered from rare to frequent
(by a counting sketch of fixed size; any order gives the same links). The
first k shared elements of two linked sets of sizes n lie in the first
n - ceil(threshold n) + k of each, therefore

- light sets, of at most ``x`` elements, meet by the 2-subsets of that prefix
  (k = 2), which two unlinked sets hardly ever share;
- heavy sets meet each other, and the light sets large enough to match them,
  by the inverted lists of their prefixes (k = 1).

``x`` is where the rows that both ways cost, from the sizes of all sets and
the mean list length, are fewest. Elements that one class holds alone come
first in the order (a bitmap of fixed size tells) and are never sent: a set
with enough of them cannot link at all. Candidates are not all pairs of a
list: each member meets the list's most connected class first, linked classes
become components, and only members of different components meet again. A
list of near copies thus costs its length.

What meets again carries its bounds. Every linked pair meets in the list of
its first shared elements, and behind a place in its set a member can share no
more than what is left of it. So the place tells the largest set that a member
can link to there; the larger set of a pair looks for partners of the sizes
that it can link to, and only members that can link to a set of at least their
own size are there to be found. Near copies just under the threshold, with too
many elements of their own to link to each other, so do not meet at all.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import in_batches, utf8_values
from tidepool.llm.components import components
from tidepool.llm.repeats import (
    KEYED, KEYED_DDL, Bitmap, bits_for, folded, pack, place_rows, repeated, unpack)
from tidepool.llm.words import ANY_WORD, WordHasher, distinct, grouped, mixed, ngram_hashes
from tidepool.session import materialize

# Buckets of the frequency sketch (one byte each when it is sent to tasks).
SKETCH_BITS = 22
SKETCH_SLICES = 64
SKETCH, SIZES, SMALLEST, TOTAL = 0, 1, 2, 3

# Sets whose sizes take part in the choice of the boundary; beyond, subsets
# cost far more than lists.
MOST_LIGHT = 400
SMALLEST_HASHES = 1024
# Keys that a task holds before their places are sent: with what sorts them some 50 MB.
LOOSE = 1 << 21

# Parts of a component in the join that names its classes.
COMPONENT_PARTS = 16


def need(n: int, threshold: int) -> int:
    """Least overlap of a set of ``n`` with a set it links to."""
    return -(-threshold * n // 100)


def shingle_sets(texts: list[bytes], hasher: WordHasher, n: int) -> Iterator[np.ndarray]:
    """Sorted distinct n-gram hashes of each text; fewer words than ``n`` are one n-gram, none are no set."""
    words, bounds = hasher.group(texts)
    grams = ngram_hashes(words, n)
    for start, end in zip(bounds[:-1], bounds[1:], strict=True):
        if 0 < end - start < n:
            yield ngram_hashes(words[start:end], int(end - start)) ^ np.uint64(end - start)
        else:
            yield distinct(grams[start:max(start, end - n + 1)])


def class_key(elements: np.ndarray) -> int:
    """64-bit name of a set; equal sets share it."""
    value = xxhash.xxh3_64_intdigest(elements.tobytes())
    return value - (1 << 64) if value >> 63 else value


def copy_key(ck: int, key) -> int:
    """Hash of a class and one of its documents."""
    return xxhash.xxh64_intdigest(f"{ck}:{key}")


class Signer:
    """Signatures of sets, given the repeated elements, their frequencies and the boundary."""

    def __init__(self, repeated: Bitmap, ranks: np.ndarray, boundary: int, threshold: int):
        self.repeated, self.ranks = repeated, ranks
        self.boundary, self.threshold = boundary, threshold

    def of(self, elements: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Signatures (subsets have the top bit set), and how much a pair that has them first can share.

        Elements become 63-bit numbers whose order is from rare to frequent:
        those of one class alone first, the others by the sketch. Signatures
        with an element of the first kind meet nothing and are left out. A
        pair whose first shared element has place p here shares at most the
        n - p elements from there on; one whose first two are at places p < q
        at most n - q + 1.
        """
        n = len(elements)
        spare = n - need(n, self.threshold)
        shared = self.repeated.has(elements)
        alone = n - int(shared.sum())
        if alone > spare + 1:
            return elements[:0], np.zeros(0, np.int64)
        held = elements[shared]
        rank = self.ranks[(held >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64)
        order = np.sort(((rank + np.uint64(1)) << np.uint64(56)) | (held >> np.uint64(8)))
        listed = max(0, spare + 1 - alone)
        if n > self.boundary or n < 2:
            return order[:listed], n - alone - np.arange(len(order[:listed]))
        if 100 * n < self.threshold * (self.boundary + 1):
            listed = 0
        lists = order[:listed]
        first, second = _pairs(min(spare + 2, n) - alone)
        subsets = mixed(order[first] * np.uint64(0x9E3779B97F4A7C15) + order[second]) | np.uint64(1 << 63)
        return (np.concatenate([lists, subsets]),
                np.concatenate([n - alone - np.arange(len(lists)), n - alone - second + 1]))


@functools.lru_cache(maxsize=1024)
def _pairs(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(n, 1)


def sets_of(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[object, np.ndarray]]:
    """(id, set) of each row of (id, text) batches."""
    hasher = WordHasher(ANY_WORD)
    for batch in batches:
        rows = zip(batch.column(0).to_pylist(), utf8_values(batch.column(1)), strict=True)
        for group in grouped(rows, lambda row: row[1]):
            sets = shingle_sets([bytes(text) for _, text in group], hasher, n)
            yield from zip([key for key, _ in group], sets, strict=True)


# ---- scans ------------------------------------------------------------------

def documents_and_places(texts: DataFrame, n: int, bits: int) -> DataFrame:
    """``id, n, ck`` of every document, and ``key, data`` places of the elements of classes."""
    id_type = texts.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None

        def watched():
            nonlocal schema
            for batch in batches:
                schema = schema or pa.schema([*KEYED, ("id", batch.schema.field(0).type), ("n", pa.int64()),
                                              ("ck", pa.int64())])
                yield batch

        def places(parts):
            for k, data in place_rows(np.concatenate(parts), bits):
                yield k, data, None, None, None

        def rows():
            seen, loose, held = set(), [], 0
            for key, elements in sets_of(watched(), n):
                ck = class_key(elements) if len(elements) else None
                yield None, None, key, len(elements), ck
                if ck is not None and ck not in seen:
                    seen.add(ck)
                    loose.append(elements)
                    held += len(elements)
                    if held > LOOSE:
                        yield from places(loose)
                        loose, held = [], 0
            if loose:
                yield from places(loose)

        found = rows()
        first = next(found, None)
        if first is not None:
            yield from in_batches(itertools.chain([first], found), schema, weight=lambda r: len(r[1] or b""))

    return texts.mapInArrow(run, f"{KEYED_DDL}, id {id_type}, n bigint, ck bigint")


def set_statistics(texts: DataFrame, n: int, repeated_elements) -> dict[int, list[tuple[int, bytes]]]:
    """Sketch slices of the repeated elements, size histogram, smallest hashes and total, by kind."""
    width = (1 << SKETCH_BITS) // SKETCH_SLICES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)  # of one task
        sizes = np.zeros(MOST_LIGHT + 1, np.int64)
        least, small, held, total = np.zeros(0, np.uint64), [], 0, 0

        def lowest():
            return distinct(np.concatenate([least, *small]))[:SMALLEST_HASHES]

        for _, elements in sets_of(batches, n):
            if not len(elements):
                continue
            if len(elements) <= MOST_LIGHT:
                sizes[len(elements)] += 1
            shared = elements[repeated_elements.value.has(elements)]
            total += len(shared)
            np.add.at(counts, (shared >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), np.uint32(1))
            # Elements of a set are sorted: no more of them than are asked for can be among the least.
            shared = shared[:SMALLEST_HASHES]
            if len(least) == SMALLEST_HASHES:
                shared = shared[:np.searchsorted(shared, least[-1])]
            if len(shared):
                small.append(shared.copy())
                held += len(shared)
                if held > 64 * SMALLEST_HASHES:
                    least, small, held = lowest(), [], 0
        if sizes.any() or total:
            rows = ((SKETCH << 32 | k, pack(counts[k * width:(k + 1) * width].astype(np.int64)))
                    for k in range(SKETCH_SLICES))
            others = [(SIZES << 32, pack(sizes)), (SMALLEST << 32, pack(lowest())),
                      (TOTAL << 32, pack(np.array([total])))]
            yield from in_batches(itertools.chain(rows, others), KEYED)

    def add(state, data):
        kind, value = state
        if kind == SMALLEST:
            new = unpack(data, np.uint64)
            return kind, new if value is None else distinct(np.concatenate([value, new]))[:SMALLEST_HASHES]
        new = unpack(data, np.int64)
        return kind, new if value is None else value + new

    folds = folded(texts.mapInArrow(run, KEYED_DDL), lambda key: (key >> 32, None), add, lambda s: pack(s[1]))
    out: dict[int, list] = {SKETCH: [], SIZES: [], SMALLEST: [], TOTAL: []}
    for r in folds.collect():  # the sketch (8 bytes a bucket at most) and three short arrays
        out[r.key >> 32].append((r.key & 0xFFFFFFFF, r.data))
    return out


def frequency_ranks(slices: list[tuple[int, bytes]]) -> np.ndarray:
    """Rank of each bucket, 0 to 126: steps of a quarter octave of its count."""
    ranks = np.zeros(1 << SKETCH_BITS, np.uint8)
    width = len(ranks) // SKETCH_SLICES
    for k, data in slices:
        counts = unpack(data, np.int64)
        ranks[k * width:(k + 1) * width] = np.minimum(126, 4 * np.log2(np.maximum(counts, 1))).astype(np.uint8)
    return ranks


def choose_boundary(sizes: np.ndarray, list_length: float, threshold: int) -> int:
    """The light sets' largest size that makes the fewest rows: subsets, list entries and their scans."""
    n = np.arange(len(sizes))
    spare = n - -(-threshold * n // 100)
    subsets = sizes * (spare + 2) * (spare + 1) / 2
    lists = sizes * (spare + 1) * (1 + list_length)
    best, cost = 0, None
    for x in range(len(sizes)):
        meets = -(-threshold * (x + 1) // 100)
        now = subsets[1:x + 1].sum() + lists[min(meets, len(sizes)):].sum()
        if cost is None or now < cost:
            best, cost = x, now
    return best


def signatures(texts: DataFrame, n: int, repeated_elements, order, chosen) -> DataFrame:
    """``sig, ck, n, reach`` of the signatures that may repeat, of the documents that the bitmap of
    ``copy_key`` names; equal sets of a task once. ``order``: what a Signer takes but the bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(repeated_elements.value, *order.value)
        seen, kept, held = set(), [], 0

        def out():
            sig, ck, size, reach = zip(*kept, strict=True)
            counts = [len(x) for x in sig]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(sig).view(np.int64)), pa.array(np.repeat(np.array(ck, np.int64), counts)),
                 pa.array(np.repeat(np.array(size, np.int32), counts)),
                 pa.array(np.concatenate(reach).astype(np.int32))], names=["sig", "ck", "n", "reach"])

        for key, elements in sets_of(batches, n):
            if len(elements) < 2:
                continue
            ck = class_key(elements)
            if ck in seen or not chosen.value.has(np.array([copy_key(ck, key)], np.uint64))[0]:
                continue
            seen.add(ck)
            sigs, reach = signer.of(elements)
            if len(sigs):
                kept.append((sigs, ck, len(elements), reach))
                held += len(sigs)
                if held > 100_000:
                    yield out()
                    kept, held = [], 0
        if kept:
            yield out()

    return texts.mapInArrow(run, "sig bigint, ck bigint, n int, reach int")


def meeting(signed: DataFrame) -> DataFrame:
    """The rows of ``signed`` (it is stored) but most of those whose signature no other row has."""

    def keys(batch: pa.RecordBatch) -> np.ndarray:
        return mixed(batch.column(0).to_numpy().view(np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            loose, held = [], 0
            for batch in batches:
                loose.append(keys(batch))
                held += len(loose[-1])
                if held > LOOSE:
                    yield from place_rows(np.concatenate(loose), bits)
                    loose, held = [], 0
            if held:
                yield from place_rows(np.concatenate(loose), bits)

        yield from in_batches(rows(), KEYED, weight=lambda r: len(r[1]))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shared.value.has(keys(batch))))

    bits = bits_for(signed.count(), most=27)
    shared = signed.sparkSession.sparkContext.broadcast(repeated(signed.select("sig").mapInArrow(run, KEYED_DDL), bits))
    return signed.mapInArrow(chosen, signed.schema)


def wanted_sets(texts: DataFrame, n: int, wanted) -> DataFrame:
    """``ck, elements`` of the documents that the bitmap of ``copy_key`` names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("ck", pa.int64()), ("elements", pa.list_(pa.int64()))])

        def rows():
            for key, elements in sets_of(batches, n):
                if len(elements):
                    ck = class_key(elements)
                    if wanted.value.has(np.array([copy_key(ck, key)], np.uint64))[0]:
                        yield ck, elements.view(np.int64)

        yield from in_batches(rows(), schema, weight=lambda r: r[1].nbytes)

    return texts.mapInArrow(run, "ck bigint, elements array<bigint>")


def copies_bitmap(copies: DataFrame) -> Bitmap:
    """Bitmap of the ``copy_key`` of rows ``ck, id`` (they are stored).

    All documents are looked up, and one that it names by mistake sends its
    whole set: with 32 places to a key, about one in a thousand does.
    """
    bits = bits_for(8 * copies.count(), most=27)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.array([copy_key(ck, key) for ck, key in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)], np.uint64)
            yield from in_batches(place_rows(np.repeat(keys, 2), bits), KEYED)

    return repeated(copies.select("ck", "id").mapInArrow(run, KEYED_DDL), bits)


# ---- the join ---------------------------------------------------------------

def _sizes_fit(a: str, b: str, threshold: int):
    return (100 * F.least(a, b) >= threshold * F.greatest(a, b))


def _reach_fits(a: str, b: str, reach_a: str, reach_b: str, threshold: int):
    """Whether sets of sizes ``a`` and ``b`` can link if they share no more than either ``reach``."""
    return F.least(reach_a, reach_b) * F.lit(100 + threshold) >= threshold * (F.col(a) + F.col(b))


def size_band(n):
    """Bands of sizes, 16 to an octave."""
    return F.floor(16 * F.log2(F.greatest(n, F.lit(1)))).cast("int")


def verified(texts: DataFrame, pairs: DataFrame, classes: DataFrame, n: int, threshold: int) -> DataFrame:
    """The pairs ``a, b`` of class keys whose whole sets reach the threshold."""
    spark = texts.sparkSession
    ends = pairs.select(F.col("a").alias("ck")).unionAll(pairs.select(F.col("b").alias("ck"))).distinct()
    copies = materialize(ends.join(classes, "ck").select("ck", "id"))
    sets = wanted_sets(texts, n, spark.sparkContext.broadcast(copies_bitmap(copies)))
    left = sets.select(F.col("ck").alias("a"), F.col("elements").alias("ea"))
    right = sets.select(F.col("ck").alias("b"), F.col("elements").alias("eb"))
    both = F.size(F.array_intersect("ea", "eb"))
    return materialize(
        pairs.join(right, "b").join(left, "a")
        .where(100 * both >= threshold * (F.size("ea") + F.size("eb") - both)).select("a", "b").distinct())


def jaccard_links(texts: DataFrame, n: int, threshold: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents ``id, n, ck``, their classes ``ck, id`` (least id) and links ``a, b`` that connect
    all classes that are connected by pairs at the threshold."""
    spark = texts.sparkSession
    # About a word in six bytes, and as many n-grams as words.
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = bits_for(size // 6, most=27)
    rows = materialize(documents_and_places(texts, n, bits))
    docs = rows.where("data is null").select("id", "n", "ck")
    classes = materialize(docs.where("ck is not null").groupBy("ck").agg(F.min("id").alias("id")))
    shared = spark.sparkContext.broadcast(repeated(rows.where("data is not null"), bits))

    found = set_statistics(texts, n, shared)
    total = sum(int(unpack(d, np.int64)[0]) for _, d in found[TOTAL])
    boundary, ranks = 0, np.zeros(1 << SKETCH_BITS, np.uint8)
    if total:
        ranks = frequency_ranks(found[SKETCH])
        least = unpack(found[SMALLEST][0][1], np.uint64)
        kinds = len(least) if len(least) < SMALLEST_HASHES else (len(least) - 1) * 2.0**64 / float(least[-1])
        boundary = choose_boundary(unpack(found[SIZES][0][1], np.int64), total / kinds, threshold)
    order = spark.sparkContext.broadcast((ranks, boundary, threshold))

    # Copies of one set in other tasks make its elements look shared, so one document signs for all.
    chosen = spark.sparkContext.broadcast(copies_bitmap(classes))
    signed = meeting(materialize(signatures(texts, n, shared, order, chosen)))
    lists = materialize(signed.groupBy("sig").agg(F.min("ck").alias("lo"), F.max("ck").alias("hi"),
                                                  F.count("*").alias("entries"))
                        .where("lo < hi").select("sig", "entries"))
    listed = materialize(signed.join(lists, "sig").dropDuplicates(["sig", "ck"]))
    # The centre of a list is the member that has most neighbours over all its lists:
    # of edited copies of one text, the one that the others share most with.
    weight = listed.groupBy("ck").agg(F.sum("entries").alias("weight"))
    weighed = materialize(listed.join(materialize(weight), "ck").select("sig", "ck", "n", "reach", "weight"))
    centres = weighed.groupBy("sig").agg(F.max(F.struct("weight", "ck", "n", "reach")).alias("top"))
    members = materialize(weighed.join(materialize(centres), "sig").select(
        "sig", "ck", "n", "reach", F.col("top.ck").alias("first"), F.col("top.n").alias("first_n"),
        F.col("top.reach").alias("first_reach"), F.col("top.weight").alias("first_weight")))

    # Each class against the centre that weighs most, of the lists whose places leave room for a link.
    stars = (members.where("ck <> first").where(_sizes_fit("n", "first_n", threshold))
             .where(_reach_fits("n", "first_n", "reach", "first_reach", threshold))
             .groupBy("ck").agg(F.max(F.struct("first_weight", "first")).alias("best"))
             .select(F.col("best.first").alias("a"), F.col("ck").alias("b")))
    links = verified(texts, materialize(stars), classes, n, threshold)

    # Members of one list that are still in different components.
    roots = components(links)
    rooted = members.join(roots, members.ck == roots.node, "left").select(
        "sig", "ck", "n", F.coalesce("root", "ck").alias("root"),
        # The largest set that it can link to in this list.
        (F.floor(F.col("reach") * F.lit(100 + threshold) / threshold) - F.col("n")).cast("int").alias("widest"))
    least = F.ceil(F.col("n") * F.lit(threshold) / 100).cast("int")
    rooted = materialize(rooted.where(F.col("widest") >= least))
    split = materialize(rooted.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
                        .where("lo < hi").select("sig"))
    rooted = materialize(rooted.join(split, "sig"))
    # The larger set looks for sets of the sizes that it can link to, by bands of sizes.
    larger = rooted.select("sig", "n", "root", "widest", F.col("ck").alias("a"), F.explode(F.sequence(
        size_band(least), size_band(F.least("n", "widest")))).alias("band"))
    smaller = rooted.where("widest >= n").select(
        "sig", size_band(F.col("n")).alias("band"), F.col("ck").alias("b"), F.col("root").alias("b_root"),
        F.col("n").alias("b_n"), F.col("widest").alias("b_widest"))
    fits = ((F.col("root") != F.col("b_root")) & (F.col("b_n") <= F.least("n", "widest")) & (F.col("n") <= F.col("b_widest"))
            & _sizes_fit("n", "b_n", threshold))
    pairs = (larger.join(smaller, ["sig", "band"]).where(fits)
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    more = verified(texts, materialize(pairs), classes, n, threshold)
    return docs, classes, links.unionAll(more)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4,
                       threshold: int = 85) -> DataFrame:
    """Per row ``id_col, n_shingles, component_id`` of the links at ``threshold`` hundredths.

    Words are runs of anything but ASCII white space with A-Z lower-cased, a
    set the distinct runs of ``n`` words (of all words where there are
    fewer). ``component_id`` is the least id that links reach, itself
    included. Defined cases: null, empty and blank texts have no set and link
    with nothing; equal sets are always linked; a null id takes part but is
    never a least id (null where a component has no other); repeated rows get
    a row each; an empty table gives an empty result; other columns are
    ignored. Sets and n-grams are compared by 64-bit hashes.
    """
    if not 50 < threshold <= 100:
        raise ValueError("the threshold is in hundredths, over 50 and at most 100")
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows, classes, links = jaccard_links(texts, n, threshold)
    roots = components(links)
    # Only linked classes need the least id of their component; one of many classes meets it in parts.
    linked = materialize(roots.join(classes, roots.node == classes.ck).select("ck", "id", "root"))
    least = linked.groupBy("root").agg(F.min("id").alias("component_id"))
    part = F.pmod(F.xxhash64("ck"), F.lit(COMPONENT_PARTS)).alias("part")
    least = least.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(COMPONENT_PARTS - 1).cast("long"))))
    named = linked.select("ck", "root", part).join(least, ["root", "part"]).select("ck", "component_id")
    named = materialize(classes.join(named, "ck", "left").select(
        F.col("ck").alias("_ck"), F.when(F.col("component_id").isNotNull(), F.col("component_id")).otherwise(F.col("id")).alias("component_id")))
    # Documents without a set get keys of their own, so that they do not meet in one task.
    key = F.coalesce("ck", F.xxhash64("id"))
    return (rows.withColumn("_ck", key).join(named, "_ck", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.when(F.col("ck").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id")))
