"""Token sequences of fixed size: best-fit decreasing over a segment tree.

Best-fit decreasing looks at nothing but lengths, and there are at most
``capacity`` of them. So Spark counts the pieces of each length (a histogram
of at most 4096 rows), the segment tree over remaining capacities packs the
histogram, and Spark deals the pieces of each length to the places that the
packing gave to that length. Equal lengths are interchangeable, therefore the
outcome is that of best-fit decreasing over single pieces.
"""

from __future__ import annotations

import functools
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import in_batches
from tidepool.session import materialize

CAPACITY = 4096
END_ID = 1

# Pieces of one length that a window sorts together; longer runs are split.
RANK_BLOCK = 1 << 14

# Distinct words whose ids a task remembers.
CACHE_WORDS = 250_000


# ---- tokens -----------------------------------------------------------------

class WordTokenizer:
    """Ids of whole texts from the tokenizer file, remembered word by word.

    The file's tokenizer drops white space and never joins characters across
    it, so the ids of a text are those of its words in turn. Words of plain
    Latin letters go through the file's own split pattern and BPE model
    directly; every other word, and texts that hold a special token or a
    control character that counts as white space in Python only, go through
    the whole tokenizer.
    """

    ODD = re.compile("[\x1c-\x1f]|<\\|")
    WIDE = re.compile("[^\x00-į]")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.model = self.whole.model
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.split, self.letters = self._plain_form(path)

    def _plain_form(self, path: str):
        """The split pattern and byte alphabet, or None when the file is built otherwise."""
        import json

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        norms = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        pres = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        if norms != ["NFC", "Replace", "Lowercase"] or [p["type"] for p in pres] != ["Split", "ByteLevel"]:
            return None, None
        # ByteLevel writes printable Latin-1 characters as they are and the
        # other byte values as the code points from 256 on, in order.
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        odd = [b for b in range(256) if b not in plain]
        alphabet = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(odd)}
        return regex.compile(pres[0]["pattern"]["Regex"]), alphabet

    def _word(self, word: str) -> bytes:
        if self.split is None or self.WIDE.search(word):
            return _pack(self.whole.encode(word, add_special_tokens=False).ids)
        out = []
        for part in self.split.findall(word.lower()):
            ids = self.parts.get(part)
            if ids is None:
                if len(self.parts) >= CACHE_WORDS:
                    self.parts.clear()
                spelled = part.encode().decode("latin-1").translate(self.letters)
                ids = self.parts[part] = _pack([t.id for t in self.model.tokenize(spelled)])
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if self.split is None or self.ODD.search(text):
            return _pack(self.whole.encode(text, add_special_tokens=False).ids)
        known = self.words
        out = []
        add = out.append
        for word in unicodedata.normalize("NFC", text).split():
            ids = known.get(word)
            if ids is None:
                if len(known) >= CACHE_WORDS:
                    known.clear()
                ids = known[word] = self._word(word)
            add(ids)
        return b"".join(out)


def _pack(ids: list[int]) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


@functools.lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer for the life of a Python worker; tasks clear its memory of words."""
    return WordTokenizer(path)


def token_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                 text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID,
                 with_ids: bool = False) -> DataFrame:
    """Each document's token ids with ``end_id`` at the end, cut into pieces.

    Returns ``id_col, piece, start, length, ids_crc32`` and, if asked for,
    ``ids`` (array of int). Only documents longer than ``capacity`` are cut,
    into pieces of that many ids and a last one that may be shorter. A null
    or empty text has the one id ``end_id``.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    out_ids = ", ids array<int>" if with_ids else ""
    end = _pack([end_id])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(tokenizer_path)
        schema = None
        for batch in batches:
            if schema is None:
                fields = [("_id", batch.schema.field(0).type), ("piece", pa.int32()),
                          ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
                schema = pa.schema(fields + ([("ids", pa.list_(pa.int32()))] if with_ids else []))

            def rows(batch=batch):
                for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                     strict=True):
                    ids = tokenizer.encode(text or "") + end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        cut = ids[at:at + 4 * capacity]
                        row = (key, k, at // 4, len(cut) // 4, zlib.crc32(cut))
                        yield (*row, np.frombuffer(cut, "<u4").astype(np.int32)) if with_ids else row

            yield from in_batches(rows(), schema, weight=(lambda r: 4 * r[3]) if with_ids else None)
        tokenizer.words.clear()
        tokenizer.parts.clear()

    pieces = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(
        run, f"_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint{out_ids}")
    return pieces.withColumnRenamed("_id", id_col)


# ---- packing ----------------------------------------------------------------

class CapacityTree:
    """Segment tree over remaining capacities: how many groups of open bins have each.

    ``tightest(n)`` descends to the smallest capacity of at least ``n`` that
    has an open bin, in time logarithmic in the capacity.
    """

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, n: int) -> None:
        k = capacity + self.leaves
        while k:
            self.count[k] += n
            k >>= 1

    def tightest(self, least: int) -> int | None:
        k = least + self.leaves
        if self.count[k]:
            return least
        while k > 1:
            if not k & 1 and self.count[k + 1]:
                k += 1
                while k < self.leaves:
                    k = 2 * k if self.count[2 * k] else 2 * k + 1
                return k - self.leaves
            k >>= 1
        return None


def best_fit_plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Best-fit decreasing over a histogram of lengths.

    Rows (length, first rank, bin, offset, per bin): the pieces of that
    length from that rank on go, ``per bin`` at a time, into the bins from
    ``bin`` on, at ``offset`` of each. Bins that were filled alike are kept as
    one range, and a bin with room for several equal pieces takes them at
    once, as it would stay the tightest. A step ends a length or uses up a
    range, and only the end of a length splits one, so the rows are bounded
    by the capacity and not by the number of documents.
    """
    tree, open_bins = CapacityTree(capacity), {}
    plan, bins = [], 0

    def keep(room: int, first: int, n: int) -> None:
        if room and n:
            open_bins.setdefault(room, []).append((first, n))
            tree.add(room, 1)

    for length in sorted(counts, reverse=True):
        rank, total = 0, counts[length]
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} does not fit a sequence of {capacity}")
        while rank < total:
            room = tree.tightest(length)
            if room is None:
                room, first = capacity, bins
                n = -(-(total - rank) // (room // length))
                bins += n
            else:
                first, n = open_bins[room].pop()
                tree.add(room, -1)
            each = room // length
            full = min(n, (total - rank) // each)
            plan.append((length, rank, first, capacity - room, each))
            keep(room - each * length, first, full)
            rank += full * each
            if full < n:
                last = min(total - rank, each)
                if last:
                    if not full:
                        plan.pop()
                    plan.append((length, rank, first + full, capacity - room, each))
                    keep(room - last * length, first + full, 1)
                    rank += last
                    full += 1
                keep(room, first + full, n - full)
    return np.array(plan, dtype=np.int64).reshape(-1, 5)


def best_fit_pack(pieces: DataFrame, order: list[str], length_col: str = "length",
                  capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset``: a gapless place in a sequence of ``capacity``.

    ``order`` names columns that tell pieces of one length apart; pieces that
    are equal in all of them are interchangeable. The input must be a stored
    or checkpointed frame, as it is read twice. Defined cases: an empty input
    gives an empty result; a length outside 1..capacity raises.
    """
    counts = {int(r[0]): int(r[1]) for r in
              pieces.groupBy(length_col).agg(F.count("*")).collect()}  # at most `capacity` rows
    plan = best_fit_plan(counts, capacity)
    blocks = {n: -(-c // RANK_BLOCK) for n, c in counts.items() if c > RANK_BLOCK}

    # Rank of a piece among those of its length: frequent lengths are split
    # into blocks by hash, ranked apart, and shifted by the blocks before.
    if blocks:
        of = F.coalesce(F.create_map(*[F.lit(x) for kv in blocks.items() for x in kv])[F.col(length_col)],
                        F.lit(1))
        block = F.pmod(F.xxhash64(*order), of).cast("int")
    else:
        block = F.lit(0)
    blocked = pieces.withColumn("_block", block)
    ranked = blocked.withColumn("_rank", F.row_number().over(
        Window.partitionBy(length_col, "_block").orderBy(*order)).cast("long") - 1)
    if blocks:
        sizes = blocked.where(F.col(length_col).isin(list(blocks))).groupBy(length_col, "_block").count()
        shift = sizes.select(length_col, "_block", F.coalesce(
            F.sum("count").over(Window.partitionBy(length_col).orderBy("_block")
                                .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_shift"))
        ranked = (ranked.join(materialize(shift), [length_col, "_block"], "left")
                  .withColumn("_rank", F.col("_rank") + F.coalesce("_shift", F.lit(0))).drop("_shift"))
    ranked = ranked.select(*pieces.columns, "_rank")

    width = 1 << 44
    by_place = np.argsort(plan[:, 0] * width + plan[:, 1], kind="stable") if len(plan) else np.zeros(0, int)
    plan = plan[by_place]
    starts = plan[:, 0] * width + plan[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(batch.schema.get_field_index(length_col)).to_numpy()
            rank = batch.column(batch.num_columns - 1).to_numpy()
            row = plan[np.searchsorted(starts, length * width + rank, side="right") - 1]
            nth = rank - row[:, 1]
            cols = [*batch.columns[:-1], pa.array(row[:, 2] + nth // row[:, 4]),
                    pa.array(row[:, 3] + nth % row[:, 4] * length)]
            names = [*batch.schema.names[:-1], "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(place, f"{fields}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                   text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``token_pieces`` with the place that ``best_fit_pack`` gives each of them.

    Defined cases: null and empty texts are pieces of one id; repeated rows
    are packed once each; an empty table gives an empty result; columns other
    than the id and the text are ignored.
    """
    pieces = materialize(token_pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id))
    return best_fit_pack(pieces, [id_col, "piece", "ids_crc32"], capacity=capacity)


def sequences(docs: DataFrame, tokenizer_path: str, packed: DataFrame, id_col: str = "doc_id",
              text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The packed sequences themselves: ``sequence_id, ids`` with at most ``capacity`` ids each.

    ``packed`` comes from ``pack_documents``; ids are unique in ``docs``.
    """
    pieces = token_pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id, with_ids=True)
    return (pieces.join(packed.select(id_col, "piece", "sequence_id", "offset"), [id_col, "piece"])
            .groupBy("sequence_id")
            .agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))),
                                       lambda x: x["ids"])).alias("ids")))
