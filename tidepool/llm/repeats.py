"""Keys that occur at least twice in a whole table, as a bitmap of fixed size.

Tasks send the distinct places of their 64-bit keys (the top ``bits`` bits of
two hashes), sorted and compressed, to a fixed number of slices; a slice marks
the places that two tasks, or one task twice, have sent. The bitmap has twice
2^bits bits, 2^MAX_BITS at most (64 MB in all), whatever the input: it may say
yes for a key that occurs once, never no for one that repeats.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from tidepool.llm.common import in_batches, partitions
from tidepool.llm.words import mixed

SLICE_BITS = 6
# Keys whose places are computed together.
PLACE_KEYS = 1 << 16
MIN_BITS, MAX_BITS = 16, 28

KEYED = pa.schema([("key", pa.int64()), ("data", pa.binary())])
KEYED_DDL = "key bigint, data binary"


def bits_for(expected: int, most: int = MAX_BITS) -> int:
    """Bits for about four places to a key, within the bounds."""
    return min(most, max(MIN_BITS, int(max(1, 4 * expected)).bit_length()))


def pack(values: np.ndarray) -> bytes:
    """Compressed values, byte planes apart."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted unsigned values as compressed differences."""
    return pack(np.diff(values, prepend=np.zeros(1, values.dtype)))


def unpack_sorted(data: bytes, dtype) -> np.ndarray:
    return np.cumsum(unpack(data, dtype), dtype=dtype)


def place_rows(keys: np.ndarray, bits: int) -> Iterator[tuple[int, bytes]]:
    """(slice, places) rows of a task's keys; a key given twice counts twice."""
    width = bits - SLICE_BITS
    inner = np.uint32((1 << width) - 1)
    places = np.empty(len(keys), np.uint32)
    for which in (0, 1):
        for at in range(0, len(keys), PLACE_KEYS):
            part = keys[at:at + PLACE_KEYS]
            places[at:at + PLACE_KEYS] = (mixed(part) if which else part) >> np.uint64(64 - bits)
        places.sort()
        cuts = np.searchsorted(places, np.arange(1, 1 << SLICE_BITS, dtype=np.int64) << width)
        for k, own in enumerate(np.split(places, cuts)):  # equal places are in one slice
            new = np.ones(len(own), bool)
            new[1:] = own[1:] != own[:-1]
            own, again = own[new], np.append(~new[1:], False)[new]
            for often in (False, True):
                part = own[again == often] & inner
                if len(part):
                    yield which << SLICE_BITS | k, bytes([often]) + pack_sorted(part)


def folded(rows: DataFrame, start: Callable, add: Callable, done: Callable) -> DataFrame:
    """One ``key, data`` row per key: the fold of its rows' data, a row at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            now, state = None, None
            for batch in batches:
                for key, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    if key != now:
                        if now is not None:
                            yield now, done(state)
                        now, state = key, start(key)
                    state = add(state, data)
            if now is not None:
                yield now, done(state)

        yield from in_batches(out(), KEYED, weight=lambda r: len(r[1]))

    n = partitions(rows.sparkSession)
    return rows.select("key", "data").repartition(n, "key").sortWithinPartitions("key").mapInArrow(run, KEYED_DDL)


class Bitmap:
    def __init__(self, bits: int):
        self.bits = bits
        self.data = np.zeros(1 << (bits - 2), np.uint8)  # one half for each hash

    def has(self, keys: np.ndarray) -> np.ndarray:
        half = len(self.data) // 2
        out = self._bit(keys, self.data[:half])
        some = np.flatnonzero(out)
        out[some] = self._bit(mixed(keys[some]), self.data[half:])
        return out

    def _bit(self, keys: np.ndarray, data: np.ndarray) -> np.ndarray:
        place = keys >> np.uint64(64 - self.bits)
        byte = data[(place >> np.uint64(3)).astype(np.int64)]
        return (byte >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


def repeated(rows: DataFrame, bits: int) -> Bitmap:
    """The bitmap of the places that ``place_rows`` rows name twice; twice 2^bits bits come to the driver."""
    width = bits - SLICE_BITS

    def add(seen: np.ndarray, data: bytes) -> np.ndarray:
        at = unpack_sorted(data[1:], np.uint32)
        seen[at] = 2 if data[0] else np.minimum(seen[at] + 1, 2)
        return seen

    slices = folded(rows, lambda _: np.zeros(1 << width, np.uint8), add,
                    lambda seen: np.packbits(seen > 1, bitorder="little").tobytes())
    bitmap = Bitmap(bits)
    size = 1 << (width - 3)
    for r in slices.collect():
        bitmap.data[r.key * size:(r.key + 1) * size] = np.frombuffer(r.data, np.uint8)
    return bitmap
