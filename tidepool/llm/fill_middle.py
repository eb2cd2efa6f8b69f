"""Fill-in-the-middle rearrangement of texts by displacement scatter.

The bytes of many texts lie in one array. Two cuts part each text in prefix,
middle and suffix; each part moves as a whole, so a difference array that is
zero but at the beginnings of parts holds by how much the shift of a byte
differs from that of the byte before. Its running sum gives every byte its
shift, one scatter puts all bytes in their places in the outputs, and the
markers go between them. The way back works out the same shifts from the
markers found in an output, and gathers the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import utf8_values

# The markers of the three parts.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"

# Texts that are rearranged together, up to this many bytes (or one longer text).
CHUNK_BYTES = 4 << 20

# Bytes whose shifts are worked out at once.
BLOCK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def unit_ends(text: np.ndarray) -> np.ndarray:
    """Ends of the tokens of one text: white space goes with the word behind it, or is the last token."""
    space = _SPACE[text]
    ends = np.flatnonzero(~space & np.append(space[1:], True)) + 1
    return np.append(ends, len(text)) if len(text) and space[-1] else ends


def cut_places(text: np.ndarray, h1: int, h2: int) -> tuple[int, int, int]:
    """Number of tokens, end of the prefix, end of the middle."""
    ends = np.concatenate([[0], unit_ends(text)])
    n = len(ends) - 1
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    return n, int(ends[a]), int(ends[b])


def shifts(moves: list[tuple[int, int]], size: int) -> Iterator[tuple[int, np.ndarray]]:
    """The shift of every byte, in blocks (first byte, shifts).

    ``moves`` are (first byte of a part that is not empty, its shift), in order.
    """
    if not size:
        return
    place = np.array([p for p, _ in moves], np.int64)
    shift = np.array([s for _, s in moves], np.int64)
    step = np.diff(shift, prepend=0)
    carry = 0
    for at in range(0, size, BLOCK_BYTES):
        difference = np.zeros(min(BLOCK_BYTES, size - at), np.int64)
        own = slice(*np.searchsorted(place, [at, at + len(difference)]))
        np.add.at(difference, place[own] - at, step[own])
        out = np.cumsum(difference)
        out += carry
        carry = int(out[-1])
        yield at, out


def parts_of(form: str, start: int, p: int, q: int, end: int) -> list[tuple[bytes, int, int]]:
    """The pieces of an output in order: marker and the bytes behind it."""
    prefix, middle, suffix = (PREFIX, start, p), (MIDDLE, p, q), (SUFFIX, q, end)
    if form == "psm":
        return [prefix, suffix, middle]
    if form == "spm":
        return [suffix, prefix, middle]
    return [(b"", start, end)]


def scatter(data: np.ndarray, cuts: list[tuple[str, int, int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Outputs one after another and their ends; ``cuts`` are (form, start, p, q, end) of each text."""
    moves, marks, ends, at = [], [], [], 0
    for form, *places in cuts:
        own = []
        for marker, a, b in parts_of(form, *places):
            if marker:
                marks.append((at, marker))
                at += len(marker)
            if b > a:
                own.append((a, at - a))
                at += b - a
        moves += sorted(own)
        ends.append(at)
    out = np.empty(at, np.uint8)
    for first, shift in shifts(moves, len(data)):
        shift += np.arange(first, first + len(shift))
        out[shift] = data[first:first + len(shift)]
    for place, marker in marks:
        out[place:place + len(marker)] = np.frombuffer(marker, np.uint8)
    return out, np.array(ends, np.int64)


def output_cuts(output: bytes, form: str) -> list[tuple[int, int]]:
    """Where the prefix, the middle and the suffix lie in an output, from its markers alone."""
    if form == "plain":
        return [(0, len(output)), (len(output), len(output)), (len(output), len(output))]
    size = len(PREFIX)
    if form == "psm":
        s = output.index(SUFFIX)
        m = output.index(MIDDLE, s + size)
        return [(size, s), (m + size, len(output)), (s + size, m)]
    if form == "spm":
        p = output.index(PREFIX)
        m = output.index(MIDDLE, p + size)
        return [(p + size, m), (m + size, len(output)), (size, p)]
    raise ValueError(f"not a form: {form!r}")


def gather(outputs: list[bytes], forms: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The texts that were rearranged, one after another, and their ends."""
    data = np.frombuffer(b"".join(outputs), np.uint8)
    moves, ends, at, base = [], [], 0, 0
    for output, form in zip(outputs, forms, strict=True):
        for a, b in output_cuts(output, form):
            if b > a:
                moves.append((at, base + a - at))
                at += b - a
        ends.append(at)
        base += len(output)
    out = np.empty(at, np.uint8)
    for first, shift in shifts(moves, at):
        shift += np.arange(first, first + len(shift))
        out[first:first + len(shift)] = data[shift]
    return out, np.array(ends, np.int64)


def _runs(values: Iterator[tuple], text_of) -> Iterator[list[tuple]]:
    """Runs of rows with at most about CHUNK_BYTES of text; a longer text is a run of its own."""
    kept, size = [], 0
    for row in values:
        n = len(text_of(row))
        if kept and size + n > CHUNK_BYTES:
            yield kept
            kept, size = [], 0
        kept.append(row)
        size += n
    if kept:
        yield kept


def _texts(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The parts of the array as strings, without copies."""
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(ends), pa.py_buffer(offsets), pa.py_buffer(data)).cast(pa.string())


def hash_group(id_col: Column, seed: int, i: int) -> Column:
    """The i-th group of eight hex digits of sha256(``seed:id``), as an unsigned number."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, rate: int = 50,
                   spm_rate: int = 80, seed: int = 42) -> DataFrame:
    """Per row ``id_col, n, form, prefix_chars, middle_chars, output``.

    A text is cut into ``n`` tokens (white space and the word behind it; the
    white space at the end is one too). Four numbers h1 to h4 of its id's
    hash decide: the prefix ends after the smaller of h1 % (n+1) and
    h2 % (n+1) tokens, the middle after the larger; h3 % 100 >= rate leaves
    the text plain, h4 % 100 < spm_rate puts the suffix first (``spm``), else
    the prefix (``psm``). ``rebuild`` gives the texts back.

    Defined cases: a null or empty text is plain, and so is one that holds a
    marker (its parts could not be told apart); plain rows have null
    ``prefix_chars`` and ``middle_chars``; a null id hashes as empty text;
    equal rows give equal rows; a very long text is handled alone, its shifts
    in blocks of a megabyte; an empty table gives an empty result; other
    columns are ignored.
    """
    key = F.col(id_col)
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(key.alias("id"), *[hash_group(key, seed, i).alias(f"h{i + 1}") for i in range(4)], body.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = zip(*[c.to_pylist() for c in batch.columns[1:5]], strict=True)
            at = 0
            for group in _runs(zip(heads, utf8_values(batch.column(5)), strict=True), lambda r: r[1]):
                start, cuts, about = 0, [], []
                whole = b"".join(text for _, text in group)
                data = np.frombuffer(whole, np.uint8)
                lead = data & 0xC0 != 0x80
                for (h1, h2, h3, h4), text in group:
                    end = start + len(text)
                    n, p, q = cut_places(data[start:end], h1, h2)
                    p, q = p + start, q + start
                    marked = any(whole.find(m, start, end) >= 0 for m in (PREFIX, SUFFIX, MIDDLE))
                    form = "plain" if not len(text) or marked or h3 % 100 >= rate else "spm" if h4 % 100 < spm_rate else "psm"
                    cuts.append((form, start, p, q, end))
                    chars = (None, None) if form == "plain" else (np.count_nonzero(lead[start:p]), np.count_nonzero(lead[p:q]))
                    about.append((n, form, *chars))
                    start = end
                out, ends = scatter(data, cuts)
                columns = list(zip(*about, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(group)), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()),
                     pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64()), _texts(out, ends)],
                    names=["id", "n", "form", "prefix_chars", "middle_chars", "output"])
                at += len(group)

    kind = docs.schema[id_col].dataType.simpleString()
    made = rows.mapInArrow(run, f"id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")
    return made.withColumnRenamed("id", id_col)


def rebuild(made: DataFrame, form_col: str = "form", output_col: str = "output", name: str = "restored") -> DataFrame:
    """All columns and ``name``: the text that ``fill_in_middle`` rearranged, from output and form alone.

    Defined cases: a null output is empty and must be plain; an output that
    lacks a marker of its form raises; a column ``name`` is replaced.
    """
    columns = [c for c in made.columns if c != name]
    form_at, output_at = columns.index(form_col), columns.index(output_col)
    kept = made.select(*columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for group in _runs(zip(batch.column(form_at).to_pylist(), utf8_values(batch.column(output_at)), strict=True),
                               lambda r: r[1]):
                out, ends = gather([bytes(text) for _, text in group], [form for form, _ in group])
                part = batch.slice(at, len(group))
                yield pa.RecordBatch.from_arrays([*part.columns, _texts(out, ends)], names=[*columns, name])
                at += len(group)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(run, f"{schema}, `{name}` string")
