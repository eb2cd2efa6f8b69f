"""Seeded shuffles, sharding, batching, Zipf lengths and word windows.

Every random draw is ``md5(seed:id)`` turned into a uniform, so results do
not depend on partitioning, retries or the engine.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import WORD_SPACE, col
from ..session import materialize
from .ordered import with_ordinal
from .scan import Recurrence, scan


def seeded_order_key(seed: int | str, id_col: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def shuffle_positions(df: DataFrame, id_col: str, seed: int | str = 0,
                      name: str = "perm_pos") -> DataFrame:
    """Seeded permutation: dense position of each row in ``md5(seed:id)`` order."""
    return with_ordinal(df.withColumn("_tp_key", seeded_order_key(seed, id_col)),
                        ["_tp_key", id_col], name).drop("_tp_key")


def feistel_sides(n: int) -> tuple[int, int]:
    """a * b >= n > (a - 1) * b or so: the grid on which ``feistel_positions`` shuffles n positions."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


# A prime below 2^31, so that products of two residues fit in a long.
FEISTEL_PRIME = 2147483647
FEISTEL_ROUNDS = 6


def feistel_keys(seed: int | str) -> list[tuple[int, int]]:
    """Multiplier and summand of each round, from md5(``seed:round``)."""
    out = []
    for r in range(FEISTEL_ROUNDS):
        digest = hashlib.md5(f"{seed}:{r}".encode()).hexdigest()
        out.append((int(digest[:8], 16) % (FEISTEL_PRIME - 1) + 1, int(digest[8:16], 16) % FEISTEL_PRIME))
    return out


def _feistel(x: str, n: int, seed: int | str) -> str:
    """SQL text of one application of the permutation of 0 ... a*b - 1 to the column or variable ``x``."""
    a, b = feistel_sides(n)
    left, right = f"({x} div {b}L)", f"({x} % {b}L)"
    # Each round's value is bound once, as the argument of a lambda over a list of one.
    body = "named_struct('l', {l}, 'r', {r})"
    state = body.format(l=left, r=right)
    for k, (mul, add) in enumerate(feistel_keys(seed)):
        s = f"s{k}"
        own, other, side = ("l", "r", a) if k % 2 == 0 else ("r", "l", b)
        mixed = f"({s}.{other} % {FEISTEL_PRIME}L * {mul}L + {add}L) % {FEISTEL_PRIME}L"
        new = f"({s}.{own} + (({mixed}) div 64L + ({mixed}) * 31L) % {side}L) % {side}L"
        fields = {own: new, other: f"{s}.{other}"}
        state = f"transform(array({state}), {s} -> {body.format(**fields)})[0]"
    return f"transform(array({state}), s -> s.l * {b}L + s.r)[0]"


def feistel_positions(df: DataFrame, index: str, n: int, seed: int | str = 0, name: str = "perm_pos") -> DataFrame:
    """Seeded permutation of the dense positions 0 ... n-1 in column ``index``, row by row.

    A keyed network of six rounds permutes the cells of a grid of at least n
    places; a place beyond n-1 goes through it again until it is inside
    (cycle walking), so the result is a permutation of 0 ... n-1. The grid
    has less than one row of places too many, so about one position in
    sqrt(n) goes a second time. No sort and no exchange.
    """
    step = _feistel("x", n, seed)
    once = _feistel(f"`{index}`", n, seed)
    again = f"aggregate(sequence(1, 64), {once}, (x, _) -> CASE WHEN x >= {n}L THEN {step} ELSE x END)"
    out = df.withColumn("_tp_f", F.expr(once))
    inside = F.when(F.col("_tp_f") < n, F.col("_tp_f")).otherwise(F.expr(again))
    out = out.withColumn("_tp_f", inside)
    checked = F.when(F.col("_tp_f") < n, F.col("_tp_f")).otherwise(F.raise_error(F.lit("a position left the grid")).cast("long"))
    return out.withColumn(name, checked).drop("_tp_f")


def deal_shards(pos: DataFrame, position: str, n: int, ranks: int) -> DataFrame:
    """Rank r takes positions r, r+ranks, ... of 0 ... n-1, padded to a multiple of ``ranks`` by starting over.

    Adds ``rank`` and ``pos_in_shard`` and drops the position.
    """
    total = -(-n // ranks) * ranks
    # A row at p comes again at p + n, p + 2n, ... below the padded length.
    again = F.sequence(F.col(position), F.lit(max(total - 1, 0)).cast("long"), F.lit(max(n, 1)).cast("long"))
    padded = pos.withColumn(position, F.explode(again))
    return (padded.withColumn("rank", F.pmod(F.col(position), F.lit(ranks)))
            .withColumn("pos_in_shard", F.expr(f"{position} div {ranks}"))
            .drop(position))


def assign_shards(df: DataFrame, id_col: str, ranks: int, seed: int | str = 0,
                  shuffle: bool = True) -> DataFrame:
    """Distributed-sampler sharding: rank r takes positions r, r+n, r+2n, …

    The list is first padded to a multiple of ``ranks`` by starting over, as
    often as needed, so every rank gets the same count. Adds ``rank`` and
    ``pos_in_shard``.
    """
    pos = (shuffle_positions(df, id_col, seed, "_p") if shuffle
           else with_ordinal(df, [id_col], "_p"))
    return deal_shards(pos, "_p", pos.count(), ranks)


def batch_of(pos_in_shard: str | Column, batch_size: int) -> Column:
    """Batch index of a row within its shard; the last batch may be short."""
    return F.floor(col(pos_in_shard) / F.lit(batch_size)).cast("long")


def zipf_cdf(alpha: float = 1.3, low: int = 20, high: int = 200) -> list[float]:
    """Cumulative probabilities of k^-alpha over low < k < high (open range).

    Same law as drawing Zipf(alpha) and rejecting until low < k < high.
    """
    ks = range(low + 1, high)
    w = [k ** -alpha for k in ks]
    total = sum(w)
    out, acc = [], 0.0
    for x in w:
        acc += x
        out.append(acc / total)
    out[-1] = 1.0
    return out


def zipf_length(u: str, alpha: float = 1.3, low: int = 20, high: int = 200) -> Column:
    """Inverse CDF of the truncated Zipf law at the uniform in column ``u``.

    low+1 + (index of the first step whose cdf exceeds u), found by a
    binary search written as nested CASE expressions: about log2(steps)
    comparisons, all inside generated code (a higher-order ``filter`` over
    the step table would be interpreted per element). The search is built
    as one SQL expression, so building it is a single call.
    """
    cdf = zipf_cdf(alpha, low, high)
    ref = f"`{u}`"

    def search(lo: int, hi: int) -> str:
        if lo == hi:
            return str(low + 1 + lo)
        mid = (lo + hi) // 2
        return f"CASE WHEN {ref} < {cdf[mid]!r}D THEN {search(lo, mid)} ELSE {search(mid + 1, hi)} END"

    return F.expr(f"CAST({search(0, len(cdf) - 1)} AS INT)")


def words(text: str | Column) -> Column:
    """Split a whole text into words on runs of whitespace (empty text → no words)."""
    blanks = F.translate(col(text), WORD_SPACE, " " * len(WORD_SPACE))
    return F.array_remove(F.split(blanks, " "), "")


def one_of(c: Column) -> Column:
    """A generator of one row: the value is worked out once, whatever reads it later."""
    return F.explode(F.array(c))


def word_window(word_arr: str | Column, length: str | Column, u: Column) -> tuple[Column, Column]:
    """Window of ``length`` consecutive words; start uniform on 0 … len-length inclusive.

    Returns (start, text). Valid only when length < number of words.
    """
    w, n = col(word_arr), col(length)
    start = F.floor(u * (F.size(w) - n + 1)).cast("int")
    return start, F.array_join(F.slice(w, start + 1, n), " ")


def sample_rows(df: DataFrame, id_col: str, n: int, seed: int | str = 0) -> DataFrame:
    """n rows without replacement: the first n in seeded ``md5(seed:id)`` order.

    A cut of the range of the hash that about n rows, and a margin, lie below
    is widened until n rows do; only those are sorted, and by ranges, so no
    task sees more than its share of them. A sample of at least as many rows
    as there are is the whole table.
    """
    keyed = df.withColumn("_tp_key", seeded_order_key(seed, id_col))
    total = df.count()
    share = min(1.0, (n + 4 * n ** 0.5 + 16) / max(total, 1))
    while True:
        # Hashes are hexadecimal text of one length: they compare as numbers do.
        cut = f"{min(int(share * 16 ** 13), 16 ** 13 - 1):013x}"
        below = keyed if share >= 1 else keyed.where(F.col("_tp_key") < cut)
        found = with_ordinal(below, ["_tp_key", id_col], "_tp_pos")
        if share >= 1 or found.count() >= n:
            return found.where(F.col("_tp_pos") < n).drop("_tp_key", "_tp_pos")
        share = min(1.0, 2 * share)


def chunk_windows(chunks: DataFrame, requests: DataFrame, document: Sequence[str], request: str, length: str, u: str,
                  block_words: int = 1 << 12) -> DataFrame:
    """Random word windows of chunked documents: ``document, request, length, start, window``.

    ``chunks`` is a stored table of ``scan_document_chunks`` (it is read
    twice: word counts first, then the texts that windows touch). ``requests``
    has a unique ``request`` id, the ``document`` columns, the number of words
    and a uniform number in [0, 1); the start is uniform on 0 ... words -
    length. A request that is not shorter than its document gives no row.

    The words before each chunk are a running sum over the chunks; windows
    and chunks meet on blocks of ``block_words`` word places, so only chunks
    that hold a part of a window are split into words.
    """
    place = [*document, "part", "split", "chunk"]
    index = with_ordinal(chunks.select(*place, "n_words"), place, "_pos")
    index = scan(index, document, "_pos", {"_first": Recurrence(add=F.col("n_words"), before=True)})
    index = materialize(index.where("n_words > 0").select(*place, "_first", (F.col("_first") + F.col("n_words")).alias("_end")))
    totals = index.groupBy(*document).agg(F.max("_end").alias("_words"))
    drawn = requests.join(totals, list(document)).where(F.col(length) < F.col("_words"))
    drawn = drawn.select(*document, request, length, F.floor(F.col(u) * (F.col("_words") - F.col(length) + 1)).cast("long").alias("start"))

    def blocks(first: str, end: str) -> Column:
        return F.sequence(F.expr(f"{first} div {block_words}L"), F.expr(f"({end} - 1) div {block_words}L"))

    asked = drawn.withColumn("_to", F.col("start") + F.col(length))
    asked = asked.withColumn("_block", F.explode(blocks("start", "_to")))
    held = index.withColumn("_block", F.explode(blocks("_first", "_end")))
    # A window and a chunk that meet in two blocks count in the first of them.
    met = asked.join(held, [*document, "_block"]).where(
        (F.col("_first") < F.col("_to")) & (F.col("start") < F.col("_end"))
        & (F.col("_block") == F.expr(f"greatest(start, _first) div {block_words}L")))
    pieces = met.join(chunks.select(*place, "text"), place).select(
        *document, request, length, "start", "_first", "_to", one_of(words("text")).alias("_w"))
    begin = F.greatest(F.col("start") - F.col("_first"), F.lit(0))
    cut = F.slice("_w", (begin + 1).cast("int"), (F.least(F.col("_to") - F.col("_first"), F.size("_w")) - begin).cast("int"))
    parts = pieces.select(*document, request, length, "start", F.struct("_first", F.array_join(cut, " ").alias("t")).alias("_piece"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list("_piece")), lambda p: p["t"]), " ")
    return parts.groupBy(*document, request, length, "start").agg(text.alias("window"))
