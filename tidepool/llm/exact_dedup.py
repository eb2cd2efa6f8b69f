"""Exact duplicates by progressive refinement: length, prefix hash, full hash.

Three scans, each of them narrower in what it hashes:

1. byte lengths only; a length that occurs once belongs to a unique text;
2. a hash of the first characters, for texts whose length repeats;
3. the SHA-256 of the whole text, for texts whose length and prefix repeat.

What a level learns reaches the next scan as a bitmap of fixed size (``bits``
bits, 4 KB slices). A false hit only costs one more hash: the groups are made
from length, prefix hash and full hash. Texts never move between executors;
only ids, lengths and hashes do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import ascii_lower
from tidepool.session import materialize

# Bits of a level's bitmap: at most 2^24 bits, 512 slices of 4 KB, 2 MB in all.
BITS = 1 << 24


def _place(keys: Sequence[Column], bits: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(bits)) + 1


def repeated_keys(df: DataFrame, keys: Sequence[str], bits: int = BITS) -> DataFrame:
    """Bitmap slices (``bits`` / 32768 rows of 4 KB at most) of the keys that occur twice or more."""
    twice = df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
    place = _place([F.col(k) for k in keys], bits)
    return (twice.select(place.alias("_place"))
            .groupBy(F.bitmap_bucket_number("_place").alias("_slice"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bitmap")))


def mark_repeated(df: DataFrame, slices: DataFrame, keys: Sequence[str], flag: str,
                  bits: int = BITS) -> DataFrame:
    """Adds ``flag``: true when the row's keys may occur twice (never false when they do)."""
    place = _place([F.col(k) for k in keys], bits)
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(F.col("_bitmap"), (at / 8).cast("int") + 1, F.lit(1))), 16, 10)
    bit = byte.cast("int").bitwiseAND(
        F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (at % 8).cast("int") + 1))
    return (df.withColumn("_slice", F.bitmap_bucket_number(place))
            .join(F.broadcast(slices), "_slice", "left")
            .withColumn(flag, F.coalesce(bit != 0, F.lit(False)))
            .drop("_slice", "_bitmap"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                carry: dict[str, Column] | None = None, prefix_chars: int = 256,
                bits: int = BITS) -> DataFrame:
    """One row per input row: ``id_col, keep_id, group_size, kept`` and the ``carry`` columns.

    Texts are equal when identical after lower-casing A-Z. ``keep_id`` is the
    largest id of the equal texts and ``group_size`` their number of rows.
    Defined cases: a null text counts as empty, and all empty texts are
    equal; a null id is the smallest id; of repeated rows (same id, equal
    text) exactly one is kept, whichever comes first; a very long text is
    compared whole, however long a beginning it shares, and held as one value
    of its row; an empty table gives an empty result; other
    columns of the input are ignored unless named in ``carry`` (output name
    to expression over the input's columns).
    """
    carry = carry or {}
    text = F.coalesce(docs[text_col], F.lit(""))
    length = F.octet_length(text)
    prefix = F.xxhash64(ascii_lower(F.substring(text, 1, prefix_chars)))
    full = F.sha2(ascii_lower(text).cast("binary"), 256)

    lengths = materialize(repeated_keys(docs.select(length.alias("_len")), ["_len"], bits))
    second = mark_repeated(docs.select(length.alias("_len"), prefix.alias("_prefix")),
                           lengths, ["_len"], "_again", bits).where("_again")
    pairs = materialize(repeated_keys(second, ["_len", "_prefix"], bits))

    rows = docs.select(docs[id_col].alias("_id"), text.alias("_text"), length.alias("_len"),
                       prefix.alias("_prefix"),
                       *[c.alias(f"_carry_{name}") for name, c in carry.items()])
    rows = mark_repeated(rows, lengths, ["_len"], "_again", bits)
    rows = mark_repeated(rows, pairs, ["_len", "_prefix"], "_again2", bits)
    full = F.sha2(ascii_lower(F.col("_text")).cast("binary"), 256)
    rows = materialize(
        rows.withColumn("_hash", F.when(F.col("_again") & F.col("_again2"), full))
        .withColumn("_row", F.monotonically_increasing_id())
        .drop("_text", "_again", "_again2"))

    groups = materialize(
        rows.where("_hash is not null").groupBy("_len", "_prefix", "_hash")
        .agg(F.max(F.struct("_id", "_row")).alias("_keep"), F.count("*").alias("_n"))
        .where("_n > 1")
        .select(F.concat_ws(":", "_len", "_prefix", "_hash").alias("_key"), "_keep", "_n"))
    # A text without a full hash is unique: it gets a key of its own, so that
    # such rows spread over the join instead of meeting at one null key.
    key = F.coalesce(F.concat(F.col("_len"), F.lit(":"), F.col("_prefix"), F.lit(":"), F.col("_hash")),
                     F.col("_row").cast("string"))
    joined = rows.withColumn("_key", key).join(groups, "_key", "left")
    alone = F.col("_n").isNull()
    return joined.select(
        F.col("_id").alias(id_col),
        F.when(alone, F.col("_id")).otherwise(F.col("_keep._id")).alias("keep_id"),
        F.coalesce("_n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("_keep._row") == F.col("_row"))).alias("kept"),
        *[F.col(f"_carry_{name}").alias(name) for name in carry])
