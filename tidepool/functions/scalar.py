"""Column-level helpers (all built-in expressions, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that separate words: ASCII white space, the separators 0x1C to
# 0x1F and the blanks of Unicode.
WORD_SPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
              "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
WORD_SEP = f"[{WORD_SPACE}]+"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """Text without the white space at its ends."""
    return F.trim(col(c), F.lit(WORD_SPACE))


def strict_cast(raw: Column, to: str) -> Column:
    """``cast`` that raises on text that is no ``to``, whatever the session's ANSI setting."""
    value = raw.try_cast(to)
    bad = F.raise_error(F.concat(F.lit(f"not a {to}: "), raw)).cast(to)
    return F.when(raw.isNull() | value.isNotNull(), value).otherwise(bad)


def epoch_micros(c: str | Column) -> Column:
    """Microseconds since 1970-01-01 for a ``timestamp_ntz`` (wall-clock) column.

    Independent of the session time zone, like the naive timestamps in the
    Parquet inputs.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, col(c))


def seconds_between(a: str | Column, b: str | Column) -> Column:
    """(b - a) in seconds as a double."""
    return (epoch_micros(b) - epoch_micros(a)) / F.lit(1e6)


def argmax(arr: str | Column) -> Column:
    """0-based index of the largest element; the first one on ties."""
    a = col(arr)
    return F.array_position(a, F.array_max(a)) - 1


def trunc_int(c: Column) -> Column:
    """Python ``int()`` on a float: truncation towards zero."""
    return c.cast("long")


def md5_unit(seed: str, *parts: str | Column) -> Column:
    """Deterministic uniform in [0, 1) from ``md5(seed:part1:part2...)``.

    Uses the first 13 hex digits (52 bits), so the value is exact in a double
    and the same in any engine that has md5.
    """
    text = F.concat_ws(":", F.lit(seed), *[col(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def zip_sum(a: str | Column, b: str | Column) -> Column:
    """Element-wise sum of two equal-length lists (join by position)."""
    return F.zip_with(col(a), col(b), lambda x, y: x + y)
