"""Text sources: plain lines, edge lists, whitespace field logs."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..functions.scalar import WORD_SEP, strict_cast, strip
from ..session import materialize


# Characters of a batch of document chunks.
CHUNK_BATCH = 4 << 20


def quote_regex(sep: str) -> str:
    """Literal separator for ``split``, which takes a Java regular expression."""
    return re.escape(sep) if sep not in ("\t", " ") else sep


def scan_text(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """One row per line, column ``value``.

    ``min_partitions`` asks for at least that many input splits: Hadoop's
    text input cuts the bytes of all files into splits of the total size by
    that number, and lines stay in the split that holds their first byte. So
    there is no exchange; a file format that cannot be cut (gzip) stays one
    split a file.
    """
    if not min_partitions:
        return spark.read.text(path)
    lines = spark.sparkContext._jsc.textFile(path, min_partitions)
    made = spark._jsparkSession.createDataset(lines.rdd(), spark._jvm.org.apache.spark.sql.Encoders.STRING())
    return DataFrame(made.toDF(), spark)


def parse_edges(lines: DataFrame, sep: str = "\t", comment: str | None = "#",
                mode: str = "strict", value: str = "value") -> DataFrame:
    """Text lines -> (src: string, dst: string).

    Lines starting with ``comment`` are dropped; the rest are split on
    ``sep`` and the first two fields kept (later fields are ignored). A line
    with fewer than two fields raises in ``strict`` mode and is skipped in
    ``drop`` mode.
    """
    v = F.col(value)
    kept = lines.where(~v.startswith(comment)) if comment else lines
    parts = F.split(v, quote_regex(sep))
    src, dst = F.get(parts, 0), F.get(parts, 1)
    if mode == "drop":
        kept = kept.where(F.size(parts) >= 2)
    elif mode == "strict":
        dst = F.when(v.isNull() | (F.size(parts) >= 2), dst).otherwise(
            F.raise_error(F.concat(F.lit("fewer than two fields: "), v)))
    else:
        raise ValueError(f"mode must be 'strict' or 'drop', not {mode!r}")
    return kept.select(src.alias("src"), dst.alias("dst"))


def scan_edges(spark: SparkSession, path: str, sep: str = "\t", comment: str | None = "#",
               mode: str = "strict", min_partitions: int | None = None) -> DataFrame:
    return parse_edges(scan_text(spark, path, min_partitions), sep, comment, mode)


def field_lines(lines: DataFrame, token: str, value: str = "value") -> DataFrame:
    """Keep lines containing ``token``; add ``fields``: the line split on runs of white space."""
    v = F.col(value)
    return lines.where(v.contains(token)).withColumn("fields", F.split(strip(v), WORD_SEP))


def lines_by_token(lines: DataFrame, tokens: tuple[str, ...], name: str = "token",
                   value: str = "value") -> DataFrame:
    """A row for each line and each of the ``tokens`` it contains, with ``fields`` as above."""
    v = F.col(value)
    held = F.array_compact(F.array(*[F.when(v.contains(t), F.lit(t)) for t in tokens]))
    return (lines.withColumn(name, F.explode(held))
            .withColumn("fields", F.split(strip(v), WORD_SEP)))


def field(idx: int, to: str | None = None, mode: str = "strict") -> Column:
    """0-based field of ``fields``; ``strict`` raises on a short line or bad number."""
    raw = F.get(F.col("fields"), idx)
    if mode == "strict":
        raw = F.when(F.size("fields") > idx, raw).otherwise(F.raise_error(F.lit(f"a line has no field {idx}")))
        return raw if to is None else strict_cast(raw, to)
    return raw if to is None else raw.try_cast(to)


# Split tables of up to so many rows are sent to every task.
BROADCAST_SPLITS = 1 << 16


def scan_lines(spark: SparkSession, path: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Text files as (file, line_no, value) with 0-based line numbers per file.

    ``by`` names columns of the folders (``name=value``): the files of a
    folder are then parts of one text, in the order of their names, and the
    columns ``by`` stand in the place of ``file``.

    Lines stay where they are read: a task numbers the lines of its splits,
    and the counts of the splits (one row each) give every split its first
    number. The numbered lines are checkpointed, as the counts read them too.
    The table of splits goes to every task while it is small (its rows are
    counted); Spark chooses the join beyond that.
    """
    whole = list(by) or ["file"]
    raw = materialize(spark.read.text(path).select(
        *by, F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_mid"), "value"))
    splits = raw.groupBy(*by, "file", "_split").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    # One row a split; a window holds the splits of one text.
    before = Window.partitionBy(*whole).orderBy("file", "_split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(splits.select(
        F.col("file").alias("_file"), F.col("_split").alias("_start"), "_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    small = offsets.count() <= BROADCAST_SPLITS
    on = (F.col("file") == F.col("_file")) & (F.col("_split") == F.col("_start"))
    return raw.join(F.broadcast(offsets) if small else offsets, on).select(
        *whole, (F.col("_before") + F.col("_mid") - F.col("_first")).alias("line_no"), "value")


def hms_to_ms(c: Column) -> Column:
    """``h:m:s`` text -> milliseconds since midnight (no date: no wrap at midnight); null for any other text."""
    p = F.split(c, ":")
    h, m, s = (F.get(p, i).try_cast("long") for i in range(3))
    return (h * 3600 + m * 60 + s) * 1000


def scan_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as one text each: (path, text). Each file is one row."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def changes(column: pa.Array) -> np.ndarray:
    """Whether each value but the first differs from the one before (at its own place; the first never does)."""
    after, before = column[1:], column[:-1]
    differs = pc.fill_null(pc.not_equal(after, before), False).to_numpy(zero_copy_only=False)
    nulls = column.is_null().to_numpy(zero_copy_only=False)
    return np.concatenate([[False], differs | (nulls[1:] != nulls[:-1])])


def joined_runs(batches: Iterator[pa.RecordBatch], chunk_chars: int, sep: str) -> Iterator[tuple[list, int, str]]:
    """(head, number, text) of chunks of the last column's values, which have the same head in all other columns.

    A chunk ends with the value that fills it. Values are counted, cut and
    joined as columns, none by itself.
    """
    def joined(held):
        values = pa.concat_arrays(held).cast(pa.string())
        return pc.binary_join(pa.ListArray.from_arrays([0, len(values)], values), sep)[0].as_py()

    now, held, size, number = None, [], 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        *marks, values = batch.columns
        cuts = np.flatnonzero(np.any([changes(c) for c in marks], axis=0)).tolist()
        sizes = np.cumsum(pc.utf8_length(values).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        for at, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            head = [c[at].as_py() for c in marks]
            if head != now:
                if held:
                    yield now, number, joined(held)
                now, held, size, number = head, [], 0, 0
            while at < end:
                if held and size >= chunk_chars:
                    yield now, number, joined(held)
                    held, size, number = [], 0, number + 1
                before = int(sizes[at - 1]) if at else 0
                # As many as it takes to fill the chunk, one at least.
                stop = int(np.searchsorted(sizes, before + chunk_chars - size)) + 1
                stop = min(end, max(stop, at + 1))
                held.append(values.slice(at, stop - at))
                size += int(sizes[stop - 1]) - before
                at = stop
    if held:
        yield now, number, joined(held)


def scan_document_chunks(spark: SparkSession, path: str, by: tuple[str, ...] = (), chunk_chars: int = 1 << 14,
                         sep: str = " ") -> DataFrame:
    """Whole documents as chunks: (file or ``by``, part, split, chunk, n_words, text).

    Files are read as runs of text between ``sep``, so neither a document nor
    a line is held whole, and a word that crosses the border of two input
    splits comes whole from the split that it begins in. A task joins the runs
    of a split to chunks of about ``chunk_chars``; chunks are whole words, in
    the order (part, split, chunk) within their document, and ``n_words``
    counts the words between runs of white space. ``by`` names columns of the
    folders, as for ``scan_lines``; ``part`` is the file. Memory is bounded by
    the chunk and by the longest run without ``sep``.
    """
    raw = spark.read.option("lineSep", sep).text(path).select(
        *by, F.col("_metadata.file_path").alias("part"), F.col("_metadata.file_block_start").alias("split"), "value")
    heads = len(by) + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple] = []
        for head, number, text in joined_runs(batches, chunk_chars, sep):
            kept.append((*head, number, len(text.split()), text))
            if len(kept) * chunk_chars >= CHUNK_BATCH:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in kept], schema)
                kept = []
        if kept:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in kept], schema)

    names = [*by, "part", "split", "chunk", "n_words", "text"]
    types = [raw.schema[c].dataType for c in raw.columns[:heads]]
    schema = to_arrow_schema(StructType([StructField(n, t) for n, t in zip(
        names, [*types, IntegerType(), IntegerType(), StringType()], strict=True)]))
    ddl = ", ".join(f"`{n}` {t.simpleString()}" for n, t in zip(
        names, [*types, IntegerType(), IntegerType(), StringType()], strict=True))
    return raw.mapInArrow(run, ddl)


# Layout of a kernel-summary row (profiler "kern_sum" text):
# time %, total time (ns), instances, avg, median, min, max, stddev, name.
KERNEL_FIELDS = ("pct", "total_ns", "instances", "avg_ns", "med_ns", "min_ns", "max_ns",
                 "stddev_ns")


_NUM = r"[0-9]+(?:\.[0-9]+)?"
KERNEL_ROW = r"^\s*" + r"\s+".join([_NUM] * 8) + r"\s+\S"


def parse_kernel_summary(lines: DataFrame, value: str = "value", file: str = "file") -> DataFrame:
    """Kernel-summary text rows -> typed columns, short kernel name, run settings.

    A row is kept when it starts with eight numbers and a name (one regex
    test on the raw line, so the filter never re-evaluates the parse). The
    fields come from one split on blanks with a limit of nine: the ninth is
    the name, kept whole (it holds blanks and commas). ``kernel`` is the
    short name: the identifier after any ``void`` and ``ns::`` qualifiers,
    before template or argument lists. Run settings come from the file name
    (``bs32_tp2_pp2_ite40.txt``); a setting that is absent is 0.
    """
    kept = lines.where(F.col(value).rlike(KERNEL_ROW))
    parts = F.split(F.trim(F.col(value), F.lit(" \t")), r"\s+", 9)
    cols = []
    for i, name in enumerate(KERNEL_FIELDS):
        to = "double" if name in ("pct", "avg_ns", "med_ns", "stddev_ns") else "long"
        cols.append(parts.getItem(i).cast(to).alias(name))
    full = parts.getItem(8)
    short = F.regexp_extract(full, r"^(?:void\s+)?(?:\w+::)*(\w+)", 1)
    base = F.regexp_extract(F.col(file), r"([^/]*)$", 1)
    settings = [F.coalesce(F.regexp_extract(base, rf"(?:^|_){k}(\d+)", 1).try_cast("int"),
                           F.lit(0)).alias(k) for k in ("bs", "tp", "pp", "ite")]
    return kept.select("*", *cols, full.alias("name"), short.alias("kernel"), *settings)
