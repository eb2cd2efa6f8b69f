"""GPU utilisation logs: parse, de-duplicate stamps, carry stamps forward, gap fill.

A log is a sequence of lines per source: stamp lines (containing ``node``,
5th blank-separated field ``h:m:s``) and sample lines (containing ``root``,
2nd character the GPU id, 2nd comma field ``N %``). Every operator here
takes lines with a position ``pos`` that is unique within each source (gaps
allowed). What depends on the lines before is a recurrence (``scan``), so one
long log is still spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import WORD_SPACE, strip
from ..session import materialize
from ..sources.text import hms_to_ms
from .ordered import attach_by_key
from .scan import Recurrence, scan

BUMP_MS = 300


def parse_util_lines(lines: DataFrame, source: str = "source", pos: str = "pos",
                     value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Classify lines and parse their fields.

    Adds ``kind`` ('stamp', 'sample', 'both' or NULL), ``raw_ms`` for stamps,
    ``gpu`` and ``util`` for samples; ``keep`` names extra columns to pass
    through. A line with both tokens is a stamp and a sample under it. A
    field that is missing or no number raises.
    """
    v = strip(value)
    is_stamp = v.contains("node")
    is_sample = v.contains("root")
    blanks = F.translate(v, WORD_SPACE, " " * len(WORD_SPACE))
    stamp_field = F.get(F.split(blanks, " +"), 4)
    util_text = strip(F.get(F.split(F.get(F.split(v, ","), 1), "%"), 0))

    def read(c: Column, what: str) -> Column:
        return F.coalesce(c, F.raise_error(F.concat(F.lit(f"no {what}: "), F.col(value))))

    return lines.select(
        source, pos, value, *keep,
        F.when(is_stamp & is_sample, "both").when(is_stamp, "stamp").when(is_sample, "sample").alias("kind"),
        F.when(is_stamp, read(hms_to_ms(stamp_field), "time")).alias("raw_ms"),
        F.when(is_sample, read(F.substring(v, 2, 1).try_cast("int"), "GPU")).alias("gpu"),
        F.when(is_sample, read(util_text.try_cast("long"), "share")).alias("util"))


def _adjusted(rows: DataFrame, source: str, pos: str, is_stamp: Column, raw: Column, step: int) -> DataFrame:
    """Each row with the newest stamp at or above it: ``stamp_pos``, ``stamp_ms`` (adjusted), ``stamp_index``.

    Let m be 1 where a stamp was moved and 0 elsewhere. A stamp equal to the
    raw one before it is moved if that one was not (m flips), one that is
    ``step`` above it is moved if that one was (m stays), any other is not (m
    is 0 again). So m is a count of flips that starts over at the others,
    modulo 2, for any step and any grain of the stamps.
    """
    own = F.when(is_stamp, F.struct(F.col(pos).alias("p"), raw.alias("raw")))
    rows = scan(rows, [source], pos, {
        "_tp_above": Recurrence(reset=own, before=True),
        "stamp_index": Recurrence(add=is_stamp.cast("long"), start=F.lit(-1).cast("long")),
    }, chain=True)
    before = F.col("_tp_above.raw")
    equal, beyond = raw == before, raw == before + step
    restart = (F.when(~is_stamp, None).when(before.isNull(), (raw == 0).cast("long"))
               .when(~equal & ~beyond, F.lit(0).cast("long")))
    rows = scan(rows, [source], pos, {
        "_tp_moves": Recurrence(reset=restart, add=(is_stamp & equal & ~beyond).cast("long"))})
    newest = F.coalesce(own, F.col("_tp_above"))
    kept = [c for c in rows.columns if c not in ("_tp_above", "_tp_moves", "stamp_index")]
    return rows.select(*kept, "stamp_index", newest["p"].alias("stamp_pos"),
                       (newest["raw"] + F.pmod("_tp_moves", F.lit(2)) * step).alias("stamp_ms"))


def bump_equal_stamps(stamps: DataFrame, source: str, raw: str, order: str,
                      name: str = "adjusted_ms", step: int = BUMP_MS,
                      index: str | None = None) -> DataFrame:
    """A stamp equal to the *adjusted* previous stamp of its source gets ``+step``.

    The previous stamp starts at 0, so a first stamp of 0 is moved. Stamps
    may be of any grain: one that equals a moved stamp is moved too.
    ``index`` names an optional output column with the 0-based position of
    the stamp among its source's stamps.
    """
    out = _adjusted(stamps, source, order, F.lit(True), F.col(raw), step)
    return out.select(*stamps.columns, F.col("stamp_ms").alias(name),
                      *([F.col("stamp_index").alias(index)] if index else []))


def stamped_lines(parsed: DataFrame, source: str = "source", pos: str = "pos", step: int = BUMP_MS) -> DataFrame:
    """All lines with the newest stamp at or above them in their source.

    Adds ``stamp_pos`` (the line of that stamp, i.e. the sampling round),
    ``stamp_ms`` (its adjusted time) and ``stamp_index``; above the first
    stamp they are null, null and -1.
    """
    is_stamp = F.coalesce(F.col("kind").isin("stamp", "both"), F.lit(False))
    return _adjusted(parsed, source, pos, is_stamp, F.col("raw_ms"), step)


def stamped_samples(parsed: DataFrame, source: str = "source", pos: str = "pos", step: int = BUMP_MS) -> DataFrame:
    """The sample lines with the newest stamp above them; a sample without one raises."""
    lines = stamped_lines(parsed, source, pos, step).where(F.col("kind").isin("sample", "both"))
    above = F.coalesce(F.col("stamp_pos"), F.raise_error(F.lit("a sample has no stamp above it")))
    return lines.withColumn("stamp_pos", above).drop("kind", "raw_ms")


def gap_fill(samples: DataFrame, source: str = "source", gpus: int = 4, pos: str = "pos") -> DataFrame:
    """One row per sampling round with one column per GPU (missing GPU → 0).

    Time axis: seconds since the source's earliest stamp, plus a closing row
    of zeros at ``(max - min) // 1000 + 1`` seconds.
    """
    ids = list(range(gpus))
    rounds = (samples.groupBy(source, "stamp_pos", "stamp_ms")
              .pivot("gpu", ids).agg(F.max_by("util", pos)))
    rounds = rounds.select(source, "stamp_pos", "stamp_ms",
                           *[F.coalesce(F.col(str(g)), F.lit(0).cast("long")).alias(f"gpu{g}")
                             for g in ids])
    rounds = materialize(rounds)  # read by the bounds and by the points
    bounds = rounds.groupBy(source).agg(F.min("stamp_ms").alias("_lo"),
                                        F.max("stamp_ms").alias("_hi"))
    # Rounds are contiguous per source in stamp_pos order: attach the bounds
    # by (block, source) so a long log's rounds are spread over tasks.
    points = attach_by_key(rounds, [source], "stamp_pos", bounds).select(
        source, ((F.col("stamp_ms") - F.col("_lo")) / 1000.0).alias("t_s"),
        *[f"gpu{g}" for g in ids])
    closing = bounds.select(
        source, (F.floor((F.col("_hi") - F.col("_lo")) / 1000) + 1).cast("double").alias("t_s"),
        *[F.lit(0).cast("long").alias(f"gpu{g}") for g in ids])
    return points.unionByName(closing)


def gpu_cycle_fill(samples: DataFrame, source: str = "source", pos: str = "pos", gpus: int = 4) -> DataFrame:
    """The series that a reader makes who expects the GPUs in turn: ``source, position, t_s, gpu0, ...``.

    The reader takes samples in order and expects GPU 0, 1, ... again and
    again; each GPU that is not the one of the next sample gets a 0, and so
    do those after the last sample up to the end of the cycle. Times go in a
    list of their own: a new entry where a sample's stamp differs from that of
    the sample before. Both lists are closed (zeros; a time one past the span)
    and put side by side by position; where GPU ids do not rise within a stamp
    or a stamp is silent they differ in length, and the shorter one's columns
    are null. Times are seconds since the source's least one.

    The GPU expected after a sample follows from that sample alone, so the
    place of a sample among all cells is a running sum of the zeros before it
    and itself. A GPU id outside 0 to ``gpus`` - 1 raises: the reader would
    wait for it forever.
    """
    gpu = F.when(F.col("gpu").between(0, gpus - 1), F.col("gpu")).otherwise(
        F.raise_error(F.concat(F.lit("no such GPU: "), F.col("gpu").cast("string"))).cast("int"))
    rows = scan(samples.select(source, pos, gpu.alias("gpu"), "util", "stamp_ms"), [source], pos, {
        "_above": Recurrence(reset=F.struct("gpu", "stamp_ms"), before=True)}, chain=True)
    expected = F.coalesce((F.col("_above.gpu") + 1) % gpus, F.lit(0))
    cells = F.pmod(F.col("gpu") - expected, F.lit(gpus)) + 1
    new_time = F.coalesce(F.col("_above.stamp_ms") != F.col("stamp_ms"), F.lit(True))
    start = F.lit(-1).cast("long")
    rows = scan(rows.withColumn("_new", new_time), [source], pos, {
        "_cell": Recurrence(add=cells, start=start), "_time": Recurrence(add=F.col("_new").cast("long"), start=start)})
    rows = materialize(rows.select(source, "gpu", "util", "stamp_ms", "_new", F.expr(f"_cell div {gpus}").alias("_cycle"), "_time"))

    names = [f"gpu{g}" for g in range(gpus)]
    cycles = rows.groupBy(source, F.col("_cycle").alias("position")).agg(
        *[F.coalesce(F.max(F.when(F.col("gpu") == g, F.col("util"))), F.lit(0).cast("long")).alias(n) for g, n in enumerate(names)])
    bounds = rows.groupBy(source).agg(F.min("stamp_ms").alias("_lo"), F.max("stamp_ms").alias("_hi"),
                                      (F.max("_cycle") + 1).alias("_cycles"), (F.max("_time") + 1).alias("_times"))
    cycles = cycles.unionByName(bounds.select(
        source, F.col("_cycles").alias("position"), *[F.lit(0).cast("long").alias(n) for n in names]))
    times = rows.where("_new").select(source, F.col("_time").alias("position"), "stamp_ms")
    times = attach_by_key(times, [source], "position", bounds.select(source, "_lo")).select(
        source, "position", ((F.col("stamp_ms") - F.col("_lo")) / 1000.0).alias("t_s"))
    times = times.unionByName(bounds.select(
        source, F.col("_times").alias("position"),
        (F.floor((F.col("_hi") - F.col("_lo")) / 1000) + 1).cast("double").alias("t_s")))
    beside = times.unionByName(cycles, allowMissingColumns=True)
    return beside.groupBy(source, "position").agg(*[F.max(c).alias(c) for c in ("t_s", *names)])
