"""From raw documents to packed training sequences, as five stages.

Each stage is (name, function); a function takes (spark, docs, sf_dir), works
on all that its predecessor kept and returns the columns of documents, but for
the last, which returns the packed pieces. ``run`` writes each stage's result
as Parquet and reads it again for the next.

Defined cases: null and empty texts pass the filters (all empty texts are
exact duplicates of each other, so one stays); documents without an id pass
the near-duplicate stage; further columns are carried along under any name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.common import table
from tidepool.llm.decontaminate import drop_leaks
from tidepool.llm.exact_dedup import exact_dedup
from tidepool.llm.jaccard_join import jaccard_components
from tidepool.llm.packing import pack_documents
from tidepool.llm.queries import tokenizer_path
from tidepool.llm.row_filter import parted
from tidepool.llm.toxicity import fit_toxicity, score_toxicity
from tidepool.session import materialize, scratch_path

# Near duplicates: distinct five-word shingles, Jaccard similarity in hundredths.
NEAR_WORDS, NEAR_THRESHOLD = 5, 80


# A row is named by its id and a hash of its text: an id may be on rows of different texts.
ROW_KEY = ["_id_key", "_hash"]


def _row_key() -> dict[str, Column]:
    return dict(zip(ROW_KEY, [F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.xxhash64("text")], strict=True))


def _plain_names(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The table with names that no operator uses for its results, and the way back."""
    names = [c if c in ("doc_id", "text") else f"column_{i}" for i, c in enumerate(docs.columns)]

    def back(df: DataFrame) -> DataFrame:
        return df.select(*names).toDF(*docs.columns)

    return docs.toDF(*names), back


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity field, learnt from all labels, does not reject."""
    plain, back = _plain_names(docs)
    field = fit_toxicity(plain, table(spark, sf_dir, "labels"))
    keep = [c for c in plain.columns if c != "doc_id"]
    return back(score_toxicity(plain, field, spans=False, keep=keep).where("predicted = 0"))


def remove_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the largest id."""
    plain, back = _plain_names(docs)
    keyed = plain.withColumns(_row_key())
    found = exact_dedup(plain, carry=_row_key())
    # Rows that go, and how many of the same id and text stay (one, of repeated rows).
    counted = found.groupBy(*ROW_KEY).agg(F.sum(F.col("kept").cast("int")).alias("_stay"), F.count(F.lit(1)).alias("_n"))
    gone = materialize(counted.where("_stay < _n").select(*ROW_KEY, "_stay"))
    others, named = parted(keyed, gone, ROW_KEY)
    named = named.join(gone, ROW_KEY, "left")
    stay = named.where("_stay is null").unionByName(named.where("_stay > 0").dropDuplicates(ROW_KEY))
    return back(others.unionByName(stay.select(*others.columns)))


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: the one with the smallest id."""
    plain, back = _plain_names(docs)
    # Each row decides for itself.
    keyed = plain.withColumns(_row_key())
    row = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", *ROW_KEY))
    found = jaccard_components(keyed.select(row.alias("row"), "text"), "row", n=NEAR_WORDS, threshold=NEAR_THRESHOLD)
    gone = materialize(found.where("row <> component_id").select(*[f"row.{c}" for c in ROW_KEY]).distinct())
    others, named = parted(keyed, gone, ROW_KEY)
    return back(others.unionByName(named.join(gone, ROW_KEY, "left_anti")))


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    plain, back = _plain_names(docs)
    return back(drop_leaks(plain, table(spark, sf_dir, "benchmark")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their places in sequences of 4096."""
    plain, _ = _plain_names(docs)
    packed = pack_documents(plain, tokenizer_path("word_bpe_49k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", remove_toxic),
    ("exact_dedup", remove_exact_copies),
    ("near_dedup", remove_near_copies),
    ("decontamination", remove_benchmark),
    ("packing", pack),
]

# Scores of a trained field, transitive links and token ids are beyond SQL;
# tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; returns the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


__all__ = ["ORACLE_SQL", "STAGES", "run"]
