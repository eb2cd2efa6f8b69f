"""Sharding, request-length and request-window queries over ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import WORD_SPACE, md5_unit
from ..operators import sampling as X
from ..session import materialize, remove_path, scratch_path
from ..sources.sinks import write_lines
from ..sources.tables import numbered_table, table
from ..sources.text import scan_document_chunks, scan_text

RANKS = 4
GLOBAL_BATCH = 256


def shard_assign(spark, sf_dir, ranks: int = RANKS, seed: int = 0):
    """Documents shuffled with seed 0, padded and dealt to 4 ranks; batches of 256/4 per rank."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    s = X.assign_shards(docs, "doc_id", ranks, seed)
    return s.select("doc_id", "rank", "pos_in_shard",
                    X.batch_of("pos_in_shard", GLOBAL_BATCH // ranks).alias("batch"))


def zipf_lengths(spark, sf_dir, seed: int = 1):
    """One request length per document, truncated Zipf(1.3) on 21..199."""
    docs = table(spark, sf_dir, "documents").select("doc_id", md5_unit(str(seed), "doc_id").alias("_u"))
    return docs.select("doc_id", X.zipf_length("_u").alias("n_words"))


def shard_assign_feistel(spark, sf_dir, ranks: int = RANKS, seed: int = 0):
    """Documents shuffled in place by a keyed permutation of their row numbers, dealt to 4 ranks."""
    docs = numbered_table(spark, sf_dir, "documents", "_row").select("doc_id", "_row")
    n = table(spark, sf_dir, "documents").count()
    s = X.deal_shards(X.feistel_positions(docs, "_row", n, seed, "_p").drop("_row"), "_p", n, ranks)
    return s.select("doc_id", "rank", "pos_in_shard",
                    X.batch_of("pos_in_shard", GLOBAL_BATCH // ranks).alias("batch"))


def request_windows(spark, sf_dir, seed_len: int = 1, seed_start: int = 2):
    """A request of Zipf length from each document long enough (length < words)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", md5_unit(str(seed_len), "doc_id").alias("_u"))
    # The words come from a generator, so lengths and filters above it do not work them out again.
    docs = docs.select("doc_id", "text", X.zipf_length("_u").alias("n_words")).select(
        "doc_id", "n_words", X.one_of(X.words("text")).alias("w"))
    ok = docs.where(F.col("n_words") < F.size("w"))
    start, text = X.word_window("w", "n_words", md5_unit(str(seed_start), "doc_id"))
    return ok.select("doc_id", "n_words", start.alias("start"), text.alias("request"))


def _corpus_requests(spark, sf_dir, seed_len: int = 1, seed_start: int = 2):
    """Random windows of whole stored documents: all texts of a language are one, a request for each row."""
    docs = table(spark, sf_dir, "documents")
    path, chunks = scratch_path(spark, "corpus"), scratch_path(spark, "corpus_chunks")
    texts = docs.select("lang", "doc_id", "text").where(F.col("text").isNotNull())
    texts.repartitionByRange("lang", "doc_id").sortWithinPartitions("lang", "doc_id").drop("doc_id").write.partitionBy("lang").text(path)
    scan_document_chunks(spark, path, by=("lang",)).write.parquet(chunks)
    remove_path(spark, path)
    drawn = docs.select("lang", "doc_id", md5_unit(str(seed_len), "doc_id").alias("_u"), md5_unit(str(seed_start), "doc_id").alias("u"))
    requests = drawn.select("lang", "doc_id", X.zipf_length("_u").alias("n_words"), "u")
    found = materialize(X.chunk_windows(spark.read.parquet(chunks), requests, ["lang"], "doc_id", "n_words", "u"))
    remove_path(spark, chunks)
    return found


def corpus_windows(spark, sf_dir):
    """A request of Zipf length from the whole document of each row's language."""
    return _corpus_requests(spark, sf_dir).select("lang", "doc_id", "n_words", "start", F.col("window").alias("request"))


def request_file(spark, sf_dir):
    """The requests of ``corpus_windows`` written as a file of lines, and its lines."""
    path = scratch_path(spark, "requests")
    write_lines(_corpus_requests(spark, sf_dir), path, "window")
    lines = materialize(scan_text(spark, path))
    remove_path(spark, path)
    return lines.select(F.col("value").alias("request"))


def sample_documents(spark, sf_dir, n: int = 150, seed: int = 7):
    """A seeded sample of 150 documents without replacement."""
    return X.sample_rows(table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), "doc_id", n, seed)


QUERIES = {
    "shard_assign": shard_assign,
    "zipf_lengths": zipf_lengths,
    "request_windows": request_windows,
    "shard_assign_feistel": shard_assign_feistel,
    "corpus_windows": corpus_windows,
    "request_file": request_file,
    "sample_documents": sample_documents,
}


def _space_sql() -> str:
    return "(" + " || ".join(f"chr({ord(c)})" for c in WORD_SPACE) + ")"


def _cdf_sql() -> str:
    return "[" + ", ".join(repr(c) for c in X.zipf_cdf()) + "]"


def _unit_sql(seed: str, col: str) -> str:
    return (f"CAST(('0x' || substr(md5('{seed}:' || CAST({col} AS VARCHAR)), 1, 13)) AS BIGINT)"
            " / 4503599627370496.0")


def _len_sql(seed: str, col: str) -> str:
    return (f"CAST(21 + len(list_filter({_cdf_sql()}, lambda c: c <= {_unit_sql(seed, col)}))"
            " AS INTEGER)")


def _feistel_sql(n: str, seed: int) -> str:
    """CTEs ``side`` and ``perm(x, y)``: the keyed permutation of all cells of the grid, a CTE a round."""
    parts = [f"side AS (SELECT n, a, (n + a - 1) // a AS b FROM (SELECT n, CAST(floor(sqrt(n - 1)) AS BIGINT) + 1 AS a FROM ({n})))",
             "f0 AS (SELECT x, a, b, x // b AS l, x % b AS r FROM (SELECT a, b, unnest(range(a * b)) AS x FROM side))"]
    for k, (mul, add) in enumerate(X.feistel_keys(seed)):
        own, other, side = ("l", "r", "a") if k % 2 == 0 else ("r", "l", "b")
        m = f"(({other} % {X.FEISTEL_PRIME} * {mul} + {add}) % {X.FEISTEL_PRIME})"
        parts.append(f"f{k + 1} AS (SELECT x, a, b, ({own} + ({m} // 64 + {m} * 31) % {side}) % {side} AS {own}, {other} FROM f{k})")
    parts.append(f"perm AS MATERIALIZED (SELECT x, l * b + r AS y FROM f{X.FEISTEL_ROUNDS})")
    return ",\n".join(parts)


def _window_sql() -> str:
    return f"""
d AS MATERIALIZED (
  SELECT lang, list(t ORDER BY doc_id) AS ts FROM (
    SELECT lang, doc_id, regexp_split_to_array(trim(text, {_space_sql()}), '[' || {_space_sql()} || ']+') AS t
    FROM documents WHERE trim(text, {_space_sql()}) <> '') GROUP BY lang),
w AS MATERIALIZED (SELECT lang, flatten(ts) AS w FROM d),
r AS (SELECT lang, doc_id, {_len_sql('1', 'doc_id')} AS n_words, {_unit_sql('2', 'doc_id')} AS u FROM documents),
s AS (SELECT r.lang, doc_id, w, n_words, CAST(floor(u * (len(w) - n_words + 1)) AS BIGINT) AS start
      FROM r JOIN w ON r.lang = w.lang WHERE n_words < len(w)),
q AS (SELECT lang, doc_id, n_words, start, array_to_string(w[start + 1:start + n_words], ' ') AS request FROM s)"""


SQL = {
    "shard_assign_feistel": f"""
WITH RECURSIVE {_feistel_sql('SELECT count(*) AS n FROM documents', 0)},
d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS x FROM documents),
walk AS (SELECT doc_id, y FROM d JOIN perm USING (x)
         UNION ALL SELECT walk.doc_id, perm.y FROM walk JOIN perm ON walk.y = perm.x WHERE walk.y >= (SELECT n FROM side)),
p AS (SELECT doc_id, y AS p FROM walk WHERE y < (SELECT n FROM side)),
q AS (SELECT doc_id, p AS q FROM p
      UNION ALL SELECT doc_id, p + n FROM p, side WHERE p < (4 - n % 4) % 4)
SELECT doc_id, q % 4 AS rank, q // 4 AS pos_in_shard, (q // 4) // 64 AS batch FROM q""",
    "corpus_windows": f"WITH {_window_sql()}\nSELECT * FROM q",
    "request_file": f"WITH {_window_sql()}\nSELECT request FROM q",
    "sample_documents": """
SELECT doc_id, lang, source FROM documents ORDER BY md5('7:' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 150""",
    "shard_assign": """
WITH p AS (SELECT doc_id, row_number() OVER (ORDER BY md5('0:' || CAST(doc_id AS VARCHAR)), doc_id) - 1 AS p
           FROM documents),
c AS (SELECT count(*) AS n FROM documents),
q AS (SELECT doc_id, p AS q FROM p
      UNION ALL SELECT doc_id, p + c.n FROM p, c WHERE p < (4 - c.n % 4) % 4)
SELECT doc_id, q % 4 AS rank, q // 4 AS pos_in_shard, (q // 4) // 64 AS batch FROM q""",
    "zipf_lengths": f"SELECT doc_id, {_len_sql('1', 'doc_id')} AS n_words FROM documents",
    "request_windows": f"""
WITH d AS (SELECT doc_id, regexp_split_to_array(trim(text, {_space_sql()}), '[' || {_space_sql()} || ']+') AS w,
                  {_len_sql('1', 'doc_id')} AS n_words, {_unit_sql('2', 'doc_id')} AS u
           FROM documents),
s AS (SELECT doc_id, w, n_words, CAST(floor(u * (len(w) - n_words + 1)) AS INTEGER) AS start
      FROM d WHERE n_words < len(w))
SELECT doc_id, n_words, start, array_to_string(w[start + 1:start + n_words], ' ') AS request FROM s""",
}
