"""The registered queries of this folder and, where SQL can express them, their DuckDB SQL.

Each query applies one operator with production parameters to its whole
table(s) and derives the contract's columns from the operator's output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.centroids import cluster_vectors
from tidepool.llm.common import LOWER, UPPER, ascii_lower, crc32_mod, table
from tidepool.llm.context_tree import score_texts
from tidepool.llm.decontaminate import find_leaks
from tidepool.llm.exact_dedup import exact_dedup
from tidepool.llm.fill_middle import fill_in_middle, rebuild
from tidepool.llm.jaccard_join import jaccard_components
from tidepool.llm.license_scan import licence_scan
from tidepool.llm.packing import pack_documents
from tidepool.llm.phrase_dedup import remove_phrases
from tidepool.llm.suffix_dedup import remove_repeats
from tidepool.llm.token_counts import count_tokens
from tidepool.llm.toxicity import fit_toxicity, score_toxicity
from tidepool.llm.warc import read_archives, write_archives


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file; its package is on the path or in /opt/tokenizers."""
    try:
        import public_tokenizers
    except ImportError:
        return f"/opt/tokenizers/{name}"
    return public_tokenizers.path(name)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test items that documents hold, with their place and alignment score."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token pieces packed into sequences of 4096."""
    packed = pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_context_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a model of those whose crc32(doc_id) mod 10 is not 0."""
    held_out = crc32_mod(F.col("doc_id"), 10) == 0
    return score_texts(table(spark, sf_dir, "documents"), held_out).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents whose 4-word shingle sets have a Jaccard similarity of 0.85."""
    return jaccard_components(table(spark, sf_dir, "documents"), n=4, threshold=85)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents; a document's path is source, language and id."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("unknown")),
                       F.coalesce(F.col("doc_id").cast("string"), F.lit("unknown")))
    return licence_scan(docs.select("doc_id", path.alias("path"), "text"), "doc_id", "path", "text")


def op6_toxicity_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents; learnt from labels whose crc32(doc_id) mod 4 is not 2."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    field = fit_toxicity(docs, labels.where(crc32_mod(F.col("doc_id"), 4) != 2))
    return score_toxicity(docs, field, spans=True).select(
        "doc_id", (crc32_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted", "spans")


def op7_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records, and what the archives give back."""
    files = write_archives(table(spark, sf_dir, "pages"), "page_id", "url", "html", min_bytes=0)
    rows = read_archives(files, with_data=False).where("last")
    return rows.select(
        F.col("id").cast("long").alias("page_id"), "payload_bytes",
        F.col("digest").alias("payload_digest"), "record_type",
        F.col("refers_to").cast("long").alias("refers_to"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents by the unigram model over the piece vocabulary."""
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicate groups of all documents, with the SHA-256 of the normalised text."""
    docs = table(spark, sf_dir, "documents")
    digest = F.sha2(ascii_lower(docs.text).cast("binary"), 256)
    return exact_dedup(docs, carry={"text_sha256": digest}).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes that repeat 50 bytes or more of an earlier one."""
    docs = table(spark, sf_dir, "documents")
    cut = remove_repeats(docs, size=50)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut.select(
        "doc_id", (F.octet_length("kept") + removed).cast("long").alias("n_bytes"), removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All whole vectors of 64 components in 16 clusters after 3 rounds."""
    return cluster_vectors(table(spark, sf_dir, "embeddings")).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the words of 20-word windows that also start earlier."""
    return remove_phrases(table(spark, sf_dir, "documents"), size=20, with_text=False).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents rearranged, and the texts rebuilt from the outputs."""
    made = rebuild(fill_in_middle(table(spark, sf_dir, "documents")))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_decontaminate, op2_best_fit_packing, op3_context_tree_lm, op4_ngram_jaccard_join, op5_license_scan,
    op6_toxicity_crf, op7_warc_chunks, op8_token_counts, op9_exact_dedup, op10_suffix_dedup,
    op11_centroid_clustering, op12_phrase_dedup, op13_fill_in_middle)}


def base32(h: str) -> str:
    """DuckDB SQL for the base32 form of a SHA-1 in hex: each 5 hex digits are 4 letters."""
    letter = ("substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
              "1 + ((('0x' || substr({h}, {at}, 5))::int >> {shift}) & 31), 1)")
    return " || ".join(letter.format(h=h, at=i // 4 * 5 + 1, shift=15 - i % 4 * 5) for i in range(32))


def centroid_sql(k: int = 16, rounds: int = 3, dims: int = 64) -> str:
    """DuckDB SQL: all distances in every round, floors of means by exact division."""
    away = (f"list_sum(list_transform(range(1, {dims + 1}), lambda i: (v.xs[i] - c.xs[i]) * (v.xs[i] - c.xs[i])))::bigint")
    parts = [f"""v as materialized (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as xs from embeddings
  where len(embedding) = {dims} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
             f"""c0 as materialized (
  select row_number() over (order by sha256('1:' || vec_id), xs) - 1 as c, xs from v
  qualify c < {k})"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} as materialized (
  select vec_id, v.xs, c.c, {away} as d from v cross join c{r} c
  qualify row_number() over (partition by vec_id order by d, c.c) = 1)""")
        if r < rounds:
            parts.append(f"""c{r + 1} as materialized (
  select c.c, coalesce(m.xs, c.xs) as xs from c{r} c left join (
    select c, list((s - ((s % n) + n) % n) // n order by i)::bigint[] as xs from (
      select c, i, sum(x)::bigint as s, count(*) as n from (
        select c, generate_subscripts(xs, 1) as i, unnest(xs) as x from a{r}) group by c, i)
    group by c) m on c.c = m.c)""")
    return "with " + ",\n".join(parts) + f"""
select a.vec_id, a.c::integer as cluster, a.d as distance,
       (sum(d) over (partition by a.c))::bigint as cluster_inertia, (sum(d) over ())::bigint as inertia,
       sha256(array_to_string(c.xs, ',')) as centroid_sha256
from a{rounds} a join c{rounds} c on a.c = c.c"""


ORACLES = {
    "op11_centroid_clustering": centroid_sql(),
    "op12_phrase_dedup": r"""
with d as materialized (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
p as (select doc_id, w, unnest(range(1, len(w) - 18)) as i from d),
t as (select doc_id, i, row_number() over (partition by array_to_string(w[i:i + 19], ' ') order by doc_id, i) > 1 as again
      from p),
u as (select doc_id, generate_subscripts(w, 1) as i, unnest(w) as word from d),
g as (select u.doc_id, u.i, word,
             max(coalesce(again, false)::int) over (partition by u.doc_id order by u.i rows between 19 preceding and current row) as gone
      from u left join t on u.doc_id = t.doc_id and u.i = t.i),
k as (select doc_id, sum(gone) as n_removed, string_agg(word, ' ' order by i) filter (where gone = 0) as kept
      from g group by doc_id)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed,
       sha256(coalesce(kept, '')) as kept_sha256
from d left join k on d.doc_id = k.doc_id""",
    "op13_fill_in_middle": r"""
with d as (
  select doc_id, coalesce(text, '') as text, sha256('42:' || doc_id) as h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as t
  from documents),
c as (
  select doc_id, text, t, len(t)::bigint as n,
         ('0x' || h[1:8])::bigint % (len(t) + 1) as a, ('0x' || h[9:16])::bigint % (len(t) + 1) as b,
         case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>')
                or ('0x' || h[17:24])::bigint % 100 >= 50 then 'plain'
              when ('0x' || h[25:32])::bigint % 100 < 80 then 'spm' else 'psm' end as form
  from d),
s as (
  select doc_id, text, n, form, array_to_string(t[1:least(a, b)], '') as pre,
         array_to_string(t[least(a, b) + 1:greatest(a, b)], '') as mid, array_to_string(t[greatest(a, b) + 1:n], '') as suf
  from c)
select doc_id, n, form,
       case when form <> 'plain' then length(pre) end as prefix_chars,
       case when form <> 'plain' then length(mid) end as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid
              else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256,
       sha256(text) as restored_sha256
from s""",
    "op7_warc_chunks": f"""
with p as (
  select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes,
         sha1(coalesce(html, '')) as h
  from pages),
d as (
  select page_id, payload_bytes,
         {base32('h')} as payload_digest,
         max(page_id) over (partition by h) as best
  from p)
select page_id, payload_bytes, payload_digest,
       case when page_id = best then 'response' else 'revisit' end as record_type,
       case when page_id <> best then best end as refers_to
from d""",
    "op9_exact_dedup": f"""
with d as (
  select doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') as t from documents)
select doc_id,
       max(doc_id) over (partition by t) as keep_id,
       count(*) over (partition by t) as group_size,
       doc_id = max(doc_id) over (partition by t) as kept,
       sha256(t) as text_sha256
from d""",
}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
