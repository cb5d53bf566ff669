"""Registered queries of this package: one per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panewise.llm import bpe, decontam, embdup, hardneg, html, langid, linedup, ngramjoin, pii, runs, substring, tokenfile, warczip
from panewise.llm.common import shared_path

RANKS = "byte_bpe_50k.tiktoken"
WORD_VOCAB = "word_bpe_49k.json"
END_ID = 1
#: Key of the registered query only; a job passes its own.
PII_KEY = "registered-query"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii_surrogates(spark, sf):
    """doc_id, text with surrogates, n_entities of every document."""
    return pii.replace_entities(table(spark, sf, "documents").select("doc_id", "text"), PII_KEY)


def op2_byte_bpe(spark, sf):
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    return bpe.round_trip(table(spark, sf, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op3_language_id(spark, sf):
    """doc_id, held_out, lang_pred, score; learnt from the rows that are not held out."""
    docs = table(spark, sf, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = langid.fit(docs.filter(~F.coalesce(held_out, F.lit(False))))
    out = langid.predict(docs, model)
    return out.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score", "cross_entropy", "accepted")


def op4_substring_dedup(spark, sf):
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    return substring.remove_repeats(table(spark, sf, "documents"), with_text=False)


def op5_token_file(spark, sf):
    """doc_id, start, n_tokens, ids_crc32, read back from the written token files."""
    path = shared_path(spark, "token-file")
    tokenfile.write(table(spark, sf, "documents"), path, public_tokenizers.path(WORD_VOCAB), END_ID)
    return tokenfile.digests(tokenfile.read(spark, path))


def op6_decontamination(spark, sf):
    """One row per document and benchmark item that overlap."""
    return decontam.overlaps(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op7_embedding_dedup(spark, sf):
    """vec_id, n_links, component_id, kept of every vector."""
    return embdup.near_duplicates(table(spark, sf, "embeddings"))


def op8_html_extraction(spark, sf):
    """page_id, url, text, n_chars, n_template of every page."""
    return html.extract(table(spark, sf, "pages"))


def op9_ngram_jaccard(spark, sf):
    """doc_id, n_shingles, component_id of every document."""
    return ngramjoin.near_duplicates(table(spark, sf, "documents"))


def op10_line_dedup(spark, sf):
    """doc_id, line_no, first_doc_id, first_line_no, edits of every removed line."""
    return linedup.repeated_lines(table(spark, sf, "documents")).drop("text_tag")


def planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text; a tenth of the ids has words repeated with a period, from a word on up to the text's end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    docs = docs.select("doc_id", "text", (h % 10 == 0).alias("_chosen"), F.floor(h / 10).alias("_g"))
    words = F.when(F.col("_chosen"), F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    docs = docs.withColumn("_words", words).withColumn("_n", F.size("_words"))
    docs = docs.withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")).cast("int"))
    docs = docs.withColumn("_p", (F.floor((F.col("_n") - F.col("_a")) / (F.col("_g") % 8 + 3)) + 1).cast("int"))
    turns = F.ceil((F.col("_n") - F.col("_a")) / F.col("_p")).cast("int")
    tail = F.flatten(F.array_repeat(F.slice("_words", F.col("_a") + 1, F.col("_p")), turns))
    text = F.concat_ws(" ", F.slice("_words", 1, F.col("_a")), F.slice(tail, 1, F.col("_n") - F.col("_a")))
    return docs.select("doc_id", F.when(F.col("_n") > 0, text).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark, sf):
    """doc_id, n_runs, the longest run, digests of runs and collapsed text of every document."""
    out = runs.periodic_runs(planted_periods(table(spark, sf, "documents")))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    out = out.withColumn("_best", best)
    length, period = -F.col("_best.less"), F.col("_best.period")
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_best.start").alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"), F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def page_of(uri: str) -> Column:
    """The page id in a record id that ``warczip.write`` made."""
    return F.regexp_extract(uri, "^urn:x-page:(-?[0-9]+):", 1).try_cast("long")


def op12_warc_archive(spark, sf):
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, read back from the written packages."""
    path = shared_path(spark, "warc")
    warczip.write(table(spark, sf, "pages"), path)
    out = warczip.read(spark, path, with_payload=False)
    return out.select(page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_of("refers_to").alias("refers_to"))


OP12_SQL = """
WITH bits AS (
  SELECT page_id, html, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         unhex(sha1(coalesce(html, '')))::BIT::VARCHAR AS b,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
  FROM pages)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(1 + 16 * CAST(substr(b, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(b, 5 * i + 2, 1) AS INT) + 4 * CAST(substr(b, 5 * i + 3, 1) AS INT)
         + 2 * CAST(substr(b, 5 * i + 4, 1) AS INT) + CAST(substr(b, 5 * i + 5, 1) AS INT) AS INT), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM bits"""


def op13_hard_negatives(spark, sf):
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; every hundredth id is an anchor."""
    rows = table(spark, sf, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.hard_negatives(rows.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 100 == 0)


OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same, CAST(list_inner_product(a.e, v.e) AS BIGINT) AS score
  FROM v a JOIN v ON v.vec_id <> a.vec_id
  WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pii_surrogates": op1_pii_surrogates,
        "op2_byte_bpe": op2_byte_bpe,
        "op3_language_id": op3_language_id,
        "op4_substring_dedup": op4_substring_dedup,
        "op5_token_file": op5_token_file,
        "op6_decontamination": op6_decontamination,
        "op7_embedding_dedup": op7_embedding_dedup,
        "op8_html_extraction": op8_html_extraction,
        "op9_ngram_jaccard": op9_ngram_jaccard,
        "op10_line_dedup": op10_line_dedup,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_warc_archive": op12_warc_archive,
        "op13_hard_negatives": op13_hard_negatives,
    }


def oracle_sql() -> dict[str, str]:
    return {"op10_line_dedup": linedup.ORACLE_SQL, "op12_warc_archive": OP12_SQL, "op13_hard_negatives": OP13_SQL}
