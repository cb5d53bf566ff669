"""Training-data pipeline over ``documents``: five stages, each one of the operators of ``panewise.llm``.

1. ``language_id``      documents without letters, or unlike every learnt language, go
2. ``line_dedup``       repeated lines go, the earliest stays; documents that lose all their lines go
3. ``ngram_jaccard``    one document (the smallest id) of each group of near duplicates stays
4. ``decontamination``  documents that overlap a benchmark item go
5. ``byte_bpe``         token count and digests of ids and decoded bytes of what is left

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which
is written as Parquet and read back as the next one's docs. All but the last return the columns of their input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panewise.llm import bpe, decontam, langid, linedup, ngramjoin
from panewise.llm.common import written

RANKS = "byte_bpe_50k.tiktoken"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled rows of ``docs``; texts that the models reject go."""
    model = langid.fit(docs)
    others = [c for c in docs.columns if c != "text"]
    packed = docs.select(F.struct(*others).alias("row"), "text") if others else docs  # the other columns travel as one, whatever their names
    kept = langid.predict(packed, model, keep=("row", "text") if others else ("text",)).filter("accepted")
    return kept.select(*[F.col(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated lines; ``n_chars`` follows the text."""
    out = linedup.dedup_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast(out.schema["n_chars"].dataType)) if "n_chars" in out.columns else out


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document whose id names its group; of rows that repeat an id and a text, one."""
    groups = ngramjoin.near_duplicates(docs)
    copies = groups.filter("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.join(copies, "doc_id", "left_anti").select(*docs.columns)
    ids = docs.agg(F.count("doc_id").alias("n"), F.count_distinct("doc_id").alias("d")).first()
    if ids["n"] > ids["d"]:
        kept = kept.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"]).union(kept.filter("doc_id IS NULL"))
    return kept


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.decontaminate(docs, benchmark).select(*docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, keep=("doc_id", "lang", "source"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

#: Language models have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
