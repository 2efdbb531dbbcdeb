"""A training corpus in five stages: language, near-duplicates, benchmark leaks, source mix, token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns of
``documents``; the last returns a row per document of the token files it has written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm import decontaminate, langid, mixing, simhash, tokens
from threadloom.llm.common import prepare, read, scratch

MIN_SCORE = 0.3  # of the language; four languages at random have 0.25
# The whole chain trains a network, draws a seeded mix and writes files: SQL cannot express it.
ORACLE_SQL = None


def held_out() -> Column:
    """Documents that no language model learns from: crc32 of the id as text, modulo 4, is 2."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose language cannot be told: no text, no letters, or a score below ``MIN_SCORE``."""
    prepare(spark)
    model = langid.fit(docs.filter(~held_out()))
    marked = langid.identify(docs.withColumnsRenamed({c: f"in_{c}" for c in docs.columns if c != "text"}), model)
    kept = marked.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_SCORE))
    return kept.select(*[F.col(c if c == "text" else f"in_{c}").alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: 3-word shingles, 2 bits."""
    return simhash.keep_one(docs=docs, store=scratch(prepare(spark), "keep"), words=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.clean_documents(docs, read(prepare(spark), sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; documents appear as often as they are taken."""
    prepare(spark)
    return mixing.mixed_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed documents as token files; a row per document: doc_id, start, n_tokens, ids_crc32."""
    import public_tokenizers

    path = scratch(prepare(spark), "tokens").path("ids")
    tokens.write_ids(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    return tokens.read_documents(spark, path)


STAGES = [
    ("language_id", language),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("source_mix", source_mix),
    ("token_ids", token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what one stage returns is written and read again by the next."""
    store = scratch(prepare(spark), "pipeline")
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
