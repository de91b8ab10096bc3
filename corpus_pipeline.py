"""Documents to packed sequences: language ID, exact and near deduplication, mixing and packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlake.llm import exact_dedup, langid, mixing, packing, simhash
from assetlake.llm.common import free_name
from assetlake.session import cut_lineage, prepare

#: A prediction less likely than this is no language at all.
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a recognised language; texts that are null, without a letter or unlike any language go."""
    prepare(spark)
    model = langid.train(docs.where(langid.learns("doc_id", langid.FOLDS)), "doc_id", "text", "lang")
    marks = ["lang_pred", "score"]
    renamed = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    place = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    told = langid.predict(renamed, model, place["doc_id"], place["text"], [F.col(c) for c in renamed.columns])
    kept = told.where((F.col(marks[0]) != langid.UNKNOWN) & (F.col(marks[1]) >= LEAST_SCORE))
    return kept.select(*[F.col(place[c]).alias(c) for c in docs.columns])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the least id stays."""
    prepare(spark)
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by SimHash fingerprints the one with the least id stays."""
    prepare(spark)
    return simhash.simhash_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix reads them, in training order."""
    prepare(spark)
    position = free_name(docs, "position")
    return mixing.mix(docs).drop(position)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens."""
    prepare(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("simhash_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]
#: The language model, the fingerprints and the tokenizer have no SQL form; the tests hold each stage to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each writes its rows to the shared folder for the next one to read."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

