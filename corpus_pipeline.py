"""Corpus pipeline: language ID, near duplicates, repeated passages, benchmark leaks, source mix.

``STAGES`` are (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, written as Parquet and read again as the next one's docs.  All but the
last return the columns of ``documents``:

* language_id    documents without letters go, and those of ENOUGH_GRAMS or more letter trigrams that
                 no mixture of the learned languages explains better than chance;
* ngram_jaccard  of every group of near duplicates the smallest doc_id stays;
* suffix_dedup   bytes covered by strings of 200 bytes that also start elsewhere are
                 cut from the texts (n_chars follows); every document stays;
* decontaminate  documents holding a passage like a benchmark item go;
* source_mix     the words that the mix takes of each document, those with any.

Nulls, empty and very long texts, repeated rows and empty tables are handled as the
operators' docstrings say; rows without doc_id pass the near-duplicate stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import bounded_batches, read, save
from ledgerlens.llm.decontaminate import remove_contaminated
from ledgerlens.llm.language import UNKNOWN, held_out, identify, train
from ledgerlens.llm.mixing import mix_sources
from ledgerlens.llm.ngram_join import keep_one
from ledgerlens.llm.suffix_dedup import remove_repeats

ENOUGH_GRAMS = 30      # shorter texts say too little to be rejected
ORACLE_SQL = None      # language models, suffix order and SimHash have no SQL form; see tests/llm/test_pipeline.py


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    model = train(docs.where(F.col("doc_id").isNotNull() & ~held_out("doc_id")))
    found = identify(docs, model, prefix="_found_")
    known = (F.col("_found_lang_pred") != UNKNOWN) & ((F.col("_found_n_grams") < ENOUGH_GRAMS) | (F.col("_found_fit") >= 0))
    return found.where(known).select(*docs.columns)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return keep_one(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    out = remove_repeats(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_sources(docs).where("taken > 0")


STAGES = [("language_id", language_id), ("ngram_jaccard", ngram_jaccard), ("suffix_dedup", suffix_dedup),
          ("decontaminate", decontaminate), ("source_mix", source_mix)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), name)
    return docs
