"""Corpus pipeline: identify the language, keep good text, keep one of each group of near copies,
remove benchmark text, pack for training.  Every stage calls one operator of ``quarry.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import decontaminate, langid, packing, quality, simhash, toxicity
from quarry.llm.common import id_remainder, table, written
from quarry.session import ship_package

#: A document goes if no language labels this share of its letters (or it has no letter).
LEAST_LANGUAGE = 0.35
#: A document goes if it is less likely than this to be good.
LEAST_QUALITY = 0.5
#: SimHash contract: words of a shingle, bits that may differ.
SHINGLE, MAX_BITS = 4, 4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    model = langid.train(docs.where(id_remainder("doc_id", 3) != 1))
    return langid.keep_identified(docs, model, LEAST_LANGUAGE)


def good_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    sample = toxicity.labelled_texts(docs, table(spark, sf_dir, "labels"), "quality",
                                     id_remainder("doc_id", 4) != 2, quality.SAMPLE)
    return quality.keep_good(docs, quality.train(sample), LEAST_QUALITY)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return simhash.keep_one(docs, SHINGLE, MAX_BITS)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packing.pack(docs)


STAGES = [("language_id", language), ("quality_classifier", good_text), ("simhash_near_dedup", near_dedup),
          ("benchmark_decontamination", no_benchmark), ("best_fit_packing", packed)]

#: Models, XXH64 and the tokenizer have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
