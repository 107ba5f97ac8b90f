"""From raw documents to packed training sequences, in five stages that each read what the one before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyforge.llm import decontamination, line_dedup, ngram_join, packing, toxicity
from plyforge.llm.queries import table, tokenizer_path
from plyforge.sources.paths import stored
from plyforge.sources.shipping import ship_library


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on this stage's documents, does not call toxic."""
    ship_library(spark)
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the boilerplate lines of their source; n_chars counts what is left."""
    ship_library(spark)
    cleaned = line_dedup.drop_boilerplate(docs).select(*docs.columns)
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of documents whose runs of five words have a Jaccard similarity of 0.8 or more."""
    ship_library(spark)
    return ngram_join.one_of_each(docs, NEAR_WORDS, NEAR_PERCENT)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ship_library(spark)
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as pieces of packed sequences."""
    ship_library(spark)
    return packing.pack_documents(docs, tokenizer_path())


#: Near copies share four fifths of their runs of five words, or more. op7_ngram_join has thresholds of its own.
NEAR_WORDS, NEAR_PERCENT = 5, 80

STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("ngram_join", drop_near_copies),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

#: The classifier's decisions cannot be expressed in SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of `documents`; what each stage keeps is written to shared storage and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
