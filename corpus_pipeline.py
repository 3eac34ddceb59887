"""A corpus run through five operators, each stage written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import exact_dedup, language, mixing, packing, simhash
from tidemark.llm.common import crc_mod, read, settle, whole_row


LEAST_FIT = -6.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labels name; those without letters go, and those whose words fit no such language."""
    model = language.learn(docs, crc_mod(F.col("doc_id"), 4) != 2)
    told = language.identify(docs.select(whole_row(docs).alias("row"), "text"), model)
    return told.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("fit") >= LEAST_FIT)).select("row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.keep(docs, crc_mod(F.col("doc_id"), 2) == 0)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose five-word shingles have a similarity of 0.8 or more the smallest id stays."""
    return simhash.near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks for."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of the permitted lengths with the documents and words they hold."""
    return packing.sequences(docs, packing.plan(docs))


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack),
]

#: Rounded copies, fitted models and packed sequences have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; every stage is written to the shared folder as Parquet."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
