"""The corpus pipeline: stages over documents, each written as Parquet and reread by the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.llm import decontaminate, exact_dedup, lang_id, ngram_join, packing
from weftlink.llm.common import Scratch, drop_texts, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Documents go whose n-grams are less like those of the language found than this: 1 is usual, 0 is what was never seen.
LEAST_FIT = 0.5


def _texts(docs: DataFrame) -> DataFrame:
    """The texts and their digests: all that a judgement of texts needs."""
    return docs.select(F.sha2(F.coalesce("text", F.lit("")), 256).alias("__sha"), F.col("text").alias("__text"))


def reject_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled rows teach stay; those without a letter, null texts too, go.

    Without labelled rows all stay.
    """
    names, matrix = lang_id.fit(docs)
    if not names:
        return docs
    found = lang_id.predict(_texts(docs), names, matrix, "__text")
    return drop_texts(docs, found.where((F.col("lang_pred") == "und") | (F.col("fit") < LEAST_FIT)), "text", Scratch(spark))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text only the one with the largest id stays."""
    return exact_dedup.deduplicate(docs)


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of similar documents the one with the smallest id stays."""
    return ngram_join.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item stay; null and empty texts hold none."""
    found = decontaminate.find_items(_texts(docs), table(spark, sf_dir, "benchmark"), "__text", out="__leaks")
    return drop_texts(docs, found.where(F.size("__leaks") > 0), "text", Scratch(spark))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents left in sequences of at most 2048 ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language id", reject_language),
    ("exact dedup", drop_copies),
    ("n-gram jaccard join", drop_similar),
    ("benchmark decontamination", drop_leaks),
    ("best-fit packing", pack_documents),
]

#: Language identification, similarity by MinHash and tokenization are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again.

    An empty table passes through; repeated rows, null ids and columns of any name are as each stage says.
    """
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage{k}")
        if k:
            scratch.drop(f"stage{k - 1}")
    return docs
