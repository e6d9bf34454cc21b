"""The corpus pipeline: documents in, encoded training mix out.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept,
and returns a DataFrame; all but the last return the columns of ``documents``.
``run`` writes what a stage returns to the shared scratch folder and reads it
again for the next, so a lost executor costs no more than one stage; what no later
stage reads is deleted.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, line_dedup, mixing, quality_net, resemblance
from tidemark.llm.common import materialise, table
from tidemark.scratch import discard


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; it learns from the labels of this stage's documents."""
    net = quality_net.train(docs, table(spark, sf_dir, "labels"))
    out = "score" + "_" * max(map(len, docs.columns))  # longer than any name there is
    return quality_net.score(docs, net, out=out).where(F.col(out) >= 0.5).drop(out)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that at least three documents share stay in one of them; ``n_chars`` follows the text."""
    return line_dedup.dedup_lines(docs).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, at least 0.8 alike in shingles of five words, stays: the one with the smallest id."""
    return resemblance.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, or up to three times."""
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and again decoded text of each row."""
    return byte_bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality classifier", quality), ("line dedup", lines), ("near duplicates", near_duplicates), ("mixing", mix), ("byte-level BPE", encode)]

#: A trained classifier and a hashed sample have no SQL; tests/llm/test_pipeline.py holds the stages against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, materialise(stage(spark, docs, sf_dir), f"stage{k}")
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
