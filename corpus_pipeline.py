"""A corpus pipeline in stages; each stage's rows are written and read again for the next.

1. ``toxicity`` removes documents that score as toxic, 2. ``line_dedup`` drops lines that at least
ten different texts hold (copies of a text count once, as the next stage leaves one of them), 3. ``near_duplicates`` keeps one document, the one with the least id, of each
component of texts whose five-word shingles reach a Jaccard similarity of 0.8, 4.
``decontamination`` removes documents that share too much with the benchmark, and 5. ``encode``
returns the token ids of what is left, checked by decoding them.

Nulls, empty texts and empty tables go through each stage as its operator defines them: they
score as not toxic, keep their one empty line, link with nothing, are not contaminated and have
no tokens. A document that lost all of its lines stays, with an empty text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklake.llm import bpe, decontaminate, lines, ngram_join, toxicity
from sparklake.llm.arrays import stored

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

#: The classifier of the first stage is trained, which SQL can't express; the tests hold the
#: stages against brute-force versions instead.
ORACLE_SQL = None


def _measured(docs: DataFrame) -> DataFrame:
    """The columns of documents, with the length of a text that a stage has changed."""
    return docs.withColumn("n_chars", F.char_length(F.coalesce("text", F.lit(""))).cast("bigint"))


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_frequent_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(lines.dedup(docs, threshold=10, copies=False))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.representatives(docs, n=5, num=80, den=100)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encoded_and_checked(docs, RANKS, public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", remove_toxic),
    ("line_dedup", drop_frequent_lines),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("decontamination", remove_contaminated),
    ("encode", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each from what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
