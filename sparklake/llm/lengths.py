"""Token counts from an exact histogram of encoded lengths.

Documents are encoded (the merge replay of ``bpe``), counted by length, and suffix sums over the
histogram answer, for every context limit: how many documents and tokens there are beyond it,
how many tokens remain when each document is truncated to it, and which share fits in it.

The histogram has one row a length, however many documents there are. Its suffix sums are taken
in two levels: blocks of lengths, whose sums are few, and within each block.

Cases: a null or empty text has length 0, which is a row like any other; repeated rows count as
documents of their own; an empty table gives an empty histogram.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparklake.llm import bpe
from sparklake.llm.arrays import stored

BLOCK = 1024


def histogram(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """(n_tokens, n_docs) for each length that occurs."""
    lengths = bpe.encode(docs.select(text), path, pattern, text, lengths_only=True)
    return lengths.groupBy(F.col("made").alias("n_tokens")).agg(F.count("*").alias("n_docs"))


def suffix_sums(counts: DataFrame) -> DataFrame:
    """For each length as a context limit:

    ``docs_over`` and ``tokens_over`` (documents longer than the limit, and their tokens),
    ``truncated_tokens`` (the total with each document cut to the limit), ``total_tokens``, and
    ``share_within`` (documents of at most this length: the histogram's quantiles).
    """
    rows = counts.withColumn("block", F.floor(F.col("n_tokens") / BLOCK)).withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    later = W.orderBy(F.col("block").desc()).rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("d").over(later), F.lit(0)).alias("d_later"),
        F.coalesce(F.sum("t").over(later), F.lit(0)).alias("t_later"),
        F.sum("d").over(W.partitionBy()).alias("all_docs"),
        F.sum("t").over(W.partitionBy()).alias("total_tokens"),
    )
    after = W.partitionBy("block").orderBy(F.col("n_tokens").desc()).rowsBetween(W.unboundedPreceding, -1)
    over = rows.join(blocks, "block").select(
        "n_tokens",
        "n_docs",
        (F.coalesce(F.sum("n_docs").over(after), F.lit(0)) + F.col("d_later")).alias("docs_over"),
        (F.coalesce(F.sum("tokens").over(after), F.lit(0)) + F.col("t_later")).alias("tokens_over"),
        "all_docs",
        "total_tokens",
    )
    return over.select(
        "n_tokens",
        "n_docs",
        "docs_over",
        "tokens_over",
        (F.col("total_tokens") - F.col("tokens_over") + F.col("docs_over") * F.col("n_tokens")).alias("truncated_tokens"),
        "total_tokens",
        ((F.col("all_docs") - F.col("docs_over")) / F.col("all_docs")).alias("share_within"),
    )


def truncated_total(counts: DataFrame, limit: int) -> DataFrame:
    """One row: the total tokens with each document cut to any limit, occurring or not."""
    return counts.agg(F.coalesce(F.sum(F.least("n_tokens", F.lit(limit)) * F.col("n_docs")), F.lit(0)).alias("truncated_tokens"))


def quantile(sums: DataFrame, share: float) -> DataFrame:
    """One row: the smallest length that at least this share of the documents fits in."""
    return sums.where(F.col("share_within") >= share).agg(F.min("n_tokens").alias("n_tokens"))


def op6(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """The registered query: suffix sums for every length, of a histogram that is made once."""
    return suffix_sums(stored(histogram(docs, path, pattern), "length-histogram"))
