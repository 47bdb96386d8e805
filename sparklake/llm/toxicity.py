"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over the words and word beginnings of a text learns from confirmed toxic examples and unlabelled
text. The risk is that of the positives, weighted by the class prior, plus that of the unlabelled
as negatives less the share that the prior says is positive; where that difference falls below
zero, the step goes against it, which keeps the estimate from overfitting.

Which features tell is decided by their rates in the confirmed texts and in all documents, counted
on the cluster. The weights are fitted with numpy on a bounded sample: the positives and the
unlabelled texts whose ids hash lowest, at most POSITIVES and UNLABELLED of them. Every document
is scored.

Cases: a null or empty text is scored by the bias alone; repeated rows score alike; labels that
are null confirm nothing; a null id hashes as the empty text; other columns of both tables are
never inputs and pass through ``score`` whatever their names are; without any confirmed example
every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparklake.llm.arrays import ALNUM, Words, hashes, mapped, slices, stored, with_row

BITS = 24  # words are hashed to so many bits; few of the values get a weight
PREFIXES = (4, 5, 6)  # bytes of word beginnings, for stems that take many endings
PREFIX_SALT = np.uint64(0x9E3779B97F4A7C15)
LEAST_TEXTS, LEAST_Z = 4, 4.0  # texts that must hold a feature; standard deviations it must tell
POSITIVES, UNLABELLED = 4000, 12000
EPOCHS, RATE = 200, 0.1
RIDGE = 0.2  # penalty on the weights, shared among the positives


def _keys(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The number of the text, and the hashed word or word beginning, of every occurrence."""
    words = Words(column, ALNUM)
    shift, of = np.uint64(64 - BITS), words.text_of
    texts, keys = [of], [(words.hash >> shift).astype(np.int64)]
    for size in PREFIXES:
        longer = words.end - words.start > size
        start = words.start[longer]
        texts.append(of[longer])
        keys.append((hashes(words.data, start, start + size) * PREFIX_SALT >> shift).astype(np.int64))
    return np.concatenate(texts), np.concatenate(keys)


def word_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashed words and word beginnings of each text, and where each text's begin."""
    text, key = _keys(column)
    both = np.unique(text << BITS | key)
    return both & ((1 << BITS) - 1), np.searchsorted(both >> BITS, np.arange(len(column) + 1))


class Linear:
    """Weights of the features that tell, and a bias."""

    def __init__(self, features: np.ndarray, weights: np.ndarray, bias: float):
        self.features, self.weights, self.bias = features, weights, bias

    def table(self) -> np.ndarray:
        """The place of each hashed feature in ``features``, -1 for the others."""
        place = np.full(1 << BITS, -1, np.int32)
        place[self.features] = np.arange(len(self.features))
        return place

    def margins(self, column: pa.Array, table: np.ndarray) -> np.ndarray:
        text, key = _keys(column)
        place = table[key]
        told = place >= 0
        both = np.unique(text[told] * max(1, len(self.features)) + place[told])
        text, place = both // max(1, len(self.features)), both % max(1, len(self.features))
        return np.bincount(text, weights=self.weights[place], minlength=len(column)) + self.bias


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def train(features: np.ndarray, index: np.ndarray, first: np.ndarray, positive: np.ndarray, prior: float) -> Linear:
    """Minimise the non-negative risk with logistic loss by Adam over the whole sample.

    ``index`` has the places in ``features`` of what each text holds, ``first`` where each
    text's begin.
    """
    rows, size = len(first) - 1, len(features)
    of = np.repeat(np.arange(rows), np.diff(first))
    n_p, n_u = max(1, int(positive.sum())), max(1, int((~positive).sum()))
    w, moment, spread = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    w[-1] = np.log(prior / (1 - prior))
    ridge = RIDGE / n_p
    for step in range(1, EPOCHS + 1):
        margin = np.bincount(of, weights=w[index], minlength=rows) + w[-1]
        p = _sigmoid(margin)
        # loss as a negative is log(1 + e^m), with derivative p; as a positive log(1 + e^-m), p - 1
        as_negative = np.logaddexp(0, margin)
        rest = as_negative[~positive].mean() - prior * as_negative[positive].mean()
        slope = np.where(positive, -prior * p / n_p, p / n_u)
        slope = -slope if rest < 0 else slope + np.where(positive, prior * (p - 1) / n_p, 0)
        g = np.append(np.bincount(index, weights=slope[of], minlength=size) + ridge * w[:-1], slope.sum())
        moment = 0.9 * moment + 0.1 * g
        spread = 0.999 * spread + 0.001 * g * g
        w -= RATE * (moment / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-8)
    return Linear(features, w[:-1], float(w[-1]))


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Whether labels of this id are kept for testing: crc32 of the id as text, modulo 5, is 0."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        index, first = word_features(batch.column("text"))
        made = [index[a:b].astype(np.int32).tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("positive"), pa.array(made, pa.binary())], ["positive", "words"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of a task hold each feature: one table of 2^BITS counters a task."""
    held = np.zeros(1 << BITS, np.int32)
    for batch in slices(batches, "text"):
        feature, n = np.unique(word_features(batch.column("text"))[0], return_counts=True)
        held[feature] += n.astype(np.int32)
    feature = np.flatnonzero(held).astype(np.int32)
    for a in range(0, len(feature), 1 << 16):
        part = feature[a : a + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(held[part].astype(np.int64))], ["feature", "n"])


def _telling(counts: DataFrame, n_p: int, n_u: int) -> DataFrame:
    """Features whose rates differ between positives and unlabelled by more than chance."""
    held, others = F.col("held"), F.col("others")
    rate = (held + others) / (n_p + n_u)
    deviation = F.sqrt(F.greatest(rate * (1 - rate), F.lit(1e-12)) * (1 / n_p + 1 / n_u))
    apart = F.abs(held / n_p - others / n_u) >= LEAST_Z * deviation
    return counts.where(apart & (held + others >= LEAST_TEXTS)).select("feature")


def _counts(confirmed: DataFrame, everyone: DataFrame) -> DataFrame:
    """For each feature, how many confirmed texts (``held``) and texts of all (``others``) hold it."""
    none = F.lit(0).cast("bigint")
    held = mapped(confirmed.select("text"), _counted, "feature int, n bigint").select("feature", F.col("n").alias("held"), none.alias("others"))
    others = mapped(everyone.select("text"), _counted, "feature int, n bigint").select("feature", none.alias("held"), F.col("n").alias("others"))
    return held.union(others).groupBy("feature").agg(F.sum("held").alias("held"), F.sum("others").alias("others"))


def _kept(features):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = features.value
        for batch in batches:
            words = [np.frombuffer(x.as_buffer(), np.int32) for x in batch.column("words")]
            places = [np.flatnonzero(np.isin(known, x, assume_unique=True)).astype(np.int32).tobytes() for x in words]
            yield pa.RecordBatch.from_arrays([batch.column("positive"), pa.array(places, pa.binary())], ["positive", "words"])

    return work


def fit(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    toxic: str = "toxic",
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
    prior: float | None = None,
) -> Linear | None:
    """Train on a bounded sample; labels of held-out ids are not read.

    Without a given ``prior``, it is the share of toxic ones among the labels for training.
    """
    known = labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{toxic}`").alias("toxic")).where(~held_out("id"))
    if prior is None:
        prior = known.agg(F.avg("toxic")).first()[0]
    if not prior:
        return None
    prior = min(max(prior, 1e-4), 0.9)
    order = [F.xxhash64("id"), F.col("id")]
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    confirmed = known.where("toxic = 1").select("id").distinct().orderBy(*order).limit(positives)
    # unlabelled texts stand for all texts, so a confirmed one may be among them too
    others = rows.select("id").where(~held_out("id")).distinct().orderBy(*order).limit(unlabelled)
    wanted = others.withColumn("positive", F.lit(False)).union(confirmed.withColumn("positive", F.lit(True)))
    # ids are as many as the sample's bounds allow; the texts stay where they are
    wanted = F.broadcast(stored(wanted, "toxicity-ids"))
    sample = mapped(rows.join(wanted, "id").select("positive", "text"), _extract, "positive boolean, words binary")
    sample = stored(sample, "toxicity-sample")
    sizes = dict(sample.groupBy("positive").count().collect())
    if not sizes.get(True):
        return None
    everyone = rows.where(~held_out("id"))
    n_u = everyone.count()
    counts = _telling(_counts(rows.join(wanted.where("positive"), "id"), everyone), sizes[True], max(1, n_u))
    # features that tell, and the sample's texts reduced to them: bounded by the confirmed texts' words
    told = counts.collect()
    features = np.sort(np.array([r[0] for r in told], np.int32))
    reduced = mapped(sample, _kept(docs.sparkSession.sparkContext.broadcast(features)), "positive boolean, words binary")
    found = sorted((r[0], bytes(r[1])) for r in reduced.collect())  # the order of addition must not vary
    places = [np.frombuffer(x, np.int32) for _, x in found]
    first = np.concatenate([[0], np.cumsum([len(x) for x in places])])
    return train(features, np.concatenate(places), first, np.array([x for x, _ in found]), prior)


def _scorer(model):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        linear: Linear | None = model.value
        table = linear.table() if linear is not None else None
        for batch in slices(batches, "text"):
            if linear is None:
                scores = np.zeros(batch.num_rows)
            else:
                scores = _sigmoid(linear.margins(batch.column("text"), table))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(scores, pa.float64())], ["row", "score"])

    return work


def score(docs: DataFrame, model: Linear | None, text: str = "text") -> DataFrame:
    """``row`` (a struct of all columns) and the ``score`` of the text alone, from 0 to 1."""
    df = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    )
    held = docs.sparkSession.sparkContext.broadcast(model)
    return mapped(df, _scorer(held), with_row(df, "score double"))


def clean(docs: DataFrame, labels: DataFrame, text: str = "text", threshold: float = 0.5, **options) -> DataFrame:
    """The documents that score below the threshold, with all their columns."""
    kept = score(docs, fit(docs, labels, text, **options), text).where(F.col("score") < threshold)
    return kept.select("row.*")


def op10(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The registered query."""
    docs = docs.select("doc_id", "text")
    return score(docs, fit(docs, labels)).select(
        "row.doc_id",
        held_out("row.doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
