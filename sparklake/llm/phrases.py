"""Phrase collocation mining by Rabin-Karp fingerprints.

Texts, lower-cased (A-Z), are split into pieces at marks and line breaks and pieces into words. Prefix
polynomials over the words' hashes give the fingerprint of every run of words in one pass of
numpy; language and length are mixed in. Phrases are counted level by level: a run of words is
shuffled only if the shorter runs it is made of may be frequent, told by a bit filter that is
sized by their number. Tasks count their own rows before the shuffle.

A last pass takes the fingerprints that are frequent, with a pointer to their first document, compares
their occurrences word by word with the text, and writes out those phrases alone; they are
counted by text, so a collision of fingerprints, of one slice or of two, changes no result: it
only adds a candidate.

A cut of a phrase into a first part and the rest scores floor(1000 * a * n / (l * r)); a phrase
has the score of its lowest cut. Phrases inside a longer one that is as frequent are dropped.

Cases: a null or empty text has no words; a null language is ``und``; a null id points nowhere; each
of repeated rows counts; equal scores go by count, then by phrase in byte order; columns beside
those named are not read; an empty table gives an empty result. Counts take 64 bits, products
38 decimal digits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparklake.llm import bits
from sparklake.llm.arrays import Words, hashes, mapped, mix, slices, stored

MOST_WORDS = 5
SLICE_BYTES = 4 << 20
HELD = 1 << 21  # distinct fingerprints that a task counts before it hands them on
ROWS = 1 << 16  # rows of a batch that leaves a task
UNKNOWN = "und"
NOWHERE = (1 << 63) - 1

MARK = np.zeros(256, bool)
MARK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
WORD = ~MARK
WORD[[0x20, 0x09]] = False

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


class Runs:
    """The words of a batch and the fingerprints of their runs."""

    def __init__(self, batch: pa.RecordBatch, width: int):
        self.words = words = Words(batch.column("text"), WORD)
        self.text = words.text_of
        # words of one piece have one number: marks before them, and texts
        self.piece = np.cumsum(MARK[words.data])[words.start] + self.text if len(words) else self.text
        langs = batch.column("lang").dictionary_encode()
        self.langs, self.lang = langs.dictionary.to_pylist(), langs.indices.to_numpy()
        names = [x.encode() for x in self.langs]
        ends = np.cumsum([len(x) for x in names], dtype=np.int64)
        seeds = hashes(np.frombuffer(b"".join(names), np.uint8), np.concatenate([[0], ends[:-1]]).astype(np.int64), ends)
        self.seed = seeds[self.lang][self.text] if len(words) else np.empty(0, np.uint64)
        self.mask = np.uint64((1 << width) - 1)
        with np.errstate(over="ignore"):
            power, back = np.full(len(words) + 1, BASE), np.full(len(words) + 1, INVERSE)
            power[0] = back[0] = 1
            self.back = np.cumprod(back)
            self.prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words.hash * np.cumprod(power)[:-1])])

    def keys(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The fingerprint of the run of ``n`` words at each word, and whether it is within a piece."""
        m = max(0, len(self.words) - n + 1)
        with np.errstate(over="ignore"):
            own = (self.prefix[n : n + m] - self.prefix[:m]) * self.back[:m]
            key = mix(own ^ mix(self.seed[:m] + np.uint64(n))) & self.mask
        return key, self.piece[:m] == self.piece[n - 1 : n - 1 + m]

    def numbers(self) -> np.ndarray:
        """A number for each word, the same for words of the same bytes alone."""
        data, start = self.words.data, self.words.start
        size = self.words.end - start
        _, first, own = np.unique(self.words.hash, return_index=True, return_inverse=True)
        twin = start[first[own]]
        differ = size != size[first[own]]
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
        at = np.flatnonzero(~differ)
        for k in range(0, int(size.max(initial=0)), 8):
            at = at[size[at] > k]
            left = np.uint64(64) - np.minimum(size[at] - k, 8).astype(np.uint64) * np.uint64(8)
            wrong = ((eight[start[at] + k] ^ eight[twin[at] + k]) << left) != 0
            differ[at[wrong]] = True
            at = at[~wrong]
        seen: dict[bytes, int] = {}
        for i in np.flatnonzero(differ).tolist():
            own[i] = len(first) + seen.setdefault(data[start[i] : self.words.end[i]].tobytes(), len(seen))
        return own

    def phrases(self, at: np.ndarray, n: int) -> pa.Array:
        """The words of the runs of ``n`` words at these places, with one space between them."""
        words = (at[:, None] + np.arange(n)).ravel()
        start, size = self.words.start[words], (self.words.end - self.words.start)[words]
        size[np.arange(len(size)) % n < n - 1] += 1  # with the byte after the word, which separates it from the next
        ends = np.cumsum(size)
        where = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)
        data = np.where(WORD[self.words.data[where]], self.words.data[where], np.uint8(0x20))
        offsets = np.concatenate([[0], ends[n - 1 :: n]]).astype(np.int32)
        return pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data))


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else [])
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _count(sizes: list[int], shorter: int, known, width: int):
    """Counts of the fingerprints of runs of these lengths whose parts of ``shorter`` words may be frequent."""

    def batches_of(keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(keys), ROWS):
            part = keys[k : k + ROWS].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.nulls(len(part), pa.string()), pa.array(part), pa.array(counts[k : k + ROWS])], ["lang", "key", "f"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        totals: dict[str, int] = {}
        size = 0
        for batch in slices(batches, "text", SLICE_BYTES):
            runs = Runs(batch, width)
            if shorter:
                part, within = runs.keys(shorter)
                may = within & bits.probe(known.value, part)
            else:
                for lang, n in zip(runs.langs, np.bincount(runs.lang[runs.text], minlength=len(runs.langs)).tolist(), strict=True):
                    totals[lang] = totals.get(lang, 0) + n
            for n in sizes:
                key, good = runs.keys(n)
                for k in range(n - shorter + 1) if shorter else ():
                    good = good & may[k : k + len(key)]
                held.append(np.unique(key[good], return_counts=True))
                size += len(held[-1][0])
            if size >= HELD:
                held = [_merged(held)]
                size = len(held[0][0])
            if size >= HELD // 2 and len(held) == 1:  # little was merged: hand it on
                yield from batches_of(*held[0])
                held, size = [], 0
        if held:
            yield from batches_of(*_merged(held))
        if totals:
            none = pa.nulls(len(totals), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(totals, pa.string()), none, pa.array(totals.values(), pa.int64())], ["lang", "key", "f"])

    return work


def _write_out(known: list, width: int):
    """The phrases behind frequent fingerprints, with counts and a pointer, compared with the text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            runs, number = Runs(batch, width), None
            ids = batch.column("doc").fill_null(NOWHERE).to_numpy(zero_copy_only=False)
            for n, filled in enumerate(known, 1):
                key, good = runs.keys(n)
                at = np.flatnonzero(good & bits.probe(filled.value, key))
                if not len(at):
                    continue
                number = runs.numbers() if number is None else number
                _, first, own = np.unique(key[at], return_index=True, return_inverse=True)
                same = runs.lang[runs.text[at]] == runs.lang[runs.text[at[first[own]]]]
                for k in range(n):
                    same &= number[at + k] == number[at[first[own]] + k]
                doc = ids[runs.text[at]]
                least = np.full(len(first), NOWHERE)
                np.minimum.at(least, own[same], doc[same])
                # each occurrence that differs from the first of its fingerprint is a row of its own
                places = np.concatenate([at[first], at[~same]])
                counts = np.concatenate([np.bincount(own[same], minlength=len(first)), np.ones(int((~same).sum()), np.int64)])
                least = np.concatenate([least, doc[~same]])
                langs = pa.array(runs.langs, pa.string()).take(pa.array(runs.lang[runs.text[places]]))
                for k in range(0, len(places), ROWS):
                    part = slice(k, k + ROWS)
                    size = pa.array(np.full(len(places[part]), n, np.int32))
                    pointer = pa.array(least[part], mask=least[part] == NOWHERE)
                    columns = [langs[part], runs.phrases(places[part], n), size, pa.array(counts[part]), pointer]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "size", "f", "doc"])

    return work


def frequent(docs: DataFrame, least: int, text: str, lang: str, doc_id: str, width: int = 64) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f, doc) of all phrases of one to five words that occur at least
    ``least`` times in their language, and (lang, n), the words of each language.

    ``doc`` is the least id of a document that holds the phrase. ``width`` is the number of bits of a fingerprint.
    """
    context = docs.sparkSession.sparkContext
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc"),
        F.coalesce(F.col(f"`{lang}`"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    known, totals, shorter = {}, None, 0
    for sizes in ([1], [2], [3], [4, 5]):
        counted = mapped(rows, _count(sizes, shorter, known.get(shorter), width), "lang string, key bigint, f bigint")
        sums = counted.groupBy("lang", "key").agg(F.sum("f").alias("f"))
        level = stored(sums.where((F.col("f") >= least) | F.col("key").isNull()), "phrase-keys")
        keys = level.where("key is not null")
        filled = context.broadcast(bits.build(keys, "key", bits.size_for(keys.count())))
        known |= dict.fromkeys(sizes, filled)
        totals = level.where("key is null").select("lang", F.col("f").alias("n")) if totals is None else totals
        shorter = sizes[0]
    made = mapped(rows, _write_out([known[k] for k in range(1, MOST_WORDS + 1)], width), "lang string, phrase string, size int, f bigint, doc bigint")
    exact = made.groupBy("lang", "phrase").agg(F.first("size").alias("size"), F.sum("f").alias("f"), F.min("doc").alias("doc"))
    return stored(exact.where(F.col("f") >= least), "phrases"), totals


def _joined(words: Column, start, length) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score, doc) of the phrases of two words and more.

    All products and quotients are exact: counts have up to 19 digits, decimals hold 38.
    """
    word = F.split("phrase", " ")
    long = phrases.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), "doc", word.alias("w"))
    cuts = long.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "doc", "k",
        _joined(F.col("w"), F.lit(1), F.col("k")).alias("one"),
        _joined(F.col("w"), F.col("k") + 1, F.col("size") - F.col("k")).alias("two"),
    )
    part = lambda name, f: phrases.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    cuts = cuts.join(part("one", "l"), ["lang", "one"]).join(part("two", "r"), ["lang", "two"]).join(totals, "lang")
    exact = "cast(1000 as decimal(4)) * cast(a as decimal(19)) * cast(n as decimal(15)) div (cast(l as decimal(19)) * cast(r as decimal(19)))"
    best = cuts.withColumn("score", F.expr(exact)).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r", "a", "n", "doc")).alias("best")
    )
    return best.select("lang", "phrase", *[f"best.{c}" for c in ("a", "l", "r", "n", "score", "doc")])


def outermost(phrases: DataFrame) -> DataFrame:
    """(lang, phrase) of two words and more that no longer phrase of the same count holds."""
    long = phrases.where("size > 2").select("lang", "size", "f", F.split("phrase", " ").alias("w"))
    sized = long.select("*", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("length"))
    inside = sized.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)).alias("at"))
    inside = inside.select("lang", _joined(F.col("w"), F.col("at"), F.col("length")).alias("phrase"), "f")
    most = inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    own = phrases.where("size > 1").join(most, ["lang", "phrase"], "left")
    return own.where("longer is null or longer < f").select("lang", "phrase")


def collocations(
    docs: DataFrame, least: int = 100, top: int = 2000, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", width: int = 64
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, doc): each language's ``top`` phrases."""
    phrases, totals = frequent(docs, least, text, lang, doc_id, width)
    rows = scored(phrases, totals).join(outermost(phrases), ["lang", "phrase"], "left_semi")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # the first of each of 64 parts of a language, then the first of those
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    ranked = rows.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    ranked = ranked.where(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score", "doc")


def op11(docs: DataFrame) -> DataFrame:
    """The registered query: phrases that occur a hundred times, two thousand a language."""
    return collocations(docs.select("doc_id", "lang", "text")).withColumnRenamed("doc", "first_doc")
