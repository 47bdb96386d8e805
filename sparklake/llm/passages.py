"""Substring dedup by unit hashing.

Units are lines and, inside a line, segments whose borders its own words set: a segment begins
at a word whose hash is the least among the five words to either side in its line. So two copies of a
passage are cut alike, whatever text they are glued to, but for the words next to their ends. A
segment has six words at least; what is shorter, at the ends of a line, is no unit. A line of one
segment is one unit, the line.

Units are normalised (A-Z in lower case, white space collapsed), and their 128-bit digests are
grouped over the corpus. The earliest ranked occurrence stays: the one in the document with the
smallest id, and there the first. Every later one is removed, a line with its line break; ranges
that touch become one. Removed ranges keep their offsets in the original text.

A first pass finds the digests that more than one document holds. A second one gives, through a
bit filter sized by their number, the units that may be among them, and a join tells which are.

Cases: a null or empty text has no units and keeps its (empty) text; rows with the same id are
one document, so a copied row with the same id loses nothing to its twin; rows without an id are
documents of their own, which rank after those with one unless ids leave no room there; units of
white space are not compared; columns beside id and text pass through whatever their names are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparklake.llm import bits
from sparklake.llm.arrays import NOT_SPACE, Words, mapped, mix, slices, stored, with_row
from sparklake.llm.ngram_join import _numbered

REACH = 5  # words to either side that a segment's first word is compared with
LEAST_WORDS = REACH + 1
PASSAGE_WORDS = 20  # of a removed range that the query reports as a passage; lines are shorter
_LINE, _SEGMENT = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)
_BASES = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93)


class Units:
    """The units of a column of texts: bytes ``start:end``, ``words``, digest ``d1, d2``, ``line`` (is it one)
    and ``text``, sorted by text and place; of a line and its first segment the line comes first.
    """

    def __init__(self, column: pa.Array):
        self.words = words = Words(column, NOT_SPACE)
        data, text = words.data, words.text_of
        newline = np.flatnonzero(data == 0x0A)
        row = np.searchsorted(newline, words.start) + text  # grows with each line of each text
        first = np.flatnonzero(np.diff(row, prepend=-1))
        line = self._runs(first, len(words), _LINE)
        # a line begins after a line break and ends after the next, or with its text
        after = np.searchsorted(newline, words.start[first])
        begins = np.maximum(np.concatenate([[0], newline + 1])[after], words.offsets[text[first]])
        ends = np.minimum(np.append(newline + 1, len(data))[after], words.offsets[text[first] + 1])
        cut = self._borders(row)
        cut[first] = True
        at = np.flatnonzero(cut)
        segment = self._runs(at, len(words), _SEGMENT)
        # up to the next segment, or to the line's end without its break
        stop = np.append(words.start[at[1:]], 0) if len(at) else at
        last = np.append(row[at[1:]] != row[at[:-1]], True) if len(at) else np.zeros(0, bool)
        of = np.searchsorted(first, at, "right") - 1
        stop = np.where(last, ends[of] - (data[ends[of] - 1] == 0x0A), stop) if len(at) else stop
        several = np.bincount(of, minlength=len(first))[of] > 1
        keep = several & (segment[2] >= LEAST_WORDS)
        own = [
            np.concatenate([a, b[keep]])
            for a, b in zip(
                (begins, ends, *line, np.ones(len(first), bool), text[first]),
                (words.start[at], stop, *segment, np.zeros(len(at), bool), text[at]),
                strict=True,
            )
        ]
        order = np.lexsort((~own[5], own[0], own[6]))
        self.start, self.end, self.d1, self.d2, self.count, self.line, self.text = (x[order] for x in own)
        self.first = np.searchsorted(self.text, np.arange(len(column) + 1))

    def _runs(self, first: np.ndarray, n: int, seed: np.uint64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Two hashes and the number of words of the runs that begin at ``first``."""
        size = np.diff(np.append(first, n))
        place = np.arange(n) - np.repeat(first, size)
        out = []
        with np.errstate(over="ignore"):
            for base in _BASES:
                power = np.full(int(size.max(initial=0)) + 1, base)
                terms = mix(self.words.hash ^ base) * np.cumprod(power)[place]
                sums = np.add.reduceat(terms, first) if len(first) else np.empty(0, np.uint64)
                out.append(mix(sums ^ seed ^ size.astype(np.uint64)).view(np.int64))
        return out[0], out[1], size

    def _borders(self, row: np.ndarray) -> np.ndarray:
        """Words whose hash is the least of those near in their line; of equal ones, the first."""
        rank = mix(self.words.hash ^ _SEGMENT)
        least = np.ones(len(rank), bool)
        for d in range(1, REACH + 1):
            same = row[d:] == row[:-d]
            least[d:] &= ~same | (rank[d:] < rank[:-d])
            least[:-d] &= ~same | (rank[:-d] <= rank[d:])
        return least


def _digests(known=None):
    """(id, d1, d2) of each document's units, or of those that a filter may hold."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            units = Units(batch.column("text"))
            keep = np.ones(len(units.d1), bool) if known is None else bits.probe(known.value, units.d1)
            key = np.stack([units.text[keep], units.d1[keep], units.d2[keep]], axis=1)
            key = key[np.lexsort((key[:, 2], key[:, 1], key[:, 0]))]
            key = key[_new(key)]
            ids = batch.column("id").take(pa.array(key[:, 0]))
            yield pa.RecordBatch.from_arrays([ids, pa.array(key[:, 1]), pa.array(key[:, 2])], ["id", "d1", "d2"])

    return work


def _new(rows: np.ndarray) -> np.ndarray:
    """Which rows of a sorted array differ from the one before."""
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    return new


def _again(d1: np.ndarray, d2: np.ndarray, seen: list | None) -> np.ndarray:
    """Which units of a document are among ``seen``, or stood in it before."""
    _, first, own = np.unique(d1, return_index=True, return_inverse=True)
    again = first[own] < np.arange(len(d1))
    if seen:
        again |= np.isin(d1, np.fromiter((x["d1"] for x in seen), np.int64, len(seen)))
    known = {(x["d1"], x["d2"]) for x in seen or ()}
    for i in np.flatnonzero(again).tolist():
        pair = d1[i].item(), d2[i].item()
        earlier = np.flatnonzero(d1[:i] == d1[i]) if pair not in known else ()
        again[i] = pair in known or bool((d2[earlier] == d2[i]).any())
    return again


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        units, made = Units(batch.column("text")), []
        data = units.words.data
        point = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before each byte
        for i, (text, seen) in enumerate(zip(batch.column("text").to_pylist(), batch.column("repeated").to_pylist(), strict=True)):
            own = slice(units.first[i], units.first[i + 1])
            again = np.flatnonzero(_again(units.d1[own], units.d2[own], seen)) + own.start
            spans: list[dict] = []
            origin = point[units.words.offsets[i]]
            for k in again.tolist():
                start, end = (int(point[x[k]] - origin) for x in (units.start, units.end))
                if spans and end <= spans[-1]["end"]:  # a segment of a line that goes
                    continue
                if spans and start == spans[-1]["end"]:
                    spans[-1]["end"] = end
                    spans[-1]["words"] += int(units.count[k])
                else:
                    spans.append({"start": start, "end": end, "words": int(units.count[k])})
            at, keep = 0, []
            for span in spans:
                keep.append(text[at : span["start"]])
                at = span["end"]
            made.append({"text": "".join([*keep, text[at:]]), "spans": spans, "n_units": own.stop - own.start})
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(made, MADE)], ["row", "made"])


MADE = pa.struct(
    [
        ("text", pa.string()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("words", pa.int64())]))),
        ("n_units", pa.int64()),
    ]
)
_MADE = "made struct<text:string,spans:array<struct<start:bigint,end:bigint,words:bigint>>,n_units:bigint>"


def _ranked(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(id, row, text), where rows without an id have one that no other row has."""
    known = F.col(f"`{doc_id}`").cast("bigint")
    parts = lambda df, prefix="": [
        F.struct(*[F.col(f"{prefix}`{c}`").alias(c) for c in docs.columns if c != text]).alias("row"),
        F.coalesce(F.col(f"{prefix}`{text}`"), F.lit("")).alias("text"),
    ]
    if docs.where(known.isNull()).isEmpty():
        return docs.select(known.alias("id"), *parts(docs))
    lone, _, _ = _numbered(docs, known)
    return docs.where(known.isNotNull()).select(known.alias("id"), *parts(docs)).union(lone.select("id", *parts(lone, "row.")))


def dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``row`` (a struct of all columns but the text) and ``made``: the remaining ``text``, the
    removed ``spans`` (code points of the original, end exclusive, with their words) and ``n_units``.
    """
    rows = _ranked(docs, text, doc_id)
    units = "id bigint, d1 bigint, d2 bigint"
    held = mapped(rows.select("id", "text"), _digests(), units)
    first = held.groupBy("d1", "d2").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    first = stored(first.where("first < last").select("d1", "d2", "first"), "passage-digests")
    filled = bits.build(first, "d1", bits.size_for(first.count()))
    likely = mapped(rows.select("id", "text"), _digests(docs.sparkSession.sparkContext.broadcast(filled)), units)
    later = likely.join(first, ["d1", "d2"]).where("id > first")
    # at most one entry for each unit of the document
    repeated = later.groupBy("id").agg(F.collect_set(F.struct("d1", "d2")).alias("repeated"))
    df = rows.join(repeated, "id", "left").select("row", "text", "repeated")
    return mapped(df, _remove, with_row(df, _MADE))


def op5(docs: DataFrame) -> DataFrame:
    """The registered query: what remains of each document, and where the rest stood.

    ``longest_removed`` is the number of words of the longest removed range, and
    ``passage_removed`` tells whether it has the length of a passage.
    """
    words = F.transform("made.spans", lambda s: s["words"])
    return dedup(docs.select("doc_id", "text")).select(
        "row.doc_id",
        "made.n_units",
        F.size("made.spans").cast("bigint").alias("n_removed"),
        F.aggregate(words, F.lit(0).cast("bigint"), lambda a, b: a + b).alias("words_removed"),
        F.coalesce(F.array_max(words), F.lit(0).cast("bigint")).alias("longest_removed"),
        F.coalesce(F.array_max(words) >= PASSAGE_WORDS, F.lit(False)).alias("passage_removed"),
        F.transform("made.spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("removed"),
        F.sha2("made.text", 256).alias("kept_sha256"),
    )
