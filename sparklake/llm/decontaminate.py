"""Benchmark decontamination with an FM-index over each training shard.

A task turns its documents into shards of a few MB. In a shard, words that no benchmark phrase
has become separators, and runs of known words too short for any phrase are left out: no
occurrence can lie there. Over the rest it builds an FM-index (suffix order, wavelet matrix over
the Burrows-Wheeler transform, sampled positions), searches all phrases backwards at once,
locates their occurrences and merges them into spans.

A phrase is a window of 13 consecutive words of an item; an item with fewer words, but not none,
is one window. Words are compared by 64-bit hashes.

Cases: a null or empty text has no words, no hits and is not contaminated; an item without words
has no phrase; an item with a null id counts for hits but is not listed; items that share an id
count once; repeated documents are judged each for itself; columns beside id and text pass
through in ``row`` whatever their names are; an empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparklake.llm.arrays import ALNUM, Words, mapped, slices, stored

SAMPLE = 16  # every 16th position of a segment is kept for locating
SHARD_BYTES = 8 << 20
BLOCK_BYTES = 16 << 20  # benchmark text that is sent to the executors at once

FOUND = "spans array<struct<start:int,end:int>>, n_words bigint, n_hit bigint, items array<string>"


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Positions by suffix; 0 ends a suffix, and separators rank by position."""
    n = len(symbols)
    ends = symbols == 0
    rank = symbols.astype(np.int64) + np.count_nonzero(ends)
    rank[ends] = np.arange(np.count_nonzero(ends))
    step = 1
    while True:
        after = np.zeros(n, np.int64)
        after[:-step] = rank[step:] + 1
        after[rank < np.count_nonzero(ends)] = 0  # nothing after a separator matters
        key = rank * (max(int(rank.max()), n) + 2) + after
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        rank, step = new, step * 2
        if rank.max() == n - 1 or step >= n:
            return order


class WaveletMatrix:
    """Ranks of symbols in a sequence, for many queries at once."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        for bit in range(bits - 1, -1, -1):
            ones = (symbols >> bit) & 1
            before = np.concatenate([[0], np.cumsum(ones)])
            self.levels.append((bit, len(symbols) - int(before[-1]), before))
            symbols = np.concatenate([symbols[ones == 0], symbols[ones == 1]])

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        low = np.zeros_like(upto)
        for bit, zeros, before in self.levels:
            one = ((symbol >> bit) & 1).astype(bool)
            low = np.where(one, zeros + before[low], low - before[low])
            upto = np.where(one, zeros + before[upto], upto - before[upto])
        return upto - low


class FMIndex:
    """Backward search and location over segments of symbols, each ended by 0."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        order = suffix_order(symbols)
        self.last = symbols[order - 1]
        self.size = len(symbols)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=n_symbols))])
        self.ranks = WaveletMatrix(self.last, max(1, int(n_symbols - 1).bit_length()))
        # segment starts are sampled, so that no walk has to pass a separator
        self.sampled = (order % SAMPLE == 0) | (self.last == 0)
        self.position = order[self.sampled]
        self.before = np.concatenate([[0], np.cumsum(self.sampled)])

    def step(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        return self.smaller[symbol] + self.ranks.rank(symbol, row)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of the phrases (one a row of the matrix, all of one length)."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.size, np.int64)
        live = np.arange(len(phrases))
        for k in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[live, k]
            low[live], high[live] = self.step(symbol, low[live]), self.step(symbol, high[live])
            live = live[low[live] < high[live]]
        return low, np.maximum(high, low)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of rows: walk back to a sampled one."""
        found, rows, walked = np.empty(len(rows), np.int64), rows.copy(), 0
        todo = np.arange(len(rows))
        while len(todo):
            here = self.sampled[rows]
            found[todo[here]] = self.position[self.before[rows[here]]] + walked
            todo, rows = todo[~here], rows[~here]
            rows = self.step(self.last[rows], rows)
            walked += 1
        return found


class Phrases:
    """The windows of a block of benchmark items, as numbers of words."""

    def __init__(self, ids: list[list[str]], items: list[str], width: int):
        """``ids`` has, for each distinct text of ``items``, all items with that text."""
        words = Words(pa.array(items, pa.large_string()), ALNUM)
        self.known = np.unique(words.hash)
        number = np.searchsorted(self.known, words.hash) + 1
        self.ids = ids
        windows: dict[int, dict[tuple, set]] = {}
        for i in range(len(items)):
            own = number[words.first[i] : words.first[i + 1]].tolist()
            size = min(width, len(own))
            for k in range(len(own) - size + 1 if own else 0):
                windows.setdefault(size, {}).setdefault(tuple(own[k : k + size]), set()).add(i)
        # by length: the windows as a matrix, and the items of each window
        self.by_length = {
            size: (
                np.array(list(of), np.int64),
                np.concatenate([[0], np.cumsum([len(x) for x in of.values()])]),
                np.array([y for x in of.values() for y in sorted(x)], np.int64),
            )
            for size, of in windows.items()
        }
        self.shortest = min(windows, default=0)

    def find(self, words: Words) -> tuple[np.ndarray, dict[int, set]]:
        """Which words lie in an occurrence, and the benchmark texts (by number) of each text."""
        hit, items = np.zeros(len(words) + 1, np.int64), {}
        if not self.by_length or not len(words):
            return hit[:-1] > 0, items
        number = np.searchsorted(self.known, words.hash)
        number = np.where(self.known[np.minimum(number, len(self.known) - 1)] == words.hash, number + 1, 0)
        # runs of known words of one text, at least as long as the shortest phrase
        cut = np.zeros(len(words) + 1, bool)
        cut[words.first] = True
        known = number > 0
        begin = np.flatnonzero(known & (cut[:-1] | ~np.concatenate([[False], known[:-1]])))
        end = np.flatnonzero(known & (cut[1:] | ~np.concatenate([known[1:], [False]]))) + 1
        fits = end - begin >= self.shortest
        begin, end = begin[fits], end[fits]
        if not len(begin):
            return hit[:-1] > 0, items
        size = end - begin + 1
        ends = np.cumsum(size)
        source = np.arange(ends[-1]) - np.repeat(ends - size - begin, size)  # word at each symbol
        symbols = number[np.minimum(source, len(words) - 1)]
        symbols[ends - 1] = 0
        index = FMIndex(symbols, len(self.known) + 1)
        text_of = words.text_of
        for length, (phrases, of, item) in self.by_length.items():
            low, high = index.search(phrases)
            found = np.repeat(np.arange(len(phrases)), high - low)
            shift = np.cumsum(high - low) - (high - low)
            rows = np.arange(len(found)) - np.repeat(shift - low, high - low)
            at = source[index.locate(rows)]
            np.add.at(hit, at, 1)
            np.add.at(hit, at + length, -1)
            pairs = np.unique(np.stack([text_of[at], found]), axis=1)
            for text, phrase in pairs.T.tolist():
                items.setdefault(text, set()).update(item[of[phrase] : of[phrase + 1]].tolist())
        return np.cumsum(hit)[:-1] > 0, items


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _search(block, schema: pa.DataType):
    """Add what one block of the benchmark finds to what earlier blocks found."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases: Phrases = block.value
        for batch in slices(batches, "text", SHARD_BYTES):
            words = Words(batch.column("text"), ALNUM)
            hit, items = phrases.find(words)
            spans: dict[int, list] = {}
            edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
            for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
                i = int(np.searchsorted(words.first, a, "right")) - 1
                while a < b:  # a run of hits may go on in the next text
                    stop = min(b, int(words.first[i + 1]))
                    if stop > a:
                        spans.setdefault(i, []).append((a - int(words.first[i]), stop - int(words.first[i])))
                    a, i = stop, i + 1
            found = []
            for i, old in enumerate(batch.column("found").to_pylist()):
                mine = _merged(spans.get(i, []) + [(x["start"], x["end"]) for x in old["spans"]] if old else spans.get(i, []))
                listed = set(old["items"] if old else ()).union(*(phrases.ids[x] for x in items.get(i, ())))
                found.append(
                    {
                        "spans": [{"start": a, "end": b} for a, b in mine],
                        "n_words": int(words.first[i + 1] - words.first[i]),
                        "n_hit": sum(b - a for a, b in mine),
                        "items": sorted(listed),
                    }
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("text"), pa.array(found, schema)], ["row", "text", "found"]
            )

    return work


def annotate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = 13,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """What each document shares with the benchmark.

    Returns ``row`` (a struct of all columns but the text), ``text`` and ``found``: ``spans``
    (word ranges, end exclusive, merged), ``n_words``, ``n_hit`` and the sorted ids of
    ``items``. Items with the same text are one to the search. The benchmark's distinct texts and
    their ids go to the executors in blocks of about ``block_bytes``, one pass over the stage's rows
    for each; the rows are written after each block but the last, and the block is freed before the
    next one comes, so driver and workers hold one block at a time.
    """
    spark = docs.sparkSession
    items = benchmark.select(
        F.col(f"`{item_id}`").cast("string").alias("id"), F.coalesce(F.col(f"`{item_text}`"), F.lit("")).alias("item")
    )
    items = stored(items.groupBy("item").agg(F.sort_array(F.collect_set("id")).alias("ids")), "benchmark-texts")
    size = items.agg(F.sum(F.octet_length("item") + F.octet_length(F.array_join("ids", ",")))).first()[0] or 0
    blocks = 1 + int(size) // block_bytes
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(0).alias("_none")]
    schema = f"struct<{FOUND.replace(' array', ':array').replace(' bigint', ':bigint')}>"
    df = docs.select(
        F.struct(*rest).alias("row"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
        F.lit(None).cast(schema).alias("found"),
    )
    arrow = pa.struct(
        [
            ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            ("n_words", pa.int64()),
            ("n_hit", pa.int64()),
            ("items", pa.list_(pa.string())),
        ]
    )
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k).collect()
        block = spark.sparkContext.broadcast(Phrases([x["ids"] for x in rows], [x["item"] for x in rows], width))
        df = mapped(df, _search(block, arrow), df.schema)
        if k + 1 < blocks:
            df = stored(df, "benchmark-block")
            block.destroy()
    return df


def contaminated(found: str = "found", share: int = 20) -> Column:
    """Whether at least one word in ``share`` lies in a benchmark phrase."""
    return (F.col(f"{found}.n_hit") > 0) & (F.col(f"{found}.n_hit") * share >= F.col(f"{found}.n_words"))


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents that are not contaminated, whole and with all their columns."""
    kept = annotate(docs, benchmark, text, **options).where(~contaminated())
    return kept.select(*[F.col("text").alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        words = Words(batch.column("text"), ALNUM)
        out = []
        for i, found in enumerate(batch.column("found").to_pylist()):
            raw = batch.column("text")[i].as_py().encode()
            base, keep = int(words.offsets[i]), []
            at = 0
            for span in found["spans"]:
                a, b = words.first[i] + span["start"], words.first[i] + span["end"] - 1
                keep.append(raw[at : int(words.start[a]) - base])
                at = int(words.end[b]) - base
            out.append(b"".join([*keep, raw[at:]]).decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(out, batch.column("text").type), batch.column("found")], ["row", "text", "found"]
        )


def without_spans(annotated: DataFrame) -> DataFrame:
    """``annotate``'s rows with the text of all spans removed; what stands between words stays."""
    return mapped(annotated, _cut, annotated.schema)


def op8(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest columns of the registered query."""
    return annotate(docs.select("doc_id", "text"), benchmark).select(
        "row.doc_id",
        "found.n_words",
        "found.n_hit",
        F.size("found.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )
