"""Byte-level BPE by corpus-level merge replay.

Each task cuts its slice of the corpus into pieces by the vocabulary's pattern, keeps every
distinct piece once, and replays the merges over all of them together: an inverted index leads
from a token pair to the places where it stands, pairs are taken in rank order, and a merge
updates only the neighbours it touches. Documents then look up their pieces. There is no shuffle;
a task holds one slice, its distinct pieces and a bounded memory of earlier ones.

The result equals that of merging each piece by itself, lowest rank first and leftmost first.

Cases: a null or empty text has no tokens and decodes to nothing; ids that the vocabulary lacks
raise when decoding; a null list of ids decodes to nothing; repeated rows are encoded alike;
other columns pass through whatever their names are.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparklake.llm.arrays import mapped, slices, with_row

MEMORY = 300_000  # pieces a task remembers before it starts afresh
SLICE_BYTES = 4 << 20  # text over which the merges are replayed at once
IDS_AT_ONCE = 1 << 17  # ids of a batch that is decoded, or one row
AT_ONCE = 1 << 19  # places that enter the index in one step


def read_ranks(path: str) -> dict[bytes, int]:
    """The tokens of a rank file: a token in base 64 and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, lines))}


class Merges:
    """The vocabulary as a sorted table: which token two neighbours make."""

    def __init__(self, ranks: dict[bytes, int]):
        self.bytes = np.array([ranks.get(bytes([i]), -1) for i in range(256)], np.int64)
        pairs, made = [], []
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    pairs.append(a << 32 | b)
                    made.append(rank)
        order = np.argsort(np.array(pairs, np.int64))
        self.pairs = np.append(np.array(pairs, np.int64)[order], np.int64(1 << 62))
        self.made = np.append(np.array(made, np.int64)[order], -1)
        # tokens that can enter a pair of lower rank than their own
        self.early = {
            x for p, rank in zip(pairs, made, strict=True) for x in (p >> 32, p & 0xFFFFFFFF) if rank < x
        }

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair of neighbours, -1 where it is no token."""
        pair = a.astype(np.int64) << 32 | b
        at = np.searchsorted(self.pairs, pair)
        return np.where((self.pairs[at] == pair) & (a >= 0) & (b >= 0), self.made[at], -1)


def replay(pieces: list[bytes], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """The token ids of all pieces, one after another, and where each piece's begin.

    The pieces stand in one array of tokens, linked left and right, with a -1 after each piece.
    ``index`` has, for the rank of a pair, the places of its left token. Ranks are taken in order;
    all places of a rank are merged at once, and only the pairs with their neighbours enter the
    index anew. Where a merge can make a pair of lower rank, a piece's places go one by one.
    """
    size = np.fromiter(map(len, pieces), np.int64, len(pieces))
    ends = np.cumsum(size + 1) - 1
    n = int(size.sum()) + len(pieces)
    token = np.full(n, -1, np.int32)
    inside = np.ones(n, bool)
    inside[ends] = False
    token[inside] = merges.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
    right, left = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def enter(at: np.ndarray, rank: np.ndarray) -> None:
        at, rank = at[rank >= 0], rank[rank >= 0]
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        cuts = np.flatnonzero(np.diff(rank)) + 1
        for places, r in zip(np.split(at, cuts), rank[np.concatenate([[0], cuts])].tolist(), strict=True) if len(at) else ():
            if r in index:
                index[r].append(places)
            else:
                index[r] = [places]
                heapq.heappush(heap, r)

    def merge(at: np.ndarray, rank: int) -> np.ndarray:
        """Merge the pairs at these places, which don't overlap; the ranks of the new pairs."""
        gone = right[at]
        token[at], token[gone] = rank, -1
        after = right[gone]
        right[at], left[after] = after, at
        before = left[at]
        places = np.concatenate([before[before >= 0], at])
        ranks = merges.rank(token[places], token[right[places]])
        enter(places, ranks)
        return ranks

    for k in range(0, n - 1, AT_ONCE):
        at = np.arange(k, min(n - 1, k + AT_ONCE), dtype=np.int32)
        enter(at, merges.rank(token[at], token[at + 1]))
    while heap:
        rank = heapq.heappop(heap)
        places = np.sort(np.concatenate(index.pop(rank)))
        places = places[np.diff(places, prepend=-1) > 0]
        # an earlier merge may have taken one of the two
        places = places[token[places] >= 0]
        a, b = token[places], token[right[places]]
        places = places[merges.rank(a, b) == rank]
        if not len(places):
            continue
        alone = np.ones(len(places), bool)
        if rank in merges.early:
            of = np.searchsorted(ends, places)
            same = of[1:] == of[:-1]
            alone[1:] &= ~same
            alone[:-1] &= ~same
        else:  # of a run of one token, every second place
            linked = np.concatenate([[False], right[places[:-1]] == places[1:]])
            begin = np.maximum.accumulate(np.where(linked, 0, np.arange(len(places))))
            places = places[(np.arange(len(places)) - begin) % 2 == 0]
            alone = np.ones(len(places), bool)
        if alone.any():
            merge(places[alone], rank)
        skip = -1
        for k in np.flatnonzero(~alone).tolist():
            at = places[k : k + 1]
            if of[k] == skip or token[at[0]] < 0 or merges.rank(token[at], token[right[at]])[0] != rank:
                continue
            new = merge(at, rank)
            if ((new >= 0) & (new < rank)).any():  # that pair comes first; this piece's others wait
                rest = places[k + 1 :][of[k + 1 :] == of[k]]
                enter(rest, np.full(len(rest), rank))
                skip = of[k]
    keep = token >= 0
    return token[keep].astype(np.int32), np.concatenate([[0], np.cumsum(keep)[ends]])


class Replay:
    """Ids of pieces, remembered up to a bound."""

    def __init__(self, path: str, pattern: str):
        self.merges = Merges(read_ranks(path))
        self.cut = regex.compile(pattern).findall
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.ids = np.empty(0, np.int32)
        self.first = np.zeros(1, np.int64)

    def encode(self, texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        """The pieces of all texts by number, and where each text's begin."""
        if len(self.number) > MEMORY:
            self.forget()
        number, known = self.number, len(self.number)
        rows = []
        for text in texts:
            pieces = self.cut(text)
            rows.append(np.fromiter((number.setdefault(x, len(number)) for x in pieces), np.int32, len(pieces)))
        new = [x.encode() for x in islice(number, known, None)]
        ids, first = replay(new, self.merges)
        self.first = np.concatenate([self.first, first[1:] + self.first[-1]])
        self.ids = np.concatenate([self.ids, ids])
        return np.concatenate([*rows, np.empty(0, np.int32)]), np.cumsum([0, *map(len, rows)])


def _encoder(path: str, pattern: str, lengths_only: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Replay(path, pattern)

        def made(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pieces, at = bpe.encode(x for batch in rows for x in batch.column("text").to_pylist())
            size = np.diff(bpe.first)
            done = 0
            for batch in rows:
                begin, end = at[done], at[done + batch.num_rows]
                own = pieces[begin:end]
                ends = np.concatenate([[0], np.cumsum(size[own])])
                offsets = ends[at[done : done + batch.num_rows + 1] - begin]
                if lengths_only:
                    out = pa.array(np.diff(offsets), pa.int64())
                else:
                    where = np.arange(ends[-1]) + np.repeat(bpe.first[own] - ends[:-1], size[own])
                    out = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(bpe.ids[where], pa.int32()))
                done += batch.num_rows
                yield pa.RecordBatch.from_arrays([batch.column("row"), out], ["row", "made"])

        held, size = [], 0
        for batch in slices(batches, "text", 1 << 20):
            held.append(batch)
            size += batch.column("text").nbytes
            if size >= SLICE_BYTES:
                yield from made(held)
                held, size = [], 0
        if held:
            yield from made(held)

    return work


def _packed(df: DataFrame, column: str) -> list:
    rest = [F.col(f"`{c}`") for c in df.columns if c != column]
    return [F.struct(*rest or [F.lit(0).alias("_none")]).alias("row")]


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", lengths_only: bool = False) -> DataFrame:
    """All columns but the text as the struct ``row``, and ``made``: the ids, or their number.

    ``path`` names a rank file that is on every executor, as installed with the vocabulary.
    """
    df = docs.select(*_packed(docs, text), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    kind = "bigint" if lengths_only else "array<int>"
    return mapped(df, _encoder(path, pattern, lengths_only), with_row(df, f"made {kind}"))


def _decoder(path: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = read_ranks(path)
        size = np.full(max(ranks.values(), default=-1) + 1, -1, np.int64)
        size[list(ranks.values())] = [len(token) for token in ranks]
        start = np.cumsum(np.maximum(size, 0)) - np.maximum(size, 0)
        token = np.frombuffer(b"".join(sorted(ranks, key=ranks.get)), np.uint8)
        for batch in batches:
            lengths = pc.list_value_length(batch.column("ids")).fill_null(0).to_numpy(zero_copy_only=False)
            part = np.cumsum(lengths, dtype=np.int64) // IDS_AT_ONCE
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                rows = batch.slice(a, b - a)
                ids = rows.column("ids").flatten().to_numpy(zero_copy_only=False)
                if len(ids) and (ids.min() < 0 or ids.max() >= len(size) or (size[ids] < 0).any()):
                    raise KeyError("an id that the vocabulary lacks")
                ends = np.cumsum(size[ids])
                # the bytes of all tokens, one after another
                made = token[np.arange(ends[-1] if len(ends) else 0) + np.repeat(start[ids] - (ends - size[ids]), size[ids])]
                offsets = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(lengths[a:b])])]
                out = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(offsets), pa.py_buffer(made)])
                yield pa.RecordBatch.from_arrays([rows.column("row"), rows.column("ids"), out.cast(pa.binary())], ["row", "ids", "bytes"])

    return work


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Add ``bytes`` to rows with ``row`` and ``ids``: the tokens' bytes, joined."""
    df = encoded.select("row", "ids")
    return mapped(df, _decoder(path), with_row(df, "ids array<int>, bytes binary"))


def encoded_and_checked(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """The columns but the text, with ``ids``, ``n_tokens`` and ``restored``: whether the ids
    decode to the text's bytes. A column that has one of these names becomes ``own_`` and its name.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(0).alias("_none")]
    df = docs.select(F.struct(*rest).alias("rest"), F.sha2(whole.cast("binary"), 256).alias("digest"), whole.alias("text"))
    made = ("ids", "n_tokens", "restored")

    def free(name: str) -> str:
        if name not in made:
            return name
        new = f"own_{name}"
        while new in docs.columns:
            new = f"own_{new}"
        return new

    decoded = decode(encode(df, path, pattern).withColumnRenamed("made", "ids"), path)
    return decoded.select(
        *[F.col(f"row.rest.`{c}`").alias(free(c)) for c in docs.columns if c != text],
        "ids",
        F.size("ids").cast("bigint").alias("n_tokens"),
        (F.sha2("bytes", 256) == F.col("row.digest")).alias("restored"),
    )


def op1(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """The digest columns of the registered query."""
    encoded = encode(docs.select("doc_id", "text"), path, pattern).withColumnRenamed("made", "ids")
    return decode(encoded, path).select(
        "row.doc_id",
        F.coalesce(F.size("ids"), F.lit(0)).cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.coalesce("ids", F.array().cast("array<int>")).cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
