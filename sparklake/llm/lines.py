"""Incremental, reversible line dedup: cuckoo filters over shards of exact reference counts.

``counts`` has one row for each line key of the corpus: its 128-bit digest, its shard and the
number of documents that hold it. Inserting documents adds to the counts and deleting them takes
the same off again, so a deletion undoes an insertion exactly. Each shard also has a cuckoo
filter over its frequent keys, into which keys enter as their count rises to the threshold and
from which they leave as it falls. A filter answers "perhaps" for a few other keys; those that
the corpus holds are listed beside it as ``doubts``, found by asking the filter for every key of
its shard. Filter and list together answer exactly for every line of the corpus.

Cleaning probes all filters in each task while they fit in a documented size. Beyond it the lines
go to their shards, where a task holds one filter at a time and lines stream past it; shards with
a hot line are dealt in parts. Both ways ask the same filters and give the same rows.

Cases: a null or empty text is one empty line; a line of white space has the empty key, which is
too short to count; a line that a document repeats counts once for it; repeated rows count as
documents of their own; columns beside id and text pass through whatever their names are; an
empty table gives empty counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparklake.llm.arrays import mapped, prepare, slices, stored, with_row

SPACE = " \t\n\x0b\x0c\r"
KEYS_PER_SHARD = 200_000
FILTER_BYTES = 32 << 20  # filters and doubts that cleaning may send to the executors
ROWS_PER_PART = 4_000_000  # lines of a shard that one task probes
MOST_HOT = 100_000  # shards in parts; they are broadcast, at 12 bytes each
SLOTS = 4  # fingerprints in a bucket
KICKS = 500

_LOWER = {i: i + 32 for i in range(65, 91)}


def line_key(line: str) -> str:
    """A line without white space at its ends, A-Z in lower case."""
    return line.strip(SPACE).translate(_LOWER)


def digests(text: str, least: int) -> list[bytes]:
    """The key digest of each line, empty for keys of fewer than ``least`` code points."""
    keys = map(line_key, text.split("\n"))
    return [xxhash.xxh3_128_digest(k.encode()) if len(k) >= least else b"" for k in keys]


class CuckooFilter:
    """Two candidate buckets a key; keys can be taken out again. Buckets of 16-bit prints."""

    def __init__(self, table: np.ndarray):
        self.table = table  # buckets x slots, 0 is empty
        self.mask = len(table) - 1

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 1 << max(2, int(np.ceil(np.log2(max(1, keys) / SLOTS / 0.8))))
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Prints and both buckets of 64-bit keys."""
        prints = (keys >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        one = (keys & np.uint64(0xFFFFFFFF)).astype(np.int64) & self.mask
        return prints, one, self._other(prints, one)

    def _other(self, prints, bucket):
        return (bucket ^ ((np.asarray(prints).astype(np.int64) * 0x5BD1E995) & 0x7FFFFFFF)) & self.mask

    def has(self, keys: np.ndarray) -> np.ndarray:
        prints, one, two = self._places(keys)
        return ((self.table[one] == prints[:, None]) | (self.table[two] == prints[:, None])).any(axis=1)

    def insert(self, keys: np.ndarray) -> bool:
        """Put all keys in; False if one found no place, and a larger filter is needed."""
        for p, one, two in zip(*(x.tolist() for x in self._places(keys)), strict=True):
            for bucket in (one, two):
                free = np.flatnonzero(self.table[bucket] == 0)
                if len(free):
                    self.table[bucket, free[0]] = p
                    break
            else:
                bucket, slot = one, 0
                for _ in range(KICKS):
                    p, self.table[bucket, slot] = int(self.table[bucket, slot]), p
                    bucket = int(self._other(p, bucket))
                    free = np.flatnonzero(self.table[bucket] == 0)
                    if len(free):
                        self.table[bucket, free[0]] = p
                        break
                    slot = (slot + 1) % SLOTS
                else:
                    return False
        return True

    def delete(self, keys: np.ndarray) -> None:
        """Take out keys that were put in before."""
        for p, one, two in zip(*(x.tolist() for x in self._places(keys)), strict=True):
            for bucket in (one, two):
                at = np.flatnonzero(self.table[bucket] == p)
                if len(at):
                    self.table[bucket, at[0]] = 0
                    break

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        size = max(1, len(keys))
        while not (made := cls.sized(size)).insert(keys):
            size *= 2
        return made


def _key64(digest) -> np.ndarray:
    return np.frombuffer(b"".join(d[:8] for d in digest), np.uint64)


def _document_keys(least: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            keys = [k for text in batch.column("text").to_pylist() for k in {*digests(text, least)} - {b""}]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary())], ["digest"])

    return work


def document_counts(docs: DataFrame, text: str = "text", least: int = 1, copies: bool = True) -> DataFrame:
    """(digest, docs): in how many of these documents each line key stands.

    Without ``copies``, documents of equal text count as one.
    """
    whole = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    if copies:
        keys = mapped(whole, _document_keys(least), "digest binary")
    else:
        keys = mapped(whole, _text_keys(least), "of binary, digest binary").distinct()
    return keys.groupBy("digest").agg(F.count("*").alias("docs"))


def _shard(n: int | Column) -> Column:
    """The shard of a key, from digest bytes that the filters don't use."""
    return F.pmod(F.conv(F.hex(F.substring("digest", 13, 4)), 16, 10).cast("bigint"), F.lit(n)).cast("int")


def insert(
    counts: DataFrame | None, docs: DataFrame, sign: int = 1, text: str = "text", least: int = 1, copies: bool = True
) -> DataFrame:
    """The reference counts with the documents added (or, with -1, taken off); zeros go."""
    change = document_counts(docs, text, least, copies).select("digest", (F.col("docs") * sign).alias("docs"))
    if counts is None:
        return change
    return counts.select("digest", "docs").union(change).groupBy("digest").agg(F.sum("docs").alias("docs")).where("docs <> 0")


def delete(counts: DataFrame, docs: DataFrame, text: str = "text", least: int = 1) -> DataFrame:
    """Undo ``insert`` of the same documents."""
    return insert(counts, docs, -1, text, least)


def _filter_of(threshold: int):
    def work(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        known = _key64(rows["digest"])
        frequent = (rows["docs"] >= threshold).to_numpy()
        made = CuckooFilter.of(known[frequent])
        doubts = rows["digest"][made.has(known) & ~frequent]
        return pd.DataFrame(
            {
                "shard": [key[0]],
                "filter": [made.table.tobytes()],
                "doubts": [b"".join(doubts)],
                "keys": [int(frequent.sum())],
                "held": [int(rows["docs"].sum())],
            }
        )

    return work


FILTERS = "shard int, filter binary, doubts binary, keys bigint, held bigint"


def shards_for(counts: DataFrame) -> int:
    """As many shards as keep each at about KEYS_PER_SHARD keys."""
    return 1 + counts.count() // KEYS_PER_SHARD


def filters(counts: DataFrame, threshold: int, shards: int) -> DataFrame:
    """One row a shard: the cuckoo filter of its frequent keys, its doubts, and how often its keys are held."""
    return counts.withColumn("shard", _shard(shards)).groupBy("shard").applyInPandas(_filter_of(threshold), FILTERS)


def _filter_changed(threshold: int):
    def work(key: tuple, old: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(old):
            return _filter_of(threshold)(key, rows.rename(columns={"after": "docs"})[["digest", "docs"]])
        made = CuckooFilter(np.frombuffer(old["filter"][0], np.uint16).reshape(-1, SLOTS).copy())
        known = _key64(rows["digest"])
        was, now = (rows["before"] >= threshold).to_numpy(), (rows["after"] >= threshold).to_numpy()
        made.delete(known[was & ~now])
        if not made.insert(known[now & ~was]):
            made = CuckooFilter.of(known[now])
        doubts = rows["digest"][made.has(known) & ~now & (rows["after"] > 0).to_numpy()]
        return pd.DataFrame(
            {
                "shard": [key[0]],
                "filter": [made.table.tobytes()],
                "doubts": [b"".join(doubts)],
                "keys": [int(now.sum())],
                "held": [int(rows["after"].sum())],
            }
        )

    return work


def refreshed(old_filters: DataFrame, before: DataFrame, after: DataFrame, threshold: int, shards: int) -> DataFrame:
    """The filters after a change of the counts: keys that crossed the threshold move."""
    rows = (
        before.select("digest", F.col("docs").alias("before"))
        .join(after.select("digest", F.col("docs").alias("after")), "digest", "full")
        .fillna(0, ["before", "after"])
        .withColumn("shard", _shard(shards))
    )
    return old_filters.groupBy("shard").cogroup(rows.groupBy("shard")).applyInPandas(_filter_changed(threshold), FILTERS)


class Frequent:
    """All shards' filters and doubts; tells which line digests are frequent."""

    def __init__(self, rows: list, shards: int):
        self.shards = shards
        self.filters = {r["shard"]: CuckooFilter(np.frombuffer(r["filter"], np.uint16).reshape(-1, SLOTS)) for r in rows if r["keys"]}
        self.doubts = {r["doubts"][i : i + 16] for r in rows for i in range(0, len(r["doubts"]), 16)}

    def among(self, digest: list[bytes]) -> set[bytes]:
        """Those of the given digests that are frequent."""
        known = _key64(digest)
        shard = np.frombuffer(b"".join(d[12:] for d in digest), ">u4").astype(np.int64) % self.shards
        hit = np.zeros(len(digest), bool)
        for k in np.unique(shard).tolist():
            if k in self.filters:
                own = np.flatnonzero(shard == k)
                hit[own] = self.filters[k].has(known[own])
        return {digest[i] for i in np.flatnonzero(hit)} - self.doubts


def _kept(text: str, keys: list[bytes], frequent: set[bytes]) -> dict:
    lines = text.split("\n")
    stay = [line for line, key in zip(lines, keys, strict=True) if key not in frequent]
    return {"text": "\n".join(stay), "n_lines": len(lines), "n_dropped": len(lines) - len(stay)}


KEPT = pa.struct([("text", pa.string()), ("n_lines", pa.int64()), ("n_dropped", pa.int64())])
_KEPT = "kept struct<text:string,n_lines:bigint,n_dropped:bigint>"


def _probe(frequent, least: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            keys = [digests(text, least) for text in texts]
            found = frequent.value.among(sorted(set().union(*keys) - {b""}))
            kept = [_kept(text, k, found) for text, k in zip(texts, keys, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(kept, KEPT)], ["row", "kept"])

    return work


def _text_keys(least: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            rows = [(xxhash.xxh3_128_digest(t.encode()), k) for t in texts for k in sorted({*digests(t, least)} - {b""})]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary())], ["of", "digest"]
            )

    return work


def _probe_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines sorted by shard and part, where each part's filter comes first."""
    place, cuckoo, doubts = None, None, set()
    for batch in batches:
        places = list(zip(batch.column("shard").to_pylist(), batch.column("part").to_pylist(), strict=True))
        ends = [i for i in range(1, len(places)) if places[i] != places[i - 1]]
        for a, b in zip([0, *ends], [*ends, len(places)], strict=True):
            if a == b:
                continue
            if places[a] != place:
                place, cuckoo, doubts = places[a], None, set()
            table = batch.column("filter")[a].as_py()
            if table is not None:
                listed = batch.column("doubts")[a].as_py()
                cuckoo = CuckooFilter(np.frombuffer(table, np.uint16).reshape(-1, SLOTS))
                doubts = {listed[i : i + 16] for i in range(0, len(listed), 16)}
                a += 1
            if cuckoo is None or a == b:
                continue
            digest = batch.column("digest").slice(a, b - a).to_pylist()
            hit = [i for i in np.flatnonzero(cuckoo.has(_key64(digest))).tolist() if digest[i] not in doubts]
            of = batch.column("of").slice(a, b - a).take(pa.array(hit, pa.int64()))
            yield pa.RecordBatch.from_arrays([of, pa.array([digest[i] for i in hit], pa.binary())], ["of", "digest"])


def _frequent_among(held: DataFrame, made: DataFrame, shards: int) -> DataFrame:
    """The rows (of, digest) whose key is frequent, each probed in the filter of its shard.

    A shard whose keys are held more than ROWS_PER_PART times is dealt in parts, each with the
    filter. At most MOST_HOT shards can be: above that, parts grow with the corpus instead.
    """
    total = made.agg(F.sum("held")).first()[0] or 0
    most = max(ROWS_PER_PART, total // MOST_HOT)
    parts = F.ceil(F.col("held") / most).cast("int")
    hot = made.where(F.col("held") > most).select("shard", parts.alias("parts"))
    asked = (
        held.withColumn("shard", _shard(shards))
        .join(F.broadcast(hot), "shard", "left")
        .withColumn("part", F.pmod(F.xxhash64("of"), F.coalesce("parts", F.lit(1))).cast("int"))
    )
    answers = made.where("keys > 0").withColumn("part", F.explode(F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1)))
    both = answers.select("shard", "part", "filter", "doubts").unionByName(
        asked.select("shard", "part", "of", "digest"), allowMissingColumns=True
    )
    placed = both.repartition("shard", "part").sortWithinPartitions("shard", "part", F.col("filter").isNull())
    return mapped(placed, _probe_shards, "of binary, digest binary")


def _drop(least: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            kept = [
                _kept(text, digests(text, least), set(frequent or ()))
                for text, frequent in zip(batch.column("text").to_pylist(), batch.column("frequent").to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(kept, KEPT)], ["row", "kept"])

    return work


def _text_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        of = [xxhash.xxh3_128_digest(t.encode()) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("text"), pa.array(of, pa.binary())], ["row", "text", "of"])


def clean(
    docs: DataFrame,
    counts: DataFrame,
    threshold: int = 10,
    text: str = "text",
    least: int = 1,
    filter_bytes: int = FILTER_BYTES,
) -> DataFrame:
    """Drop the lines whose key at least ``threshold`` documents hold, by ``counts``.

    Returns ``row`` (a struct of all columns but the text) and ``kept``: the remaining lines as
    ``text``, ``n_lines`` before and ``n_dropped``. The documents' lines must be in ``counts``.
    """
    spark = prepare(docs.sparkSession)
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(0).alias("_none")]
    df = docs.select(F.struct(*rest).alias("row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    shards = shards_for(counts)
    made = stored(filters(counts, threshold, shards), "line-filters")
    size = made.agg(F.sum(F.octet_length("filter") + F.octet_length("doubts"))).first()[0] or 0
    if size <= filter_bytes:
        frequent = spark.sparkContext.broadcast(Frequent(made.collect(), shards))
        return mapped(df, _probe(frequent, least), with_row(df, _KEPT))
    # too many for that: each line asks its shard's filter, once for each distinct text
    held = mapped(df.select("text"), _text_keys(least), "of binary, digest binary").distinct()
    hits = _frequent_among(held, made, shards).groupBy("of").agg(F.collect_list("digest").alias("frequent"))
    rows = mapped(df, _text_digest, with_row(df, "text string, of binary")).join(hits, "of", "left")
    return mapped(rows.select("row", "text", "frequent"), _drop(least), with_row(df, _KEPT))


def dedup(docs: DataFrame, threshold: int = 10, text: str = "text", least: int = 1, copies: bool = True) -> DataFrame:
    """All columns, with the text's frequent lines dropped.

    Without ``copies``, a line that only copies of one text hold is not frequent, and stays.
    """
    counts = stored(insert(None, docs, text=text, least=least, copies=copies), "line-counts")
    kept = clean(docs, counts, threshold, text, least)
    return kept.select(*[F.col("kept.text").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op7(docs: DataFrame) -> DataFrame:
    """The digest columns of the registered query."""
    docs = docs.select("doc_id", "text")
    counts = stored(insert(None, docs), "line-counts")
    return clean(docs, counts).select(
        "row.doc_id", "kept.n_lines", "kept.n_dropped", F.sha2("kept.text", 256).alias("kept_sha256")
    )
