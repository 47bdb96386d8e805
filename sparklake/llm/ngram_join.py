"""N-gram Jaccard join with rare-first prefix filtering.

A document's set holds its distinct word n-grams, as 64-bit hashes. Documents with equal sets are
one class, so copies are never paired. The n-grams of a set are ordered by how often their bucket
of a count sketch was hit over the whole corpus, rarest first: linked sets share an n-gram of
their prefixes. Classes meet on the n-grams of their prefixes, and a pair must pass

* the length filter (sizes within the threshold),
* the positional filter (what can still be shared after the first common n-gram), and
* the suffix filter (the sets' counts over fixed hash ranges bound their difference)

before its sets are intersected, once for each pair. Pairs are tried in two rounds, because a
group of near copies has too many of them. Each n-gram's hub is the class that holds it nearest
to its set's beginning. First each class meets the hub that it shares most n-grams with; then,
after components are known, only classes that share an n-gram but lie in different components. What is left out joins classes
already known to be connected, so components are those of all links.

The sketch has a fixed size, whatever the corpus; any consistent order gives right results, and
what it tells apart are the n-grams so frequent that meeting on them would be slow. Sets are cut
twice for their prefixes: first the n-grams alone are counted, then postings are made of those
that more than one prefix holds, told by a filter that is sized by their number.

Cases: a null or empty text, or one without words, has an empty set and is linked with nothing; a
text with fewer than n words has its whole sequence as its only n-gram; each row has the set of
its own text, so rows with the same id and text are one document, and an id with two texts has
a row for each; ties go to the smallest id; columns beside id and text are left out here
and pass through ``representatives`` whatever their names are; an empty table gives an empty one.
A null id has a set, and no component; for ``representatives`` each row without
an id is a document of its own, which links as others do and stays unless another one stands for it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparklake.llm import bits
from sparklake.llm.arrays import NOT_SPACE, Words, mapped, ngrams, slices, stored
from sparklake.llm.components import components

SKETCH_BITS = 20
BROADCAST_ROWS = 1_000_000  # rows of one or two ids that may be broadcast, 16 MB at most
CHUNKS = 64
PAIRS_AT_ONCE = 1_000_000  # pairs of rows that a task holds in memory
BLOCK = 4096  # members of an n-gram's bucket that are compared with each other in one piece


def sets_of(column: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    words = Words(column, NOT_SPACE)
    h, text = ngrams(words, n)
    order = np.argsort(text, kind="stable") if len(text) and (np.diff(text) < 0).any() else slice(None)
    h, text = h[order], text[order]
    first = np.searchsorted(text, np.arange(len(column) + 1))
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        own = np.sort(h[a:b])
        out.append(own[np.concatenate([[True], own[1:] != own[:-1]])] if b > a else own)
    return out


def _class(own: np.ndarray) -> tuple[int, int]:
    """128 bits that tell a set from others."""
    a, b = np.frombuffer(xxhash.xxh3_128_digest(own.tobytes()), np.int64).tolist()
    return a, b


def _signature(own: np.ndarray) -> int:
    """How many members lie in each of eight hash ranges, up to 255, in a byte each."""
    bins = np.bincount((own & np.uint64(7)).astype(np.int64), minlength=8)
    return int(np.minimum(bins, 255).astype(np.uint8).view(np.int64)[0])


def _described(n: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, np.int64)
        shift = np.uint64(64 - SKETCH_BITS)
        names = ["id", "n", "c1", "c2", "sig", "chunk", "counts"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        for batch in slices(batches, "text"):
            sets = sets_of(batch.column("text"), n)
            whole = np.concatenate([*sets, np.empty(0, np.uint64)])
            sketch += np.bincount((whole >> shift).astype(np.int64), minlength=len(sketch))
            classes = [_class(x) for x in sets]
            none = [None] * len(sets)
            facts = [[len(x) for x in sets], [c[0] for c in classes], [c[1] for c in classes], [_signature(x) for x in sets]]
            columns = [batch.column("id"), *facts, none, none]
            yield pa.RecordBatch.from_arrays(
                [x if isinstance(x, pa.Array) else pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names
            )
        parts = [(k, x) for k, x in enumerate(sketch.reshape(CHUNKS, -1)) if x.any()]
        none = [None] * len(parts)
        packed = [zlib.compress(x.astype(np.uint32).tobytes(), 1) for _, x in parts]
        columns = [none, none, none, none, none, [k for k, _ in parts], packed]
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names)

    return work


def _added(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros((1 << SKETCH_BITS) // CHUNKS, np.int64)
    for x in rows["counts"]:
        total += np.frombuffer(zlib.decompress(x), np.uint32)
    return pd.DataFrame({"chunk": [key[0]], "counts": [total.tobytes()]})


def described(docs: DataFrame, n: int) -> tuple[DataFrame, np.ndarray]:
    """(id, n, c1, c2, sig) of each document, and the counts of n-grams by hash bucket."""
    schema = "id bigint, n bigint, c1 bigint, c2 bigint, sig bigint, chunk int, counts binary"
    both = stored(mapped(docs, _described(n), schema), "ngram-sets")
    sums = both.where("chunk is not null").select("chunk", "counts").groupBy("chunk").applyInPandas(_added, "chunk int, counts binary")
    sketch = np.zeros((CHUNKS, (1 << SKETCH_BITS) // CHUNKS), np.int64)
    for row in sums.collect():  # at most CHUNKS rows of a fixed size
        sketch[row[0]] = np.frombuffer(row[1], np.int64)
    return both.where("chunk is null").select("id", "n", "c1", "c2", "sig"), sketch.ravel()


def needed(size, num: int, den: int):
    """The least overlap of a set of this size with any set linked to it."""
    return -(-num * size // den)


def _postings(n: int, num: int, den: int, sketch, shared=None):
    """The prefix n-grams of each set; with the filter ``shared``, those that it may hold alone.

    Without it only the n-grams are given.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, shift = sketch.value, np.uint64(64 - SKETCH_BITS)
        for batch in slices(batches, "text"):
            sets = [x for x in sets_of(batch.column("text"), n) if len(x)]
            size = np.array([len(x) for x in sets], np.int64)
            length = size - needed(size, num, den) + 1
            token = [np.empty(0, np.uint64)]
            for own, p in zip(sets, length.tolist(), strict=True):
                order = np.argsort(counts[(own >> shift).astype(np.int64)], kind="stable")
                token.append(own[order[:p]])
            token = np.concatenate(token).view(np.int64)
            if shared is None:
                yield pa.RecordBatch.from_arrays([pa.array(token)], ["token"])
                continue
            classes = np.array([_class(x)[0] for x in sets], np.int64)
            at = np.repeat(np.arange(len(sets)), length)
            pos = np.arange(len(at)) - np.repeat(np.cumsum(length) - length, length)
            keep = bits.probe(shared.value, token)
            columns = [x[keep] for x in (token, classes[at], size[at], pos)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["token", "c1", "n", "pos"])

    return work


def _perhaps(wanted):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(bits.probe(wanted.value, batch.column("key").to_numpy(zero_copy_only=False))))

    return work


def _filter(keys: DataFrame, key: str):
    """A filter over stored keys, sent to the tasks; its size follows their number up to a bound."""
    return keys.sparkSession.sparkContext.broadcast(bits.build(keys, key, bits.size_for(keys.count())))


def _set_rows(n: int, narrow: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            sets = sets_of(part.column("text"), n)
            sets = [((x >> np.uint64(32)).astype(np.uint32) if narrow else x).tobytes() for x in sets]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(sets, pa.binary())], ["id", "grams"])

    return work


def _small(rows: DataFrame) -> DataFrame:
    """Hint a broadcast of stored id rows while they are few; joins shuffle otherwise."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def grams_of(docs: DataFrame, ids: DataFrame, n: int, narrow: bool) -> DataFrame:
    """(id, grams) of the documents with these ids; ``narrow`` gives the upper halves of the hashes.

    A filter over the ids keeps most other texts from being cut and shuffled; an exact join
    follows. ``ids`` must be stored.
    """
    key = F.xxhash64("id").alias("key")
    rows = docs.where("id is not null").select("id", "text", key)
    likely = mapped(rows, _perhaps(_filter(ids.select(key), "key")), rows.schema)
    found = mapped(likely, _set_rows(n, narrow), "id bigint, grams binary")
    sets = stored(found.join(_small(ids), "id", "left_semi"), "ngram-grams")
    # ids of several rows are rare, and finding them is cheaper than moving all sets
    again = sets.groupBy("id").count().where("count > 1")
    return sets if again.isEmpty() else stored(sets.distinct(), "ngram-grams")


def _compared(num: int, den: int, narrow: bool):
    """Pairs that may link, and whether it is sure that they do.

    Halves of hashes match by chance about ``size * size / 2^32`` times a pair, and such matches
    only add: what fails by halves fails. What passes with many times that to spare is sure.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.uint32 if narrow else np.uint64
        for batch in batches:
            keep, sure = np.zeros(batch.num_rows, bool), np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"), strict=True)):
                one, two = np.frombuffer(x.as_buffer(), kind), np.frombuffer(y.as_buffer(), kind)
                if len(one) > len(two):
                    one, two = two, one
                at = np.searchsorted(two, one)
                shared = int((two[np.minimum(at, len(two) - 1)] == one).sum())
                spare = 8 + 8 * (len(one) * len(two) >> 32) if narrow else 0
                keep[i], sure[i] = (den * k >= num * (len(one) + len(two) - k) for k in (shared, shared - spare))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(pa.array(keep)) for c in ("a", "b")] + [pa.array(sure[keep])], ["a", "b", "sure"]
            )

    return work


def _set_pairs(pairs: DataFrame, docs: DataFrame, n: int, num: int, den: int, narrow: bool) -> DataFrame:
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    sets = grams_of(docs, stored(ids, "ngram-ids"), n, narrow)
    hubs = stored(pairs.select(F.col("a").alias("id")).distinct(), "ngram-ids")
    one = sets.join(_small(hubs), "id", "left_semi").select(F.col("id").alias("a"), F.col("grams").alias("x"))
    two = sets.select(F.col("id").alias("b"), F.col("grams").alias("y")).join(_small(pairs), "b")
    rows = two.join(one, "a").select("a", "b", "x", "y")
    return stored(mapped(rows, _compared(num, den, narrow), "a bigint, b bigint, sure boolean"), "ngram-links")


def verified(pairs: DataFrame, docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of ids whose sets reach the threshold.

    ``pairs`` must be stored. Each pair moves the set of ``b`` to that of ``a`` once, so a hub
    that is ``a`` of many pairs moves once itself. Halves of the hashes decide nearly all pairs;
    whole ones move for those near the threshold alone.
    """
    first = _set_pairs(pairs, docs, n, num, den, True)
    links, open_ = first.where("sure").select("a", "b"), first.where("NOT sure").select("a", "b")
    if open_.isEmpty():
        return links
    return links.union(_set_pairs(stored(open_, "ngram-pairs"), docs, n, num, den, False).select("a", "b"))


def _may_link(num: int, den: int, x: str, y: str) -> Column:
    """Length, positional and suffix filters for two rows that share an n-gram."""
    col = lambda side, name: F.col(f"{side}{name}")
    a, b = col(x, "n"), col(y, "n")
    least = F.floor((num * (a + b) + (num + den - 1)) / F.lit(num + den))
    fits = den * F.least(a, b) >= num * F.greatest(a, b)
    rest = F.least(a - col(x, "pos"), b - col(y, "pos"))
    apart = sum(
        F.abs(F.shiftrightunsigned(col(x, "sig"), 8 * k).bitwiseAND(255) - F.shiftrightunsigned(col(y, "sig"), 8 * k).bitwiseAND(255))
        for k in range(8)
    )
    return fits & (rest >= least) & (a + b - apart >= 2 * least)


def _block_pairs(num: int, den: int):
    """Candidate pairs within each run of rows with the same (token, one, two).

    All runs of a batch are handled at once, a bounded number of pairs at a time.
    """

    def tried(rows: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
        at = lambda c: (rows[c][i], rows[c][j])
        (a, b), (n, m), (p, q) = at("id"), at("n"), at("pos")
        least = -(-num * (n + m) // (num + den))
        ok = (rows["component"][i] != rows["component"][j]) & (den * np.minimum(n, m) >= num * np.maximum(n, m))
        ok &= (np.minimum(n - p, m - q) >= least) & (a != b)
        # in a run of two blocks only pairs across them are new
        ok &= (rows["one"][i] == rows["two"][i]) | (rows["block"][i] != rows["block"][j])
        i, j, near = i[ok], j[ok], (n + m - 2 * least)[ok]
        bins = rows["sig"].view(np.uint8).reshape(-1, 8)
        close = np.abs(bins[i].astype(np.int16) - bins[j]).sum(axis=1) <= near
        a, b = a[ok][close], b[ok][close]
        return np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1)

    def made(batch: pa.RecordBatch, end: int, edges: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The pairs of the rows before ``end``, whose runs end at ``edges``."""
        rows = {c: np.ascontiguousarray(batch.column(c).to_numpy(zero_copy_only=False)[:end]) for c in batch.schema.names}
        stop = edges[np.searchsorted(edges, np.arange(end), "right")]
        after = stop - np.arange(end) - 1  # rows of the run that follow each row
        part = (np.cumsum(after) - after) // PAIRS_AT_ONCE
        found = [np.empty((0, 2), np.int64)]
        for k in np.unique(part):
            own = np.flatnonzero(part == k)
            i = np.repeat(own, after[own])
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(after[own]) - after[own], after[own])
            found.append(tried(rows, i, j))
        pairs = np.unique(np.concatenate(found), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0], pa.int64()), pa.array(pairs[:, 1], pa.int64())], ["a", "b"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < 50_000:
                continue
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            key = [whole.column(c).to_numpy() for c in ("token", "one", "two")]
            edges = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
            if len(edges):  # the last run may go on in the next batch
                yield from made(whole, int(edges[-1]), edges)
                whole = whole.slice(int(edges[-1]))
            held, size = [whole], whole.num_rows
        if size:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            key = [whole.column(c).to_numpy() for c in ("token", "one", "two")]
            edges = np.append(np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1, whole.num_rows)
            yield from made(whole, whole.num_rows, edges)

    return work


def link_components(docs: DataFrame, n: int, num: int, den: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id) of each document.

    Sets link when ``den * intersection >= num * union``; a component's id is its least doc_id.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    info, sketch = described(rows, n)
    held = spark.sparkContext.broadcast(sketch)
    schema = "token bigint, c1 bigint, n bigint, pos bigint"
    whole = rows.where("id is not null").select("text")
    # most n-grams stand in one prefix alone: only their hashes are shuffled, the rest of a posting never is
    tokens = mapped(whole, _postings(n, num, den, held), "token bigint")
    again = stored(tokens.groupBy("token").agg(F.count("*").alias("n")).where("n > 1").select("token"), "ngram-again")
    postings = stored(mapped(whole, _postings(n, num, den, held, _filter(again, "token")), schema).distinct(), "ngram-postings")

    # n-grams that more than one class has in its prefix, and each one's hub
    near = F.shiftleft(F.least("pos", F.lit(2047)), 52).bitwiseOR(F.col("c1").bitwiseAND((1 << 52) - 1))
    buckets = postings.groupBy("token").agg(F.min(near).alias("hub"), F.max(near).alias("far")).where("hub <> far")
    buckets = stored(buckets.select("token", "hub"), "ngram-buckets")
    shared = postings.join(buckets, "token").withColumn("near", near)
    reps = info.where("n > 0 and id is not null").groupBy("c1", "c2").agg(F.min("id").alias("id"), F.min("n").alias("n"), F.min("sig").alias("sig"))
    reps = stored(reps, "ngram-classes")
    # by half of a class's hash and its size: a chance match only adds a candidate
    shared = stored(shared.join(reps.drop("c2"), ["c1", "n"]).select("token", "id", "n", "pos", "sig", (F.col("near") == F.col("hub")).alias("hub")), "ngram-shared")

    # first round: each class with the hub that it shares most n-grams with
    hubs = shared.where("hub").select("token", *[F.col(c).alias(f"h_{c}") for c in ("id", "n", "pos", "sig")])
    met = shared.where("not hub").join(hubs, "token").where(_may_link(num, den, "", "h_"))
    best = met.where("id <> h_id").groupBy("id", "h_id").agg(F.count("*").alias("shared"))
    best = best.groupBy("id").agg(F.max_by("h_id", F.struct("shared", -F.col("h_id"))).alias("h_id"))
    # once each, where two classes are each other's hub; a is the hub
    pairs = best.groupBy(F.least("id", "h_id").alias("lo"), F.greatest("id", "h_id").alias("hi")).agg(F.min("h_id").alias("a"))
    pairs = stored(pairs.select("a", (F.col("lo") + F.col("hi") - F.col("a")).alias("b")), "ngram-pairs")
    links = verified(pairs, rows, n, num, den)
    known = stored(components(links), "ngram-components")

    # second round: n-grams whose classes lie in different components
    placed = shared.join(known, "id", "left").withColumn("component", F.coalesce("component", "id")).drop("hub")
    split = placed.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("m"))
    split = split.where("lo < hi").select("token", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    apart = placed.join(split, "token").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    apart = apart.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    apart = apart.select(
        "token", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"),
        "block", "id", "component", "n", "pos", "sig",
    )
    grouped = apart.repartition("token", "one", "two").sortWithinPartitions("token", "one", "two")
    more = mapped(grouped, _block_pairs(num, den), "a bigint, b bigint").distinct()
    tried = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = more.join(tried, ["a", "b"], "left_anti")
    more = stored(more, "ngram-pairs")
    if more.isEmpty():
        final = known
    else:
        late = verified(more, rows, n, num, den)
        final = components(known.select(F.col("id").alias("a"), F.col("component").alias("b")).union(late))

    classes = reps.select("c1", "c2", "id").join(final, "id", "left").select("c1", "c2", F.coalesce("component", "id").alias("component"))
    return info.join(classes, ["c1", "c2"], "left").select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"),
    )


def _numbered(docs: DataFrame, known: Column) -> tuple[DataFrame, int, int]:
    """Rows without an id as (id, row), and the range, end exclusive, of ids that no other row has.

    Written once, so that the numbers hold; they follow the places of rows in partitions.
    """
    at = F.monotonically_increasing_id().alias("at")
    lone = stored(docs.where(known.isNull()).select(at, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")), "ngram-lone")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    parts, places = lone.agg(F.max(part) + 1, F.max(place) + 1).first()
    least, most = docs.agg(F.min(known), F.max(known)).first()
    size = parts * places
    start = 0 if most is None else most + 1 if most + size < 1 << 63 else least - size
    if start < -(1 << 63):
        raise ValueError("ids leave no room for rows without one")
    return lone.select((F.lit(start).cast("bigint") + place * F.lit(parts) + part).alias("id"), "row"), start, start + size


def _semi(docs: DataFrame, known: Column, stay: DataFrame) -> DataFrame:
    """The rows whose id is among ``stay``, as they are, whatever their columns' names."""
    rows = docs.select(known.alias("id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.join(stay, "id", "left_semi").select("row.*")


def representatives(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One document of each component, the one with the least id, with all columns.

    Rows without an id are compared like others; one of them stays only where none has an id.
    """
    known = F.col(f"`{doc_id}`").cast("bigint")
    if docs.where(known.isNull()).isEmpty():
        of = link_components(docs, n, num, den, text, doc_id)
        stay = of.where("doc_id = component_id").select(F.col("doc_id").alias("id")).distinct()
        return _semi(docs, known, stay)
    lone, start, end = _numbered(docs, known)
    both = docs.where(known.isNotNull()).select(known.alias("id"), F.col(f"`{text}`").alias("text"))
    both = both.union(lone.select("id", F.col(f"row.`{text}`")))
    of = link_components(both, n, num, den, "text", "id")
    own = F.struct(F.col("doc_id").between(start, end - 1), "doc_id")
    stay = of.groupBy("component_id").agg(F.min(own)["doc_id"].alias("id")).select("id")
    return _semi(docs, known, stay).union(lone.join(stay, "id", "left_semi").select("row.*"))


def op2(docs: DataFrame) -> DataFrame:
    """The registered query: 3-word shingles, linked from 90 in 100 on."""
    return link_components(docs.select("doc_id", "text"), 3, 90, 100)
