"""Secret scans with a linear-chain conditional random field.

Text is cut into tokens, which the field tags as beginning (B), inside (I) or outside (O) of a
secret. Features are a token's shape (length, kinds of characters, how evenly they are spread),
how much it looks like a key, the shapes of the words beside it, key words before it, and how much
code the file looks to hold. It is decoded by Viterbi. Where the unary score of O exceeds the
others by more than transitions can make up, O is certain and ends a chain, so that only the few
chains between are decoded step by step; the result is that of decoding the whole text.

It is trained by maximum likelihood on windows of tokens from a bounded sample: around matches of
the base patterns, and at hashed places of whole texts. As it shall find keys that no pattern
knows, windows with a match are learnt from three times: as they are, without the key words and
neighbours, and without the exact shape. A token that looks like a key but that no pattern has
matched counts as unknown, not as outside: the likelihood sums over its tags.

Patterns give base spans, which always stay; tagged spans that touch no base span are added as
``crf``.

Cases: a null or empty text has no spans; repeated rows are scanned alike; columns beside id and
text pass through whatever their names are; without any base match to learn from the field stays
untrained and adds nothing. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparklake.llm.arrays import mapped, mix, slices, stored, text_bytes

KINDS = ["assign", "access", "hex", "crf"]
# fixed values: the patterns and least lengths of the base kinds
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")  # the runs of 16 and more
HEX = re.compile(r"[0-9a-f]{32,}")
KEYWORD = re.compile(r"passw|secret|token|api_?key", re.I | re.A)
ASSIGNED = 8
LIKELY = "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]|AKIA[A-Z0-9]{12}|(?-i:[0-9a-f]{32})"

SAMPLE_DOCS = 2000  # at most so many documents that look like they have base matches, and as many of all, to learn from
SAMPLE_WINDOWS = 1500  # at most so many windows with a match, and as many others
DOC_WINDOWS = 16  # at most so many matches of one document have a window, those whose places hash lowest
WINDOW = 24  # tokens on either side of a place that are learnt from
EPOCHS, RATE, L2 = 150, 0.5, 1e-4
O, B, I = 0, 1, 2  # noqa: E741


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base matches."""
    out = []
    if KEYWORD.search(text):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGNED]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    return out + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


# kinds of bytes: 0 outside tokens, 1 lower, 2 upper, 3 digit, 4 symbols of keys, 5 other
_CLASS = np.full(256, 5, np.uint8)
_CLASS[0x61:0x7B], _CLASS[0x41:0x5B], _CLASS[0x30:0x3A] = 1, 2, 3
_CLASS[[ord(c) for c in "+/_-="]] = 4
_CLASS[[0x20, *range(0x09, 0x0E), *map(ord, "\"'`:,;()[]{}<>")]] = 0

LENGTHS = np.array([1, 4, 8, 12, 16, 20, 24, 32, 40, 64])
LOOKS = np.array([12, 16])  # lengths from which a token of letters and digits may be a key, and looks like one
UNKNOWN_LOOK = 2  # unlabelled tokens that look like keys at least so much may be some
N_SHAPE = 11 * 32 * 3
N_KEY = 3
N_FILE = 4 * (len(LOOKS) + 1)  # a look, and how much code the file holds


class Tokens:
    """Tokens of a column of texts with the numbers of their features."""

    def __init__(self, column: pa.Array):
        data, self.offsets = text_bytes(column)
        self.data = data
        kind = _CLASS[data]
        inside = np.zeros(len(data) + 1, np.int8)
        inside[:-1] = kind > 0
        edge = np.diff(inside, prepend=np.int8(0))
        begin, end = edge == 1, edge == -1
        cut = self.offsets[1:-1]
        cut = cut[(cut > 0) & (cut < len(data))]
        cut = cut[(inside[cut] == 1) & (inside[cut - 1] == 1)]
        begin[cut] = end[cut] = True
        self.start, self.end = np.flatnonzero(begin), np.flatnonzero(end)
        self.first = np.searchsorted(self.start, self.offsets)
        n = len(self.start)
        self.shape = np.zeros(n, np.int64)
        self.key = np.zeros(n, np.int64)
        self.look = np.zeros(n, np.int64)
        if not n:
            self.file = np.zeros(0, np.int64)
            return
        size = self.end - self.start
        # which classes a token has; lower case is what the others leave
        seen, rest = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for c in (2, 3, 4, 5):
            count = np.bincount(np.searchsorted(self.start, np.flatnonzero(kind == c), "right") - 1, minlength=n)
            rest += count
            seen |= (count > 0).astype(np.int64) << (c - 1)
            if c == 3:
                digits = count
        seen |= (rest < size).astype(np.int64)
        share = np.where(digits * 8 < size, 0, np.where(digits * 2 < size, 1, 2))
        self.shape = (np.searchsorted(LENGTHS, size, "right") * 32 + seen) * 3 + share
        # digits and letters, perhaps symbols of keys, nothing else
        mixed = (seen & 4 > 0) & (seen & 3 > 0) & (seen & 16 == 0)
        self.look = np.where(mixed, np.searchsorted(LOOKS, size, "right"), 0)
        self._keys(n)
        # a file's share of tokens with digits or key symbols, as a number from 0 to 3
        text = np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.first))
        odd = np.bincount(text, weights=(seen & 12) > 0, minlength=len(self.offsets) - 1)
        total = np.maximum(1, np.diff(self.first))
        self.file = np.searchsorted([0.02, 0.1, 0.3], odd / total, "right")[text]

    def _keys(self, n: int) -> None:
        """1 for key words, 2 where one of the two tokens before is a key word."""
        low = self.data.tobytes()
        for m in re.finditer(rb"(?i)passw(?:or)?d|secret|token|api_?key|auth|credential|private|akia", low):
            k = int(np.searchsorted(self.start, m.start(), "right")) - 1
            if 0 <= k < n and m.start() < self.end[k]:
                self.key[k] = 1
        marked = np.flatnonzero(self.key == 1)
        for step in (1, 2):
            after = marked + step
            after = after[after < n]
            self.key[after[self.key[after] == 0]] = 2

    def features(self) -> list[np.ndarray]:
        """For each template, a feature number of each token; a text's edge has shape 0."""
        shape = self.shape + 1
        last, following = np.zeros_like(shape), np.zeros_like(shape)
        last[1:], following[:-1] = shape[:-1], shape[1:]
        first = self.first[:-1][np.diff(self.first) > 0]
        last[first] = 0
        following[(self.first[1:][np.diff(self.first) > 0]) - 1] = 0
        kind = self.look * 4 + self.file
        base = 3 * (N_SHAPE + 1)
        return [
            shape, last + N_SHAPE + 1, following + 2 * (N_SHAPE + 1), base + self.key, base + N_KEY + kind, base + N_KEY + N_FILE + self.look,
        ]


N_TEMPLATES = 6
HIDDEN = 3 * (N_SHAPE + 1) + N_KEY + N_FILE + len(LOOKS) + 1  # stands for a feature that is left out; its weight stays 0
N_FEATURES = HIDDEN + 1
CONTEXT, EXACT = [1, 2, 3], [0]  # templates of the neighbours and key words; of the exact shape


class Field:
    """Weights of a linear-chain field over O, B and I."""

    def __init__(self, unary: np.ndarray, moves: np.ndarray):
        self.unary, self.moves = unary, moves  # features x 3, from x to
        self.moves[O, I] = -1e3  # nothing is inside without a beginning

    def scores(self, features: list[np.ndarray]) -> np.ndarray:
        return sum(self.unary[f] for f in features)

    def decode(self, scores: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The best tags of all tokens; ``first`` has where each text's tokens begin."""
        tags = np.zeros(len(scores), np.int8)
        usable = self.moves[self.moves > -999]
        begins = np.zeros(len(scores) + 1, bool)
        begins[first] = True
        # with O in place of another tag up to three transitions differ, as an I after it becomes B
        after = np.zeros(len(scores))
        after[:-1] = np.where(begins[1:-1], 0, np.maximum(0, scores[1:, I] - scores[1:, B]))
        open_ = scores[:, O] - scores[:, 1:].max(axis=1) <= 3 * (usable.max() - usable.min()) + after
        if not open_.any():
            return tags
        at = np.flatnonzero(open_)
        split = np.flatnonzero((np.diff(at) > 1) | begins[at[1:]]) + 1
        for run in np.split(at, split):
            tags[run] = self._viterbi(scores[run])
        return tags

    def _viterbi(self, scores: np.ndarray) -> np.ndarray:
        """Tags of a chain with O, or the text's edge, on both sides."""
        best = scores[0] + self.moves[O]
        back = np.zeros((len(scores), 3), np.int8)
        for k in range(1, len(scores)):
            through = best[:, None] + self.moves
            back[k] = through.argmax(axis=0)
            best = through.max(axis=0) + scores[k]
        tag = int((best + self.moves[:, O]).argmax())
        out = np.empty(len(scores), np.int8)
        for k in range(len(scores) - 1, -1, -1):
            out[k] = tag
            tag = back[k][tag]
        return out


def _expected(scores: np.ndarray, move: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expected tags of each token and expected moves, by forward and backward sums over padded chains."""
    n, length, _ = scores.shape
    forward, backward = np.empty((n, length, 3)), np.ones((n, length, 3))
    forward[:, 0] = scores[:, 0] * move[O]
    forward[:, 0] /= forward[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, length):
        now = forward[:, t - 1] @ move * scores[:, t]
        forward[:, t] = np.where(real[:, t, None], now / now.sum(axis=1, keepdims=True), forward[:, t - 1])
    for t in range(length - 2, -1, -1):
        now = (backward[:, t + 1] * scores[:, t + 1]) @ move.T
        backward[:, t] = np.where(real[:, t + 1, None], now / now.sum(axis=1, keepdims=True), backward[:, t])
    share = forward * backward
    share /= share.sum(axis=2, keepdims=True)
    edge = forward[:, :-1, :, None] * move * (scores[:, 1:] * backward[:, 1:])[:, :, None, :]
    edge /= edge.sum(axis=(2, 3), keepdims=True)
    return share * real[..., None], (edge * real[:, 1:, None, None]).sum(axis=(0, 1))


def train(features: np.ndarray, tags: np.ndarray, real: np.ndarray, unknown: np.ndarray | None = None) -> Field:
    """Maximum likelihood over padded windows: (windows, length, templates), (windows, length).

    The tags of ``unknown`` tokens are summed over: the gradient is what the known tags let
    expect, less what the field expects without them. Steps are scaled by their running size.
    """
    n, length, _ = features.shape
    unary, moves = np.zeros((N_FEATURES, 3)), np.zeros((3, 3))
    grown = [np.full_like(unary, 1e-8), np.full_like(moves, 1e-8)]
    gold = np.zeros((n, length, 3))
    np.put_along_axis(gold, tags[..., None].astype(np.int64), 1.0, axis=2)
    gold *= real[..., None]
    partly = np.zeros(n, bool) if unknown is None else (unknown & real).any(axis=1)
    allowed = gold[partly] if unknown is None else np.where(unknown[partly, :, None], 1.0, gold[partly])
    known_moves = np.einsum("nti,ntj->ij", gold[~partly, :-1], gold[~partly, 1:])
    flat = features.reshape(n * length, -1)
    for _ in range(EPOCHS):
        field = Field(unary, moves)
        scores = np.exp(np.clip(field.unary[features].sum(axis=2), -30, 30))
        move = np.exp(field.moves)
        share, edge = _expected(scores, move, real)
        want, want_moves = gold, known_moves
        if partly.any():
            want = gold.copy()
            want[partly], more = _expected(scores[partly] * np.where(real[partly, :, None], allowed, 1.0), move, real[partly])
            want_moves = known_moves + more
        wrong = (want - share).reshape(n * length, 3)
        step = np.zeros_like(unary)
        for k in range(flat.shape[1]):
            for tag in range(3):
                step[:, tag] += np.bincount(flat[:, k], weights=wrong[:, tag], minlength=N_FEATURES)
        step[HIDDEN] = 0
        steps = [step / n - L2 * unary, (want_moves - edge) / n - L2 * moves]
        for weights, g, size in zip((unary, moves), steps, grown, strict=True):
            size += g * g
            weights += RATE * g / np.sqrt(size)
        moves[O, I] = 0.0
    return Field(unary, moves)


def _offsets(data: np.ndarray, base: int, stop: int) -> np.ndarray:
    """Code points before each byte of a text."""
    return np.concatenate([[0], np.cumsum((data[base:stop] & 0xC0) != 0x80)])


def _place(seed: int, k: np.ndarray) -> np.ndarray:
    """Hashes of places in a text."""
    return mix(np.uint64(seed & 0xFFFFFFFFFFFFFFFF) + k.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _tagged(tokens: Tokens, i: int, text: str, kinds: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The tags of a text's tokens by the base patterns, and the tokens that begin a match."""
    a, b = tokens.first[i], tokens.first[i + 1]
    tags = np.zeros(b - a, np.int64)
    spans = [x for x in base_spans(text) if x[0] in kinds]
    if spans:
        at = _offsets(tokens.data, tokens.offsets[i], tokens.offsets[i + 1])
        start = at[tokens.start[a:b] - tokens.offsets[i]]
        end = at[tokens.end[a:b] - tokens.offsets[i]]
        for kind, s, e in spans:
            if kind == "assign":  # the value, not the key word
                s = ASSIGN.match(text, s).start(2)
            low, high = np.searchsorted(end, s, "right"), np.searchsorted(start, e, "left")
            tags[low:high] = I
            tags[low : low + 1] = B
    return tags, np.flatnonzero(tags == B)


def _examples(kinds: tuple[str, ...]):
    """Windows of a document: around its matches, or at a hashed place of the whole text."""
    length = 2 * WINDOW

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            tokens = Tokens(batch.column("text"))
            features = np.stack(tokens.features(), axis=1) if len(tokens.start) else np.zeros((0, N_TEMPLATES), np.int64)
            out = []
            for i, text in enumerate(batch.column("text").to_pylist()):
                a, b = tokens.first[i], tokens.first[i + 1]
                if a == b:
                    continue
                seed = batch.column("key")[i].as_py()
                tags, matches = _tagged(tokens, i, text, kinds)
                unknown = (tags == O) & (tokens.look[a:b] >= UNKNOWN_LOOK)
                if batch.column("likely")[i].as_py():
                    order = _place(seed, matches)
                    centres = matches[np.argsort(order, kind="stable")[:DOC_WINDOWS]]
                else:
                    centres = (_place(seed, np.zeros(1)) % np.uint64(b - a)).astype(np.int64)
                for centre in centres.tolist():
                    low = max(0, min(centre - WINDOW, b - a - length))
                    own = slice(low, min(b - a, low + length))
                    rank = int(_place(seed, np.array([centre + 1]))[0] >> np.uint64(1))
                    made = (features[a:b][own].astype(np.int32), tags[own].astype(np.int8), unknown[own].astype(np.int8))
                    out.append((rank, bool(tags[own].any()), *[x.tobytes() for x in made]))
            types = [pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
            columns = [pa.array([x[k] for x in out], t) for k, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays(columns, ["place", "found", "features", "tags", "unknown"])

    return work


def fit(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", sample: int = SAMPLE_DOCS, kinds: tuple[str, ...] = tuple(KINDS[:3])
) -> Field | None:
    """Train on windows of at most ``sample`` documents that look like they have base matches, and as many of all.

    Documents are drawn over the whole table by a hash of id and text, before any text moves. Only
    matches of ``kinds`` are labels; without any, None.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    df = docs.select(F.xxhash64(F.col(f"`{doc_id}`"), body).alias("key"), body.alias("text"))
    drawn = [
        part.select("key").orderBy("key").limit(sample).withColumn("likely", F.lit(likely))
        for part, likely in ((df.where(F.col("text").rlike(LIKELY)), True), (df, False))
    ]
    wanted = F.broadcast(stored(drawn[0].union(drawn[1]).distinct(), "secret-keys"))  # bounded by the sample
    schema = "place bigint, found boolean, features binary, tags binary, unknown binary"
    windows = stored(mapped(df.join(wanted, "key").select("key", "likely", "text"), _examples(kinds), schema).distinct(), "secret-windows")
    rows = []
    for found in (True, False):
        rows += windows.where(F.col("found") == found).orderBy("place", "features").limit(SAMPLE_WINDOWS).collect()
    if not any(r["found"] for r in rows):
        return None
    length = 2 * WINDOW
    features = np.full((len(rows), length, N_TEMPLATES), HIDDEN, np.int64)
    tags, real = np.zeros((len(rows), length), np.int64), np.zeros((len(rows), length), bool)
    unknown = np.zeros((len(rows), length), bool)
    for i, r in enumerate(rows):
        own = np.frombuffer(r["features"], np.int32).reshape(-1, N_TEMPLATES)
        k = len(own)
        features[i, :k], tags[i, :k], real[i, :k] = own, np.frombuffer(r["tags"], np.int8), True
        unknown[i, :k] = np.frombuffer(r["unknown"], np.int8) > 0
    matched = np.array([r["found"] for r in rows])
    parts = [features]
    for hidden in (CONTEXT, EXACT):
        part = features[matched].copy()
        part[..., hidden] = HIDDEN
        parts.append(part)
    again = lambda x: np.concatenate([x, x[matched], x[matched]])
    return train(np.concatenate(parts), again(tags), again(real), again(unknown))


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _scanner(field):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf: Field | None = field.value
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            found = [base_spans(text) for text in texts]
            if crf is not None:
                tokens = Tokens(batch.column("text"))
                tags = crf.decode(crf.scores(tokens.features()), tokens.first[:-1])
                begins = np.flatnonzero(tags == B)
                marked = np.flatnonzero(tags != O)
                gaps = np.append(marked[np.flatnonzero(np.diff(marked, append=len(tags) + 1) > 1)], len(tags))
                ends = np.minimum(gaps[np.searchsorted(gaps, begins)], np.append(begins[1:], len(tags)) - 1) if len(begins) else begins
                of = np.searchsorted(tokens.first, begins, "right") - 1
                for i, a, b in zip(of.tolist(), begins.tolist(), ends.tolist(), strict=True):
                    base, stop = int(tokens.offsets[i]), int(tokens.offsets[i + 1])
                    raw = tokens.data[base:stop].tobytes()
                    s = len(raw[: tokens.start[a] - base].decode())
                    e = s + len(raw[tokens.start[a] - base : tokens.end[b] - base].decode())
                    if not any(s < y and x < e for k, x, y in found[i] if k != "crf"):
                        found[i].append(("crf", s, e))
            out = [[{"kind": k, "start": a, "end": b} for k, a, b in sorted(x, key=lambda s: (s[1], KINDS.index(s[0])))] for x in found]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, SPANS)], ["row", "spans"])

    return work


def scan(docs: DataFrame, field: Field | None, text: str = "text") -> DataFrame:
    """``row`` (a struct of all columns but the text) and the ``spans`` (kind, start, end)."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(0).alias("_none")]
    df = docs.select(F.struct(*rest).alias("row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(field)
    row = df.schema["row"].dataType.simpleString()
    return mapped(df, _scanner(held), f"row {row}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def op4(docs: DataFrame) -> DataFrame:
    """The digest columns of the registered query."""
    docs = docs.select("doc_id", "text")
    found = scan(docs, fit(docs))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint")
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    named = lambda spans: F.array_join(F.transform(spans, one), ",")
    return found.select(
        "row.doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(named(F.filter("spans", lambda s: s["kind"] != "crf")), 256).alias("base_sha256"),
        named(F.col("spans")).alias("spans"),
    )
