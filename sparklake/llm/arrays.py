"""Helpers of the operators here: settings, Arrow batches in small slices, words as arrays."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

MASK = np.uint64(0xFFFFFFFFFFFFFFFF)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)
# the low k bytes of a 64-bit word
_LOW = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def prepare(spark: SparkSession) -> SparkSession:
    """Keep Arrow batches small, as documents are long, and let Python workers find this package."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    # split a hot join key even where that costs one more shuffle afterwards
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    paths = [str(Path(__file__).resolve().parents[2]), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    spark.sparkContext.environment.setdefault("PYTHONPATH", os.pathsep.join(filter(None, paths)))
    return spark


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder in the one that ``spark.checkpoint.dir`` names.

    Only a local session without that setting gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return os.path.join(base, f"{purpose}-{uuid.uuid4().hex}")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends in files all can reach."""
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame, *columns: str, text: str = "text") -> DataFrame:
    """The named columns and the text, where a null text counts as empty."""
    return docs.select(*columns, F.coalesce(F.col(text), F.lit("")).alias(text))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Batches in slices of about ``most`` bytes of text; one row always fits in a slice."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)


def with_row(df: DataFrame, more: str, row: str = "row") -> StructType:
    """The schema of ``row`` as it is in ``df``, whatever its fields' names are, and of more columns."""
    return StructType([StructField(row, df.schema[row].dataType), *StructType.fromDDL(more).fields])


def mapped(
    df: DataFrame,
    work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str | StructType,
) -> DataFrame:
    """``mapInArrow`` over small batches."""
    prepare(df.sparkSession)
    return df.mapInArrow(work, schema)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and, one more than rows, the offsets of the texts."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]] if len(column) else np.empty(0, np.uint8)
    return data, ends - ends[0]


class Words:
    """The words of a column of texts: ``start`` and ``end`` in bytes, ``hash``, and ``first``.

    Words are runs of bytes for which ``is_word`` holds, after A-Z became lower case. Words of
    text ``i`` are ``first[i]:first[i + 1]``. The hash has 64 bits and takes in every byte.
    """

    def __init__(self, column: pa.Array, is_word: np.ndarray):
        data, self.offsets = text_bytes(column)
        self.data = _LOWER[data]
        inside = np.zeros(len(data) + 1, np.int8)
        inside[:-1] = is_word[self.data]
        edge = np.diff(inside, prepend=np.int8(0))
        begins, finishes = edge == 1, edge == -1
        cut = self.offsets[1:-1]
        cut = cut[(cut > 0) & (cut < len(data))]
        cut = cut[(inside[cut] == 1) & (inside[cut - 1] == 1)]  # words of two texts that touch
        begins[cut] = finishes[cut] = True
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(finishes)
        self.first = np.searchsorted(self.start, self.offsets)
        self.hash = hashes(self.data, self.start, self.end)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def text_of(self) -> np.ndarray:
        """The number of the text that each word is in."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.first))


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges, eight bytes at a time."""
    with np.errstate(over="ignore"):
        padded = np.zeros(len(data) + 8, np.uint8)
        padded[: len(data)] = data
        eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
        left = (end - start).astype(np.int64)
        h = left.astype(np.uint64) * _STEP + _M2
        at, todo = start.copy(), np.arange(len(start))
        while len(todo):
            h[todo] = mix((h[todo] ^ (eight[at] & _LOW[np.minimum(left, 8)])) * _STEP + _M1)
            on = left > 8
            todo, at, left = todo[on], at[on] + 8, left[on] - 8
        return h


def ngrams(words: Words, n: int, whole: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``n`` words and the number of the text each is in.

    With ``whole``, a text of fewer words, but not none, has its whole sequence as one run.
    """
    counts = np.diff(words.first)
    with np.errstate(over="ignore"):
        if len(words) >= n:
            h = mix(words.hash[: len(words) - n + 1] + np.uint64(n))
            for k in range(1, n):
                h = mix(h * _STEP ^ words.hash[k : len(words) - n + 1 + k])
            text = words.text_of
            same = text[: len(h)] == text[n - 1 :]
            h, text = h[same], text[: len(same)][same]
        else:
            h, text = np.empty(0, np.uint64), np.empty(0, np.int64)
        if whole:
            short = np.flatnonzero((counts > 0) & (counts < n))
            if len(short):
                one = mix(words.hash[words.first[short]] + counts[short].astype(np.uint64))
                for k in range(1, n - 1):
                    more = counts[short] > k
                    one[more] = mix(one[more] * _STEP ^ words.hash[words.first[short[more]] + k])
                h, text = np.concatenate([h, one]), np.concatenate([text, short])
    return h, text


#: Words are all but white space: `[^\x20\x09-\x0D]+`.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Words of letters, digits and everything outside ASCII, after lower-casing A-Z.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
