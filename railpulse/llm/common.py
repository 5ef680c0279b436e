"""Whole texts as byte buffers, hashed words and word shingles, stored tables.

A batch of texts is handled as one buffer of UTF-8 bytes with offsets. Words are
runs of bytes other than space and the controls 9 to 13; A-Z count as a-z. A
null text is an empty text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from railpulse.session import scratch_path

SHINGLE_WORDS = 5
BATCH_ROWS = 512
BATCH_BYTES = 16 << 20
HASHED_AT_ONCE = 1 << 20  # bytes of text
BROADCAST_KEYS = 500_000

_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}
_LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER[65:91] += np.uint64(32)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the rows and bytes that a Python worker holds at once, as texts may be long; one row is never split."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read back: its lineage ends here."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def gathered(df: DataFrame, rows: int, each: int = 250_000) -> DataFrame:
    """``df``, of at most ``rows`` counted rows, in no more partitions than it takes at ``each`` rows in one.

    A shuffle has as many partitions as the largest needs; a small table should not be written as that many files.
    """
    return df.coalesce(max(1, -(-rows // each)))


def only(rows: DataFrame, keys: DataFrame, key: str, how: str) -> DataFrame:
    """``rows`` joined to a table of few bytes per key.

    ``keys`` are broadcast if they were counted to be few; otherwise both sides are shuffled.
    """
    small = keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    return rows.join(F.broadcast(keys) if small else keys, key, how)


def over_batches(
    df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """``work`` on every Arrow batch of ``df``; batches without rows are skipped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = found = None
        for batch in batches:
            if batch.num_rows:
                found = work(batch)
                if found is not None and found.num_rows:
                    yield found
        del batch, found
        give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return a worker's freed memory to the machine; at the end of a task, as the worker outlives it and stays as large otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only the GNU library needs it
    if trim is not None:
        trim(0)


def held_out(doc_id: str = "doc_id") -> F.Column:
    """True for the rows whose labels nothing is learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a column, and where each begins (one more than texts)."""
    binary = pa.types.is_binary(column.type)
    column = pc.fill_null(column.cast(pa.large_binary() if binary else pa.large_string()), b"" if binary else "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if column.buffers()[2] is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (finaliser of a multiply-shift generator)."""
    x = values.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct numbers; for 64-bit numbers sorting is several times as fast as the hashing of ``np.unique``."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def powers(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64, for i below n."""
    key = str(base)
    if key not in _POWERS or _POWERS[key].shape[1] < n:
        size = max(n, 1 << 20)
        table = np.empty((2, size), np.uint64)
        for row, factor in enumerate((base, pow(base, -1, 1 << 64))):
            table[row] = np.uint64(factor)
            table[row, 0] = 1
            np.cumprod(table[row], out=table[row])
        _POWERS[key] = table
    return _POWERS[key][0, :n], _POWERS[key][1, :n]


def prefix_hashes(values: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Sums by which ``span_hashes`` finds the hash of any span; ``values`` are not 0."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values), base)[0], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    """The same number for equal spans, wherever they begin."""
    return mixed((sums[ends] - sums[starts]) * powers(len(sums), base)[1][starts])


class Words:
    """Words of a batch: ``starts`` and ``ends`` in bytes, a hash of each, ``first`` word of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        inside = ~_SPACE[data]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        begins, ends = offsets[:-1], offsets[1:]
        filled = ends > begins
        opens[begins[filled]] = inside[begins[filled]]
        closes[ends[filled] - 1] = inside[ends[filled] - 1]
        self.starts = np.flatnonzero(opens)
        self.ends = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.hashes = np.zeros(len(self.starts), np.uint64)
        # A span's hash does not depend on where it begins, so words are hashed some at a time, with sums of their own.
        at = 0
        while at < len(self.starts):
            low = self.starts[at]
            upto = max(at + 1, int(np.searchsorted(self.ends, low + HASHED_AT_ONCE, "right")))
            sums = prefix_hashes(_LOWER[data[low:self.ends[upto - 1]]])
            self.hashes[at:upto] = span_hashes(sums, self.starts[at:upto] - low, self.ends[at:upto] - low)
            at = upto

    def shingles(self, words: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all shingles in order, and the first one of each text.

        A text with fewer words has its whole sequence as its only shingle; one
        without words has none.
        """
        counts = np.diff(self.first)
        total = len(self.hashes)
        padded = np.concatenate([self.hashes, np.zeros(words, np.uint64)])
        full = np.zeros(total, np.uint64)
        for j in range(words):
            full += padded[j:j + total] * np.uint64(_multiplier(j))
        per_text = np.where(counts >= words, counts - words + 1, np.minimum(counts, 1))
        first = np.concatenate([[0], np.cumsum(per_text)])
        text_of = np.repeat(np.arange(len(counts)), per_text)
        at = self.first[:-1][text_of] + np.arange(first[-1]) - first[:-1][text_of]
        found = full[at]
        for text in np.flatnonzero((counts > 0) & (counts < words)):
            found[first[text]] = whole_hash(self.hashes[self.first[text]:self.first[text + 1]])
        return mixed(found), first


def _multiplier(j: int) -> int:
    return pow(0xD6E8FEB86659FD93, j + 1, 1 << 64)


def whole_hash(hashes: np.ndarray) -> np.uint64:
    """Number of a sequence shorter than a shingle; its length is part of it."""
    total = 0x5851F42D4C957F2D * len(hashes)
    for j, h in enumerate(hashes.tolist()):
        total += h * _multiplier(j)
    return np.uint64(total & 0xFFFFFFFFFFFFFFFF)
