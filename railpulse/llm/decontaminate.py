"""Benchmark items inside documents, by a size-partitioned MinHash containment search.

An item is contained in a document if at least ``threshold`` of its distinct
word shingles (five words) occur there. Items are partitioned by size. An item of
n shingles is indexed by its MinHash sketch, its k smallest shingle hashes, with
k = n - ceil(threshold * n) + 1 set for the size: whatever shingles a
containing document lacks, it has one of these. So every container is a
candidate, at any document length, and only documents that share a sketch value
are verified: their words are compared as text, shingle by shingle.

Documents are never shuffled. The sketches of at most ``BLOCK_WORDS`` words of
items at a time are broadcast; more items mean more blocks, each a pass over the
documents.

Defined cases: an item with one to four words is contained where its words stand
in a row; an item without words (or null) is contained nowhere; repeated items
and repeated documents each give their own rows; empty tables give no rows.
When documents are dropped, rows that share a doc_id are one document with several
texts and go together; a row with null doc_id is a document of its own, decided by
its text.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from railpulse.llm.common import SHINGLE_WORDS, Words, mixed, only, over_batches, small_batches, stored, utf8, whole_hash

THRESHOLD = 0.75
BLOCK_WORDS = 2_000_000
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {i: i + 32 for i in range(65, 91)}
_BITS = 20


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").translate(_LOWER))


def grams(words: Sequence[str], size: int) -> set[tuple[str, ...]]:
    return set(zip(*(words[j:] for j in range(size))))


class Index:
    """Sketches of a block of items, by shingle size."""

    def __init__(self, items: list[tuple[int, str | None]], threshold: float):
        self.threshold, self.ids, self.grams = threshold, [], []
        entries: dict[int, list[tuple[int, int]]] = {}
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            size = min(SHINGLE_WORDS, len(words))
            shingles = grams(words, size)
            hashes = np.unique(_gram_hashes(text, size))
            kept = hashes[:len(shingles) - math.ceil(threshold * len(shingles)) + 1]
            entries.setdefault(size, []).extend((int(h), len(self.ids)) for h in kept)
            self.ids.append(item_id)
            self.grams.append((size, shingles))
        self.tables = {}
        for size, pairs in entries.items():
            pairs.sort()
            values = np.array([h for h, _ in pairs], np.uint64)
            members = np.array([i for _, i in pairs], np.int64)
            filter_ = np.zeros(1 << _BITS, bool)
            filter_[(values & np.uint64((1 << _BITS) - 1)).astype(np.int64)] = True
            self.tables[size] = values, members, filter_

    def candidates(self, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``hashes`` that hit a sketch, and the items hit."""
        values, members, filter_ = self.tables[size]
        near = np.flatnonzero(filter_[(hashes & np.uint64((1 << _BITS) - 1)).astype(np.int64)])
        low = np.searchsorted(values, hashes[near], "left")
        counts = np.searchsorted(values, hashes[near], "right") - low
        total = int(counts.sum())
        steps = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
        return np.repeat(near, counts), members[np.repeat(low, counts) + steps]


def _gram_hashes(text: str, size: int) -> np.ndarray:
    return _batch_grams(Words(*utf8(pa.array([text], pa.string()))), size)[0]


def _batch_grams(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, and the first of each text."""
    if size == SHINGLE_WORDS:
        return words.shingles()
    at = np.arange(len(words.hashes) - size + 1)
    text_of = np.searchsorted(words.first, at, "right") - 1
    at = at[at + size <= words.first[text_of + 1]]
    # The numbers of ``whole_hash``, for all runs at once.
    parts = np.zeros(len(at), np.uint64)
    for j in range(size):
        unit = np.zeros(j + 1, np.uint64)
        unit[j] = 1
        factor = np.uint64((int(whole_hash(unit)) - int(whole_hash(np.zeros(j + 1, np.uint64)))) & 0xFFFFFFFFFFFFFFFF)
        parts += words.hashes[at + j] * factor
    parts += whole_hash(np.zeros(size, np.uint64))
    return mixed(parts), np.searchsorted(at, words.first)


def find_contained(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, key: str = "doc_id") -> DataFrame:
    """Rows (doc_id, item_id, n_found, n_shingles, containment) of items inside documents.

    ``key`` names the column that stands in the place of doc_id.
    """
    spark = docs.sparkSession
    small_batches(spark)
    items = items.select("item_id", "text")
    total = items.agg(F.sum(F.size(F.split("text", r"[\x20\x09-\x0D]+")))).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_WORDS))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    found = [
        _search(docs, Index([tuple(r) for r in items.where(block == b).collect()], threshold), key)
        for b in range(blocks)
    ]
    return functools.reduce(DataFrame.unionByName, found)


def _search(docs: DataFrame, index: Index, key: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)
    names = [key, "item_id", "n_found", "n_shingles", "containment"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        index = shared.value
        texts = batch.column("text")
        words = Words(*utf8(texts))
        pairs = set()
        for size in index.tables:
            hashes, first = _batch_grams(words, size)
            at, items = index.candidates(hashes, size)
            pairs.update(zip((np.searchsorted(first, at, "right") - 1).tolist(), items.tolist()))
        rows, last, own = [], None, {}
        for text, item in sorted(pairs):
            if text != last:
                last, own, spelled = text, {}, words_of(texts[text].as_py())
            size, shingles = index.grams[item]
            if size not in own:
                own[size] = grams(spelled, size)
            found = len(shingles & own[size])
            if found >= index.threshold * len(shingles):
                rows.append((text, index.ids[item], found, len(shingles), found / len(shingles)))
        if not rows:
            return None
        doc, *rest = zip(*rows)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        return pa.RecordBatch.from_arrays(
            [batch.column(key).take(pa.array(doc, pa.int64())), *(pa.array(c, k) for c, k in zip(rest, kinds))],
            names,
        )

    return over_batches(
        docs.select(key, "text"), work,
        f"{key} {docs.schema[key].dataType.simpleString()}, item_id long, n_found long, n_shingles long, containment double",
    )


def decontaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents without those that contain an item."""
    # Null never equals null, so a row without doc_id goes by the digest of its text, which is no number.
    docs = docs.withColumn("_document", F.coalesce(F.col("doc_id").cast("string"), F.sha2("text", 256)))
    found = stored(find_contained(docs, items, threshold, "_document").select("_document").distinct(), "contaminated")
    return only(docs, found, "_document", "left_anti").drop("_document")
