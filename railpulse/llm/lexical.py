"""Ranked search of documents by the terms of items, exact, over K2-treaps.

Documents are cut into shards of ``SHARD_DOCS``. A shard is a grid of terms and documents whose cells hold the
impact of the term on the document's score, compressed as a K2-treap (``treap``). An item descends the
paths of all its terms together, best document range first, and stops when no range can reach its best documents;
the best of all shards are ranked once more. Impacts are whole numbers, so scores do not depend on the order of sums.

Terms are runs of digits, ASCII letters (A-Z as a-z) and characters beyond ASCII. The weight of a term and the norm of
a document follow from counts over all documents. Rows of the grid are the terms that occur in items: another term can
change no score, except through a document's length, and that counts every term.

Items are taken in blocks of about ``BLOCK_BYTES`` of text, one block after the other. A block's terms, at most
one for every two bytes, are all that is sent to every task, and the index of a block is read where it lies.

Defined cases: null or empty texts have no terms; a document without terms counts nowhere, and an item without any, or
with terms that no document has, gives no rows; repeated rows of ``documents`` are ranked each for itself, in any
order, null doc_id first; repeated rows of items (item_id and text) are one item; other columns are not looked at. Of
documents with equal scores the smaller doc_id comes first. Without documents there are no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from railpulse.llm.common import stored
from railpulse.llm.treap import Treap, compressed

BEST = 20
SHARD_DOCS = 1 << 12
BLOCK_BYTES = 4 << 20
SLICE_BYTES = 8 << 20

_TO_TERMS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_SCALE = 1_000_000_000


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TO_TERMS).split()


def term_weights(df: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def norms(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """100 for a document of mean length, 75 for a very short one."""
    return np.array([75 + 25 * x * documents // total for x in n.tolist()], np.int64)


def impacts(tf: np.ndarray, weight: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """What a term adds to a document's score; all in whole numbers."""
    return weight * ((_SCALE * tf) // (1000 * tf + 12 * norm))


# -- postings ----------------------------------------------------------------


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document with terms: how many, and which of the vocabulary's how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.get
        for batch in batches:
            rows, n, terms, tfs, size = [], [], [], [], 0

            def found() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([
                    batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(n, pa.int64()),
                    pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64())),
                ], ["doc_id", "n", "terms", "tfs"])

            for row, text in enumerate(batch.column("text")):
                words = terms_of(text.as_py())
                if words:
                    counted = Counter(map(known, words))
                    counted.pop(None, None)
                    rows.append(row)
                    n.append(len(words))
                    terms.append(list(counted.keys()))
                    tfs.append(list(counted.values()))
                    size += 16 * len(counted) + 16
                    if size > SLICE_BYTES:
                        yield found()
                        rows, n, terms, tfs, size = [], [], [], [], 0
            if rows:
                yield found()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


# -- index -------------------------------------------------------------------


def index(posted: DataFrame, weights: np.ndarray, documents: int, total: int) -> DataFrame:
    """A row per shard: the doc_ids of its columns in ascending order, and its treap."""
    shard_docs = SHARD_DOCS

    def shard(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.sort_by([("_null", "descending"), ("doc_id", "ascending")])
        lists = rows.column("terms").combine_chunks()
        length = np.diff(lists.offsets.to_numpy())
        term = lists.flatten().to_numpy().astype(np.int64)
        tf = rows.column("tfs").combine_chunks().flatten().to_numpy()
        column = np.repeat(np.arange(rows.num_rows), length)
        norm = np.repeat(norms(rows.column("n").to_numpy(), documents, total), length)
        weight = impacts(tf, weights[term], norm)
        some = weight > 0
        data = compressed(term[some], column[some], weight[some])
        ids = rows.column("doc_id").combine_chunks().cast(pa.int64())
        listed = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
        return pa.RecordBatch.from_arrays([listed, pa.array([data], pa.binary())], ["doc_ids", "treap"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, shard_docs - count)
                batch = batch.slice(part.num_rows)
                held.append(part)
                count += part.num_rows
                if count == shard_docs:
                    yield shard(pa.Table.from_batches(held))
                    held, count = [], 0
        if held:
            yield shard(pa.Table.from_batches(held))

    marked = posted.withColumn("_null", F.col("doc_id").isNull().cast("int"))
    return marked.mapInArrow(run, "doc_ids array<long>, treap binary")


def search(shards: DataFrame, items: list[tuple[np.ndarray, np.ndarray]], best: int = BEST) -> DataFrame:
    """Rows (item, doc_id, score): the best documents of every shard for every item, given as terms and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, data in zip(batch.column("doc_ids"), batch.column("treap")):
                grid = Treap(data.as_buffer())
                found = [grid.best_columns(terms, times, best) for terms, times in items]
                item = np.repeat(np.arange(len(items)), [len(c) for c, _ in found])
                columns = np.concatenate([c for c, _ in found])
                score = np.concatenate([s for _, s in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(item), ids.values.take(pa.array(columns)), pa.array(score)], ["item", "doc_id", "score"],
                )

    return shards.mapInArrow(run, "item long, doc_id long, score long")


def ranked(found: DataFrame, best: int = BEST) -> DataFrame:
    """The best of all shards. Each input partition keeps its own best before the shuffle."""
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


# -- all items ---------------------------------------------------------------


def _block(docs: DataFrame, rows: list, best: int) -> DataFrame:
    """Results of a block of items."""
    spark = docs.sparkSession
    counted = [Counter(terms_of(r.text)) for r in rows]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*counted)))}
    posted = stored(postings(docs, vocabulary), "postings")
    documents, total = posted.agg(F.count(F.lit(1)), F.sum("n")).first()
    df = np.zeros(len(vocabulary), np.int64)
    for term, count in posted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[term] = count
    # A shard is cut within a partition; partitions are put together where they are smaller than that.
    gathered = posted.coalesce(max(1, -(-documents // SHARD_DOCS)))
    shards = stored(index(gathered, term_weights(df, documents or 1), documents, total or 1), "treaps")
    # Terms no document has have no cells, and some would lie outside the grid.
    numbered = [{vocabulary[t]: c for t, c in terms.items() if df[vocabulary[t]]} for terms in counted]
    items = [(np.array(list(x), np.int64), np.array(list(x.values()), np.int64)) for x in numbered]
    names = spark.createDataFrame(list(enumerate(r.item_id for r in rows)), "item long, item_id long")
    top = ranked(search(shards, items, best), best)
    return top.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int"), "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """The ``best`` documents of every item by score: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    asked = items.where(F.octet_length("text") > 0).select("item_id", "text").distinct()
    size = asked.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, blocks)))
    found = []
    for number in range(blocks):
        rows = asked.where(block == number).collect()
        if rows:
            found.append(stored(_block(docs, rows, best), "ranked"))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, found)
