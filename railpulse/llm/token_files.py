"""Token ids in binary files that give up a short document without the rest.

A store is a folder. ``dictionary`` holds a zstandard dictionary trained on serialized id arrays, ``segments`` the
files, ``manifest`` a row per file. Every document is a zstandard frame of its own, compressed with the shared
dictionary, which is what makes frames of a few hundred bytes small. A segment file is, little-endian throughout:

====================  ======================================================================================
header, 104 bytes     magic ``RPTOKEN1``; SHA-256 of the dictionary; bytes of an id (2 or 4); end id; number of the
                      partition and of the segment in it; documents; ids; where the index begins; CRC-32 of the
                      index
frames                one per document, with a checksum
index                 per document its id (64 bits) and a byte that says it is null; then where each frame begins and
                      how many ids of the segment come before it, one entry more than documents (64 bits each)
line feed             closes the file, as Spark's text writer does
====================  ======================================================================================

Spark writes and reads the files (text writer and ``binaryFile``), so they go wherever Spark's tables go, and a task
that fails leaves nothing behind. Documents are dealt to partitions by ranges of ``doc_id``, ties by a hash of the
text and then by place, so no id makes a partition large; segments end at ``SEGMENT_TOKENS`` ids. The
manifest adds up the ids of the segments before each one.

The dictionary is fitted on at most ``SAMPLE_DOCS`` documents of at most ``SAMPLE_BYTES`` bytes, those with the
smallest hashes; it decides sizes and no result.

Defined cases: a null or empty text is its end id alone; rows with equal or null doc_id are documents of their own, null
first, rows that are alike in any order; a table without rows gives a store without documents; with too few texts for
training there is no dictionary; columns other than doc_id and text are not stored. A store whose
dictionary or index was changed is refused.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from railpulse.llm.packing import ENCODED_ROWS, encoder
from railpulse.operators.keyed import join_lookup
from railpulse.session import scratch_path

END_ID = 1
SEGMENT_TOKENS = 1 << 21
BATCH_BYTES = 8 << 20
LEVEL = 3
SAMPLE_DOCS = 2000
SAMPLE_BYTES = 1 << 16
DICTIONARY_BYTES = 1 << 16

_MAGIC = b"RPTOKEN1"
_HEADER = struct.Struct("<8s32sIIQQQQQI12x")


class BadStore(ValueError):
    """The files are not what their header says."""


def _text_slices(column: pa.Array) -> Iterator[list[str]]:
    """Texts of a batch in lists of about ``BATCH_BYTES``, however many rows that is."""
    held, size = [], 0
    for text in column:
        held.append(text.as_py() or "")
        size += len(held[-1])
        if size >= BATCH_BYTES or len(held) >= ENCODED_ROWS:
            yield held
            held, size = [], 0
    if held:
        yield held


# -- the dictionary ----------------------------------------------------------


def train_dictionary(docs: DataFrame, path: str, width: int, end_id: int) -> bytes:
    """A dictionary for id arrays; empty if there is too little to learn from."""
    # The smallest hashes are found among about twice as many as are wanted, and not by sorting all.
    rows = max(docs.count(), 2 * SAMPLE_DOCS)
    highest = ((1 << 64) - 1) * 2 * SAMPLE_DOCS // rows - (1 << 63)
    key = F.xxhash64("doc_id", "text")
    sample = (
        docs.where(F.octet_length("text").between(1, SAMPLE_BYTES)).select(key.alias("key"), "text")
        .where(F.col("key") <= F.lit(highest)).orderBy("key", "text").limit(SAMPLE_DOCS)
    )

    def serialize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in _text_slices(batch.column("text")):
                arrays = [_serialized(ids, width, end_id) for ids in encoder(path).encode(texts)]
                yield pa.RecordBatch.from_arrays([pa.array(arrays, pa.binary())], ["ids"])

    samples = [bytes(r[0]) for r in sample.mapInArrow(serialize, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


def _shared(dictionary: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def _serialized(ids: np.ndarray, width: int, end_id: int) -> bytes:
    return np.append(ids, np.uint32(end_id)).astype(f"<u{width}").tobytes()


# -- writing -----------------------------------------------------------------


class _Segment:
    """Frames and index of the documents of one file."""

    def __init__(self, compress: Callable[[bytes], bytes], digest: bytes, width: int, end_id: int, part: int, number: int):
        self.compress, self.digest, self.width, self.end_id = compress, digest, width, end_id
        self.part, self.number = part, number
        self.doc_ids: list[int | None] = []
        self.frames: list[bytes] = []
        self.lengths: list[int] = []
        self.tokens = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        raw = _serialized(ids, self.width, self.end_id)
        self.doc_ids.append(doc_id)
        self.frames.append(self.compress(raw))
        self.lengths.append(len(raw) // self.width)
        self.tokens += self.lengths[-1]

    def content(self) -> bytes:
        body = b"".join(self.frames)
        index = b"".join([
            np.array([d or 0 for d in self.doc_ids], "<i8").tobytes(),
            np.array([d is None for d in self.doc_ids], "u1").tobytes(),
            np.cumsum([_HEADER.size, *map(len, self.frames)], dtype="<u8").tobytes(),
            np.cumsum([0, *self.lengths], dtype="<u8").tobytes(),
        ])
        header = _HEADER.pack(
            _MAGIC, self.digest, self.width, self.end_id, self.part, self.number, len(self.frames), self.tokens,
            _HEADER.size + len(body), zlib.crc32(index),
        )
        return header + body + index


def write_tokens(docs: DataFrame, root: str, path: str, end_id: int = END_ID) -> None:
    """Write the ids of all ``docs``, an ``end_id`` after each, as a new store at ``root``."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    width = 2 if max(encoder(path).ends.size - 1, end_id) < 1 << 16 else 4
    dictionary = train_dictionary(docs, path, width, end_id)
    _write_bytes(spark.createDataFrame([(bytearray(dictionary),)], "content binary"), f"{root}/dictionary")
    digest = hashlib.sha256(dictionary).digest()
    segment_tokens = SEGMENT_TOKENS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=_shared(dictionary), write_checksum=True)
        number = 0
        segment = _Segment(compressor.compress, digest, width, end_id, part, number)

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([segment.content()], pa.binary())], ["content"])

        for batch in batches:
            doc_ids = iter(batch.column("doc_id").to_pylist())
            for texts in _text_slices(batch.column("text")):
                for ids in encoder(path).encode(texts):
                    segment.add(next(doc_ids), ids)
                    if segment.tokens >= segment_tokens:
                        yield closed()
                        number += 1
                        segment = _Segment(compressor.compress, digest, width, end_id, part, number)
        if segment.frames:
            yield closed()

    # Equal ids, a third of all rows perhaps, are told apart by text and place.
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc(), F.col("_place").asc()]
    placed = docs.withColumn("_place", F.monotonically_increasing_id())
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    _write_bytes(ordered.mapInArrow(run, "content binary"), f"{root}/segments")
    _manifest(spark, root).write.parquet(f"{root}/manifest")


def _write_bytes(rows: DataFrame, path: str) -> None:
    """One file per row, its bytes and a line feed."""
    rows.select(F.col("content").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def _manifest(spark: SparkSession, root: str) -> DataFrame:
    """A row per segment with the ids in all segments before it; two short sums, none over documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                header, doc_ids = _opened(content.as_buffer())
                known = [d for d in doc_ids if d is not None]
                row = [path, *header[4:8], min(known, default=None), max(known, default=None), len(known) < len(doc_ids)]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)

    names = ["path", "part", "segment", "n_docs", "n_tokens", "first_id", "last_id", "has_null"]
    types = [pa.string(), *[pa.int64()] * 6, pa.bool_()]
    schema = "path string, part long, segment long, n_docs long, n_tokens long, first_id long, last_id long, has_null boolean"
    found = _segments(spark, root).mapInArrow(run, schema).write
    listed = scratch_path(spark, "token-segments")
    found.parquet(listed)
    rows = spark.read.schema(schema).parquet(listed)
    within = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("_before"))
    inside = rows.withColumn("_inside", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    return inside.join(parts, "part").select(
        *names, (F.col("_before") + F.col("_inside")).alias("first_token"),
    )


# -- reading -----------------------------------------------------------------


def _segments(spark: SparkSession, root: str) -> DataFrame:
    files = spark.read.format("binaryFile").load(f"{root}/segments")
    return files.where(F.col("length") > _HEADER.size).select("path", "content")


def _opened(content: pa.Buffer) -> tuple[tuple, list[int | None]]:
    """Header and document ids of a segment, after its index was found whole."""
    if len(content) < _HEADER.size or bytes(content[:8]) != _MAGIC:
        raise BadStore("not a segment of token ids")
    header = _HEADER.unpack_from(content)
    docs, at = header[6], header[8]
    size = docs * 9 + (docs + 1) * 16
    if len(content) < at + size or zlib.crc32(content[at:at + size]) != header[9]:
        raise BadStore("the index of a segment was changed")
    doc_ids = np.frombuffer(content, "<i8", docs, at)
    null = np.frombuffer(content, "u1", docs, at + 8 * docs)
    return header, [None if n else d for d, n in zip(doc_ids.tolist(), null.tolist())]


def _frames(content: pa.Buffer, header: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Where each frame begins, and how many ids come before it in the segment."""
    docs = header[6]
    at = header[8] + 9 * docs
    return np.frombuffer(content, "<u8", docs + 1, at), np.frombuffer(content, "<u8", docs + 1, at + 8 * (docs + 1))


def _dictionary(spark: SparkSession, root: str) -> bytes:
    found = spark.read.format("binaryFile").load(f"{root}/dictionary").where(F.col("length") > 0).select("content").collect()
    return b"".join(bytes(r[0]) for r in found)[:-1]


def _documents(
    files: DataFrame, dictionary: bytes, finish: Callable[[np.ndarray], object], column: tuple[str, str, pa.DataType],
    wanted: frozenset[int | None] | None = None,
) -> DataFrame:
    """A row per document with ``finish`` of its ids; only the frames of ``wanted`` ids are decompressed."""
    digest = hashlib.sha256(dictionary).digest()
    name, sql, arrow = column

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompress = zstandard.ZstdDecompressor(dict_data=_shared(dictionary)).decompress
        for batch in batches:
            for value in batch.column("content"):
                content = value.as_buffer()
                header, doc_ids = _opened(content)
                if header[1] != digest:
                    raise BadStore("the segment was written with another dictionary")
                begins, before = _frames(content, header)
                rows = [i for i, d in enumerate(doc_ids) if wanted is None or d in wanted]
                for at in range(0, len(rows), 256):
                    some = rows[at:at + 256]
                    found = [
                        finish(np.frombuffer(decompress(content[begins[i]:begins[i + 1]]), f"<u{header[2]}").astype("<u4"))
                        for i in some
                    ]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([doc_ids[i] for i in some], pa.int64()),
                        *(pa.array([header[k]] * len(some), pa.int64()) for k in (4, 5)),
                        pa.array(before[some].astype(np.int64)),
                        pa.array(np.diff(before).astype(np.int64)[some]),
                        pa.array(found, arrow),
                    ], ["doc_id", "part", "segment", "_inside", "n_tokens", name])

    schema = f"doc_id long, part long, segment long, _inside long, n_tokens long, {name} {sql}"
    return files.mapInArrow(run, schema)


def _placed(spark: SparkSession, root: str, found: DataFrame, manifest: DataFrame, column: str) -> DataFrame:
    bases = manifest.select("part", "segment", "first_token")
    return join_lookup(found, bases, ["part", "segment"]).select(
        "doc_id", (F.col("first_token") + F.col("_inside")).alias("start"), "n_tokens", column,
    )


def read_tokens(spark: SparkSession, root: str) -> DataFrame:
    """All documents of a store: doc_id, start, n_tokens, ids (little-endian 32-bit numbers as bytes)."""
    found = _documents(
        _segments(spark, root), _dictionary(spark, root), lambda ids: ids.tobytes(), ("ids", "binary", pa.binary()),
    )
    return _placed(spark, root, found, spark.read.parquet(f"{root}/manifest"), "ids")


def find_tokens(spark: SparkSession, root: str, doc_ids: list[int | None]) -> DataFrame:
    """``read_tokens`` of a few documents: only files whose range holds one are read, only their frames decompressed."""
    manifest = spark.read.parquet(f"{root}/manifest")
    known = sorted({d for d in doc_ids if d is not None})
    reaches = F.lit(None in doc_ids) & F.col("has_null")
    for d in known:
        reaches = reaches | F.lit(d).between(F.col("first_id"), F.col("last_id"))
    paths = [r[0] for r in manifest.where(reaches).select("path").collect()]
    files = spark.read.format("binaryFile").load(paths or f"{root}/segments").select("path", "content")
    found = _documents(
        files if paths else files.limit(0), _dictionary(spark, root), lambda ids: ids.tobytes(),
        ("ids", "binary", pa.binary()), frozenset(doc_ids),
    )
    return _placed(spark, root, found, manifest, "ids")


def token_digest(docs: DataFrame, path: str) -> DataFrame:
    """Write ``docs`` as a store and describe every document as read back from its files."""
    spark = docs.sparkSession
    root = scratch_path(spark, "tokens")
    write_tokens(docs, root, path)
    found = _documents(
        _segments(spark, root), _dictionary(spark, root), lambda ids: zlib.crc32(ids), ("ids_crc32", "long", pa.int64()),
    )
    return _placed(spark, root, found, spark.read.parquet(f"{root}/manifest"), "ids_crc32")
