"""Long exact repeats: bytes covered by a string of ``LENGTH`` bytes that also starts elsewhere.

Bringing equal strings together. Of the ``ANCHOR``-byte grams in a string, the one
with the smallest hash (the leftmost of equals) is its anchor, so equal strings
have equal anchors at the same place. Consecutive starts with one anchor form a
window. Windows, as hashes, are counted by anchor and content: a window that
occurs twice is a repeat as a whole. An anchor with windows that differ sends one
of each, as bytes, to a task, which builds a run-length index of them (``rindex``)
and marks the starts that match elsewhere for ``LENGTH`` bytes or more. All other
windows hold no repeat.

Skew. Counts combine before they shuffle, so a text with a third of all copies is
a few rows. An anchor with more than ``MAX_VARIANTS`` different windows (a passage
shared by very many texts) is not gathered: the strings at its starts are counted
by hash instead, which is exact as well and splits over all tasks.

Defined cases: a null text is empty; a text shorter than ``LENGTH`` bytes keeps all
its bytes; repeated rows are repeats of each other; rows with equal doc_id and
different texts are told apart; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from railpulse.llm.common import over_batches, prefix_hashes, small_batches, span_hashes, stored, utf8
from railpulse.llm.rindex import RunLengthIndex

LENGTH = 400
ANCHOR = 100
MAX_VARIANTS = 1_000
PIECE_BYTES = 4 << 20
INDEX_BYTES = 1 << 20
KEY = ["_k1", "_k2"]


def keyed(docs: DataFrame) -> DataFrame:
    """Rows told apart by id and text."""
    return docs.select(
        "doc_id", "text", F.xxhash64("doc_id", "text").alias("_k1"), F.xxhash64("text", F.lit(1), "doc_id").alias("_k2")
    )


def _pieces(offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, int]]:
    """(text, begin, end) in bytes: long texts in pieces whose starts do not overlap."""
    for text, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        at = a
        while b - at >= length:
            yield text, at, min(b, at + PIECE_BYTES + length - 1)
            at += PIECE_BYTES


def windows_of(data: np.ndarray, offsets: np.ndarray, length: int, anchor: int):
    """Arrays (text, start in its text, starts, anchor hash, window hash) of all windows of a batch."""
    found = [[] for _ in range(5)]
    span = length - anchor + 1
    group: list[tuple[int, int, int]] = []
    for piece in [*_pieces(offsets, length), None]:
        if piece is not None:
            group.append(piece)
            if piece[2] - group[0][1] < PIECE_BYTES:
                continue
        if group:
            _windows(data, offsets, group, length, anchor, span, found)
            group = []
    return [np.concatenate(f) if f else np.zeros(0, np.int64) for f in found]


def _windows(data, offsets, group, length, anchor, span, found) -> None:
    low, high = group[0][1], max(p[2] for p in group)
    if high - low < length:
        return
    sums = prefix_hashes(data[low:high].astype(np.uint64) + np.uint64(1))
    n = high - low - anchor + 1
    at = np.arange(n)
    grams = span_hashes(sums, at, at + anchor)
    # Order by 40 bits of the hash, then by place; a group is shorter than 2**24 bytes.
    key = (grams & ~np.uint64(0xFFFFFF)) | at.astype(np.uint64)
    blocks = -(-n // span)
    padded = np.full(blocks * span, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = key
    shaped = padded.reshape(blocks, span)
    ahead = np.minimum.accumulate(shaped, axis=1).ravel()
    behind = np.minimum.accumulate(shaped[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - span + 1
    smallest = np.minimum(behind[:starts], ahead[span - 1:span - 1 + starts])
    place = (smallest & np.uint64(0xFFFFFF)).astype(np.int64)
    for text, a, b in group:
        own = place[a - low:b - low - length + 1]
        opens = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        many = np.diff(np.append(opens, len(own)))
        begin = opens + (a - low)
        found[0].append(np.full(len(opens), text))
        found[1].append(begin + low - offsets[text])
        found[2].append(many)
        found[3].append(grams[own[opens]].view(np.int64))
        found[4].append(span_hashes(sums, begin, begin + many + length - 1).view(np.int64))


def window_rows(docs: DataFrame, length: int, anchor: int) -> DataFrame:
    """Windows of keyed documents, equal ones of a document as one row with all their starts."""
    names = [*KEY, "anchor", "window", "starts", "many"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        text, start, many, anchors, window = windows_of(*utf8(batch.column("text")), length, anchor)
        if not len(text):
            return None
        order = np.lexsort((start, window, anchors, text))
        text, start, many, anchors, window = (a[order] for a in (text, start, many, anchors, window))
        new = np.concatenate([[True], (text[1:] != text[:-1]) | (anchors[1:] != anchors[:-1]) | (window[1:] != window[:-1])])
        first = np.flatnonzero(new)
        starts = pa.ListArray.from_arrays(
            pa.array(np.append(first, len(text)), pa.int32()), pa.array(start, pa.int64())
        )
        owner = pa.array(text[first])
        return pa.RecordBatch.from_arrays(
            [batch.column(KEY[0]).take(owner), batch.column(KEY[1]).take(owner), pa.array(anchors[first]),
             pa.array(window[first]), starts, pa.array(many[first], pa.int64())], names,
        )

    return over_batches(
        docs.select("text", *KEY), work,
        "_k1 long, _k2 long, anchor long, window long, starts array<long>, many long",
    )


def _cut_windows(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of ``wanted`` windows (_k1, _k2, start, many, anchor, alone)."""
    per_text = wanted.groupBy(*KEY).agg(F.collect_list(F.struct("start", "many", "anchor", "alone")).alias("cuts"))
    names = [*KEY, "start", "anchor", "alone", "bytes"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = utf8(batch.column("text"))
        raw = data.tobytes()
        columns: list[list] = [[] for _ in range(5)]
        for row, cuts in enumerate(batch.column("cuts").to_pylist()):
            base = int(offsets[row])
            for cut in cuts:
                a = base + cut["start"]
                for column, value in zip(columns, (
                    row, cut["start"], cut["anchor"], cut["alone"], raw[a:a + cut["many"] + length - 1],
                )):
                    column.append(value)
        owner = pa.array(columns[0], pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column(KEY[0]).take(owner), batch.column(KEY[1]).take(owner), pa.array(columns[1], pa.int64()),
             pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.bool_()), pa.array(columns[4], pa.binary())], names,
        )

    # Repeated rows have the same bytes; one of them is enough.
    texts = docs.select("text", *KEY).join(per_text, KEY).dropDuplicates(KEY)
    return over_batches(texts, work, "_k1 long, _k2 long, start long, anchor long, alone boolean, bytes binary")


def _marked(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Byte runs covered by strings at the given starts."""
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > length)
    a = starts[np.concatenate([[0], breaks + 1])]
    b = starts[np.concatenate([breaks, [len(starts) - 1]])] + length
    return list(zip(a.tolist(), b.tolist()))


def _indexed(windows: DataFrame, length: int, parts: int) -> DataFrame:
    """Covered runs of windows that stand alone, from run-length indexes of all windows of an anchor."""
    names = [*KEY, "a", "b"]

    def finish(rows: list[dict]) -> pa.RecordBatch | None:
        index = RunLengthIndex([r["bytes"] for r in rows])
        found = []
        for row, match in zip(rows, index.matching_statistics()):
            if row["alone"]:
                for a, b in _marked(np.flatnonzero(match >= length), length):
                    found.append((row[KEY[0]], row[KEY[1]], row["start"] + a, row["start"] + b))
        if not found:
            return None
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if size >= INDEX_BYTES and row["anchor"] != held[-1]["anchor"]:
                    found = finish(held)
                    if found is not None:
                        yield found
                    held, size = [], 0
                held.append(row)
                size += len(row["bytes"])
        found = finish(held) if held else None
        if found is not None:
            yield found

    dealt = windows.repartition(parts, "anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(run, "_k1 long, _k2 long, a long, b long")


def _counted(windows: DataFrame, length: int) -> DataFrame:
    """Covered runs of windows of anchors with very many: strings counted by two hashes."""
    names = [*KEY, "at", "s1", "s2"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = utf8(batch.column("bytes"))
        columns: list[list[np.ndarray]] = [[] for _ in range(4)]
        values = data.astype(np.uint64) + np.uint64(1)
        bases = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
        sums = [prefix_hashes(values, base) for base in bases]
        for row, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
            at = np.arange(a, b - length + 1)
            columns[0].append(np.full(len(at), row))
            columns[1].append(at - a + batch.column("start")[row].as_py())
            for column, s, base in zip(columns[2:], sums, bases):
                column.append(span_hashes(s, at, at + length, base).view(np.int64))
        row, at, s1, s2 = (np.concatenate(c) for c in columns)
        owner = pa.array(row)
        return pa.RecordBatch.from_arrays(
            [batch.column(KEY[0]).take(owner), batch.column(KEY[1]).take(owner), pa.array(at), pa.array(s1), pa.array(s2)],
            names,
        )

    strings = over_batches(windows, work, "_k1 long, _k2 long, at long, s1 long, s2 long")
    repeated = strings.groupBy("s1", "s2").agg(F.count("*").alias("n")).where("n > 1")
    hit = strings.join(repeated, ["s1", "s2"], "left_semi")
    return hit.select(*KEY, F.col("at").alias("a"), (F.col("at") + length).alias("b"))


def repeated_runs(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """Rows (_k1, _k2, runs): covered byte runs (a, b) of keyed documents, unmerged; none for most."""
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    windows = stored(window_rows(docs, length, anchor), "windows")
    counts = windows.groupBy("anchor", "window").agg(
        F.sum(F.size("starts")).alias("n"), F.min(F.struct(*KEY, F.col("starts")[0].alias("start"), "many")).alias("one")
    )
    variants = stored(
        counts.select("anchor", "window", "n", "one.*"), "window-counts"
    )
    whole = windows.join(variants.where("n > 1").select("anchor", "window"), ["anchor", "window"], "left_semi").select(
        *KEY, F.explode(F.transform("starts", lambda s: F.struct(s.alias("a"), (s + F.col("many") + length - 1).alias("b")))).alias("r")
    ).select(*KEY, "r.a", "r.b")
    # Only anchors of which some window stands alone and another one differs are of interest.
    anchors = variants.groupBy("anchor").agg(F.count("*").alias("variants"), F.min("n").alias("least")).where(
        "variants > 1 and least = 1"
    ).select("anchor", (F.col("variants") > MAX_VARIANTS).alias("crowded"))
    wanted = variants.join(anchors, "anchor").withColumn("alone", F.col("n") == 1)
    cut = stored(_cut_windows(docs, wanted, length), "window-bytes")
    crowded = stored(anchors.where("crowded").select("anchor"), "crowded-anchors")
    found = whole.unionByName(_indexed(cut.join(crowded, "anchor", "left_anti"), length, parts))
    if not crowded.isEmpty():
        found = found.unionByName(_counted(cut.join(crowded, "anchor", "left_semi"), length))
    return found.groupBy(*KEY).agg(F.collect_list(F.struct("a", "b")).alias("runs"))


def merged(runs: list[dict] | None) -> list[tuple[int, int]]:
    found: list[list[int]] = []
    for a, b in sorted((r["a"], r["b"]) for r in runs or []):
        if found and a <= found[-1][1]:
            found[-1][1] = max(found[-1][1], b)
        else:
            found.append([a, b])
    return [(a, b) for a, b in found]


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of all documents (doc_id, text).

    ``kept`` are the remaining bytes; a cut may fall inside a character.
    """
    small_batches(docs.sparkSession)
    docs = keyed(docs)
    runs = repeated_runs(docs, length)
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = utf8(batch.column("text"))
        raw = data.tobytes()
        columns: list[list] = [[] for _ in range(5)]
        for row, runs in enumerate(batch.column("runs").to_pylist()):
            whole = raw[offsets[row]:offsets[row + 1]]
            spans, at, parts = merged(runs), 0, []
            for a, b in spans:
                parts.append(whole[at:a])
                at = b
            kept = b"".join(parts) + whole[at:]
            for column, value in zip(columns, (
                len(whole), sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest(), kept,
            )):
                column.append(value)
        kinds = [pa.int64()] * 3 + [pa.string(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))], names
        )

    return over_batches(
        docs.join(runs, KEY, "left").select("doc_id", "text", "runs"), work,
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary",
    )
