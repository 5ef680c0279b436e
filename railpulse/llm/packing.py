"""Vector bin packing of token pieces into training sequences.

Documents become token ids, an end id after each, and are cut into pieces of
``SEQUENCE_TOKENS`` and a remainder. A full piece is a sequence. Remainders are
packed under three limits at once: tokens, segments, and loss-bearing tokens
(those a model is trained to predict, the answers of instruction data). The
open sequence takes, of all pieces that still fit, the one with the largest dot
product of its demand and what is left, each as a share of the limits; ties go
to the earlier piece. It closes when nothing fits.

Pieces are dealt to buckets of about ``BUCKET_PIECES`` by a hash, and a bucket is
packed in one task: its size does not depend on the data, nor on how many rows one
document or source has. What a bucket leaves open is one sequence.

Defined cases: a null or empty text is its end id alone; rows with equal doc_id
are packed each for itself; a piece with more loss-bearing tokens than the limit
is an error, as no sequence could hold it; an empty table gives no rows.
"""

from __future__ import annotations

import string
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from railpulse.llm.common import give_back, over_batches, small_batches, stored

SEQUENCE_TOKENS = 4096
MAX_SEGMENTS = 128
END_ID = 2
BUCKET_PIECES = 3072
CACHED_WORDS = 200_000
ENCODED_AT_ONCE = 1 << 20  # characters of text
ENCODED_ROWS = 2048
TOKENIZER = "word_bpe_49k.json"
JOINED_WORDS = 500
# Some characters split words here and not in the tokenizer, so such texts go to it whole.
_UNLIKE = ("\x1c", "\x1d", "\x1e", "\x1f")
# None of these is a letter or a digit, so a run of them at a word's end is tokens of its own.
_MARKS = string.punctuation


class WordEncoder:
    """Token ids of texts, for a tokenizer that drops white space and case and merges within runs of letters only.

    Texts are split, and the different words of a megabyte of them found, in Arrow. Each is encoded once, which gives
    the ids of the whole text: runs of letters many at a time, as each ends with the one token of it that carries the mark
    of a word's end, and punctuation after them by itself. These pieces are remembered, not the words made of them.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # The same merges for words that are letters in lower case already, where there is nothing left to search for.
        self.letters = Tokenizer(self.tokenizer.model)
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ])
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}  # ids as little-endian 32-bit numbers

    def _whole(self, text: str) -> bytes:
        return _ids_of(self.tokenizer, text)

    def _letters(self, words: list[str]) -> None:
        for at in range(0, len(words), JOINED_WORDS):
            part = words[at:at + JOINED_WORDS]
            joined = " ".join(part)
            plain = joined.lower() == joined and unicodedata.is_normalized("NFC", joined)
            ids = _ids_of(self.letters, joined) if plain else self._whole(joined)
            cuts = (4 * np.flatnonzero(self.ends[np.frombuffer(ids, "<u4")]) + 4).tolist()
            if len(cuts) == len(part):
                self.known.update(zip(part, (ids[a:b] for a, b in zip([0, *cuts], cuts))))
            else:
                self.known.update((w, self._whole(w)) for w in part)

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of different pieces."""
        found = list(map(self.known.get, pieces))
        missing = [at for at, ids in enumerate(found) if ids is None]
        if len(self.known) + len(missing) > CACHED_WORDS:
            # Those met again just now stay, so frequent ones are not encoded anew.
            self.known = {piece: ids for piece, ids in zip(pieces, found) if ids is not None}
        new = [pieces[at] for at in missing]
        self._letters([piece for piece in new if piece.isalpha()])
        self.known.update((piece, self._whole(piece)) for piece in new if not piece.isalpha())
        for at, piece in zip(missing, new):
            found[at] = self.known[piece]
        return found

    def _words(self, words: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Ids of pieces, and which two of them are the ids of each word."""
        bare = pc.utf8_rtrim(words, characters=_MARKS)
        cores = bare.dictionary_encode()
        first, second = cores.indices.to_numpy().copy(), np.zeros(len(words), np.int32)
        pieces = _strings(cores.dictionary)
        places = {"": len(pieces)}
        second[:] = len(pieces)
        marked = np.flatnonzero(pc.not_equal(pc.binary_length(words), pc.binary_length(bare)).to_numpy(zero_copy_only=False))
        for at, word in zip(marked.tolist(), _strings(words.take(pa.array(marked)))):
            core = pieces[first[at]]
            # Only after a letter or a digit are marks sure to be tokens of their own.
            if core and not core[-1].isalpha() and core[-1] not in string.digits:
                first[at] = places.setdefault(word, len(pieces) + len(places))
            else:
                second[at] = places.setdefault(word[len(core):], len(pieces) + len(places))
        # A word, or the marks after one, may be a core as well.
        different = list(dict.fromkeys([*pieces, *places]))
        if len(different) < len(pieces) + len(places):
            at = dict(zip(different, range(len(different))))
            again = np.array([at[piece] for piece in [*pieces, *places]], np.int32)
            first, second = again[first], again[second]
        return self._pieces(different), first, second

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        at = 0
        while at < len(texts):
            upto, size = at + 1, len(texts[at])
            while upto < len(texts) and size + len(texts[upto]) <= ENCODED_AT_ONCE:
                size += len(texts[upto])
                upto += 1
            yield from self._encode(texts[at:upto])
            at = upto

    def _encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        # Lower case merges words; only where it is sure to be what the tokenizer makes of the text.
        plain = [t.lower() if "\u03a3" not in t and unicodedata.is_normalized("NFC", t) else t for t in texts]
        unlike = [any(c in t for c in _UNLIKE) or "<|" in t for t in texts]
        split = pc.utf8_split_whitespace(pa.array(["" if u else t for t, u in zip(plain, unlike)], pa.large_string()))
        words = split.flatten().dictionary_encode()
        ids, first, second = self._words(words.dictionary)
        chosen = words.indices.to_numpy()
        pieces = np.column_stack([first[chosen], second[chosen]]).ravel()
        lengths = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
        begins = np.cumsum(lengths) - lengths
        upto = np.concatenate([[0], np.cumsum(lengths[pieces])])
        places = np.repeat(begins[pieces] - upto[:-1], lengths[pieces]) + np.arange(upto[-1])
        found = np.frombuffer(b"".join(ids), "<u4")[places]
        cuts = upto[2 * split.offsets.to_numpy().astype(np.int64)].tolist()
        for text, whole, a, b in zip(texts, unlike, cuts, cuts[1:]):
            yield np.frombuffer(self._whole(text), "<u4") if whole else found[a:b]


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def _ids_of(tokenizer, text: str) -> bytes:
    found = tokenizer.encode_batch_fast([text], add_special_tokens=False)
    return np.array(found[0].ids, "<u4").tobytes()


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def token_pieces(docs: DataFrame, path: str, size: int = SEQUENCE_TOKENS, end_id: int = END_ID) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens) of all documents."""
    small_batches(docs.sparkSession, ENCODED_ROWS)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows: list[tuple] = []
        texts = [t or "" for t in batch.column("text").to_pylist()]
        for row, ids in enumerate(encoder(path).encode(texts)):
            ids = np.append(ids, np.uint32(end_id)).astype("<u4")
            for start in range(0, len(ids), size):
                piece = ids[start:start + size]
                rows.append((row, start, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
        row, *rest = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(row, pa.int64())), *(pa.array(c, pa.int64()) for c in rest)], names
        )

    return over_batches(
        docs.select("doc_id", "text"), work,
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long",
    )


def dot_product_fill(demands: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Sequence of every piece, numbered in the order they are filled.

    ``demands`` has a row per piece and a column per limit.
    """
    share = demands / limits
    if len(share) and share.max() > 1:
        raise ValueError("a piece exceeds a limit by itself")
    # Equal pieces are one kind with a count, so each choice looks at kinds only.
    kinds, kind_of = np.unique(share, axis=0, return_inverse=True)
    kind_of = kind_of.ravel()
    waiting = np.argsort(kind_of, kind="stable")
    left = np.bincount(kind_of, minlength=len(kinds))
    upto = np.cumsum(left) - left
    sequence = np.empty(len(share), np.int64)
    number = 0
    while left.any():
        room = np.ones(share.shape[1])
        live = np.flatnonzero(left)
        while True:
            live = live[(left[live] > 0) & (kinds[live] <= room + 1e-12).all(axis=1)]
            if not len(live):
                break
            best = live[np.argmax(kinds[live] @ room)]
            sequence[waiting[upto[best]]] = number
            upto[best] += 1
            left[best] -= 1
            room = room - kinds[best]
        number += 1
    return sequence


def pack(
    pieces: DataFrame,
    tokens: str = "length",
    loss_tokens: str | None = None,
    max_tokens: int = SEQUENCE_TOKENS,
    max_segments: int = MAX_SEGMENTS,
    max_loss: int = SEQUENCE_TOKENS,
    key: tuple[str, ...] = ("doc_id", "start"),
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    ``tokens`` and ``loss_tokens`` name the columns with the demands of a piece; by default
    every token bears loss. ``key`` names the columns by which pieces are dealt and ordered.
    """
    pieces = stored(pieces, "pieces")
    spark = pieces.sparkSession
    buckets = max(1, -(-pieces.count() // BUCKET_PIECES))
    columns = pieces.columns
    loss = loss_tokens or tokens
    limits = np.array([max_tokens, max_segments, max_loss], float)

    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)))
    parts = max(buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = dealt.repartition(parts, "_bucket").sortWithinPartitions("_bucket", *key)

    def finish(rows: pa.Table) -> pa.RecordBatch:
        length = rows.column(tokens).to_numpy()
        demands = np.column_stack([length, np.ones(len(length)), rows.column(loss).to_numpy()])
        sequence = dot_product_fill(demands, limits)
        order = np.argsort(sequence, kind="stable")
        before = np.cumsum(length[order]) - length[order]
        opens = np.searchsorted(sequence[order], sequence[order])
        offset = np.empty(len(length), np.int64)
        offset[order] = before - before[opens]
        sequence = (rows.column("_bucket").to_numpy() << 32) + sequence
        found = rows.select(columns).append_column("sequence_id", pa.array(sequence, pa.int64()))
        return found.append_column("offset", pa.array(offset, pa.int64())).combine_chunks().to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current = None
        for batch in batches:
            bucket = batch.column("_bucket").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if held and bucket[a] != current:
                    yield finish(pa.Table.from_batches(held))
                    held = []
                current = bucket[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield finish(pa.Table.from_batches(held))
        held = batch = None
        give_back()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return dealt.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str) -> DataFrame:
    """All tokens of all documents in sequences of at most ``SEQUENCE_TOKENS``."""
    return pack(token_pieces(docs, path))
