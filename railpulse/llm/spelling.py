"""Words that are spellings of one another, by letter counts first and edits second.

Two words are near if one inserted, deleted or replaced code point turns one into the other. Such words have almost the
same letters: the squared distance of their letter counts is 1 after an insertion and 2 after a replacement, and their
lengths are equal or adjacent. So words are gathered in blocks by length, NumPy multiplies the letter-count matrices
of a block with itself and with the next one, which gives all squared distances at once, and pairs at a
distance of at most 2 are verified letter by letter.

Blocks are made narrower before they are multiplied, without losing a pair. Letters are divided into ``CLASSES`` classes
by code point. One edit changes at most two letters, so of four classes two at least keep all their letters: near
words share the exact letters of some two classes. A block is therefore a length and the letters of two classes, and a
word is in six of them. A pair that shares more than two is kept in the first. A block with more than ``TILE_WORDS``
words is cut into tiles by hash, and every two tiles meet by themselves, so no block is held whole.

Words are counted over whole texts before anything is compared, partly in each input partition.

Defined cases: a null or empty text has no words; a null doc_id reads as empty text where it is hashed; repeated rows
count as often as they are there; a table without words gives no rows; other columns are not looked at. Of near words
with equal counts the smallest in code-point order is the form.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from railpulse.llm.common import stored

MIN_LENGTH = 6
MIN_COUNT = 5
FORM_RATIO = 5
LOSS = 199
CLASSES = 4
SHARED = list(itertools.combinations(range(CLASSES), CLASSES - 2))
TILE_WORDS = 512
CHUNK_WORDS = 512

_LETTERS = r"[A-Za-zÀ-ÿ]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


# -- words -------------------------------------------------------------------


def lower_ascii(column: F.Column) -> F.Column:
    return F.translate(column, _UPPER, _UPPER.lower())


def word_counts(docs: DataFrame) -> DataFrame:
    """Words of at least ``MIN_LENGTH`` code points and ``MIN_COUNT`` occurrences, one run in ``LOSS`` short of a letter.

    One shuffle, of the distinct words of each input partition.
    """
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
        F.explode(F.regexp_extract_all("text", F.lit(_LETTERS), 0)).alias("run"),
    )
    # Without capitals beyond A-Z, lower() is the same as lower_ascii and much faster.
    lowered = runs.select(
        "doc_id", F.when(F.col("run").rlike("[À-Þ]"), lower_ascii(F.col("run"))).otherwise(F.lower("run")).alias("run"),
    )
    hashed = lowered.select("run", F.crc32(F.concat("doc_id", F.lit(":"), "run")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    short = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % LOSS == 0, short).otherwise(F.col("run")).alias("word"))
    return (
        words.where(F.length("word") >= MIN_LENGTH)
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_COUNT)
    )


# -- blocks ------------------------------------------------------------------


def _class_letters(word: F.Column, which: int) -> F.Column:
    letters = F.filter(F.split(word, ""), lambda c: (c != "") & (F.ascii(c) % CLASSES == which))
    return F.array_join(F.array_sort(letters), "")


def tiles(words: DataFrame) -> DataFrame:
    """Rows (block, shared, tile_a, tile_b, tile, left, word, n): what meets in a tile pair.

    ``shared`` numbers the two classes. A word is in the block of its length, as a ``left`` word, and in that of the
    length before, where the words one letter shorter wait for it. Blocks are numbered by hash; should two
    have one number, their words meet in vain.
    """
    classes = words.select("word", "n", *[_class_letters(F.col("word"), k).alias(f"_{k}") for k in range(CLASSES)])
    places = F.array(*[
        F.struct(
            F.lit(number).alias("shared"),
            F.xxhash64(F.lit(number), F.length("word") - shift, *[f"_{k}" for k in pair]).alias("block"),
            F.lit(shift == 0).alias("left"),
        )
        for number, pair in enumerate(SHARED) for shift in (0, 1)
    ])
    placed = classes.select("word", "n", F.explode(places).alias("place")).select("word", "n", "place.*")
    counts = placed.groupBy("block").agg(F.count(F.lit(1)).alias("size"), F.max("left").alias("met"))
    # Blocks where nothing can meet go; few are so large that they need tiles.
    met = placed.join(counts.where("met and size > 1"), "block")
    n_tiles = F.ceil(F.col("size") / F.lit(TILE_WORDS)).cast("int")
    tile = F.pmod(F.xxhash64("word"), n_tiles).cast("int")
    dealt = met.select("block", "shared", "left", "word", "n", n_tiles.alias("tiles"), tile.alias("tile"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    return dealt.select("block", "shared", "left", "word", "n", "tile", other.alias("other")).select(
        "block", "shared", F.least("tile", "other").alias("tile_a"), F.greatest("tile", "other").alias("tile_b"),
        "tile", "left", "word", "n",
    )


def letter_counts(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of every letter in every word, the letters, and the words as rows of code points that end in zeros."""
    longest = max(map(len, words))
    points = np.frombuffer("".join(w.ljust(longest, "\0") for w in words).encode("utf-32-le"), "<u4")
    letters = np.flatnonzero(np.bincount(points))
    column = np.zeros(int(letters[-1]) + 1, np.int64)
    column[letters] = np.arange(len(letters))
    points = points.reshape(len(words), longest)
    cells = np.arange(len(words))[:, None] * len(letters) + column[points]
    counts = np.bincount(cells.ravel(), minlength=len(words) * len(letters)).reshape(len(words), len(letters))
    return counts[:, letters != 0].astype(np.float32), letters[letters != 0], points


def one_edit(short: np.ndarray, long: np.ndarray, lengths: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Whether rows of code points differ by one replacement, or (``more``) by one letter that ``long`` has besides."""
    same = short == long
    replaced = (~same).sum(axis=1) == 1
    # Up to the first difference as they are, from there on moved by one.
    first = np.where(same.all(axis=1), short.shape[1], (~same).argmax(axis=1))
    moved = np.zeros(short.shape, bool)
    moved[:, :-1] = short[:, :-1] == long[:, 1:]
    position = np.arange(short.shape[1])
    fits = moved | (position < first[:, None]) | (position >= lengths[:, None])
    return np.where(more, fits.all(axis=1), replaced)


def near_pairs(
    words: list[str], group: np.ndarray, shared: np.ndarray, left: np.ndarray, tile: np.ndarray, crossing: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) of near words in a chunk of whole tile pairs (``group``), each pair once in all blocks.

    ``crossing`` marks the rows of pairs of two different tiles, in which words of one tile are not compared again.
    """
    counts, letters, points = letter_counts(words)
    norm = (counts * counts).sum(axis=1)
    gram = counts @ counts.T
    # Squared distances of at most 2, the sum of the norms less twice the product.
    i, j = np.nonzero(2 * gram >= (norm - 2)[:, None] + norm[None, :])
    keep = (group[i] == group[j]) & left[i] & ~(crossing[i] & (tile[i] == tile[j]))
    i, j = i[keep], j[keep]
    length = (points != 0).sum(axis=1)
    # Of equally long words both are left, and meet twice.
    more = (length[j] == length[i] + 1) & ~left[j]
    keep = more | (left[j] & (i < j) & (length[i] == length[j]))
    i, j, more = i[keep], j[keep], more[keep]
    near = one_edit(points[i], points[j], length[i], more)
    i, j = i[near], j[near]
    changed = counts[i] != counts[j]
    same = [~changed[:, letters % CLASSES == k].any(axis=1) for k in range(CLASSES)]
    both = np.column_stack([np.logical_and.reduce([same[k] for k in pair]) for pair in SHARED])
    here = both.any(axis=1) & (both.argmax(axis=1) == shared[i])
    return i[here], j[here]


def links(words: DataFrame) -> DataFrame:
    """Rows (word, other, other_n) for every two near words, in both directions."""
    key = ["block", "tile_a", "tile_b"]
    dealt = tiles(words).repartition(*key).sortWithinPartitions(*key)

    def opens(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
        """Whether a row begins another tile pair than the one before it."""
        new = np.zeros(batch.num_rows, bool)
        for name in key:
            values = batch.column(name).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        return new

    def compared(rows: pa.Table) -> pa.RecordBatch:
        column = {c: rows.column(c).to_numpy() for c in ("shared", "tile", "tile_a", "tile_b", "n")}
        left = rows.column("left").combine_chunks().to_numpy(zero_copy_only=False)
        word = rows.column("word").combine_chunks()
        i, j = near_pairs(
            word.to_pylist(), np.cumsum(opens(rows)), column["shared"], left, column["tile"],
            column["tile_a"] != column["tile_b"],
        )
        one, other = np.concatenate([i, j]), np.concatenate([j, i])
        return pa.RecordBatch.from_arrays(
            [word.take(pa.array(one)), word.take(pa.array(other)), pa.array(column["n"][other])], ["word", "other", "other_n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Chunks of whole tile pairs, whose sizes are bounded."""
        held: list[pa.RecordBatch] = []
        count = 0
        last = None
        for batch in batches:
            new = opens(batch)
            this = tuple(batch.column(c)[0].as_py() for c in key)
            new[0] = this != last
            last = tuple(batch.column(c)[batch.num_rows - 1].as_py() for c in key)
            at = 0
            for row in np.flatnonzero(new).tolist():
                if count + row - at >= CHUNK_WORDS:
                    held.append(batch.slice(at, row - at))
                    yield compared(pa.Table.from_batches(held))
                    held, count, at = [], 0, row
            held.append(batch.slice(at))
            count += batch.num_rows - at
        if count:
            yield compared(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, "word string, other string, other_n long")


# -- forms and roots ---------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """The last form of every word that has one, by doubling: each round follows twice as many forms."""
    found = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = found.join(ahead, "root", "left")
        found = stored(
            moved.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("went")),
            "roots",
        )
        if found.where("went").isEmpty():
            return found.select("word", "root")
        found = found.select("word", "root")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Every word with its form (the commoner spelling it stands for), root and counts."""
    words = stored(word_counts(docs.select("doc_id", "text")), "words")
    best = links(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("most"), "other")).alias("best"),
    )
    common = -F.col("best.most") >= FORM_RATIO * F.col("n")
    described = stored(
        words.join(best, "word", "left").select(
            "word", F.when(common, F.col("best.other")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(common, -F.col("best.most")).alias("form_n"),
        ),
        "forms",
    )
    ended = roots(described.where(F.col("form").isNotNull()))
    return described.join(ended, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n",
    )
