"""Exact Jaccard links between documents' sets of five-word shingles, by partition and pigeonhole.

Two sets with intersection over union of at least 3/4 differ in at most
(|A| + |B|) / 7 shingles. Cut the universe of shingle hashes into ranges: if A has
more non-empty segments than there can be differences, one of them is the same
in B. Sets are banded by size, a band's sizes lying within a factor of two, and a
band has its own number of ranges.

* A set enters its band with all its non-empty segments, of which it *selects*
  H + 1, H being the most it can differ from any larger partner. The subset is
  chosen by cost: segments of common shingles last, larger ones first.
* A set near the lower end of its band also enters the band below, with as many
  selected segments as it takes to meet the smaller sets there.
* A segment of one shingle more or less is a difference of one, so covering it by
  its deletions buys nothing where segments suffice. The number of ranges of a
  band is set, before anything is indexed, to the smallest for which every set of
  the band has enough segments. Bands of up to ``SINGLES`` shingles have one range
  per shingle, where that is always so.

Candidates are pairs that share a segment one of them selected, have sizes that
fit, and are not yet known to be connected. They are verified exactly on the
shingle hashes (64 bit).

Skew. Equal sets are one class from the start. First each set is compared with one
holder of each of its ``MINIMA`` smallest hashes, then, if not connected by that,
with a few more: a family of near copies is connected by about one verified link
per member, and pairs inside it are not listed. Where two families meet in a bucket, the ``NEAREST`` pairs by sketch
are verified first. Families that had more and are still apart come back, alone, with a print of every set (16 bits of each
hash) beside its segments. Sets share at most what their prints share, so a bucket counts what two prints share, keeps the
pairs that this leaves possible and gives the ``NEAREST``: what two families that are not to be linked have in common
ends there and lists no pairs. Families that nevertheless had more and are apart return with ``WIDER`` times as many,
until none has pairs left: every candidate is verified, refuted by its prints or already connected. Shingles that very many
texts share are rarely selected. Which shingles count as common comes from a sample and decides cost only.

Segments travel as packed arrays by bucket of about ``BUCKET_SEGMENTS``.

Defined cases: a document with fewer than five words has its word sequence as one
shingle; one without words, or null, has none and links with nothing; rows that
share a doc_id are one document with several texts; a row with null doc_id links
with nothing and has a null component; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from railpulse.llm.common import Words, distinct, gathered, give_back, mixed, only, over_batches, small_batches, stored, utf8
from railpulse.llm.components import connected_components, with_components

SINGLES = 128
# Ranges of a band as multiples of its largest size; the last gives every shingle its own.
SHARES = (0.42, 0.5, 0.6, 0.75, 1.0, 1.5, 3.0, 8.0, math.inf)
MINIMA = 4
FAMILY_ROUNDS = (range(1, 6),)  # holders drawn per hash in each round after the first
SKETCH_BITS = 7
BUCKET_SEGMENTS = 1_500_000
COMMON_SAMPLE = 32  # one text in this many
COMMON_COUNT = 6
MAX_COMMON = 200_000
PAIRWISE = 48  # groups up to this size are paired by array shifts
NEAREST = 2  # pairs of two families that a bucket gives at first
WIDER = 16
COMPARED_AT_ONCE = 1 << 21  # entries of prints
PRINT_BYTES = 32 << 20  # in a bucket
COUNTED_PAIRS = 20_000  # in a task, by sketch
CHECKED_PAIRS = 1000  # in a task, by text


def band_of(size: int) -> int:
    return max(0, (size - 1).bit_length())


def most_differences(size: int) -> int:
    """Of a set and any larger partner."""
    return size // 3


def differences_below(size: int, band: int) -> int:
    """Of a set and any partner in the band below its own."""
    return (size + (1 << (band - 1))) // 7


def reaches_below(size: int, band: int) -> bool:
    return band > 0 and 3 * size <= 4 * (1 << (band - 1))


def segment_numbers(hashes: np.ndarray, ranges: float) -> np.ndarray:
    """Range of each hash; sorted hashes give sorted ranges."""
    if math.isinf(ranges):
        return np.arange(len(hashes))
    return ((hashes >> np.uint64(40)) * np.uint64(ranges)) >> np.uint64(24)


def ranges_of(band: int, shares: dict[int, float]) -> float:
    size = 1 << band
    share = math.inf if size <= SINGLES else shares.get(band, SHARES[0])
    return share if math.isinf(share) else math.ceil(share * size)


def share_needed(hashes: np.ndarray, band: int, needed: int) -> int:
    """Index of the first share under which a set has ``needed`` segments in a band."""
    if 1 << band <= SINGLES:
        return 0
    for i, share in enumerate(SHARES):
        ranges = share if math.isinf(share) else math.ceil(share * (1 << band))
        numbers = segment_numbers(hashes, ranges)
        if 1 + np.count_nonzero(numbers[1:] != numbers[:-1]) >= needed:
            return i
    raise AssertionError("a set has more shingles than it can differ by")


def rare_of(hashes: np.ndarray, common: np.ndarray) -> np.ndarray:
    if not len(common):
        return np.ones(len(hashes), bool)
    return common[np.minimum(np.searchsorted(common, hashes), len(common) - 1)] != hashes


def sets_of(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    hashes, first = Words(*utf8(texts)).shingles()
    return [distinct(hashes[a:b]) for a, b in zip(first[:-1], first[1:])]


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("_k"))


# -- sets and classes --------------------------------------------------------------


def describe(docs: DataFrame) -> DataFrame:
    """Per row: size of its set, two hashes of it, and the shares its bands need."""
    names = ["doc_id", "_k", "n", "f1", "f2", "own", "below"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns: list[list] = [[] for _ in names[2:]]
        for hashes in sets_of(batch.column("text")):
            n = len(hashes)
            band = band_of(n)
            own = share_needed(hashes, band, most_differences(n) + 1) if n else 0
            below = share_needed(hashes, band - 1, differences_below(n, band) + 1) if n and reaches_below(n, band) else 0
            sums = int(hashes.sum()), int(mixed(hashes ^ np.uint64(0x5DEECE66D)).sum())
            for column, value in zip(columns, (n, *(s - (1 << 64) if s >> 63 else s for s in sums), own, below)):
                column.append(value)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("_k"), *(pa.array(c, pa.int64()) for c in columns)], names
        )

    return over_batches(docs, work, ", ".join(f"{n} long" for n in names))


def band_column() -> F.Column:
    """``band_of`` as a column."""
    return F.when(F.col("n") > 1, F.length(F.conv((F.col("n") - 1).cast("string"), 10, 2))).otherwise(0)


def shares_of_bands(rows: DataFrame) -> dict[int, float]:
    """The share of every band that gives all of its sets, and those that enter it from above, enough segments."""
    own = rows.where("n > 0").select(band_column().alias("band"), F.col("own").alias("need"))
    below = rows.where("n > 0").select((band_column() - 1).alias("band"), F.col("below").alias("need"))
    found = own.unionByName(below).groupBy("band").agg(F.max("need").alias("need")).collect()
    return {r["band"]: SHARES[r["need"]] for r in found}


# -- verification --------------------------------------------------------------------


def sketch(hashes: np.ndarray) -> bytes:
    """How many hashes fall in each of 2 ** ``SKETCH_BITS`` ranges, up to 255: sets differ at least as their counts do."""
    counts = np.bincount((hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=1 << SKETCH_BITS)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def small_sketch(hashes: np.ndarray) -> np.ndarray:
    """The same up to 15, two to a byte."""
    counts = np.minimum(np.frombuffer(sketch(hashes), np.uint8), 15)
    return counts[::2] << 4 | counts[1::2]


def unpacked(sketches: np.ndarray) -> np.ndarray:
    return np.stack([sketches >> 4, sketches & 15], axis=2).reshape(len(sketches), -1).astype(np.int8)


def print_of(hashes: np.ndarray) -> np.ndarray:
    """16 bits of each of the sorted hashes, in order; two sets share at most as many as their prints do."""
    return (hashes >> np.uint64(48)).astype(np.uint16)


class Prints:
    """The prints of the sets of a bucket."""

    def __init__(self, values: np.ndarray, sizes: np.ndarray):
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        self.sizes = sizes
        # A number that a print has several times counts as several numbers.
        place = np.arange(len(values))
        opens = np.ones(len(values), bool)
        opens[1:] = values[1:] != values[:-1]
        opens[self.first[:-1][sizes > 0]] = True
        again = place - np.maximum.accumulate(np.where(opens, place, 0))
        numbers = np.unique(again << 16 | values, return_inverse=True)[1]
        self.numbers = numbers.astype(np.int32)
        self.marked = np.zeros(int(numbers.max()) + 1 if len(numbers) else 0, bool)

    def differences(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of each pair of sets (a, b), at least; pairs with the same ``a`` are compared together."""
        shared = np.zeros(len(a), np.int64)
        order = np.argsort(a, kind="stable")
        cuts = np.flatnonzero(np.diff(a[order])) + 1
        for pairs in np.split(order, cuts) if len(order) else []:
            own = self.numbers[self.first[a[pairs[0]]]:self.first[a[pairs[0]] + 1]]
            self.marked[own] = True
            step = max(1, COMPARED_AT_ONCE // max(1, int(self.sizes[b[pairs]].max())))
            for at in range(0, len(pairs), step):
                some = pairs[at:at + step]
                counts = self.sizes[b[some]]
                ends = np.cumsum(counts)
                entries = np.arange(ends[-1]) + np.repeat(self.first[b[some]] - ends + counts, counts)
                hits = np.concatenate([[0], np.cumsum(self.marked[self.numbers[entries]])])
                shared[some] = hits[ends] - hits[ends - counts]
            self.marked[own] = False
        return self.sizes[a] + self.sizes[b] - 2 * shared


def verified(pairs: DataFrame, docs: DataFrame, sifted: bool = False) -> DataFrame:
    """The links among candidate ``pairs`` (a, b) of ``docs`` (id, text).

    Unless the pairs are ``sifted`` already, counts by hash range rule out most of them before whole texts are brought
    together. Texts travel, not their sets, as they compress and hashes do not.
    """
    pairs = stored(pairs, "candidates")
    count = pairs.count()

    def texts_of(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
        return only(docs, stored(gathered(wanted, 2 * count), "candidate-ids"), "id", "left_semi").select("id", "text")

    def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = sets_of(batch.column("text"))
        return pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([sketch(s) for s in sets], pa.binary())],
            ["id", "n", "sketch"],
        )

    def brought(pairs: DataFrame, rows: DataFrame) -> DataFrame:
        for side in ("a", "b"):
            pairs = pairs.join(rows.withColumnsRenamed({c: side if c == "id" else f"{c}_{side}" for c in rows.columns}), side)
        return pairs

    def plausible(batch: pa.RecordBatch) -> pa.RecordBatch:
        one, two = (np.frombuffer(b"".join(batch.column(f"sketch_{x}").to_pylist()), np.uint8) for x in "ab")
        differ = np.abs(one.astype(np.int16) - two.astype(np.int16)).reshape(-1, 1 << SKETCH_BITS).sum(axis=1)
        total = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
        return batch.select(["a", "b"]).filter(pa.array(7 * differ <= total))

    def check(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = {}
        for side in "ab":
            at = dict(zip(batch.column(side).to_pylist(), range(batch.num_rows)))
            new = [i for i in at if i not in own]
            own.update(zip(new, sets_of(batch.column(f"text_{side}").take(pa.array([at[i] for i in new], pa.int64())))))
        keep = []
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            both = np.concatenate([own[a], own[b]])
            both.sort()
            shared = int(np.count_nonzero(both[1:] == both[:-1]))
            keep.append(100 * shared >= 75 * (len(both) - shared))
        return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    near = pairs
    if not sifted:
        known = over_batches(texts_of(pairs), counted, "id long, n long, sketch binary")
        near = brought(pairs, known).select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b")
        near = stored(over_batches(gathered(near, count, COUNTED_PAIRS), plausible, "a long, b long"), "plausible")
        count = near.count()
    joined = brought(near, texts_of(near)).select("a", "b", "text_a", "text_b")
    return stored(over_batches(gathered(joined, count, CHECKED_PAIRS), check, "a long, b long"), "links")


def smallest_hashes(docs: DataFrame) -> DataFrame:
    """Rows (id, h, n): the ``MINIMA`` smallest hashes of each set."""

    def minima(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        sets = sets_of(batch.column("text"))
        counts = [min(MINIMA, len(s)) for s in sets]
        if not any(counts):
            return None
        owner = np.repeat(np.arange(len(sets)), counts)
        least = np.concatenate([s[:MINIMA] for s in sets]).view(np.int64)
        sizes = np.array([len(s) for s in sets])[owner]
        return pa.RecordBatch.from_arrays(
            [batch.column("id").take(pa.array(owner)), pa.array(least), pa.array(sizes)], ["id", "h", "n"]
        )

    return stored(over_batches(docs, minima, "id long, h long, n long"), "minima")


def family_pairs(holders: DataFrame, seeds: range) -> DataFrame:
    """Candidates (a, b): each holder (id, h, n, family) of a hash and one of its holders per seed, drawn by hash."""
    drawn = holders.groupBy("h").agg(
        F.count("*").alias("held"),
        F.array(*(F.min(F.struct(F.xxhash64("id", F.lit(seed)).alias("draw"), "id", "n", "family")) for seed in seeds)).alias("drawn"),
    ).where("held > 1").select("h", "drawn")
    met = holders.join(drawn, "h").select("id", "n", "family", F.explode("drawn").alias("pivot"))
    return met.where("family <> pivot.family and 4 * least(n, pivot.n) >= 3 * greatest(n, pivot.n)").select(
        F.least("id", "pivot.id").alias("a"), F.greatest("id", "pivot.id").alias("b")
    ).distinct()


def families_of(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Families (id, family) of near copies, and the links (a, b) that make them."""
    holders = smallest_hashes(docs)
    links = verified(family_pairs(holders.withColumn("family", F.col("id")), range(1)), docs)
    for seeds in FAMILY_ROUNDS:
        found = stored(connected_components(links).select("id", F.col("component").alias("family")), "family")
        known = holders.join(found, "id", "left").withColumn("family", F.coalesce("family", "id"))
        links = links.unionByName(verified(family_pairs(known, seeds), docs))
    return stored(connected_components(links).select("id", F.col("component").alias("family")), "family"), links


# -- segments ---------------------------------------------------------------------------


def common_shingles(docs: DataFrame) -> np.ndarray:
    """Hashes that many texts of a sample share, sorted; at most ``MAX_COMMON``."""

    def explode(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        sets = sets_of(batch.column("text"))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], ["h"])

    sample = docs.where(F.pmod(F.xxhash64("id"), F.lit(COMMON_SAMPLE)) == 0).select("text")
    counts = over_batches(sample, explode, "h long").groupBy("h").count().where(F.col("count") >= COMMON_COUNT)
    rows = counts.orderBy(F.desc("count"), "h").limit(MAX_COMMON).select("h").toArrow()
    return np.sort(rows.column("h").to_numpy().view(np.uint64)) if rows.num_rows else np.zeros(0, np.uint64)


OWN, SELECTED, BELOW, COMMON = 0, 1, 2, 4  # COMMON is added to one of the others


def segments(hashes: np.ndarray, common: np.ndarray, shares: dict[int, float]) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(band, signatures, kinds, segments with rare shingles) for a set's band and, if it reaches, the one below."""
    n = len(hashes)
    band = band_of(n)
    rare = rare_of(hashes, common)
    content = mixed(hashes)
    for target in (band, band - 1) if reaches_below(n, band) else (band,):
        numbers = segment_numbers(hashes, ranges_of(target, shares))
        first = np.flatnonzero(np.concatenate([[True], numbers[1:] != numbers[:-1]]))
        signatures = mixed(np.add.reduceat(content, first) + np.uint64(target))
        sizes = np.diff(np.append(first, n))
        costly = np.add.reduceat(rare, first, dtype=np.int64) == 0
        needed = (most_differences(n) if target == band else differences_below(n, band)) + 1
        chosen = np.lexsort((signatures, -sizes, costly))[:needed]
        if target == band:
            kinds = np.full(len(first), OWN, np.uint8)
            kinds[chosen] = SELECTED
        else:
            signatures, kinds = signatures[chosen], np.full(len(chosen), BELOW, np.uint8)
        kinds += np.uint8(COMMON) * (costly if target == band else costly[chosen])
        yield target, signatures, kinds, int(np.count_nonzero(~costly))


def packed_segments(
    docs: DataFrame, shares: dict[int, float], common: np.ndarray, buckets: dict[int, int], prints: bool = False
) -> DataFrame:
    """Rows of packed arrays: the segments of a batch by bucket, and the sets they are of, with their ``prints`` if asked for.

    ``docs`` has id and family beside text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(common)
    first_bucket, total = {}, 0
    for band in sorted(buckets):
        first_bucket[band] = total
        total += buckets[band]
    names = ["bucket", "single", "ids", "families", "sizes", "rares", "sketches", "prints", "owners", "kinds", "signatures"]
    band_at = {first_bucket[b] + i: b for b in buckets for i in range(buckets[b])}

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        found: list[tuple[np.ndarray, ...]] = []
        sets = sets_of(batch.column("text"))
        for owner, hashes in enumerate(sets):
            if not len(hashes):
                continue
            for band, signatures, kinds, rares in segments(hashes, shared.value, shares):
                bucket = first_bucket[band] + (signatures >> np.uint64(32)) % np.uint64(buckets[band])
                found.append((bucket.astype(np.int64), np.full(len(kinds), owner, np.uint16), kinds,
                              (signatures & np.uint64(0xFFFFFFFF)).astype(np.uint32), np.full(len(kinds), rares, np.int32)))
        if not found:
            return None
        columns = [np.concatenate(c) for c in zip(*found)]
        order = np.argsort(columns[0], kind="stable")
        bucket, owner, kind, signature, rares = (c[order] for c in columns)
        ids, families = (batch.column(c).to_numpy() for c in ("id", "family"))
        sizes = np.array([len(s) for s in sets], np.int32)
        sketches = np.stack([small_sketch(s) for s in sets])
        cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
        columns: list[list] = [[] for _ in names]
        for a, b in zip(cuts[:-1], cuts[1:]):
            present, at, place = np.unique(owner[a:b], return_index=True, return_inverse=True)
            values = (
                int(bucket[a]), int(math.isinf(ranges_of(band_at[int(bucket[a])], shares))), ids[present], families[present],
                sizes[present], rares[a + at], sketches[present],
                np.concatenate([print_of(sets[i]) for i in present]) if prints else b"",
                place.astype(np.uint16), kind[a:b], signature[a:b],
            )
            for column, value in zip(columns, values):
                column.append(value if isinstance(value, (int, bytes)) else np.ascontiguousarray(value).tobytes())
        return pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int64()) for c in columns[:2]), *(pa.array(c, pa.binary()) for c in columns[2:])], names
        )

    return over_batches(docs.select("text", "id", "family"), work,
                        "bucket long, single long, " + ", ".join(f"{n} binary" for n in names[2:]))


def candidates_of(signature, kind, owner, sets: dict[str, np.ndarray], single: bool) -> np.ndarray:
    """Distinct candidate pairs (owner, owner) of a bucket, smaller number first.

    ``sets`` has the family, size, number of rare segments and sketch of each owner, and their ``Prints`` or None.

    A set selects a segment of common shingles only with all its rare ones. So a pair that meets in such a segment
    meets in a rare one too, or all rare segments of both differ, each by one at least, in which case there must not be
    more of them than the pair may differ by. Where every shingle is a segment these add up.
    """
    families, sizes, rares, sketches = (sets[c] for c in ("families", "sizes", "rares", "sketches"))
    prints = sets.get("prints")
    order = np.argsort(signature, kind="stable")
    signature, kind, owner = signature[order], kind[order], owner[order]
    opens = np.flatnonzero(np.concatenate([[True], signature[1:] != signature[:-1]])) if len(signature) else np.zeros(0, int)
    ends = np.append(opens[1:], len(signature))
    if len(opens):
        # Groups of one family hold nothing new, and those that nobody selected need not be met in.
        family = families[owner]
        lively = np.minimum.reduceat(family, opens) != np.maximum.reduceat(family, opens)
        lively &= np.maximum.reduceat(kind & 3, opens) != OWN
        opens, ends = opens[lively], ends[lively]
    found: list[np.ndarray] = []

    def fits(a, b, common):
        """Whether owners may be linked, by family, size, rare segments and sketch."""
        total = sizes[a] + sizes[b]
        apart = rares[a] + rares[b] if single else np.maximum(rares[a], rares[b])
        ok = (families[a] != families[b]) & (4 * np.minimum(sizes[a], sizes[b]) >= 3 * np.maximum(sizes[a], sizes[b]))
        ok &= ~common | (7 * apart <= total)
        for at in range(0, len(ok), 1 << 16):
            some = np.flatnonzero(ok[at:at + (1 << 16)]) + at
            differ = np.abs(sketches[a[some]] - sketches[b[some]]).sum(axis=1, dtype=np.int64)
            ok[some] = 7 * differ <= total[some]
        if prints is not None:
            some = np.flatnonzero(ok)
            ok[some] = 7 * prints.differences(a[some], b[some]) <= total[some]
        return ok

    def add(a, b):
        nonlocal found
        found.append(np.minimum(a, b).astype(np.int64) << 32 | np.maximum(a, b))
        if len(found) > 1000:
            found = [distinct(np.concatenate(found))]

    small = ends - opens <= PAIRWISE
    first, last = opens[small], ends[small]
    for shift in range(1, PAIRWISE):
        going = last - first > shift
        first, last = first[going], last[going]
        if not len(first):
            break
        counts = last - first - shift
        x = np.repeat(first - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        y = x + shift
        one, two, a, b = kind[x] & 3, kind[y] & 3, owner[x], owner[y]
        met = ((one == SELECTED) & (two != BELOW) & (sizes[a] <= sizes[b])) | (
            (two == SELECTED) & (one != BELOW) & (sizes[b] <= sizes[a])) | ((one == BELOW) ^ (two == BELOW))
        x, y = x[met], y[met]
        pair = distinct(np.minimum(owner[x], owner[y]).astype(np.int64) << 33
                        | np.maximum(owner[x], owner[y]).astype(np.int64) << 1 | (kind[x] >= COMMON))
        a, b = pair >> 33, (pair >> 1) & 0xFFFFFFFF
        ok = fits(a, b, (pair & 1).astype(bool))
        add(a[ok], b[ok])

    # In large groups every set that selected one is compared once with all it meets anywhere.
    groups: dict[int, list[int]] = {}
    members = []
    for g, (a, b) in enumerate(zip(opens[~small].tolist(), ends[~small].tolist())):
        members.append((owner[a:b], bool(kind[a] >= COMMON)))
        for x in owner[a:b][(kind[a:b] & 3) != OWN].tolist():
            groups.setdefault(x, []).append(g)
    for x, own in groups.items():
        met = np.zeros((2, len(families)), bool)
        for g in own:
            met[int(members[g][1]), members[g][0]] = True
        met[1] &= ~met[0]
        for common in (0, 1):
            partners = np.flatnonzero(met[common])
            a = np.full(len(partners), x)
            ok = fits(a, partners, np.full(len(partners), bool(common)))
            add(a[ok], partners[ok])
    return distinct(np.concatenate(found)) if found else np.zeros(0, np.int64)


def nearest_pairs(pairs: np.ndarray, families: np.ndarray, sketches: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` pairs of each two families whose sketches differ least, and whether the two have more."""
    a, b = pairs >> 32, pairs & 0xFFFFFFFF
    differ = np.concatenate([
        np.abs(sketches[a[at:at + (1 << 16)]] - sketches[b[at:at + (1 << 16)]]).sum(axis=1, dtype=np.int64)
        for at in range(0, len(pairs), 1 << 16)
    ])
    key = np.minimum(families[a], families[b]).astype(np.int64) << 32 | np.maximum(families[a], families[b])
    order = np.lexsort((pairs, differ, key))
    key = key[order]
    opens = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    counts = np.diff(np.append(opens, len(key)))
    keep = np.arange(len(key)) - np.repeat(opens, counts) < most
    return pairs[order][keep], np.repeat(counts > most, counts)[keep]


def segment_pairs(packed: DataFrame, buckets: int, most: int) -> DataFrame:
    """Distinct candidate pairs (a, b, cut) of all buckets, ``most`` of two families from each; cut if they have more."""
    names = ["a", "b", "cut"]

    def finish(rows: list[dict]) -> pa.RecordBatch | None:
        ids, families = (np.concatenate([np.frombuffer(r[c], np.int64) for r in rows]) for c in ("ids", "families"))
        sizes, rares = (np.concatenate([np.frombuffer(r[c], np.int32) for r in rows]).astype(np.int64) for c in ("sizes", "rares"))
        sketches = unpacked(np.frombuffer(b"".join(r["sketches"] for r in rows), np.uint8).reshape(len(ids), -1))
        base = np.cumsum([0, *(len(r["sizes"]) // 4 for r in rows)])
        owner = np.concatenate([np.frombuffer(r["owners"], np.uint16).astype(np.int32) + b for r, b in zip(rows, base)])
        kind = np.concatenate([np.frombuffer(r["kinds"], np.uint8) for r in rows])
        signature = np.concatenate([np.frombuffer(r["signatures"], np.uint32) for r in rows])
        sets = {"families": np.unique(families, return_inverse=True)[1], "sizes": sizes, "rares": rares, "sketches": sketches}
        printed = np.frombuffer(b"".join(r["prints"] for r in rows), np.uint16)
        sets["prints"] = Prints(printed, sizes) if len(printed) else None
        pairs = candidates_of(signature, kind, owner, sets, bool(rows[0]["single"]))
        if not len(pairs):
            return None
        pairs, cut = nearest_pairs(pairs, sets["families"], sketches, most)
        a, b = ids[pairs >> 32], ids[pairs & 0xFFFFFFFF]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(cut)], names)

    def run(batches):
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and row["bucket"] != held[0]["bucket"]:
                    found = finish(held)
                    if found is not None:
                        yield found
                    held = []
                held.append(row)
        found = finish(held) if held else None
        if found is not None:
            yield found
        held = batch = row = found = None
        give_back()

    dealt = packed.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    found = dealt.mapInArrow(run, "a long, b long, cut boolean").where("a <> b")
    return found.groupBy("a", "b").agg(F.max("cut").alias("cut"))


def printed_buckets(volume: dict[int, tuple[int, int]]) -> dict[int, int]:
    """Buckets of each band for sets that travel with their prints, from the sums of their sizes and of the squares.

    A band goes whole into one bucket if its prints fit there. Otherwise a set goes, with its print, to as many buckets as
    it has segments, half its size or so, and the number of buckets is such that a bucket still has no more.
    """
    found = {}
    for band in {*volume, *(b - 1 for b in volume if b > 0)}:
        total, squares = (sum(volume.get(b, (0, 0))[i] for b in (band, band + 1)) for i in (0, 1))
        found[band] = 1 if 2 * total <= PRINT_BYTES else -(-squares // PRINT_BYTES)
    return found


# -- the join -----------------------------------------------------------------------------


def jaccard_links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Described rows (doc_id, _k, n, class id), and links (a, b) that connect what is connected.

    An id is the smallest doc_id of a class of equal sets.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = keyed(docs)
    rows = stored(describe(docs), "sets")
    classes = stored(
        rows.where("n > 0 and doc_id is not null").groupBy("n", "f1", "f2").agg(F.min(F.struct("doc_id", "_k")).alias("first"))
        .select("n", "f1", "f2", F.col("first.doc_id").alias("id"), F.col("first._k").alias("_k")),
        "classes",
    )
    # One row of each class goes on, under its doc_id; the others, and empty sets, stay behind.
    others = stored(rows.select("_k").distinct().join(classes.select("_k"), "_k", "left_anti"), "other-rows")
    ones = once(only(docs, others, "_k", "left_anti").select("doc_id", "text")).select(F.col("doc_id").alias("id"), "text")
    families, near = families_of(ones)

    shares = shares_of_bands(rows)
    # Entries of a band: about half of its shingles, more than that from above at most.
    volume = {r["band"]: r["total"] for r in classes.groupBy(band_column().alias("band")).agg(F.sum("n").alias("total")).collect()}
    buckets = {
        b: max(1, -(-(volume.get(b, 0) + volume.get(b + 1, 0) // 4) // (2 * BUCKET_SEGMENTS)))
        for b in {*volume, *(b - 1 for b in volume if b > 0)}
    }
    links = near.unionByName(far_links(ones, classes.select("id", "n"), families, near, shares, buckets))
    described = rows.join(classes.select("f1", "f2", "n", F.col("id").alias("class")), ["f1", "f2", "n"], "left")
    described = described.select("doc_id", "_k", "n", F.when(F.col("doc_id").isNotNull(), F.coalesce("class", "doc_id")).alias("class"))
    return described, links


def far_links(
    ones: DataFrame, sizes: DataFrame, families: DataFrame, near: DataFrame, shares: dict[int, float], buckets: dict[int, int]
) -> DataFrame:
    """Links (a, b) that join ``families``, themselves made by the links ``near``, as far as they can be joined.

    ``sizes`` has the size n of each set by id.
    """
    common = common_shingles(ones)
    labelled, links, found, most = only(ones, families, "id", "left"), near, None, NEAREST
    printed = False
    while True:
        packed = packed_segments(
            labelled.withColumn("family", F.coalesce("family", "id")), shares, common, buckets, prints=printed)
        pairs = stored(segment_pairs(packed, sum(buckets.values()) or 1, most), "met")
        new = verified(pairs.select("a", "b"), ones, sifted=True)
        found = new if found is None else found.unionByName(new)
        cut = pairs.where("cut").select("a", "b")
        if cut.isEmpty():
            return found
        links = links.unionByName(new)
        families = stored(connected_components(links).select("id", F.col("component").alias("family")), "family")
        for side in "ab":
            cut = cut.join(families.withColumnsRenamed({"id": side, "family": f"of_{side}"}), side, "left")
            cut = cut.withColumn(f"of_{side}", F.coalesce(f"of_{side}", side))
        apart = cut.where("of_a <> of_b").select(F.explode(F.array("of_a", "of_b")).alias("family")).distinct()
        apart = stored(apart, "apart")
        if apart.isEmpty():
            return found
        members = families.join(apart, "family", "left_semi").unionByName(
            apart.select(F.col("family").alias("id"), "family")).distinct()
        members = stored(members, "members")
        labelled = only(ones, members, "id", "inner")
        if printed:
            most *= WIDER
        printed = True
        volume = members.join(sizes, "id").groupBy(band_column().alias("band")).agg(F.sum("n").alias("n"), F.sum(F.expr("n * n")).alias("nn"))
        buckets = printed_buckets({r["band"]: (r["n"], r["nn"]) for r in volume.collect()})


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id) of all documents (doc_id, text)."""
    rows, links = jaccard_links(docs)
    # Texts that share a doc_id are one document.
    same = rows.select(F.col("doc_id").alias("a"), F.col("class").alias("b")).where("a <> b").distinct()
    lone = same.groupBy("a").agg(F.count("*").alias("c")).where("c > 1")
    links = links.unionByName(same.join(lone, "a", "left_semi"))
    found = with_components(rows, links, "class")
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def once(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each doc_id and text, null equal to null: the first by the other columns."""
    rows = docs.withColumn("_k", F.xxhash64("doc_id", "text"))
    repeated = stored(rows.groupBy("_k").count().where("count > 1").select("_k"), "repeated-rows")
    if repeated.isEmpty():
        return docs
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    # Only repeated rows are grouped, and copies are cut to one per input partition before the shuffle.
    many = only(rows, repeated, "_k", "left_semi").groupBy("doc_id", "text").agg(F.min(F.struct(F.lit(0), *others)).alias("first"))
    many = many.select(*(c if c in ("doc_id", "text") else F.col("first")[c].alias(c) for c in docs.columns))
    return only(rows, repeated, "_k", "left_anti").select(*docs.columns).unionByName(stored(many, "repeated-once"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component: that with its smallest doc_id.

    Of rows that repeat both doc_id and text one stays, also where these are null. Otherwise documents without words,
    and rows with null doc_id, are all kept, and so are different texts of a doc_id.
    """
    docs = once(docs)
    found = near_duplicates(docs.select("doc_id", "text"))
    away = stored(found.where("doc_id <> component_id").select("doc_id").distinct(), "copies")
    return only(docs, away, "doc_id", "left_anti").select(*docs.columns)
