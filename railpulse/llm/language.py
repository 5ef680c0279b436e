"""Language of every word by a linear-chain conditional random field.

A chain is the words of a line. A word's features are its prefixes and suffixes
of up to three letters, its letter bigrams and trigrams with word borders, and
itself if it is one of the frequent words of the fitted sample (the lexicon);
they are hashed into ``BUCKETS`` weights per language. Transitions between
languages are weights too. Forward-backward gives each word's distribution over
languages. A document's language is the one with the largest share of these,
and its score is that share.

Weights maximise the likelihood of labelled chains. Half of these are spliced
from two documents of different languages, so that the transitions learn how
text switches. Every language that has a labelled text with a doc_id outside the
held-out fold is learned, however rare. The sample is at most ``FIT_ROWS`` documents
of each (smallest hash of doc_id) and ``FIT_CHAINS`` chains of them, picked in turns
by hash over the whole texts; if that is less than ``LEAST_CHAINS`` a language, it is
that many. Prediction reads every word of every text.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
without any labelled text every document is; ties between languages go to the
first in alphabetical order; repeated documents get equal results; empty tables
give no rows.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from railpulse.llm.common import held_out, mixed, over_batches, small_batches, stored

UNKNOWN = "und"
FIT_ROWS = 1_000  # of each language
FIT_CHAINS = 3_000
LEAST_CHAINS = 100  # of each language that has as many
CHAIN_WORDS = 40  # longer lines enter the sample as several chains
LEXICON_WORDS = 2_000
BUCKETS = 1 << 15
EPOCHS = 12
RATE = 0.3
RIDGE = 1e-4
REMEMBERED = 150_000
CELLS = 1_000_000  # words times languages of the lines handled together
ROWS = 512
_WORD = re.compile(r"[^\W\d_]+")


def lines_of(text: str | None) -> list[list[str]]:
    found = (words_of(line) for line in (text or "").lower().split("\n"))
    return [words for words in found if words]


def words_of(line: str) -> list[str]:
    """Maximal runs of letters; fractions, raised and circled digits are none."""
    runs = _WORD.findall(line)
    if all(map(str.isalpha, runs)):
        return runs
    return "".join(c if c.isalpha() else " " for run in runs for c in (*run, " ")).split()


def features(words: list[str], lexicon: frozenset[str]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of every word's features, word after word, and how many each word has.

    Up to three characters make one number, so all words of a batch are hashed together.
    """
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    text = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    ends = np.cumsum(lengths + 2)
    starts = ends - lengths - 2
    grams = {1: text}
    for n in (2, 3):
        grams[n] = grams[n - 1][:-1] * np.uint64(0x110000) + text[n - 1:]
    every = np.arange(len(words))
    owners, numbers = [], []

    def add(owner: np.ndarray, kind: int, n: int, at: np.ndarray) -> None:
        owners.append(owner)
        numbers.append(grams[n][at] * np.uint64(4) + np.uint64(kind))

    for n in (1, 2, 3):
        long = lengths >= n
        add(every[long], 0, n, starts[long] + 1)
        add(every[long], 1, n, ends[long] - 1 - n)
    for n in (2, 3):
        counts = lengths + 3 - n
        add(np.repeat(every, counts), 2, n, np.arange(counts.sum()) + np.repeat(starts - np.cumsum(counts) + counts, counts))
    frequent = [i for i, w in enumerate(words) if w in lexicon]
    owners.append(np.array(frequent, np.int64))
    numbers.append(np.array([zlib.crc32(words[i].encode()) << 2 | 3 for i in frequent], np.uint64))
    buckets = (mixed(np.concatenate(numbers)) % np.uint64(BUCKETS)).astype(np.int64)
    found = np.concatenate(owners) * BUCKETS + buckets
    found.sort()
    found = found[np.diff(found, prepend=-1) > 0]
    return found % BUCKETS, np.bincount(found // BUCKETS, minlength=len(words))


def forward_backward(
    emission: np.ndarray, transition: np.ndarray, first: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors of every word, and the expected transitions summed over all chains.

    ``emission`` and ``transition`` hold log weights; chain c has the rows
    ``first[c]`` to ``first[c + 1]``. Chains advance together, longest first, so
    a step costs as much as there are chains of its length.
    """
    e = np.exp(emission - emission.max(axis=1, keepdims=True))
    t = np.exp(transition - transition.max())
    lengths = np.diff(first)
    order = np.argsort(-lengths, kind="stable")
    begins, ordered = first[:-1][order], lengths[order]
    steps = int(ordered[0]) if len(ordered) else 0
    live = np.searchsorted(-ordered, -np.arange(steps), "left")  # chains longer than each step
    alpha, beta = np.empty_like(e), np.ones_like(e)
    for s in range(steps):
        at = begins[:live[s]] + s
        a = e[at] if s == 0 else (alpha[at - 1] @ t) * e[at]
        alpha[at] = a / a.sum(axis=1, keepdims=True)
    pairs = np.zeros_like(t)
    for s in range(steps - 2, -1, -1):
        at = begins[:live[s + 1]] + s
        ahead = e[at + 1] * beta[at + 1]
        b = ahead @ t.T
        pairs += t * (alpha[at] / (alpha[at] * b).sum(axis=1, keepdims=True)).T.dot(ahead)
        beta[at] = b / b.sum(axis=1, keepdims=True)
    posterior = alpha * beta
    return posterior / posterior.sum(axis=1, keepdims=True), pairs


@dataclass
class Crf:
    languages: list[str]
    lexicon: frozenset[str] = frozenset()
    weights: np.ndarray | None = None
    transition: np.ndarray | None = None
    known: dict[str, int] = field(default_factory=dict)
    table: np.ndarray | None = None

    def __getstate__(self):
        return self.__dict__ | {"known": {}, "table": None}

    def emissions(self, words: list[str]) -> np.ndarray:
        """Log weights of each word for each language; words met before are remembered."""
        new = list(set(words) - self.known.keys())
        if len(self.known) + len(new) > min(REMEMBERED, 16 * CELLS // len(self.languages)):
            self.known, self.table, new = {}, None, list(set(words))
        if new:
            buckets, sizes = features(new, self.lexicon)
            sums = np.add.reduceat(self.weights[buckets], np.cumsum(sizes) - sizes, axis=0)
            base = len(self.known)
            self.known.update((w, base + i) for i, w in enumerate(new))
            self.table = sums if self.table is None else np.concatenate([self.table, sums])
        known = self.known
        return self.table[[known[w] for w in words]]

    def document_shares(self, texts: list[str | None]) -> np.ndarray:
        """Share of each language in each text; zeros where a text has no letter."""
        shares = np.zeros((len(texts), len(self.languages)))
        words: list[str] = []
        first, owner = [0], []

        def add() -> None:
            posterior, _ = forward_backward(self.emissions(words), self.transition, np.array(first))
            of_line = np.add.reduceat(posterior, first[:-1], axis=0, dtype=np.float64)
            np.add.at(shares, owner, of_line)

        for row, text in enumerate(texts):
            for line in lines_of(text):
                words += line
                first.append(len(words))
                owner.append(row)
                if len(words) * len(self.languages) >= CELLS:
                    add()
                    words, first, owner = [], [0], []
        if words:
            add()
        total = shares.sum(axis=1, keepdims=True)
        return np.divide(shares, total, out=shares, where=total > 0)


def train(labelled: list[tuple[str, str]], languages: list[str]) -> Crf:
    """A field from chains (line, language) by gradient steps with per-weight rates."""
    index = {name: i for i, name in enumerate(languages)}
    chains = [(words_of(line.lower()), index[lang]) for line, lang in labelled]
    chains = [(w[i:i + CHAIN_WORDS], k) for w, k in chains for i in range(0, len(w), CHAIN_WORDS)]
    rng = np.random.default_rng(7)
    counts: dict[str, int] = {}
    for words, _ in chains:
        for w in words:
            counts[w] = counts.get(w, 0) + 1
    lexicon = frozenset(sorted(counts, key=lambda w: (-counts[w], w))[:LEXICON_WORDS])
    crf = Crf(languages, lexicon, np.zeros((BUCKETS, len(languages)), np.float32),
              np.zeros((len(languages), len(languages)), np.float32))
    spliced = []
    for i in rng.permutation(len(chains)).tolist():
        words, k = chains[i]
        tags = [k] * len(words)
        if rng.random() < 0.5:
            other, j = chains[int(rng.integers(len(chains)))]
            words, tags = words + other, tags + [j] * len(other)
        spliced.append((words, tags))
    vocabulary = {w: i for i, w in enumerate(counts)}
    buckets, sizes = features(list(vocabulary), lexicon)
    width = int(sizes.max(initial=0))
    padded = np.full((len(sizes), width), BUCKETS)
    padded[np.arange(width) < sizes[:, None]] = buckets
    squares = np.full((BUCKETS + 1, len(languages)), 1e-6, np.float32)
    weights = np.zeros((BUCKETS + 1, len(languages)), np.float32)
    transition_squares = np.full_like(crf.transition, 1e-6)
    for _ in range(EPOCHS):
        for at in range(0, len(spliced), 256):
            part = spliced[at:at + 256]
            ids = np.array([vocabulary[w] for words, _ in part for w in words])
            tags = np.array([t for _, ts in part for t in ts])
            first = np.concatenate([[0], np.cumsum([len(ts) for _, ts in part])])
            rows = padded[ids]
            emission = weights[rows[:, 0]]
            for column in rows.T[1:]:
                emission += weights[column]
            posterior, expected = forward_backward(emission, crf.transition, first)
            error = -posterior
            error[np.arange(len(tags)), tags] += 1
            inside = np.ones(len(tags), bool)
            inside[first[1:] - 1] = False
            seen = np.zeros_like(crf.transition)
            np.add.at(seen, (tags[:-1][inside[:-1]], tags[1:][inside[:-1]]), 1)
            gradient = np.zeros_like(weights)
            for j in range(len(languages)):
                gradient[:, j] = np.bincount(rows.ravel(), np.repeat(error[:, j], width), BUCKETS + 1)
            gradient = gradient / len(part) - RIDGE * weights
            squares += gradient ** 2
            weights += RATE * gradient / np.sqrt(squares)
            weights[BUCKETS] = 0
            step = (seen - expected) / len(part) - RIDGE * crf.transition
            transition_squares += step ** 2
            crf.transition += RATE * step / np.sqrt(transition_squares)
    crf.weights = weights[:BUCKETS]
    return crf


def fit(docs: DataFrame) -> Crf | None:
    """The field of the bounded sample; None if nothing is labelled."""
    small_batches(docs.sparkSession, ROWS)
    rows = docs.select("doc_id", "text", "lang").where("doc_id is not null and text is not null and lang is not null")
    # Numbers are ordered, not texts, and of a language only those below a hash that twice as many as wanted should meet.
    ids = stored(rows.where(~held_out()).select("lang", "doc_id").distinct(), "language-ids")
    counts = ids.groupBy("lang").count()
    wanted = ids.join(F.broadcast(counts), "lang").withColumn("hash", F.xxhash64("doc_id"))
    wanted = wanted.where(F.col("hash") / 2.0 ** 64 + 0.5 <= 2.0 * FIT_ROWS / F.col("count"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("hash", "doc_id"))
    chosen = wanted.withColumn("rank", rank).where(F.col("rank") <= FIT_ROWS).select("lang", "doc_id")
    sample = stored(rows.join(F.broadcast(stored(chosen, "language-chosen")), ["lang", "doc_id"]), "language-fit")
    languages = [r["lang"] for r in counts.collect()]
    pieces = (
        sample.select("doc_id", "lang", F.posexplode(F.split("text", "\n")).alias("at", "line"))
        .select("doc_id", "lang", "at", F.posexplode(F.expr(
            rf"regexp_extract_all(line, '(\\S+\\s*){{1,{CHAIN_WORDS}}}', 0)")).alias("part", "line"))
    )
    # Rarer languages come first, in turns, so that each has ``LEAST_CHAINS`` if there are so many.
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", "at", "part"), "line"))
    chosen = pieces.withColumn("turn", turn).orderBy("turn", "lang").limit(max(FIT_CHAINS, LEAST_CHAINS * len(languages)))
    labelled = [(r["line"], r["lang"]) for r in chosen.select("line", "lang").collect()]
    return train(labelled, sorted(languages)) if labelled else None


def identify(docs: DataFrame, crf: Crf | None) -> DataFrame:
    """Rows (doc_id, lang_pred, score)."""
    return over_batches(docs.select("doc_id", "text"), _predictor(docs, crf, ["doc_id"]),
                        "doc_id long, lang_pred string, score double")


def _predictor(docs: DataFrame, crf: Crf | None, kept: list[str]):
    small_batches(docs.sparkSession, ROWS)
    shared = docs.sparkSession.sparkContext.broadcast(crf)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        crf, texts = shared.value, batch.column("text").to_pylist()
        shares = np.zeros((len(texts), 1)) if crf is None else crf.document_shares(texts)
        best = shares.argmax(axis=1)
        score = shares[np.arange(len(texts)), best]
        names = [UNKNOWN if s == 0 else crf.languages[b] for s, b in zip(score, best)]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in kept), pa.array(names, pa.string()), pa.array(np.minimum(score, 1.0))],
            [*kept, "lang_pred", "score"],
        )

    return work


def language_id(docs: DataFrame) -> DataFrame:
    """Fit on the labelled rows and identify every document."""
    return identify(docs, fit(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def with_language(docs: DataFrame) -> DataFrame:
    """All columns of ``docs``, without those whose language cannot be told (``und``)."""
    crf = fit(docs)
    columns = docs.columns
    inner = _predictor(docs, crf, columns)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = inner(batch)
        keep = pa.array([n != UNKNOWN for n in found.column("lang_pred").to_pylist()], pa.bool_())
        return found.select(columns).filter(keep)

    return over_batches(docs, work, docs.schema)
