"""Toxic passages by maximum-scoring segments over token log-odds.

Learning. A word counts under its whole form and its prefixes of 4 to 7 letters
(its units), since abuse is inflected. Each unit gets the log-odds of toxic
against clean labelled text under a Dirichlet prior set by its pooled
frequency. A unit is kept if its signed-root likelihood ratio exceeds what the
largest of that many chance units would show. Occurrences count by distinct
following words where those are few, so a text that is copied many times is not
evidence many times over.

Scoring. A word scores its most significant unit's log-odds, any other word
``DRIFT``. All maximal-scoring segments are found in one pass (linear time). By
the extreme-value law of such scores a segment of score S in n words has the
expected number K n exp(-lambda S) by chance, with lambda the root of the
score distribution's moment equation. A document's evidence is the sum of
log(1 / expected number) over its significant segments, and a logistic curve
fitted to labelled rows turns evidence into the score.

The classifier is fitted on at most ``FIT_ROWS`` labelled rows, those with the
smallest hash of their doc_id, and keeps at most ``MAX_UNITS`` units; all other
steps cover every document and its whole text.

Defined cases: null and empty texts have no evidence; rows of ``labels`` with
null are not used, and repeated ones count as toxic if any is; without labels
of both kinds every score is 0; repeated documents get equal scores; empty
tables give no rows.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from railpulse.llm.common import held_out, over_batches, small_batches, stored

FIT_ROWS = 20_000
MAX_UNITS = 50_000
PREFIXES = (7, 6, 5, 4)
DRIFT = -0.25
LEAST_ODDS = 1.0
PRIOR = 0.5
PRIOR_SHARE = 0.02
CHANCE = 1.0  # K of the extreme-value law, absorbed by the logistic curve
FLUSH_WORDS = 400_000
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end exclusive, score), left to right.

    Linear time: only positions of positive score open a candidate, and the
    negative stretch between two of them enters as the difference of sums.
    """
    positive = np.flatnonzero(scores > 0)
    if not len(positive):
        return []
    sums = np.concatenate([[0.0], np.cumsum(scores, dtype=np.float64)])
    # A stack of candidates: start, end, sum before it, sum at its end, and the
    # nearest candidate to the left with a smaller sum before it.
    stack: list[tuple[int, int, float, float, int]] = []
    for at in positive.tolist():
        start, end, low, high = at, at + 1, float(sums[at]), float(sums[at + 1])
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= low:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= high:
                stack.append((start, end, low, high, j))
                break
            start, low = stack[j][0], stack[j][2]
            del stack[j:]
    return [(s, e, high - low) for s, e, low, high, _ in stack]


@dataclass
class Model:
    units: dict[str, tuple[float, float]] = field(default_factory=dict)  # log-odds and significance
    rate: float = 1.0  # lambda of the extreme-value law
    intercept: float | None = None
    slope: float = 0.0
    known: dict[str, float] = field(default_factory=dict)

    def __getstate__(self):
        return self.__dict__ | {"known": {}}

    def word_score(self, word: str) -> float:
        found = self.known.get(word)
        if found is None:
            best = (0.0, 0.0)
            for unit in units_of(word):
                hit = self.units.get(unit)
                if hit is not None and hit[1] > best[1]:
                    best = hit
            found = best[0] if best[0] > 0 else DRIFT
            if len(self.known) > FLUSH_WORDS:
                self.known.clear()
            self.known[word] = found
        return found

    def passages(self, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of words, and the significant segments with their evidence."""
        words = words_of(text)
        if not words or not self.units:
            return len(words), []
        known, score = self.known, self.word_score
        scores = np.array([known[w] if w in known else score(w) for w in words])
        found = []
        for start, end, total in maximal_segments(scores):
            evidence = self.rate * total - math.log(CHANCE * len(words))
            if evidence > 0:
                found.append((start, end, evidence))
        return len(words), found

    def evidence(self, text: str | None) -> float:
        return sum(e for _, _, e in self.passages(text)[1])

    def probability(self, evidence: float) -> float:
        if self.intercept is None:
            return 0.0
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.intercept + self.slope * evidence))))


def units_of(word: str) -> list[str]:
    return [word + "$"] + [word[:n] for n in PREFIXES if len(word) >= n]


def fit_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The bounded sample (text, toxic) of labelled rows outside the held-out fold."""
    chosen = (
        labels.select("doc_id", "toxic").where("doc_id is not null and toxic is not null")
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .where(~held_out()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS)
    )
    # At most FIT_ROWS rows of two numbers are broadcast.
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def _word_counts(rows: DataFrame) -> DataFrame:
    """Words with their occurrences in toxic and clean rows, and a 64-bit sketch of following words."""
    names = ["word", "toxic", "clean", "toxic_next", "clean_next"]

    def run(batches):
        held: dict[str, list[int]] = {}
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                words = words_of(text)
                bits = {w: 1 << (zlib.crc32(w.encode()) & 63) for w in set(words)}
                side = 0 if toxic == 1 else 1
                for word, following in zip(words, [*words[1:], words[0]] if words else []):
                    entry = held.get(word)
                    if entry is None:
                        entry = held[word] = [0, 0, 0, 0]
                    entry[side] += 1
                    entry[side + 2] |= bits[following]
            if len(held) > FLUSH_WORDS:
                yield _counted(held, names)
                held = {}
        if held:
            yield _counted(held, names)

    return rows.mapInArrow(run, ", ".join(f"{n} {'string' if n == 'word' else 'long'}" for n in names))


def _counted(held: dict[str, list[int]], names: list[str]) -> pa.RecordBatch:
    numbers = np.array(list(held.values()), np.uint64).view(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(held), pa.string()), *(pa.array(numbers[:, i].copy()) for i in range(4))], names
    )


def _merged(counts: DataFrame, key: str) -> DataFrame:
    return counts.groupBy(key).agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"),
        F.bit_or("toxic_next").alias("toxic_next"), F.bit_or("clean_next").alias("clean_next"),
    )


def _distinct(count: str, sketch: str) -> F.Column:
    """Occurrences, or the distinct following words (linear counting) while the sketch can tell."""
    empty = F.lit(64) - F.bit_count(sketch)
    estimate = -64 * F.log(empty / 64.0)
    return F.when(empty >= 4, F.least(F.col(count), estimate)).otherwise(F.col(count)).cast("double")


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    small_batches(docs.sparkSession)
    rows = stored(fit_rows(docs, labels), "toxicity-fit")
    words = stored(_merged(_word_counts(rows), "word"), "toxicity-words")
    toxic, clean = words.agg(F.sum("toxic"), F.sum("clean")).first()
    model = Model()
    if not toxic or not clean:
        return model
    prefixes = [F.when(F.length("word") >= n, F.substring("word", 1, n)) for n in PREFIXES]
    units = _merged(
        words.withColumn("unit", F.explode(F.array_compact(F.array(F.concat("word", F.lit("$")), *prefixes)))), "unit"
    ).select("unit", _distinct("toxic", "toxic_next").alias("t"), _distinct("clean", "clean_next").alias("c"))
    prior = F.lit(PRIOR) + PRIOR_SHARE * (F.col("t") + F.col("c"))
    odds = F.log((F.col("t") + prior) / toxic) - F.log((F.col("c") + prior) / clean)
    share = toxic / (toxic + clean)
    total = F.col("t") + F.col("c")
    ratio = 2 * (
        F.when(F.col("t") > 0, F.col("t") * F.log(F.col("t") / (total * share))).otherwise(0)
        + F.when(F.col("c") > 0, F.col("c") * F.log(F.col("c") / (total * (1 - share)))).otherwise(0)
    )
    scored = stored(units.select("unit", "t", "c", odds.alias("odds"), F.sqrt(F.greatest(ratio, F.lit(0.0))).alias("z")), "toxicity-units")
    chance = math.sqrt(2 * math.log(max(2, scored.count())))
    kept = scored.where((F.col("odds") >= LEAST_ODDS) & (F.col("z") >= chance)).orderBy(F.desc("z"), "unit").limit(MAX_UNITS)
    model.units = {r["unit"]: (r["odds"], r["z"]) for r in kept.collect()}
    if model.units:
        _calibrate(model, rows, words, clean)
    return model


def _calibrate(model: Model, rows: DataFrame, words: DataFrame, clean: int) -> None:
    """Lambda from the scores of clean words; the curve from labelled rows, binned by evidence."""
    shared = model

    def scores(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = [round(shared.word_score(w), 2) for w in batch.column("word").to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(values, pa.float64()), batch.column("clean")], ["score", "clean"])

    spread = over_batches(words.where("clean > 0").select("word", "clean"), scores, "score double, clean long")
    counts = spread.groupBy("score").agg(F.sum("clean").alias("n")).collect()
    model.rate = extreme_value_rate([(r["score"], r["n"] / clean) for r in counts])

    def binned(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = [min(200, round(2 * shared.evidence(t)) / 2) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(values, pa.float64()), batch.column("toxic").cast(pa.int64())], ["evidence", "toxic"])

    bins = over_batches(rows, binned, "evidence double, toxic long").groupBy("evidence").agg(
        F.count("*").alias("n"), F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")
    ).collect()
    model.intercept, model.slope = logistic([(r["evidence"], r["n"], r["toxic"]) for r in bins])


def extreme_value_rate(distribution: list[tuple[float, float]]) -> float:
    """The positive root of E[exp(x * score)] = 1; 1 where scores are never positive or drift upwards."""
    if not any(s > 0 and p > 0 for s, p in distribution) or sum(s * p for s, p in distribution) >= 0:
        return 1.0
    low, high = 0.0, 8.0
    for _ in range(100):
        middle = (low + high) / 2
        if sum(p * math.exp(middle * s) for s, p in distribution) < 1:
            low = middle
        else:
            high = middle
    return max(0.05, (low + high) / 2)


def logistic(bins: list[tuple[float, int, int]]) -> tuple[float | None, float]:
    """Intercept and slope by Newton steps with a weak prior; None without both kinds of rows."""
    x = np.array([b[0] for b in bins]) if bins else np.zeros(0)
    n = np.array([b[1] for b in bins], float)
    y = np.array([b[2] for b in bins], float)
    if not len(bins) or y.sum() == 0 or y.sum() == n.sum():
        return None, 0.0
    x = np.minimum(x, 30.0)
    design = np.column_stack([np.ones(len(x)), x])
    weights = np.array([math.log((y.sum() + 0.5) / (n.sum() - y.sum() + 0.5)), 0.1])
    prior = np.diag([0.01, 0.1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ weights))
        step = np.linalg.solve(
            design.T @ (design * (n * p * (1 - p))[:, None]) + prior, design.T @ (y - n * p) - prior @ weights
        )
        weights = weights + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(weights[0]), float(max(weights[1], 0.0))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Rows (doc_id, score, evidence, passages): passages as word spans with their evidence."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("evidence", pa.float64())])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = shared.value
        evidence, passages = [], []
        for text in batch.column("text").to_pylist():
            found = model.passages(text)[1]
            evidence.append(sum(e for _, _, e in found))
            passages.append([{"start": s, "end": e, "evidence": v} for s, e, v in found])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([model.probability(min(e, 30.0)) for e in evidence], pa.float64()),
             pa.array(evidence, pa.float64()), pa.array(passages, pa.list_(span))],
            ["doc_id", "score", "evidence", "passages"],
        )

    return over_batches(
        docs.select("doc_id", "text"), work,
        "doc_id long, score double, evidence double, "
        "passages array<struct<start: long, `end`: long, evidence: double>>",
    )


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labelled rows and score every document."""
    return score(docs, fit(docs, labels)).select(
        "doc_id", held_out().alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"),
        F.size("passages").cast("long").alias("n_passages"),
    )
