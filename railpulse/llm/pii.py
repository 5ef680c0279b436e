"""Personal data: patterns propose spans, checksums confirm, nearby words score.

A span has a kind, a start and an end (code points, end exclusive) and a score:

* ``email``, ``ip``, ``card`` (Luhn) and ``phone`` are the base kinds. Every
  candidate that passes its check is a span, whatever its score.
* ``iban`` (modulo 97) and ``id_number`` (nine digits as 3-2-4) are added. An
  IBAN needs its checksum; an id number needs a telling word nearby, as it has
  no checksum. Added spans never replace or shorten base spans.

The score starts from how strong the check of the kind is, and telling words in
the 40 code points before the span raise it.

Null and empty texts have no spans. Rows are handled one by one: equal rows give
equal results, and an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from railpulse.llm.common import over_batches, small_batches

# The base patterns of the contract. Those of e-mails and addresses are written so that no run of characters is
# tried from each of its places: a match that fails at the first of a run fails at all of them.
_LOCAL = r"[A-Za-z0-9._%+-]"
EMAIL_HERE = re.compile(_LOCAL + r"++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
EMAIL = re.compile(rf"(?<!{_LOCAL}){EMAIL_HERE.pattern}")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
BASE_KINDS = ("email", "ip", "card", "phone")

IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b")
ID_NUMBER = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
ADDED_KINDS = ("iban", "id_number")
KINDS = BASE_KINDS + ADDED_KINDS

STRENGTH = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "id_number": 0.3}
TELLING = {
    "email": re.compile(r"mail|contact|write", re.I),
    "ip": re.compile(r"\bip\b|address|host|server", re.I),
    "card": re.compile(r"card|visa|credit|karte|carte|tarjeta", re.I),
    "phone": re.compile(r"phone|call|tel|mobile|fax", re.I),
    "iban": re.compile(r"iban|account|bank|konto|cuenta|compte", re.I),
    "id_number": re.compile(r"ssn|social|security|\bid\b|tax", re.I),
}
NEARBY = 40
BONUS = 0.3
NEEDED = 0.5


@dataclass(frozen=True)
class Span:
    start: int
    end: int
    kind: str
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d)
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _ip_ok(found: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:4] or "0") <= 255 for p in found.split("."))


def _card_ok(found: str) -> bool:
    digits = _digits(found)
    return 12 <= len(digits) <= 19 and luhn(digits)


def _phone_ok(found: str) -> bool:
    return 9 <= len(_digits(found)) <= 15


def _iban_ok(found: str) -> bool:
    plain = found.replace(" ", "")
    return 15 <= len(plain) <= 34 and mod97(plain)


def emails(text: str) -> Iterator[re.Match]:
    """Addresses from left to right; one may begin inside a run, where the one before it has ended."""
    at = 0
    while m := EMAIL_HERE.match(text, at) or EMAIL.search(text, at):
        yield m
        at = m.end()


def spans(text: str | None) -> list[Span]:
    """All spans of a text, by start, then by kind in the order of ``KINDS``."""
    if not text:
        return []
    proposed = []
    if "@" in text:
        proposed += [("email", m) for m in emails(text)]
    if "." in text:
        proposed += [("ip", m) for m in IP.finditer(text) if _ip_ok(m[0])]
    proposed += [("card", m) for m in CARD.finditer(text) if m.end() - m.start() >= 12 and _card_ok(m[0])]
    if "+" in text:
        proposed += [("phone", m) for m in PHONE.finditer(text) if _phone_ok(m[0])]
    proposed += [("iban", m) for m in IBAN.finditer(text) if _iban_ok(m[0])]
    if "-" in text:
        proposed += [("id_number", m) for m in ID_NUMBER.finditer(text)]
    found = []
    for kind, m in proposed:
        told = TELLING[kind].search(text, max(0, m.start() - NEARBY), m.start()) is not None
        score = min(1.0, STRENGTH[kind] + BONUS * told)
        if kind in BASE_KINDS or score >= NEEDED:
            found.append(Span(m.start(), m.end(), kind, round(score, 3)))
    return sorted(found, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def as_text(found: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in found)


def redacted(text: str | None, found: list[Span]) -> str | None:
    """The text with every span replaced by its kind in brackets; overlaps go as one."""
    if not found:
        return text
    parts, at = [], 0
    for s in sorted(found, key=lambda s: (s.start, -s.end)):
        if s.start >= at:
            parts += [text[at:s.start], f"[{s.kind}]"]
        at = max(at, s.end)
    return "".join(parts) + text[at:]


def find_pii(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are ignored): its spans with scores."""
    small_batches(docs.sparkSession)
    span = "array<struct<start: long, `end`: long, kind: string, score: double>>"
    kind = pa.list_(pa.struct([
        ("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("score", pa.float64()),
    ]))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [
            [{"start": s.start, "end": s.end, "kind": s.kind, "score": s.score} for s in spans(t)]
            for t in batch.column("text").to_pylist()
        ]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], ["doc_id", "spans"])

    return over_batches(docs.select("doc_id", "text"), work, f"doc_id long, spans {span}")


def pii_digest(docs: DataFrame) -> DataFrame:
    """Per row: how many spans of each base kind, a digest of the base spans, and all spans."""
    small_batches(docs.sparkSession)
    counts = [f"n_{k}" for k in BASE_KINDS]
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in counts) + ", base_sha256 string, spans string"

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns: list[list] = [[] for _ in range(len(counts) + 2)]
        for text in batch.column("text").to_pylist():
            found = spans(text)
            base = [s for s in found if s.kind in BASE_KINDS]
            for column, kind in zip(columns, BASE_KINDS):
                column.append(sum(s.kind == kind for s in base))
            columns[-2].append(hashlib.sha256(as_text(base).encode()).hexdigest())
            columns[-1].append(as_text(found))
        kinds = [pa.int64()] * len(counts) + [pa.string()] * 2
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))],
            ["doc_id", *counts, "base_sha256", "spans"],
        )

    return over_batches(docs.select("doc_id", "text"), work, schema)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with the spans of ``text`` replaced and their ``n_chars`` counted anew; all else stays."""
    small_batches(docs.sparkSession)
    columns = docs.columns

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        safe = [redacted(t, spans(t)) for t in texts]
        new = {"text": pa.array(safe, pa.string())}
        if "n_chars" in columns:
            held = batch.column("n_chars").to_pylist()
            new["n_chars"] = pa.array(
                [n if a is b else len(b) for n, a, b in zip(held, texts, safe)], pa.int64()
            )
        return pa.RecordBatch.from_arrays([new.get(c, batch.column(c)) for c in columns], columns)

    return over_batches(docs, work, docs.schema)
