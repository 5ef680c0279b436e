"""Lexical search, token files and spelling variants against brute force and round trips."""

from __future__ import annotations

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest

from railpulse.llm import lexical, spelling, token_files
from railpulse.llm.queries import tokenizer_path
from railpulse.llm.treap import Treap, compressed
from railpulse.session import scratch_path

DOCS = "doc_id long, text string, rank string, word string, n int, start long"
ITEMS = "item_id long, text string, score double"
LOWER = {i: i + 32 for i in range(65, 91)}


def table(spark, rows, schema):
    """Rows with extra columns whose names clash with those of the results."""
    wide = len(schema.split(","))
    return spark.createDataFrame([(*r, *[None] * (wide - len(r))) for r in rows], schema)


# -- the treap -------------------------------------------------------------


@pytest.mark.parametrize("seed", range(6))
def test_treap_finds_the_best_columns(seed):
    draw = random.Random(seed)
    n_rows, n_columns = draw.choice([(1, 1), (3, 200), (300, 5), (40, 700)])
    cells = {(draw.randrange(n_rows), draw.randrange(n_columns)): draw.choice([1, 2, 300, 70_000, 1 << 40]) for _ in range(900)}
    rows, columns = (np.array(c) for c in zip(*cells))
    treap = Treap(compressed(rows, columns, np.array(list(cells.values()))))
    for _ in range(10):
        asked = collections.Counter(draw.randrange(n_rows) for _ in range(draw.randint(1, 12)))
        sums = collections.Counter()
        for (r, c), w in cells.items():
            if asked[r]:
                sums[c] += asked[r] * w
        best = sorted(((-s, c) for c, s in sums.items()))[:7]
        got = treap.best_columns(np.array(list(asked)), np.array(list(asked.values())), 7, beam=draw.choice([1, 8, 128]))
        assert [(-s, c) for c, s in zip(*map(np.ndarray.tolist, got))] == best


def test_empty_treap():
    none = np.zeros(0, np.int64)
    assert not len(Treap(compressed(none, none, none)).best_columns(np.array([0]), np.array([1]), 3)[0])


# -- lexical search ----------------------------------------------------------


def ranking(docs, items, best=20):
    pattern = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
    terms = lambda t: [x.translate(LOWER) for x in pattern.findall(t or "")]
    counted = [(d, collections.Counter(t), len(t)) for d, t in ((r[0], terms(r[1])) for r in docs) if t]
    n_docs, total = len(counted), sum(n for _, _, n in counted)
    df = collections.Counter(t for _, c, _ in counted for t in c)
    found = []
    for item_id, text in set((i[0], i[1]) for i in items):
        scores = []
        for d, c, n in counted:
            m = 100 - 25 + (25 * n * n_docs) // total
            weight = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
            score = sum(weight(t) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t])
            if score > 0:
                scores.append((-score, d is not None, d))
        found += [(item_id, k + 1, d, -s) for k, (s, _, d) in enumerate(sorted(scores)[:best])]
    return sorted(found, key=str)


def drawn_documents(seed, rows=300):
    draw = random.Random(seed)
    words = ["the", "Ünit", "über", "x9", "A", "train", "delay", "zug", "日本", "don't", "e-mail", "ÉTÉ", *(f"w{i}" for i in range(60))]
    docs = [(i, " ".join(draw.choices(words, k=draw.randint(0, 40)))) for i in range(rows)]
    docs += [(7, "the the train"), (7, "the the train"), (None, "train delay"), (None, None), (900, ""), (901, "?!"), (902, "delay " * 30_000)]
    return docs + [(1000 + i, "train copy of copies") for i in range(80)]


ASKED = [(1, "The train's DELAY, the über-Ünit x9"), (2, None), (3, ""), (4, "unseen words only"), (5, "日本 copy copy"), (1, "w1 w2 w3"), (1, "w1 w2 w3"), (6, "delay")]


@pytest.mark.parametrize("shard_docs, block_bytes", [(1 << 14, 1 << 20), (50, 12)])
def test_search_equals_brute_force(spark, monkeypatch, shard_docs, block_bytes):
    monkeypatch.setattr(lexical, "SHARD_DOCS", shard_docs)
    monkeypatch.setattr(lexical, "BLOCK_BYTES", block_bytes)
    docs = drawn_documents(1)
    found = lexical.rank_documents(table(spark, docs, DOCS).repartition(3), table(spark, ASKED, ITEMS))
    assert sorted((tuple(r) for r in found.collect()), key=str) == ranking(docs, ASKED)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]


def test_search_without_rows(spark):
    docs, items = table(spark, [(1, "a b")], DOCS), table(spark, [(1, "a b")], ITEMS)
    assert not lexical.rank_documents(docs.limit(0), items).collect()
    assert not lexical.rank_documents(docs, items.limit(0)).collect()
    assert not lexical.rank_documents(table(spark, [(1, "-")], DOCS), items).collect()


# -- token files -------------------------------------------------------------


TEXTS = [
    (5, "Plain words, and MORE words."), (-3, ""), (8, None), (None, "a"), (None, "b"), (5, "again"), (5, "again"),
    (40, "it's 3.14 naïve…  x.y,z &&& don't***  ½ ² straße\x1cA <|endoftext|> Σίσυφος é"), (41, "long " * 60_000),
    (42, "mot&&& ça'va 12ab ab12 'sup O'Neil's end."),
]


def expected_tokens(rows, end_id=1):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    tokenizer.encode_special_tokens = False
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [end_id] for _, t in rows]


@pytest.mark.parametrize("segment_tokens", [1 << 21, 40])
def test_token_files_round_trip(spark, monkeypatch, segment_tokens):
    monkeypatch.setattr(token_files, "SEGMENT_TOKENS", segment_tokens)
    rows = TEXTS + [(100 + i, f"short text number {i} of many {i * i}") for i in range(300)]
    digest = token_files.token_digest(table(spark, rows, DOCS).repartition(4), tokenizer_path()).collect()
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    want = [(r[0], len(ids), crc(ids)) for r, ids in zip(rows, expected_tokens(rows))]
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in digest), key=str) == sorted(want, key=str)
    digest.sort(key=lambda r: r.start)
    assert [r.start for r in digest] == [sum(x.n_tokens for x in digest[:k]) for k in range(len(digest))]
    order = [(r.doc_id is not None, r.doc_id or 0) for r in digest]
    assert order == sorted(order)


def test_a_few_documents_are_found(spark):
    rows = [(i, f"document {i} says {'ja ' * i}") for i in range(0, 200, 2)] + [(None, "nobody")]
    root = scratch_path(spark, "tokens-test")
    token_files.write_tokens(table(spark, rows, DOCS), root, tokenizer_path())
    everything = {r.doc_id: tuple(r) for r in token_files.read_tokens(spark, root).collect()}
    want = dict(zip((r[0] for r in rows), expected_tokens(rows)))
    assert {k: np.frombuffer(v[3], "<u4").tolist() for k, v in everything.items()} == want
    found = token_files.find_tokens(spark, root, [4, 5, 198, None]).collect()
    assert sorted(map(tuple, found), key=str) == sorted((everything[k] for k in (4, 198, None)), key=str)
    assert not token_files.find_tokens(spark, root, [10**6]).collect()


def test_changed_files_are_refused(spark):
    root = scratch_path(spark, "tokens-test")
    token_files.write_tokens(table(spark, [(i, f"text {i}") for i in range(50)], DOCS), root, tokenizer_path())
    content = bytearray(token_files._segments(spark, root).first().content)
    content[-3] ^= 1
    with pytest.raises(token_files.BadStore):
        token_files._opened(__import__("pyarrow").py_buffer(bytes(content)))


def test_token_files_of_nothing(spark):
    assert not token_files.token_digest(table(spark, [], DOCS), tokenizer_path()).collect()
    one = token_files.token_digest(table(spark, [(3, None)], DOCS), tokenizer_path()).collect()
    assert [(r.doc_id, r.start, r.n_tokens) for r in one] == [(3, 0, 1)]


# -- spelling ------------------------------------------------------------------


def variants(rows):
    counts = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        if len(a) > len(b):
            a, b = b, a
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))

    found = {}
    for w, n in words.items():
        others = [o for o in words if o != w and near(w, o)]
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form = best if best is not None and words[best] >= 5 * n else None
        found[w] = (form, n, len(others), words[form] if form else None)

    def root(w):
        return root(found[w][0]) if found[w][0] else w

    return sorted((w, form, root(w), *rest) for w, (form, *rest) in found.items())


def spelled_documents(seed):
    draw = random.Random(seed)
    bases = ["station", "Straße", "délayed", "aaaaaa", "aaaaaaa", "ÀÉtrange", "xaxaxa", "platform", "abcdef", "bcdefa", "×mal÷en"]
    rows = []
    for k in range(400):
        text = []
        for _ in range(30):
            w = draw.choice(bases)
            if draw.random() < 0.25:
                p = draw.randrange(len(w))
                w = draw.choice([w[:p] + w[p + 1:], w[:p] + draw.choice("aeé") + w[p:], w[:p] + draw.choice("aeß") + w[p + 1:]])
            text.append(w.upper() if draw.random() < 0.1 else w)
        rows.append((draw.choice([k, k, None]), " ".join(text)))
    # A chain: each form five times as frequent as the word before.
    rows += [(900, "chainea " * 5), (901, "chaineb " * 30), (902, "chainebb " * 160), (903, "chainebbb " * 900)]
    return rows + [(904, None), (905, ""), (906, "12 ?"), (906, "12 ?")]


@pytest.mark.parametrize("tile, chunk", [(1024, 1024), (4, 16)])
def test_spelling_equals_brute_force(spark, monkeypatch, tile, chunk):
    monkeypatch.setattr(spelling, "TILE_WORDS", tile)
    monkeypatch.setattr(spelling, "CHUNK_WORDS", chunk)
    rows = spelled_documents(2)
    found = spelling.spelling_variants(table(spark, rows, DOCS).repartition(3))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = sorted(map(tuple, found.collect()))
    assert got == variants(rows)
    assert dict((r[0], r[2]) for r in got)["chainea"] == "chainebbb"


def test_no_spellings(spark):
    assert not spelling.spelling_variants(table(spark, [], DOCS)).collect()
    alone = spelling.spelling_variants(table(spark, [(1, "lonesome " * 9)], DOCS)).collect()
    assert [tuple(r) for r in alone] == [("lonesome", None, "lonesome", 9, 0, None)]
