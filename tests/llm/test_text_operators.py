"""Operators on texts against brute force, and their defined cases."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from llm.conftest import AWKWARD, prose
from tokenizers import Tokenizer

from railpulse.llm import decontaminate, language, ngram_join, packing, pii, repeats, toxicity
from railpulse.llm.rindex import RunLengthIndex


def shingles(text):
    words = decontaminate.words_of(text)
    if not words:
        return frozenset()
    return frozenset(zip(*(words[j:] for j in range(5)))) if len(words) >= 5 else frozenset([tuple(words)])


def components(rows, linked):
    smallest = {i: i for i, _ in rows}
    changed = True
    while changed:
        changed = False
        for a, x in rows:
            for b, y in rows:
                if smallest[b] < smallest[a] and linked(x, y):
                    smallest[a], changed = smallest[b], True
    return smallest


def near(x, y):
    return bool(x) and 100 * len(x & y) >= 75 * len(x | y)


def variants(base, seeds, step):
    out = []
    for s in seeds:
        words = base.split()
        words[s * step % len(words)] = f"swap{s}"
        out.append(" ".join(words))
    return out


def test_jaccard_components_equal_brute_force(documents):
    texts = [prose(1, 200), *variants(prose(1, 200), range(1, 25), 7), prose(2, 40), prose(2, 40).upper(), prose(2, 52)]
    shared = prose(9, 60)
    texts += [f"{shared} {prose(100 + i, 20 + 3 * i)}" for i in range(12)]
    texts += ["a b c", "A b  c", "a b", "", None, "x " * 400, "x " * 300, prose(1, 200) + " " + prose(3, 70)]
    rows = list(enumerate(texts))
    sets = [(i, shingles(t)) for i, t in rows]
    expected = components(sets, near)
    found = {r.doc_id: r for r in ngram_join.near_duplicates(documents(rows)).collect()}
    assert {i: r.component_id for i, r in found.items()} == expected
    assert {i: r.n_shingles for i, r in found.items()} == {i: len(s) for i, s in sets}


def test_jaccard_defined_cases(documents):
    found = ngram_join.near_duplicates(documents(AWKWARD)).collect()
    assert len(found) == len(AWKWARD)
    assert all(r.component_id == r.doc_id for r in found)
    assert ngram_join.near_duplicates(documents([])).collect() == []
    kept = ngram_join.one_of_each(documents([(1, "a b c"), (2, "a b c"), (3, None), (None, "a b c")]))
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 3, None]


def test_large_groups_are_paired_like_small_ones(monkeypatch):
    rng = np.random.default_rng(0)
    signature, owner = rng.integers(0, 4, 120).astype(np.uint32), np.repeat(np.arange(30), 4).astype(np.int32)
    kind = np.full(120, ngram_join.SELECTED, np.uint8)
    sets = {"families": np.arange(30), "sizes": np.full(30, 50), "rares": np.full(30, 9), "sketches": np.zeros((30, 128), np.int8)}
    small = ngram_join.candidates_of(signature, kind, owner, sets, False)
    monkeypatch.setattr(ngram_join, "PAIRWISE", 2)
    assert np.array_equal(small, ngram_join.candidates_of(signature, kind, owner, sets, False))


def test_prints_never_overstate_differences():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 4000).astype(np.uint64) << np.uint64(1)
    pool[:40] = pool[0] + np.arange(40, dtype=np.uint64)  # many hashes with one print
    sets = [np.unique(rng.choice(pool, n)) for n in (1, 30, 400, 1500, 3000)] + [pool[:0], np.sort(pool[:40])]
    sizes = np.array([len(s) for s in sets])
    prints = ngram_join.Prints(np.concatenate([ngram_join.print_of(s) for s in sets]), sizes)
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    exact = np.array([len(np.setxor1d(sets[x], sets[y])) for x, y in zip(a, b)])
    found = prints.differences(a, b)
    assert (found <= exact).all() and (found >= 0).all()
    assert (exact - found <= 0.1 * (sizes[a] + sizes[b]) + 80).all()
    assert (found[a == b] == 0).all()


def test_families_that_nearly_link_list_no_pairs(documents, monkeypatch):
    """Near copies of two texts that share too little, met in many buckets: prints leave the linked pairs only."""
    rng = np.random.default_rng(2)
    base = [f"w{i}" for i in range(300)]
    other = base[:210] + [f"v{i}" for i in range(90)]  # shares about 0.54 of its shingles

    def copies(words, n):
        for i in range(n):
            text = list(words)
            text[int(rng.integers(0, len(text)))] = f"x{rng.integers(1 << 40)}"
            yield " ".join(text)

    texts = [*copies(base, 60), *copies(other, 60)]
    rounds = []
    plain = ngram_join.packed_segments

    def packed(*args, **named):
        rounds.append(named.get("prints", False))
        return plain(*args, **named)

    monkeypatch.setattr(ngram_join, "packed_segments", packed)
    monkeypatch.setattr(ngram_join, "small_sketch", lambda hashes: np.zeros(1 << ngram_join.SKETCH_BITS - 1, np.uint8))
    listed = []
    check = ngram_join.verified

    def verified(pairs, docs, sifted=False):
        pairs = ngram_join.stored(pairs, "listed")
        if sifted:
            listed.append(pairs.count())
        return check(pairs, docs, sifted)

    monkeypatch.setattr(ngram_join, "verified", verified)
    found = ngram_join.near_duplicates(documents(list(enumerate(texts)))).collect()
    sets = [(i, shingles(t)) for i, t in enumerate(texts)]
    assert {r.doc_id: r.component_id for r in found} == components(sets, near)
    assert {r.component_id for r in found} == {0, 60}
    assert rounds == [False, True]
    assert listed[1] == 0


def brute_repeats(texts, length):
    raw = [(t or "").encode() for t in texts]
    count = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        covered = np.zeros(len(b) + 1, int)
        for i in range(len(b) - length + 1):
            if count[b[i:i + length]] > 1:
                covered[i:i + length] = 1
        spans = int((np.diff(np.concatenate([[0], covered])) == 1).sum())
        kept = bytes(c for c, x in zip(b, covered) if not x)
        out.append((len(b), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("most", [1_000, 1])
def test_repeats_equal_brute_force(documents, monkeypatch, most):
    """With one variant per anchor allowed, all go the way of crowded anchors."""
    monkeypatch.setattr(repeats, "MAX_VARIANTS", most)
    passage = prose(5, 100)
    texts = [prose(1, 300), prose(1, 300), f"{prose(2, 40)} {passage} {prose(3, 50)}", f"{prose(4, 9)} {passage}",
             passage[7:450], "ab " * 400, "é" * 500, None, "", "short", passage[3:403], prose(6, 50) + passage[:401] + "!"]
    found = repeats.remove_repeats(documents(list(enumerate(texts)))).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found] == brute_repeats(texts, 400)


def test_repeats_defined_cases(documents):
    found = repeats.remove_repeats(documents(AWKWARD)).collect()
    assert len(found) == len(AWKWARD) and sum(r.n_removed for r in found) == len("é " * 30_000) + 30_000
    assert repeats.remove_repeats(documents([])).collect() == []


def test_matching_statistics_equal_brute_force():
    windows = [b"banana", b"bandana", b"nab", b"xx", b"xx", b"ananas" * 3]
    found = RunLengthIndex(windows).matching_statistics()

    def longest(w, i):
        best = 0
        for v, other in enumerate(windows):
            for j in range(len(other)):
                if (v, j) != (w, i):
                    n = 0
                    while i + n < len(windows[w]) and j + n < len(other) and windows[w][i + n] == other[j + n]:
                        n += 1
                    best = max(best, n)
        return best

    assert [f.tolist() for f in found] == [[longest(w, i) for i in range(len(x))] for w, x in enumerate(windows)]


def test_contained_items_equal_brute_force(spark, documents):
    item, short = prose(1, 30), "tiny phrase here"
    near_item = item.split()
    near_item[2] = "changed"
    docs = [(1, f"{prose(2, 900)} {item.upper()} {prose(3, 500)}"), (2, " ".join(near_item)), (3, prose(4, 50)),
            (4, f"a {short} b"), (5, " ".join(item.split()[:20])), *AWKWARD]
    items = spark.createDataFrame([(1, item), (2, short), (3, None), (4, ""), (5, item)], "item_id long, text string")
    found = decontaminate.find_contained(documents(docs), items)
    assert sorted((r.doc_id, r.item_id, r.n_found, r.n_shingles) for r in found.collect()) == [
        (1, 1, 26, 26), (1, 5, 26, 26), (2, 1, 23, 26), (2, 5, 23, 26), (4, 2, 1, 1)]
    kept = decontaminate.decontaminated(documents(docs), items)
    assert kept.columns == documents([]).columns
    assert not {1, 2} & {r.doc_id for r in kept.collect()}
    assert decontaminate.find_contained(documents([]), items.limit(0)).collect() == []


def test_personal_data_spans():
    text = ("Mail a.b@x-y.co.uk, ip 10.0.0.255 and 1.2.3.256; card 4111 1111 1111 1111, not 4111 1111 1111 1112; "
            "call +1 (499) 555-6503. IBAN DE89 3704 0044 0532 0130 00, SSN 078-05-1120, plain 078-05-1120x é")
    found = [(s.kind, text[s.start:s.end]) for s in pii.spans(text)]
    assert found == [
        ("email", "a.b@x-y.co.uk"), ("ip", "10.0.0.255"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (499) 555-6503"),
        ("iban", "DE89 3704 0044 0532 0130 00"), ("id_number", "078-05-1120"), ("id_number", "078-05-1120")]
    safe = pii.redacted(text, pii.spans(text))
    assert "[card]" in safe and "4111 1111 1111 1111" not in safe


def test_personal_data_tables(documents):
    rows = [*AWKWARD, (9, "x@y.z 4539578763621486"), (10, "9" * 5000)]
    found = pii.pii_digest(documents(rows)).collect()
    assert len(found) == len(rows)
    nine = next(r for r in found if r.doc_id == 9)
    assert (nine.n_email, nine.n_card, nine.spans) == (1, 1, "email:0:5,card:6:22")
    assert nine.base_sha256 == hashlib.sha256(b"email:0:5,card:6:22").hexdigest()
    clean = pii.redact(documents(rows))
    assert clean.columns == documents([]).columns and clean.where("doc_id = 9").first().text == "[email] [card]"
    assert pii.pii_digest(documents([])).collect() == []


def test_packing_places_every_id_once(documents):
    path = public_tokenizers.path(packing.TOKENIZER)
    rows = [*AWKWARD, *((100 + i, prose(i, 40 * i)) for i in range(30)), (200, "Ünï\x1cé it's 12 <|endoftext|>x")]
    tokenizer = Tokenizer.from_file(path)
    found = packing.pack_documents(documents(rows), path).collect()
    by_doc, by_sequence = {}, {}
    for r in found:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for doc_id, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        pieces = sorted(by_doc[doc_id], key=lambda r: r.start)
        if doc_id != 4:  # two equal rows
            assert [p.start for p in pieces] == list(range(0, len(ids), 4096))
            assert sum(p.length for p in pieces) == len(ids)
        for p in pieces:
            assert p.ids_crc32 == zlib.crc32(ids[p.start:p.start + p.length].tobytes()) and p.doc_tokens == len(ids)
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [p.offset for p in pieces] == np.cumsum([0, *(p.length for p in pieces[:-1])]).tolist()
        assert sum(p.length for p in pieces) <= 4096
    assert packing.pack_documents(documents([]), path).collect() == []


def test_packing_keeps_all_three_limits():
    rng = np.random.default_rng(1)
    demands = np.column_stack([rng.integers(1, 90, 200), np.ones(200), rng.integers(0, 30, 200)])
    limits = np.array([100.0, 4, 40])
    sequence = packing.dot_product_fill(demands, limits)
    for s in np.unique(sequence):
        assert (demands[sequence == s].sum(axis=0) <= limits).all()
    with pytest.raises(ValueError):
        packing.dot_product_fill(np.array([[101.0, 1, 0]]), limits)


def test_segments_equal_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(200):
        scores = np.where(rng.random(12) < 0.5, rng.integers(1, 6, 12), -rng.integers(1, 5, 12)).astype(float)
        expected, open_ = [], [(0, 12)]
        while open_:  # by definition: the best segment, then the same on both sides of it
            a, b = open_.pop()
            best = max(((scores[i:j].sum(), -(j - i), -i) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0, 0, 0))
            if best[0] > 0:
                i, j = -best[2], -best[2] - best[1]
                expected.append(best[0])
                open_ += [(a, i), (j, b)]
        found = toxicity.maximal_segments(scores)
        assert sorted(s for _, _, s in found) == pytest.approx(sorted(expected))


def test_toxicity_learns_inflected_words_and_ignores_copies(spark, documents):
    rows, labels = [], []
    for i in range(600):
        toxic = i % 6 == 0
        words = prose(i, 60).split()
        if toxic:
            for k in (5, 20, 40):
                words[k + i % 5] = f"zorkfa{prose(1000 + i + k, 1)}"
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    table = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")
    found = {r.doc_id: r for r in toxicity.toxicity(documents(rows), table).collect()}
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(found[i].held_out for i in held) and sum(r.held_out for r in found.values()) == len(held)
    assert sum(found[i].predicted == int(i % 6 == 0) for i in held) >= 0.97 * len(held)


def test_toxicity_defined_cases(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    found = toxicity.toxicity(documents(AWKWARD), labels).collect()
    assert len(found) == len(AWKWARD) and all(r.score == 0 and r.predicted == 0 for r in found)
    assert toxicity.toxicity(documents([]), labels).collect() == []


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(3)
    emission, transition = rng.normal(size=(5, 3)), rng.normal(size=(3, 3))
    first = np.array([0, 4, 5])
    posterior, pairs = language.forward_backward(emission, transition, first)
    weight, marginal, expected = 0.0, np.zeros((4, 3)), np.zeros((3, 3))
    for code in range(81):
        tags = [code // 3 ** t % 3 for t in range(4)]
        w = math.exp(sum(emission[t, k] for t, k in enumerate(tags)) + sum(transition[a, b] for a, b in zip(tags, tags[1:])))
        weight += w
        for t, k in enumerate(tags):
            marginal[t, k] += w
        for a, b in zip(tags, tags[1:]):
            expected[a, b] += w
    assert posterior[:4] == pytest.approx(marginal / weight) and pairs == pytest.approx(expected / weight)


def test_language_on_switching_text(documents):
    kinds = {"aa": "abcde", "zz": "vwxyz"}
    rows = []
    for i in range(200):
        lang = "aa" if i % 2 else "zz"
        letters = str.maketrans("abcdefghij", kinds[lang] * 2)
        rows.append((i, prose(i, 40).translate(letters), lang))
    rows += [(1000, None, "aa"), (1001, "12 34 !", "zz"), (1002, "", None)]
    found = {r.doc_id: r for r in language.language_id(documents(rows)).collect()}
    assert all(found[i].lang_pred == lang for i, _, lang in rows[:200] if found[i].held_out)
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in (1000, 1001, 1002))
    crf = language.fit(documents(rows))
    mixed = crf.document_shares(["abcd edcb zyxw vwxy zyzy", None])
    assert mixed[0] == pytest.approx([0.4, 0.6], abs=0.1) and mixed[1].sum() == 0
    assert len(language.with_language(documents(rows)).collect()) == 200
    assert language.language_id(documents([])).collect() == []
    assert {r.lang_pred for r in language.language_id(documents(AWKWARD)).collect()} == {"und"}


def test_every_labelled_language_is_learned(documents, monkeypatch):
    common = str.maketrans("abcdefghij", "klmnopqrst")
    rare = {f"l{k:02}": chr(0x4E00 + 20 * k) for k in range(70)}
    rows = [(i, prose(i, 6).translate(common), "common") for i in range(300)]
    for k, (lang, letter) in enumerate(rare.items()):
        letters = str.maketrans("abcdefghij", "".join(chr(ord(letter) + j) for j in range(10)))
        rows += [(1000 + 10 * k + j, prose(1000 + 10 * k + j, 6).translate(letters), lang) for j in range(6)]
    monkeypatch.setattr(language, "FIT_ROWS", 40)
    monkeypatch.setattr(language, "EPOCHS", 6)
    crf = language.fit(documents(rows))
    assert crf.languages == sorted(["common", *rare])
    texts = [r[1] for r in rows]
    shares = crf.document_shares(texts)
    assert [crf.languages[k] for k in shares.argmax(axis=1)] == [r[2] for r in rows]
    monkeypatch.setattr(language, "CELLS", 500)
    assert crf.document_shares(texts) == pytest.approx(shares, abs=1e-5)
