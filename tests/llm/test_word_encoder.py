"""Ids found piece by piece are those of the whole text, and no piece is encoded for every word it occurs in."""

import random
import tracemalloc

import pytest

from railpulse.llm import packing
from railpulse.llm.queries import tokenizer_path

ODD = [
    "", "   ", "  lead\ttrail \n", "It's we'll don't' dogs'.", "Ab'c d''. ---!! *** a, a. a", "x€, €, ”. “word”, abc€!!",
    "½, 3.5%, x² １２３ abc１", "İstanbul İ straße ǅ ÉTÉ", "Σας ΟΔΟΣ", "été, É", "a\x1cb c　d", "<|endoftext|> x",
    "日本語のテキスト, 中文.", "हिन्दी, กำ!", "a\x00b, �.",
]


@pytest.mark.parametrize("at_once, cached", [(1 << 20, 10_000), (8, 10_000), (1 << 20, 5)])
def test_ids_are_those_of_whole_texts(monkeypatch, at_once, cached):
    monkeypatch.setattr(packing, "ENCODED_AT_ONCE", at_once)
    monkeypatch.setattr(packing, "CACHED_WORDS", cached)
    encoder = packing.WordEncoder(tokenizer_path())
    for _ in range(2):
        found = [ids.tolist() for ids in encoder.encode(ODD)]
        assert found == [encoder.tokenizer.encode(text, add_special_tokens=False).ids for text in ODD]


def test_marks_after_a_word_are_not_encoded_with_it():
    cores = [f"w{'abcdefghij'[i // 10]}{'abcdefghij'[i % 10]}" for i in range(100)]
    marks = ["***", "%%%", ")", "\"", "&&&", "$", "}", "]"]
    encoder = packing.WordEncoder(tokenizer_path())
    list(encoder.encode([" ".join(core + mark for core in cores for mark in marks)]))
    assert len(encoder.known) <= len(cores) + len(marks) + 1


def test_memory_does_not_grow_with_the_texts_given_at_once():
    draw = random.Random(5)
    words = ["".join(draw.choices("abcdefgh", k=6)) for _ in range(2000)]
    texts = [" ".join(draw.choices(words, k=5000)) for _ in range(110)]  # 3.8 million characters
    encoder = packing.WordEncoder(tokenizer_path())
    list(encoder.encode([" ".join(words)]))
    tracemalloc.start()
    try:
        for _ in encoder.encode(texts):
            pass
        assert tracemalloc.get_traced_memory()[1] < 40e6
    finally:
        tracemalloc.stop()


def test_a_full_cache_keeps_the_pieces_just_met(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 4)
    encoder = packing.WordEncoder(tokenizer_path())
    list(encoder.encode(["often one two"]))
    list(encoder.encode(["often three four five"]))
    assert "often" in encoder.known and "one" not in encoder.known
