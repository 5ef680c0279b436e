"""Cases in which the contract says what is to come out: odd markup, symbols, absent ids, very long runs."""

import random
import re
import time

import pytest

from railpulse.llm import embeddings, html_text, language, pii

# As the contract writes them.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


@pytest.mark.parametrize("letters", ["a1.@-", "a@._ ", "10. ", "1.2x"])
def test_linear_patterns_match_as_those_of_the_contract(letters):
    rng = random.Random(letters)
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(40)))
        assert [m.span() for m in pii.emails(text)] == [m.span() for m in EMAIL.finditer(text)], text
        assert [m.span() for m in pii.IP.finditer(text)] == [m.span() for m in IP.finditer(text)], text


def test_an_address_may_begin_where_another_ends():
    assert [m[0] for m in pii.emails("a@b.com.@c.de_x@e.fg")] == ["a@b.com", ".@c.de", "_x@e.fg"]


@pytest.mark.parametrize("text", [
    "1" * 1_000_000 + ".", "a" * 1_000_000 + "@", "a@" * 500_000, "a.b@c" * 200_000, "1." * 500_000, "+1(" * 300_000,
    "AB12" * 250_000, "1-" * 500_000,
])
def test_texts_of_a_million_characters_take_seconds(text):
    start = time.perf_counter()
    pii.spans(text)
    assert time.perf_counter() - start < 20


@pytest.mark.parametrize("html, texts", [
    ("<article><p title=it's fine>One, it's two</p><p>three</p>", ["One, it's two", "three"]),
    ("<p>one</p><img alt=don't><p>it's two</p><p>three</p>", ["one", "it's two", "three"]),
    ("<p><a href=x\"y>one</a> two</p>", ["one two"]),
    ("<p title=\"a>b\" lang = 'c>d'>one</p><p data-x=a>two</p>", ["one", "two"]),
    ("<p title=\"never closed>one</p><p>two</p>", ["one", "two"]),
    ("<p =>one</p><p = 'x>y'>two</p><p ''>three</p>", ["one", "two", "three"]),
    ("<svg title=it's><title>no</title></svg><p>isn't</p>", ["isn't"]),
])
def test_quotes_open_values_and_nothing_else(html, texts):
    assert [b.text for b in html_text.blocks_of(html)] == texts


def test_symbols_are_no_letters(documents):
    assert language.words_of("½ ab² ①② é_x 3") == ["ab", "é", "x"]
    found = language.language_id(documents([(1, "½ ² ① 12", "aa"), (2, "word", "aa"), (3, "word", "aa"), (4, "word", "aa")]))
    assert found.where("doc_id = 1").first().lang_pred == "und"


def test_vectors_without_an_id(spark):
    near = [1.0, 0.001]
    rows = [
        (None, [1.0, 0.0]), (5, [1.0, 0.0]), (6, near),  # a group with two ids
        (None, [0.0, 1.0]), (None, [0.0, 1.0]), (None, [0.001, 1.0]),  # a group without any
        (None, None), (9, [-1.0, 0.0]), (-3, [0.0, -1.0]),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted((r.vec_id is None, r.vec_id or 0, r.n_links, r.component_id or 0, r.kept)
                   for r in embeddings.near_duplicates(table).collect())
    assert found == sorted([
        (True, 0, 2, 5, False), (False, 5, 2, 5, True), (False, 6, 2, 5, False),
        (True, 0, 2, 0, True), (True, 0, 2, 0, True), (True, 0, 2, 0, True),
        (True, 0, 0, 0, True), (False, 9, 0, 9, True), (False, -3, 0, -3, True),
    ])
