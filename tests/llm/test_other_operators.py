"""Pages, vectors, archives and components against brute force, and their defined cases."""

import hashlib
import io
import base64

import numpy as np
import pytest

from railpulse.llm import arc, embeddings, html_text
from railpulse.llm.components import connected_components

PAGES = "page_id long, url string, html string, text string, path string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], PAGES)


@pytest.mark.parametrize("version", [1, 2])
def test_archives_come_back(spark, version):
    rows = [(3, "http://a b", "<p>ü</p>"), (1, None, "<p>ü</p>"), (2, "u", None), (5, "u", ""), (4, "v", "x" * 300_000),
            (7, "w", "line\n\r\n\r\nWARC/1.1\nend"), (7, "w", "line\n\r\n\r\nWARC/1.1\nend"), (None, "n", "<p>ü</p>")]
    found = arc.archived(pages(spark, rows), version).collect()
    assert len(found) == len(rows)
    by_page = {}
    for r in found:
        by_page.setdefault(r.page_id, []).append(r)
    for page, _, html in rows:
        raw = (html or "").encode()
        for r in by_page[page]:
            assert r.payload_bytes == len(raw)
            assert r.payload_digest == base64.b32encode(hashlib.sha1(raw).digest()).decode()
    types = {p: sorted((r.record_type, r.refers_to) for r in rs) for p, rs in by_page.items()}
    assert types[1] == [("response", None)] and types[3] == [("revisit", 1)] and types[None] == [("revisit", 1)]
    assert types[2] == [("response", None)] and types[5] == [("revisit", 2)]
    assert types[7] == [("response", None), ("revisit", 7)]
    assert arc.archived(pages(spark, [])).collect() == []


def test_small_payloads_may_all_be_responses(spark):
    found = arc.archived(pages(spark, [(1, "u", "a"), (2, "u", "a"), (3, "u", "b" * 50), (4, "u", "b" * 50)]), 1, 10)
    assert {r.page_id: r.record_type for r in found.collect()} == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_broken_archives_fail():
    good = arc.arc_opening(1, "n") + arc.arc_record(1, "u", b"abc", "-")
    assert [c for _, c in arc.parse_arc(io.BytesIO(good))] == [b"abc"]
    for bad in (b"hello\n", good[:-3], good.replace(b"text/html 3", b"3")):
        with pytest.raises(arc.BadArchive):
            list(arc.parse_arc(io.BytesIO(bad)))


def article(i, body):
    return (f"<html><head><title>T{i}</title><script>var a='<p>no</p>'</script></head><body><nav><ul><li><a href=/>Home</a>"
            f"<li><a href=/n>News</a></ul></nav><div class='ad'>Buy {i}</div><article><h1>Head {i}</h1>{body}</article>"
            f"<footer>&copy; {i}</footer></body></html>")


def test_blocks_decode_and_join():
    html = "<p>a&amp;b <b>c</b>d<br>e\n f<p>g &lt;i&gt;<!-- x --><script>1<2</script> h&nbsp;</p></div>t"
    assert [b.text for b in html_text.blocks_of(html)] == ["a&b cd e f", "g <i> h", "t"]
    assert html_text.blocks_of(None) == [] and html_text.blocks_of("<p></p>") == []


@pytest.mark.parametrize("html, texts", [
    ("<article><p>one</p><svg/><p>two</p></article>", ["one", "two"]),
    ("<p>one<math/> more</p><p>two</p>", ["one more", "two"]),
    ("<p>one</p><svg viewBox='0 0 1 1'><path d='m'><p>two</p>", ["one", "two"]),
    ("<p>one</p><canvas id=c><p>two</p>", ["one", "two"]),
    ("<object-view>one</object-view><p>two</p><template-card>three</template-card><script-x>four</script-x>", ["one", "two", "threefour"]),
    ("<p>one</p><template><p>no</p><p>two</p>", ["one", "no", "two"]),
    ("<p>let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be</p>", ["let x=2 be"]),
    ("<p>a</p><object data=f>b</object><canvas>c</canvas><noscript><p>d</p></noscript><p>e</p>", list("abcde")),
    ("<p>a<svg><title>no</title><style/><svg></svg>no</svg>b</p><template><p>no</p></template><p>c</p>", ["ab", "c"]),
    ("<p>a</p><textarea>no</textarea ><iframe>no</iframe><style>no</style x><p>b</p><script>no <p>no</p>", ["a", "b"]),
])
def test_elements_hide_no_text_of_the_page(html, texts):
    assert [b.text for b in html_text.blocks_of(html)] == texts


def test_articles_keep_formulas_and_fallbacks(spark):
    body = ("<p>The quick brown fox and more.</p><object>Words of an object, in place.</object><svg/>"
            "<noscript><p>Some more words for readers without scripts.</p></noscript><p>The last words of it.</p>")
    rows = [(i, "u", article(i, "<p>The quick brown fox and more.</p><p>Second paragraph of it.</p>")) for i in range(60)]
    found = {r.page_id: r.text for r in html_text.extract(pages(spark, [*rows, (60, "u", article(60, body))])).collect()}
    assert found[60] == ("Head 60 The quick brown fox and more. Words of an object, in place. "
                         "Some more words for readers without scripts. The last words of it.")


def test_articles_are_extracted(spark):
    body = "<p>The quick <i>brown</i> fox &amp; more.</p><p>Second paragraph, with several words in it.</p>"
    rows = [(i, f"u{i}", article(i, body)) for i in range(60)]
    rows += [(100, None, None), (101, "e", ""), (102, "s", "<script>x</script>"), (0, "u0", article(0, body))]
    found = {r.page_id: r for r in html_text.extract(pages(spark, rows)).collect()}
    for i in range(60):
        assert found[i].text == f"Head {i} The quick brown fox & more. Second paragraph, with several words in it."
        assert found[i].n_chars == len(found[i].text)
    assert all(found[i].text == "" and found[i].n_chars == 0 for i in (100, 101, 102)) and found[100].url is None
    assert html_text.extract(pages(spark, [])).collect() == []


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(900, 16))
    vectors[500:700] = vectors[0] + rng.normal(scale=0.12, size=(200, 16))  # one large group
    vectors[700:720] = vectors[1]
    rows = [(i, [float(x) for x in np.float32(v)]) for i, v in enumerate(vectors)]
    odd = [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [None] * 16), (2004, []), (2005, [1.0, 2.0]),
           (2006, [2.0, 4.0]), (0, rows[0][1])]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    found = embeddings.near_duplicates(table).collect()
    assert len(found) == len(rows) + len(odd)
    by_id = {r.vec_id: r for r in found}
    unit = np.array([v for _, v in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    truth = linked.sum(axis=1) - 1 + linked[0]  # vector 0 is there twice
    counts = np.array([by_id[i].n_links for i in range(len(rows))])
    assert (counts <= truth).all() and counts.sum() >= 0.98 * truth.sum()
    assert all(by_id[i].component_id == by_id[1].component_id == 1 for i in range(700, 720))
    assert all(by_id[i].n_links == 0 and by_id[i].kept for i in range(2000, 2005))
    assert by_id[2005].n_links == by_id[2006].n_links == 1 and by_id[2006].component_id == 2005
    assert embeddings.near_duplicates(table.limit(0)).collect() == []


class Scanner:
    """Stands for a graph: beams below ``sees`` meet no node of the ``hidden`` queries' groups."""

    def __init__(self, vectors, hidden=None, sees=0):
        self.vectors, self.hidden, self.sees = vectors, hidden, sees

    def search(self, queries, width):
        sims = queries @ self.vectors.T
        if width < self.sees:
            sims[:, self.hidden] = -1
        ids = np.argsort(-sims, axis=1)[:, :width]
        return ids, np.take_along_axis(sims, ids, axis=1)


def spread(rng, count, size=32):
    found = rng.normal(size=(count, size))
    return found / np.linalg.norm(found, axis=1, keepdims=True)


def test_audit_sees_links_of_small_groups_beside_a_large_one():
    rng = np.random.default_rng(2)
    exact = spread(rng, 2000)
    exact[:700] = exact[0] + rng.normal(scale=0.02, size=(700, 32))
    exact /= np.linalg.norm(exact, axis=1, keepdims=True)
    queries = exact + rng.normal(scale=0.01, size=exact.shape)
    queries /= np.linalg.norm(queries, axis=1, keepdims=True)
    hidden = np.arange(700, 2000)
    assert embeddings.audited_width(Scanner(exact, hidden, 128), exact, queries, 0.9) == (128, 1.0)
    assert embeddings.audited_width(Scanner(exact), exact, queries, 0.9) == (32, 1.0)


def test_audit_does_not_count_a_node_as_its_own_link():
    rng = np.random.default_rng(3)
    exact = np.repeat(spread(rng, 500), 2, axis=0) + rng.normal(scale=0.01, size=(1000, 32))
    exact /= np.linalg.norm(exact, axis=1, keepdims=True)

    class Own(Scanner):
        def search(self, queries, width):
            ids, sims = super().search(queries, width)
            if width < 128:
                sims[:, 1:] = -1  # finds the query itself alone
                ids[:, 1:] = -1
            return ids, sims

    assert embeddings.audited_width(Own(exact), exact, exact, 0.9, np.arange(1000))[0] == 128


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(5, 5), (None, 3), (9, 7)]
    found = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    expected = {i: 100 for i in range(100, 141)} | {i: 7 for i in range(200, 260)} | {7: 7, 9: 7}
    assert {r.id: r.component for r in found} == expected and len(found) == len(expected)
