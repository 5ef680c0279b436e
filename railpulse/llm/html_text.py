"""Main text of web pages: a bidirectional LSTM labels every block of a page.

A page is read as a sequence of leaf blocks, each with its tag path (names,
classes and ids of the elements around it) and its text. A block's vector holds
its path and its words, both hashed, and a few shape numbers (length, share of
link text, depth, position). One LSTM reads the sequence forwards and one
backwards, so each block is judged in the context of its whole page; a logistic
unit says whether it is main text. All of it is numpy.

Training. At most ``FIT_PAGES`` pages (smallest hash of page_id) that mark their
article by a semantic element label their own blocks. From the texts of these,
``SYNTHETIC_PAGES`` pages are composed whose regions carry common class names or
semantic elements, or neither, so that the labeller does not rest on one site's
markup. If no page marks its article, words are drawn at random instead.

Elements without page text are skipped: script, style, textarea and iframe to their
end tag or else to the end of the page; svg and template only where an end tag
belongs to them. Text of math stays in its block; fallback text (object, canvas,
noscript) makes blocks of its own, and the labeller decides.

Defined cases: a null or empty html, or a page without text, has an empty text;
unclosed and stray tags are tolerated, and an unclosed or self-closed svg or math
hides nothing after it; repeated pages give equal rows; a null
url stays null; an empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from railpulse.llm.common import over_batches, small_batches

FIT_PAGES = 300
SYNTHETIC_PAGES = 450
FIT_BLOCKS = 80
PATH_SIZE, WORD_SIZE, SHAPE_SIZE = 96, 32, 6
INPUT = PATH_SIZE + WORD_SIZE + SHAPE_SIZE
HIDDEN = 20
EPOCHS = 14
RATE = 0.02
ROWS = 256

# Element names of the markup language.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup option "
    "p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "iframe")  # what they hold is not markup
SILENT = ("svg", "template")
FOREIGN = frozenset(("svg", "math"))  # may close themselves, and end where a block begins
FALLBACK = frozenset(("object", "canvas", "noscript"))
# Elements that end an open element of the same group when they begin.
SIBLINGS = {
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
FENCES = frozenset("ul ol dl table article section div main body nav aside header footer form".split())

# What stands in a tag: a quote opens a value only after an equals sign, and only if it is closed.
_ATTRIBUTES = r"(?:[^>=]|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?)*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({'|'.join(RAW)})(?=[\s/>]).*?(?:</\1(?=[\s/>])[^>]*>|\Z)"
    rf"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)({_ATTRIBUTES})>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
_SILENT = re.compile(rf"<(/?)({'|'.join(SILENT)})(?=[\s/>])({_ATTRIBUTES})>", re.I)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_PART = re.compile(r"[a-z]+")
_WORD = re.compile(r"\w+")


@dataclass
class Block:
    path: tuple[tuple[str, ...], ...]  # for every element around: its name, then parts of its class and id
    text: str
    linked: int = 0  # characters inside links


def silent_spans(html: str) -> dict[int, int]:
    """Where silent elements that have an end tag begin and end; those that close themselves or never end are not among them."""
    found: dict[int, int] = {}
    opened: dict[str, list[int]] = {name: [] for name in SILENT}
    for m in _SILENT.finditer(html):
        name = m[2].lower()
        if m[1]:
            if opened[name]:
                found[opened[name].pop()] = m.end()
        elif not (name in FOREIGN and m[3].endswith("/")):
            opened[name].append(m.start())
    return found


def blocks_of(html: str | None) -> list[Block]:
    """Leaf blocks of a page in order, character references decoded, white space single."""
    found: list[Block] = []
    stack: list[tuple[str, ...]] = []
    buffer: list[str] = []
    state = {"links": 0, "linked": 0}

    def text(raw: str) -> None:
        if raw:
            buffer.append(raw)
            if state["links"]:
                state["linked"] += len(raw)

    def flush() -> None:
        if buffer:
            clean = " ".join(entities.unescape("".join(buffer)).split())
            if clean:
                found.append(Block(tuple(stack), clean, min(state["linked"], len(clean))))
            buffer.clear()
        state["linked"] = 0

    def leave(depth: int) -> None:
        state["links"] -= sum(e[0] == "a" for e in stack[depth:])
        del stack[depth:]

    html, at = html or "", 0
    silent = silent_spans(html)
    while m := _TOKEN.search(html, at):
        text(html[at:m.start()])
        at = silent.get(m.start(), m.end())
        if at > m.end():
            continue
        name = (m[3] or "").lower()
        if not name:
            continue
        if name == "br":
            text("\n")
            continue
        if name in BLOCK or name in FALLBACK:
            flush()
        if m[2]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    leave(depth)
                    break
                if name not in FENCES and stack[depth][0] in FENCES:
                    break  # a stray end inside another container
            continue
        if name in VOID or name in FOREIGN and m[4].endswith("/"):
            continue
        if name in BLOCK:
            leave(next((depth for depth, e in enumerate(stack) if e[0] in FOREIGN), len(stack)))
        closes = SIBLINGS.get(name, {"p"} if name in BLOCK else set())
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth][0] in closes:
                leave(depth)
                break
            if stack[depth][0] in FENCES:
                break
        parts = [name]
        if "=" in m[4]:
            for value in _NAMED.findall(m[4]):
                parts += _PART.findall("".join(value).lower())
        stack.append(tuple(parts))
        state["links"] += name == "a"
    text(html[at:])
    flush()
    return found


# -- vectors --------------------------------------------------------------------

_HASHED: dict[str, tuple[int, float]] = {}


def _hashed(token: str, size: int) -> tuple[int, float]:
    found = _HASHED.get(token)
    if found is None:
        if len(_HASHED) > 500_000:
            _HASHED.clear()
        number = zlib.crc32(token.encode())
        found = _HASHED[token] = (number % size, 1.0 if number & 0x10000 else -1.0)
    return found


_PATHS: dict[tuple, np.ndarray] = {}


def path_vector(path: tuple[tuple[str, ...], ...]) -> np.ndarray:
    found = _PATHS.get(path)
    if found is None:
        if len(_PATHS) > 20_000:
            _PATHS.clear()
        found = np.zeros(PATH_SIZE, np.float32)
        for element in path:
            for part in {f"/{element[0]}", *(f".{p}" for p in element[1:])}:
                index, sign = _hashed(part, PATH_SIZE)
                found[index] += sign
        if path:
            index, sign = _hashed(f">{path[-1][0]}", PATH_SIZE)
            found[index] += sign
        _PATHS[path] = np.clip(found, -2, 2)
        found = _PATHS[path]
    return found


def vectors(blocks: list[Block]) -> np.ndarray:
    found = np.zeros((len(blocks), INPUT), np.float32)
    for i, block in enumerate(blocks):
        found[i, :PATH_SIZE] = path_vector(block.path)
        words = _WORD.findall(block.text)
        if words:
            hits = [_hashed(w, WORD_SIZE) for w in words]
            bag = np.bincount([h[0] for h in hits], [h[1] for h in hits], WORD_SIZE)
            found[i, PATH_SIZE:-SHAPE_SIZE] = bag / np.sqrt(np.dot(bag, bag) + 1)
        found[i, -SHAPE_SIZE:] = (
            np.log1p(len(block.text)) / 5, np.log1p(len(words)) / 3, block.linked / len(block.text),
            block.text.count(".") / (len(words) + 1), len(block.path) / 10, i / len(blocks),
        )
    return found


# -- the network ------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _padded(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(steps, pages, ...) with zeros after the end of shorter pages, and where pages go on."""
    steps = max(map(len, sequences))
    found = np.zeros((steps, len(sequences), *sequences[0].shape[1:]), np.float32)
    inside = np.zeros((steps, len(sequences), 1), np.float32)
    for i, s in enumerate(sequences):
        found[:len(s), i] = s
        inside[:len(s), i] = 1
    return found, inside


class Lstm:
    """One direction; the state stays as it is outside a page."""

    def __init__(self, rng: np.random.Generator):
        scale = 1 / np.sqrt(INPUT + HIDDEN)
        self.w = [
            rng.normal(0, scale, (INPUT, 4 * HIDDEN)).astype(np.float32),
            rng.normal(0, scale, (HIDDEN, 4 * HIDDEN)).astype(np.float32),
            np.zeros(4 * HIDDEN, np.float32),
        ]
        self.w[2][HIDDEN:2 * HIDDEN] = 1

    def run(self, x: np.ndarray, inside: np.ndarray, keep: bool = False):
        steps, pages = x.shape[:2]
        given = x @ self.w[0] + self.w[2]
        h = c = np.zeros((pages, HIDDEN), np.float32)
        out = np.zeros((steps, pages, HIDDEN), np.float32)
        tape = []
        for s in range(steps):
            z = given[s] + h @ self.w[1]
            i, f, o = (_sigmoid(z[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN:])
            new_c = f * c + i * g
            t = np.tanh(new_c)
            if keep:
                tape.append((h, c, i, f, o, g, t))
            h = inside[s] * (o * t) + (1 - inside[s]) * h
            c = inside[s] * new_c + (1 - inside[s]) * c
            out[s] = h
        return out, tape

    def gradients(self, x: np.ndarray, inside: np.ndarray, tape: list, d_out: np.ndarray) -> list[np.ndarray]:
        found = [np.zeros_like(w) for w in self.w]
        dh = dc = np.zeros_like(d_out[0])
        for s in range(len(tape) - 1, -1, -1):
            h, c, i, f, o, g, t = tape[s]
            dh = dh + d_out[s]
            live_h, live_c = dh * inside[s], dc * inside[s]
            d_c = live_c + live_h * o * (1 - t * t)
            dz = np.concatenate(
                [d_c * g * i * (1 - i), d_c * c * f * (1 - f), live_h * t * o * (1 - o), d_c * i * (1 - g * g)], axis=1
            )
            found[0] += x[s].T @ dz
            found[1] += h.T @ dz
            found[2] += dz.sum(axis=0)
            dh = dh * (1 - inside[s]) + dz @ self.w[1].T
            dc = dc * (1 - inside[s]) + d_c * f
        return found


class Labeller:
    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.forward, self.backward = Lstm(rng), Lstm(rng)
        self.out = [rng.normal(0, 0.1, (2 * HIDDEN, 1)).astype(np.float32), np.zeros(1, np.float32)]

    def _states(self, x, inside, keep=False):
        ahead, tape_a = self.forward.run(x, inside, keep)
        behind, tape_b = self.backward.run(x[::-1], inside[::-1], keep)
        return np.concatenate([ahead, behind[::-1]], axis=2), tape_a, tape_b

    def probabilities(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Chance of main text for every block; pages of like length run together."""
        found: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if len(p)), key=lambda i: len(pages[i]))
        for at in range(0, len(order), 64):
            part = order[at:at + 64]
            x, inside = _padded([pages[i] for i in part])
            p = _sigmoid(self._states(x, inside)[0] @ self.out[0] + self.out[1])[:, :, 0]
            for j, i in enumerate(part):
                found[i] = p[:len(pages[i]), j]
        return found

    def train(self, pages: list[tuple[np.ndarray, np.ndarray]]) -> None:
        rng = np.random.default_rng(3)
        weights = [*self.forward.w, *self.backward.w, *self.out]
        first, second = ([np.zeros_like(w) for w in weights] for _ in range(2))
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(pages))
            for at in range(0, len(order), 50):
                part = [pages[i] for i in order[at:at + 50]]
                x, inside = _padded([p[0] for p in part])
                y, _ = _padded([p[1][:, None].astype(np.float32) for p in part])
                states, tape_a, tape_b = self._states(x, inside, True)
                error = (_sigmoid(states @ self.out[0] + self.out[1]) - y) * inside / inside.sum()
                d_states = error @ self.out[0].T
                gradients = [
                    *self.forward.gradients(x, inside, tape_a, d_states[:, :, :HIDDEN]),
                    *self.backward.gradients(x[::-1], inside[::-1], tape_b, d_states[::-1, :, HIDDEN:]),
                    np.einsum("sph,spo->ho", states, error), error.sum(axis=(0, 1)),
                ]
                step += 1
                for w, g, m, v in zip(weights, gradients, first, second):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    w -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)


# -- training pages ------------------------------------------------------------------

MAIN = ("article", "main")
ASIDE = frozenset("nav header footer aside form menu button select dialog head".split())
# Common class names of the regions of a page.
REGIONS = {
    "menu": ("nav", "menu navbar navigation breadcrumb toc links pagination".split()),
    "top": ("header", "header masthead topbar banner logo branding".split()),
    "bottom": ("footer", "footer bottom copyright colophon legal".split()),
    "side": ("aside", "sidebar aside related widget rail popular trending".split()),
    "notice": ("div", "notice cookie consent alert popup modal newsletter subscribe gdpr".split()),
    "advert": ("div", "ad ads advert advertisement sponsor sponsored promo banner".split()),
    "form": ("form", "form signup login search register".split()),
    "comments": ("section", "comments comment reply discussion respond disqus".split()),
}
MAIN_NAMES = "content article post entry story main body text page".split()


def marked(blocks: list[Block]) -> np.ndarray | None:
    """Labels by the semantic elements of a page; None if it has no article."""
    found = []
    names = {word for _, words in REGIONS.values() for word in words} - {"header", "body"}
    for block in blocks:
        around = [e[0] for e in block.path]
        at = next((i for i, e in enumerate(around) if e in MAIN), None)
        inner = block.path[at + 1:] if at is not None else ()
        found.append(at is not None and not any(e[0] in ASIDE or names & set(e[1:]) for e in inner))
    return np.array(found) if any(found) else None


def composed(rng: np.random.Generator, main: list[str], other: list[str]) -> tuple[list[Block], np.ndarray]:
    """A page with regions in a usual order, under semantic elements, class names or neither."""
    page, labels = [], []
    body = (("html",), ("body",)) + ((("div", *_some(rng, ["wrapper", "container", "page", "site"])),) if rng.random() < 0.5 else ())

    def add(path, text, label, linked=False):
        page.append(Block(path, text, len(text) if linked else 0))
        labels.append(label)

    def region(kind: str, texts: int, around=body):
        tag, names = REGIONS[kind]
        style = rng.random()
        if kind in ("notice", "advert", "comments") and style < 0.3:
            style = 0.5
        element = (tag,) if style < 0.3 and tag != "div" else (tag if style < 0.5 else "div", str(rng.choice(names)))
        listed = kind in ("menu", "side") and rng.random() < 0.8
        for _ in range(texts):
            text = str(rng.choice(main if kind == "comments" and rng.random() < 0.7 else other))
            if kind in ("menu", "form", "side") and rng.random() < 0.8:
                text = " ".join(text.split()[:int(rng.integers(1, 6))])
            leaf = (("ul",), ("li",), ("a",)) if listed else ((str(rng.choice(["p", "div", "span", "label"])),) if rng.random() < 0.6 else ())
            leaf = tuple(e if isinstance(e, tuple) else (e,) for e in leaf)
            add(around + (element,) + leaf, text, False, listed or rng.random() < 0.2)

    if rng.random() < 0.7:
        add((("html",), ("head",), ("title",)), str(rng.choice(main))[:60], False)
    for kind, chance in (("top", 0.5), ("menu", 0.8), ("notice", 0.3), ("advert", 0.5)):
        if rng.random() < chance:
            region(kind, int(rng.integers(1, 8 if kind == "menu" else 3)))
    style = rng.random()
    if style < 0.35:
        around = body + ((str(rng.choice(MAIN)),),)
    elif style < 0.7:
        around = body + (("div", str(rng.choice(MAIN_NAMES))),)
    else:
        around = body + ((("div",),) if rng.random() < 0.7 else ())
    if rng.random() < 0.7:
        add(around + (("h1",),), " ".join(str(rng.choice(main)).split()[:12]), True)
    for _ in range(int(rng.integers(1, 12))):
        if rng.random() < 0.07:
            region(str(rng.choice(["advert", "notice", "form", "side"])), 1, around)
        leaf = str(rng.choice(["p", "p", "p", "p", "li", "h2", "blockquote", "div", "td", "pre"]))
        text = str(rng.choice(main))
        text = " ".join(text.split()[:8]) if leaf == "h2" else text
        inline = ((str(rng.choice(["b", "em", "span", "i"])),),) if rng.random() < 0.1 else ()
        add(around + ((leaf,),) + inline, text, True)
    for kind, chance in (("comments", 0.3), ("form", 0.25), ("side", 0.5), ("advert", 0.2), ("bottom", 0.8)):
        if rng.random() < chance:
            region(kind, int(rng.integers(1, 6 if kind in ("comments", "side") else 3)), around if kind == "comments" and rng.random() < 0.3 else body)
    return page, np.array(labels)


def _some(rng: np.random.Generator, names: list[str]) -> list[str]:
    return [str(rng.choice(names))] if rng.random() < 0.7 else []


def train(pages: list[str | None]) -> Labeller:
    """A labeller from sample pages."""
    rng = np.random.default_rng(11)
    examples, main, other = [], [], []
    for html in pages:
        blocks = blocks_of(html)
        labels = marked(blocks)
        if labels is not None:
            main += [b.text[:2000] for b, y in zip(blocks, labels) if y]
            other += [b.text[:300] for b, y in zip(blocks, labels) if not y]
            examples.append((vectors(blocks)[:FIT_BLOCKS], labels[:FIT_BLOCKS]))
    alphabet = list("etaoinshrdlu")
    words = ["".join(rng.choice(alphabet, int(rng.integers(2, 9)))) for _ in range(500)]
    while len(main) < 50:
        main.append(" ".join(rng.choice(words, int(rng.integers(10, 120)))) + ".")
    while len(other) < 50:
        other.append(" ".join(rng.choice(words, int(rng.integers(1, 12)))))
    main, other = np.array(main, object), np.array(other, object)
    for _ in range(SYNTHETIC_PAGES):
        blocks, labels = composed(rng, main, other)
        examples.append((vectors(blocks)[:FIT_BLOCKS], labels[:FIT_BLOCKS]))
    labeller = Labeller()
    labeller.train(examples)
    return labeller


def fit(pages: DataFrame) -> Labeller:
    rows = pages.where("html is not null and page_id is not null").select("page_id", "html")
    chosen = rows.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(FIT_PAGES)
    sample = rows.join(F.broadcast(chosen), "page_id").dropDuplicates(["page_id"]).orderBy(F.xxhash64("page_id"), "page_id")
    return train([r["html"] for r in sample.collect()])


def extract(pages: DataFrame, labeller: Labeller | None = None) -> DataFrame:
    """Rows (page_id, url, text, n_chars, n_blocks) of all pages."""
    small_batches(pages.sparkSession, ROWS)
    shared = pages.sparkSession.sparkContext.broadcast(labeller or fit(pages))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        pages = [blocks_of(html) for html in batch.column("html").to_pylist()]
        chances = shared.value.probabilities([vectors(p) for p in pages])
        texts = [" ".join(b.text for b, c in zip(p, cs) if c > 0.5) for p, cs in zip(pages, chances)]
        return pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64()), pa.array([len(p) for p in pages], pa.int64())],
            ["page_id", "url", "text", "n_chars", "n_blocks"],
        )

    return over_batches(
        pages.select("page_id", "url", "html"), work,
        "page_id long, url string, text string, n_chars long, n_blocks long",
    )
