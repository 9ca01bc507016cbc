"""Main text of web pages by a recurrent block labeller.

A page becomes the sequence of its text blocks.  Each block has a vector: hashed names of the
elements on its path with their classes and ids, hashed words of its text, and its length,
share of links and sentence ends.  A bidirectional LSTM reads the whole sequence both ways and
says of every block whether it is main text; the main blocks, in page order, are the text.

The network is trained here, on a bounded sample of pages whose blocks a plain rule about
elements labels, and on pages composed from the sample's paragraphs in many layouts, whose
labels are known from the composition; in some the main text stands in unmarked elements.
Sample pages in which nothing is marked as main text are left out.  Pages of about equal
length run through the network together.

Defined results: null and empty html have no text; text outside any element is a block;
unclosed and wrongly nested elements are repaired as `html_blocks` says; repeated rows are
labelled each; an empty table gives an empty answer.  Other columns are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from citeweave.llm.html_blocks import BINS, OTHER_NAMES, Block, Element, blocks, name_bit
from citeweave.llm.samples import hashed_sample
from citeweave.llm.words import slices, word_hashes

PATH, WORDS, PLAIN = BINS, 32, 5
SIZE = PATH + WORDS + PLAIN
HIDDEN = 16
#: Pages the sample holds at most, and pages composed for training.
SAMPLE_PAGES, COMPOSED = 200, 600
#: Training reads this many blocks of a page at most; labelling reads all.
TRAIN_BLOCKS = 120
#: Blocks, with padding, that run through the network at once.
CELLS = 1 << 14

def ruled(block: Block) -> bool:
    """Label of a sample block: below a main element and below nothing that is marked otherwise."""
    return bool(block.element and block.element.main and not block.element.other)


class Vectors:
    """Vectors of blocks, in two parts: hashed names of the path, and what the text shows."""

    def paths(self, found: list[Block]) -> tuple[np.ndarray, np.ndarray]:
        """Different path vectors, and which of them each block has."""
        places: dict[int, int] = {}
        of = np.array([places.setdefault(self._bits(b.element), len(places)) for b in found], np.int64)
        packed = b"".join(bits.to_bytes(PATH // 8, "little") for bits in places)
        rows = np.frombuffer(packed, np.uint8).reshape(len(places), PATH // 8)
        return np.unpackbits(rows, axis=1, bitorder="little").astype(np.float32), of

    @staticmethod
    def _bits(element: Element | None) -> int:
        return (element.bits if element else 0) | name_bit("leaf" + (f"<{element.tag}" if element else ""))

    def plain(self, found: list[Block]) -> np.ndarray:
        out = np.zeros((len(found), WORDS + PLAIN), np.float32)
        if not found:
            return out
        hashes, counts = word_hashes([b.text.encode("utf-8", "surrogatepass") for b in found])
        owner = np.repeat(np.arange(len(found)), counts)
        bins = owner * WORDS + (hashes & np.uint64(WORDS - 1)).astype(np.int64)
        spread = np.bincount(bins, minlength=len(found) * WORDS).reshape(-1, WORDS)
        out[:, :WORDS] = spread / np.maximum(1, counts)[:, None]
        sizes = np.array([len(b.text) for b in found])
        out[:, WORDS] = np.log1p(sizes) / 8
        out[:, WORDS + 1] = np.log1p(counts) / 6
        out[:, WORDS + 2] = np.minimum(1, np.array([b.linked for b in found]) / sizes)
        out[:, WORDS + 3] = [b.text[-1] in ".!?…\"'”" for b in found]
        out[:, WORDS + 4] = sizes > 80
        return out

    def of(self, found: list[Block]) -> np.ndarray:
        if not found:
            return np.zeros((0, SIZE), np.float32)
        paths, which = self.paths(found)
        return np.concatenate([paths[which], self.plain(found)], 1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Labeller:
    """Weights of both directions and of the output."""

    into: np.ndarray  # (2, SIZE, 4 * HIDDEN)
    again: np.ndarray  # (2, HIDDEN, 4 * HIDDEN)
    shift: np.ndarray  # (2, 4 * HIDDEN)
    out: np.ndarray  # (2 * HIDDEN,)
    constant: np.ndarray  # (1,)

    @classmethod
    def drawn(cls, rng: np.random.Generator) -> Labeller:
        draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[-2]), shape)
        shift = np.zeros((2, 4 * HIDDEN))
        shift[:, HIDDEN : 2 * HIDDEN] = 1  # remember at first
        return cls(draw(2, SIZE, 4 * HIDDEN), draw(2, HIDDEN, 4 * HIDDEN), shift, rng.normal(0, 0.3, 2 * HIDDEN), np.zeros(1))

    def parts(self) -> list[np.ndarray]:
        return [self.into, self.again, self.shift, self.out, self.constant]

    def run(self, x: np.ndarray, real: np.ndarray, trace: list | None = None) -> np.ndarray:
        """States (pages, blocks, 2 * HIDDEN) for vectors already times `into`, (2, pages, blocks, 4 * HIDDEN)."""
        _, n, length, _ = x.shape
        states = np.zeros((n, length, 2 * HIDDEN))
        for way, order in enumerate((range(length), range(length - 1, -1, -1))):
            h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
            for t in order:
                gates = x[way, :, t] + h @ self.again[way] + self.shift[way]
                inner = _sigmoid(gates[:, : 3 * HIDDEN])
                i, f, o = inner[:, :HIDDEN], inner[:, HIDDEN : 2 * HIDDEN], inner[:, 2 * HIDDEN :]
                g = np.tanh(gates[:, 3 * HIDDEN :])
                on = real[:, t, None]
                before_h, before_c = h, c
                new_c = f * c + i * g
                squashed = np.tanh(new_c)
                c = np.where(on, new_c, c)
                h = np.where(on, o * squashed, h)
                states[:, t, way * HIDDEN : (way + 1) * HIDDEN] = h
                if trace is not None:
                    trace.append((way, t, i, f, o, g, squashed, before_h, before_c))
        return states

    def given(self, found: list[Block], vectors: Vectors) -> np.ndarray:
        """What enters the gates of both directions, (blocks, 2, 4 * HIDDEN); a path is multiplied once."""
        if not found:
            return np.zeros((0, 2, 4 * HIDDEN))
        (paths, which), plain = vectors.paths(found), vectors.plain(found)
        return np.stack([(paths @ w[:PATH])[which] + plain @ w[PATH:] for w in self.into], 1)

    def scores(self, pages: list[list[Block]], vectors: Vectors) -> list[np.ndarray]:
        """Logit of every block of every page; pages of like length run together."""
        given = np.split(
            self.given([b for found in pages for b in found], vectors), np.cumsum([len(found) for found in pages])[:-1]
        )
        out: list[np.ndarray] = [np.empty(0)] * len(pages)
        order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
        start = 0
        while start < len(order):
            stop = start + 1
            while stop < len(order) and len(pages[order[stop]]) * (stop - start + 1) <= CELLS:
                stop += 1
            group = order[start:stop]
            x, real = _padded([given[k] for k in group])
            logits = self.run(np.moveaxis(x, 2, 0), real) @ self.out + self.constant
            for row, k in enumerate(group):
                out[k] = logits[row, : len(pages[k])]
            start = stop
        return out


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(map(len, pages))
    x, real = np.zeros((len(pages), longest, *pages[0].shape[1:])), np.zeros((len(pages), longest), bool)
    for row, page in enumerate(pages):
        x[row, : len(page)], real[row, : len(page)] = page, True
    return x, real


def _slopes(net: Labeller, x: np.ndarray, real: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Slopes of the mean log loss by every weight, back through all blocks of both directions."""
    flat = x.reshape(-1, SIZE)
    given = np.stack([flat @ w for w in net.into]).reshape(2, *x.shape[:2], -1)
    trace: list = []
    states = net.run(given, real, trace)
    off = np.where(real, _sigmoid(states @ net.out + net.constant) - y, 0) / real.sum()
    d_out = (states * off[..., None]).sum((0, 1))
    d_states = off[..., None] * net.out
    d_given, d_again = np.zeros_like(given), np.zeros_like(net.again)
    n = len(x)
    d_h, d_c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
    last = None
    for way, t, i, f, o, g, squashed, before_h, before_c in reversed(trace):
        if way != last:
            d_h, d_c, last = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN)), way
        on = real[:, t, None]
        d_h = d_h + d_states[:, t, way * HIDDEN : (way + 1) * HIDDEN]
        d_new_c = np.where(on, d_c + d_h * o * (1 - squashed**2), 0)
        gates = np.concatenate(
            [d_new_c * g * i * (1 - i), d_new_c * before_c * f * (1 - f), np.where(on, d_h * squashed * o * (1 - o), 0), d_new_c * i * (1 - g**2)], 1
        )
        d_given[way, :, t] = gates
        d_again[way] += before_h.T @ gates
        d_h = np.where(on, gates @ net.again[way].T, d_h)
        d_c = np.where(on, d_new_c * f, d_c)
    d_into = np.stack([flat.T @ d_given[way].reshape(len(flat), -1) for way in (0, 1)])
    return [d_into, d_again, d_given.sum((1, 2)), d_out, np.array([off.sum()])]


def fit(pages: list[tuple[list[Block], list[bool]]], seed: int = 0, rounds: int = 16, group: int = 40) -> Labeller:
    """Adam with falling steps over groups of pages of like length, on windows of `TRAIN_BLOCKS` blocks."""
    rng, vectors = np.random.default_rng(seed), Vectors()
    net = Labeller.drawn(rng)
    data = []
    for found, labels in pages:
        x, y = vectors.of(found), np.array(labels, float)
        data += [(x[k : k + TRAIN_BLOCKS], y[k : k + TRAIN_BLOCKS]) for k in range(0, len(y), TRAIN_BLOCKS)]
    data.sort(key=lambda d: len(d[1]))
    groups = [data[k : k + group] for k in range(0, len(data), group)]
    first = [np.zeros_like(p) for p in net.parts()]
    second = [np.zeros_like(p) for p in net.parts()]
    step, steps = 0, rounds * len(groups)
    for _ in range(rounds):
        for k in rng.permutation(len(groups)):
            x, real = _padded([d[0] for d in groups[k]])
            y = np.zeros(real.shape)
            for row, (_, labels) in enumerate(groups[k]):
                y[row, : len(labels)] = labels
            step += 1
            for p, a, b, slope in zip(net.parts(), first, second, _slopes(net, x, real, y), strict=True):
                a += 0.1 * (slope - a)
                b += 0.001 * (slope**2 - b)
                p -= 0.01 * (1 - step / (steps + 1)) * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return net


def composed(paragraphs: list[str], rng: np.random.Generator) -> tuple[list[Block], list[bool]]:
    """A page in a random layout, and which of its blocks are main text, known by where they stand."""
    clean = [re.sub(r"[<>&]", " ", p) for p in paragraphs] or ["Some words of a text."]
    pick = lambda low, high: [clean[k] for k in rng.integers(len(clean), size=rng.integers(low, high))]
    one = lambda items: items[rng.integers(len(items))]
    short = lambda: " ".join(one(clean).split()[: rng.integers(1, 5)]) or "more"
    links = lambda: "".join(f'<li><a href="/x">{short()}</a></li>' for _ in range(rng.integers(2, 12)))
    text = lambda: "".join(f"<p>{p}</p>" for p in pick(1, 4))
    marked = sorted(name for name in OTHER_NAMES if name[0] != "<")
    other = {
        "menu": lambda: one(["<nav><ul>{}</ul></nav>", '<div class="menu"><ul>{}</ul></div>', '<ul id="nav">{}</ul>']).format(links()),
        "header": lambda: one(["<header><h2>{}</h2></header>", '<div class="header"><p>{}</p></div>']).format(short()),
        "ad": lambda: one(['<div class="ad">{}</div>', '<aside class="advert"><p>{}</p></aside>', '<div class="banner ads"><p>{}</p></div>', '<div class="promo">{}</div>']).format(one(clean)),
        "side": lambda: one(["<aside><h3>{0}</h3>{1}</aside>", '<div class="sidebar"><h3>{0}</h3>{1}</div>', '<div class="related"><h3>{0}</h3>{1}</div>']).format(short(), text()),
        "notice": lambda: one(['<div class="cookie notice">{}</div>', '<div id="cookie-banner"><p>{}</p></div>', '<div class="notice"><p>{}</p></div>']).format(one(clean)),
        "form": lambda: f'<form action="/f"><label>{short()}</label><p>{one(clean)}</p><button>{short()}</button></form>',
        "comments": lambda: one(['<section class="comments">{}</section>', '<div id="comments">{}</div>', '<ol class="comment-list">{}</ol>']).format("".join(f'<div class="comment"><p>{p}</p></div>' for p in pick(1, 5))),
        "footer": lambda: one(["<footer>{0} {1}</footer>", '<div class="footer"><p>{0}</p><p>{1}</p></div>']).format(short(), one(clean)),
        "named": lambda: one(['<div class="{0}">{1}</div>', '<section id="{0}"><p>{1}</p></section>', '<ul class="{0}"><li>{1}</li></ul>', '<div class="{0}-box"><h3>{2}</h3>{3}</div>']).format(one(marked), one(clean), short(), text()),
    }
    page, mains = ["<body>"], []

    def add(piece: str, main: bool = False) -> None:
        start = sum(map(len, page))
        page.append(piece)
        if main:
            mains.append((start, start + len(piece)))

    def some(names: list[str], often: float = 0.5) -> None:
        for name in names:
            if rng.random() < often:
                add(other[name]())

    if rng.random() < 0.3:
        pair = one([("", ""), ("<div>", "</div>"), ("<section>", "</section>"), ("<div><div>", "</div></div>"), ('<div class="wrap">', "</div>"),
                    ('<div id="page"><div class="inner">', "</div></div>"), ("<table><tr><td>", "</td></tr></table>")])
    else:
        pair = one([("<article>", "</article>"), ("<main><article>", "</article></main>"), ("<main>", "</main>"), ('<div class="content">', "</div>"),
                    ('<div id="main"><section class="post">', "</section></div>"), ('<div class="wrap"><article class="entry">', "</article></div>"),
                    ('<div class="story">', "</div>")])
    some(["notice", "header", "menu", "ad", "side", "named"])
    add(pair[0])
    add(f"<h1>{short()}</h1>", True)
    for p in pick(1, 14):
        add(one(["<p>{}</p>", "<p>{}</p>", "<p>{}</p>", "<div>{}</div>", "<ul><li>{}</li></ul>", "<h2>{}</h2>"]).format(p), True)
        if rng.random() < 0.05:
            some(["ad", "side", "named"], 0.4)
    if rng.random() < 0.3:
        some(["comments", "form", "named"])
    add(pair[1])
    some(["side", "named", "ad", "form", "comments", "menu", "notice", "footer"])
    found = blocks("".join(page))
    return found, [any(start <= b.at < stop for start, stop in mains) for b in found]


def train(pages: list[str | None], seed: int = 0) -> Labeller:
    """Fit on sample pages under the rule and on composed pages."""
    rng = np.random.default_rng(seed)
    parsed = [blocks(p) for p in pages]
    data = [(found, [ruled(b) for b in found]) for found in parsed]
    texts = [b.text for found in parsed for b in found if len(b.text) > 40]
    return fit([d for d in data if any(d[1])] + [composed(texts, rng) for _ in range(COMPOSED)], seed)


def sample_pages(pages: DataFrame, n: int = SAMPLE_PAGES) -> list[str]:
    """The `n` pages with the smallest hashes of their ids."""
    chosen = hashed_sample(pages.where("html IS NOT NULL").select("page_id", "html"), "page_id", n)
    return [row["html"] for row in chosen.collect()]


def main_texts(pages: list[str | None], net: Labeller, vectors: Vectors) -> list[str]:
    parsed = [blocks(p) for p in pages]
    scores = net.scores(parsed, vectors)
    return [
        " ".join(b.text for b, s in zip(found, score, strict=True) if s > 0) if found else ""
        for found, score in zip(parsed, scores, strict=True)
    ]


def extract(pages: DataFrame, net: Labeller) -> DataFrame:
    """(page_id, url, text, n_chars), a row per row of `pages`."""
    sent = pages.sparkSession.sparkContext.broadcast(net)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = Vectors()
        for batch in slices(batches, "html", 2 << 20):
            texts = main_texts(batch.column("html").to_pylist(), sent.value, vectors)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id").cast(pa.int64()),
                    batch.column("url").cast(pa.string()),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(label, "page_id long, url string, text string, n_chars long")
