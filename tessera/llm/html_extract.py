"""HTML extraction by a recurrent block labeller, in numpy.

A page is read as its sequence of text blocks (``html_blocks``). Each block is a
vector: the mean of hashed vectors of its tag path, the mean of hashed vectors of
its words, and a few measures (length, share of links, place). A bidirectional
LSTM reads the sequence, so every block is judged in the context of the whole
page, and a logistic layer decides whether it is main text.

The network is trained on the driver on pages made by rule (``html_samples``; a
fixed number, so its cost is the same for any input) and runs in Spark tasks over
all pages, in batches of pages of similar length. Pages are read whole.

Defined results: null and empty html give an empty text; so does a page without
main blocks; repeated rows get equal texts. Extra columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .html_blocks import PATH_BUCKETS, Block, blocks_of
from .html_samples import MAIN, sample_pages
from .staging import prepare
from .words import blocks, split_words

WORD_BUCKETS = 4096
DIM, HIDDEN, MEASURES = 12, 20, 7
TRAIN_PAGES, EPOCHS, SEED = 1500, 5, 5
#: Share that word vectors lose at each step: words seen by chance fade away.
DECAY = 0.01


@dataclass
class Pages:
    """Blocks of some pages as arrays; ``first``: each page's first block."""

    path: np.ndarray        # hashed path tokens, block after block
    path_first: np.ndarray
    word: np.ndarray        # hashed words, block after block
    word_first: np.ndarray
    measures: np.ndarray
    first: np.ndarray


def encode(pages: list[list[Block]]) -> Pages:
    flat = [b for p in pages for b in p]
    first = np.concatenate(([0], np.cumsum([len(p) for p in pages]))).astype(np.int64)
    words = split_words([b.text.encode("utf-8", "replace") for b in flat], lower=True)
    chars = np.array([len(b.text) for b in flat], np.float64)
    count = np.diff(words.first)
    place = np.arange(len(flat)) - np.repeat(first[:-1], np.diff(first))
    size = np.repeat(np.diff(first), np.diff(first)).astype(np.float64)
    measures = np.stack([
        np.log1p(chars) / 8, np.log1p(count) / 6,
        np.minimum([b.link_chars for b in flat] / np.maximum(chars, 1), 1) if len(flat) else chars,
        place / np.maximum(size, 1), np.exp(-place / 4),
        np.array([b.text[-1:] in ".!?…" for b in flat], np.float64), np.ones(len(flat))], 1).astype(np.float32)
    paths = [b.path for b in flat]
    return Pages(np.fromiter((i for p in paths for i in p), np.int64),
                 np.concatenate(([0], np.cumsum([len(p) for p in paths]))).astype(np.int64),
                 (words.hashes() % np.uint64(WORD_BUCKETS)).astype(np.int64), words.first, measures, first)


def _mean(table: np.ndarray, index: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mean of the rows ``index`` of each stretch (zero for an empty one)."""
    total = np.zeros((len(first) - 1, table.shape[1]), np.float32)
    full = np.flatnonzero(np.diff(first) > 0)
    if len(full):
        total[full] = np.add.reduceat(table[index], first[:-1][full], axis=0)
    return total / np.maximum(np.diff(first), 1)[:, None].astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Layer:
    """One direction of the LSTM."""

    wx: np.ndarray
    wh: np.ndarray
    b: np.ndarray
    kept: list = field(default_factory=list)

    def run(self, x: np.ndarray, live: np.ndarray, keep: bool = False) -> np.ndarray:
        """States (steps, pages, HIDDEN) for input (steps, pages, features);
        ``live``: whether a page has a block at this step."""
        steps, n, _ = x.shape
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        gates = x @ self.wx + self.b
        out = np.zeros((steps, n, HIDDEN), np.float32)
        self.kept = []
        for t in range(steps):
            z = gates[t] + h @ self.wh
            i, f, o = np.split(_sigmoid(z[:, :3 * HIDDEN]), 3, axis=1)
            g = np.tanh(z[:, 3 * HIDDEN:])
            on = live[t][:, None]
            new = f * c + i * g
            th = np.tanh(new)
            if keep:
                self.kept.append((h, c, i, f, o, g, th, on))
            c = np.where(on, new, c)
            h = np.where(on, o * th, h)
            out[t] = h * on
        return out

    def back(self, x: np.ndarray, d_out: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        dh = np.zeros_like(d_out[0])
        dc = np.zeros_like(dh)
        dz_all = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
        d_wh = np.zeros_like(self.wh)
        for t in reversed(range(len(x))):
            h, c, i, f, o, g, th, on = self.kept[t]
            dh = dh + d_out[t] * on
            d_new = (dc + dh * o * (1 - th * th)) * on
            dz = np.concatenate((d_new * g * i * (1 - i), d_new * c * f * (1 - f),
                                 dh * on * th * o * (1 - o), d_new * i * (1 - g * g)), 1)
            dz_all[t] = dz
            d_wh += h.T @ dz
            dh = dz @ self.wh.T + dh * ~on
            dc = d_new * f + dc * ~on
        flat = dz_all.reshape(-1, 4 * HIDDEN)
        return dz_all @ self.wx.T, [x.reshape(-1, x.shape[2]).T @ flat, d_wh, flat.sum(0)]


@dataclass
class Labeller:
    paths: np.ndarray
    words: np.ndarray
    ahead: Layer
    behind: Layer
    out: np.ndarray
    bias: np.ndarray

    @classmethod
    def new(cls, rng: np.random.Generator) -> Labeller:
        def draw(*shape, scale=None):
            return (rng.normal(0, scale or 1 / np.sqrt(shape[0]), shape)).astype(np.float32)
        inputs = 2 * DIM + MEASURES
        layers = [Layer(draw(inputs, 4 * HIDDEN), draw(HIDDEN, 4 * HIDDEN), np.zeros(4 * HIDDEN, np.float32))
                  for _ in range(2)]
        return cls(draw(PATH_BUCKETS, DIM, scale=0.3), draw(WORD_BUCKETS, DIM, scale=0.02), *layers,
                   draw(2 * HIDDEN, 1), np.zeros(1, np.float32))

    def params(self) -> list[np.ndarray]:
        return [self.paths, self.words, *(p for a in (self.ahead, self.behind) for p in (a.wx, a.wh, a.b)),
                self.out, self.bias]

    def vectors(self, p: Pages) -> np.ndarray:
        return np.concatenate((_mean(self.paths, p.path, p.path_first),
                               _mean(self.words, p.word, p.word_first), p.measures), 1)

    @staticmethod
    def _grid(first: np.ndarray, pages: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Block index by (step, page), forwards and backwards, and where there is one."""
        size = np.diff(first)[pages]
        step = np.arange(size.max(initial=0))[:, None]
        live = step < size
        start = first[:-1][pages]
        return np.where(live, start + step, 0), np.where(live, start + size - 1 - step, 0), live

    def main_share(self, p: Pages, batch: int = 64) -> np.ndarray:
        """Probability of every block to be main text."""
        x, result = self.vectors(p), np.zeros(int(p.first[-1]))
        order = np.argsort(np.diff(p.first), kind="stable")
        for a in range(0, len(order), batch):
            pages = order[a:a + batch]
            fore, rear, live = self._grid(p.first, pages)
            if not len(fore):
                continue
            y = (self.ahead.run(x[fore], live) @ self.out[:HIDDEN])[..., 0]
            z = (self.behind.run(x[rear], live) @ self.out[HIDDEN:])[..., 0]
            result[fore[live]] += y[live]
            result[rear[live]] += z[live]
        return _sigmoid(result + self.bias[0])

    def gradients(self, p: Pages, label: np.ndarray) -> list[np.ndarray]:
        x = self.vectors(p)
        fore, rear, live = self._grid(p.first, np.arange(len(p.first) - 1))
        xa, xb = x[fore], x[rear]
        ha, hb = self.ahead.run(xa, live, True), self.behind.run(xb, live, True)
        n = len(x)
        sa, sb = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        sa[fore[live]], sb[rear[live]] = ha[live], hb[live]
        s = np.concatenate((sa, sb), 1)
        d = ((_sigmoid((s @ self.out)[:, 0] + self.bias[0]) - label) / n).astype(np.float32)[:, None]
        ds = d @ self.out.T
        dxa, ga = self.ahead.back(xa, ds[fore][:, :, :HIDDEN] * live[..., None])
        dxb, gb = self.behind.back(xb, ds[rear][:, :, HIDDEN:] * live[..., None])
        dx = np.zeros_like(x)
        dx[fore[live]] += dxa[live]
        dx[rear[live]] += dxb[live]
        tables = []
        for table, index, first, at in ((self.paths, p.path, p.path_first, 0), (self.words, p.word, p.word_first, DIM)):
            size = np.diff(first)
            grad = np.zeros_like(table)
            np.add.at(grad, index, np.repeat(dx[:, at:at + DIM] / np.maximum(size, 1)[:, None], size, axis=0))
            tables.append(grad)
        return [*tables, *ga, *gb, s.T @ d, d.sum(0)]


def labelled_page(page: str) -> tuple[list[Block], np.ndarray]:
    found = blocks_of(page)
    label = np.array([MAIN in b.text for b in found], np.float32)
    for b in found:
        b.text = b.text.replace(MAIN, "") or "-"
    return found, label


@functools.lru_cache(maxsize=1)
def trained(pages: int = TRAIN_PAGES, epochs: int = EPOCHS, seed: int = SEED, rate: float = 0.01) -> Labeller:
    """The labeller, fitted to pages made by rule (Adam on batches of 24 pages)."""
    data = [x for x in map(labelled_page, sample_pages(pages, seed)) if x[0]]
    rng = np.random.default_rng(seed)
    net = Labeller.new(rng)
    params = net.params()
    m, v = ([np.zeros_like(p) for p in params] for _ in range(2))
    step, steps = 0, epochs * (len(data) // 24 + 1)
    for _ in range(epochs):
        # pages of similar length together, batches in random order
        order = sorted(range(len(data)), key=lambda k: (len(data[k][0]) // 8, rng.random()))
        batches = [order[a:a + 24] for a in range(0, len(order), 24)]
        for b in rng.permutation(len(batches)):
            batch = [data[k] for k in batches[b]]
            grads = net.gradients(encode([x for x, _ in batch]), np.concatenate([y for _, y in batch]))
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            step += 1
            for p, g, m_, v_ in zip(params, grads, m, v, strict=True):
                g = g * min(1.0, 5 / (norm + 1e-9))
                m_ += 0.1 * (g - m_)
                v_ += 0.001 * (g * g - v_)
                p -= rate * (1 - 0.95 * step / steps) * (m_ / (1 - 0.9 ** step)) / (np.sqrt(v_ / (1 - 0.999 ** step)) + 1e-8)
            net.words *= 1 - DECAY
    for layer in (net.ahead, net.behind):
        layer.kept = []
    return net


def main_texts(net: Labeller, pages: list[str]) -> list[str]:
    """Main text of each page: its main blocks, joined by an empty line."""
    found = [blocks_of(p) for p in pages]
    coded = encode(found)
    keep = net.main_share(coded) >= 0.5
    return ["\n\n".join(b.text for b, k in zip(p, keep[a:a + len(p)], strict=True) if k)
            for p, a in zip(found, coded.first[:-1].tolist(), strict=True)]


def _extract(shared, id_col: str, url_col: str, html_col: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for block in blocks(batches, html_col, 2 << 20):
            texts = main_texts(net, [h or "" for h in block[html_col].to_pylist()])
            yield from pa.table({
                id_col: block[id_col], url_col: block[url_col], "text": pa.array(texts, pa.string()),
                "n_chars": pa.array([len(t) for t in texts], pa.int64())}).to_batches()

    return work


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            net: Labeller | None = None) -> DataFrame:
    """Main text of every page: ``id_col, url_col, text, n_chars``."""
    prepare(pages)
    shared = pages.sparkSession.sparkContext.broadcast(net or trained())  # fixed size, under 1 MB
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return pages.select(id_col, url_col, html_col).mapInArrow(
        _extract(shared, id_col, url_col, html_col),
        f"`{id_col}` {kinds[id_col]}, `{url_col}` {kinds[url_col]}, text string, n_chars long")
