"""Language ID by a byte convolutional network, in numpy.

Text bytes (letters lower-cased) are embedded; filters of several widths slide
over a window of fixed length, each filter's largest response over the window is
kept (max pooling), and a softmax layer scores the languages. A text is cut into
windows that cover it whole; its language has the largest sum of log
probabilities over the windows, weighted by their letters.

Training is plain stochastic gradient descent (Adam) on the driver over a bounded
sample of labelled rows: per language about ``per_lang`` documents (those with the
smallest hash of id and text; rows equal in both are one) and ``windows_per_doc``
windows of each, at evenly spread places of its text. Prediction runs in Spark tasks over all documents.

Defined results: ``und`` with score 0 for null text and texts without a letter,
and for all texts if nothing labelled was given; the score is the mean
probability of the predicted language over the text's windows; ties go to the
language that sorts first; rows are judged one by one. Extra columns are ignored;
a kept column that is named like a result is replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import prepare, small, stage, unused
from .words import as_bytes, blocks

WINDOW = 256
WIDTHS = (2, 3, 4, 5)
FILTERS = 16
EMBED = 8
UNKNOWN = "und"
#: A character that some alphabet counts as a letter.
LETTER = r"\p{L}"
_BATCH = 256


def _fold() -> np.ndarray:
    """Byte codes: 0 pads; ASCII letters lose their case; digits are one code."""
    code = np.arange(256, dtype=np.uint8)
    code[65:91] += 32
    code[48:58] = 48
    code[[9, 10, 11, 12, 13]] = 32
    return code


FOLD = _fold()


@dataclass
class Net:
    """Weights: embedding, one matrix (width * EMBED, FILTERS) and bias per width,
    and the softmax layer."""

    langs: list[str]
    embed: np.ndarray
    conv: list[np.ndarray]
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def new(cls, langs: list[str], rng: np.random.Generator) -> Net:
        def draw(*shape):
            return rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        embed = rng.normal(0, 0.5, (256, EMBED)).astype(np.float32)
        embed[0] = 0
        return cls(langs, embed, [draw(w * EMBED, FILTERS) for w in WIDTHS],
                   [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
                   draw(len(WIDTHS) * FILTERS, len(langs)), np.zeros(len(langs), np.float32))

    def params(self) -> list[np.ndarray]:
        return [self.embed, *self.conv, *self.bias, self.out, self.out_bias]

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Largest response of every filter, and where it was."""
        e = self.embed[x]  # (windows, length, EMBED)
        best, place = [], []
        for w, k, b in zip(WIDTHS, self.conv, self.bias, strict=True):
            span = x.shape[1] - w + 1
            y = e[:, :span] @ k[:EMBED]
            for j in range(1, w):
                y += e[:, j:j + span] @ k[j * EMBED:(j + 1) * EMBED]
            at = y.argmax(1)
            place.append(at)
            best.append(np.take_along_axis(y, at[:, None], 1)[:, 0] + b)
        return np.concatenate(best, 1), place

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = np.maximum(self.pooled(x)[0], 0) @ self.out + self.out_bias
        z -= z.max(1, keepdims=True)
        p = np.exp(z)
        return p / p.sum(1, keepdims=True)


def windows(text: bytes, length: int = WINDOW) -> np.ndarray:
    """The whole text as rows of ``length`` byte codes, the last one padded."""
    n = max(1, -(-len(text) // length))
    out = np.zeros(n * length, np.uint8)
    out[:len(text)] = FOLD[np.frombuffer(text, np.uint8)]
    return out.reshape(n, length)


def train(x: np.ndarray, y: np.ndarray, langs: list[str], epochs: int = 4, rate: float = 4e-3,
          seed: int = 1) -> Net:
    """Fit a network to windows ``x`` with language numbers ``y``."""
    rng = np.random.default_rng(seed)
    net = Net.new(langs, rng)
    params = net.params()
    m, v = ([np.zeros_like(p) for p in params] for _ in range(2))
    weight = (len(y) / (len(langs) * np.bincount(y, minlength=len(langs)).clip(1)))[y].astype(np.float32)
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for a in range(0, len(order), 64):
            rows = order[a:a + 64]
            xb = x[rows]
            pool, place = net.pooled(xb)
            act = np.maximum(pool, 0)
            z = act @ net.out + net.out_bias
            z -= z.max(1, keepdims=True)
            p = np.exp(z)
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            dz = p * weight[rows][:, None] / len(rows)
            grads_out, grads_bias = act.T @ dz, dz.sum(0)
            dpool = (dz @ net.out.T) * (pool > 0)
            d_embed = np.zeros_like(net.embed)
            d_conv, d_bias = [], []
            for k, (w, kernel) in enumerate(zip(WIDTHS, net.conv, strict=True)):
                d = dpool[:, k * FILTERS:(k + 1) * FILTERS]
                # the bytes under each filter's best place: (windows, FILTERS, width)
                codes = xb[np.arange(len(rows))[:, None, None], place[k][:, :, None] + np.arange(w)]
                seen = net.embed[codes].reshape(len(rows), FILTERS, w * EMBED)
                d_conv.append(np.einsum("bf,bfe->ef", d, seen))
                d_bias.append(d.sum(0))
                back = (d[:, :, None] * kernel.T[None]).reshape(-1, EMBED)
                np.add.at(d_embed, codes.reshape(-1), back)
            step += 1
            for p_, g, m_, v_ in zip(params, [d_embed, *d_conv, *d_bias, grads_out, grads_bias], m, v, strict=True):
                m_ += 0.1 * (g - m_)
                v_ += 0.001 * (g * g - v_)
                p_ -= rate * (m_ / (1 - 0.9 ** step)) / (np.sqrt(v_ / (1 - 0.999 ** step)) + 1e-8)
            net.embed[0] = 0
    return net


def learn(labelled: DataFrame, id_col: str, text_col: str, lang_col: str, per_lang: int = 400,
          windows_per_doc: int = 6, seed: int = 1) -> Net | None:
    """A network trained on a bounded sample of ``labelled`` (None if it is empty).

    The sample's documents are picked by hash of id and text; a language's share of
    the hash range is set from its count, so that about ``per_lang`` documents (rows
    alike in both count once) come to the driver, as windows.
    """
    prepare(labelled)
    rows = labelled.where(F.col(lang_col).isNotNull() & F.rlike(F.coalesce(text_col, F.lit("")), F.lit(LETTER)))
    rows = rows.select(F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)).alias("key"),
                       F.col(text_col).alias("text"))
    size = stage(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    share = (F.abs(F.col("key") % 1_000_000_007) / 1_000_000_007.0) * F.col("n")
    # counted: a table of languages goes to the tasks, texts are not shuffled by language
    picked = rows.join(small(size, 100_000), "lang").where(share < per_lang).select("lang", "key", "text")
    picked = picked.dropDuplicates(["lang", "key"])  # null or repeated ids with one text don't add up

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            out = []
            for lang, key, text in zip(block["lang"].to_pylist(), block["key"].to_pylist(),
                                       as_bytes(block["text"]), strict=True):
                all_ = windows(text)
                at = np.unique(np.linspace(0, len(all_) - 1, windows_per_doc).astype(int))
                out += [(lang, key, int(a), all_[a].tobytes()) for a in at]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in out], t) for k, t in enumerate(
                    (pa.string(), pa.int64(), pa.int32(), pa.binary()))], ["lang", "key", "at", "codes"])

    got = sorted((r["lang"], r["key"], r["at"], bytes(r["codes"])) for r in picked.mapInArrow(
        cut, "lang string, key long, at int, codes binary").toLocalIterator())
    if not got:
        return None
    langs = sorted({r[0] for r in got})
    number = {lang: k for k, lang in enumerate(langs)}
    x = np.frombuffer(b"".join(r[3] for r in got), np.uint8).reshape(-1, WINDOW)
    return train(x, np.array([number[r[0]] for r in got]), langs, seed=seed)


def _predict(shared, keep: list[str], text_col: str, letters: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net: Net | None = shared.value
        for block in blocks(batches, text_col):
            texts = as_bytes(block[text_col])
            spoken = block[letters].to_numpy()
            lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            asked = np.flatnonzero(spoken) if net else np.zeros(0, int)
            if len(asked):
                parts = [windows(texts[i]) for i in asked]
                x = np.concatenate(parts)
                first = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
                p = np.concatenate([net.probabilities(x[a:a + _BATCH]) for a in range(0, len(x), _BATCH)])
                weight = ((x >= 97).sum(1) + 1e-6)[:, None]
                fit = np.add.reduceat(np.log(p + 1e-12) * weight, first[:-1], axis=0)
                best = fit.argmax(1)
                mean = np.add.reduceat(p * weight, first[:-1], axis=0) / np.add.reduceat(weight, first[:-1], axis=0)
                score[asked] = mean[np.arange(len(asked)), best]
                for i, b in zip(asked.tolist(), best.tolist(), strict=True):
                    lang[i] = net.langs[b]
            yield from pa.table({**{c: block[c] for c in keep}, "lang_pred": pa.array(lang, pa.string()),
                                 "score": pa.array(np.clip(score, 0, 1))}).to_batches()

    return work


def identify(docs: DataFrame, net: Net | None, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``keep`` of every row, with ``lang_pred`` and ``score``."""
    prepare(docs)
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a few thousand weights
    keep = tuple(c for c in keep if c.lower() not in ("lang_pred", "score"))
    name, = unused(docs, "letters")
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
                       + ["lang_pred string", "score double"])
    letters = F.rlike(F.coalesce(F.col(text_col), F.lit("")), F.lit(LETTER))
    rows = docs.select(*(F.col(f"`{c}`") for c in dict.fromkeys([*keep, text_col])), letters.alias(name))
    return rows.mapInArrow(_predict(shared, list(keep), text_col, name), schema)


def held_out(id_col: Column) -> Column:
    """Rows kept from training: crc32 of the id as text leaves 1 by 3."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                lang_col: str = "lang") -> tuple[DataFrame, Net | None]:
    """Train on the rows outside ``held_out`` and predict all: ``id_col, held_out,
    lang_pred, score``; also returns the network."""
    net = learn(docs.where(~held_out(F.col(id_col))), id_col, text_col, lang_col)
    rows = docs.select(F.col(id_col), F.col(text_col), held_out(F.col(id_col)).alias("held_out"))
    return identify(rows, net, text_col, (id_col, "held_out")), net
