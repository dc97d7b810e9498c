"""Cross-tokenizer alignment by lockstep merging.

Every text is encoded by a byte-level BPE (A) and a piece BPE (B); both sequences
spell the same bytes. Walking both, a step links the A and B tokens at hand (their
byte ranges overlap) and moves on the side that ends first; where both end, a cut
closes a group. Here one NumPy state vector holds the two pointers of all documents
of a batch: a step moves every document at once, emits its links and cuts, and
compacts the documents that are through. A long document would keep the others
waiting, so it enters as several lanes: at about every ``LANE`` tokens a nearby byte
offset where both sides end is looked up, and its parts walk side by side.

Corpus-wide counts of id pairs need all documents first, so the job has two passes:
the tokens are stored (packed, 2 bytes each), pairs are counted by an aggregation,
and the documents are walked again against the counts. Pairs frequent enough to be
among ``HOT`` travel to the tasks; the links of all rarer pairs meet their counts in
a shuffled join, so nothing that is broadcast grows with the corpus.

Defined results: a null or empty text, and one whose joined token bytes differ from
a space and the text, has no tokens: zeros and an empty ``groups_sha256``. Rows are
told apart by place, not by doc_id: null and repeated ids and repeated rows are
documents like any other. Extra columns are ignored; an empty table gives an empty
table.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import prepare, stage
from .words import as_bytes, blocks

#: Folder of the tokenizer files.
FOLDER = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of text, or of packed tokens, in one batch.
BLOCK = 1 << 20
#: Tokens of a lane, and A tokens that are tried for its end.
LANE, NEAR = 256, 32
#: Pairs that travel to the tasks at most (17 bytes each).
HOT = 1 << 20
#: Different pairs that a task holds before it hands their counts on.
HELD = 1 << 20
#: How the byte-level tokenizer splits a text (a fixed value of its format).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 characters stand for their own
    byte, the other bytes, in order, for characters from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(c): b for c, b in [*((b, b) for b in own), *((256 + k, b) for k, b in enumerate(rest))]}


@dataclass
class Tokenizers:
    """Both tokenizers and the bytes of their tokens."""

    a: object
    b: object
    a_bytes: list[bytes]
    b_bytes: list[bytes]
    slow: object  # A by its own library, for texts that the fast encoder refuses

    def __post_init__(self):
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of A and B, None if the text has no tokens."""
        if not text:
            return None
        spaced = " " + text
        try:
            a = self.a.encode_ordinary(spaced)
        except BaseException as e:  # noqa: BLE001 - its regex engine panics on very long runs
            if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            a = self.slow().encode(spaced, add_special_tokens=False).ids
        b = self.b.encode(text, num_threads=1)
        raw = spaced.encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != raw or b"".join(map(self.b_bytes.__getitem__, b)) != raw:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)


@functools.lru_cache(maxsize=2)
def tokenizers(folder: str) -> Tokenizers:
    """The tokenizers of ``folder``, loaded once in a Python worker."""
    import sentencepiece
    import tiktoken

    path = os.path.join(folder, A_FILE)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    byte, vocab = byte_of_char(), spec["model"]["vocab"]
    special = {x["content"]: x["id"] for x in spec["added_tokens"] if x.get("special")}
    ranks = {bytes(byte[c] for c in token): k for token, k in vocab.items() if token not in special}
    a_bytes = [b""] * (1 + max([*ranks.values(), *special.values()]))
    for token, k in ranks.items():
        a_bytes[k] = token
    a = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    @functools.cache
    def slow():
        from tokenizers import Tokenizer
        out = Tokenizer.from_file(path)
        out.encode_special_tokens = True  # their strings in a text are plain text
        return out

    b = sentencepiece.SentencePieceProcessor(model_file=os.path.join(folder, B_FILE))
    b_bytes = []
    for piece in (b.id_to_piece(k) for k in range(b.get_piece_size())):
        one = re.fullmatch(r"<0x([0-9A-F]{2})>", piece)
        b_bytes.append(bytes([int(one[1], 16)]) if one else piece.replace("▁", " ").encode())
    return Tokenizers(a, b, a_bytes, b_bytes, slow)


def lanes(a_end: np.ndarray, b_end: np.ndarray, doc_a: np.ndarray, doc_b: np.ndarray,
          lane: int = LANE) -> tuple[np.ndarray, np.ndarray]:
    """First A and B token of each lane, with the number of all as last entry: the
    documents' first tokens, and tokens behind a common end, one about every ``lane``
    A tokens where the next ``NEAR`` have one."""
    at = np.arange(lane, len(a_end), lane)
    tried = np.minimum(at[:, None] + np.arange(NEAR), len(a_end) - 1)
    value = a_end[tried]
    place = np.minimum(np.searchsorted(b_end, value), max(len(b_end) - 1, 0))
    same = b_end[place] == value
    row, col = np.flatnonzero(same.any(1)), same.argmax(1)
    first_a = np.unique(np.concatenate((doc_a, tried[row, col[row]] + 1)))
    first_b = np.unique(np.concatenate((doc_b, place[row, col[row]] + 1)))
    return first_a, first_b


def walk(a_end: np.ndarray, b_end: np.ndarray, first_a: np.ndarray,
         first_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links (A and B index) in order, and flags: a cut follows the link.

    ``a_end``, ``b_end``: byte offsets after each token, rising through the batch;
    a lane's last A and B token end together.
    """
    a, stop = first_a[:-1].copy(), first_a[1:]
    b = first_b[:-1].copy()
    link = np.full(len(a_end) + len(b_end) + 1, -1, np.int64)
    cut = np.zeros(len(link), bool)
    while len(a):
        x, y = a_end[a], b_end[b]
        step = a + b  # rises along the whole batch: a place of its own for each link
        link[step] = a
        cut[step] = x == y
        a = a + (x <= y)
        b = b + (y <= x)
        on = a < stop
        if not on.all():
            a, b, stop = a[on], b[on], stop[on]
    step = np.flatnonzero(link >= 0)
    return link[step], step - link[step], cut[step]


@dataclass
class Aligned:
    """A batch of documents walked through."""

    a: np.ndarray       # ids of A and B of all documents
    b: np.ndarray
    first_a: np.ndarray  # first token of each document; one more entry at the end
    first_b: np.ndarray
    link_a: np.ndarray  # token indexes of each link
    link_b: np.ndarray
    cut: np.ndarray     # a cut follows the link
    first: np.ndarray   # first link of each document; one more entry at the end

    def codes(self) -> np.ndarray:
        return self.a[self.link_a] << 32 | self.b[self.link_b]


def align(tok: Tokenizers, pairs: list[tuple[np.ndarray, np.ndarray]]) -> Aligned:
    """Walks the (A ids, B ids) of some documents (empty arrays: no tokens)."""
    none = np.zeros(0, np.int64)
    a = np.concatenate([none, *(p[0] for p in pairs)])
    b = np.concatenate([none, *(p[1] for p in pairs)])
    doc_a = np.concatenate(([0], np.cumsum([len(p[0]) for p in pairs], dtype=np.int64)))
    doc_b = np.concatenate(([0], np.cumsum([len(p[1]) for p in pairs], dtype=np.int64)))
    a_end, b_end = np.cumsum(tok.a_size[a]), np.cumsum(tok.b_size[b])
    link_a, link_b, cut = walk(a_end, b_end, *lanes(a_end, b_end, doc_a, doc_b))
    return Aligned(a, b, doc_a, doc_b, link_a, link_b, cut, np.searchsorted(link_a, doc_a))


def group_texts(got: Aligned) -> list[bytes]:
    """Each document's groups as ``a1,a2|b1;a3|b2`` with decimal ids."""
    ends = np.flatnonzero(got.cut)
    per_a = np.diff(got.link_a[ends], prepend=-1)
    per_b = np.diff(got.link_b[ends], prepend=-1)
    group_a, group_b = np.repeat(np.arange(len(ends)), per_a), np.repeat(np.arange(len(ends)), per_b)
    before_a, before_b = np.cumsum(per_a), np.cumsum(per_b) - per_b
    place_a = np.arange(len(got.a)) + before_b[group_a]
    place_b = np.arange(len(got.b)) + before_a[group_b]
    ids = np.empty(len(got.a) + len(got.b), np.int64)
    ids[place_a], ids[place_b] = got.a, got.b
    mark = np.full(len(ids), ord(","), np.uint8)
    mark[place_a[before_a - 1]] = ord("|")
    mark[place_b[np.cumsum(per_b) - 1]] = ord(";")
    digits, size = _decimals(int(ids.max(initial=0)) + 1)
    width = digits.shape[1]
    text = np.empty((len(ids), width + 1), np.uint8)
    text[:, :width] = digits[ids]
    text[np.arange(len(ids)), size[ids]] = mark
    used = np.arange(width + 1) <= size[ids][:, None]
    raw = text[used].tobytes()
    upto = np.concatenate(([0], np.cumsum(size[ids] + 1)))[got.first_a + got.first_b]
    return [raw[x:max(x, y - 1)] for x, y in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]


@functools.lru_cache(maxsize=2)
def _decimals_to(top: int) -> tuple[np.ndarray, np.ndarray]:
    width = len(str(top - 1))
    left = np.array([str(k).ljust(width) for k in range(top)], f"S{width}").view(np.uint8).reshape(top, width)
    return left, np.array([len(str(k)) for k in range(top)], np.int64)


def _decimals(top: int) -> tuple[np.ndarray, np.ndarray]:
    """Digits (left-aligned) and number of digits of the numbers below ``top`` or more."""
    return _decimals_to(1 << max(16, (top - 1).bit_length()))


def _pack(ids: np.ndarray) -> bytes:
    """Ids in two or four bytes, all low bytes first (they compress better so)."""
    kind = np.uint16 if ids.max(initial=0) < 1 << 16 else np.uint32
    raw = ids.astype(kind)
    return bytes([raw.itemsize]) + raw.view(np.uint8).reshape(-1, raw.itemsize).T.tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    wide = raw[0]
    flat = np.frombuffer(raw, np.uint8, offset=1).reshape(wide, -1).T
    return np.ascontiguousarray(flat).view(f"<u{wide}").ravel().astype(np.int64)


def _encode(folder: str):
    """Task function: tokens and groups of whole texts."""
    nothing = np.zeros(0, np.int64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizers(folder)
        for block in blocks(batches, "text", BLOCK):
            pairs = [tok.encode(t) or (nothing, nothing) for t in block["text"].to_pylist()]
            got = align(tok, pairs)
            cuts = np.concatenate(([0], np.cumsum(got.cut)))[got.first]
            groups = group_texts(got)
            yield from pa.table({
                "id": block["id"], "n_a": pa.array(np.diff(got.first_a)), "n_b": pa.array(np.diff(got.first_b)),
                "n_groups": pa.array(np.diff(cuts)), "n_links": pa.array(np.diff(got.first)),
                "groups_sha256": pa.array([hashlib.sha256(g).hexdigest() if g else "" for g in groups]),
                "a": pa.array([_pack(p[0]) for p in pairs], pa.binary()),
                "b": pa.array([_pack(p[1]) for p in pairs], pa.binary())}).to_batches()

    return work


def _walked(folder: str, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, Aligned]]:
    tok = tokenizers(folder)
    for block in blocks(batches, "a", BLOCK):
        yield block, align(tok, [(_unpack(a), _unpack(b)) for a, b in zip(
            as_bytes(block["a"]), as_bytes(block["b"]), strict=True)])


def _summed(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    at = np.flatnonzero(np.concatenate((np.ones(min(1, len(codes)), bool), codes[1:] != codes[:-1])))
    return codes[at], np.add.reduceat(n[order], at) if len(at) else n[:0]


def _count_pairs(folder: str):
    """Task function: links of each id pair, combined over the task's batches."""

    def out(codes, n):
        return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], ["code", "n"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for _, got in _walked(folder, batches):
            more, m = np.unique(got.codes(), return_counts=True)
            codes, n = _summed(np.concatenate((codes, more)), np.concatenate((n, m)))
            if len(codes) > HELD:
                yield out(codes, n)
                codes, n = codes[:0], n[:0]
        yield out(codes, n)

    return work


def _apply(folder: str, hot):
    """Task function: each document's sums over the hot pairs, and its other pairs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count, best = hot.value
        for block, got in _walked(folder, batches):
            codes = got.codes()
            place = np.minimum(np.searchsorted(known, codes), max(len(known) - 1, 0))
            hit = known[place] == codes if len(known) else np.zeros(len(codes), bool)
            sums = []
            for v in (best, count):
                value = np.zeros(len(codes), np.int64)
                value[hit] = v[place[hit]]
                sums.append(np.diff(np.concatenate(([0], np.cumsum(value)))[got.first]))
            rest = np.flatnonzero(~hit)
            doc = np.searchsorted(got.first, rest, "right") - 1
            upto = np.searchsorted(doc, np.arange(block.num_rows + 1))
            yield from block.drop_columns(["a", "b"]).append_column("best", pa.array(sums[0])).append_column(
                "total", pa.array(sums[1])).append_column("rest", pa.ListArray.from_arrays(
                    pa.array(upto, pa.int32()), pa.array(codes[rest]))).to_batches()

    return work


def hot_pairs(counts: DataFrame, most: int):
    """The pairs of ``counts`` (code, n, best) of at least a power of two of links, as
    many such powers as ``most`` pairs allow: sorted codes, counts and flags."""
    levels = counts.groupBy(F.floor(F.log2("n")).alias("level")).agg(F.count(F.lit(1)).alias("c")).collect()
    least, held = 64, 0
    for r in sorted(levels, key=lambda r: -r["level"]):
        if held + r["c"] > most:
            break
        least, held = r["level"], held + r["c"]
    rows = counts.where(F.floor(F.log2("n")) >= least).select("code", "n", "best").toArrow()
    code = rows["code"].to_numpy()
    order = np.argsort(code)
    complete = held == sum(r["c"] for r in levels)
    return (code[order], rows["n"].to_numpy()[order], rows["best"].to_numpy().astype(bool)[order]), complete


def alignments(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = FOLDER,
               hot: int = HOT) -> DataFrame:
    """How the tokens of both tokenizers align in each document.

    Returns one row per row of ``docs``: ``id_col, n_a, n_b`` (tokens), ``n_groups``
    (stretches between common ends), ``n_links`` (A-B occurrences that share bytes),
    ``n_best`` (links whose id pair is the most frequent one of its B id in the
    corpus), ``count_sum`` (corpus-wide links of the links' pairs) and
    ``groups_sha256``. ``folder`` has the tokenizer files, on every executor.
    """
    prepare(docs)
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    per_doc = "id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
    tokens = stage(docs.mapInArrow(_encode(folder), per_doc + ", a binary, b binary"), "tokens", compression="zstd")
    pairs = stage(tokens.select("a", "b").mapInArrow(_count_pairs(folder), "code long, n long")
                  .groupBy("code").agg(F.sum("n").alias("n")), "pairs")
    b_id = F.col("code").bitwiseAND(F.lit((1 << 32) - 1))
    top = pairs.groupBy(b_id.alias("b")).agg(F.max("n").alias("top"))  # a row for each id of B's vocabulary at most
    counts = stage(pairs.join(F.broadcast(top), b_id == F.col("b")).select(
        "code", "n", (F.col("n") == F.col("top")).cast("long").alias("best")), "pair-counts")
    chosen, complete = hot_pairs(counts, hot)
    known = spark.sparkContext.broadcast(chosen)
    done = tokens.mapInArrow(_apply(folder, known), per_doc + ", best long, total long, rest array<long>")
    if not complete:
        done = stage(done.withColumn("row", F.monotonically_increasing_id()), "aligned")
        rest = (done.select("row", F.explode("rest").alias("code")).groupBy("row", "code").agg(F.count(F.lit(1)).alias("m"))
                .join(counts, "code").groupBy("row").agg(F.sum(F.col("m") * F.col("best")).alias("more_best"),
                                                         F.sum(F.col("m") * F.col("n")).alias("more")))
        done = (done.drop("rest").join(rest, "row", "left")
                .withColumn("best", F.col("best") + F.coalesce("more_best", F.lit(0)))
                .withColumn("total", F.col("total") + F.coalesce("more", F.lit(0))))
    return done.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", F.col("best").alias("n_best"),
                       F.col("total").alias("count_sum"), "groups_sha256")
