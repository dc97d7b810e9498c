"""Substring dedup by super-k-mers of words.

A window is ``window`` consecutive words of one text. The minimiser of a window
is the smallest hash among its ``core``-word sequences; consecutive windows with
one minimiser travel as one packed string (their words joined by spaces) to the
bucket of that minimiser, so equal windows meet in one bucket while a word
travels about ``1 + 2 * window / (window - core + 2)`` times, not ``window``
times. In the bucket, sorting the windows brings equal ones together; equality
is confirmed on the words themselves.

Hot passages: before anything travels, each task marks the windows that repeat
inside one of its blocks of text. They have an earlier copy already, so only the
block's first copy travels: a passage in a third of all documents costs one
packed string per block. Windows that straddle the passage's edge differ in every
document and share a few minimisers: minimisers of more than ``HOT`` windows are
counted first, and their windows travel one by one to the bucket of the whole
window's hash, so no bucket is held by one task but that of equal windows. Hot is
what would fill a part of its own (more than HOT windows, and more than the mean
part), so there are fewer hot minimisers than parts. The packed strings of a block that go to one part of
the buckets share a compressed parcel; a task opens one part at a time.

Defined results: a null or empty text has no words and keeps nothing; a text
shorter than the window loses nothing; rows that share a doc_id are versions of
one document: windows at the same start don't remove each other, an earlier start
in any of them counts as earlier, and each loses only its own repeated windows (rows
are told apart by id and text; equal ones lose the same). A null doc_id counts as
the largest one. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import prepare, shuffle_tasks, stage, total
from .words import (
    BLOCK_BYTES, Words, as_bytes, blocks, inside_text, mix, runs, sequence_hashes, sliding_min, split_words,
)

NULL_ID = 2**63 - 1
#: Parts of the minimisers for each shuffle partition; a task holds one part at a time.
PARTS = 16
#: A minimiser of more windows than this, and than the mean part has, is hot. A block
#: reports its minimisers of SEEN different windows or more (fewer, if the parts are
#: so many that what it leaves out could fill one).
HOT, SEEN = 200_000, 32
_TRAVEL = "part int, n int, size long, parcel binary"
_SPANS = "doc long, row long, start int, n int"


def repeated_windows(words: Words, n: int, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Flags: the ``n``-word window at this word repeats an earlier one of the block.

    ``doc`` and ``start``: document and word index in it, for each word of the
    block; equal windows must come in the order of (doc, start). Windows of one
    place (repeated rows) don't count as earlier.
    """
    flags = np.zeros(len(words), bool)
    at = np.flatnonzero(inside_text(words, n))
    if len(at) < 2:
        return flags
    order = at[np.argsort(h := sequence_hashes(words.hashes(), n)[at], kind="stable")]
    h = np.sort(h)
    new = np.concatenate(([True], h[1:] != h[:-1]))
    first = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    later = (first != order) & ((doc[first] != doc[order]) | (start[first] != start[order]))
    copies, originals = order[later], first[later]
    by_place = np.argsort(copies)
    copies, originals = copies[by_place], originals[by_place]
    if not len(copies):
        return flags
    # confirm on the words: whole runs of windows at once
    cut = (np.diff(copies) != 1) | (np.diff(originals) != 1)
    begin = np.concatenate(([0], np.flatnonzero(cut) + 1))
    size = np.diff(np.concatenate((begin, [len(copies)])))
    text, offset = words.joined()
    a, b, more = copies[begin], originals[begin], size + n - 1
    for k, (p, p_end, q, q_end) in enumerate(zip(
            offset[a].tolist(), offset[a + more].tolist(),
            offset[b].tolist(), offset[b + more].tolist(), strict=True)):
        if text[p:p_end] == text[q:q_end]:
            flags[copies[begin[k]]:copies[begin[k]] + size[k]] = True
        else:  # two sequences with one hash: judge each window alone
            for j in range(begin[k], begin[k] + size[k]):
                x, y = copies[j], originals[j]
                flags[x] = text[offset[x]:offset[x + n]] == text[offset[y]:offset[y + n]]
    return flags


def minimisers(words: Words, window: int, core: int) -> np.ndarray:
    """Smallest hash of a ``core``-word sequence in the window at each word (0
    where the block ends before the window does)."""
    core_hash = np.full(len(words), np.uint64(2**64 - 1))
    got = mix(sequence_hashes(words.hashes(), core))
    core_hash[:len(got)] = got
    smallest = np.zeros(len(words), np.uint64)
    got = sliding_min(core_hash, window - core + 1) if len(words) >= window else got[:0]
    smallest[:len(got)] = got
    return smallest


def _often(window: int, core: int, seen: int):
    """Task function: the block's minimisers of ``seen`` different windows or more,
    and (null) the number of its windows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            words = split_words(as_bytes(block["text"]))
            at = np.flatnonzero(inside_text(words, window))
            if not len(at):
                continue
            _, first = np.unique(sequence_hashes(words.hashes(), window)[at], return_index=True)
            m, n = np.unique(minimisers(words, window, core)[at[first]], return_counts=True)
            m, n = m[n >= seen].view(np.int64), n[n >= seen]
            yield pa.RecordBatch.from_arrays(
                [pa.array([*m.tolist(), None], pa.int64()), pa.array([*n.tolist(), len(first)], pa.int64())], ["m", "n"])

    return work


def hot_minimisers(docs: DataFrame, text_col: str, window: int, core: int, hot: int, seen: int, parts: int) -> np.ndarray:
    """Minimisers of more windows than ``hot`` and than the mean of ``parts``, sorted;
    fewer than ``parts``."""
    seen = max(1, min(seen, BLOCK_BYTES // 8 // parts))
    found = stage(docs.select(F.col(text_col).alias("text")).mapInArrow(_often(window, core, seen), "m long, n long")
                  .groupBy("m").agg(F.sum("n").alias("n")), "minimisers")
    mean = total(found.where("m IS NULL"), "n") // parts
    rows = found.where(F.col("m").isNotNull() & (F.col("n") > max(hot, mean))).select("m").collect()
    return np.sort(np.array([r["m"] for r in rows], np.int64).view(np.uint64))


def _pack(window: int, core: int, parts: int, hot):
    """Task function: packed strings of the windows that have no earlier copy in
    their block, in one compressed parcel for each block and part (a part holds
    the buckets of ``1 / parts`` of the minimisers), and the spans of the windows
    that have one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            ids = block["id"].fill_null(NULL_ID).to_numpy().astype(np.int64)
            order = np.argsort(ids, kind="stable")
            ids = ids[order]
            texts = as_bytes(block["text"])
            words = split_words([texts[i] for i in order])
            per_text = np.diff(words.first)
            doc, row = np.repeat(ids, per_text), np.repeat(block["row"].to_numpy()[order], per_text)
            start = np.arange(len(words)) - np.repeat(words.first[:-1], per_text)
            again = repeated_windows(words, window, doc, start)
            fresh = inside_text(words, window) & ~again
            smallest = minimisers(words, window, core)
            known = hot.value
            if len(known):  # the windows of hot minimisers go by their own hash
                at = np.flatnonzero(fresh)
                at = at[np.searchsorted(known, smallest[at]) < np.searchsorted(known, smallest[at], "right")]
                smallest[at] ^= mix(sequence_hashes(words.hashes(), window)[at])
            at, n = runs(fresh, smallest, words.text_of())
            text, offset = words.joined()
            begin, end = offset[at], offset[at + n + window - 1] - 1
            part = (mix(smallest[at]) % np.uint64(parts)).astype(np.int64)
            by_part = np.argsort(part, kind="stable")
            at, part, begin, end = at[by_part], part[by_part], begin[by_part], end[by_part]
            packed = [text[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
            cut = np.flatnonzero(np.diff(part, prepend=-1))
            out = []
            for i, j in zip(cut.tolist(), [*cut[1:].tolist(), len(part)], strict=False):
                parcel = b"".join([doc[at[i:j]].tobytes(), row[at[i:j]].tobytes(), start[at[i:j]].tobytes(),
                                   (end[i:j] - begin[i:j]).tobytes(), *packed[i:j]])
                out.append((int(part[i]), j - i, len(parcel), pa.compress(parcel, "zstd", asbytes=True)))
            at, n = runs(again, words.text_of())
            if len(at):
                parcel = doc[at].tobytes() + row[at].tobytes() + start[at].tobytes() + n.tobytes()
                out.append((int(doc[0] % parts), -len(at), len(parcel),
                            pa.compress(parcel, "zstd", asbytes=True)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in out], t) for k, t in enumerate(
                    (pa.int32(), pa.int32(), pa.int64(), pa.binary()))],
                ["part", "n", "size", "parcel"])

    return work


def _open(parcel: bytes, size: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    raw = pa.decompress(parcel, size, "zstd", asbytes=True)
    doc, row, start, last = np.frombuffer(raw, np.int64, 4 * n).reshape(4, n)
    return doc, row, start, last, raw[32 * n:]


def _count(window: int):
    """Task function over rows sorted by part: spans of windows that repeat an
    earlier one of their part."""

    def judged(parcels: list) -> Iterator[pa.RecordBatch]:
        docs, rows, starts, texts = [], [], [], []
        for doc, row, start, size, text in parcels:
            docs.append(doc)
            rows.append(row)
            starts.append(start)
            end = np.cumsum(size)
            texts += [text[a:b] for a, b in zip((end - size).tolist(), end.tolist(), strict=True)]
        doc, start = np.concatenate(docs), np.concatenate(starts)
        order = np.lexsort((start, doc))
        words = split_words([texts[i] for i in order])
        per_text = np.diff(words.first)
        doc, row = np.repeat(doc[order], per_text), np.repeat(np.concatenate(rows)[order], per_text)
        start = (np.repeat(start[order] - words.first[:-1], per_text) + np.arange(len(words)))
        again = repeated_windows(words, window, doc, start)
        at, n = runs(again, words.text_of())
        yield _spans(doc[at], row[at], start[at], n)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            for part, n, size, parcel in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part != now and held:
                    yield from judged(held)
                    held = []
                now = part
                opened = _open(parcel, size, abs(n))
                if n < 0:
                    yield _spans(*opened[:4])
                else:
                    held.append(opened)
        if held:
            yield from judged(held)

    return work


def _spans(doc: np.ndarray, row: np.ndarray, start: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(doc), pa.array(row), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32))],
        ["doc", "row", "start", "n"])


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, row, text``: ``row`` tells the texts of one id apart."""
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("row"),
                       F.col(text_col).alias("text"))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = 20, core: int = 6, hot: int = HOT, seen: int = SEEN) -> DataFrame:
    """Spans of word windows that also start earlier: ``doc, row, start, n`` (``row``:
    hash of the text).

    ``n`` consecutive windows from word ``start`` of the document repeat an
    earlier window (smaller document, or earlier in the same one). ``core`` words
    make a minimiser: fewer travel less text, more make hot minimisers rarer.
    """
    prepare(docs)
    tasks = shuffle_tasks(docs)
    parts = tasks * PARTS
    known = docs.sparkSession.sparkContext.broadcast(hot_minimisers(docs, text_col, window, core, hot, seen, parts))
    return (_keyed(docs, id_col, text_col)
            .mapInArrow(_pack(window, core, parts, known), _TRAVEL)
            .repartition(tasks, "part")
            .sortWithinPartitions("part")
            .mapInArrow(_count(window), _SPANS))


def _remove(window: int, with_text: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            words = split_words(as_bytes(block["text"]))
            per_text = np.diff(words.first)
            # +1 where a removed stretch begins, -1 where it ends
            edge = np.zeros(len(words) + 1, np.int64)
            spans = block["spans"].combine_chunks()
            row = np.repeat(np.arange(block.num_rows),
                            spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            flat = spans.flatten()
            begin = words.first[row] + flat.field("start").to_numpy(zero_copy_only=False)
            end = begin + flat.field("n").to_numpy(zero_copy_only=False) + window - 1
            last = words.first[row + 1]
            np.add.at(edge, np.minimum(begin, last), 1)
            np.add.at(edge, np.minimum(end, last), -1)
            gone = np.cumsum(edge[:-1]) > 0
            text, offset = words.joined()
            kept = np.frombuffer(text, np.uint8)[np.repeat(~gone, np.diff(offset))].tobytes()
            upto = np.concatenate(([0], np.cumsum(np.diff(offset) * ~gone)))[words.first]
            parts = [kept[a:max(a, b - 1)] for a, b in zip(
                upto[:-1].tolist(), upto[1:].tolist(), strict=True)]
            removed = np.concatenate(([0], np.cumsum(gone)))[words.first]
            out = {"id": block["id"], "n_words": pa.array(per_text.astype(np.int64)),
                   "n_removed": pa.array(np.diff(removed).astype(np.int64)),
                   "kept_sha256": pa.array([hashlib.sha256(p).hexdigest() for p in parts])}
            if with_text:
                out["kept_text"] = pa.array([p.decode("utf-8", "replace") for p in parts])
            yield from pa.table(out).to_batches()

    return work


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = 20, core: int = 6, with_text: bool = True) -> DataFrame:
    """Every document without the words of windows that start earlier elsewhere.

    Returns ``id_col, n_words, n_removed, kept_sha256`` and, if asked for,
    ``kept_text`` (the words left, joined by one space).
    """
    spans = stage(repeated_spans(docs, id_col, text_col, window, core), "repeat-spans")
    per_row = (spans.groupBy("doc", F.col("row").alias("text_row"))
               .agg(F.collect_list(F.struct("start", "n")).alias("spans")))
    rows = _keyed(docs, id_col, text_col)
    schema = "id long, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if with_text else "")
    same = (F.coalesce("id", F.lit(NULL_ID)) == per_row["doc"]) & (rows["row"] == per_row["text_row"])
    return (rows.join(per_row, same, "left").select("id", "text", "spans")
            .mapInArrow(_remove(window, with_text), schema).withColumnRenamed("id", id_col))
