"""Benchmark decontamination by a prefix-filtered set join.

A window is ``window`` consecutive words of a benchmark item (an item of fewer
words is one window). It must be found whole, so it matches only where its
rarest shingle (``shingle`` words; counted over all documents) matches: that one
is the necessary prefix of its shingles in order of rarity. Documents are joined
with the windows on the prefix alone; a match at offset ``o`` fixes where the
window would start, which must leave room for the whole window inside the text
(positional and length bounds); then its words are compared one by one, as 64-bit
hashes.

The windows are the stated query set: they go to the tasks in blocks of at most
``block_windows`` (the number in every block is counted first), one pass over
the documents for each block; documents are never shuffled. Items don't travel
with the windows: a window carries one number for its set of items, and the numbers
that a document hits meet the items in a join.

Defined results: null and empty texts have no words and no hits; null items have
no windows, equal windows of several items count for each, an item without an id
is named by the empty string. Rows of ``docs`` are judged by their own text, however
many blocks there are: null and repeated ids share nothing. Extra columns are
ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import prepare, stage
from .words import ALNUM, as_bytes, blocks, inside_text, runs, sequence_hashes, split_words

#: Words of the longest shingle used as a prefix token.
SHINGLE = 3
#: Windows broadcast at once: 10 word hashes each, so about 30 MB.
BLOCK_WINDOWS = 200_000
#: Bytes of text in one numpy pass.
BLOCK = 2 << 20
_FILTER_BITS = 22
_HITS = "id long, key string, n_words long, spans array<struct<start:int,n:int>>, sets array<long>"


class _Lookup:
    """Positions of 64-bit keys in a sorted array of distinct ones, behind a bitmap."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.seen = np.zeros(1 << _FILTER_BITS, bool)
        self.seen[self._slot(keys)] = True

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``h``, index into the keys) of all equal pairs."""
        at = np.flatnonzero(self.seen[self._slot(h)])
        if not len(at) or not len(self.keys):
            return at[:0], at[:0]
        key = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        ok = self.keys[key] == h[at]
        return at[ok], key[ok]


def _windows(id_col: str, text_col: str, window: int):
    """Task function: the windows of each item as their word hashes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text_col, BLOCK):
            words = split_words(as_bytes(block[text_col]), ALNUM, lower=True)
            h, ids = words.hashes(), block[id_col].to_pylist()
            out = []
            for name, a, b in zip(ids, words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
                for i in range(a, max(a + 1, b - window + 1) if b > a else a):
                    out.append((name, h[i:min(i + window, b)].astype("<u8").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.binary())],
                ["item", "words"])

    return work


def _tokens(words: np.ndarray, shingle: int) -> np.ndarray:
    """Shingle hashes of one window, by offset."""
    return sequence_hashes(words, min(shingle, len(words)))


def _count_tokens(text_col: str, tokens, shingle: int):
    """Task function: how often each of ``tokens`` occurs in the documents."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Lookup(tokens.value)
        count = np.zeros(len(lookup.keys), np.int64)
        for block in blocks(batches, text_col, BLOCK):
            words = split_words(as_bytes(block[text_col]), ALNUM, lower=True)
            h = words.hashes()
            for n in range(1, shingle + 1):
                _, key = lookup.find(sequence_hashes(h, n)[inside_text(words, n)[:max(0, len(h) - n + 1)]])
                count += np.bincount(key, minlength=len(count))
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lookup.keys[at].astype(np.int64)), pa.array(count[at])], ["token", "c"])

    return work


def _find(shared, hits_only: bool):
    """Task function: spans of words inside occurring windows, and the numbers of
    the windows' item sets."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        lookup = _Lookup(w["tokens"])
        for block in blocks(batches, "text", BLOCK):
            words = split_words(as_bytes(block["text"]), ALNUM, lower=True)
            h, owner = words.hashes(), words.text_of()
            starts, found = [], []
            for n in np.unique(w["token_words"]).tolist():
                at, key = lookup.find(sequence_hashes(h, n))
                # every window whose prefix is this token
                size = w["by_token"][key + 1] - w["by_token"][key]
                k = np.repeat(w["by_token"][key] - np.cumsum(size) + size, size) + np.arange(size.sum())
                start = np.repeat(at, size) - w["offset"][k]
                ok = (start >= 0) & (w["token_words"][k] == n)
                start, k = start[ok], k[ok]
                # positional and length bounds: the whole window lies in this text
                ok = start + w["words"][k] <= words.first[owner[start] + 1]
                start, k = start[ok], k[ok]
                for j in range(int(w["words"].max(initial=0))):
                    inside = w["words"][k] > j
                    ok = ~inside
                    ok[inside] = h[start[inside] + j] == w["hashes"][k[inside], j]
                    start, k = start[ok], k[ok]
                starts.append(start)
                found.append(k)
            start, k = np.concatenate(starts or [[]]).astype(np.int64), np.concatenate(found or [[]]).astype(np.int64)
            yield from _report(block, words, owner, start, k, w, hits_only)

    return work


def _report(block: pa.Table, words, owner: np.ndarray, start: np.ndarray, k: np.ndarray, w: dict,
            hits_only: bool) -> list[pa.RecordBatch]:
    n_texts = len(words.first) - 1
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + w["words"][k], -1)
    begin, size = runs(np.cumsum(edge[:-1]) > 0, owner)
    text = owner[begin]
    by_text, number = owner[start], w["sets"][k]  # item sets by text, each once
    order = np.lexsort((number, by_text))
    by_text, number = by_text[order], number[order]
    new = np.ones(len(order), bool)
    new[1:] = (by_text[1:] != by_text[:-1]) | (number[1:] != number[:-1])
    offsets = lambda t: pa.array(np.searchsorted(t, np.arange(n_texts + 1)), pa.int32())
    spans = pa.StructArray.from_arrays(
        [pa.array((begin - words.first[text]).astype(np.int32)), pa.array(size.astype(np.int32))],
        ["start", "n"])
    out = pa.table({
        "id": block["id"], "key": block["key"], "n_words": pa.array(np.diff(words.first).astype(np.int64)),
        "spans": pa.ListArray.from_arrays(offsets(text), spans),
        "sets": pa.ListArray.from_arrays(offsets(by_text[new]), pa.array(number[new]))})
    return (out.filter(pa.array(np.bincount(text, minlength=n_texts) > 0)) if hits_only else out).to_batches()


def _block(rows: list[tuple[bytes, int]], counts: dict[int, int], shingle: int) -> dict:
    """One block of windows as arrays, ordered by prefix token."""
    made = []
    for raw, items in rows:
        words = np.frombuffer(raw, "<u8")
        tokens = _tokens(words, shingle)
        offset = min(range(len(tokens)), key=lambda o: (counts.get(int(tokens[o].astype(np.int64)), 0), int(tokens[o])))
        made.append((int(tokens[offset]), offset, words, items))
    made.sort(key=lambda m: m[0])
    width = max((len(m[2]) for m in made), default=0)
    hashes = np.zeros((len(made), width), np.uint64)
    for k, m in enumerate(made):
        hashes[k, :len(m[2])] = m[2]
    token = np.array([m[0] for m in made], np.uint64)
    tokens = np.unique(token)
    size = np.array([len(m[2]) for m in made], np.int64)
    return {"tokens": tokens, "by_token": np.append(np.searchsorted(token, tokens), len(token)),
            "offset": np.array([m[1] for m in made], np.int64), "words": size,
            "token_words": np.minimum(size, shingle), "hashes": hashes,
            "sets": np.array([m[3] for m in made], np.int64)}


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (``words``: their word hashes, ``set``: the number of their
    set of items), and the items of each set (``set, item``). A set's number is made
    of its size and two sums of hashes, so that no window's items are gathered."""
    pairs = stage(items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), text_col)
                  .mapInArrow(_windows("id", text_col, window), "item string, words binary").distinct(), "item-windows")
    sums = [F.sum(F.xxhash64("item", F.lit(k)).cast("decimal(20,0)")).alias(f"s{k}") for k in (1, 2)]
    windows = stage(pairs.groupBy("words").agg(F.count(F.lit(1)).alias("n"), *sums)
                    .select("words", F.xxhash64("n", "s1", "s2").alias("set")), "windows")
    return windows, stage(pairs.join(windows, "words").select("set", "item").distinct(), "item-sets")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", window: int = 10,
                  shingle: int = SHINGLE, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Which words of each document lie in windows of benchmark items.

    Returns ``id_col, n_words, n_hit, n_items, items_sha256, contaminated, spans``
    (``spans``: first word and number of words of each hit passage) and
    ``text_md5``, which with the id tells rows with different texts apart.
    """
    prepare(docs)
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.md5(F.col(text_col)).alias("key"),
                       F.col(text_col).alias("text"))
    windows, sets = item_windows(items, item_id_col, item_text_col, window)
    n_blocks = 1 + windows.count() // block_windows
    while True:  # blocks by hash, none over the bound
        block = F.pmod(F.xxhash64("words"), F.lit(n_blocks))
        most = windows.groupBy(block).count().agg(F.max("count")).first()[0] or 0
        if most <= block_windows:
            break
        n_blocks *= 2
    found = []
    for b in range(n_blocks):
        rows = [(bytes(r["words"]), r["set"]) for r in windows.where(block == b).collect()]
        tokens = [_tokens(np.frombuffer(raw, "<u8"), shingle) for raw, _ in rows]
        shared = spark.sparkContext.broadcast(np.unique(np.concatenate(tokens or [np.zeros(0, np.uint64)])))
        counts = {r["token"]: r["c"] for r in
                  docs.select("text").mapInArrow(_count_tokens("text", shared, shingle), "token long, c long")
                  .groupBy("token").agg(F.sum("c").alias("c")).collect()}
        shared.destroy()
        arrays = spark.sparkContext.broadcast(_block(rows, counts, shingle))
        # the first pass has all rows, the others those with hits; none has the texts
        found.append(stage(docs.mapInArrow(_find(arrays, b > 0), _HITS), f"hits-{b}"))
        arrays.destroy()
    hits = found[0]
    if n_blocks > 1:
        more = functools.reduce(DataFrame.union, found[1:]).groupBy("id", "key").agg(
            F.flatten(F.collect_set("spans")).alias("spans2"), F.flatten(F.collect_set("sets")).alias("sets2"))
        same = hits["id"].eqNullSafe(more["id"]) & (hits["key"] == more["key"])
        hits = hits.join(more, same, "left").select(
            hits["id"], hits["key"], "n_words", F.concat("spans", F.coalesce("spans2", F.array())).alias("spans"),
            F.array_distinct(F.concat("sets", F.coalesce("sets2", F.array()))).alias("sets"))
        hits = hits.withColumn("spans", _merged(F.array_sort("spans")))
    hits = stage(hits.withColumn("row", F.monotonically_increasing_id()), "hits")
    named = (hits.select("row", F.explode("sets").alias("set")).join(sets, "set").select("row", "item").distinct()
             .groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items")))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["n"])
    return (hits.withColumn("n_hit", n_hit).join(named, "row", "left").select(
        F.col("id").alias(id_col), "n_words", "n_hit", F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "spans", F.col("key").alias("text_md5")))


def _merged(spans: Column) -> Column:
    """Sorted spans with those that touch or overlap made one."""
    def step(done: Column, s: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        joined = F.struct(last["start"].alias("start"), (F.greatest(
            last["start"] + last["n"], s["start"] + s["n"]) - last["start"]).alias("n"))
        return F.when((F.size(done) > 0) & (s["start"] <= last["start"] + last["n"]),
                      F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(spans, F.array().cast("array<struct<start:int,n:int>>"), step)
