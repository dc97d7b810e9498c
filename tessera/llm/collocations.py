"""Phrase collocation mining with stripes.

A stripe is the associative counter of the words that follow a prefix: under the
empty prefix the words themselves, under a word the words after it, under two words
the third. So a phrase's frequency is one entry, a prefix's total is its entry in
the stripe that is one word shorter, and a prefix's most frequent extension is the maximum
of its stripe.

1. The words of each language get 64-bit ids (a hash of language and word, with
   another seed if two words share one: looked up, not assumed).
2. For two words, then three, each task counts the stripes of its blocks of text and
   sends them, packed and compressed, to the parts. Stripes merge elementwise: an
   entry goes to the part of its (prefix, next word), so a prefix with a third of
   all rows is spread over all parts, and a block sends one entry for a next word
   however often it saw it. Entries under the least count are dropped once whole.
3. A phrase can't be more frequent than the phrases in it: entries of which a part
   is surely rare don't travel (a Bloom filter of FILTER bits with the frequent
   shorter phrases; it lets rare ones pass when it fills, never drops a frequent one).
4. Cuts, scores, subsumption and ranks are joins and aggregations over the frequent
   phrases, in 38-digit decimals.

Defined results: a null or empty text, or one of separators only, has no words; a
null language is ``und`` (and joins rows that say so); ids are not read, so null or
repeated ones and repeated rows count like any other; extra columns are ignored; an
empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .staging import discard, prepare, shuffle_tasks, stage
from .words import Words, _word_bytes, as_bytes, blocks, join_hash, mix, split_words

#: Bytes between words, and those of them that end a piece.
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
WORD = _word_bytes(*((b, b) for b in _ENDS + b"\x20\x09"))
ENDS = ~_word_bytes(*((b, b) for b in _ENDS))
#: Language of rows without one.
UNKNOWN = "und"
#: Bits of the filter of frequent phrases, a power of two: 8 MB go to each task at any size of the input.
FILTER = 1 << 26
#: Shares of a language's phrases that are ranked apart before they meet.
SHARES = 16
#: Parts of the stripes for each shuffle partition; a task holds one part at a time.
PARTS = 4


def identified(block: pa.Table, seed: int) -> tuple[Words, np.ndarray, np.ndarray]:
    """The words of a block's texts, the id of each (of its language and bytes) and
    the number of its piece."""
    words = split_words(as_bytes(block["text"]), WORD, lower=True)
    langs = block["lang"].combine_chunks().dictionary_encode()
    known = np.array([xxhash.xxh64_intdigest(x, seed) for x in langs.dictionary.to_pylist()], np.uint64)
    h = words.hashes() if seed == 0 else np.fromiter(
        (xxhash.xxh64_intdigest(words.buf[a:b], seed) for a, b in zip(
            words.starts.tolist(), words.ends.tolist(), strict=True)), np.uint64, len(words))
    ids = mix(h ^ known[langs.indices.to_numpy()][words.text_of()])
    piece = np.cumsum(ENDS[np.frombuffer(words.buf, np.uint8)], dtype=np.int64)[words.starts]
    return words, ids, piece


def _count_words(seed: int):
    """Task function: the empty prefix's stripe of each block."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            words, ids, _ = identified(block, seed)
            ids, first, n = np.unique(ids, return_index=True, return_counts=True)
            a, b = words.starts[first], words.ends[first]
            found = [words.buf[x:y] for x, y in zip(a.tolist(), b.tolist(), strict=True)]
            yield from pa.table({
                "id": pa.array(ids.view(np.int64)), "lang": block["lang"].take(pa.array(words.text_of()[first])),
                "word": pa.array(found, pa.binary()).cast(pa.string()), "n": pa.array(n.astype(np.int64))}).to_batches()

    return work


def word_counts(docs: DataFrame) -> DataFrame:
    """Staged ``id, lang, word, n`` of ``lang, text`` rows, and the seed of the ids."""
    seed = 0
    while True:
        words = stage(docs.mapInArrow(_count_words(seed), "id long, lang string, word string, n long")
                      .groupBy("id", "lang", "word").agg(F.sum("n").alias("n")), "words")
        if words.groupBy("id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").isEmpty():
            words._seed = seed
            return words
        discard(words)
        seed += 1


def _sums(columns: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The different rows of ``columns``, sorted, and the sum of ``n`` of each."""
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    at = np.flatnonzero(new)
    return [c[at] for c in columns], np.add.reduceat(n[order], at) if len(at) else n[:0]


def sequence_key(columns: list[np.ndarray]) -> np.ndarray:
    """A hash of each row of ids."""
    out = mix(columns[0] + np.uint64(len(columns)))
    for c in columns[1:]:
        out = join_hash(out, c)
    return out


def _places(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a key in the filter."""
    low = np.uint64(FILTER - 1)
    return key & low, key >> np.uint64(32) & low


def passes(bits: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
    """Flags: the filter may hold this row of ids."""
    out = np.ones(len(columns[0]), bool)
    for p in _places(sequence_key(columns)):
        out &= (bits[p >> np.uint64(6)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)
    return out


def _marks(size: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(f"w{k}").to_numpy().view(np.uint64) for k in range(size)]
            p = np.concatenate(_places(sequence_key(columns)))
            yield pa.RecordBatch.from_arrays(
                [pa.array((p >> np.uint64(6)).astype(np.int32)),
                 pa.array((np.uint64(1) << (p & np.uint64(63))).view(np.int64))], ["at", "bits"])

    return work


def frequent_filter(frequent: DataFrame, size: int):
    """Broadcast Bloom filter of the rows of ids ``w0, w1, ...``: FILTER bits, whatever their number."""
    marks = (frequent.select(*(f"w{k}" for k in range(size))).mapInArrow(_marks(size), "at int, bits long")
             .groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow())
    bits = np.zeros(FILTER >> 6, np.uint64)
    bits[marks["at"].to_numpy()] = marks["bits"].to_numpy().view(np.uint64)
    return frequent.sparkSession.sparkContext.broadcast(bits)


def _stripes(size: int, seed: int, parts: int, known):
    """Task function: the stripes of each block's phrases of ``size`` words, one
    compressed parcel for each part that has entries."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            _, ids, piece = identified(block, seed)
            total = max(0, len(ids) - size + 1)
            ok = passes(known.value, [ids]) if size == 2 else None
            if ok is not None:  # both words
                ok = ok[:total] & ok[1:total + 1]
            else:  # both phrases that are one word shorter
                short = passes(known.value, [ids[k:k + total + 1] for k in range(size - 1)])
                ok = short[:total] & short[1:total + 1]
            ok &= piece[:total] == piece[size - 1:size - 1 + total]
            at = np.flatnonzero(ok)
            columns, n = _sums([ids[at + k] for k in range(size)], np.ones(len(at), np.int64))
            part = (sequence_key(columns) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            columns, n, part = [c[order] for c in columns], n[order], part[order]
            cut = np.flatnonzero(np.diff(part, prepend=-1))
            out = []
            for i, j in zip(cut.tolist(), [*cut[1:].tolist(), len(part)], strict=False):
                parcel = _packed([c[i:j] for c in columns], n[i:j])
                out.append((int(part[i]), len(parcel), pa.compress(parcel, "zstd", asbytes=True)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int32(), pa.int64(), pa.binary()))],
                ["part", "size", "parcel"])

    return work


def _packed(columns: list[np.ndarray], n: np.ndarray) -> bytes:
    """Stripes as bytes: each prefix once with its number of next words, then the
    next words and their counts."""
    new = np.zeros(len(n), bool)
    new[:1] = True
    for c in columns[:-1]:
        new[1:] |= c[1:] != c[:-1]
    at = np.flatnonzero(new)
    length = np.diff(at, append=len(n))
    return b"".join([np.array([len(at), len(n)], np.int64).tobytes(), *(c[at].tobytes() for c in columns[:-1]),
                     length.tobytes(), columns[-1].tobytes(), n.tobytes()])


def _opened(raw: bytes, size: int) -> tuple[list[np.ndarray], np.ndarray]:
    a, b = np.frombuffer(raw, np.int64, 2).tolist()
    flat = np.frombuffer(raw, np.uint64, offset=16)
    length = flat[(size - 1) * a:size * a].astype(np.int64)
    prefix = [np.repeat(flat[k * a:(k + 1) * a], length) for k in range(size - 1)]
    return [*prefix, flat[size * a:size * a + b]], flat[size * a + b:].view(np.int64)


def _merge(size: int, least: int):
    """Task function over parcels sorted by part: entries of ``least`` or more."""

    def merged(held: list) -> pa.RecordBatch:
        columns, n = _sums([np.concatenate(c) for c in zip(*(x[0] for x in held), strict=True)],
                           np.concatenate([x[1] for x in held]))
        keep = n >= least
        return pa.RecordBatch.from_arrays([*(pa.array(c[keep].view(np.int64)) for c in columns), pa.array(n[keep])],
                                          [*(f"w{k}" for k in range(size)), "n"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            for part, raw, parcel in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part != now and held:
                    yield merged(held)
                    held = []
                now = part
                held.append(_opened(pa.decompress(parcel, raw, "zstd", asbytes=True), size))
        if held:
            yield merged(held)

    return work


def frequent_phrases(docs: DataFrame, words: DataFrame, longest: int, least: int) -> list[DataFrame]:
    """Staged ``w0, w1, ..., n`` of the phrases of 2 to ``longest`` words that occur
    ``least`` times or more."""
    tasks = shuffle_tasks(docs)
    shorter, out = words.where(F.col("n") >= least).withColumnRenamed("id", "w0"), []
    for size in range(2, longest + 1):
        known = frequent_filter(shorter, size - 1)
        schema = "".join(f"w{k} long, " for k in range(size)) + "n long"
        shorter = stage(docs.mapInArrow(_stripes(size, words._seed, tasks * PARTS, known), "part int, size long, parcel binary")
                        .repartition(tasks, "part").sortWithinPartitions("part")
                        .mapInArrow(_merge(size, least), schema), f"phrases-{size}")
        known.destroy()
        out.append(shorter)
    return out


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = 3,
                 least: int = 10, cover: int = 50, top: int = 2000) -> DataFrame:
    """The ``top`` phrases of each language by score.

    A candidate has 2 to ``longest`` words and ``a >= least`` occurrences inside
    pieces. Its worst cut gives ``l``, ``r`` (occurrences of both sides) and
    ``score = floor(1000000 a a / (l r))``. Dropped if a longer candidate around it
    has ``100 * occurrences >= cover * a``. Returns ``lang, rank, phrase, a, l, r,
    n`` (words of the language) and ``score``.
    """
    prepare(docs)
    docs = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    words = word_counts(docs)
    sizes = frequent_phrases(docs, words, longest, least)
    single = words.where(F.col("n") >= least).select("id", "lang", "word", "n")
    known = single.select(F.array("id").alias("ids"), "n")
    phrases = None
    for size, found in enumerate(sizes, 2):
        rows = found.select(F.array(*(f"w{k}" for k in range(size))).alias("ids"), "n")
        phrases = rows if phrases is None else phrases.union(rows)
    phrases = stage(phrases, "phrases")
    known = stage(known.union(phrases), "frequent")

    cuts = phrases.withColumnRenamed("n", "a").withColumn("k", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)))
    for side, part in (("l", F.expr("slice(ids, 1, k)")), ("r", F.expr("slice(ids, k + 1, size(ids) - k)"))):
        cuts = cuts.withColumn("part", part).join(
            known.select(F.col("ids").alias("part"), F.col("n").alias(side)), "part").drop("part")
    # up to 10 ** 15 occurrences in exact decimals
    score = F.expr("""CAST(CAST(1000000 AS DECIMAL(7,0)) * (CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0)))
                      div (CAST(l AS DECIMAL(15,0)) * CAST(r AS DECIMAL(15,0))) AS BIGINT)""")
    scored = (cuts.withColumn("score", score).groupBy("ids")
              .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.first("a").alias("a")))
    inner = phrases.select(F.explode(F.expr("""flatten(transform(filter(sequence(2, size(ids)), m -> m < size(ids)),
        m -> transform(sequence(1, size(ids) - m + 1), i -> slice(ids, i, m))))""")).alias("ids"), "n")
    around = inner.groupBy("ids").agg(F.max("n").alias("most"))
    left = (scored.join(around, "ids", "left").where(~F.coalesce(100 * F.col("most") >= cover * F.col("a"), F.lit(False)))
            .select("ids", "a", "cut.l", "cut.r", "cut.score"))
    for k in range(longest):
        word = single.select(F.col("id").alias("wid"), F.col("word").alias(f"word{k}"), *(["lang"] if k == 0 else []))
        left = left.withColumn("wid", F.expr(f"try_element_at(ids, {k + 1})")).join(word, "wid", "left").drop("wid")
    named = left.select("lang", F.concat_ws(" ", *(f"word{k}" for k in range(longest))).alias("phrase"), "a", "l", "r", "score")
    # the best of each share first: a language with a third of all rows sends SHARES * top phrases to its last task
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    named = named.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SHARES)))
    for keys in (["lang", "share"], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        named = named.withColumn("rank", place).where(F.col("rank") <= top)
    best = named
    n = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return best.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
