"""MinHash near-dedup: one-permutation hashing, banded buckets, star edges.

1. Each document's set of word shingles is sketched with one-permutation hashing
   and optimal densification; bands of the sketch are bucket keys.
2. Documents with one shingle set become one class (an aggregation; copies are
   never expanded into pairs). Only the class representative, the smallest
   doc_id, goes on.
3. Every bucket sends star edges: from its centre, the member that shares most
   buckets (in a group of near copies, the text nearest to all), to the members.
   A bucket of n members makes n - 1 pairs, and most buckets of a group have the
   same centre, so the distinct pairs are few.
4. Each pair is confirmed on the full shingle sets; confirmed links give
   components (alternating large and small stars).
5. Buckets that still hold several components send stars from the best centre
   outside the first centre's component too.
6. Buckets that hold several components even without those two centres are
   finished exactly (``_rest_pairs``): of their members, each pair that can be
   similar enough is confirmed, whoever the centres were.

With 40 bands of 4 bins two texts at the similarity 0.75 share no bucket with
probability 2.5e-7; links between texts that share a bucket are all found or
joined over other links.

Defined results: a null or empty text has an empty set, links with nothing and is
its own component; a text with fewer words than a shingle has its whole sequence
as its one shingle; rows that share a doc_id are versions of one document (it has
the links of all); a null doc_id cannot be named by a link: such a row is kept,
with a null component. Extra columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import discard, prepare, small, stage
from .words import as_bytes, blocks, inside_text, mix, sequence_hashes, split_words

#: Bins of the one-permutation sketch: BANDS bands of ROWS bins.
BANDS, ROWS = 40, 4
#: Bytes of text in one numpy pass.
BLOCK = 2 << 20
#: A shingle of more of the texts left after the stars than this is a hot one
#: (more, if there would be over HOT_MOST: they travel to the tasks).
HOT, HOT_MOST = 64, 500_000


def shingle_sets(texts, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``size``-word shingles of each text, lower-cased, as sorted
    64-bit hashes one text after another, and the offsets of the texts. A text
    of fewer words has its whole sequence as its only shingle, a text without
    words none."""
    words = split_words(texts, lower=True)
    h, per_text = words.hashes(), np.diff(words.first)
    whole = inside_text(words, size)
    owner = words.text_of()
    hashes = [sequence_hashes(h, size)[whole[:max(0, len(words) - size + 1)]]]
    owners = [owner[whole]]
    for n in range(1, size):
        short = np.flatnonzero(per_text == n)
        if len(short):
            hashes.append(mix(sequence_hashes(h, n)[words.first[short]] + np.uint64(n)))
            owners.append(short)
    s, t = np.concatenate(hashes), np.concatenate(owners)
    order = np.lexsort((s, t))
    s, t = s[order], t[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (t[1:] != t[:-1])
    s, t = s[new], t[new]
    return s, np.concatenate(([0], np.cumsum(np.bincount(t, minlength=len(per_text)))))


@functools.lru_cache(maxsize=4)
def _donors(bins: int) -> np.ndarray:
    """For each bin the order in which an empty one asks the others for a value."""
    rng = np.random.default_rng(bins)
    return np.stack([rng.permutation(bins) for _ in range(bins)])


def sketches(s: np.ndarray, offsets: np.ndarray, bins: int) -> np.ndarray:
    """One-permutation sketch of each set: the smallest hash in each of ``bins``
    equal ranges; an empty bin takes the value of a bin picked by a hash that is
    the same for all sets (optimal densification)."""
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(offsets))
    place = ((s >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    new = np.ones(len(s), bool)
    new[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
    out = np.zeros((n, bins), np.uint64)
    full = np.zeros((n, bins), bool)
    out[owner[new], place[new]] = s[new]
    full[owner[new], place[new]] = True
    own, donors = full.copy(), _donors(bins)
    row, col = np.nonzero(~full & (np.diff(offsets) > 0)[:, None])
    for t in range(bins):
        if not len(row):
            break
        donor = donors[col, t]
        has = own[row, donor]
        out[row[has], col[has]] = out[row[has], donor[has]]
        row, col = row[~has], col[~has]
    return out


def band_keys(sketch: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit bucket key for each band of ``rows`` bins."""
    n, bins = sketch.shape
    parts = sketch.reshape(n, bins // rows, rows)
    key = np.broadcast_to(np.arange(bins // rows, dtype=np.uint64), parts.shape[:2])
    for r in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return key


def _sketch(id_col: str, text_col: str, size: int, bands: int, rows: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text_col, BLOCK):
            s, at = shingle_sets(as_bytes(block[text_col]), size)
            n = np.diff(at)
            keys = band_keys(sketches(s, at, bands * rows), rows).astype(np.int64)
            # fingerprint of the set: two sums over its scrambled hashes
            prints = [np.concatenate(([np.uint64(0)], np.cumsum(mix(s + np.uint64(c)))))
                      for c in (0x51, 0xA7)]
            prints = [(c[at[1:]] - c[at[:-1]]).astype(np.int64) for c in prints]
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum(np.where(n > 0, bands, 0)))), pa.int32()),
                pa.array(keys[n > 0].ravel()))
            yield from pa.table({
                "id": block[id_col], "n": pa.array(n.astype(np.int64)),
                "p1": pa.array(prints[0]), "p2": pa.array(prints[1]), "bands": lists}).to_batches()

    return work


def _sets(id_col: str, text_col: str, size: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text_col, BLOCK):
            s, at = shingle_sets(as_bytes(block[text_col]), size)
            raw = s.tobytes()
            yield from pa.table({
                "id": block[id_col],
                "shingles": pa.array([raw[8 * a:8 * b] for a, b in zip(
                    at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.binary()),
            }).to_batches()

    return work


def _confirm(threshold: int):
    """Task function: the pairs with 100 * intersection >= threshold * union."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            left, right = batch.column("left"), batch.column("right")
            for k in range(batch.num_rows):
                a = np.frombuffer(left[k].as_buffer(), np.uint64)
                b = np.frombuffer(right[k].as_buffer(), np.uint64)
                both = np.concatenate((a, b))
                both.sort(kind="stable")  # merges the two sorted runs
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                keep[k] = 100 * common >= threshold * (len(both) - common)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return work


def confirmed(docs: DataFrame, pairs: DataFrame, id_col: str, text_col: str, size: int,
              threshold: int) -> DataFrame:
    """The pairs (a, b) of ``pairs`` whose full shingle sets are similar enough (a pair
    more than once, if a document has versions)."""
    ids = stage(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "pair-ids")
    # counted: up to 16 MB of ids or pairs travel to the tasks, instead of all texts or sets
    sets = stage(docs.join(small(ids, 2_000_000), docs[id_col] == ids["id"], "left_semi")
                 .mapInArrow(_sets(id_col, text_col, size), "id long, shingles binary"),
                 "shingle-sets")
    sides = [sets.join(small(pairs, 1_000_000), sets["id"] == pairs[k])
             .select("a", "b", F.col("shingles").alias(side)) for k, side in (("a", "left"), ("b", "right"))]
    links = stage(sides[0].join(sides[1], ["a", "b"]).select("a", "b", "left", "right")
                  .mapInArrow(_confirm(threshold), "a long, b long"), "links")
    discard(sets)
    return links


def _tokens(text_col: str, size: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text_col, BLOCK):
            s, _ = shingle_sets(as_bytes(block[text_col]), size)
            yield pa.RecordBatch.from_arrays([pa.array(s.view(np.int64))], ["s"])

    return work


def _cold_prefix(id_col: str, text_col: str, size: int, hot, threshold: int):
    """Task function: size of each set, its number of hot shingles, two sums over
    their hashes (a fingerprint of its hot part) and the first of the others by hash:
    as many as must hold a shared one, if a similar enough set shares any of them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = hot.value
        for block in blocks(batches, text_col, BLOCK):
            s, at = shingle_sets(as_bytes(block[text_col]), size)
            n = np.diff(at)
            cold = np.searchsorted(known, s) == np.searchsorted(known, s, "right")
            before = np.concatenate(([0], np.cumsum(cold)))
            owner = np.repeat(np.arange(len(n)), n)
            need = n - -(-threshold * n // 100) + 1
            sums = [np.concatenate(([np.uint64(0)], np.cumsum(np.where(cold, np.uint64(0), mix(s + np.uint64(c))))))
                    for c in (0x51, 0xA7)]
            first = cold & (before[:-1] - before[at[owner]] < need[owner])
            offsets = np.concatenate(([0], np.cumsum(first)))[at]
            yield from pa.table({
                "id": block[id_col], "n": pa.array(n.astype(np.int64)),
                "h": pa.array((n - np.diff(before[at])).astype(np.int64)),
                **{f"hot{k}": pa.array((c[at[1:]] - c[at[:-1]]).astype(np.int64)) for k, c in enumerate(sums)},
                "prefix": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(s[first].view(np.int64))),
            }).to_batches()

    return work


def _rest_pairs(docs: DataFrame, rest: DataFrame, id_col: str, text_col: str, size: int,
                threshold: int, hot: int) -> DataFrame:
    """Pairs (a, b) of different components that can be similar enough, among the
    bucket members ``rest`` (key, rep, n, component).

    In an order of all shingles that has the hot ones last, the first shingle
    that two similar enough sets share is in the prefixes of both. If it is not
    hot, the pair meets there (a shingle that is not hot has at most ``hot``
    texts, so these pairs grow with the texts). If it is, they share hot ones
    only; then ``(100 + threshold) * h >= threshold * (n + other n)`` for both,
    which few texts meet that the stars have not joined. Of the members of a bucket
    with one and the same hot part, the smallest shares as much with any text as the
    others do, and so links wherever one of them links over hot shingles: each
    member is paired with the smallest member of each hot part of its buckets. If x
    and y link, so do x and y's smallest, y and x's smallest, and those two.
    """
    spark = docs.sparkSession
    label = stage(rest.select(F.col("rep").alias("id"), "component").distinct(), "rest-ids")
    texts = docs.join(small(label.select("id"), 2_000_000), docs[id_col] == label["id"], "left_semi")
    often = stage(texts.mapInArrow(_tokens(text_col, size), "s long").groupBy("s").agg(F.count(F.lit(1)).alias("c"))
                  .where(F.col("c") > hot), "often")
    while often.where(F.col("c") > hot).count() > HOT_MOST:
        hot *= 2
    known = often.where(F.col("c") > hot).select("s").toArrow()["s"].to_numpy().view(np.uint64)
    known = spark.sparkContext.broadcast(np.sort(known))
    text = stage(texts.mapInArrow(_cold_prefix(id_col, text_col, size, known, threshold),
                                  "id long, n long, h long, hot0 long, hot1 long, prefix array<long>")
                 .where("n > 0").join(small(label, 1_000_000), "id"), "rest-prefixes")
    near = F.expr(f"100 * least(x.n, y.n) >= {threshold} * greatest(x.n, y.n)") & F.expr("x.component <> y.component")
    # at most ``hot`` texts for each shingle
    met = (text.select(F.explode("prefix").alias("s"), F.struct("id", "n", "component").alias("t"))
           .groupBy("s").agg(F.collect_set("t").alias("x"), F.min("t.component").alias("low"), F.max("t.component").alias("high"))
           .where("low < high")
           .select(F.explode("x").alias("x"), F.col("x").alias("y")).select("x", F.explode("y").alias("y"))
           .where("x.id < y.id").where(near).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")))
    # hot ones only: (100 + threshold) * h - threshold * n bounds the other's threshold * n
    able = (rest.select("key", "rep", "n").distinct()
            .join(text.drop("prefix").withColumnRenamed("id", "rep").where(
                100 * F.col("h") >= threshold * F.col("n")), ["rep", "n"])
            .withColumn("reach", (100 + threshold) * F.col("h") - threshold * F.col("n")))
    able = stage(able, "rest-hot")
    least = able.groupBy("key").agg(F.min("n").alias("least"))
    able = able.join(least, "key").where(F.col("reach") >= threshold * F.col("least")).drop("least")
    several = able.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    able = stage(able.join(several.select("key"), "key", "left_semi"), "rest-hot")
    heads = able.groupBy("key", "hot0", "hot1").agg(F.min(F.struct("n", "rep", "reach", "component")).alias("y"))
    both = (able.alias("x").join(heads, "key").where(F.expr("x.rep <> y.rep") & near
            & F.expr(f"x.reach >= {threshold} * y.n AND y.reach >= {threshold} * x.n"))
            .select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")))
    return met.union(both).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): ``id, component`` with
    the smallest id reachable, for the ids that have an edge.

    Alternating large-star and small-star steps (both are a minimum per node and
    a join back), each on a written table, until a step changes nothing. Every edge
    becomes one edge, so repeated ones need no shuffle of their own.
    """
    now = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .where("a <> b"), "edges")
    mark = (now.count(), None)
    while True:
        before = mark
        # counted: up to 16 MB of minima travel to the tasks, instead of a shuffle of all edges
        hint = F.broadcast if before[0] <= 500_000 else lambda df: df
        # large star: every larger neighbour of a node moves to its smallest neighbour
        both = now.union(now.select("b", "a")).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = (both.join(hint(low), "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")))
        # small star: every smaller neighbour and the node itself do
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        now = stage(large.join(hint(low), "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
                                                      F.col("m").alias("b")), "edges")
        mark = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == before:
            break
    return (now.select(F.col("a").alias("id"), F.col("b").alias("component"))
            .union(now.select("b", "b")).distinct())


def _joined(label: DataFrame, links: DataFrame) -> DataFrame:
    """The components ``label`` (id, component) after ``links`` (a, b) between them, whose
    ends may be ids without one: only the components that they join are worked on."""
    known = small(label, 1_000_000)
    ends = links
    for end in ("a", "b"):
        ends = (ends.join(known.toDF(end, "c"), end, "left")
                .withColumn("c", F.coalesce("c", end)).drop(end).withColumnRenamed("c", end))
    ends = stage(ends.select("a", "b"), "joined")
    merged = stage(components(ends), "components")
    to = small(merged, 1_000_000).toDF("component", "to")
    kept = label.join(to, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
    new = merged.join(label.select("id"), "id", "left_anti")
    return stage(kept.union(new), "components")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    size: int = 5, threshold: int = 75, bands: int = BANDS,
                    rows: int = ROWS, hot: int = HOT) -> DataFrame:
    """Components of documents whose shingle sets are similar.

    Returns one row per row of ``docs``: ``id_col, n_shingles`` (size of its
    set), ``component_id`` (the smallest id reachable over links) and ``kept``
    (the row is its component's smallest id).
    """
    prepare(docs)
    docs = docs.select(F.col(id_col).cast("long").alias(id_col), text_col)
    sketch = stage(docs.mapInArrow(
        _sketch(id_col, text_col, size, bands, rows),
        "id long, n long, p1 long, p2 long, bands array<long>"), "sketches")
    same_set = ["n", "p1", "p2"]
    named = sketch.where("id IS NOT NULL AND n > 0")
    # only sets that several rows have; a written table, so that a skewed join can split its copies
    classes = stage(named.groupBy(*same_set).agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("m"))
                    .where("m > 1").drop("m"), "copies")
    member = (named.join(classes, same_set, "left").withColumn("rep", F.coalesce("rep", "id"))
              .select("id", "rep", "n", F.when(F.col("id") == F.col("rep"), F.col("bands")).alias("bands")))
    member = stage(member, "classes")
    reps = member.where("bands IS NOT NULL").dropDuplicates(["rep", "bands"])
    in_band = reps.select("rep", "n", F.explode("bands").alias("key"))
    shared = in_band.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    bucket = stage(in_band.join(shared, "key"), "buckets")  # rep, n, key, m
    # how many bucket mates a text has over all bands: the centre has most
    score = bucket.groupBy("rep").agg(F.sum("m").alias("score"))
    bucket = stage(bucket.join(score, "rep").select("key", "rep", "n", "score"), "buckets")
    # the centre: most bucket mates, then the smallest id
    best = F.max_by(F.struct("rep", "n"), F.struct("score", -F.col("rep")))
    near = (100 * F.least("n", "c.n") >= threshold * F.greatest("n", "c.n"))

    def pairs_with_centre(held: DataFrame, tested: DataFrame | None = None) -> DataFrame:
        pairs = (held.where(near & (F.col("rep") != F.col("c.rep")))
                 .select(F.least("rep", "c.rep").alias("a"), F.greatest("rep", "c.rep").alias("b")).distinct())
        if tested is not None:
            pairs = pairs.join(small(tested, 1_000_000), ["a", "b"], "left_anti")
        return stage(pairs, "pairs")

    def labelled(held: DataFrame, label: DataFrame, rep: str, component: str) -> DataFrame:
        known = small(label, 1_000_000).toDF("id", component)
        return (held.join(known, held[rep] == known["id"], "left")
                .withColumn(component, F.coalesce(component, rep)).drop("id"))

    bucket = stage(bucket.join(bucket.groupBy("key").agg(best.alias("c")), "key"), "buckets")
    first = pairs_with_centre(bucket)
    label = stage(components(confirmed(docs, first, id_col, text_col, size, threshold)), "components")
    # the best member outside the first centre's component meets the members outside its own
    bucket = bucket.select("key", "rep", "n", "score", F.col("c.rep").alias("c_rep"))
    held = labelled(labelled(bucket, label, "rep", "component"), label, "c_rep", "c_component")
    best = F.max_by(F.struct("rep", "n", "component"), F.struct("score", -F.col("rep")))
    centre = held.where("component <> c_component").groupBy("key").agg(best.alias("c"))
    bucket = stage(held.join(centre, "key").select("key", "rep", "n", "component", "c_rep", "c"), "buckets")
    second = pairs_with_centre(bucket.where("component <> c.component"), first)
    found = confirmed(docs, second, id_col, text_col, size, threshold)
    if not found.isEmpty():
        label = _joined(label, found)
    # both centres have met all; the others of a bucket not yet
    rest = labelled(bucket.where("rep <> c_rep AND rep <> c.rep").select("key", "rep", "n"), label, "rep", "component")
    several = rest.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    rest = stage(rest.join(several.select("key"), "key", "left_semi").select("key", "rep", "n", "component"), "rest")
    if not rest.isEmpty():
        pairs = _rest_pairs(docs, rest, id_col, text_col, size, threshold, hot)
        for tested in (first, second):
            pairs = pairs.join(small(tested, 1_000_000), ["a", "b"], "left_anti")
        found = confirmed(docs, stage(pairs, "pairs"), id_col, text_col, size, threshold)
        if not found.isEmpty():
            label = _joined(label, found)
    result = (member.select("id", "rep").distinct()
              .join(label.withColumnRenamed("id", "rep"), "rep", "left")
              .groupBy("id").agg(F.min(F.coalesce("component", "rep")).alias("component_id")))
    return (sketch.select("id", "n").join(result, "id", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.coalesce("component_id", "id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("component_id") == F.col(id_col), F.lit(True))))
