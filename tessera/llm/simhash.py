"""SimHash near-dedup: 64-bit fingerprints linked by a binary trie self-join.

1. Each text's 3-word shingles are hashed (XXH64, seed 42); a fingerprint bit is
   set if more than half of the hashes have it. Equal fingerprints become one
   node (an aggregation), so copies are never paired.
2. The fingerprints are the leaves of a binary trie. The self-join walks pairs of
   its nodes together from the top: a pair (u, v) carries the number of bits in
   which the two paths differ, and is dropped as soon as that exceeds the error
   budget. A node with one leaf is a whole path: two such are compared at once.
3. Pairs of leaves within the budget are links; components are alternating stars.

The walk runs on Spark, ``STEP`` bits a round: nodes are rows (a prefix of the
fingerprint), a round joins the frontier of node pairs twice with the table of
nodes and their children. A node has at most ``2 ** STEP`` children, however many
leaves lie under it, so no group of alike fingerprints is a hot key.

A plain walk would open most pairs of the upper nodes, where a budget of two bits
prunes nothing. With at most two differing bits one third of the fingerprint is
equal in both, so the trie is walked in three orders of the thirds, each with a
budget for its depth (``SEARCHES``): no error in the first third, and so on. The
three together meet every pair within two bits:

    errors in (A, B, C)              met by the order
    A none                           A B C (0, 2, 2)
    C none, at most one in B         C B A (0, 1, 2)
    B none, one in C                 B C A (0, 1, 2)

A fingerprint has at most 2080 others within two bits, so links grow with the
number of different fingerprints, not with its square.

Defined results: the fingerprint of a text without words (null, empty, blank) is
zero and is linked like any other; a text of fewer than three words has its whole
sequence as its only shingle. Every row is judged by its own text: rows that share
a doc_id may be in different components. A null doc_id names nothing:
``component_id`` is the smallest doc_id reachable, null if only rows without one
are. Extra columns are ignored. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .near_dedup import components
from .staging import discard, prepare, stage
from .words import as_bytes, blocks, inside_text, split_words

#: Bytes of text in one numpy pass.
BLOCK = 2 << 20
#: Shingle hashes whose bits are counted in one pass.
CHUNK = 1 << 18
#: For each byte its bits, bit i as the number in byte i of a 64-bit word.
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view("<u8").ravel()
#: Bits by which a round of the walk goes down.
STEP = 6
#: Thirds of a fingerprint, as (shift, bits) from its low end.
A, B, C = (43, 21), (22, 21), (0, 22)
#: Orders of the thirds, and the budget at the depth reached: pairs of (depth, errors).
SEARCHES = (
    ((A, B, C), ((21, 0), (64, 2))),
    ((C, B, A), ((22, 0), (43, 1), (64, 2))),
    ((B, C, A), ((21, 0), (43, 1), (64, 2))),
)
#: Depth at which the walk begins: no search allows an error above it.
TOP = 21


def fingerprints(texts, size: int = 3, seed: int = 42) -> np.ndarray:
    """64-bit SimHash of each text (None or without words: zero)."""
    words = split_words(texts, lower=True)
    n_texts = len(words.first) - 1
    joined, at = words.joined()
    owner, per_text = words.text_of(), np.diff(words.first)
    first = np.flatnonzero(inside_text(words, size))
    last = first + size
    short = np.flatnonzero((per_text > 0) & (per_text < size))
    first = np.concatenate((first, words.first[short]))
    last = np.concatenate((last, words.first[short + 1]))
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], seed) for a, b in zip(at[first].tolist(), (at[last] - 1).tolist(), strict=True)),
                    np.uint64, len(first))
    owner = owner[first]
    ones = np.zeros((n_texts, 64), np.int64)
    new = np.ones(len(owner), bool)
    new[1:] = owner[1:] != owner[:-1]
    for k in range(0, len(h), CHUNK):
        # sums of at most 255 hashes of one text: 64 counters of a byte each
        begin = new[k:k + CHUNK].copy()
        begin[::255] = True
        begin = np.flatnonzero(begin)
        lanes = _LANES[h[k:k + CHUNK].view(np.uint8).reshape(-1, 8)]
        np.add.at(ones, owner[k + begin], np.add.reduceat(lanes, begin, axis=0).view(np.uint8))
    total = np.bincount(owner, minlength=n_texts)
    over = 2 * ones > total[:, None]
    return np.packbits(over, axis=1, bitorder="little").view("<u8").ravel()


def _fingerprint(id_col: str, text_col: str, size: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text_col, BLOCK):
            got = fingerprints(as_bytes(block[text_col]), size)
            yield from pa.table({"id": block[id_col], "fp": pa.array(got.view(np.int64))}).to_batches()

    return work


def _reordered(fp: Column, parts) -> Column:
    """The fingerprint with its thirds in the order ``parts``, first one on top."""
    out, left = F.lit(0).cast("long"), 64
    for shift, bits in parts:
        left -= bits
        piece = F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << bits) - 1))
        out = out.bitwiseOR(F.shiftleft(piece, left))
    return out


def _budget(depth: int) -> Column:
    """Errors that the row's search allows in the first ``depth`` bits."""
    out = F.when(F.lit(False), 0)
    for k, (_, stops) in enumerate(SEARCHES):
        out = out.when(F.col("search") == k, next(errors for stop, errors in stops if depth <= stop))
    return out


def _children(leaves: DataFrame, depth: int, below: int) -> DataFrame:
    """``search, node, kids``: the nodes at ``depth`` and for each its children at
    ``below``: (label, number of leaves, the smallest leaf's key)."""
    kids = (leaves.groupBy("search", F.shiftrightunsigned("key", 64 - below).alias("kid"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("key")))
    node = F.shiftrightunsigned("kid", below - depth)
    label = F.col("kid").bitwiseAND(F.lit((1 << (below - depth)) - 1)).cast("int")
    return kids.groupBy("search", node.alias("node")).agg(
        F.collect_list(F.struct(label.alias("label"), "n", "key")).alias("kids"))


def _descend(frontier: DataFrame, leaves: DataFrame, depth: int, below: int) -> DataFrame:
    """The frontier's pairs of children at ``below`` that are within the budget:
    ``search, a, b, errors`` and for both sides the number of leaves and a key."""
    kids = _children(leaves, depth, below)
    both = (frontier.join(kids.withColumnsRenamed({"node": "a", "kids": "x"}), ["search", "a"])
            .join(kids.withColumnsRenamed({"node": "b", "kids": "y"}), ["search", "b"]))
    bits = below - depth
    # a node met with itself gives each pair of children once; a child with itself only if it has two leaves
    pairs = F.expr(f"""inline(flatten(transform(x, p -> transform(
        filter(y, q -> errors + bit_count(p.label ^ q.label) <= budget
                       AND (a <> b OR p.label < q.label OR (p.label = q.label AND p.n > 1))),
        q -> named_struct('a', a << {bits} | p.label, 'b', b << {bits} | q.label,
                          'errors', errors + cast(bit_count(p.label ^ q.label) AS int),
                          'na', p.n, 'nb', q.n, 'ka', p.key, 'kb', q.key)))))""")
    return both.withColumn("budget", _budget(below)).select("search", pairs)


def linked(nodes: DataFrame, errors: int = 2) -> DataFrame:
    """Pairs (a, b) of the different 64-bit values ``fp`` of ``nodes`` that differ in
    ``errors`` bits or fewer (at most two), each once."""
    if not 0 < errors <= 2:
        raise ValueError("the searches are made for one or two errors")
    leaves = stage(nodes.select(F.explode(F.array(*(
        F.struct(F.lit(k).alias("search"), _reordered(F.col("fp"), parts).alias("key"))
        for k, (parts, _) in enumerate(SEARCHES)))).alias("e")).select("e.*"), "leaves")
    top = F.shiftrightunsigned("key", 64 - TOP)
    frontier = stage(leaves.groupBy("search", top.alias("a")).agg(F.count(F.lit(1)).alias("n"))
                     .where("n > 1").select("search", "a", F.col("a").alias("b"), F.lit(0).alias("errors")), "frontier")
    depth, found = TOP, None
    while depth < 64 and not frontier.isEmpty():
        live = frontier.select("search", F.explode(F.array("a", "b")).alias("node")).distinct()
        here = F.shiftrightunsigned(leaves["key"], 64 - depth)
        rest = stage(leaves.join(live, (leaves["search"] == live["search"]) & (here == live["node"]), "left_semi"), "leaves")
        discard(leaves)
        leaves = rest
        below = depth + ((64 - depth) % STEP or STEP)
        pairs = stage(_descend(frontier, leaves, depth, below), "pairs")
        alone = F.expr("na = 1 AND nb = 1")
        links = pairs.where(alone).where(F.bit_count(F.col("ka").bitwiseXOR(F.col("kb"))) <= errors).select("search", "ka", "kb")
        found = links if found is None else found.union(links)
        frontier = pairs.where(~alone).select("search", "a", "b", "errors")
        depth = below
    if found is None:
        return nodes.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("false")
    sides = []
    for side in ("ka", "kb"):
        back = F.when(F.lit(False), F.lit(None).cast("long"))
        for k, (parts, _) in enumerate(SEARCHES):
            back = back.when(F.col("search") == k, _restored(F.col(side), parts))
        sides.append(back)
    return found.select(F.least(*sides).alias("a"), F.greatest(*sides).alias("b")).distinct()


def _restored(key: Column, parts) -> Column:
    """The fingerprint of a key made by ``_reordered``."""
    out, left = F.lit(0).cast("long"), 64
    for shift, bits in parts:
        left -= bits
        piece = F.shiftrightunsigned(key, left).bitwiseAND(F.lit((1 << bits) - 1))
        out = out.bitwiseOR(F.shiftleft(piece, shift))
    return out


def simhash_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       size: int = 3, errors: int = 2) -> DataFrame:
    """Components of documents whose fingerprints differ in ``errors`` bits or fewer.

    Returns one row per row of ``docs``: ``id_col, fingerprint`` (16 hex digits)
    and ``component_id`` (the smallest id reachable over links).
    """
    prepare(docs)
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    prints = stage(docs.mapInArrow(_fingerprint("id", "text", size), "id long, fp long"), "fingerprints")
    nodes = stage(prints.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    label = stage(components(linked(nodes.select("fp"), errors)), "components")
    # the smallest id of each component, then of each fingerprint
    named = nodes.join(label, nodes["fp"] == label["id"], "left").select(
        "fp", F.coalesce("component", "fp").alias("component"), "least")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of = stage(named.join(least, "component").select("fp", "component_id"), "classes")
    return prints.join(of, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
