"""Boosted regression trees with a leaf limit, grown best-first on histograms (M7).

Spark's trees are limited by depth. Here a tree is limited by its number of leaves (and
depth): the leaf whose best split gains most is split next. Everything a split needs is
the histogram of a leaf: per (feature, bin) the number of rows and the sum of residuals.
A pass over the binned matrix (``binned``) gives the histograms of many leaves, and of
several models, at once: each task places its rows in the trees so far and sums into
arrays of fixed size, Spark adds those up. Of two children only the one with fewer rows
is counted, the other is the parent less its sibling.

The passes read the matrix as blocks of rows (``_blocks``): features that depend on each
other are one column of codes (``binned.bundled``), which is counted once and then shared
out to its features; a row's prediction so far is held beside it, for each model, and
brought forward when a round's trees are grown.

To save passes the frontier is expanded ahead: growth is replayed with the gains known,
and one pass evaluates all children that the replay made. It is repeated until a replay
meets no leaf it does not know, so the tree is the one that strict best-first growth
gives; the passes of a tree are about its depth, not its leaves.

What comes to the driver is histograms: models * open leaves * features * bins numbers
at most, whatever the rows. Missing values (bin 0) have a branch of their own: every
split is tried with them on either side.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .binned import BINS, Bundle, bin_values, blocks, bundled

#: Rows of a block.
BLOCK_ROWS = 1 << 18


@dataclass(frozen=True)
class Split:
    """Rows of ``node`` with a bin of at most ``bin`` go left; missing ones too if ``missing_left``."""

    node: int
    feature: int
    bin: int
    missing_left: bool
    gain: float
    left: tuple[int, float, float]   # child's number, rows and sum of residuals
    right: tuple[int, float, float]


@dataclass
class Tree:
    splits: list[Split]
    values: dict[int, float]  # of the leaves

    def place(self, x: np.ndarray) -> np.ndarray:
        return placed(x, self.splits)

    def predict(self, x: np.ndarray) -> np.ndarray:
        table = np.zeros(max(self.values) + 1)
        for node, v in self.values.items():
            table[node] = v
        return table[self.place(x)]


@dataclass
class Model:
    """``start`` plus ``rate`` times the trees' values."""

    leaves: int
    depth: int
    start: float
    rate: float
    trees: list[Tree] = field(default_factory=list)
    allowed: tuple[int, ...] | None = None  # features that it may split (None: all)

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for t in self.trees:
            out += self.rate * t.predict(x)
        return out


def placed(x: np.ndarray, splits: Sequence[Split]) -> np.ndarray:
    """The node that each row ends in; parents come before their children."""
    node = np.zeros(len(x), np.int64)

    def left(s: Split, at: np.ndarray) -> np.ndarray:
        v = x[at, s.feature]
        return np.where(v == 0, s.missing_left, v <= s.bin)

    for k, at in _ends(len(x), splits, left).items():
        node[at] = k
    return node


def _ends(n: int, splits: Sequence[Split], left: Callable[[Split, np.ndarray], np.ndarray]) -> dict[int, np.ndarray]:
    """The rows of each end: a split reads the rows of its own node only."""
    ends = {0: np.arange(n)}
    for s in splits:
        at = ends.pop(s.node)
        go = left(s, at)
        ends[s.left[0]], ends[s.right[0]] = at[go], at[~go]
    return ends


def best_split(node: int, n: np.ndarray, s: np.ndarray, least: int, children: tuple[int, int],
               allowed: tuple[int, ...] | None = None) -> Split | None:
    """The split of a leaf with histogram ``n``, ``s`` (features, bins + 1) that lowers
    the squared error most; the lowest feature, then bin, wins ties. ``least``: rows
    that a child must have."""
    total_n, total_s = n[0].sum(), s[0].sum()
    if total_n < 2 * least:
        return None
    here = total_s * total_s / total_n
    best = None
    for missing_left in (False, True):
        # cut after each bin (after the last one: the missing ones, column 0, against the rest)
        ln, ls = np.cumsum(n[:, 1:], 1), np.cumsum(s[:, 1:], 1)
        if missing_left:
            ln, ls = ln + n[:, :1], ls + s[:, :1]
        rn, rs = total_n - ln, total_s - ls
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = ls * ls / ln + rs * rs / rn - here
        gain[(ln < least) | (rn < least)] = -np.inf
        if allowed is not None:
            gain[~np.isin(np.arange(len(gain)), allowed)] = -np.inf
        f, b = np.unravel_index(int(gain.argmax()), gain.shape)
        g = float(gain[f, b])
        if g > 1e-12 * max(1.0, abs(here)) and (best is None or g > best.gain):
            best = Split(node, int(f), int(b) + 1, missing_left, g, (children[0], float(ln[f, b]), float(ls[f, b])),
                         (children[1], float(rn[f, b]), float(rs[f, b])))
    return best


class _Growth:
    """One tree while it grows: histograms and best splits of the nodes known."""

    def __init__(self, model: Model, least: int):
        self.model, self.least = model, least
        self.hist: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.split: dict[int, Split | None] = {}
        self.depth, self.next = {0: 0}, 1
        self.splits: list[Split] = []
        self.wanted: list[int] = [0]      # nodes to count in the next pass
        self.twins: dict[int, tuple[int, int]] = {}  # counted child: (parent, its sibling)
        self.root = (0.0, 0.0)

    def known(self, node: int, n: np.ndarray, s: np.ndarray) -> None:
        self.hist[node] = n, s
        self.split[node] = (best_split(node, n, s, self.least, (self.next, self.next + 1), self.model.allowed)
                            if self.depth[node] < self.model.depth else None)
        if found := self.split[node]:
            self.depth[found.left[0]] = self.depth[found.right[0]] = self.depth[node] + 1
            self.next += 2

    def take(self, counted: dict[int, tuple[np.ndarray, np.ndarray]]) -> None:
        """Histograms of the wanted nodes; their siblings follow."""
        for node in self.wanted:
            n, s = counted[node]
            if node == 0:
                self.root = float(n[0].sum()), float(s[0].sum())
            self.known(node, n, s)
            if node in self.twins:
                parent, sibling = self.twins[node]
                pn, ps = self.hist[parent]
                self.known(sibling, pn - n, ps - s)
        self.replay()

    def replay(self) -> None:
        """Best-first growth with the splits known so far."""
        heap, self.splits, fresh = [], [], []

        def push(node: int) -> None:
            if s := self.split[node]:
                heapq.heappush(heap, (-s.gain, node))

        push(0)
        while heap and len(self.splits) + 1 < self.model.leaves:
            node = heapq.heappop(heap)[1]
            s = self.split[node]
            self.splits.append(s)
            if s.left[0] in self.split:
                push(s.left[0])
                push(s.right[0])
            elif len(self.splits) + 1 < self.model.leaves:  # the last split's children stay leaves
                fresh.append(s)
        self.wanted, self.twins = [], {}
        for s in fresh:
            small, large = sorted((s.left, s.right), key=lambda c: c[1])
            self.wanted.append(small[0])
            self.twins[small[0]] = s.node, large[0]

    def paths(self) -> list[Split]:
        """All splits above the wanted nodes, parents first."""
        above = {c[0]: s for s in self.split.values() if s for c in (s.left, s.right)}
        found: dict[int, Split] = {}
        for node in self.wanted:
            while node in above and above[node].node not in found:
                found[above[node].node] = above[node]
                node = above[node].node
        return [found[n] for n in sorted(found)]

    def tree(self) -> Tree:
        """Residual means as leaf values."""
        ends = {0: self.root}
        for s in self.splits:
            del ends[s.node]
            ends[s.left[0]], ends[s.right[0]] = s.left[1:], s.right[1:]
        return Tree(self.splits, {k: s / n if n else 0.0 for k, (n, s) in ends.items()})


_BLOCK = "layout binary, codes binary, label binary, predicted binary"


@dataclass
class _Block:
    """Rows of a task: the bundles of their bins, labels, and each model's predictions."""

    bundles: list[Bundle]
    label: np.ndarray
    predicted: np.ndarray

    def __post_init__(self):
        self.place = {f: (k, row) for k, b in enumerate(self.bundles) for row, f in enumerate(b.features)}

    def left(self, s: Split, at: np.ndarray) -> np.ndarray:
        k, row = self.place[s.feature]
        v = self.bundles[k].table[row]
        return np.where(v == 0, s.missing_left, v <= s.bin)[self.bundles[k].code[at]]

    def record(self) -> pa.RecordBatch:
        layout = pickle.dumps([(b.features, b.table) for b in self.bundles])
        codes = np.stack([b.code for b in self.bundles])
        return pa.RecordBatch.from_arrays([pa.array([raw], pa.binary()) for raw in (
            layout, codes.tobytes(), self.label.tobytes(), self.predicted.tobytes())], ["layout", "codes", "label", "predicted"])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    for batch in batches:
        for k in range(batch.num_rows):
            layout, codes, label, predicted = (batch.column(j)[k].as_py() for j in range(4))
            y = np.frombuffer(label)
            columns = np.frombuffer(codes, np.uint16).reshape(-1, len(y))
            parts = [Bundle(f, t, c) for (f, t), c in zip(pickle.loads(layout), columns, strict=True)]
            yield _Block(parts, y, np.frombuffer(predicted).reshape(-1, len(y)))


def _blocks(rows: DataFrame, n_rows: int, n_features: int, bins: int, models: Sequence[Model]) -> DataFrame:
    """``rows`` (``n_rows`` of bins and label) as blocks, with the models' first
    predictions. Two tasks a core if they have few blocks: a task adds its blocks up."""
    start = [m.start for m in models]
    tasks = max(2 * rows.sparkSession.sparkContext.defaultParallelism, -(-n_rows // (4 * BLOCK_ROWS)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, BLOCK_ROWS):
            x = np.concatenate([bin_values(c, n_features) for c in block.column(0).chunks])
            y = block.column(1).to_numpy().astype(float)
            yield _Block(bundled(np.ascontiguousarray(x.T), bins + 1), y, np.repeat(np.array(start)[:, None], len(y), 1)).record()

    return rows.coalesce(tasks).mapInArrow(work, _BLOCK)


def _advanced(matrix: DataFrame, models: Sequence[Model]) -> DataFrame:
    """The blocks with the predictions that the models' last trees make."""
    last = [(m.rate, m.trees[-1]) for m in models]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _read(batches):
            p = block.predicted.copy()
            for m, (rate, tree) in enumerate(last):
                for node, at in _ends(len(block.label), tree.splits, block.left).items():
                    p[m, at] += rate * tree.values[node]
            yield _Block(block.bundles, block.label, p).record()

    return matrix.mapInArrow(work, _BLOCK)


def _pass(matrix: DataFrame, n_features: int, bins: int, models: list[Model], growths: list[_Growth]):
    """Histograms of all wanted nodes: for each model node -> (n, s). A model's features
    are counted, and the first one, which tells a node's rows."""
    spark = matrix.sparkSession
    task = spark.sparkContext.broadcast([
        (None if m.allowed is None else {0, *m.allowed}, g.paths(), g.wanted) for m, g in zip(models, growths, strict=True)])
    width = bins + 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((len(w), 2, n_features * width)) for _, _, w in task.value]
        for block in _read(batches):
            for m, ((allowed, splits, wanted), total) in enumerate(zip(task.value, sums, strict=True)):
                if not wanted:
                    continue
                residual = block.label - block.predicted[m]
                parts = []
                for b in block.bundles:
                    used = [row for row, f in enumerate(b.features) if allowed is None or f in allowed]
                    if used:
                        # the cells (feature, bin) of each code
                        parts.append((b.code, b.table.shape[1], b.table[used] + np.array(b.features)[used, None] * width))
                ends = _ends(len(residual), splits, block.left)
                for k, node in enumerate(wanted):
                    at = ends[node]
                    if not len(at):
                        continue
                    r = residual[at]
                    for code, size, cells in parts:
                        c = code[at].astype(np.int64)
                        n = np.bincount(c, minlength=size)
                        used = np.flatnonzero(n)
                        cell = cells[:, used].ravel()
                        for j, v in enumerate((n, np.bincount(c, r, size))):
                            total[k, j] += np.bincount(cell, np.tile(v[used], len(cells)), n_features * width)
        for m, total in enumerate(sums):
            n, s = total[:, 0].ravel(), total[:, 1].ravel()
            used = np.flatnonzero(n)
            if len(used):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(used), m, np.int32)), pa.array(used), pa.array(n[used]), pa.array(s[used])],
                    ["model", "cell", "n", "s"])

    got = (matrix.mapInArrow(work, "model int, cell long, n double, s double").groupBy("model", "cell")
           .agg(F.sum("n").alias("n"), F.sum("s").alias("s")).toArrow())
    task.destroy()
    model, cell = got["model"].to_numpy(), got["cell"].to_numpy()
    out = []
    for m, g in enumerate(growths):
        flat = np.zeros((2, len(g.wanted) * n_features * width))
        mine = model == m
        flat[0, cell[mine]], flat[1, cell[mine]] = got["n"].to_numpy()[mine], got["s"].to_numpy()[mine]
        hist = flat.reshape(2, len(g.wanted), n_features, width)
        out.append({node: (hist[0, k], hist[1, k]) for k, node in enumerate(g.wanted)})
    return out


def fit(matrix: DataFrame, n_features: int, label: str, limits: Sequence[tuple[int, int]], rounds: int,
        rate: float = 0.1, least: int = 20, bins: int = BINS,
        allowed: Sequence[Sequence[int] | None] | None = None) -> list[Model]:
    """A boosted model for each (leaves, depth) of ``limits``, all grown in the same
    passes over ``matrix`` (``bins`` of ``binned.bin_matrix`` and the label). ``least``:
    rows of a leaf; ``allowed``: for each model the features that it may use."""
    ship_package(matrix.sparkSession)
    rows = matrix.where(F.col(label).isNotNull()).select("bins", F.col(label).cast("double"))
    start, n_rows = rows.agg(F.avg(label), F.count(label)).first()
    start = start or 0.0
    allowed = allowed or [None] * len(limits)
    models = [Model(leaves, depth, float(start), rate, [], None if a is None else tuple(a))
              for (leaves, depth), a in zip(limits, allowed, strict=True)]
    held = _blocks(rows, n_rows, n_features, bins, models).persist()
    for k in range(rounds):
        growths = [_Growth(m, least) for m in models]
        while any(g.wanted for g in growths):
            for g, counted in zip(growths, _pass(held, n_features, bins, models, growths), strict=True):
                if g.wanted:
                    g.take(counted)
        for m, g in zip(models, growths, strict=True):
            m.trees.append(g.tree())
        if k + 1 < rounds:
            before, held = held, _advanced(held, models).persist()
            held.count()
            before.unpersist()
    held.unpersist()
    return models


def root_gains(matrix: DataFrame, features: Sequence[str], label: str, least: int = 20,
               bins: int = BINS) -> DataFrame:
    """``feature, gain``: of each feature that can be cut, the largest drop of the
    squared error by one cut of all rows."""
    ship_package(matrix.sparkSession)
    rows = matrix.where(F.col(label).isNotNull()).select("bins", F.col(label).cast("double"))
    start, n_rows = rows.agg(F.avg(label), F.count(label)).first()
    model = Model(2, 1, float(start or 0.0), 1.0)
    n, s = _pass(_blocks(rows, n_rows, len(features), bins, [model]), len(features), bins, [model], [_Growth(model, least)])[0][0]
    found = [(f, best_split(0, n[k:k + 1], s[k:k + 1], least, (1, 2))) for k, f in enumerate(features)]
    return matrix.sparkSession.createDataFrame([(f, x.gain) for f, x in found if x], "feature string, gain double")


def predict(matrix: DataFrame, models: Sequence[Model], n_features: int, keep: Sequence[str]) -> DataFrame:
    """The columns ``keep`` and the models' predictions as an array."""
    ship_package(matrix.sparkSession)
    kinds = {f.name: f.dataType.simpleString() for f in matrix.schema}
    shared = matrix.sparkSession.sparkContext.broadcast(list(models))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = bin_values(batch.column(0), n_features)
            p = np.stack([m.predict(x) for m in shared.value], 1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * p.shape[1], pa.int32()), pa.array(p.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(1 + k) for k in range(len(keep))), lists], [*keep, "predictions"])

    schema = "".join(f"`{c}` {kinds[c]}, " for c in keep) + "predictions array<double>"
    return matrix.select("bins", *keep).mapInArrow(work, schema)


def report(matrix: DataFrame, models: Sequence[Model], n_features: int, label: str, holdout: str,
           numbered: bool = False) -> DataFrame:
    """One row for each model: its limits, rounds, the most leaves and levels of its
    trees, and the RMSE on both parts (``numbered``: and its place in ``models``)."""
    p = predict(matrix.where(F.col(label).isNotNull()), models, n_features, [label, holdout])
    errors = (p.select(label, holdout, F.posexplode("predictions").alias("model", "p"))
              .withColumn("e", (F.col("p") - F.col(label)) ** 2).groupBy("model")
              .agg(F.sqrt(F.avg(F.when(~F.col(holdout), F.col("e")))).alias("train"),
                   F.sqrt(F.avg(F.when(F.col(holdout), F.col("e")))).alias("val")))
    facts = matrix.sparkSession.createDataFrame(
        [(k, m.leaves, m.depth, len(m.trees), max(len(t.values) for t in m.trees), max(_levels(t) for t in m.trees))
         for k, m in enumerate(models)],
        "model int, num_leaves int, max_depth int, num_round int, leaves int, levels int")
    out = facts.join(errors, "model")
    return out if numbered else out.drop("model")


def gains(model: Model, names: Sequence[str]) -> dict[str, float]:
    """Total gain of each feature's splits, most first (name breaks ties)."""
    out: dict[str, float] = {}
    for t in model.trees:
        for s in t.splits:
            out[names[s.feature]] = out.get(names[s.feature], 0.0) + s.gain
    return dict(sorted(out.items(), key=lambda x: (-x[1], x[0])))


def _levels(tree: Tree) -> int:
    depth = {0: 0}
    for s in tree.splits:
        depth[s.left[0]] = depth[s.right[0]] = depth[s.node] + 1
    return max(depth.values())
