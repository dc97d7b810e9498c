"""Binned feature matrices and screening from histograms (M8, M9).

1. Cut points: every feature's different values with their row counts (counted in
   blocks of rows, column by column, then added up) get running totals in order (range
   partitions, no window over a whole feature); a value's bin is its place among the
   rows, in ``bins`` equal parts. Equal values share a bin; a feature has at most ``bins``.
2. The matrix: a row's features as one small integer each (0: missing), looked up in
   the cut points, which are bounded by features times bins.
3. Histograms: each task sums (feature, bin, part) over its rows in arrays of fixed
   size; their sum over the tasks has features times bins rows, however many rows the
   table has. All candidates are scored from it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .ordinal import running_total

#: Bins of a feature; a bin's number fits into a byte.
BINS = 32
#: Rows of a block whose values are counted together.
COUNT_ROWS = 1 << 16
#: Codes of a bundle, at most (a code has two bytes).
CODES = 1 << 12


def value_counts(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``feature`` (its number), ``value``, ``n``: rows of every value that is not missing."""
    ship_package(df.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, COUNT_ROWS):
            for k in range(len(features)):
                v = block.column(k).to_numpy()
                value, n = np.unique(v[~np.isnan(v)] + 0.0, return_counts=True)  # -0.0 is 0.0
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(value), k, np.int32)), pa.array(value), pa.array(n)],
                                                 ["feature", "value", "n"])

    rows = df.select(*[F.col(f"`{c}`").cast("double").alias(f"__{k}") for k, c in enumerate(features)])
    return (rows.mapInArrow(count, "feature int, value double, n long").groupBy("feature", "value")
            .agg(F.sum("n").alias("n")))


def blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The batches of a task put together to ``rows`` rows or a little more."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def cut_points(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """For each feature the smallest value of each of its bins, ascending."""
    if not 1 < bins <= 254:
        raise ValueError("a bin's number must fit into a byte")
    placed = running_total(value_counts(df, features), ["feature", "value"], "n", "before")
    size = placed.groupBy("feature").agg(F.min("before").alias("first"), F.sum("n").alias("total"))
    place = F.floor((F.col("before") - F.col("first")) * bins / F.col("total"))
    low = (placed.join(size, "feature").groupBy("feature", place.alias("bin")).agg(F.min("value").alias("low"))
           .orderBy("feature", "bin").collect())  # features * bins rows at most
    return [np.array([r["low"] for r in low if r["feature"] == k], float) for k in range(len(features))]


def bin_matrix(df: DataFrame, features: Sequence[str], cuts: Sequence[np.ndarray],
               keep: Sequence[str] = (), name: str = "bins") -> DataFrame:
    """The columns ``keep`` and ``name``: one byte for each feature, 0 if it is missing,
    else 1 + the number of its bin."""
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(list(cuts))
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            out = np.zeros((batch.num_rows, len(known)), np.uint8)
            for k, cut in enumerate(known):
                v = batch.column(len(keep) + k).to_numpy(zero_copy_only=False).astype(float)
                # a value below the first cut (not seen when the cuts were made) is in the first bin
                out[:, k] = np.where(np.isnan(v), 0, np.maximum(np.searchsorted(cut, v, "right"), 1))
            raw = pa.array([r.tobytes() for r in out], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(keep))), raw], [*keep, name])

    rows = df.select(*keep, *(F.col(f"`{c}`").cast("double").alias(f"__{k}") for k, c in enumerate(features)))
    return rows.mapInArrow(work, ", ".join(f"`{c}` {kinds[c]}" for c in keep) + (", " if keep else "") + f"`{name}` binary")


def bin_values(raw: pa.Array, width: int) -> np.ndarray:
    """The byte matrix of a column of ``bin_matrix``."""
    return np.frombuffer(b"".join(raw.to_pylist()), np.uint8).reshape(-1, width)


@dataclass
class Bundle:
    """Features of a block of rows as one column: a row's ``code`` is the column of
    ``table`` (features, codes) that holds its bins."""

    features: list[int]
    table: np.ndarray
    code: np.ndarray

    def joined(self, other: "Bundle") -> "Bundle | None":
        """Both as one bundle, if the pairs of codes that occur are ``CODES`` or fewer."""
        width = other.table.shape[1]
        pair = self.code.astype(np.int64) * width + other.code
        seen = np.flatnonzero(np.bincount(pair, minlength=1))
        if len(seen) > CODES:
            return None
        number = np.zeros(self.table.shape[1] * width, np.uint16)
        number[seen] = np.arange(len(seen))
        return Bundle(self.features + other.features,
                      np.concatenate((self.table[:, seen // width], other.table[:, seen % width])), number[pair])


def bundled(x: np.ndarray, width: int) -> list[Bundle]:
    """The columns of a block's bins ``x`` (features, rows), each less than ``width``, in
    few bundles: features that depend on each other share one, then small ones. Which
    feature is tried where is told by some of the rows; every row has its exact code."""
    out: list[Bundle] = []
    step = max(1, x.shape[1] // 8192)

    def dependence(b: Bundle, v: np.ndarray, own: int) -> float:
        """0: one tells the other, 1: every pair occurs."""
        code = b.code[::step].astype(np.int64)
        n, pairs = (np.count_nonzero(np.bincount(c, minlength=1)) for c in (code, code * width + v))
        least, most = max(n, own), n * own
        return (pairs - least) / (most - least) if most > least else float(own > 1)

    for k, v in enumerate(x):
        seen = np.flatnonzero(np.bincount(v, minlength=width))
        number = np.zeros(width, np.uint16)
        number[seen] = np.arange(len(seen))
        alone = Bundle([k], seen[None].astype(np.uint8), number[v])
        some = v[::step]
        own = np.count_nonzero(np.bincount(some, minlength=width))
        for share, i in sorted((dependence(b, some, own), i) for i, b in enumerate(out)):
            if share > 0.5:
                out.append(alone)
                break
            if both := out[i].joined(alone):
                out[i] = both
                break
        else:
            out.append(alone)
    out.sort(key=lambda b: -b.table.shape[1])
    while len(out) > 1 and out[-1].table.shape[1] * out[-2].table.shape[1] <= CODES:
        out[-2:] = [out[-2].joined(out[-1])]
        out.sort(key=lambda b: -b.table.shape[1])
    return out


def histograms(matrix: DataFrame, n_features: int, label: str, holdout: str, bins: int = BINS) -> DataFrame:
    """``feature, bin, nt, st, nh, s1, s2``: of the rows outside the hold-out the number
    and label sum, of those in it number, label sum and sum of squares."""
    ship_package(matrix.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((5, n_features, bins + 1))
        for batch in batches:
            x = bin_values(batch.column(0), n_features)
            y = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
            hold = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for j, w in enumerate((~hold, np.where(hold, 0, y), hold, np.where(hold, y, 0), np.where(hold, y * y, 0))):
                w = w.astype(float)
                for k in range(n_features):
                    total[j, k] += np.bincount(x[:, k], w, bins + 1)
        feature, b = np.divmod(np.arange(n_features * (bins + 1)), bins + 1)
        flat = total.reshape(5, -1)
        used = flat[0] + flat[2] > 0
        yield pa.RecordBatch.from_arrays([pa.array(feature[used].astype(np.int32)), pa.array(b[used].astype(np.int32)),
                                          *(pa.array(f[used]) for f in flat)],
                                         ["feature", "bin", "nt", "st", "nh", "s1", "s2"])

    rows = matrix.where(F.col(label).isNotNull()).select("bins", F.col(label).cast("double"), F.col(holdout))
    return (rows.mapInArrow(work, "feature int, bin int, nt double, st double, nh double, s1 double, s2 double")
            .groupBy("feature", "bin").agg(*[F.sum(c).alias(c) for c in ("nt", "st", "nh", "s1", "s2")]))


def screen(df: DataFrame, features: Sequence[str], label: str, holdout: Column, row_key: str,
           bins: int = BINS) -> DataFrame:
    """M8: every feature alone against the base score: ``feature, val, base, diff``.

    The base predicts the hold-out by the mean label of the other rows, a candidate by
    the mean of its bin (the base's, if the bin has no other rows); ``val`` and
    ``base`` are RMSE, ``diff = val - base``. Cut points come from all rows.
    """
    cuts = cut_points(df, features, bins)
    rows = df.select(row_key, *features, F.col(label).alias("__label"), holdout.alias("__hold"))
    h = histograms(bin_matrix(rows, features, cuts, ["__label", "__hold"]), len(features), "__label", "__hold", bins)
    # each feature's histogram has all rows: the base is in any of them
    g = h.groupBy("feature").agg(*[F.sum(c).alias(f"all_{c}") for c in ("nt", "st", "nh", "s1", "s2")])

    def error(m, n, s1, s2):
        return s2 - F.lit(2.0) * m * s1 + n * m * m

    mean = F.col("all_st") / F.col("all_nt")
    m = F.when(F.col("nt") > 0, F.col("st") / F.when(F.col("nt") > 0, F.col("nt"))).otherwise(mean)
    scored = (h.join(g, "feature").withColumn("e", error(m, F.col("nh"), F.col("s1"), F.col("s2")))
              .groupBy("feature").agg(F.sum("e").alias("e"), F.first(error(
                  mean, F.col("all_nh"), F.col("all_s1"), F.col("all_s2"))).alias("b"), F.first("all_nh").alias("n")))
    names = F.array(*[F.lit(f) for f in features])
    return scored.select(names[F.col("feature")].alias("feature"), F.sqrt(F.col("e") / F.col("n")).alias("val"),
                         F.sqrt(F.col("b") / F.col("n")).alias("base")).withColumn("diff", F.col("val") - F.col("base"))
