"""Score distributions, colour statistics, file audits and batch scoring
(R1-R6, W2, W3, J9, M14).

Fixed-length distributions are ``array<double>`` columns handled with
higher-order array functions on the row (no explode, no shuffle). Colour
statistics are a count per (image, half, colour) aggregation; the top-25
cut ranks colours inside one image half, a group bounded by the image's own
pixel count.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

N_BINS = 10
TOP_COLOURS = 25  # fixed value: colours kept per image half
DARK_MAX = 20     # fixed value: all channels at or below -> dark
LIGHT_MIN = 240   # fixed value: all channels at or above -> light


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise(counts: str | Column) -> Column:
    """Divide each bin by the sum of the bins."""
    a = _c(counts)
    total = F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return F.transform(a, lambda x: x.cast("double") / total)


def mean_score(dist: str | Column) -> Column:
    """R2: sum of p_i * i over bins i = 1..N."""
    a = _c(dist)
    return F.aggregate(F.transform(a, lambda p, i: p * (i + 1)), F.lit(0.0), lambda acc, x: acc + x)


def std_score(dist: str | Column) -> Column:
    """sqrt(sum of p_i * (i - mean)^2)."""
    a = _c(dist)
    m = mean_score(a)
    sq = F.transform(a, lambda p, i: p * ((i + 1) - m) * ((i + 1) - m))
    return F.sqrt(F.aggregate(sq, F.lit(0.0), lambda acc, x: acc + x))


def cdf(dist: str | Column) -> Column:
    """Cumulative sums along the bin axis."""
    a = _c(dist)
    return F.transform(a, lambda _p, i: F.aggregate(F.slice(a, 1, i + 1), F.lit(0.0),
                                                      lambda acc, x: acc + x))


def emd(dist_a: str | Column, dist_b: str | Column) -> Column:
    """R4 per row: root mean square of the gap between the two cdfs."""
    gaps = F.zip_with(cdf(dist_a), cdf(dist_b), lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda acc, x: acc + x) / F.size(gaps))


def emd_loss(df: DataFrame, dist_a: str, dist_b: str) -> DataFrame:
    """The mean of the per-row distances (one row)."""
    return df.agg(F.avg(emd(dist_a, dist_b)).alias("emd"))


def colour_stats(pixels: DataFrame, image: str = "image_id", half: str = "half",
                 digits: int | None = 2) -> DataFrame:
    """Per image, the mean over its two halves of the percent of
    light and dark pixels among the 25 most frequent colours of each half.
    An image without both halves gets nulls (the reference returns None)."""
    counts = pixels.groupBy(image, half, "r", "g", "b").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy(image, half)
                               .orderBy(F.col("n").desc(), "r", "g", "b"))
    top = counts.withColumn("__rank", rank).where(F.col("__rank") <= TOP_COLOURS)
    dark = (F.col("r") <= DARK_MAX) & (F.col("g") <= DARK_MAX) & (F.col("b") <= DARK_MAX)
    light = (F.col("r") >= LIGHT_MIN) & (F.col("g") >= LIGHT_MIN) & (F.col("b") >= LIGHT_MIN)
    per_half = top.groupBy(image, half).agg(
        (F.sum(F.when(light, F.col("n")).otherwise(0)) * 100.0 / F.sum("n")).alias("light"),
        (F.sum(F.when(dark, F.col("n")).otherwise(0)) * 100.0 / F.sum("n")).alias("dark"))
    if digits is not None:
        per_half = per_half.select(image, half, F.bround("light", digits).alias("light"),
                                   F.bround("dark", digits).alias("dark"))
    both = F.count(F.lit(1)) == 2
    return per_half.groupBy(image).agg(
        F.when(both, F.avg("light")).alias("light_percent"),
        F.when(both, F.avg("dark")).alias("dark_percent"))


def list_files(spark, path: str, glob: str | None = None) -> DataFrame:
    """Recursive binary listing (path, length, modificationTime, content)."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def signature_audit(files: DataFrame, magic: bytes, trailer: bytes | None = None) -> DataFrame:
    """Files that fail a cheap decode check: the leading bytes are not the
    format's signature, or (with ``trailer``) the file is cut short before its
    closing marker. Returns the failing files."""
    head = F.substring(F.col("content"), 1, len(magic))
    ok = F.hex(head) == F.lit(magic.hex().upper())
    if trailer is not None:
        text = F.regexp_replace(F.col("content").cast("string"), r"\s+$", "")
        ok = ok & text.endswith(trailer.decode("utf-8"))
    return files.select("path", "length", ok.alias("readable")).where(~F.col("readable"))


def present(rows: DataFrame, listing: DataFrame, key: str) -> DataFrame:
    """Rows whose file exists (semi join with the listing)."""
    return rows.join(listing.select(key).distinct(), key, "left_semi")


def batch_score(df: DataFrame, key: str, features: str,
                make_model: Callable[[], Callable[[np.ndarray], np.ndarray]],
                n_bins: int = N_BINS) -> DataFrame:
    """Score rows with a model built once per task; the model maps a
    (rows x features) matrix to (rows x n_bins) distributions; the output is
    ``key, mean, std`` of each distribution. Arrow batches replace the
    reference's flush every 1000 rows; the task commit makes output atomic."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make_model()
        bins = np.arange(1, n_bins + 1, dtype=np.float64)
        for pdf in batches:
            x = np.stack([np.asarray(v, dtype=np.float64) for v in pdf[features]]) \
                if len(pdf) else np.zeros((0, 1))
            p = model(x) if len(pdf) else np.zeros((0, n_bins))
            mean = (p * bins).sum(axis=1)
            std = np.sqrt((((bins[None, :] - mean[:, None]) ** 2) * p).sum(axis=1))
            yield pd.DataFrame({key: pdf[key].values, "mean": mean, "std": std})

    return df.select(key, features).mapInPandas(run, f"{key} long, mean double, std double")


def linear_softmax_head(n_features: int, n_bins: int = N_BINS):
    """A fixed linear head with softmax (stand-in for a loaded network):
    weight[k][j] = (((k + 1) * (j + 3)) % 7 - 3) / 10."""
    def make():
        k = np.arange(n_bins)[:, None]
        j = np.arange(n_features)[None, :]
        w = ((((k + 1) * (j + 3)) % 7) - 3) / 10.0

        def model(x: np.ndarray) -> np.ndarray:
            logits = x @ w.T
            logits -= logits.max(axis=1, keepdims=True)
            e = np.exp(logits)
            return e / e.sum(axis=1, keepdims=True)
        return model
    return make
