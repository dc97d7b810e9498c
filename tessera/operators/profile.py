"""Table profiling: value counts, shares, summaries, exact quantiles,
histograms, correlations, null audits, key overlaps and top-k.

Nothing here funnels a table through one task: quantiles are exact but
computed from distributed positions (``ordinal``), totals are one-number
aggregates, and top-k uses ``orderBy().limit()`` (per-partition top-k, then a
merge of k rows per partition).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordinal import running_total, with_position


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- counts and shares ------------------------------------------------------

def distinct_first_seen(df: DataFrame, column: str, order: str) -> DataFrame:
    """Distinct values of ``column`` with the first ``order`` value each was seen at."""
    return df.groupBy(column).agg(F.min(order).alias("first_seen"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Rows per value, most frequent first (value breaks ties). Nulls are a value."""
    return (df.groupBy(column).agg(F.count(F.lit(1)).alias(name))
            .orderBy(F.col(name).desc(), F.col(column).asc_nulls_first()))


def top_values(df: DataFrame, column: str, k: int, name: str = "n") -> DataFrame:
    """The ``k`` most frequent values (top-k is the feature, so the limit stays)."""
    return value_counts(df, column, name).limit(k)


def percent_share(df: DataFrame, column: str, name: str = "pct") -> DataFrame:
    """Share of rows per value in percent."""
    total = df.count()  # one number
    return (df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
            .withColumn(name, F.col("n") * F.lit(100.0) / F.lit(total)))


# -- summaries --------------------------------------------------------------

def grouped_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """Exact quantiles with linear interpolation (pandas / ``quantile_cont``)
    per key group, one column ``q_<p>`` per probability; a null key has none.

    Rows are counted by (key, value) first, combined map-side, so a value that a third
    of the rows have is one row; running totals over range partitions give each value
    the ranks it fills, and only the values at the ranks that quantiles need are kept.
    """
    keys = list(keys)
    base = df.where(F.col(value).isNotNull())
    if not keys:
        base = base.withColumn("__all", F.lit(0))
    by = keys or ["__all"]
    counts = base.groupBy(*by, value).agg(F.count(F.lit(1)).alias("__c"))
    placed = running_total(counts, [*by, value], "__c", "__before")
    sizes = placed.groupBy(*by).agg(F.min("__before").alias("__start"), F.sum("__c").alias("__n"))
    r = placed.join(sizes, by).withColumn("__lo", F.col("__before") - F.col("__start"))

    def holds(rank: Column) -> Column:
        return (F.col("__lo") <= rank) & (rank < F.col("__lo") + F.col("__c"))

    places = [(F.col("__n") - 1) * F.lit(float(p)) for p in probs]
    wanted = F.lit(False)
    for h in places:
        wanted = wanted | holds(F.floor(h)) | holds(F.ceil(h))
    aggs = []
    for p, h in zip(probs, places, strict=True):
        lo = F.max(F.when(holds(F.floor(h)), F.col(value)))
        hi = F.max(F.when(holds(F.ceil(h)), F.col(value)))
        aggs.append((lo + (hi - lo) * F.max(h - F.floor(h))).alias(quantile_name(p)))
    out = r.where(wanted).groupBy(*by).agg(*aggs)
    return out if keys else out.drop("__all")


def quantile_name(p: float) -> str:
    return "q_" + f"{p:g}".replace(".", "_")


def describe(df: DataFrame, column: str) -> DataFrame:
    """count, mean, std (n-1), min, 25 %, 50 %, 75 %, max of one column."""
    stats = df.agg(
        F.count(column).alias("count"), F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"), F.min(column).cast("double").alias("min"),
        F.max(column).cast("double").alias("max"),
    ).withColumn("__k", F.lit(0))
    q = grouped_quantiles(df, [], column, [0.25, 0.5, 0.75]).withColumn("__k", F.lit(0))
    return stats.join(q, "__k", "left").select(
        F.lit(column).alias("column_name"), "count", "mean", "std", "min",
        F.col("q_0_25").alias("p25"), F.col("q_0_5").alias("p50"),
        F.col("q_0_75").alias("p75"), "max")


def box_stats(df: DataFrame, by: str, value: str) -> DataFrame:
    """Five-number summary per group (box plot data)."""
    q = grouped_quantiles(df, [by], value, [0.0, 0.25, 0.5, 0.75, 1.0])
    return q.select(by, F.col("q_0").alias("min"), F.col("q_0_25").alias("q1"),
                    F.col("q_0_5").alias("median"), F.col("q_0_75").alias("q3"),
                    F.col("q_1").alias("max"))


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: name, Spark type, non-null count, row count."""
    counts = df.agg(F.count(F.lit(1)).alias("__rows"),
                    *[F.count(F.col(c)).alias(f"__nn{i}") for i, c in enumerate(df.columns)])
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    stack = ", ".join(f"'{c}', '{types[c]}', `__nn{i}`" for i, c in enumerate(df.columns))
    return counts.selectExpr(
        f"stack({len(df.columns)}, {stack}) AS (column_name, data_type, non_null)", "__rows"
    ).withColumnRenamed("__rows", "n_rows")


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count per column, one row per column."""
    cols = list(columns or df.columns)
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"__z{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', `__z{i}`" for i, c in enumerate(cols))
    return agg.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, n_null)")


def any_null_share(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (),
                   name: str = "pct_missing", with_count: str | None = None) -> DataFrame:
    """Percent of rows where any of ``columns`` is null (optionally per group)."""
    anynull = F.lit(False)
    for c in columns:
        anynull = anynull | F.col(c).isNull()
    aggs = [(F.avg(F.when(anynull, 1.0).otherwise(0.0)) * 100.0).alias(name)]
    if with_count:
        aggs.insert(0, F.count(F.lit(1)).alias(with_count))
    return df.groupBy(*by).agg(*aggs)


# -- histograms and correlation ------------------------------------------------

def _range(df: DataFrame, column: str) -> tuple[float, float]:
    row = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    return float(row["lo"]), float(row["hi"])


def bin_index(x: Column, lo: float, hi: float, bins: int) -> Column:
    """1-based equal-width bin of ``x`` on [lo, hi]; the last edge is closed."""
    if hi == lo:
        return F.when(x.isNotNull(), F.lit(1))
    raw = F.floor((x - F.lit(lo)) / F.lit(hi - lo) * F.lit(bins)) + 1
    return F.least(raw, F.lit(bins)).cast("int")


def histogram(df: DataFrame, column: str | Column, bins: int = 100,
              name: str = "value") -> DataFrame:
    """Equal-width histogram of a numeric expression: bin, lower, upper, count."""
    x = _c(column)
    vals = df.select(x.cast("double").alias(name)).where(F.col(name).isNotNull())
    lo, hi = _range(vals, name)
    width = (hi - lo) / bins if hi > lo else 0.0
    counted = vals.groupBy(bin_index(F.col(name), lo, hi, bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))
    return counted.select(
        "bin", (F.lit(lo) + (F.col("bin") - 1) * F.lit(width)).alias("lower"),
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("upper"), "n")


def joint_histogram(df: DataFrame, x: str, y: str, bins: int = 20) -> DataFrame:
    """Counts over a grid of equal-width bins of two numeric columns."""
    both = df.select(F.col(x).cast("double").alias(x), F.col(y).cast("double").alias(y)) \
        .where(F.col(x).isNotNull() & F.col(y).isNotNull())
    xl, xh = _range(both, x)
    yl, yh = _range(both, y)
    return both.groupBy(bin_index(F.col(x), xl, xh, bins).alias("x_bin"),
                        bin_index(F.col(y), yl, yh, bins).alias("y_bin")) \
        .agg(F.count(F.lit(1)).alias("n"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair (pairwise complete), long form; null where one
    side does not vary.

    One pass for any number of columns: a task sums the co-moments of all pairs over
    its rows as masked matrix products (rows where both are present, their sums,
    squares and products), Spark adds up one row per pair and task. Values are shifted
    by their column's mean, so that the sums don't swamp the differences.
    """
    cols, k = list(columns), len(columns)
    rows = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    shift = np.array([x or 0.0 for x in rows.agg(*[F.avg(c) for c in rows.columns]).first()])
    upper = np.triu_indices(k)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((6, k, k))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns], 1) - shift
            there = ~np.isnan(x)
            x, m = np.where(there, x, 0.0), there.astype(float)
            total[0] += m.T @ m
            total[1] += x.T @ m            # of the first column, where the second is present too
            total[2] += m.T @ x
            total[3] += (x * x).T @ m
            total[4] += m.T @ (x * x)
            total[5] += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(u.astype(np.int32)) for u in upper] + [pa.array(t[upper]) for t in total],
                                         ["a", "b", *_MOMENTS])

    # every pair has a row, also if no task has any
    pairs = df.sparkSession.range(k * k).select((F.col("id") / k).cast("int").alias("a"), (F.col("id") % k).cast("int").alias("b"),
                                                *[F.lit(0.0).alias(c) for c in _MOMENTS]).where("a <= b")
    sums = (rows.mapInArrow(moments, "a int, b int, " + ", ".join(f"{c} double" for c in _MOMENTS)).unionByName(pairs)
            .groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in _MOMENTS]))
    n, sx, sy, sxx, syy, sxy = map(F.col, _MOMENTS)
    vx, vy = n * sxx - sx * sx, n * syy - sy * sy
    varies = (vx > n * sxx * 1e-12) & (vy > n * syy * 1e-12)  # more than rounding leaves
    names = F.array(*[F.lit(c) for c in cols])
    return sums.select(names[F.col("a")].alias("col_a"), names[F.col("b")].alias("col_b"),
                       F.when(varies, (n * sxy - sx * sy) / F.sqrt(vx * vy)).alias("corr"))


_MOMENTS = ("n", "sx", "sy", "sxx", "syy", "sxy")


def length_profile(df: DataFrame, column: str, longer_than: int) -> DataFrame:
    """Rows whose text is longer than N, and the longest / shortest lengths."""
    n = F.length(column)
    return df.agg(F.count_if(n > longer_than).alias("n_longer"),
                  F.max(n).alias("max_len"), F.min(n).alias("min_len"))


def value_lengths(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Length of every distinct value: ``column_name, value, length``."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                      for c in columns])
    return (df.select(F.explode(cells).alias("c")).select("c.*").where("value IS NOT NULL").distinct()
            .withColumn("length", F.length("value")))


# -- overlaps, first / last, positions -------------------------------------------

def key_overlap(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Distinct keys only in left, only in right, and in both (Venn counts)."""
    lk = left.select(F.col(column).alias("k")).where("k IS NOT NULL").distinct().withColumn("l", F.lit(1))
    rk = right.select(F.col(column).alias("k")).where("k IS NOT NULL").distinct().withColumn("r", F.lit(1))
    j = lk.join(rk, "k", "full")
    return j.agg(
        F.count_if(F.col("l").isNotNull() & F.col("r").isNull()).alias("only_left"),
        F.count_if(F.col("l").isNull() & F.col("r").isNotNull()).alias("only_right"),
        F.count_if(F.col("l").isNotNull() & F.col("r").isNotNull()).alias("both"))


def first_last(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """First and last ``n`` rows in a total order, tagged ``head`` / ``tail``."""
    asc = [F.col(c).asc() for c in order]
    desc = [F.col(c).desc() for c in order]
    head = df.orderBy(*asc).limit(n).withColumn("part", F.lit("head"))
    tail = df.orderBy(*desc).limit(n).withColumn("part", F.lit("tail"))
    return head.unionByName(tail)


def value_positions(df: DataFrame, column: str, tiebreak: Sequence[str]) -> DataFrame:
    """Each non-null value against its 0-based position in sorted order."""
    vals = df.where(F.col(column).isNotNull()).select(column, *tiebreak)
    return with_position(vals, [column, *tiebreak], "position")
