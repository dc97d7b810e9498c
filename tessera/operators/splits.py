"""Reproducible splits and samples.

Membership is a function of the row key and a seed: the first 8 hex digits of
``md5('<seed>:<key>')`` compared with a threshold. It does not depend on the
partitioning (unlike ``randomSplit``), survives task retries, and the same
expression runs in DuckDB. Positional splits (last N, contiguous folds,
every k-th row) use distributed positions, never a one-task window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordinal import with_position

HEX_DIGITS = 8


def hash_hex(key: str | Column, seed: int | str) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.substring(F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string"))), 1, HEX_DIGITS)


def threshold_hex(fraction: float) -> str:
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be in [0, 1]")
    top = 16 ** HEX_DIGITS
    return format(min(int(round(fraction * top)), top - 1), f"0{HEX_DIGITS}x") \
        if fraction < 1.0 else "g" * HEX_DIGITS


def in_fraction(key: str | Column, seed: int | str, fraction: float) -> Column:
    """True for about ``fraction`` of the keys, the same keys on every run."""
    return hash_hex(key, seed) < F.lit(threshold_hex(fraction))


def hash_split(df: DataFrame, key: str, seed: int, fraction: float,
               name: str = "is_holdout") -> DataFrame:
    """Flag a seeded ``fraction`` of rows as hold-out."""
    return df.withColumn(name, in_fraction(key, seed, fraction))


def nested_split(df: DataFrame, key: str, seeds: tuple[int, int],
                 fractions: tuple[float, float], name: str = "part") -> DataFrame:
    """A local test slice, then a validation slice of the rest, with
    different seeds for the two draws."""
    first = in_fraction(key, seeds[0], fractions[0])
    second = in_fraction(key, seeds[1], fractions[1])
    return df.withColumn(name, F.when(first, F.lit("local_test"))
                         .when(second, F.lit("valid")).otherwise(F.lit("train")))


def hash_sample(df: DataFrame, key: str, seed: int, fraction: float) -> DataFrame:
    """Seeded sample of about ``fraction`` of the rows (sampling is the feature)."""
    return df.where(in_fraction(key, seed, fraction))


def last_n_split(df: DataFrame, order: Sequence[str], n: int, name: str = "is_valid") -> DataFrame:
    """The last ``n`` rows in ``order`` are validation."""
    total = df.count()  # one number
    placed = with_position(df, order, "__pos")
    return placed.withColumn(name, F.col("__pos") >= F.lit(total - n)).drop("__pos")


def time_split(df: DataFrame, column: str, cutoff: str, name: str = "part") -> DataFrame:
    """Rows up to the cut-off date are train, later rows test."""
    return df.withColumn(name, F.when(F.col(column) <= F.lit(cutoff).cast("date"), F.lit("train"))
                         .otherwise(F.lit("test")))


def contiguous_folds(df: DataFrame, order: Sequence[str], k: int, name: str = "fold") -> DataFrame:
    """``k`` contiguous folds in ``order`` (no shuffling, no stratification);
    fold sizes differ by at most one, larger folds first."""
    total = df.count()  # one number
    placed = with_position(df, order, "__pos")
    base, extra = divmod(total, k)
    # first `extra` folds hold base + 1 rows
    big = F.lit(extra * (base + 1))
    pos = F.col("__pos")
    fold = F.when(pos < big, F.floor(pos / F.lit(base + 1))) \
        .otherwise(F.lit(extra) + F.floor((pos - big) / F.lit(max(base, 1))))
    return placed.withColumn(name, fold.cast("int")).drop("__pos")


def systematic_sample(df: DataFrame, order: Sequence[str], n_target: int) -> DataFrame:
    """Every (N / n_target)-th row in ``order`` (a sampling operator)."""
    total = df.count()  # one number
    step = max(total // n_target, 1)
    placed = with_position(df, order, "__pos")
    return placed.where(F.col("__pos") % F.lit(step) == 0).drop("__pos")


def draw_seeds(pool: DataFrame, column: str, n: int, salt: int | str) -> DataFrame:
    """``n`` distinct values of ``column`` in a seeded random order."""
    vals = pool.select(F.col(column).alias("seed")).where("seed IS NOT NULL").distinct()
    return (vals.withColumn("__h", hash_hex("seed", salt))
            .orderBy("__h", "seed").limit(n).drop("__h"))


def stacked_cut(df: DataFrame, column: str, value: str) -> DataFrame:
    """The rows of one part of a stacked table."""
    return df.where(F.col(column) == value)


def hash_sql(key_sql: str, seed: int | str) -> str:
    """DuckDB form of ``hash_hex``."""
    return f"substr(md5(concat('{seed}:', CAST({key_sql} AS VARCHAR))), 1, {HEX_DIGITS})"
