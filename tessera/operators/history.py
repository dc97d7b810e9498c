"""User-history features: union, keep-first de-duplication, period
aggregation and the two joins that carry item figures to users and back.

Physical shape of ``user_history`` (see ``explain``): the de-duplication and
the per-item period sums are both hash-partitioned on ``item_id``, so the
owner join between them adds no exchange; both per-user aggregates are
partial-then-final on ``user_id`` (a hot user is combined map-side), and the
final user join reuses that partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SOURCE_RANK = "source_rank"


def union_all(tables: Sequence[DataFrame], rank_col: str | None = SOURCE_RANK) -> DataFrame:
    """Append tables by column name (missing columns become null); with
    ``rank_col`` each row records the position of its table in ``tables``."""
    out = None
    for i, t in enumerate(tables):
        if rank_col:
            t = t.withColumn(rank_col, F.lit(i))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    if out is None:
        raise ValueError("union_all needs at least one table")
    return out


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str],
               columns: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the first by ``order`` (ties broken by the remaining
    columns). An aggregation, not a window: a hot key is reduced map-side."""
    keys = list(keys)
    rest = [c for c in (columns or df.columns) if c not in keys]
    packed = F.min(F.struct(*[F.col(c) for c in order],
                            *[F.col(c).alias(f"v__{c}") for c in rest if c not in order]))
    firsts = df.groupBy(*keys).agg(packed.alias("__first"))
    return firsts.select(*keys, *[
        F.col(f"__first.{c}") if c in order else F.col(f"__first.v__{c}").alias(c)
        for c in rest
    ])


def days_between(start: str | Column, end: str | Column) -> Column:
    """Whole days from ``start`` to ``end``; dates use ``datediff``, timestamps
    are floored (a negative half day is -1), like a pandas timedelta."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return F.floor((F.unix_micros(e.cast("timestamp")) - F.unix_micros(s.cast("timestamp")))
                   / F.lit(86400 * 1000 * 1000)).cast("long")


def period_days(periods: DataFrame) -> DataFrame:
    """``days_up`` = days between ``date_from`` and ``date_to`` of each period."""
    return periods.withColumn("days_up", F.datediff("date_to", "date_from"))


def item_period_stats(periods_with_days: DataFrame) -> DataFrame:
    """Per item: total days up and number of periods (non-null day counts)."""
    return periods_with_days.groupBy("item_id").agg(
        F.sum("days_up").cast("long").alias("days_up_sum"),
        F.count("days_up").alias("times_put_up"),
    )


def attach_owner(item_stats: DataFrame, owners: DataFrame) -> DataFrame:
    """Left join of item figures to the de-duplicated samples (owner lookup)."""
    return item_stats.join(owners.select("item_id", "user_id"), "item_id", "left")


def user_period_means(items_with_owner: DataFrame) -> DataFrame:
    """Per user: mean of the per-item figures; items without an owner drop out."""
    return (items_with_owner.where(F.col("user_id").isNotNull())
            .groupBy("user_id").agg(
                F.avg("days_up_sum").alias("avg_days_up_user"),
                F.avg("times_put_up").alias("avg_times_up_user")))


def user_item_counts(owners: DataFrame) -> DataFrame:
    """Items per user over all de-duplicated samples."""
    return (owners.where(F.col("user_id").isNotNull())
            .groupBy("user_id").agg(F.count("item_id").alias("n_user_items")))


def user_history(sample_tables: Sequence[DataFrame], period_tables: Sequence[DataFrame]) -> DataFrame:
    """``user_id, avg_days_up_user, avg_times_up_user, n_user_items``.

    Samples are concatenated in the given order and de-duplicated on
    ``item_id`` keeping the first; periods are concatenated, summed per item,
    given an owner, averaged per user, and the per-user item count is added.
    """
    samples = union_all([t.select("item_id", "user_id") for t in sample_tables])
    owners = keep_first(samples, ["item_id"], [SOURCE_RANK], ["user_id"])
    days = period_days(union_all([p.select("item_id", "date_from", "date_to")
                                  for p in period_tables], rank_col=None))
    per_item = item_period_stats(days)
    per_user = user_period_means(attach_owner(per_item, owners))
    return per_user.join(user_item_counts(owners), "user_id", "left")


def attach_user_features(ads: DataFrame, user_features: DataFrame) -> DataFrame:
    """Left join of per-user features onto every ad row."""
    return ads.join(user_features, "user_id", "left")
