"""Mixing sources to target weights.

Every document gets a hash-random key; documents are range-sorted by (source,
key), so a large source spans many tasks; running sums of sizes inside each range
partition plus the totals of the partitions before it give each document's place
in its source; the source's budget cuts there exactly. A budget over the source's
size takes whole epochs first, then cuts the next one.

Targets: sources share ``total`` (all sizes, unless given) by weight; a target
stops at ``max_epochs`` times its source's size and the excess is shared again by
weight among the others, until none is above.

Defined results: a null or empty text has size 0 and nothing is taken of it; the
null source is a source (the last one); ties of the key are broken by id and
size, rows equal in all three are interchangeable; the document at the cut gives
only the words up to it. Sizes and hashes depend on the row alone, so reruns
agree. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordinal import with_position
from .staging import shuffle_tasks, stage


def n_words(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+`` (null text: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def random_key(id_col: Column, seed: int) -> Column:
    """A hash-random key of the id, the same in every run and engine."""
    return F.md5(F.concat(F.coalesce(id_col.cast("string"), F.lit("")), F.lit(f"#{seed}")))


def targets(sizes: DataFrame, weights: Sequence[float], max_epochs: int,
            total: int | None = None) -> DataFrame:
    """Target of every source. ``sizes``: ``source, source_size`` (one row each).

    Sources take ``weights`` in turn, by code point, null last. All sources below
    their limit get ``level * weight``; the level is raised until the targets use
    up the total or every source is at its limit.
    """
    placed = stage(with_position(sizes.withColumn("none", F.col("source").isNull()),
                                 ["none", "source"], "position"), "sources")
    placed = (placed.withColumn("weight", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.col("position") % len(weights) + 1).cast("int")))
        .withColumn("most", F.col("source_size") * max_epochs))
    if total is None:
        total = sizes.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, full = -1.0, F.lit(False)
    while True:
        left, weight = placed.agg(
            F.lit(total) - F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0)),
            F.sum(F.when(~full, F.col("weight")))).first()
        if not weight or float(left) / weight <= level:
            break
        level = float(left) / weight
        full = F.col("most") <= F.col("weight") * level
    target = F.when(full, F.col("most").cast("double")).otherwise(F.col("weight") * F.lit(max(level, 0.0)))
    return placed.select("source", "source_size", target.alias("target"))


def mix_sources(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), max_epochs: int = 3,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                seed: int = 7, total: int | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """The words that a mix by ``weights`` takes of each document.

    Returns ``id_col, size, source_size, target, taken`` and the columns ``keep``
    of the document; ``taken`` counts repeats of the document.
    """
    tasks = shuffle_tasks(docs)
    sized = stage(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), *[F.col(c).alias(f"keep_{c}") for c in keep],
        n_words(F.col(text_col)).alias("size"), random_key(F.col(id_col), seed).alias("key")), "sizes")
    order = ["source", "key", "id", "size"]
    ranged = stage(sized.repartitionByRange(tasks, *order)
                   .withColumn("part", F.spark_partition_id()), "ranges")
    # what each range partition holds of a source, and what came before it
    held = ranged.groupBy("source", "part").agg(F.sum("size").alias("held"))
    held = stage(held, "held")
    before = F.sum("held").over(Window.partitionBy("source").orderBy("part")
                                .rowsBetween(Window.unboundedPreceding, -1))
    plan = targets(held.groupBy("source").agg(F.sum("held").alias("source_size")),
                   weights, max_epochs, total)
    plan = (held.withColumn("before", F.coalesce(before, F.lit(0))).alias("h")
            .join(plan.alias("p"), F.col("h.source").eqNullSafe(F.col("p.source")))
            .select(F.col("h.source").alias("s"), F.col("part").alias("q"), "before", "source_size", "target"))
    # sources of one range partition are apart, so this window stays inside it
    inner = F.sum("size").over(Window.partitionBy("source", "part").orderBy("key", "id", "size")
                               .rowsBetween(Window.unboundedPreceding, -1))
    placed = ranged.withColumn("inner", F.coalesce(inner, F.lit(0)))
    mixed = placed.join(plan, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("q")))
    budget = F.floor("target")
    epochs = F.coalesce(F.floor(F.try_divide(budget, F.col("source_size"))), F.lit(0))
    rest = budget - epochs * F.col("source_size")
    start = F.col("before") + F.col("inner")
    cut = F.least(F.col("size"), F.greatest(rest - start, F.lit(0)))
    return mixed.select(
        F.col("id").alias(id_col), *[F.col(f"keep_{c}").alias(c) for c in keep], "size", "source_size",
        "target", (epochs * F.col("size") + cut).cast("long").alias("taken"))
