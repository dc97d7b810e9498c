"""Global positions and running indexes without a one-task window.

``row_number()`` over an unpartitioned window, or over a window partitioned by
a hot key, sends every row of the table (or of the hot key) through one task.
These helpers instead range-partition on the full sort order (so a hot key is
split across many range partitions by its order column), number rows inside
each partition, and add per-partition offsets. The offset table has one row per
partition, so its broadcast is bounded by the partition count, not the data.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import materialize

_PID = "__pid"
_MID = "__mid"
_OFF = "__off"


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def with_position(df: DataFrame, order: Sequence[str | Column], name: str = "position",
                  num_partitions: int | None = None) -> DataFrame:
    """Add the 0-based position of each row in the order ``order``.

    ``order`` must be a total order (end it with a unique column); ties would
    make positions depend on the partitioning.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = _cols(order)
    staged = materialize(
        df.repartitionByRange(n, *ordered)
        .sortWithinPartitions(*ordered)
        .withColumn(_PID, F.spark_partition_id())
        .withColumn(_MID, F.monotonically_increasing_id())
    )
    # monotonically_increasing_id = (partition id << 33) + row number in partition
    local = F.col(_MID) - F.shiftleft(F.col(_PID).cast("long"), 33)
    counts = staged.groupBy(_PID).agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(
        _PID,
        (F.sum("__n").over(Window.orderBy(_PID)) - F.col("__n")).alias(_OFF),
    )
    # one row per range partition: bounded by the partition count
    return (staged.join(F.broadcast(offsets), _PID)
            .select(*df.columns, (F.col(_OFF) + local).alias(name)))


def running_total(df: DataFrame, order: Sequence[str | Column], amount: str, name: str,
                  num_partitions: int | None = None) -> DataFrame:
    """Add the sum of ``amount`` (whole numbers) over all rows before each row in the
    order ``order`` (a total order). Each task adds up its sorted range as it passes, and
    the sums of the ranges before come on top; the rows are shuffled once."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = _cols(order)
    place = df.columns.index(amount)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = 0
        for batch in batches:
            v = batch.column(place).to_numpy(zero_copy_only=False).astype(np.int64)
            upto = np.cumsum(v) + carried
            yield batch.append_column("__in", pa.array(upto - v))
            carried = int(upto[-1]) if len(upto) else carried

    ranges = df.repartitionByRange(n, *ordered).sortWithinPartitions(*ordered).withColumn(_PID, F.spark_partition_id())
    staged = materialize(ranges.mapInArrow(add_up, StructType([*ranges.schema, StructField("__in", LongType())])))
    sums = staged.groupBy(_PID).agg(F.sum(amount).alias("__n"))
    offsets = sums.select(_PID, (F.sum("__n").over(Window.orderBy(_PID)) - F.col("__n")).alias(_OFF))
    # one row per range partition: bounded by the partition count
    return (staged.join(F.broadcast(offsets), _PID)
            .select(*df.columns, (F.col(_OFF) + F.col("__in")).alias(name)))


def running_index(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                  name: str = "cumcount", num_partitions: int | None = None) -> DataFrame:
    """0-based index of each row inside its key group, in ``order``.

    Rows with a null key get a null index (pandas ``cumcount`` semantics).
    Equivalent to ``row_number() over (partition by keys order by order) - 1``
    but a hot key is spread over many tasks.
    """
    pos = "__gpos"
    placed = with_position(df, [*keys, *order], pos, num_partitions)
    firsts = placed.groupBy(*keys).agg(F.min(pos).alias("__first"))
    joined = placed.join(firsts, list(keys), "left")
    all_keys = F.lit(True)
    for k in keys:
        all_keys = all_keys & F.col(k).isNotNull()
    return joined.select(
        *df.columns,
        F.when(all_keys, F.col(pos) - F.col("__first")).alias(name),
    )
