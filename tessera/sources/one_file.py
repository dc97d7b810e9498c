"""One CSV file written by many tasks.

Spark writes a file by one task. Here the lines are stored first, each with its begin
among its task's lines; running sums of the tasks' bytes give every line its place in
the file, and tasks write their lines there. A place does not depend on which task writes
it, nor how often it does so.

Tasks write to places of a file through the file system that they share (a folder named
by ``file:`` or no scheme). Object stores and HDFS offer no such writes: there one task
still writes the file.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package
from .manifest import qualified

NAME = "part-00000.csv"


def _sizes(lines: pa.Array) -> np.ndarray:
    """Bytes of each line with its line feed."""
    return pc.binary_length(lines).to_numpy(zero_copy_only=False).astype(np.int64) + 1


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: each line with its task and its begin among that task's lines."""
    part, end = TaskContext.get().partitionId(), 0
    for batch in batches:
        lines = batch.column(0)
        size = _sizes(lines)
        begin = end + np.cumsum(size) - size
        end += int(size.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(lines), part, np.int32)), pa.array(begin), pa.array(size), lines],
            ["part", "begin", "size", "line"])


def _write_at(file: str, starts):
    """Task function: lines written to their places, those that lie side by side at once;
    returns the bytes written. ``starts``: where each part begins in the file."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, done = starts.value, 0
        at = os.open(file, os.O_WRONLY)  # the driver made it: a folder that is not shared fails here
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                lines = batch.column(2)
                size = _sizes(lines)
                begin = known[batch.column(0).to_numpy()] + batch.column(1).to_numpy()
                cut = [0, *(np.flatnonzero(begin[1:] != begin[:-1] + size[:-1]) + 1).tolist(), batch.num_rows]
                for a, b in zip(cut, cut[1:], strict=False):
                    data, place = memoryview(("\n".join(lines.slice(a, b - a).to_pylist()) + "\n").encode()), int(begin[a])
                    while data:
                        n = os.pwrite(at, data, place)
                        data, place, done = data[n:], place + n, done + n
        finally:
            os.close(at)  # what a shared file system held back until now fails here
        yield pa.RecordBatch.from_pydict({"n": pa.array([done], pa.int64())})

    return work


def write_one_csv(df: DataFrame, path: str) -> None:
    """``df`` as one CSV file with a header in the folder ``path``. Until then its lines
    are stored compressed, by the tasks that compute them: rows of one task whose values
    repeat need little space side by side. The file appears when it is whole."""
    from . import io

    spark = df.sparkSession
    uri = qualified(spark, path)
    if not uri.startswith("file://"):
        io.write_csv(df.coalesce(1), path)
        return
    ship_package(spark)
    line = F.to_csv(F.struct(*(F.col(f"`{c}`") for c in df.columns)), io.CSV)
    stored = scratch_path(spark, "csv-lines")
    (df.select(line.alias("line")).mapInArrow(_placed, "part int, begin long, size long, line string")
     .write.option("compression", "zstd").parquet(stored))
    lines = spark.read.parquet(stored)

    names = spark.range(1).select(F.to_csv(F.struct(*(F.lit(c).alias(f"c{k}") for k, c in enumerate(df.columns))), io.CSV))
    header = (names.first()[0] + "\n").encode()
    found = lines.groupBy("part").agg(F.sum("size").alias("size")).orderBy("part").toArrow()  # a row for each task
    part, size = found["part"].to_numpy(), found["size"].to_numpy()
    starts = np.zeros(int(part.max()) + 1 if len(part) else 0, np.int64)
    starts[part] = len(header) + np.cumsum(size) - size

    folder = uri.removeprefix("file://")
    os.makedirs(folder, exist_ok=True)
    whole, file = os.path.join(folder, NAME), os.path.join(folder, f".{NAME}.part")
    with open(file, "wb") as f:
        f.write(header)
        f.truncate(len(header) + int(size.sum()))
    written = (lines.select("part", "begin", "line").mapInArrow(_write_at(file, spark.sparkContext.broadcast(starts)), "n long")
               .agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    if written != int(size.sum()):
        raise RuntimeError(f"{written} bytes written of {int(size.sum())} to {whole}")
    os.replace(file, whole)
