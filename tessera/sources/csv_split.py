"""CSV files with line breaks in fields, read by many tasks.

Spark splits a CSV file only if no field holds a line break; with ``multiLine`` a
file is one task. Here a file is cut into byte ranges as any text file, and the state
at each range's begin (inside a quoted field or not) follows from a prefix scan: the
quotes of a range, modulo 2, say whether it flips the state, and running sums over the
ranges of a file give every range's own.

1. A first scan takes from each range its quotes and, for either state it may begin
   in, the lines before its first record's begin and those after its last record's
   end (its edges, at most ``EDGE`` bytes each).
2. The running parities, one row for each range, settle which state was true.
3. A second scan cuts each range's lines into whole records, now knowing the state.
   The records over a boundary are one range's tail and the next one's head.
4. Records are parsed by ``from_csv``, which reads only the columns asked for.

Lines end with a line feed, or a carriage return and a line feed; a quote occurs in
quoted fields only (doubled inside), as writers put it. A record that reaches further
than ``EDGE`` bytes into a range makes the whole read fall back to one task a file.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType

from ..session import materialize, ship_package

#: Bytes of a record on either side of a range's boundary, at most.
EDGE = 8 << 20
OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true"}
_SCAN = ("file string, block long, quotes long, head0 string, tail0 string, head1 string, tail1 string, "
         "long0 boolean, long1 boolean, whole0 boolean")
#: Types that a column of text may turn out to have, narrowest first.
_TYPES = ("int", "bigint", "double", "date", "timestamp", "boolean")


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines with the file and byte range they begin in, in file order inside a task."""
    return (spark.read.option("lineSep", "\n").text(path)
            .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")))


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.StringArray]]:
    """Stretches of lines of one byte range, in order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        block, file = batch.column("block").to_numpy(), batch.column("file").dictionary_encode()
        new = (np.diff(block) != 0) | (np.diff(file.indices.to_numpy()) != 0)
        cut = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        for a, b in zip(cut, cut[1:], strict=False):
            yield file[a].as_py(), int(block[a]), batch.column("value").slice(a, b - a)


def _quotes(lines: pa.StringArray) -> np.ndarray:
    return pc.count_substring(lines, '"').to_numpy(zero_copy_only=False).astype(np.int64)


class _Edge:
    """Lines of one edge, none of them if they are over ``most`` bytes."""

    def __init__(self, most: int):
        self.most, self.lines, self.size = most, [], 0

    def add(self, lines: pa.StringArray) -> None:
        self.size += lines.nbytes if len(lines) else 0
        if self.size > self.most:
            self.lines = []
        else:
            self.lines += lines.to_pylist()

    def text(self) -> str | None:
        return "\n".join(self.lines) if self.lines else None


class _Edges:
    """Head and tail of one byte range, if it begins in state ``inside``."""

    def __init__(self, inside: int, most: int):
        self.state, self.ended, self.whole, self.most = inside, inside == 0, False, most
        self.head, self.tail = _Edge(most), _Edge(most)

    def add(self, lines: pa.StringArray, quotes: np.ndarray) -> None:
        after = (self.state + np.cumsum(quotes)) & 1
        ends = np.flatnonzero(after == 0)
        self.state = int(after[-1])
        begin = 0
        if not self.ended:  # the head goes up to the first line that closes the field
            stop = int(ends[0]) + 1 if len(ends) else len(lines)
            self.head.add(lines.slice(0, stop))
            if not len(ends):
                return
            self.ended, begin = True, stop
        last = int(ends[-1]) + 1 if len(ends) else 0
        if last > begin:
            self.whole = True
        if last:
            self.tail = _Edge(self.most)
        self.tail.add(lines.slice(max(begin, last)))

    def texts(self) -> tuple[str | None, str | None]:
        return self.head.text(), self.tail.text()

    def too_long(self) -> bool:
        return max(self.head.size, self.tail.size) > self.most or not self.ended


def _scan(edge: int):
    """Task function: quotes and edges of each byte range."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total, edges = None, 0, ()

        def row() -> pa.RecordBatch:
            (h0, t0), (h1, t1) = (e.texts() for e in edges)
            # an edge that is too long only matters if its state turns out to be the true one
            return pa.RecordBatch.from_pydict({
                "file": [now[0]], "block": pa.array([now[1]], pa.int64()), "quotes": pa.array([total], pa.int64()),
                "head0": pa.array([h0], pa.string()), "tail0": pa.array([t0], pa.string()),
                "head1": pa.array([h1], pa.string()), "tail1": pa.array([t1], pa.string()),
                "long0": [edges[0].too_long()], "long1": [edges[1].too_long()], "whole0": [edges[0].whole]})

        for file, block, lines in _ranges(batches):
            if (file, block) != now:
                if now:
                    yield row()
                now, total, edges = (file, block), 0, (_Edges(0, edge), _Edges(1, edge))
            quotes = _quotes(lines)
            total += int(quotes.sum())
            for e in edges:
                e.add(lines, quotes)
        if now:
            yield row()

    return work


def _cut(inside):
    """Task function: the whole records of each byte range (not those over its
    boundaries), and whether a record is its file's first. ``inside``: for each file
    its ranges and their states."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, now, state, held, head, first = inside.value, None, 0, None, False, False
        for file, block, lines in _ranges(batches):
            if (file, block) != now:
                now, held = (file, block), None
                blocks, states = known[file]
                at = int(np.searchsorted(blocks, block))
                if at == len(blocks) or blocks[at] != block:
                    raise RuntimeError(f"the byte ranges of {file} changed between two scans")
                state = int(states[at])
                head, first = state == 1, block == 0
            after = (state + np.cumsum(_quotes(lines))) & 1
            state = int(after[-1])
            if held is not None:
                lines = pa.concat_arrays([held, lines])
                after = np.concatenate((np.ones(len(held), np.int64), after))
            ends = np.flatnonzero(after == 0)
            begin = 0
            if head and len(ends):  # the previous range's record ends here
                begin, ends, head = int(ends[0]) + 1, ends[1:], False
            stop = int(ends[-1]) + 1 if len(ends) else begin
            held = lines.slice(stop) if stop < len(lines) and not head else None
            if len(ends):
                offsets = pa.array(np.concatenate(([begin], ends + 1)), pa.int32())
                top = np.zeros(len(ends), bool)
                top[0], first = first, False
                yield pa.RecordBatch.from_arrays(
                    [pc.binary_join(pa.ListArray.from_arrays(offsets, lines), "\n").cast(pa.string()), pa.array(top)],
                    ["record", "top"])

    return work


def _over_boundaries(ranges: DataFrame) -> DataFrame:
    """The record that is open at each range's end: its tail and the next range's head."""
    order = Window.partitionBy("file").orderBy("block")
    tail = F.when(F.col("inside") == 0, F.col("tail0")).otherwise(F.col("tail1"))
    rest = F.when(F.lead("inside").over(order) == 1, F.lead("head1").over(order))
    top = (F.col("block") == 0) & ~F.col("whole0")
    return (ranges.select(F.concat_ws("\n", tail, rest).alias("record"), top.alias("top"), tail.alias("tail"))
            .where("tail IS NOT NULL").drop("tail"))


def records(spark: SparkSession, path: str | Sequence[str], edge: int = EDGE) -> DataFrame | None:
    """Every record of the files as one text row, ``record``, and whether it is its
    file's first, ``top`` (None if a record reaches too far over a boundary)."""
    ship_package(spark)
    scanned = materialize(_lines(spark, path).mapInArrow(_scan(edge), _SCAN))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ranges = scanned.withColumn("inside", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).cast("int"))
    if not ranges.where((F.col("inside") == 0) & F.col("long0") | (F.col("inside") == 1) & F.col("long1")).isEmpty():
        return None
    known: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    found = ranges.select("file", "block", "inside").orderBy("file", "block").toArrow()  # a row for each byte range
    files = found["file"].combine_chunks().dictionary_encode()
    block, state = found["block"].to_numpy(), found["inside"].to_numpy().astype(np.int8)
    for k, name in enumerate(files.dictionary.to_pylist()):
        mine = files.indices.to_numpy() == k
        known[name] = block[mine], state[mine]
    whole = _lines(spark, path).mapInArrow(_cut(spark.sparkContext.broadcast(known)),
                                                 "record string, top boolean")
    return whole.union(_over_boundaries(ranges)).select(F.regexp_replace("record", "\r$", "").alias("record"), "top")


def header_of(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """The column names in the first line."""
    return spark.read.options(header="true", **OPTIONS).csv(path).columns


def _parsed(schema: StructType) -> Column:
    return F.from_csv("record", schema.toDDL(), OPTIONS)


def infer(rows: DataFrame, names: Sequence[str]) -> StructType:
    """The narrowest type that every value of a column has, in one aggregation."""
    text = StructType([StructField(n, StringType()) for n in names])
    cells = rows.select(_parsed(text).alias("r")).select(*(F.col(f"r.`{n}`").alias(f"c{k}") for k, n in enumerate(names)))
    seen = cells.agg(*(F.count(f"c{k}").alias(f"n{k}") for k in range(len(names))),
                     *(F.count(F.expr(f"try_cast(c{k} AS {t})")).alias(f"n{k}_{t}") for k in range(len(names)) for t in _TYPES)).first()
    kinds = [next((t for t in _TYPES if seen[f"n{k}"] and seen[f"n{k}_{t}"] == seen[f"n{k}"]), "string") for k in range(len(names))]
    return StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in zip(names, kinds, strict=True)))


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType | str | None = None,
             columns: Sequence[str] | None = None, edge: int = EDGE) -> DataFrame:
    """CSV files with a header line each, split into byte ranges. Without ``schema``
    the types are inferred (one more scan); ``columns`` are parsed alone; ``edge``:
    bytes of a record on either side of a boundary, at most."""
    names = header_of(spark, path)
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    rows = records(spark, path, edge)
    if rows is None:
        reader = spark.read.options(header="true", **OPTIONS)
        df = (reader.schema(schema) if schema is not None else reader.option("inferSchema", True)).csv(path)
        return df.select(*columns) if columns else df
    rows = rows.where(~F.col("top") & (F.length("record") > 0))
    schema = schema or infer(rows, names)
    wanted = columns or [f.name for f in schema.fields]
    return rows.select(_parsed(schema).alias("r")).select(*(F.col(f"r.`{c}`").alias(c) for c in wanted))
