"""Distinct-value dictionary pipeline around an expensive per-value function
(B1-B7, J6, J7, U3, A31).

The function (a translation service in the reference) runs once per distinct
value, never per row: values are numbered in first-seen order, cut into
fixed-size chunks, and each chunk is one unit of work and of resumption.
``mapInPandas`` calls the caller's function on Arrow batches inside tasks, one task
for each chunk; a chunk is committed when its task ends (``build``), not when the
job does, so a run that is lost keeps every finished chunk, and a rerun skips those
with an anti join. The dictionary is applied with an equi join (AQE broadcasts it
only when its measured size is small; a dictionary grows with the data).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import materialize
from ..sources.io import exists
from .ordinal import with_position

DICT_SCHEMA = "value string, mapped string, chunk long, ok boolean"
#: Values of a chunk: what a lost task calls again at most.
CHUNK_SIZE = 2000
#: Chunks, so tasks, of one job.
WINDOW = 2000
#: Characters (and 32 for each entry) of a dictionary that goes to the tasks.
SMALL = 1 << 23
#: The committer that moves a task's file to its place when the task ends.
_COMMIT_BY_TASK = ("mapreduce.fileoutputcommitter.algorithm.version", "2")


def chunk_values(df: DataFrame, columns: Sequence[str], chunk_size: int = CHUNK_SIZE,
                 order: str | None = None) -> DataFrame:
    """B1: distinct non-null values of ``columns`` numbered in first-seen order
    (by ``order``; by value when None) and cut into chunks of ``chunk_size``:
    ``(value, ordinal, chunk)``."""
    vals = None
    for c in columns:
        part = df.select(F.col(c).cast("string").alias("value"),
                         (F.col(order) if order else F.lit(0)).alias("__seen"))
        vals = part if vals is None else vals.unionByName(part)
    firsts = vals.where(F.col("value").isNotNull()).groupBy("value").agg(F.min("__seen").alias("__seen"))
    placed = with_position(firsts, ["__seen", "value"], "ordinal")
    return placed.select("value", "ordinal", F.floor(F.col("ordinal") / F.lit(chunk_size))
                         .cast("long").alias("chunk"))


def chunk_window(chunks: DataFrame, start: int, step: int) -> DataFrame:
    """B2: chunks ``start`` .. ``start + step - 1``."""
    return chunks.where(F.col("chunk").between(start, start + step - 1))


def _safe_mapper(fn: Callable[[str], str]):
    """Apply ``fn`` per value; null maps to null; a failing call
    keeps the input value and flags ``ok = False``."""
    def run(batches):
        for pdf in batches:
            out, ok = [], []
            for v in pdf["value"]:
                if v is None or (isinstance(v, float) and pd.isna(v)):
                    out.append(None)
                    ok.append(True)
                    continue
                try:
                    out.append(fn(v))
                    ok.append(True)
                except Exception:  # noqa: BLE001 - the reference keeps the input on any error
                    out.append(v)
                    ok.append(False)
            yield pd.DataFrame({"value": pdf["value"], "mapped": out,
                                "chunk": pdf["chunk"].astype("int64"), "ok": ok})
    return run


def _by_chunk(df: DataFrame) -> DataFrame:
    """Rows clustered by chunk over a stated number of tasks (adaptive execution
    would merge small partitions into one task, whatever a call costs)."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, "chunk")


def apply_to_chunks(chunks: DataFrame, fn: Callable[[str], str]) -> DataFrame:
    """``(value, mapped, chunk, ok)`` for every value of the given chunks.
    Rows are clustered by chunk so one task owns whole chunks. Write the result
    (``stored``) before using it twice: each action on it calls ``fn`` again."""
    return (_by_chunk(chunks.select("value", "chunk"))
            .mapInPandas(_safe_mapper(fn), DICT_SCHEMA))


def apply_to_long_text(chunks: DataFrame, fn: Callable[[str], str], width: int = 1000) -> DataFrame:
    """Long values: characters above U+FFFF are dropped, the text is wrapped
    into pieces of at most ``width`` characters, ``fn`` runs per piece and the
    results are joined, each with a leading space."""
    pieces = chunks.select("ordinal", "chunk",
                           F.posexplode_outer(T.wrap_pieces(T.drop_astral("value"), width))
                           .alias("pos", "piece"))
    mapped = (_by_chunk(pieces.select(F.col("piece").alias("value"), "chunk", "pos", "ordinal"))
              .mapInPandas(_piece_mapper(fn), "value string, mapped string, chunk long, ok boolean, "
                                              "pos int, ordinal long"))
    joined = mapped.groupBy("chunk", "ordinal").agg(
        F.sort_array(F.collect_list(F.struct("pos", "mapped"))).alias("__parts"),
        F.count("value").alias("n_pieces"), F.min(F.col("ok").cast("int")).cast("boolean").alias("ok"))
    text = F.array_join(F.transform("__parts", lambda p: F.concat(F.lit(" "), p["mapped"])), "")
    # the text itself is joined back once, it does not travel with its pieces
    return (chunks.join(joined, ["chunk", "ordinal"])
            .select("value", F.when(F.col("value").isNull(), F.lit(None)).otherwise(text).alias("mapped"),
                    "chunk", "ok", "ordinal", "n_pieces"))


def _piece_mapper(fn):
    base = _safe_mapper(fn)

    def run(batches):
        for pdf in batches:
            extra = pdf[["pos", "ordinal"]].reset_index(drop=True)
            for out in base(iter([pdf[["value", "chunk"]]])):
                out = out.reset_index(drop=True)
                out["pos"] = extra["pos"].fillna(0).astype("int32")
                out["ordinal"] = extra["ordinal"].astype("int64")
                yield out
    return run


def write_chunks(results: DataFrame, path: str) -> None:
    """Persist finished chunks, one folder per chunk (append: a rerun adds the
    chunks it finished). A chunk's rows meet in one task: one file for each chunk, not
    one for each chunk and task."""
    _by_chunk(results).write.mode("append").partitionBy("chunk").parquet(path)


def done_chunks(spark, path: str) -> DataFrame:
    """Chunk numbers already written at ``path`` (none if nothing is there)."""
    if not exists(spark, path):
        return spark.createDataFrame([], "chunk long")
    return spark.read.parquet(path).select("chunk").distinct()


def build(chunks: DataFrame, fn: Callable[[str], str], path: str, start: int = 0, step: int | None = None,
          window: int = WINDOW) -> DataFrame:
    """Map the values of the chunks ``start`` to ``start + step - 1`` (to the
    last) that ``path`` does not have yet, and read all that it has:
    ``(value, mapped, ok, chunk)``.

    Each chunk is one task, and its file is in place when the task ends. If the run
    dies (an executor, the driver, a function that takes its worker down), finished
    chunks stay; calling ``build`` again calls the function for the others only.
    Jobs have ``window`` chunks, so that their number of tasks is bounded. A task
    that is run twice (its executor was lost while it reported) can leave its chunk
    twice: each value of a chunk is read once.
    """
    spark = chunks.sparkSession
    chunks = materialize(chunk_window(chunks, start, step) if step is not None else chunks.where(F.col("chunk") >= start))
    todo = pending(chunks, done_chunks(spark, path))
    bounds = todo.agg(F.min("chunk"), F.max("chunk")).first()
    if bounds[0] is not None:
        for first in range(bounds[0], bounds[1] + 1, window):
            part = chunk_window(todo, first, window)
            n = min(window, bounds[1] + 1 - first)
            # the task of a chunk is its place in the window; adaptive execution leaves such partitions alone
            tasks = part.select("value", "chunk").repartitionById(n, (F.col("chunk") - first).cast("int"))
            (tasks.mapInPandas(_safe_mapper(fn), DICT_SCHEMA).write.mode("append")
             .option(*_COMMIT_BY_TASK).partitionBy("chunk").parquet(path))
    return stored_chunks(spark, path)


def stored_chunks(spark, path: str) -> DataFrame:
    """The finished chunks at ``path``: one row per value of each chunk."""
    if not exists(spark, path):
        return spark.createDataFrame([], "value string, mapped string, ok boolean, chunk long")
    kept = spark.read.schema("value string, mapped string, ok boolean, chunk long").parquet(path)
    return kept.dropDuplicates(["chunk", "value"])


def stored(results: DataFrame, path: str) -> DataFrame:
    """Write the results as chunk folders and read them back: the function has run
    once for every value, whatever reads the dictionary later."""
    write_chunks(results, path)
    return results.sparkSession.read.parquet(path)


def first_missing(done: DataFrame) -> int:
    """The smallest chunk number without output (chunks count from 0)."""
    after = done.select((F.col("chunk") + 1).alias("chunk")).union(
        done.sparkSession.range(1).select(F.col("id").alias("chunk")))
    return after.join(done, "chunk", "left_anti").agg(F.min("chunk")).first()[0]


def pending(chunks: DataFrame, done: DataFrame) -> DataFrame:
    """Chunk rows whose chunk is not finished yet."""
    return chunks.join(done, "chunk", "left_anti")


def missing_chunks(spark, expected_from: int, expected_to: int, done: DataFrame) -> DataFrame:
    """Chunk numbers in [from, to] that have no output."""
    expected = spark.range(expected_from, expected_to + 1).withColumnRenamed("id", "chunk")
    return expected.join(done, "chunk", "left_anti")


def merge(parts: Sequence[DataFrame], upto_chunk: int | None = None) -> DataFrame:
    """One mapping per value; a later chunk (then a later part) wins.
    ``upto_chunk`` stops the merge before the first missing chunk."""
    rows = None
    for rank, p in enumerate(parts):
        q = p.select("value", "mapped", "chunk").withColumn("__rank", F.lit(rank))
        rows = q if rows is None else rows.unionByName(q)
    if upto_chunk is not None:
        rows = rows.where(F.col("chunk") < upto_chunk)
    return rows.groupBy("value").agg(
        F.max_by("mapped", F.struct("chunk", "__rank")).alias("mapped"))


def apply_dictionary(df: DataFrame, dictionary: DataFrame, columns: Sequence[str],
                     suffix: str = "_en", strict: bool = True, row_key: str | None = None) -> DataFrame:
    """Add ``<col><suffix>`` looked up in the (stored) dictionary; null
    maps to null. ``strict`` raises when a non-null value is no key of the
    dictionary; a value that is mapped to null is one.

    A dictionary of ``SMALL`` characters or fewer (counted) goes to the tasks, and the
    rows stay where they are. Of a larger one, each column gets the part that its own
    different values need, if that has ``SMALL`` characters or fewer. The cells of the
    other columns meet the dictionary in one shuffled join and find their row again by
    ``row_key`` (unique in ``df``; without it, one join a column); the join can split a
    value that a third of the cells have.
    """
    d = dictionary.select("value", "mapped")
    if strict:
        used = F.explode(F.array_distinct(F.array(*[F.col(c).cast("string") for c in columns])))
        # counted before the join: a value is met once, however many rows have it
        counts = df.select(used.alias("value")).where("value IS NOT NULL").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
        n = counts.join(d, "value", "left_anti").agg(F.sum("n")).first()[0]
        if n:
            raise KeyError(f"{n} values are missing from the dictionary")

    def characters(t: DataFrame) -> DataFrame:
        return t.agg(F.sum(F.coalesce(F.length("value"), F.lit(0)) + F.coalesce(F.length("mapped"), F.lit(0)) + 32).alias("n"))

    size = characters(d).first()[0] or 0
    if size <= SMALL or row_key is None:
        out = df
        d = F.broadcast(d) if size <= SMALL else d
        for c in columns:
            lookup = d.withColumnsRenamed({"value": c, "mapped": f"{c}{suffix}"})
            out = out.join(lookup, c, "left")
        return out
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(k).alias("at"), F.col(c).cast("string").alias("value"))
                                          for k, c in enumerate(columns)])).alias("cell")).select("cell.*")
    parts = materialize(cells.where("value IS NOT NULL").distinct().join(d, "value").groupBy("at", "value").agg(
        F.max("mapped").alias("mapped")))
    large = {r["at"] for r in characters(parts.groupBy("at")).collect() if r["n"] > SMALL}
    out, met = df, [c for k, c in enumerate(columns) if k in large]
    for k, c in enumerate(columns):
        if k not in large:
            part = parts.where(F.col("at") == k).select(F.col("value").alias("__value"), F.col("mapped").alias(f"{c}{suffix}"))
            out = out.join(F.broadcast(part), F.col(c).cast("string") == F.col("__value"), "left").drop("__value")
    if met:
        cells = df.select(row_key, F.posexplode(F.array(*[F.col(c).cast("string") for c in met])).alias("__at", "value"))
        found = cells.where("value IS NOT NULL").join(d, "value").groupBy(row_key).agg(*[
            F.max(F.when(F.col("__at") == k, F.col("mapped"))).alias(f"{c}{suffix}") for k, c in enumerate(met)])
        out = out.join(found, row_key, "left")
    return out.select(*df.columns, *[f"{c}{suffix}" for c in columns])


def untranslated(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Per column, rows whose mapped value equals the source value and
    how many distinct such values there are."""
    parts = None
    for src, mapped in pairs:
        same = df.where(F.col(src) == F.col(mapped))
        agg = same.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(src).alias("n_values")) \
            .select(F.lit(src).alias("column_name"), "n_rows", "n_values")
        parts = agg if parts is None else parts.unionByName(agg)
    return parts


def untranslated_values(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """The distinct values themselves, per column."""
    same = F.array_compact(F.array(*[
        F.when(F.col(src) == F.col(mapped), F.struct(F.lit(src).alias("column_name"), F.col(src).alias("value")))
        for src, mapped in pairs]))
    return df.select(F.explode(same).alias("v")).select("v.*").distinct()
