"""Written intermediate tables in the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_path, ship_package

#: Bytes of a batch of rows that goes to a Python worker: what the JVM and the worker
#: hold of it is a small part of an executor.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare(df: DataFrame) -> None:
    """Before an operator makes its task functions: Python workers get the package
    (a function is pickled by reference to its module), and the session's batches to
    them are bounded (``BATCH_BYTES``; a smaller setting stays)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    now = spark.conf.get(_BATCH).rstrip("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each made longer until no column of ``df`` has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def stage(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage, so a lost executor costs a reread and nothing renumbers.
    The shuffle files of the job that wrote the table are freed when it ends;
    else the disk would hold those of all earlier steps of an operator. ``options``
    go to the Parquet writer.
    """
    spark = df.sparkSession
    prepare(df)
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._stage_path = path
    return staged


def discard(staged: DataFrame) -> None:
    """Delete a staged table whose every reader has ended."""
    path = staged.sparkSession._jvm.org.apache.hadoop.fs.Path(staged._stage_path)
    path.getFileSystem(staged.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df``, a staged table, with a broadcast hint if it is counted to have at
    most ``rows`` rows (of a few numbers each); else as it is, for a shuffled join."""
    return F.broadcast(df) if df.count() <= rows else df


def shuffle_tasks(df: DataFrame) -> int:
    """The session's number of shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def total(df: DataFrame, column: str) -> int:
    """Sum of a column (0 for an empty table)."""
    return df.agg(F.coalesce(F.sum(column), F.lit(0))).first()[0]
