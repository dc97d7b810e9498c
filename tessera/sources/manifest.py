"""File manifests made by tasks.

A folder tree is listed level by level: the folders of a level are rows, tasks list
them, what they find is written as a table, and its folders are the next level. The
driver sees no file names; a manifest is a table like any other, joins use it, and
contents are read (again by tasks, from their own path) only where a query needs them.

Tasks reach the storage through Arrow's file systems (local, HDFS, S3, GCS, Azure). For
a scheme that those don't know, Spark's own listing is used (one listing on the driver).
"""

from __future__ import annotations

import posixpath
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, ship_package

SCHEMA = "path string, length long, modified timestamp, is_dir boolean"


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as Arrow writes it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    name = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()
    scheme, _, rest = name.partition(":")
    return f"{scheme}://{rest}" if not rest.startswith("//") else name


def _open(uri: str) -> tuple[fs.FileSystem, str, str]:
    """File system, path in it, and what stands before that path in the (plain) URI."""
    scheme, _, rest = uri.partition("://")
    system, path = fs.FileSystem.from_uri(f"{scheme}://{quote(rest, safe='/:@')}")
    path = path.rstrip("/")
    return system, path, uri.rstrip("/").removesuffix(path)


def reachable(uri: str) -> bool:
    """Arrow knows the scheme."""
    try:
        _open(uri)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


def _list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri in batch.column(0).to_pylist():
            system, path, head = _open(uri)
            found = [i for i in system.get_file_info(fs.FileSelector(path, recursive=False))
                     if not i.base_name.startswith(("_", "."))]
            for k in range(0, len(found), 10_000):
                some = found[k:k + 10_000]
                yield pa.RecordBatch.from_arrays([
                    pa.array([head + i.path for i in some], pa.string()),
                    pa.array([i.size if i.type == fs.FileType.File else None for i in some], pa.int64()),
                    pa.array([i.mtime for i in some], pa.timestamp("us", tz="UTC")),
                    pa.array([i.type == fs.FileType.Directory for i in some])],
                    ["path", "length", "modified", "is_dir"])


def manifest(spark: SparkSession, root: str, suffixes: Sequence[str] = ()) -> DataFrame:
    """``path, length, modified`` of every file under ``root`` whose name ends in one of
    ``suffixes`` (any case; none given: all). Names that begin with ``_`` or ``.`` are
    left out, as Spark does."""
    ship_package(spark)
    uri = qualified(spark, root)
    wanted = F.lit(True)
    if suffixes:
        low = F.lower("path")
        wanted = F.lit(False)
        for s in suffixes:
            wanted = wanted | low.endswith(s.lower())
    if not reachable(uri):
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
                 .select("path", "length", F.col("modificationTime").alias("modified")))
        return files.where(wanted)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    level = spark.createDataFrame([(uri,)], "path string")
    files = None
    while True:
        listed = materialize(level.repartition(n, "path").mapInArrow(_list, SCHEMA))
        found = listed.where(~F.col("is_dir")).where(wanted).select("path", "length", "modified")
        files = found if files is None else files.unionByName(found)
        level = listed.where("is_dir").select("path")
        if level.isEmpty():
            return files


def with_content(files: DataFrame, path: str = "path", name: str = "content") -> DataFrame:
    """The rows of a manifest with their files' bytes; a file that is gone has none."""
    ship_package(files.sparkSession)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, uri in enumerate(batch.column(path).to_pylist()):
                try:
                    system, at, _ = _open(uri)
                    with system.open_input_stream(at) as f:
                        data = f.read()
                except FileNotFoundError:
                    data = None
                row = batch.slice(k, 1)
                yield pa.RecordBatch.from_arrays([*row.columns, pa.array([data], pa.binary())], [*row.schema.names, name])

    return files.mapInArrow(work, f"{kinds}, `{name}` binary")


def write_objects(df: DataFrame, root: str, name: str, content: str) -> int:
    """One file for each row, ``root/<name>`` with the bytes of ``content``; returns
    their number. A file appears under its name when it is whole."""
    spark = df.sparkSession
    ship_package(spark)
    uri = qualified(spark, root)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, n = set(), 0
        system, at, _ = _open(uri)
        for batch in batches:
            for name_, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                target = posixpath.join(at, name_)
                folder = posixpath.dirname(target)
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                part = posixpath.join(folder, "." + posixpath.basename(target) + ".part")
                with system.open_output_stream(part) as f:
                    f.write(data or b"")
                system.move(part, target)
                n += 1
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    rows = df.select(F.col(name).cast("string"), F.col(content).cast("binary"))
    return rows.mapInArrow(work, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
