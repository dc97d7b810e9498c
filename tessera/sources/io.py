"""Readers and writers.

Parquet replaces the reference's feather, pickle and HDF5 files: typed,
columnar, pruned on read (``ReadSchema``) and split across tasks. A feature
store is a folder with one Parquet table per feature, keyed by the row key
(the reference aligned files by position; a key join cannot misalign).
Existence checks use the Hadoop file system of the session, so they work on
any shared storage the cluster uses.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import csv_split

FORMATS = {".csv": "csv", ".parquet": "parquet", ".feather": "parquet", ".pickle": "parquet",
           ".json": "json", ".orc": "orc"}


# -- file system helpers ----------------------------------------------------------

def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def is_complete(spark: SparkSession, path: str) -> bool:
    """A finished Spark write leaves ``_SUCCESS`` in the folder."""
    return exists(spark, path.rstrip("/") + "/_SUCCESS")


# -- CSV ----------------------------------------------------------------------

CSV = {"quote": '"', "escape": '"'}


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             columns: Sequence[str] | None = None, dates: Sequence[str] = (),
             date_format: str | None = None, multi_line: bool = True) -> DataFrame:
    """CSV with a header; text fields may hold line breaks and quotes, and a
    file is still read by many tasks (``csv_split``; ``multi_line=False`` saves its
    first scan where no field holds a line break). With ``schema`` nothing is inferred
    (stable types); ``columns`` prunes, ``dates`` parses text dates."""
    if multi_line:
        df = csv_split.read_csv(spark, path, schema, columns)
    else:
        reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
        df = reader.csv(path)
        if columns:
            df = df.select(*columns)
    for c in dates:
        if c in df.columns:
            df = df.withColumn(c, F.to_date(F.col(c), date_format) if date_format else F.to_date(c))
    return df


def write_csv(df: DataFrame, path: str, compression: str | None = None, mode: str = "overwrite",
              max_records: int = 0) -> None:
    """CSV with a header (``compression='gzip'`` for the submission file).
    ``max_records``: rows of a file, at most (a compressed file is one task's to read)."""
    w = df.write.mode(mode).option("header", True).options(**CSV)
    if compression:
        w = w.option("compression", compression)
    if max_records:
        w = w.option("maxRecordsPerFile", max_records)
    w.csv(path)


def first_rows(df: DataFrame, key: Sequence[str], n: int) -> DataFrame:
    """S3: the first ``n`` rows in key order (``limit`` alone is not
    deterministic across partitions)."""
    return df.orderBy(*key).limit(n)


# -- typed tables and format dispatch -------------------------------------------------

def save_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
               partition_by: Sequence[str] = ()) -> None:
    """Write a typed table."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True).option("escape", '"')
    w.save(path)


def load_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: StructType | str | None = None) -> DataFrame:
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", True).option("multiLine", True).option("escape", '"')
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def format_of(name: str, default: str = "csv") -> str:
    return FORMATS.get(os.path.splitext(name)[1].lower(), default)


def save_file(df: DataFrame, name: str, ext: str = ".csv", schema=None) -> str:
    """Pick the format from the extension (csv by default)."""
    path = name if name.endswith(ext) else name + ext
    save_table(df, path, format_of(path))
    return path


def load_file(spark: SparkSession, name: str, ext: str = ".csv", schema=None) -> DataFrame:
    path = name if name.endswith(ext) else name + ext
    return load_table(spark, path, format_of(path), schema)


def read_pair(spark: SparkSession, train_path: str, test_path: str, fmt: str = "parquet",
              merged: bool = True):
    """Read train and test; stacked with a ``split`` column when merged
    (the test table may lack the target), else returned apart."""
    train = load_table(spark, train_path, fmt)
    test = load_table(spark, test_path, fmt)
    if not merged:
        return train, test
    return (train.withColumn("split", F.lit("train"))
            .unionByName(test.withColumn("split", F.lit("test")), allowMissingColumns=True))


def convert(spark: SparkSession, sources: dict[str, str], target_dir: str,
            src_fmt: str = "csv", dst_fmt: str = "parquet", schema=None) -> dict[str, str]:
    """Convert a set of tables between formats; returns the new paths."""
    out = {}
    for name, path in sources.items():
        dst = os.path.join(target_dir, name)
        save_table(load_table(spark, path, src_fmt, schema), dst, dst_fmt)
        out[name] = dst
    return out


# -- per-feature store ---------------------------------------------------------------

def store_add(df: DataFrame, store: str, key: str = "item_id") -> list[str]:
    """Write every non-key column as its own table ``store/<column>``;
    columns already stored (a complete folder) are skipped. Returns the names
    written."""
    spark = df.sparkSession
    written = []
    for c in df.columns:
        if c == key:
            continue
        path = f"{store.rstrip('/')}/{c}"
        if is_complete(spark, path):
            continue
        df.select(key, c).write.mode("overwrite").parquet(path)
        written.append(c)
    return written


def store_list(spark: SparkSession, store: str) -> list[str]:
    """Names of the complete features in a store."""
    fs, p = _fs_path(spark, store)
    if not fs.exists(p):
        return []
    names = []
    for st in fs.listStatus(p):
        if st.isDirectory() and fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
                st.getPath(), "_SUCCESS")):
            names.append(st.getPath().getName())
    return sorted(names)


def store_read(spark: SparkSession, store: str, names: Sequence[str], base: DataFrame,
               key: str = "item_id") -> tuple[DataFrame, list[str]]:
    """Attach the wanted features that exist to ``base`` by key (left
    joins); missing names are reported, not an error."""
    have = set(store_list(spark, store))
    out, missing = base, []
    for n in names:
        if n not in have:
            missing.append(n)
            continue
        if n in out.columns:
            continue
        out = out.join(spark.read.parquet(f"{store.rstrip('/')}/{n}"), key, "left")
    return out, missing


def store_matrix(matrix: DataFrame, path: str, language_col: str = "language") -> bool:
    """Write a long-form text matrix partitioned by language; an existing
    complete matrix is kept. Returns True when written."""
    spark = matrix.sparkSession
    if is_complete(spark, path):
        return False
    matrix.write.mode("overwrite").partitionBy(language_col).parquet(path)
    return True


# -- skip-if-done materialisation -------------------------------------------------

def fingerprint(*parts: object) -> str:
    return hashlib.sha1("|".join(map(str, parts)).encode("utf-8")).hexdigest()[:16]


def materialize_once(spark: SparkSession, path: str, build: Callable[[], DataFrame],
                     inputs_fingerprint: str) -> DataFrame:
    """Reuse a finished output, keyed by a fingerprint of its inputs (the
    reference reused any file with the right name, even after its inputs
    changed); otherwise compute, write and read back."""
    target = f"{path.rstrip('/')}/fp={inputs_fingerprint}"
    if not is_complete(spark, target):
        build().write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def input_fingerprint(spark: SparkSession, paths: Sequence[str], params: object = "") -> str:
    """Fingerprint of input files (names, sizes, modification times) and
    parameters, from file-system metadata only."""
    items = []
    for path in paths:
        fs, p = _fs_path(spark, path)
        if not fs.isDirectory(p):
            st = fs.getFileStatus(p)
            items.append((st.getPath().toString(), st.getLen(), st.getModificationTime()))
            continue
        files = fs.listFiles(p, True)  # partition folders too
        while files.hasNext():
            st = files.next()
            items.append((st.getPath().toString(), st.getLen(), st.getModificationTime()))
    return fingerprint(sorted(items), params)


# -- other scans ----------------------------------------------------------------------

def read_whitespace_records(spark: SparkSession, path: str, id_field: int = 1,
                            first: int = 2, count: int = 10) -> DataFrame:
    """Whitespace-separated text lines; field ``id_field`` (0-based) is
    the id, fields ``first .. first+count-1`` a float array."""
    lines = spark.read.text(path)
    parts = F.split(F.trim("value"), r"\s+")
    return lines.select(parts.getItem(id_field).cast("long").alias("image_id"),
                        F.transform(F.slice(parts, first + 1, count), lambda x: x.cast("double"))
                        .alias("scores"))


def read_fixed_length(spark: SparkSession, path: str, column: str, length: int) -> DataFrame:
    """Read records holding a fixed-length array; a record of another
    length fails the job (``assert_true``)."""
    df = spark.read.parquet(path)
    # a filter keeps the check in the plan (an unused column would be pruned)
    return df.where(F.assert_true(F.size(column) == length,
                                  f"{column} must hold {length} values").isNull())


def extract_unique(df: DataFrame, column: str, path: str) -> tuple[str, str]:
    """Store one column and its distinct values (two tables)."""
    col_path, uniq_path = f"{path}/column", f"{path}/unique"
    df.select(column).write.mode("overwrite").parquet(col_path)
    df.select(column).distinct().write.mode("overwrite").parquet(uniq_path)
    return col_path, uniq_path
