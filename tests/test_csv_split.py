"""CSV files read in byte ranges against Spark's whole-file reader and Python's."""

import csv
import os
import random
import tempfile

import pytest

from tessera.sources import csv_split as C
from tessera.sources import io

SCHEMA = "id long, a string, price double, b string"


@pytest.fixture
def small_ranges(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "300", "spark.sql.files.minPartitionNum": "64"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write(rows, names=("id", "a", "price", "b"), end="\n"):
    folder = tempfile.mkdtemp(prefix="tessera-csv-", dir="/tmp")
    with open(os.path.join(folder, "one.csv"), "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=end)
        w.writerow(names)
        w.writerows(rows)
    return folder


def random_rows(n, seed):
    rng = random.Random(seed)
    parts = ["plain", "with, comma", 'a "quoted" word', "two\nlines", "\n", "", "é日本\U0001f600", '""', "x" * 300, "a\r\nb", " lead", '"', "end\n"]
    return [(k, "".join(rng.choice(parts) for _ in range(rng.randint(0, 6))) or None,
             rng.choice([None, 1.5, 20.0, -3.25]), rng.choice([None, "z", "l1\nl2\nl3", "q\"\n\"q"])) for k in range(n)]


def compared(spark, folder):
    whole = spark.read.options(header="true", **C.OPTIONS).schema(SCHEMA).csv(folder)
    return (sorted(map(tuple, C.read_csv(spark, folder, SCHEMA).collect()), key=repr),
            sorted(map(tuple, whole.collect()), key=repr))


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_whole_file_reader(spark, small_ranges, end):
    rows = random_rows(400, 5)
    folder = write(rows, end=end)
    got, want = compared(spark, folder)
    assert len(got) == 400 and got == sorted(rows, key=repr)
    if end == "\n":  # with the other, the whole-file reader changes line ends inside fields
        assert got == want
    ranges = C._lines(spark, folder).select("block").distinct().count()
    assert ranges > 30  # one file, many tasks


def test_equals_python_reader(spark, small_ranges):
    rows = [(k, f"t{k}\n\"{k}\",", 0.5 * k, "u\n" * (k % 50)) for k in range(300)]
    got = C.read_csv(spark, write(rows), SCHEMA).collect()
    assert sorted((r["id"], r["a"], r["price"], r["b"]) for r in got) == [(a, b, c, d or None) for a, b, c, d in rows]


def test_field_over_many_ranges_and_fallback(spark, small_ranges):
    rows = random_rows(20, 6) + [(99, "line\n" * 2000, 1.0, "z")] + random_rows(20, 7)
    folder = write(rows)
    assert C.records(spark, folder) is None  # whole ranges lie inside the field
    got, want = compared(spark, folder)
    assert got == want and len(got) == 41
    folder = write([(k, "word " * 20 + "\nmore", 1.0, "z") for k in range(100)])
    assert C.records(spark, folder, edge=16) is None
    got, want = compared(spark, folder)
    assert got == want and len(got) == 100
    assert sorted(map(tuple, C.read_csv(spark, folder, SCHEMA, edge=16).collect()), key=repr) == want


def test_columns_types_and_edges(spark, small_ranges):
    rows = random_rows(200, 8)
    folder = write(rows)
    df = C.read_csv(spark, folder, columns=["price", "id"])
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [("price", "double"), ("id", "int")]
    assert sorted(r["id"] for r in df.collect()) == list(range(200))
    assert C.read_csv(spark, write([]), SCHEMA).count() == 0
    typed = write([(1, "2024-01-02", "true", "9999999999"), (2, "2023-05-06", "false", "1")], ("a", "d", "t", "n"))
    assert [f.dataType.simpleString() for f in C.read_csv(spark, typed).schema] == ["int", "date", "boolean", "bigint"]
    # several files with a header each, blank lines, no line feed at the end
    folder = write(rows[:50])
    with open(os.path.join(folder, "two.csv"), "w", encoding="utf-8") as f:
        f.write('id,a,price,b\n\n500,"x\ny",1.0,z\n\n501,id,2.0,"open\nend"')
    got, want = compared(spark, folder)
    assert got == want and {500, 501} <= {r[0] for r in got} and len(got) == 52


def test_read_csv_uses_it(spark, small_ranges):
    folder = write([(1, "x\ny", 2.0, "2020-01-02"), (2, None, 3.0, None)])
    got = io.read_csv(spark, folder, "id long, a string, price double, b string", columns=["id", "a", "b"], dates=["b"])
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "string", "date"]
    assert sorted((r["id"], r["a"], str(r["b"])) for r in got.collect()) == [(1, "x\ny", "2020-01-02"), (2, None, "None")]


def test_compressed_files_of_few_rows(spark):
    """Compressed files with line breaks in fields, each of a bounded number of rows."""
    rows = random_rows(100, 9)
    folder = tempfile.mkdtemp(prefix="tessera-csv-", dir="/tmp")
    io.write_csv(spark.createDataFrame(rows, SCHEMA).coalesce(2), folder, compression="gzip", max_records=8)
    files = [f for f in os.listdir(folder) if f.startswith("part-")]
    assert len(files) >= 13 and all(f.endswith(".csv.gz") for f in files)
    back = io.read_csv(spark, folder, SCHEMA).collect()
    plain = tempfile.mkdtemp(prefix="tessera-csv-", dir="/tmp")
    io.write_csv(spark.createDataFrame(rows, SCHEMA), plain)
    assert sorted(map(tuple, back), key=repr) == sorted(map(tuple, io.read_csv(spark, plain, SCHEMA).collect()), key=repr)


def test_ads_csv_is_compressed(spark):
    """The ads' texts repeat: their CSV is smaller than they are."""
    from tessera.plans import q_sources
    path = q_sources._ads_csv(spark, "/root/testdata/sf0.001").removeprefix("file:")
    written = sum(os.path.getsize(os.path.join(path, f)) for f in os.listdir(path) if f.startswith("part-"))
    back = io.read_csv(spark, path, q_sources.ADS_CSV_SCHEMA, columns=["description"])
    assert 0 < 2 * written < back.selectExpr("sum(octet_length(description))").first()[0]


def test_one_file_of_many_tasks(spark):
    """The file that one task would write, but for the order of its records."""
    from tessera.sources import one_file
    rows = random_rows(300, 10)
    df = spark.createDataFrame(rows, "id long, `a b` string, price double, `c,d` string").repartition(7, "id")
    folders = [tempfile.mkdtemp(prefix="tessera-csv-", dir="/tmp") for _ in range(3)]
    one_file.write_one_csv(df, folders[0])
    io.write_csv(df.coalesce(1), folders[1])
    one_file.write_one_csv(df.where("id < 0"), folders[2])  # nothing but a header
    got, want, none = ([open(os.path.join(d, f), newline="", encoding="utf-8").read() for f in os.listdir(d) if f.endswith(".csv")]
                       for d in folders)
    assert len(got) == len(want) == 1 and none == ['id,a b,price,"c,d"\n']
    assert len(got[0]) == len(want[0]) and got[0].splitlines()[0] == want[0].splitlines()[0]
    assert sorted(csv.reader(got[0].splitlines(True))) == sorted(csv.reader(want[0].splitlines(True)))
    assert not [f for f in os.listdir(folders[0]) if f.endswith(".part")]


def test_csv_one_file_has_many_writers(spark, monkeypatch):
    """No task of the query gets all rows of the file."""
    from tessera.plans import QUERIES, registry
    from tessera.sources import one_file
    df = registry.ads(spark, "/root/testdata/sf0.001")
    seen = []

    def watched(rows, path, write=one_file.write_one_csv):
        write(rows.select("*"), path)
        seen.append(path.removeprefix("file:"))

    monkeypatch.setattr(one_file, "write_one_csv", watched)
    monkeypatch.setattr(type(df), "coalesce", lambda *_: pytest.fail("rows of many tasks given to few"))
    assert QUERIES["csv_one_file"](spark, "/root/testdata/sf0.001").count() == df.count()
    assert os.listdir(seen[0]) == [one_file.NAME]


def test_places_do_not_depend_on_the_task(spark):
    """A part's lines written in pieces, in another order and twice."""
    import numpy as np
    import pyarrow as pa

    from tessera.sources import one_file
    lines = ["a", '"é\nb"', "", "cc,d"]
    with tempfile.NamedTemporaryFile(dir="/tmp") as f:
        begin = [0, 2, 9, 10]
        batch = pa.RecordBatch.from_pydict({"part": pa.array([1] * 4, pa.int32()), "begin": begin, "line": lines})
        starts = type("Known", (), {"value": np.array([0, 3])})
        for some in ([batch.slice(2), batch.slice(0, 1)], [batch.take(pa.array([1, 0, 2, 3]))]):
            list(one_file._write_at(f.name, starts)(iter(some)))
        assert open(f.name, "rb").read() == b"\0\0\0" + ("\n".join(lines) + "\n").encode()
