"""Registered queries against their DuckDB oracles, and the pipeline."""

import math
import os
import re
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import __spark_entry__ as E  # noqa: E402
from tessera.llm.queries import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark", "labels", "conversations")


def rows(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(round(v, 6) if isinstance(v := r[i], float) and not math.isnan(v) else v for i in order)
                   for r in records), key=repr)


def test_entry_has_all():
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())
    assert {int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = E.queries()[name](spark, SF)
    cur = con.execute(ORACLES[name])
    cols = [d[0] for d in cur.description]
    assert sorted(got.columns) == sorted(cols)
    assert rows(map(tuple, got.collect()), got.columns) == rows(cur.fetchall(), cols)


def test_pipeline(spark):
    """Every stage keeps what its operator's own test says it keeps."""
    import corpus_pipeline as P

    from .test_documents import components, hits
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    # planted: an exact copy, a near copy, a benchmark passage, a secret, a text without letters
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()["text"]
    text = docs.where("length(text) > 1500").orderBy("doc_id").first()["text"]
    add = [(9001, text), (9002, text + " and more"), (9003, "It was a day. " + item + " So it went."),
           (9004, "A note: password = 'hunter2hunter2' was leaked in the log."), (9005, "12 34 !?"), (9006, None)]
    extra = spark.createDataFrame([(i, t, "en", "src1", len(t or "")) for i, t in add], docs.schema)
    now, kept = docs.union(extra), []
    for name, work in P.STAGES:
        before = {r["doc_id"]: r["text"] for r in now.collect()}
        now = P.stage(work(spark, now, SF), f"test-{name}")
        kept.append((before, {r["doc_id"] for r in now.collect()}, now))
    (a, language, _), (b, dedup, _), (c, clean, _), (d, safe, marked), (e, mixed, mix) = kept
    assert {9005, 9006} == set(a) - language
    want = components(list(b.items()))
    assert dedup == {i for i in b if want.get(i, i) == i} and not {9001, 9002} & dedup
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    hit = hits(list(c.items()), bench, 10)
    assert clean == {i for i, t in c.items() if not hit[i, t][4]} and 9003 not in clean
    assert safe == set(d)
    assert "hunter2" not in marked.where("doc_id = 9004").first()["text"]
    assert marked.columns == docs.columns
    assert mixed <= set(e) and mix.where("taken <= 0 OR taken > 3 * size").count() == 0


def test_pipeline_rows_and_columns(spark):
    """Null and shared ids are judged by their own text; columns of any name pass."""
    import corpus_pipeline as P
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()["text"]
    names = ("secret_spans", "base", "tokens", "score", "lang_pred", "letters", "document", "text_md5", "key", "size")
    plain = "It was a quiet day in the town and the people went about their work without any haste at all. "
    data = [(None, "We read that " + item), (None, plain + "One."), (7, "They said " + item), (7, plain * 2 + "Two."),
            (8, plain * 3 + "password = 'hunter2hunter2' was there."), (9, "12 34")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t), *["kept"] * len(names)) for i, t in data],
                                 "doc_id long, text string, lang string, source string, n_chars long, "
                                 + ", ".join(f"`{c}` string" for c in names))
    real = spark.read.parquet(f"{SF}/documents.parquet")
    all_ = docs.unionByName(real, allowMissingColumns=True).where("doc_id IS NULL OR doc_id < 10 OR doc_id > 100")

    def mine(df):
        return sorted((r["doc_id"] or 0, r["text"][:40]) for r in df.where("base = 'kept'").collect())
    now = P.stage(P.language(spark, all_, SF), "test-language")
    assert now.columns == all_.columns and (9, "12 34") not in mine(now)
    clean = P.stage(P.decontaminate(spark, docs.where("doc_id IS NULL OR doc_id < 9"), SF), "test-clean")
    assert clean.columns == docs.columns
    assert mine(clean) == sorted((i or 0, t[:40]) for i, t in data if item not in t and i != 9)
    safe = P.stage(P.secrets(spark, clean, SF), "test-safe")
    assert safe.columns == docs.columns and safe.where("secret_spans = 'kept' AND base = 'kept' AND score = 'kept'").count() == safe.count()
    row = safe.where("doc_id = 8").first()
    assert "hunter2" not in row["text"] and row["n_chars"] == len(row["text"])
    assert P.mixing(spark, safe, SF).count() > 0
    assert P.near_dedup(spark, docs, SF).columns == docs.columns


def test_secret_counts_by_kind(spark, tmp_path):
    """Each count is of its own kind, wherever its spans stand in the list."""
    texts = {1: "AKIAABCDEFGHIJKL", 2: "secret=x1y2z3w4 then " + "0f" * 16, 3: "0f" * 16 + " " + "a0" * 16 + " token: abcdefgh1",
             4: "AKIAABCDEFGHIJKL AKIAABCDEFGHIJKM passwd='12345678'", 5: "password=short", 6: None}
    spark.createDataFrame([(i, t, "en", "s") for i, t in texts.items()], "doc_id long, text string, lang string, source string"
                          ).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["n_assign"], r["n_access"], r["n_hex"]) for r in E.queries()["op6_secret_scan"](spark, str(tmp_path)).collect()}
    assert got == {1: (0, 1, 0), 2: (1, 0, 1), 3: (1, 0, 2), 4: (1, 2, 0), 5: (0, 0, 0), 6: (0, 0, 0)}
