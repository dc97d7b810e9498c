"""Queries: the dictionary pipeline (B1-B7, J6, J7, U3, A31) with a
deterministic stand-in for the expensive per-value function."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.stand_in import mark_translation, rerun_translation
from ..operators import dictionary as D
from ..session import scratch_path
from .fixtures import with_description
from .q_text import wrap_ctes
from .registry import ads, query, sql, table

CHUNK = 20  # values per chunk: the test tables have several; production sizes are in the thousands
# the short mapped columns (the description goes through the long-text path)
COLUMNS = ["title", "param_1", "param_2", "param_3", "region", "city", "parent_category_name", "category_name"]


stand_in = mark_translation
rerun = rerun_translation

FN_SQL = ("CASE WHEN contains({v}, 'z') THEN {v} WHEN length({v}) % 3 <> 0 THEN 'en:' || {v} "
          "ELSE {v} END")

CHUNKS_CTE = ("chunks", f"""SELECT value, ordinal, ordinal // {CHUNK} AS chunk FROM (
  SELECT value, row_number() OVER (ORDER BY seen, value) - 1 AS ordinal FROM (
    SELECT value, min(seen) AS seen FROM (
      {" UNION ALL ".join(f"SELECT {c} AS value, item_id AS seen FROM ads" for c in COLUMNS)})
    WHERE value IS NOT NULL GROUP BY value))""")


def _chunks(spark, sf_dir):
    return D.chunk_values(ads(spark, sf_dir), COLUMNS, CHUNK, order="item_id")


@query("value_chunks", "B1 A19", oracle=sql("SELECT value, ordinal, chunk FROM chunks", CHUNKS_CTE))
def q_chunks(spark, sf_dir):
    return _chunks(spark, sf_dir)


@query("chunk_window", "B2",
       oracle=sql("SELECT value, ordinal, chunk FROM chunks WHERE chunk BETWEEN 1 AND 2", CHUNKS_CTE))
def q_window(spark, sf_dir):
    return D.chunk_window(_chunks(spark, sf_dir), 1, 2)


@query("dictionary_build", "B3 B5",
       oracle=sql(f"""SELECT value, {FN_SQL.format(v='value')} AS mapped, chunk,
  NOT contains(value, 'z') AS ok FROM chunks""", CHUNKS_CTE))
def q_build(spark, sf_dir):
    return D.apply_to_chunks(_chunks(spark, sf_dir), stand_in)


@query("dictionary_long_text", "B4 T7 T8",
       oracle=sql(f"""SELECT md5(text) AS value_md5, ordinal, ordinal // 130 AS chunk, CAST(len(pieces) AS BIGINT) AS n_pieces,
  md5(array_to_string(list_transform(pieces, lambda p: ' ' || {FN_SQL.format(v='p')}), '')) AS mapped_md5
FROM v JOIN wrapped USING (ordinal)""",
                  ("v", """SELECT text, row_number() OVER (ORDER BY seen, text) - 1 AS ordinal FROM (
  SELECT text, min(doc_id) AS seen FROM documents WHERE text IS NOT NULL GROUP BY text)"""), *wrap_ctes("v", "ordinal")))
def q_long_text(spark, sf_dir):
    """Whole texts, wrapped into 1000-character pieces, mapped per piece and joined back."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    chunks = D.chunk_values(d, ["text"], 130, order="doc_id")
    return D.apply_to_long_text(chunks, stand_in, 1000).select(
        F.md5("value").alias("value_md5"), "ordinal", "chunk", "n_pieces", F.md5("mapped").alias("mapped_md5"))


def _write_some(spark, sf_dir, chunk_ids):
    path = scratch_path(spark, "dictionary")
    chunks = _chunks(spark, sf_dir)
    D.write_chunks(D.apply_to_chunks(chunks.where(F.col("chunk").isin(chunk_ids)), stand_in), path)
    return chunks, path


@query("dictionary_resume", "B6",
       oracle=sql("SELECT value, chunk FROM chunks WHERE chunk NOT IN (0, 1)", CHUNKS_CTE))
def q_resume(spark, sf_dir):
    chunks, path = _write_some(spark, sf_dir, [0, 1])
    return D.pending(chunks, D.done_chunks(spark, path)).select("value", "chunk")


@query("dictionary_rebuild", "B3 B6",
       oracle=sql(f"""SELECT value, CASE WHEN chunk < 2 THEN {FN_SQL.format(v='value')} ELSE 'v2:' || value END AS mapped,
  chunk, CASE WHEN chunk < 2 THEN NOT contains(value, 'z') ELSE TRUE END AS ok FROM chunks""", CHUNKS_CTE))
def q_rebuild(spark, sf_dir):
    """A run over chunks 0 and 1, then one over all with another function: what the
    first run finished is not called again."""
    path = scratch_path(spark, "dictionary")
    chunks = _chunks(spark, sf_dir)
    D.build(chunks, stand_in, path, 0, 2)
    return D.build(chunks, rerun, path).select("value", "mapped", "chunk", "ok")


@query("missing_chunks", "J7",
       oracle=sql("""SELECT range AS chunk FROM range(0, (SELECT max(chunk) + 1 FROM chunks))
WHERE range NOT IN (0, 1, 3)""", CHUNKS_CTE))
def q_missing(spark, sf_dir):
    chunks, path = _write_some(spark, sf_dir, [0, 1, 3])
    last = chunks.agg(F.max("chunk")).first()[0]
    return D.missing_chunks(spark, 0, int(last), D.done_chunks(spark, path))


@query("dictionary_merge", "U3",
       oracle=sql(f"""SELECT value, CASE WHEN chunk BETWEEN 1 AND 2 THEN 'v2:' || value
  ELSE {FN_SQL.format(v='value')} END AS mapped FROM chunks""", CHUNKS_CTE))
def q_merge(spark, sf_dir):
    chunks = _chunks(spark, sf_dir)
    first = D.stored(D.apply_to_chunks(chunks, stand_in), scratch_path(spark, "dictionary"))
    again = D.stored(D.apply_to_chunks(D.chunk_window(chunks, 1, 2), rerun), scratch_path(spark, "dictionary"))
    return D.merge([first, again])


@query("dictionary_merge_gap", "U3",
       oracle=sql(f"SELECT value, {FN_SQL.format(v='value')} AS mapped FROM chunks WHERE chunk < 1", CHUNKS_CTE))
def q_merge_gap(spark, sf_dir):
    """Stored chunks 0 and 2: the merge stops before the missing chunk 1."""
    _, path = _write_some(spark, sf_dir, [0, 2])
    done = spark.read.parquet(path)
    return D.merge([done], D.first_missing(D.done_chunks(spark, path)))


def _applied(spark, sf_dir):
    a = ads(spark, sf_dir).select("item_id", *COLUMNS)
    dictionary = D.stored(D.apply_to_chunks(_chunks(spark, sf_dir), stand_in), scratch_path(spark, "dictionary"))
    return D.apply_dictionary(a, dictionary, COLUMNS, row_key="item_id")


@query("dictionary_apply", "B7 J6",
       oracle=sql("SELECT item_id, " + ", ".join(
           f"{c}, {FN_SQL.format(v=c)} AS {c}_en" for c in COLUMNS) + " FROM ads"))
def q_apply(spark, sf_dir):
    return _applied(spark, sf_dir).select("item_id", *[x for c in COLUMNS for x in (c, f"{c}_en")])


@query("dictionary_apply_all", "B7 J6 B4",
       oracle=sql("SELECT item_id, " + ", ".join(f"{FN_SQL.format(v=c)} AS {c}_en" for c in COLUMNS) + f""",
  md5(array_to_string(list_transform(pieces, lambda p: ' ' || {FN_SQL.format(v='p')}), '')) AS description_en_md5
FROM ads LEFT JOIN wrapped ON wrapped.text = ads.description""",
                  ("d", "SELECT DISTINCT text FROM documents"), *wrap_ctes("d", "text")))
def q_apply_all(spark, sf_dir):
    """The eight short columns and the long one, in one lookup: their dictionaries are
    one table. Texts are stored mapped; keys and mappings of the long ones are looked up by
    their digest, so that no text travels with its ads."""
    a = with_description(spark, sf_dir, ads(spark, sf_dir), digest=True).select("item_id", *COLUMNS, "description")
    texts = D.chunk_values(table(spark, sf_dir, "documents").select("doc_id", "text"), ["text"], 130, order="doc_id")
    long = D.apply_to_long_text(texts, stand_in, 1000).select(F.md5("value").alias("value"), "mapped", "chunk", "ok")
    long = D.stored(long, scratch_path(spark, "dictionary")).select("value", F.md5("mapped").alias("mapped"))
    short = D.stored(D.apply_to_chunks(_chunks(spark, sf_dir), stand_in), scratch_path(spark, "dictionary"))
    out = D.apply_dictionary(a, short.select("value", "mapped").union(long), [*COLUMNS, "description"], row_key="item_id")
    return out.select("item_id", *[f"{c}_en" for c in COLUMNS], F.col("description_en").alias("description_en_md5"))


@query("untranslated_values", "A31",
       oracle=sql(" UNION ALL ".join(
           f"SELECT DISTINCT '{c}' AS column_name, {c} AS value FROM ads WHERE {c} = {FN_SQL.format(v=c)}"
           for c in COLUMNS)))
def q_untranslated_values(spark, sf_dir):
    return D.untranslated_values(_applied(spark, sf_dir), [(c, f"{c}_en") for c in COLUMNS])


@query("untranslated_audit", "A31",
       oracle=sql(" UNION ALL ".join(
           f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count(DISTINCT {c}) AS n_values
FROM ads WHERE {c} = {FN_SQL.format(v=c)}""" for c in COLUMNS)))
def q_audit(spark, sf_dir):
    return D.untranslated(_applied(spark, sf_dir), [(c, f"{c}_en") for c in COLUMNS])
