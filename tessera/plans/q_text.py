"""Queries: text operators (T1-T18) over the ``documents`` table and an
ads-shaped view of it. Oracles build tokens in long form (unnest, anti join
on a stop-word table, positions, self-join for bigrams), independently of the
array-based Spark plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import text as TX
from ..session import spread
from .registry import query, r6, r6sql, table

LANGS = ("en", "fr", "de", "es")
TOKEN_RE = r"[\p{L}\p{N}_]+"


def _docs(spark, sf_dir):
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), "doc_id")


def _stops_sql() -> str:
    rows = []
    for code in LANGS:
        for w in TX.stop_words(code):
            rows.append("('{}', '{}')".format(code, w.replace("'", "''")))
    return f"SELECT * FROM (VALUES {', '.join(rows)}) AS s(lang, word)"


def _grams_sql(source: str, key: str, text: str, *, stop: bool, ngram_max: int,
               min_len: int = 1, lang: str = "lang", prefix: str = "") -> str:
    """CTE text producing ``<prefix>tf(<key>, term, tf)`` for a source relation."""
    lenf = f" WHERE length(tok) >= {min_len}" if min_len > 1 else ""
    anti = ("WHERE NOT EXISTS (SELECT 1 FROM stops s WHERE s.lang = t.lang AND s.word = t.tok)"
            if stop else "")
    langsel = f", {lang} AS lang" if stop else ""
    parts = [
        f"""{prefix}toks AS (SELECT {key}{', lang' if stop else ''}, tok, pos FROM (
    SELECT {key}{langsel}, unnest(l) AS tok, unnest(range(len(l))) AS pos FROM (
      SELECT {key}{langsel}, regexp_extract_all(lower({text}), '{TOKEN_RE}') AS l FROM {source}))
    {lenf})""",
        f"""{prefix}kept AS (SELECT {key}, tok, row_number() OVER (PARTITION BY {key} ORDER BY pos) AS p
    FROM {prefix}toks t {anti})""",
    ]
    grams = [f"SELECT {key}, tok AS term FROM {prefix}kept"]
    if ngram_max >= 2:
        grams.append(f"SELECT a.{key}, a.tok || ' ' || b.tok AS term FROM {prefix}kept a "
                     f"JOIN {prefix}kept b ON a.{key} = b.{key} AND b.p = a.p + 1")
    parts.append(f"{prefix}grams AS ({' UNION ALL '.join(grams)})")
    parts.append(f"{prefix}tf AS (SELECT {key}, term, count(*) AS tf FROM {prefix}grams GROUP BY {key}, term)")
    return ",\n".join(parts)


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# -- scalar text statistics ---------------------------------------------------------

@query("text_stats", "T1 T2 T3 T4 T5",
       oracle=f"""SELECT doc_id,
  CAST(length(lower(text)) AS INTEGER) AS num_chars,
  CAST(len(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '')) AS INTEGER) AS num_words,
  CAST(len(list_distinct(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '')))
    AS INTEGER) AS num_unique_words,
  {r6sql("100.0 * len(list_distinct(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '')))"
         " / nullif(len(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '')), 0)")}
    AS words_vs_unique
FROM documents""")
def q_text_stats(spark, sf_dir):
    d = _docs(spark, sf_dir)
    t = T.prepared("text")
    return d.select("doc_id", T.n_chars(t).alias("num_chars"), T.n_words(t).alias("num_words"),
                    T.n_unique_words(t).alias("num_unique_words"),
                    r6(T.unique_ratio(t)).alias("words_vs_unique"))


@query("measure_length", "T2",
       oracle="""SELECT doc_id, CAST(coalesce(length(CASE WHEN doc_id % 7 = 0 THEN NULL ELSE text END), 1) AS INTEGER)
  AS len_text
FROM documents""")
def q_measure_length(spark, sf_dir):
    d = _docs(spark, sf_dir)
    masked = F.when(F.col("doc_id") % 7 == 0, F.lit(None)).otherwise(F.col("text"))
    return d.select("doc_id", T.measured_length(masked).alias("len_text"))


@query("punct_count", "T6",
       oracle=r"""SELECT doc_id, CAST(length(text) - length(regexp_replace(text, '[!-/:-@\[-`{-~]', '', 'g'))
  AS INTEGER) AS n_punct FROM documents""")
def q_punct(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.n_punct("text").alias("n_punct"))


@query("drop_astral", "T7",
       oracle="""SELECT doc_id, CAST(length(text) AS INTEGER) AS n_before,
  CAST(length(regexp_replace(text, '[^\\x{0000}-\\x{FFFF}]', '', 'g')) AS INTEGER) AS n_after
FROM documents""")
def q_astral(spark, sf_dir):
    d = _docs(spark, sf_dir)
    return d.select("doc_id", F.length("text").alias("n_before"),
                    F.length(T.drop_astral("text")).alias("n_after"))


@query("tokens", "T9 T10",
       oracle=_with("stops AS (" + _stops_sql() + ")",
                    _grams_sql("documents", "doc_id", "text", stop=True, ngram_max=1))
       + """, all_toks AS (SELECT doc_id, count(*) AS n_tokens FROM toks GROUP BY doc_id),
kept_n AS (SELECT doc_id, count(*) AS n_kept FROM kept GROUP BY doc_id)
SELECT d.doc_id, coalesce(a.n_tokens, 0) AS n_tokens, coalesce(k.n_kept, 0) AS n_kept
FROM documents d LEFT JOIN all_toks a ON d.doc_id = a.doc_id LEFT JOIN kept_n k ON d.doc_id = k.doc_id""")
def q_tokens(spark, sf_dir):
    d = _docs(spark, sf_dir)
    toks = T.tokens(F.lower("text"))
    kept = TX.without_stop_words(toks, F.col("lang"))
    return d.select("doc_id", F.size(toks).cast("long").alias("n_tokens"),
                    F.size(kept).cast("long").alias("n_kept"))


# -- n-grams, counts, vocabularies ------------------------------------------------------

@query("ngram_counts", "T11 T12",
       oracle=_with(_grams_sql("documents", "doc_id", "text", stop=False, ngram_max=2, min_len=2))
       + """, dfs AS (SELECT term, count(*) AS df FROM tf GROUP BY term)
SELECT tf.doc_id, tf.term, CAST(tf.tf AS DOUBLE) AS weight FROM tf JOIN dfs USING (term)
WHERE dfs.df >= 25""")
def q_ngram_counts(spark, sf_dir):
    d = _docs(spark, sf_dir)
    terms = TX.analyzed_terms(F.col("text"), ngram_max=2, min_token_len=2)
    return TX.count_matrix(d, "doc_id", terms, min_df=25)


@query("vocab_topk", "T13",
       oracle=_with("stops AS (" + _stops_sql() + ")",
                    _grams_sql("documents", "doc_id", "text", stop=True, ngram_max=2))
       + """SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total FROM tf GROUP BY term
ORDER BY total DESC, term LIMIT 1000""")
def q_vocab(spark, sf_dir):
    d = _docs(spark, sf_dir)
    terms = TX.analyzed_terms(F.col("text"), ngram_max=2, language=F.col("lang"))
    stats = TX.document_frequency(TX.term_counts(d, "doc_id", terms))
    return TX.top_vocabulary(stats, 1000).select("term", "df", F.col("total").cast("long").alias("total"))


def _tfidf_sql(*, stop, ngram_max, min_len, sublinear, smooth, max_features, fit="TRUE") -> str:
    head = []
    if stop:
        head.append("stops AS (" + _stops_sql() + ")")
    head.append(_grams_sql("documents", "doc_id", "text", stop=stop, ngram_max=ngram_max,
                           min_len=min_len))
    # the rows that the vocabulary and the document frequencies are learnt from
    vocab = ("SELECT term, count(*) AS df, sum(tf) AS total FROM tf "
             f"WHERE doc_id IN (SELECT doc_id FROM documents WHERE {fit}) GROUP BY term")
    if max_features:
        vocab += f" ORDER BY total DESC, term LIMIT {max_features}"
    tfw = "(1 + ln(tf.tf))" if sublinear else "CAST(tf.tf AS DOUBLE)"
    n = f"(SELECT CAST(count(*) AS DOUBLE) FROM documents WHERE {fit})"
    idf = f"(ln((1 + {n}) / (1 + v.df)) + 1)" if smooth else f"(ln({n} / v.df) + 1)"
    return _with(*head) + f""", vocab AS ({vocab}),
w AS (SELECT tf.doc_id, tf.term, {tfw} * {idf} AS w FROM tf JOIN vocab v ON tf.term = v.term)
SELECT doc_id, term, {r6sql('w / sqrt(sum(w * w) OVER (PARTITION BY doc_id))')} AS weight FROM w"""


@query("tfidf_sublinear", "T14 T10 T11 T13",
       oracle=_tfidf_sql(stop=True, ngram_max=2, min_len=1, sublinear=True, smooth=False,
                         max_features=1000))
def q_tfidf_sublinear(spark, sf_dir):
    d = _docs(spark, sf_dir)
    terms = TX.analyzed_terms(F.col("text"), ngram_max=2, language=F.col("lang"))
    m = TX.tfidf(d, "doc_id", terms, sublinear_tf=True, smooth_idf=False, max_features=1000)
    return m.select("doc_id", "term", r6("weight").alias("weight"))


@query("tfidf_smooth", "T15",
       oracle=_tfidf_sql(stop=False, ngram_max=1, min_len=2, sublinear=False, smooth=True,
                         max_features=None))
def q_tfidf_smooth(spark, sf_dir):
    d = _docs(spark, sf_dir)
    terms = TX.analyzed_terms(F.col("text"), ngram_max=1, min_token_len=2)
    m = TX.tfidf(d, "doc_id", terms, sublinear_tf=False, smooth_idf=True)
    return m.select("doc_id", "term", r6("weight").alias("weight"))


@query("tfidf_train_fit", "T16 T14",
       oracle=_tfidf_sql(stop=False, ngram_max=1, min_len=2, sublinear=True, smooth=False,
                         max_features=500, fit="doc_id % 4 = 0"))
def q_tfidf_train_fit(spark, sf_dir):
    """Vocabulary and document frequencies from the train rows, weights for all."""
    d = _docs(spark, sf_dir)
    terms = TX.analyzed_terms(F.col("text"), ngram_max=1, min_token_len=2)
    m = TX.tfidf(d, "doc_id", terms, sublinear_tf=True, smooth_idf=False, max_features=500,
                 fit_rows=F.col("doc_id") % 4 == 0)
    return m.select("doc_id", "term", r6("weight").alias("weight"))


# -- the three-field union and the text job --------------------------------------------

def _doc_ads(spark, sf_dir):
    """Documents in the ads shape: description = text, title = a part name,
    params from language and source (param_3 missing)."""
    d = table(spark, sf_dir, "documents")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    n_parts = p.count()
    return d.join(p, p.p_partkey == d.doc_id % F.lit(n_parts), "left").select(
        F.col("doc_id").alias("item_id"), F.col("text").alias("description"),
        F.col("p_name").alias("title"), F.col("lang").alias("param_1"),
        F.col("source").alias("param_2"), F.lit(None).cast("string").alias("param_3"))


DOC_ADS_SQL = """SELECT d.doc_id AS item_id, d.text AS description, p.p_name AS title,
  d.lang AS param_1, d.source AS param_2, CAST(NULL AS VARCHAR) AS param_3
FROM documents d LEFT JOIN part p ON p.p_partkey = d.doc_id % (SELECT count(*) FROM part)"""

PREP_SQL = """SELECT item_id, coalesce(description, 'nan') AS description,
  concat_ws(' ', coalesce(param_1, 'nan'), coalesce(param_2, 'nan'), coalesce(param_3, 'nan')) AS text_feat,
  coalesce(title, 'nan') AS title FROM doc_ads"""


def _union_sql() -> str:
    n = "(SELECT CAST(count(*) AS DOUBLE) FROM prep)"
    ctes = [f"doc_ads AS ({DOC_ADS_SQL})", f"prep AS ({PREP_SQL})",
            "stops0 AS (" + _stops_sql() + ")", "stops AS (SELECT * FROM stops0 WHERE lang = 'en')",
            _grams_sql("prep", "item_id", "description", stop=True, ngram_max=2, lang="'en'", prefix="d_"),
            _grams_sql("prep", "item_id", "text_feat", stop=False, ngram_max=2, min_len=2, prefix="p_"),
            _grams_sql("prep", "item_id", "title", stop=True, ngram_max=2, lang="'en'", prefix="t_")]
    return _with(*ctes) + f""", d_vocab AS (SELECT term, count(*) AS df, sum(tf) AS total FROM d_tf GROUP BY term
  ORDER BY total DESC, term LIMIT 1000),
t_vocab AS (SELECT term, count(*) AS df FROM t_tf GROUP BY term),
d_w AS (SELECT tf.item_id, tf.term, (1 + ln(tf.tf)) * (ln({n} / v.df) + 1) AS w
  FROM d_tf tf JOIN d_vocab v ON tf.term = v.term),
t_w AS (SELECT tf.item_id, tf.term, (1 + ln(tf.tf)) * (ln({n} / v.df) + 1) AS w
  FROM t_tf tf JOIN t_vocab v ON tf.term = v.term)
SELECT item_id, 'description__' || term AS term,
  {r6sql('w / sqrt(sum(w * w) OVER (PARTITION BY item_id))')} AS weight FROM d_w
UNION ALL SELECT item_id, 'text_feat__' || term AS term, CAST(tf AS DOUBLE) AS weight FROM p_tf
UNION ALL SELECT item_id, 'title__' || term AS term,
  {r6sql('w / sqrt(sum(w * w) OVER (PARTITION BY item_id))')} AS weight FROM t_w"""


@query("text_union", "T16 T17 T12 T14", oracle=_union_sql())
def q_text_union(spark, sf_dir):
    _dense, sparse = TX.text_job(_doc_ads(spark, sf_dir), "item_id", language="english",
                                 max_features=1000)
    return sparse.select("item_id", "term", r6("weight").alias("weight"))


def _dense_sql() -> str:
    cols = []
    for f in ("description", "text_feat", "title"):
        w = f"list_filter(regexp_split_to_array(lower({f}), '\\s+'), lambda x: x <> '')"
        cols += [f"CAST(length(lower({f})) AS INTEGER) AS {f}_num_chars",
                 f"CAST(len({w}) AS INTEGER) AS {f}_num_words",
                 f"CAST(len(list_distinct({w})) AS INTEGER) AS {f}_num_unique_words",
                 f"{r6sql(f'100.0 * len(list_distinct({w})) / nullif(len({w}), 0)')} AS {f}_words_vs_unique"]
    return _with(f"doc_ads AS ({DOC_ADS_SQL})", f"prep AS ({PREP_SQL})") + \
        f"SELECT item_id, {', '.join(cols)} FROM prep"


@query("text_job_dense", "T17 T1 T2 T3 T4 T5 P9", oracle=_dense_sql())
def q_text_dense(spark, sf_dir):
    dense, _sparse = TX.text_job(_doc_ads(spark, sf_dir), "item_id", language="english",
                                 max_features=1000)
    return dense.select(*[r6(c).alias(c) if c.endswith("_words_vs_unique") else c for c in dense.columns])


def wrap_ctes(source: str, key: str, width: int = 1000) -> list[tuple[str, str]]:
    """CTEs, the last one ``wrapped(<key>, pieces)``: the greedy wrap as a fold over parts
    with their lengths (breaks after hyphens as far as the tables have them)."""
    text = r"regexp_replace(text, '[^\x{0000}-\x{FFFF}]', '', 'g')"
    broken = rf"regexp_replace({text}, '(\p{{L}}\p{{L}}-)(\p{{L}}-?\p{{L}})', '\1' || chr(1) || chr(32) || '\2', 'g')"
    return [("parts", rf"""SELECT {key}, list_transform(list_filter(regexp_split_to_array({broken}, '\s+'), lambda w: w <> ''),
    lambda w: {{'t': replace(w, chr(1), ''), 'n': CAST(length(replace(w, chr(1), '')) AS BIGINT), 'glued': ends_with(w, chr(1))}}) AS l
  FROM {source}"""), ("wrapped", f"""SELECT {key}, CASE WHEN len(l) = 0 THEN [] ELSE string_split(list_reduce(l, lambda a, w:
    CASE WHEN a.n + CASE WHEN a.glued THEN 0 ELSE 1 END + w.n <= {width}
    THEN {{'t': a.t || CASE WHEN a.glued THEN '' ELSE ' ' END || w.t, 'n': a.n + CASE WHEN a.glued THEN 0 ELSE 1 END + w.n, 'glued': w.glued}}
    ELSE {{'t': a.t || chr(1) || w.t, 'n': w.n, 'glued': w.glued}} END).t, chr(1)) END AS pieces FROM parts""")]


@query("text_wrap", "T8 T7",
       oracle=_with(*(f"{n} AS ({q})" for n, q in wrap_ctes("documents", "doc_id"))) + """
SELECT doc_id, CAST(unnest(range(len(pieces))) AS INT) AS piece_no, unnest(pieces) AS piece FROM wrapped""")
def q_wrap(spark, sf_dir):
    """Pieces of at most 1000 characters."""
    d = table(spark, sf_dir, "documents")
    pieces = T.wrap_pieces(T.drop_astral("text"), 1000)
    return d.select("doc_id", F.posexplode(pieces).alias("piece_no", "piece"))


@query("text_svd", "T18", oracle="SELECT doc_id FROM documents")
def q_svd(spark, sf_dir):
    """3-component truncated SVD of the TF-IDF matrix, one row per document; its
    values are tested against numpy."""
    d = _docs(spark, sf_dir)
    terms = TX.analyzed_terms(F.col("text"), ngram_max=1, language=F.col("lang"))
    m = TX.tfidf(d, "doc_id", terms, sublinear_tf=True, smooth_idf=False, max_features=1000)
    scores, _s = TX.truncated_svd(m, "doc_id", 3, rows_of=d)
    return scores.select("doc_id")


# Two columns have closed forms: the eigenvalues of [[a, b], [b, c]] and, all counts being
# positive, a first vector with two positive parts.
_TWO_SQL = _with(_grams_sql("documents", "doc_id", "text", stop=False, ngram_max=1, min_len=2)) + f""",
vocab AS (SELECT term, row_number() OVER (ORDER BY term) AS k FROM (
  SELECT term FROM tf GROUP BY term ORDER BY sum(tf) DESC, term LIMIT 2)),
x AS (SELECT d.doc_id, CAST(coalesce(sum(tf.tf) FILTER (WHERE k = 1), 0) AS DOUBLE) AS x1,
  CAST(coalesce(sum(tf.tf) FILTER (WHERE k = 2), 0) AS DOUBLE) AS x2
  FROM documents d LEFT JOIN tf ON tf.doc_id = d.doc_id LEFT JOIN vocab USING (term) GROUP BY d.doc_id),
g AS (SELECT sum(x1 * x1) AS a, sum(x1 * x2) AS b, sum(x2 * x2) AS c FROM x),
e AS (SELECT *, (a + c) / 2 + sqrt((a - c) * (a - c) / 4 + b * b) AS l1, (a + c) / 2 - sqrt((a - c) * (a - c) / 4 + b * b) AS l2 FROM g),
v AS (SELECT *, b / sqrt(b * b + (l1 - a) * (l1 - a)) AS p, (l1 - a) / sqrt(b * b + (l1 - a) * (l1 - a)) AS q FROM e)
SELECT doc_id, {r6sql('x1 * p + x2 * q')} AS svd_1,
  {r6sql('CASE WHEN q >= p THEN x1 * q - x2 * p ELSE x2 * p - x1 * q END')} AS svd_2,
  {r6sql('sqrt(l1)')} AS s1, {r6sql('sqrt(l2)')} AS s2 FROM x, v"""


@query("text_svd_values", "T18", oracle=_TWO_SQL)
def q_svd_values(spark, sf_dir):
    """Scores and singular values of the counts of the two most frequent terms."""
    d = _docs(spark, sf_dir)
    m = TX.count_matrix(d, "doc_id", TX.analyzed_terms(F.col("text"), min_token_len=2), max_features=2)
    scores, s = TX.truncated_svd(m, "doc_id", 2, rows_of=d)
    return scores.select("doc_id", r6("svd_1").alias("svd_1"), r6("svd_2").alias("svd_2"),
                         r6(F.lit(s[0])).alias("s1"), r6(F.lit(s[1])).alias("s2"))
