"""Text features in long form (T10-T18): stop words, n-grams, term counts,
vocabularies, TF-IDF, the three-field feature union, the text job and SVD.

A text matrix is a long table ``(row key, [field,] term, value)``, never a
dense matrix. Per-row work (lower-casing, tokenising, stop-word filtering,
n-gram building) is array functions on the row, with no shuffle. The
cross-row statistics are aggregations:

* term counts per row: ``groupBy(row, term)``; documents are repartitioned by
  row key once so that the count, the per-row norm and the weights share one
  partitioning (one exchange of the token stream, not three);
* document frequency and corpus counts: ``groupBy(term)`` with map-side
  partial aggregation (a term in every document is combined before the
  shuffle);
* the vocabulary is joined by term: AQE broadcasts it if its measured size is
  small; else it is joined by shuffle and AQE splits
  hot terms.
"""

from __future__ import annotations

import functools
import glob
import os
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import materialize

# Language codes of the documents and the stop-word list names.
LANGUAGE_NAMES = {"en": "english", "fr": "french", "de": "german", "es": "spanish",
                  "ru": "russian"}


#: Terms of a vocabulary that goes to the tasks.
BROADCAST_TERMS = 200_000


@functools.lru_cache(maxsize=None)
def stop_words(language: str) -> tuple[str, ...]:
    """Spark's bundled default stop-word list for ``language`` (the same list
    ``StopWordsRemover.loadDefaultStopWords`` returns), read from the jar."""
    name = LANGUAGE_NAMES.get(language, language)
    for jar in _mllib_jars():
        with zipfile.ZipFile(jar) as z:
            path = f"org/apache/spark/ml/feature/stopwords/{name}.txt"
            if path in z.namelist():
                return tuple(w for w in z.read(path).decode("utf-8").split() if w)
    from pyspark.ml.feature import StopWordsRemover  # needs a running JVM
    return tuple(StopWordsRemover.loadDefaultStopWords(name))


def _mllib_jars() -> list[str]:
    import pyspark
    roots = [os.environ.get("SPARK_HOME", "")]
    here = os.path.dirname(pyspark.__file__)
    while here and here != os.path.dirname(here):  # walk up out of a zipped copy
        roots.append(here)
        here = os.path.dirname(here)
    for root in roots:
        found = glob.glob(os.path.join(root, "jars", "spark-mllib_*.jar"))
        if found:
            return found
    return []


def _without(tokens: Column, language: str) -> Column:
    """The stop words are a hash set that each token is looked up in."""
    return F.filter(tokens, lambda t: ~t.isin(list(stop_words(language))))


def without_stop_words(tokens: Column, language: str | Column | None,
                       languages: Sequence[str] = ("en", "fr", "de", "es")) -> Column:
    """Drop stop words (duplicates of other words are kept). ``language``
    is a fixed language name/code, or a column of per-row codes."""
    if language is None:
        return tokens
    if isinstance(language, str):
        return _without(tokens, language)
    # the list is chosen once for a row; a code without a list is an error, not a row that
    # keeps its stop words
    kept = F.when(language.isNull(), tokens)
    for code in languages:
        kept = kept.when(language == code, _without(tokens, code))
    return kept.otherwise(F.filter(tokens, lambda t: F.raise_error(
        F.concat(F.lit("no stop words for language "), language)).cast("boolean")))


def _gram_at(tokens: Column, n: int):
    # a one-argument lambda: transform() passes the index too if asked for two
    def at(i):
        return F.concat_ws(" ", *[F.get(tokens, i + k) for k in range(n)])
    return at


def ngrams(tokens: Column, n_max: int = 2, n_min: int = 1) -> Column:
    """All n-grams for n in [n_min, n_max], space-joined, as one array."""
    parts = []
    for n in range(n_min, n_max + 1):
        if n == 1:
            parts.append(tokens)
            continue
        idx = F.sequence(F.lit(0), F.size(tokens) - n)
        gram = F.transform(idx, _gram_at(tokens, n))
        parts.append(F.when(F.size(tokens) >= n, gram).otherwise(F.array().cast("array<string>")))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


@dataclass(frozen=True)
class Analyzer:
    """Token array expression + n-gram range. The tokens are materialised as a
    column before n-grams are built: an n-gram lambda that referred to the
    tokenising expression itself would re-run the regex for every position."""
    tokens: Column
    ngram_max: int = 1

    def apply(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        staged = df.select(*keep, self.tokens.alias("__toks"))
        return staged.select(*keep, ngrams(F.col("__toks"), self.ngram_max).alias("__terms"))


def analyzed_terms(text: Column, *, ngram_max: int = 1, min_token_len: int = 1,
                   language: str | Column | None = None) -> Analyzer:
    """Lower-case, tokenise, drop stop words, build n-grams (the reference's
    vectorizer analyzer)."""
    toks = T.tokens(F.lower(text))
    if min_token_len > 1:
        toks = F.filter(toks, lambda t: F.length(t) >= min_token_len)
    toks = without_stop_words(toks, language)
    return Analyzer(toks, ngram_max)


def term_counts(df: DataFrame, row_key: str, terms: Analyzer | Column,
                partitions: int | None = None) -> DataFrame:
    """``(row_key, term, tf)``. Rows are hash-partitioned by key once;
    the count per (row, term) then needs no further exchange."""
    return _counted(_term_stream(df, row_key, terms, partitions), row_key)


def _term_stream(df: DataFrame, row_key: str, terms: Analyzer | Column, partitions: int | None = None) -> DataFrame:
    """``(row_key, term)`` for every occurrence, partitioned by row."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = df.repartition(n, row_key)
    if isinstance(terms, Analyzer):
        arrays = terms.apply(spread, [row_key])
    else:
        arrays = spread.select(row_key, terms.alias("__terms"))
    # explode_outer + a null filter: with plain explode the optimizer infers
    # ``size(terms) > 0`` and pushes it below the exchange with the whole
    # n-gram expression inlined, re-running the tokenizer per position
    exploded = (arrays.select(row_key, F.explode_outer("__terms").alias("term"))
                .where(F.col("term").isNotNull()))
    return exploded


def _counted(stream: DataFrame, row_key: str, *more: str) -> DataFrame:
    return stream.groupBy(row_key, "term", *more).agg(F.count(F.lit(1)).alias("tf"))


def document_frequency(tf: DataFrame) -> DataFrame:
    """``(term, df, total)``: rows containing the term and its corpus count."""
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))


def top_vocabulary(stats: DataFrame, max_features: int | None) -> DataFrame:
    """The ``max_features`` terms with the largest corpus count (term
    breaks ties); all terms when ``max_features`` is None or <= 0."""
    if not max_features or max_features <= 0:
        return stats
    return stats.orderBy(F.col("total").desc(), F.col("term").asc()).limit(max_features)


def min_df_filter(stats: DataFrame, min_df: int | None) -> DataFrame:
    return stats if not min_df or min_df <= 1 else stats.where(F.col("df") >= min_df)


def _restrict(stream: DataFrame, row_key: str, vocab: DataFrame) -> DataFrame:
    """``(row_key, term, df, tf)`` of the vocabulary's terms. A vocabulary of
    ``BROADCAST_TERMS`` or fewer (counted) goes to the tasks: other terms leave the
    stream before it is counted, and it is not shuffled by term."""
    v = materialize(vocab.select("term", "df"))
    if v.count() <= BROADCAST_TERMS:
        return _counted(stream.join(F.broadcast(v), "term"), row_key, "df")
    return _counted(stream, row_key).join(v, "term")


def tfidf(df: DataFrame, row_key: str, terms: Analyzer | Column, *, sublinear_tf: bool = True,
          smooth_idf: bool = False, max_features: int | None = None,
          min_df: int | None = None, norm: bool = True,
          fit_rows: Column | None = None) -> DataFrame:
    """``(row_key, term, weight)``.

    tf is the raw count or ``1 + ln(count)``; idf is ``ln(n / df) + 1``, or
    ``ln((1 + n) / (1 + df)) + 1`` when smoothed; rows are L2-normalised over
    the kept vocabulary. ``fit_rows`` restricts the rows the vocabulary and
    idf are learnt from (all rows are transformed).
    """
    stream = _term_stream(df, row_key, terms)
    tf = _counted(stream, row_key)
    if fit_rows is not None:
        fit_keys = df.where(fit_rows).select(row_key)
        fit_tf = tf.join(fit_keys, row_key, "left_semi")
        n_docs = df.where(fit_rows).count()
    else:
        fit_tf = tf
        n_docs = df.count()
    stats = min_df_filter(document_frequency(fit_tf), min_df)
    vocab = top_vocabulary(stats, max_features)
    kept = _restrict(stream, row_key, vocab)
    tf_w = (F.lit(1.0) + F.log(F.col("tf"))) if sublinear_tf else F.col("tf").cast("double")
    if smooth_idf:
        idf = F.log((F.lit(1.0) + F.lit(float(n_docs))) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    else:
        idf = F.log(F.lit(float(n_docs)) / F.col("df")) + F.lit(1.0)
    weighted = kept.select(row_key, "term", (tf_w * idf).alias("w"))
    if not norm:
        return weighted.withColumnRenamed("w", "weight")
    # per-row L2 norm: the rows are already partitioned by row key
    norm2 = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(row_key)))
    return weighted.select(row_key, "term", (F.col("w") / norm2).alias("weight"))


def count_matrix(df: DataFrame, row_key: str, terms: Analyzer | Column, min_df: int | None = None,
                 max_features: int | None = None) -> DataFrame:
    """Raw counts ``(row_key, term, weight)`` over the kept vocabulary."""
    stream = _term_stream(df, row_key, terms)
    stats = min_df_filter(document_frequency(_counted(stream, row_key)), min_df)
    vocab = top_vocabulary(stats, max_features)
    return _restrict(stream, row_key, vocab).select(row_key, "term", F.col("tf").cast("double").alias("weight"))


def text_stats(df: DataFrame, row_key: str, fields: Sequence[str], suffix: str = "") -> DataFrame:
    """T1-T5 for each field: characters, words, distinct words and the
    distinct/total ratio * 100 of the lower-cased text (null prints 'nan')."""
    cols = [row_key]
    for f in fields:
        t = T.prepared(f)
        cols += [T.n_chars(t).alias(f"{f}_num_chars{suffix}"),
                 T.n_words(t).alias(f"{f}_num_words{suffix}"),
                 T.n_unique_words(t).alias(f"{f}_num_unique_words{suffix}"),
                 T.unique_ratio(t).alias(f"{f}_words_vs_unique{suffix}")]
    return df.select(*cols)


def feature_union(df: DataFrame, row_key: str, fields: Mapping[str, dict]) -> DataFrame:
    """One long table ``(row_key, term, weight)`` over several text
    fields; each term is prefixed ``<field>__`` so names stay apart. Each field
    spec holds ``kind`` ('tfidf' or 'count') and its options.

    All fields share one partitioning by row, one count of (row, field, term), one of the
    documents per (field, term) and one join with the kept vocabulary; a field's options
    choose among its own terms and weights.
    """
    names = list(fields)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    analyzers = {f: analyzed_terms(F.col(f), ngram_max=spec.get("ngram_max", 1), min_token_len=spec.get("min_token_len", 1),
                                   language=spec.get("language")) for f, spec in fields.items()}
    # tokens are a column before n-grams are built (see ``Analyzer``)
    staged = df.repartition(n, row_key).select(row_key, *[analyzers[f].tokens.alias(f"__{k}") for k, f in enumerate(names)])

    lists = F.array(*[F.struct(F.lit(k).alias("field"), ngrams(F.col(f"__{k}"), analyzers[f].ngram_max).alias("terms"))
                      for k, f in enumerate(names)])
    stream = (staged.select(row_key, F.explode(lists).alias("l")).select(row_key, "l.field", F.explode_outer("l.terms").alias("term"))
              .where(F.col("term").isNotNull()))
    tf = _counted(stream, row_key, "field")

    def counted(rows: DataFrame) -> DataFrame:
        # one row for each different term: the texts are not read again for each field
        return materialize(rows.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total")))

    whole, vocab = None, None
    for k, (f, spec) in enumerate(fields.items()):
        rows = spec.get("fit_rows")
        if rows is None:
            whole = counted(tf) if whole is None else whole
        stats = whole if rows is None else counted(
            tf.where(F.col("field") == k).join(df.where(rows).select(row_key), row_key, "left_semi"))
        stats = stats.where(F.col("field") == k).drop("field")
        kept = top_vocabulary(min_df_filter(stats, spec.get("min_df")), spec.get("max_features"))
        n_docs = (df if rows is None else df.where(rows)).count()
        if spec["kind"] == "count":
            idf = F.lit(1.0)
        elif spec.get("smooth_idf"):
            idf = F.log((F.lit(1.0) + F.lit(float(n_docs))) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
        else:
            idf = F.log(F.lit(float(n_docs)) / F.col("df")) + F.lit(1.0)
        part = kept.select(F.lit(k).alias("field"), "term", idf.alias("idf"))
        vocab = part if vocab is None else vocab.unionByName(part)
    vocab = materialize(vocab)
    if vocab.count() <= BROADCAST_TERMS:
        # counted: other terms leave the stream before it is counted; no shuffle by term
        kept_tf = _counted(stream.join(F.broadcast(vocab), ["field", "term"]), row_key, "field", "idf")
    else:
        kept_tf = tf.join(vocab, ["field", "term"])
    sublinear = [k for k, s_ in enumerate(fields.values()) if s_["kind"] == "tfidf" and s_.get("sublinear_tf", True)]
    normed = [k for k, s_ in enumerate(fields.values()) if s_["kind"] == "tfidf" and s_.get("norm", True)]
    count = F.when(F.col("field").isin(sublinear), F.lit(1.0) + F.log(F.col("tf"))).otherwise(F.col("tf").cast("double"))
    weighted = kept_tf.select(row_key, "field", "term", (count * F.col("idf")).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(row_key, "field")))
    prefix = F.array(*[F.lit(f"{f}__") for f in names])
    return weighted.select(row_key, F.concat(prefix[F.col("field")], "term").alias("term"),
                           F.when(F.col("field").isin(normed), F.col("w") / norm).otherwise(F.col("w")).alias("weight"))


def text_job(df: DataFrame, row_key: str = "item_id", language: str = "russian",
             max_features: int = 18000, suffix: str = ""):
    """The reference's text feature job on an ads-shaped table.

    Returns ``(dense, sparse)``: per-row length statistics of description,
    text_feat (joined params) and title, and the long-form union of a TF-IDF
    on description (1-2 grams, stop words, ``max_features``), raw 1-2 gram
    counts on text_feat and a TF-IDF on title.
    """
    from ..functions import columns as C
    from . import frame as Fr

    prepared = Fr.sentinels_to_null(df, ["param_1", "param_2", "param_3", "description", "title"])
    prepared = prepared.select(
        row_key,
        F.coalesce("description", F.lit("nan")).alias("description"),
        C.join_text("param_1", "param_2", "param_3").alias("text_feat"),
        F.coalesce("title", F.lit("nan")).alias("title"))
    dense = text_stats(prepared, row_key, ["description", "text_feat", "title"], suffix)
    tf_opts = {"sublinear_tf": True, "smooth_idf": False, "ngram_max": 2, "language": language}
    sparse = feature_union(prepared, row_key, {
        "description": {"kind": "tfidf", "max_features": max_features, **tf_opts},
        "text_feat": {"kind": "count", "ngram_max": 2, "min_token_len": 2},
        "title": {"kind": "tfidf", **tf_opts},
    })
    return dense, sparse


#: Numbers of a dense block of matrix entries times components in a task.
_DENSE = 1 << 21
#: Columns whose sums travel as one row.
_COLUMNS = 512


def _products(place: np.ndarray, first: np.ndarray, weight: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Rows of a sparse block (``first``: each row's first entry) times ``v``."""
    out = np.zeros((len(first) - 1, v.shape[1]))
    step = max(1, _DENSE // v.shape[1])
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for a in range(0, len(place), step):
        r = row[a:a + step]
        begin = np.flatnonzero(np.diff(r, prepend=-1))
        out[r[begin]] += np.add.reduceat(v[place[a:a + step]] * weight[a:a + step, None], begin, axis=0)
    return out


def _sparse(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lists = batch.column(1)
    flat = lists.flatten()
    first = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int64)
    return flat.field("place").to_numpy().astype(np.int64), first, flat.field("weight").to_numpy()


def _gram_times(rows: DataFrame, v: np.ndarray) -> np.ndarray:
    """``A' A v`` in one pass: each task multiplies its rows by ``v`` and adds their
    transpose times the result; column blocks of the tasks' sums are added up in tasks."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(v)
    width = v.shape[1]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        total = np.zeros_like(v)
        for batch in batches:
            place, first, weight = _sparse(batch)
            y = _products(place, first, weight, v)
            row = np.repeat(np.arange(len(first) - 1), np.diff(first))
            order = np.argsort(place, kind="stable")
            columns, start = np.unique(place[order], return_index=True)
            total[columns] += _products(row[order], np.append(start, len(order)), weight[order], y)
        for a in range(0, len(v), _COLUMNS):
            part = total[a:a + _COLUMNS]
            if part.any():
                yield pa.RecordBatch.from_pydict({"block": pa.array([a // _COLUMNS], pa.int32()), "sums": pa.array([part.tobytes()], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(raw)
                sums[b] = sums[b] + part if b in sums else part
        for b, part in sums.items():
            yield pa.RecordBatch.from_pydict({"block": pa.array([b], pa.int32()), "sums": pa.array([part.tobytes()], pa.binary())})

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = rows.mapInArrow(multiply, "block int, sums binary").repartition(n, "block").mapInArrow(add, "block int, sums binary")
    out = np.zeros_like(v)
    for r in parts.toLocalIterator():  # the product itself: terms * components numbers
        part = np.frombuffer(r["sums"]).reshape(-1, width)
        out[r["block"] * _COLUMNS:r["block"] * _COLUMNS + len(part)] = part
    shared.destroy()
    return out


def truncated_svd(matrix: DataFrame, row_key: str, k: int, rows_of: DataFrame | None = None, extra: int = 10,
                  tolerance: float = 1e-9, max_passes: int = 60, seed: int = 1):
    """Rank-``k`` truncated SVD of a long-form matrix (no centring), by subspace
    iteration from a random start.

    Rows become sparse lists of entries (one row's terms are grouped: bounded by the
    row's text). A pass gives ``A' A V`` for the ``k + extra`` vectors held; they are made
    orthogonal and multiplied again until the ``k`` singular values settle within
    ``tolerance`` (or ``max_passes``). The driver holds terms times components numbers
    (18 000 terms and 400 components: 60 MB), never a row; scores are a last pass.
    Each component's sign is such that its largest term weight is positive.

    Returns ``(scores DataFrame(row_key, svd_1..k), singular values)``; with
    ``rows_of`` one row for every row key of that table (zeros without terms).
    """
    from ..session import materialize, ship_package
    from .ordinal import with_position

    ship_package(matrix.sparkSession)
    terms = materialize(with_position(matrix.select("term").distinct(), ["term"], "place"))
    n_cols = terms.count()
    rows = materialize(matrix.join(terms, "term").groupBy(F.col(row_key)).agg(
        F.sort_array(F.collect_list(F.struct(F.col("place").cast("int").alias("place"),
                                             F.col("weight").cast("double").alias("weight")))).alias("entries")))
    names = [f"svd_{i + 1}" for i in range(k)]
    found = min(k, n_cols)
    basis, values, right = np.zeros((n_cols, 0)), np.zeros(0), np.zeros((n_cols, 0))
    if n_cols:
        start = np.random.default_rng(seed).normal(size=(n_cols, min(k + extra, n_cols)))
        basis = np.linalg.qr(start)[0]
        for _ in range(max_passes):
            product = _gram_times(rows, basis)
            square, turn = np.linalg.eigh(basis.T @ product)  # the Gram matrix in this subspace
            order = np.argsort(-square)[:found]
            new = np.sqrt(np.maximum(square[order], 0.0))
            right = basis @ turn[:, order]
            settled = len(values) == len(new) and np.all(np.abs(new - values) <= tolerance * max(new[0], 1e-300))
            values = new
            if settled or basis.shape[1] == n_cols:
                break
            basis = np.linalg.qr(product)[0]
        top = right[np.abs(right).argmax(0), np.arange(found)]
        right = right * np.where(top < 0, -1.0, 1.0)
    # fewer terms than components: the rest are zero
    right = np.concatenate((right, np.zeros((n_cols, k - found))), 1)
    shared = matrix.sparkSession.sparkContext.broadcast(right)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = _products(*_sparse(batch), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(y[:, i]) for i in range(y.shape[1]))], [row_key, *names])

    kind = rows.schema[row_key].dataType.simpleString()
    scores = rows.mapInArrow(project, f"`{row_key}` {kind}, " + ", ".join(f"{n} double" for n in names))
    if rows_of is not None:
        scores = rows_of.select(row_key).join(scores, row_key, "left").fillna(0.0, names)
    return scores, [float(x) for x in values] + [0.0] * (k - found)
