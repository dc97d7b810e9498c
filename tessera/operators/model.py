"""Model data work (M2-M13, M15, A32): design matrices, boosted trees with
validation-based early stopping, scoring, run reports, cross-validated round
choice, parameter sweeps, feature screening and split-seed search.

Screening and seed search use a relational scorer (predict a hold-out row
by its group's training mean, falling back to the global training mean): it
needs only per-(run, group, part) sums of n, y and y^2, so all candidates or
all seeds are scored in ONE aggregation, combined map-side, with no join
back to the rows.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..functions.columns import clip
from .splits import in_fraction

# Fixed values: (num_leaves, max_depth) pairs of the reference's sweep, largest first.
# Spark's own trees are limited by depth (30 at most); ``leafwise`` grows trees with a
# limit of leaves.
SWEEP = [(128, 64), (63, 31), (31, 15), (15, 7), (9, 4), (7, 3)]
MAX_DEPTH = 30  # Spark's limit
REFERENCE_RMSE = 0.2300  # fixed value: target score of the seed search


def rmse(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Root mean squared error (one row)."""
    d = F.col(label) - F.col(prediction)
    return df.agg(F.sqrt(F.avg(d * d)).alias("rmse"))


def term_vectors(weights: DataFrame, row_key: str, rows: DataFrame, output: str) -> tuple[DataFrame, list[str]]:
    """``rows`` with the sparse vector ``output`` of each row's terms in the long table
    ``weights`` (``row_key, term, weight``: a TF-IDF, counts, or a union of them), and the
    terms in the order of the vector's places. A row without terms gets an empty vector.

    The names come to the driver, as a model of these columns does; their number is the
    vocabulary's, which ``max_features`` bounds. A row's terms meet in one place, bounded
    by its text.
    """
    from ..session import materialize
    from .ordinal import with_position

    weights = materialize(weights.select(row_key, "term", "weight"))
    places = materialize(with_position(weights.select("term").distinct(), ["term"], "place"))
    terms = [r["term"] for r in places.orderBy("place").collect()]
    entries = weights.join(places, "term").groupBy(row_key).agg(
        F.sort_array(F.collect_list(F.struct(F.col("place").cast("int").alias("place"), "weight"))).alias("entries"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten()
            n = batch.num_rows
            vector = pa.StructArray.from_arrays([
                pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, len(terms), np.int32)),
                pa.ListArray.from_arrays(_offsets(lists), flat.field("place")),
                pa.ListArray.from_arrays(_offsets(lists), flat.field("weight"))], ["type", "size", "indices", "values"])
            yield pa.RecordBatch.from_arrays([batch.column(0), vector], [row_key, output])

    def _offsets(lists: pa.ListArray) -> pa.Array:
        return pa.array(np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))), pa.int32())

    schema = StructType([StructField(row_key, rows.schema[row_key].dataType), StructField(output, VectorUDT())])
    none = F.array().cast("array<struct<place:int,weight:double>>")
    filled = rows.select(row_key).join(entries, row_key, "left").select(row_key, F.coalesce("entries", none).alias("entries"))
    # the places' names travel with the column (the assembler and the models keep them)
    named = {"ml_attr": {"num_attrs": len(terms), "attrs": {"numeric": [{"idx": k, "name": t} for k, t in enumerate(terms)]}}}
    vectors = filled.mapInArrow(work, schema).withMetadata(output, named)
    return rows.join(vectors, row_key), terms


def design_matrix(df: DataFrame, dense: Sequence[str], fill: float = -999.0, output: str = "features",
                  sparse: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """M2: fill missing values (Spark trees have no missing-value branch) and
    assemble the dense columns and the ``sparse`` vector columns into one vector;
    returns the names of the dense columns."""
    filled = df.fillna({c: fill for c in dense})
    asm = VectorAssembler(inputCols=[*dense, *sparse], outputCol=output, handleInvalid="keep")
    return asm.transform(filled.withColumns({c: F.col(c).cast("double") for c in dense})), list(dense)


def gbt(label: str = "label", features: str = "features", *, max_iter: int = 100,
        max_depth: int = 5, step_size: float = 0.1, subsample: float = 0.8,
        feature_subset: str = "all", max_bins: int = 64, validation_col: str | None = None,
        validation_tol: float = 0.001, seed: int = 1988) -> GBTRegressor:
    """M3: boosted regression trees; with ``validation_col`` training stops
    when the validation error stops improving. Depths over 30 cannot be built."""
    if max_depth > MAX_DEPTH:
        raise ValueError(f"Spark trees have at most {MAX_DEPTH} levels, not {max_depth}")
    est = GBTRegressor(labelCol=label, featuresCol=features, maxIter=max_iter,
                       maxDepth=max_depth, stepSize=step_size, subsamplingRate=subsample,
                       featureSubsetStrategy=feature_subset, maxBins=max_bins, seed=seed)
    if validation_col:
        est = est.setValidationIndicatorCol(validation_col)
        est.set(est.validationTol, validation_tol)
    return est


def predict_clipped(model: GBTRegressionModel, df: DataFrame, key: str,
                    name: str = "deal_probability") -> DataFrame:
    """M4: predictions bounded to [0, 1]."""
    return model.transform(df).select(key, clip(F.col("prediction")).alias(name))


def fit_and_report(spark, run: str, train: DataFrame, valid: DataFrame, est: GBTRegressor,
                   label: str = "label") -> tuple[GBTRegressionModel, DataFrame]:
    """M3 + M5: fit, then one report row: run, minutes, rounds, train and
    validation RMSE."""
    t0 = time.time()
    model = est.fit(train.unionByName(valid) if est.isSet("validationIndicatorCol") else train)
    minutes = (time.time() - t0) / 60.0
    tr = rmse(model.transform(train), label, "prediction").first()[0]
    va = rmse(model.transform(valid), label, "prediction").first()[0]
    report = spark.createDataFrame(
        [(run, float(minutes), int(model.getNumTrees), float(tr), float(va))],
        "run string, minutes double, num_round int, train double, val double")
    return model, report


def cv_rounds(folds: Iterable[tuple[DataFrame, DataFrame]], est: GBTRegressor,
              parallelism: int = 1) -> tuple[int, list[float]]:
    """M6: for each fold's (train, scored) tables, fit on the one and record the
    error on the other after every round; the best round count minimises the
    mean error. The tables of a fold must not carry its scored targets in their
    features. ``parallelism`` folds are fitted at a time (as ``CrossValidator`` does)."""
    def curve(tables: tuple[DataFrame, DataFrame]) -> list[float]:
        train, scored = tables
        return est.copy().fit(train).evaluateEachIteration(scored, "squared")

    folds = list(folds)
    with ThreadPool(min(parallelism, len(folds))) as pool:
        curves = pool.map(inheritable_thread_target(folds[0][0].sparkSession)(curve), folds, chunksize=1)
    n = min(len(c) for c in curves)
    mean = [sum(c[i] for c in curves) / len(curves) for i in range(n)]
    best = min(range(n), key=lambda i: mean[i]) + 1
    return best, mean


def refit(df: DataFrame, est: GBTRegressor, rounds: int) -> GBTRegressionModel:
    """M6: the final fit on all labelled rows with the chosen number of rounds."""
    return est.copy({est.maxIter: rounds}).fit(df)


def shuffled(df: DataFrame, column: str, row_key: str, seed: int = 1988) -> DataFrame:
    """``df`` with the values of ``column`` dealt out anew: the row at a place in key order
    gets the value of the row at that place in hash order (ends in a bijection, whatever
    the number of tasks)."""
    from .ordinal import with_position

    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col(row_key).cast("string")))
    given = with_position(df.select(row_key, column, digest.alias("__hash")), ["__hash", row_key], "__place")
    places = with_position(df.select(row_key), [row_key], "__place")
    dealt = places.join(given.select("__place", column), "__place").drop("__place")
    return df.drop(column).join(dealt, row_key).select(*df.columns)


def permutation_importances(df: DataFrame, columns: Sequence[str], row_key: str, label: str,
                            predicted: Callable[[DataFrame], DataFrame], seed: int = 1988) -> DataFrame:
    """By how much the RMSE rises when a column's values are dealt out anew:
    ``feature, rmse, rise``, for each column alone. ``predicted`` adds ``prediction``."""
    base = rmse(predicted(df), label, "prediction").first()[0]
    rows = [(c, rmse(predicted(shuffled(df, c, row_key, seed)), label, "prediction").first()[0]) for c in columns]
    return df.sparkSession.createDataFrame([(c, float(e), float(e - base)) for c, e in rows],
                                           "feature string, rmse double, rise double")


def top_importances(model: GBTRegressionModel, names: Sequence[str], spark, k: int = 50) -> DataFrame:
    """The ``k`` most important features (name breaks ties)."""
    imp = model.featureImportances.toArray()
    rows = [(names[i], float(imp[i])) for i in range(len(names))]
    return spark.createDataFrame(rows, "feature string, importance double") \
        .orderBy(F.col("importance").desc(), "feature").limit(k)


# -- relational scorer ---------------------------------------------------------------

def _group_mean_rmse(sums: DataFrame, run_cols: Sequence[str]) -> DataFrame:
    """From per (run, group) sums of train (nt, st) and hold-out (nh, s1, s2)
    rows: RMSE of predicting hold-out rows by the group's training mean, or the
    run's global training mean when the group has no training rows."""
    run_cols = list(run_cols)
    glob = sums.groupBy(*run_cols).agg((F.sum("st") / F.sum("nt")).alias("gm"))
    j = sums.join(glob, run_cols)
    m = F.when(F.col("nt") > 0, F.col("st") / F.col("nt")).otherwise(F.col("gm"))
    sse = F.col("s2") - F.lit(2.0) * m * F.col("s1") + F.col("nh") * m * m
    return j.groupBy(*run_cols).agg(F.sqrt(F.sum(sse) / F.sum("nh")).alias("rmse"))


def _sums(rows: DataFrame, run_cols: Sequence[str], group: str | Column, label: str,
          holdout: Column) -> DataFrame:
    y = F.col(label)
    t = ~holdout
    return rows.groupBy(*run_cols, group).agg(
        F.count_if(t).alias("nt"), F.sum(F.when(t, y).otherwise(0.0)).alias("st"),
        F.count_if(holdout).alias("nh"), F.sum(F.when(holdout, y).otherwise(0.0)).alias("s1"),
        F.sum(F.when(holdout, y * y).otherwise(0.0)).alias("s2"))


def screen_features(df: DataFrame, candidates: Sequence[str], label: str, holdout: Column,
                    base: str | None = None) -> DataFrame:
    """M8: score the base grouping (``base``, or the global mean when None)
    and base + each candidate with the relational scorer; ``diff = val -
    base``. One pass: each row is unpivoted once per candidate (a fixed,
    small list) and summed map-side."""
    from pyspark.sql import Window

    labelled = df.where(F.col(label).isNotNull()).withColumn("__hold", holdout)
    base_expr = f"CAST(`{base}` AS STRING)" if base else "'all'"
    names = ["__base__", *candidates]
    stack = ", ".join(["'__base__', CAST(NULL AS STRING)"]
                      + [f"'{c}', CAST(`{c}` AS STRING)" for c in candidates])
    long = labelled.selectExpr(f"stack({len(names)}, {stack}) AS (feature, value)",
                               f"{base_expr} AS __base", f"`{label}`", "__hold")
    # a candidate's group = (base group, candidate value); nulls form a group
    grp = F.concat_ws("\u0001", F.coalesce(F.col("__base"), F.lit("\u0000")),
                      F.coalesce(F.col("value"), F.lit("\u0000")))
    sums = _sums(long.withColumn("__g", grp), ["feature"], "__g", label, F.col("__hold"))
    scored = _group_mean_rmse(sums, ["feature"])
    # the scored table has one row per candidate: a global window is tiny
    base_rmse = F.max(F.when(F.col("feature") == "__base__", F.col("rmse"))).over(Window.partitionBy())
    return (scored.withColumn("base", base_rmse).where(F.col("feature") != "__base__")
            .select("feature", F.col("rmse").alias("val"), "base",
                    (F.col("rmse") - F.col("base")).alias("diff")))


def keep_improving(report: DataFrame) -> DataFrame:
    """M9: features whose screening difference is negative."""
    return report.where(F.col("diff") < 0)


def seed_search(df: DataFrame, seeds: Sequence[int], key: str, group: str, label: str,
                fraction: float = 0.1, reference: float = REFERENCE_RMSE) -> DataFrame:
    """For each seed, hold out a seeded ``fraction`` by key hash, score
    with the relational scorer and report the distance to the reference
    score. The seed list is small and fixed in size (it comes from
    ``draw_seeds``), so each row is expanded once per seed and summed
    map-side: one job for all seeds."""
    seed_arr = F.array(*[F.lit(int(s)).cast("long") for s in seeds])
    rows = df.where(F.col(label).isNotNull()).select(key, group, label, F.explode(seed_arr).alias("seed"))
    hold = F.substring(F.md5(F.concat(F.col("seed").cast("string"), F.lit(":"),
                                      F.col(key).cast("string"))), 1, 8) < F.lit(
        format(int(round(fraction * 16 ** 8)), "08x"))
    sums = _sums(rows, ["seed"], F.coalesce(F.col(group).cast("string"), F.lit("\u0000")).alias("__g"),
                 label, hold)
    scored = _group_mean_rmse(sums, ["seed"])
    return scored.select("seed", "rmse", F.abs(F.col("rmse") - F.lit(reference)).alias("distance"))


def option_table(spark, base: Sequence[str], options: dict[int, tuple[list[str], int]]) -> DataFrame:
    """Ablation options: option id, feature list, text vocabulary limit."""
    rows = [(k, list(base) + list(v[0]), int(v[1])) for k, v in sorted(options.items())]
    return spark.createDataFrame(rows, "option int, features array<string>, text_limit int")


def save_model(model: GBTRegressionModel, path: str) -> GBTRegressionModel:
    """Save and load back."""
    model.write().overwrite().save(path)
    return GBTRegressionModel.load(path)


def tables_equal(a: DataFrame, b: DataFrame) -> DataFrame:
    """Row count and number of differing rows (either side) as one row."""
    diff = a.exceptAll(b).unionByName(b.exceptAll(a))
    n_rows, n_diff = a.count(), diff.count()
    return a.sparkSession.createDataFrame([(n_rows, n_diff)], "n_rows long, n_diff long")


def in_holdout(key: str, seed: int, fraction: float) -> Column:
    return in_fraction(key, seed, fraction)

