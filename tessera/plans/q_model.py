"""Queries: model data work (M2-M13, M15, A32). The relational scorers
(screening, seed search) and RMSE have DuckDB oracles; of tree fits, what SQL can
say is (row counts, bounds, equal reloads), tests check the rest."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import binned as B
from ..operators import frame as Fr
from ..operators import groups as G
from ..operators import leafwise as L
from ..operators import model as M
from ..operators import out_of_fold as O
from ..operators import profile as P
from ..operators import splits as X
from ..operators import text as TX
from ..session import materialize, scratch_path, write_once
from .q_text import _grams_sql
from .q_groups import _feature_sql, _present as _present_features
from .registry import ads, query, r6, r6sql, sql, table

SEED = 1988
CANDIDATES = ["region", "city", "parent_category_name", "category_name", "user_type",
              "image_top_1", "param_1"]
DENSE = ["price", "item_seq_number", "image_top_1", "week", "weekday", "day",
         "reg_mean_dp", "cn_mean_dp", "uty_pcn_mean_dp"]


@query("rmse_group_mean", "A32",
       oracle=sql(f"""SELECT {r6sql('sqrt(avg((a.deal_probability - g.m) * (a.deal_probability - g.m)))')} AS rmse
FROM ads a JOIN (SELECT category_name, avg(deal_probability) AS m FROM ads GROUP BY category_name) g
  ON a.category_name = g.category_name WHERE a.deal_probability IS NOT NULL"""))
def q_rmse(spark, sf_dir):
    a = ads(spark, sf_dir)
    f = G.group_features(a, [G.feature(["category_name"], "deal_probability", "mean")],
                         keep=["deal_probability"])
    return M.rmse(f.where(F.col("deal_probability").isNotNull()), "deal_probability", "cn_mean_dp") \
        .select(r6("rmse").alias("rmse"))


def _hold_sql(key: str, seed_sql: str) -> str:
    return (f"substr(md5(concat(CAST({seed_sql} AS VARCHAR), ':', CAST({key} AS VARCHAR))), 1, 8) "
            f"< '{X.threshold_hex(0.1)}'")


def _screen_sql() -> str:
    ctes = [("l", f"SELECT *, {_hold_sql('item_id', SEED)} AS hold FROM ads WHERE deal_probability IS NOT NULL"),
            ("gm", "SELECT avg(deal_probability) FILTER (WHERE NOT hold) AS g FROM l")]
    parts = []
    for c in CANDIDATES:
        ctes.append((f"m_{c}", f"SELECT {c} AS v, avg(deal_probability) FILTER (WHERE NOT hold) AS m "
                               f"FROM l GROUP BY {c}"))
        parts.append(f"""SELECT '{c}' AS feature,
  sqrt(avg((l.deal_probability - coalesce(m.m, gm.g)) * (l.deal_probability - coalesce(m.m, gm.g)))) AS val
FROM l LEFT JOIN m_{c} m ON l.{c} IS NOT DISTINCT FROM m.v, gm WHERE l.hold""")
    ctes.append(("cand", " UNION ALL ".join(parts)))
    ctes.append(("base", "SELECT sqrt(avg((l.deal_probability - gm.g) * (l.deal_probability - gm.g))) AS base "
                         "FROM l, gm WHERE l.hold"))
    ctes.append(("report", "SELECT feature, val, base, val - base AS diff FROM cand, base"))
    return sql("SELECT feature, " + r6sql("val") + " AS val, " + r6sql("base") + " AS base, "
               + r6sql("diff") + " AS diff FROM report", *ctes)


def _screen(spark, sf_dir):
    a = ads(spark, sf_dir)
    return M.screen_features(a, CANDIDATES, "deal_probability", X.in_fraction("item_id", SEED, 0.1))


def _present(df):
    return df.select("feature", *[r6(c).alias(c) for c in ("val", "base", "diff")])


@query("feature_screen", "M8", oracle=_screen_sql())
def q_screen(spark, sf_dir):
    return _present(_screen(spark, sf_dir))


@query("keep_improving", "M9 P13",
       oracle=_screen_sql().replace("FROM report", "FROM report WHERE diff < 0"))
def q_keep(spark, sf_dir):
    return _present(M.keep_improving(_screen(spark, sf_dir)))


# -- screening all group features ---------------------------------------------------

#: The four families of group statistics: 84 features.
GROUP_FEATURES = (G.family(G.MEAN_KEY_SETS, "deal_probability", "mean") + G.family(G.MEAN_KEY_SETS, "price", "mean")
                  + G.family(G.VAR_KEY_SETS, "deal_probability", "var") + G.family(G.VAR_KEY_SETS, "price", "var"))


def _screen_all_sql() -> str:
    """Bins are places among a feature's rows (ties share one), as the operator cuts them."""
    names = [f.name for f in GROUP_FEATURES]
    masked = (f"SELECT * REPLACE (CASE WHEN {_hold_sql('item_id', SEED)} THEN NULL ELSE deal_probability END "
              "AS deal_probability) FROM ads")
    return sql(f"""SELECT feature, {r6sql('val')} AS val, {r6sql('base')} AS base, {r6sql('val - base')} AS diff FROM (
  SELECT feature, sqrt(sum(s2 - 2 * m * s1 + nh * m * m) / sum(nh)) AS val,
    sqrt(max(g2 - 2 * gm * g1 + gn * gm * gm) / max(gn)) AS base FROM (SELECT *, coalesce(st / nullif(nt, 0), gm) AS m FROM hist, whole) GROUP BY feature)""",
               ("masked", masked), ("feats", _feature_sql(GROUP_FEATURES, base="masked")),
               ("cells", f"SELECT item_id, feature, value FROM (FROM feats UNPIVOT INCLUDE NULLS (value FOR feature IN ({', '.join(names)})))"),
               ("placed", "SELECT item_id, feature, value, CASE WHEN value IS NULL THEN -1 ELSE ((rank() OVER "
                          f"(PARTITION BY feature, value IS NULL ORDER BY value) - 1) * {B.BINS}) // count(value) OVER (PARTITION BY feature) END AS bin FROM cells"),
               ("l", f"SELECT item_id, deal_probability AS y, {_hold_sql('item_id', SEED)} AS hold FROM ads WHERE deal_probability IS NOT NULL"),
               ("hist", "SELECT feature, bin, count(*) FILTER (WHERE NOT hold) AS nt, coalesce(sum(y) FILTER (WHERE NOT hold), 0) AS st, "
                        "count(*) FILTER (WHERE hold) AS nh, coalesce(sum(y) FILTER (WHERE hold), 0) AS s1, "
                        "coalesce(sum(y * y) FILTER (WHERE hold), 0) AS s2 FROM placed JOIN l USING (item_id) GROUP BY feature, bin"),
               ("whole", "SELECT avg(y) FILTER (WHERE NOT hold) AS gm, count(*) FILTER (WHERE hold) AS gn, "
                         "sum(y) FILTER (WHERE hold) AS g1, sum(y * y) FILTER (WHERE hold) AS g2 FROM l"))


def _screen_all(spark, sf_dir):
    """All 84 features, none of which sees a hold-out row's target; six decimals, as
    the feature queries give them, so that equal statistics tie."""
    a = ads(spark, sf_dir)
    hold = X.in_fraction("item_id", SEED, 0.1)
    masked = G.mask_target(a.drop("title"), "deal_probability", hold)
    feats = _present_features(G.group_features(masked, GROUP_FEATURES), GROUP_FEATURES)
    rows = write_once(feats.join(a.select("item_id", F.col("deal_probability").alias("label")), "item_id"), "screen")
    return B.screen(rows, [f.name for f in GROUP_FEATURES], "label", hold, "item_id")


@query("screen_all_features", "M8", oracle=_screen_all_sql())
def q_screen_all(spark, sf_dir):
    return _present(_screen_all(spark, sf_dir))


@query("keep_improving_all", "M9", oracle=_screen_all_sql() + " WHERE val < base")
def q_keep_all(spark, sf_dir):
    return _present(M.keep_improving(_screen_all(spark, sf_dir)))


def _correlation_sql() -> str:
    names = [f.name for f in GROUP_FEATURES]
    place = "CASE {} " + " ".join(f"WHEN '{n}' THEN {k}" for k, n in enumerate(names)) + " END"
    return sql(f"""SELECT col_a, col_b, {r6sql('corr')} AS corr FROM (
  SELECT x.feature AS col_a, y.feature AS col_b,
    CASE WHEN min(x.value) < max(x.value) AND min(y.value) < max(y.value) THEN corr(x.value, y.value) END AS corr
  FROM cells x JOIN cells y ON x.item_id = y.item_id AND x.k <= y.k GROUP BY ALL)""",
               ("feats", _feature_sql(GROUP_FEATURES)),
               ("cells", f"SELECT item_id, feature, value, {place.format('feature')} AS k FROM (FROM feats UNPIVOT (value FOR feature IN ({', '.join(names)})))"))


@query("correlation_all_features", "A28", oracle=_correlation_sql())
def q_correlation_all(spark, sf_dir):
    """All pairs of the 84 group features, pairwise complete."""
    a = ads(spark, sf_dir).drop("title")
    feats = materialize(_present_features(G.group_features(a, GROUP_FEATURES), GROUP_FEATURES))
    return P.correlation_matrix(feats, [f.name for f in GROUP_FEATURES]).withColumn("corr", r6("corr"))


def _seed_sql() -> str:
    seeds = (f"SELECT seed FROM (SELECT DISTINCT o_orderkey AS seed FROM orders) "
             f"ORDER BY {X.hash_sql('seed', 'seeds')}, seed LIMIT 100")
    ctes = [("seeds", seeds),
            ("l", f"SELECT s.seed, a.item_id, a.category_name, a.deal_probability AS y, "
                  f"{_hold_sql('a.item_id', 's.seed')} AS hold "
                  f"FROM ads a, seeds s WHERE a.deal_probability IS NOT NULL"),
            ("gm", "SELECT seed, avg(y) FILTER (WHERE NOT hold) AS g FROM l GROUP BY seed"),
            ("m", "SELECT seed, category_name AS v, avg(y) FILTER (WHERE NOT hold) AS m "
                  "FROM l GROUP BY seed, category_name"),
            ("scored", "SELECT l.seed, sqrt(avg((l.y - coalesce(m.m, gm.g)) * (l.y - coalesce(m.m, gm.g)))) "
                       "AS rmse FROM l JOIN gm ON l.seed = gm.seed LEFT JOIN m ON l.seed = m.seed "
                       "AND l.category_name IS NOT DISTINCT FROM m.v WHERE l.hold GROUP BY l.seed")]
    return sql(f"SELECT seed, {r6sql('rmse')} AS rmse, {r6sql(f'abs(rmse - {M.REFERENCE_RMSE})')} "
               f"AS distance FROM scored", *ctes)


@query("seed_search", "M10 X8 X1", oracle=_seed_sql())
def q_seed_search(spark, sf_dir):
    seeds = [r[0] for r in X.draw_seeds(table(spark, sf_dir, "orders"), "o_orderkey", 100, "seeds").collect()]
    s = M.seed_search(ads(spark, sf_dir), seeds, "item_id", "category_name", "deal_probability")
    return s.select("seed", r6("rmse").alias("rmse"), r6("distance").alias("distance"))


# -- tree models ----------------------------------------------------------------------

TEXT_FEATURES = 200  # terms of the text part of the matrix


#: The target statistics of the design matrix.
TARGET_MEANS = [G.feature(["region"], "deal_probability", "mean"), G.feature(["category_name"], "deal_probability", "mean"),
                G.feature(["user_type", "parent_category_name"], "deal_probability", "mean")]


def _title_weights(a):
    """T14's weights of the titles' 1-2 grams, the vocabulary learnt from the train rows."""
    terms = TX.analyzed_terms(F.col("title"), ngram_max=2)
    return TX.tfidf(a.select("item_id", "title", "split"), "item_id", terms, max_features=TEXT_FEATURES,
                    fit_rows=F.col("split") == "train")


def _with_text(a, rows):
    """``rows`` with the titles' sparse vectors, and their names."""
    out, terms = M.term_vectors(_title_weights(a), "item_id", rows, "text")
    return out, [f"title__{t}" for t in terms]


def _model_table(spark, sf_dir, text=True):
    """The design matrix and the names of its places; the target statistics never see a
    target of the rows that validation scores (``is_valid``)."""
    a = ads(spark, sf_dir)
    hold = X.in_fraction("item_id", SEED, 0.1)
    time_f = Fr.time_features(a)
    masked = G.mask_target(a, "deal_probability", hold)
    feats = G.group_features(masked, TARGET_MEANS)
    base = a.select("item_id", "split", "price", "item_seq_number", "image_top_1", "title",
                    F.col("deal_probability").alias("label"), hold.alias("is_valid"))
    table_ = base.join(time_f, "item_id").join(feats, "item_id")
    terms = []
    if text:
        table_, terms = _with_text(a, table_)
    mat, names = M.design_matrix(table_, DENSE, sparse=["text"] if text else [])
    return mat, names + terms


def _labelled(mat):
    lab = mat.where(F.col("label").isNotNull())
    return lab.where(~F.col("is_valid")), lab.where(F.col("is_valid"))


def _gbt(**kw):
    opts = {"max_iter": 30, "max_depth": 4, "step_size": 0.2, "subsample": 1.0, "max_bins": 64}
    opts.update(kw)
    return M.gbt(**opts)


def _title_sql() -> str:
    """T14 over the titles: vocabulary and frequencies from the train rows."""
    n = "(SELECT CAST(count(*) AS DOUBLE) FROM ads WHERE split = 'train')"
    grams = _grams_sql("ads", "item_id", "title", stop=False, ngram_max=2)
    return sql("").rstrip() + f""", {grams},
vocab AS (SELECT term, count(*) AS df, sum(tf) AS total FROM tf WHERE item_id IN (SELECT item_id FROM ads WHERE split = 'train')
  GROUP BY term ORDER BY total DESC, term LIMIT {TEXT_FEATURES}),
w AS (SELECT tf.item_id, tf.term, (1 + ln(tf.tf)) * (ln({n} / v.df) + 1) AS w FROM tf JOIN vocab v ON tf.term = v.term)
"""


@query("design_matrix", "M2 P7 P14",
       oracle=_title_sql() + f"SELECT item_id, CAST((SELECT count(*) FROM vocab) + {len(DENSE)} AS INT) AS n_features, "
                             f"{r6sql('coalesce(price, -999)')} AS price FROM ads")
def q_design(spark, sf_dir):
    mat, names = _model_table(spark, sf_dir)
    values = vector_to_array("features")
    return mat.select("item_id", F.size(values).alias("n_features"), r6(F.get(values, F.lit(names.index("price")))).alias("price"))


@query("design_matrix_text", "M2 T14",
       oracle=_title_sql() + f"""SELECT item_id, 'title__' || term AS feature,
  {r6sql('w / sqrt(sum(w * w) OVER (PARTITION BY item_id))')} AS value FROM w""")
def q_design_text(spark, sf_dir):
    """The text places of the matrix that are not zero, by name."""
    mat, names = _model_table(spark, sf_dir)
    named = F.array(*[F.lit(n) for n in names])
    cells = mat.select("item_id", F.posexplode(vector_to_array("features")).alias("place", "value"))
    return cells.where((F.col("place") >= len(DENSE)) & (F.col("value") != 0)).select(
        "item_id", named[F.col("place")].alias("feature"), r6("value").alias("value"))


@query("gbt_fit_report", "M3 M5 A32")
def q_fit(spark, sf_dir):
    # a fit reads its rows several times
    train, valid = _labelled(materialize(_model_table(spark, sf_dir)[0].where("label IS NOT NULL")))
    _model, report = M.fit_and_report(spark, "base", train, valid, _gbt(validation_col="is_valid"))
    return report


def _by_user_type(spark, sf_dir, a=None, feature=None):
    """A matrix of the user type's code alone: a deep enough first tree has a leaf for each."""
    a = ads(spark, sf_dir) if a is None else a
    codes = Fr.label_encode(a.select("item_id", "user_type"), ["user_type"]).select("item_id", "user_type_encoded")
    rows = a.select("item_id", "split", F.col("deal_probability").alias("label")).join(codes, "item_id")
    return M.design_matrix(rows, ["user_type_encoded"])[0]


def _first_tree(mat):
    """One tree on the labelled rows: its leaves hold the labels' means."""
    return _gbt(max_iter=1, max_depth=6).fit(mat.where(F.col("label").isNotNull()))


@query("predict_clip", "M3 M4 P11",
       oracle=sql("SELECT item_id, TRUE AS in_bounds FROM ads WHERE split = 'test'"))
def q_predict(spark, sf_dir):
    """Predictions of the test rows by a boosted model of the whole design matrix."""
    mat = materialize(_model_table(spark, sf_dir)[0])
    model = _gbt(max_iter=10).fit(_labelled(mat)[0])
    p = F.col("deal_probability")
    return M.predict_clipped(model, mat.where(F.col("split") == "test"), "item_id") \
        .select("item_id", ((p >= 0) & (p <= 1)).alias("in_bounds"))


@query("fit_report_one_tree", "M3 M5 A32",
       oracle=sql(f"""SELECT 'user_type' AS run, 1 AS num_round,
  {r6sql('sqrt(avg((y - m) * (y - m)) FILTER (WHERE NOT hold))')} AS train,
  {r6sql('sqrt(avg((y - m) * (y - m)) FILTER (WHERE hold))')} AS val
FROM (SELECT deal_probability AS y, {_hold_sql('item_id', SEED)} AS hold, avg(deal_probability) FILTER (WHERE NOT {_hold_sql('item_id', SEED)})
        OVER (PARTITION BY user_type) AS m FROM ads WHERE deal_probability IS NOT NULL)"""))
def q_fit_one(spark, sf_dir):
    """The report of a fit whose errors are those of the user types' means."""
    mat = _by_user_type(spark, sf_dir).where("label IS NOT NULL").withColumn("is_valid", X.in_fraction("item_id", SEED, 0.1))
    train, valid = _labelled(mat)
    _, report = M.fit_and_report(spark, "user_type", train, valid, _gbt(max_iter=1, max_depth=6))
    return report.select("run", "num_round", r6("train").alias("train"), r6("val").alias("val"))


# -- cross-validation -------------------------------------------------------------------

FOLDS = 10
#: Rows of a task of a fit, and of the folds that are fitted at a time.
TASK_ROWS, FLIGHT_ROWS = 50_000, 2_000_000


def _folded(spark, sf_dir):
    """Ads with the contiguous fold of each labelled row."""
    a = ads(spark, sf_dir)
    place = X.contiguous_folds(a.where(F.col("deal_probability").isNotNull()).select("item_id"), ["item_id"], FOLDS)
    return a.join(place, "item_id", "left")


def _out_of_fold_sql() -> str:
    """Total minus part, by window sums."""
    n = "(SELECT count(*) FROM ads WHERE deal_probability IS NOT NULL)"
    fold = (f"CASE WHEN pos < ({n} % {FOLDS}) * ({n} // {FOLDS} + 1) THEN pos // ({n} // {FOLDS} + 1) "
            f"ELSE ({n} % {FOLDS}) + (pos - ({n} % {FOLDS}) * ({n} // {FOLDS} + 1)) // ({n} // {FOLDS}) END")
    cols = []
    for f in TARGET_MEANS:
        keys = ", ".join(f.keys)
        total, part = f"PARTITION BY {keys}", f"PARTITION BY {keys}, fold"
        count = f"(count(deal_probability) OVER ({total}) - count(deal_probability) OVER ({part}))"
        mean = (f"(sum(deal_probability) OVER ({total}) - sum(deal_probability) OVER ({part})) / nullif({count}, 0)")
        present = " AND ".join(f"{k} IS NOT NULL" for k in f.keys)
        cols.append(f"CASE WHEN {present} THEN {r6sql(mean)} END AS {f.name}")
    return sql(f"SELECT item_id, CAST(fold AS INT) AS fold, {', '.join(cols)} FROM l WHERE fold IS NOT NULL",
               ("p", "SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS pos FROM ads WHERE deal_probability IS NOT NULL"),
               ("l", f"SELECT ads.*, {fold} AS fold FROM ads LEFT JOIN p USING (item_id)"))


@query("out_of_fold_means", "M6 A12 X6", oracle=_out_of_fold_sql())
def q_out_of_fold(spark, sf_dir):
    """Each labelled row's target statistics without its own fold."""
    a = _folded(spark, sf_dir)
    stats = O.without_fold(O.fold_statistics(a, TARGET_MEANS, "fold", FOLDS, keep=["fold"]), TARGET_MEANS, F.col("fold"))
    return stats.where(F.col("fold").isNotNull()).select("item_id", "fold", *[r6(f.name).alias(f.name) for f in TARGET_MEANS])


@query("cv_rounds", "M6 X6")
def q_cv(spark, sf_dir):
    """Ten contiguous folds of the labelled rows. All folds' target statistics come from
    one aggregation and sit in one table; a fold's matrix leaves its own part out. Then
    a refit on all labelled rows. The text part has no target; its terms are fitted on
    the rows of the train split."""
    a = _folded(spark, sf_dir)
    stats = O.fold_statistics(a, TARGET_MEANS, "fold", FOLDS)
    base = a.select("item_id", "split", "price", "item_seq_number", "image_top_1", "title", "fold",
                    F.col("deal_probability").alias("label"))
    base = base.join(Fr.time_features(a), "item_id").join(stats, "item_id")
    base = _with_text(a, base)[0]
    held = base.where(F.col("label").isNotNull()).persist()
    n = held.count()
    # a fit is a hundred short stages: tasks of TASK_ROWS rows, two a core at least
    base = held.coalesce(max(2 * spark.sparkContext.defaultParallelism, -(-n // TASK_ROWS)))
    est = _gbt(max_iter=12)

    def matrix(k):
        return M.design_matrix(O.without_fold(base, TARGET_MEANS, k), DENSE, sparse=["text"])[0]

    def tables():
        for k in range(FOLDS):
            mat = matrix(k)
            yield mat.where(F.col("fold") != k), mat.where(F.col("fold") == k)

    # small folds leave cores idle between stages: several at a time, as far as their rows fit
    best, curve = M.cv_rounds(tables(), est, parallelism=min(4, max(1, FLIGHT_ROWS // max(n, 1))))
    whole = matrix(FOLDS)
    final = M.refit(whole, est, best)
    error = M.rmse(final.transform(whole), "label", "prediction").first()[0]
    held.unpersist()
    rows = [(i + 1, float(v), i + 1 == best, float(error) if i + 1 == best else None) for i, v in enumerate(curve)]
    return spark.createDataFrame(rows, "round int, mean_error double, best boolean, refit_rmse double")


def _root_gain_sql() -> str:
    """For each feature the largest drop of the squared error by one cut of its bins,
    missing values on either side, with 20 rows on both."""
    names = [*DENSE[:6], *(f.name for f in GROUP_FEATURES)]
    masked = (f"SELECT * REPLACE (CASE WHEN {_hold_sql('item_id', SEED)} THEN NULL ELSE deal_probability END "
              "AS deal_probability) FROM ads")
    dense = ("SELECT item_id, price, CAST(item_seq_number AS DOUBLE) AS item_seq_number, CAST(image_top_1 AS DOUBLE) AS image_top_1, "
             "CAST(week(activation_date) AS DOUBLE) AS week, CAST((dayofweek(activation_date) + 6) % 7 AS DOUBLE) AS weekday, "
             "CAST(day(activation_date) AS DOUBLE) AS day FROM ads")
    return sql(f"""SELECT feature, {r6sql('max(gain)')} AS gain FROM (
  SELECT feature, ls * ls / ln + (s - ls) * (s - ls) / (n - ln) - s * s / n AS gain FROM (
    SELECT feature, n, s, side * mn + cn AS ln, side * ms + cs AS ls FROM sums, (VALUES (0), (1)) v(side))
  WHERE ln >= 20 AND n - ln >= 20) GROUP BY feature""",
               ("masked", masked), ("feats", _feature_sql(GROUP_FEATURES, base="masked")), ("dense", dense),
               ("wide", "SELECT * FROM dense JOIN feats USING (item_id)"),
               ("cells", f"SELECT item_id, feature, value FROM (FROM wide UNPIVOT INCLUDE NULLS (value FOR feature IN ({', '.join(names)})))"),
               ("placed", "SELECT item_id, feature, CASE WHEN value IS NULL THEN -1 ELSE ((rank() OVER "
                          f"(PARTITION BY feature, value IS NULL ORDER BY value) - 1) * {B.BINS}) // count(value) OVER (PARTITION BY feature) END AS bin FROM cells"),
               ("l", f"SELECT item_id, deal_probability AS label FROM ads WHERE deal_probability IS NOT NULL AND NOT {_hold_sql('item_id', SEED)}"),
               ("m", "SELECT avg(label) AS m FROM l"),
               ("hist", "SELECT feature, bin, count(*) AS c, sum(label - m) AS r FROM placed JOIN l USING (item_id), m GROUP BY feature, bin"),
               ("sums", """SELECT feature, sum(c) OVER f AS n, sum(r) OVER f AS s, coalesce(sum(CASE WHEN bin < 0 THEN c END) OVER f, 0) AS mn,
  coalesce(sum(CASE WHEN bin < 0 THEN r END) OVER f, 0) AS ms, CASE WHEN bin < 0 THEN 0 ELSE sum(CASE WHEN bin >= 0 THEN c ELSE 0 END) OVER o END AS cn,
  CASE WHEN bin < 0 THEN 0 ELSE sum(CASE WHEN bin >= 0 THEN r ELSE 0 END) OVER o END AS cs
  FROM hist WINDOW f AS (PARTITION BY feature), o AS (PARTITION BY feature ORDER BY bin)"""))


# -- leaf-limited trees on binned features ---------------------------------------------

def _binned_rows(spark, sf_dir):
    """The labelled rows' dense columns and all group features as bins, with ``label``
    and ``is_valid``; no feature sees a validation row's target."""
    a = ads(spark, sf_dir)
    hold = X.in_fraction("item_id", SEED, 0.1)
    masked = G.mask_target(a, "deal_probability", hold)
    names = [*DENSE[:6], *(f.name for f in GROUP_FEATURES)]
    rows = (a.select("item_id", "price", "item_seq_number", "image_top_1", F.col("deal_probability").alias("label"), hold.alias("is_valid"))
            .join(Fr.time_features(a), "item_id")
            .join(_present_features(G.group_features(masked, GROUP_FEATURES), GROUP_FEATURES), "item_id"))
    rows = write_once(rows.select("item_id", "label", "is_valid", *names), "binned")
    cuts = B.cut_points(rows, names)
    return materialize(B.bin_matrix(rows.where("label IS NOT NULL"), names, cuts, ["item_id", "label", "is_valid"])), names, cuts


@query("param_sweep", "M7")
def q_sweep(spark, sf_dir):
    """A boosted model for each (leaves, depth) of the sweep, grown best-first in shared
    passes."""
    matrix, names, _ = _binned_rows(spark, sf_dir)
    models = L.fit(matrix.where("NOT is_valid"), len(names), "label", M.SWEEP, rounds=4, rate=0.3)
    return L.report(matrix, models, len(names), "label", "is_valid")


@query("histogram_split_gains", "M7", oracle=_root_gain_sql())
def q_root_gains(spark, sf_dir):
    """The best cut of the whole table in each feature: what the first split is chosen from."""
    matrix, names, _ = _binned_rows(spark, sf_dir)
    return L.root_gains(matrix.where("NOT is_valid"), names, "label").select("feature", r6("gain").alias("gain"))


# The reference's lists of group features, by what their screening said.
PREDICTORS_GOOD = [
    "cty_uty_pcn_cn_mean_dp", "reg_uty_pcn_cn_mean_dp", "cty_pcn_cn_mean_dp", "uty_cn_mean_dp", "cty_uty_pcn_mean_dp",
    "cty_pcn_mean_dp", "reg_pcn_mean_dp", "reg_uty_pcn_mean_dp", "cty_mean_dp", "cty_uty_mean_dp", "reg_pcn_cn_mean_dp",
    "reg_uty_mean_dp"]
PREDICTORS_NOTCHECKED = [
    "cn_mean_dp", "pcn_cn_mean_dp", "pcn_mean_dp", "reg_mean_dp", "uty_mean_dp", "uty_pcn_cn_mean_dp", "uty_pcn_mean_dp"]
PREDICTORS_OVERFIT = ["uid_cn_mean_dp", "uid_mean_dp", "uid_pcn_cn_mean_dp", "uid_pcn_mean_dp"]
PREDICTORS_TRY = [
    "uid_cn_mean_pr", "cty_pcn_var_pr", "uty_pcn_cn_mean_dp", "cty_uty_pcn_cn_var_pr", "uty_cn_var_dp", "cty_uty_var_pr",
    "cty_pcn_cn_var_pr", "pcn_cn_mean_dp", "uid_pcn_mean_pr", "uty_cn_mean_dp", "cty_mean_dp", "cn_mean_dp",
    "reg_pcn_mean_pr", "cty_uty_mean_dp", "pcn_var_dp", "uty_pcn_cn_var_dp", "cty_uty_pcn_var_pr", "cty_pcn_mean_pr",
    "cty_uty_pcn_cn_mean_pr"]
#: Option: the group features beside the base columns.
OPTIONS = {0: [], 1: PREDICTORS_GOOD, 2: PREDICTORS_NOTCHECKED, 3: PREDICTORS_OVERFIT, 4: PREDICTORS_TRY,
           5: PREDICTORS_GOOD + PREDICTORS_TRY}


@query("ablation_options", "M11 M3 M5")
def q_ablation(spark, sf_dir):
    """A boosted model for each list of features, all grown in the same passes over one
    binned matrix, with its validation RMSE."""
    matrix, names, _ = _binned_rows(spark, sf_dir)
    table_ = M.option_table(spark, DENSE[:6], {k: (v, 0) for k, v in OPTIONS.items()}).drop("text_limit")
    lists = [[names.index(c) for c in dict.fromkeys(DENSE[:6] + OPTIONS[k])] for k in sorted(OPTIONS)]
    models = L.fit(matrix.where("NOT is_valid"), len(names), "label", [(15, 7)] * len(lists), rounds=6, rate=0.3, allowed=lists)
    scores = L.report(matrix, models, len(names), "label", "is_valid", numbered=True)
    return (table_.join(scores, F.col("option") == F.col("model"))
            .select("option", F.array_join("features", ",").alias("features"), "num_round", "train", "val"))


@query("top_importances", "M12")
def q_importances(spark, sf_dir):
    """The most important places of the matrix, text terms by name."""
    mat, names = _model_table(spark, sf_dir)
    model = _gbt(max_iter=10).fit(_labelled(mat)[0])
    return M.top_importances(model, names, spark, 50)


@query("shuffled_column", "M12",
       oracle=sql(f"""WITH given AS (SELECT price, row_number() OVER (ORDER BY md5(concat('{SEED}:', CAST(item_id AS VARCHAR))), item_id) AS p FROM ads),
placed AS (SELECT item_id, city, row_number() OVER (ORDER BY item_id) AS p FROM ads)
SELECT item_id, city, price FROM placed JOIN given USING (p)""").replace("\nWITH given", ",\ngiven", 1))
def q_shuffled(spark, sf_dir):
    """A column dealt out anew, as a permutation importance needs it."""
    a = ads(spark, sf_dir).select("item_id", "city", "price")
    return M.shuffled(a, "price", "item_id", SEED)


@query("permutation_importances", "M12")
def q_permutation(spark, sf_dir):
    """By how much the error of a fitted model rises when a column is dealt out anew;
    ``noise`` (a hash of the key) tells what chance gives."""
    a = ads(spark, sf_dir).drop("title")
    noise = F.pmod(F.xxhash64("item_id"), F.lit(1000)).cast("double").alias("noise")
    stats = G.group_features(G.mask_target(a, "deal_probability", X.in_fraction("item_id", SEED, 0.1)), TARGET_MEANS)
    columns = ["price", "item_seq_number", "noise", *(f.name for f in TARGET_MEANS)]
    rows = a.where("deal_probability IS NOT NULL").select("item_id", "price", "item_seq_number", noise, F.col("deal_probability").alias("label"))
    rows = materialize(rows.join(stats, "item_id").select("item_id", "label", *[F.col(c).cast("double").alias(c) for c in columns]))
    model = _gbt(max_iter=8, max_depth=3).fit(M.design_matrix(rows, columns)[0])
    return M.permutation_importances(rows, columns, "item_id", "label", lambda df: model.transform(M.design_matrix(df, columns)[0]))


@query("model_save_load", "M13",
       oracle=sql("SELECT count(*) AS n_rows, count(*) FILTER (WHERE split IS NULL) AS n_diff FROM ads WHERE split = 'test'"))
def q_save(spark, sf_dir):
    """Predictions of a boosted model and of the same model saved and loaded, compared
    row by row."""
    mat = materialize(_model_table(spark, sf_dir, text=False)[0])
    model = _gbt(max_iter=10).fit(_labelled(mat)[0])
    loaded = M.save_model(model, scratch_path(spark, "model"))
    test = mat.where(F.col("split") == "test")
    return M.tables_equal(M.predict_clipped(model, test, "item_id"), M.predict_clipped(loaded, test, "item_id"))


@query("replica_check", "M15 S6 S7",
       oracle=sql(f"""SELECT a.item_id, {r6sql('g.m')} AS reg_mean_dp, {r6sql('p.m')} AS inline, {r6sql('p.m')} AS replica
FROM ads a JOIN (SELECT region, avg(deal_probability) AS m FROM ads GROUP BY region) g ON a.region = g.region
JOIN (SELECT r, avg(deal_probability) AS m FROM (SELECT {r6sql('avg(deal_probability) OVER (PARTITION BY region)')} AS r, deal_probability FROM ads)
  GROUP BY r) p ON p.r = {r6sql('g.m')} WHERE a.split = 'test'"""))
def q_replica(spark, sf_dir):
    """The same matrix built inline and from the feature store, a model trained on each:
    predictions of the test rows side by side."""
    from ..sources import io
    a = ads(spark, sf_dir).select("item_id", "region", "split", "deal_probability")
    feats = [G.feature(["region"], "deal_probability", "mean")]
    inline = G.group_features(a, feats).select("item_id", r6("reg_mean_dp").alias("reg_mean_dp"))
    store = scratch_path(spark, "replica")
    io.store_add(inline, store)
    stored, _ = io.store_read(spark, store, ["reg_mean_dp"], a.select("item_id"))
    sides = []
    for name, table_ in (("inline", inline), ("replica", stored)):
        rows = a.select("item_id", "split", F.col("deal_probability").alias("label")).join(table_, "item_id")
        mat = M.design_matrix(rows, ["reg_mean_dp"])[0]
        p = M.predict_clipped(_first_tree(mat), mat.where(F.col("split") == "test"), "item_id", name)
        sides.append(p.select("item_id", r6(name).alias(name)))
    return stored.join(sides[0], "item_id").join(sides[1], "item_id").select("item_id", "reg_mean_dp", "inline", "replica")
