"""Queries: profiles (A19-A32), overlaps (J8), first/last and top-k (L1-L3),
distinct sets (U4), positions (W4) and positional splits (X4-X9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as P
from ..operators import splits as X
from .registry import ads, query, r6, r6sql, sql, table

SEED = 1988


@query("distinct_first_seen", "A19",
       oracle=sql("SELECT title, min(item_id) AS first_seen FROM ads GROUP BY title"))
def q_first_seen(spark, sf_dir):
    return P.distinct_first_seen(ads(spark, sf_dir), "title", "item_id")


@query("value_counts", "A20",
       oracle=sql("SELECT region, count(*) AS n FROM ads GROUP BY region"))
def q_value_counts(spark, sf_dir):
    return P.value_counts(ads(spark, sf_dir), "region")


@query("percent_share", "A21",
       oracle=sql(f"""SELECT parent_category_name, count(*) AS n,
  {r6sql('count(*) * 100.0 / (SELECT count(*) FROM ads)')} AS pct FROM ads GROUP BY parent_category_name"""))
def q_share(spark, sf_dir):
    s = P.percent_share(ads(spark, sf_dir), "parent_category_name")
    return s.withColumn("pct", r6("pct"))


@query("describe_price", "A22",
       oracle=sql(f"""SELECT 'price' AS column_name, count(price) AS count,
  {r6sql('avg(price) / 1000')} AS mean, {r6sql('stddev_samp(price) / 1000')} AS std,
  {r6sql('min(price) / 1000')} AS min, {r6sql('quantile_cont(price, 0.25) / 1000')} AS p25,
  {r6sql('quantile_cont(price, 0.5) / 1000')} AS p50, {r6sql('quantile_cont(price, 0.75) / 1000')} AS p75,
  {r6sql('max(price) / 1000')} AS max FROM ads"""))
def q_describe(spark, sf_dir):
    d = P.describe(ads(spark, sf_dir), "price")
    return d.select("column_name", "count",
                    *[r6(F.col(c) / 1000).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


_PROFILE_COLS = ["item_id", "user_id", "region", "param_1", "param_2", "param_3", "description",
                 "price", "user_type", "image_top_1", "deal_probability"]


@query("table_profile", "A23",
       oracle=sql(" UNION ALL ".join(
           f"SELECT '{c}' AS column_name, CASE typeof(any_value({c})) WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' "
           f"ELSE lower(typeof(any_value({c}))) END AS data_type, count({c}) AS non_null, count(*) AS n_rows FROM ads"
           for c in _PROFILE_COLS)))
def q_profile(spark, sf_dir):
    prof = P.table_profile(ads(spark, sf_dir, text=True).select(*_PROFILE_COLS))
    return prof.select("column_name", "data_type", "non_null", "n_rows")


@query("null_counts", "A24",
       oracle=sql(" UNION ALL ".join(
           f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null FROM ads" for c in _PROFILE_COLS)))
def q_nulls(spark, sf_dir):
    return P.null_counts(ads(spark, sf_dir, text=True), _PROFILE_COLS)


@query("any_null_share", "A25",
       oracle=sql(f"""SELECT user_type, {r6sql('100.0 * avg(CASE WHEN price IS NULL OR description IS NULL '
                                                'THEN 1.0 ELSE 0.0 END)')} AS pct_missing FROM ads GROUP BY user_type"""))
def q_any_null(spark, sf_dir):
    s = P.any_null_share(ads(spark, sf_dir, text=True), ["price", "description"], by=["user_type"])
    return s.withColumn("pct_missing", r6("pct_missing"))


def _hist_sql(expr: str, bins: int) -> str:
    return sql(f"""SELECT bin, {r6sql('lo + (bin - 1) * ((hi - lo) / ' + str(bins) + ')')} AS lower,
  {r6sql('lo + bin * ((hi - lo) / ' + str(bins) + ')')} AS upper, count(*) AS n FROM (
  SELECT CAST(least(floor((x - lo) / (hi - lo) * {bins}) + 1, {bins}) AS INTEGER) AS bin, lo, hi
  FROM (SELECT {expr} AS x FROM ads WHERE {expr} IS NOT NULL) v,
       (SELECT min({expr}) AS lo, max({expr}) AS hi FROM ads) r)
GROUP BY bin, lo, hi""")


@query("histogram_log_price", "A26 P10", oracle=_hist_sql("ln(price + 0.001)", 100))
def q_hist(spark, sf_dir):
    h = P.histogram(ads(spark, sf_dir), F.log(F.col("price") + 0.001), 100)
    return h.select("bin", r6("lower").alias("lower"), r6("upper").alias("upper"), "n")


@query("histogram_target", "A26", oracle=_hist_sql("deal_probability", 100))
def q_hist_target(spark, sf_dir):
    h = P.histogram(ads(spark, sf_dir), "deal_probability", 100)
    return h.select("bin", r6("lower").alias("lower"), r6("upper").alias("upper"), "n")


@query("box_stats", "A27",
       oracle=sql(f"""SELECT parent_category_name,
  {r6sql('quantile_cont(price, 0.0) / 1000')} AS min, {r6sql('quantile_cont(price, 0.25) / 1000')} AS q1,
  {r6sql('quantile_cont(price, 0.5) / 1000')} AS median, {r6sql('quantile_cont(price, 0.75) / 1000')} AS q3,
  {r6sql('quantile_cont(price, 1.0) / 1000')} AS max
FROM ads WHERE price IS NOT NULL GROUP BY parent_category_name"""))
def q_box(spark, sf_dir):
    b = P.box_stats(ads(spark, sf_dir), "parent_category_name", "price")
    return b.select("parent_category_name",
                    *[r6(F.col(c) / 1000).alias(c) for c in ("min", "q1", "median", "q3", "max")])


_CORR_COLS = ["price", "deal_probability", "item_seq_number", "image_top_1"]


@query("correlation_matrix", "A28",
       oracle=sql(" UNION ALL ".join(
           f"SELECT '{a}' AS col_a, '{b}' AS col_b, {r6sql(f'corr({a}, {b})')} AS corr FROM ads"
           for i, a in enumerate(_CORR_COLS) for b in _CORR_COLS[i:])))
def q_corr(spark, sf_dir):
    c = P.correlation_matrix(ads(spark, sf_dir), _CORR_COLS)
    return c.withColumn("corr", r6("corr"))


@query("joint_histogram", "A29",
       oracle=sql("""SELECT CAST(least(floor((x - xl) / (xh - xl) * 20) + 1, 20) AS INTEGER) AS x_bin,
  CAST(least(floor((y - yl) / (yh - yl) * 20) + 1, 20) AS INTEGER) AS y_bin, count(*) AS n
FROM (SELECT price AS x, deal_probability AS y FROM ads WHERE price IS NOT NULL AND deal_probability IS NOT NULL) v,
     (SELECT min(price) AS xl, max(price) AS xh, min(deal_probability) AS yl, max(deal_probability) AS yh
      FROM ads WHERE price IS NOT NULL AND deal_probability IS NOT NULL) r
GROUP BY ALL"""))
def q_joint(spark, sf_dir):
    return P.joint_histogram(ads(spark, sf_dir), "price", "deal_probability", 20)


@query("length_profile", "A30",
       oracle="""SELECT count(*) FILTER (WHERE length(text) > 1000) AS n_longer,
  CAST(max(length(text)) AS INTEGER) AS max_len, CAST(min(length(text)) AS INTEGER) AS min_len
FROM documents""")
def q_length_profile(spark, sf_dir):
    return P.length_profile(table(spark, sf_dir, "documents"), "text", 1000)


_LENGTH_COLUMNS = ["title", "param_1", "param_2", "param_3"]


@query("value_lengths", "A30",
       oracle=sql(" UNION ".join(f"SELECT '{c}' AS column_name, {c} AS value, CAST(length({c}) AS INTEGER) AS length "
                                 f"FROM ads WHERE {c} IS NOT NULL" for c in _LENGTH_COLUMNS)))
def q_value_lengths(spark, sf_dir):
    return P.value_lengths(ads(spark, sf_dir), _LENGTH_COLUMNS)


@query("key_overlap_users", "J8",
       oracle=sql("""SELECT count(*) FILTER (WHERE r.k IS NULL) AS only_left,
  count(*) FILTER (WHERE l.k IS NULL) AS only_right,
  count(*) FILTER (WHERE l.k IS NOT NULL AND r.k IS NOT NULL) AS both
FROM lk l FULL OUTER JOIN rk r ON l.k = r.k""",
                  ("lk", "SELECT DISTINCT user_id AS k FROM ads WHERE split = 'train'"),
                  ("rk", "SELECT DISTINCT user_id AS k FROM ads WHERE split = 'test'")))
def q_overlap(spark, sf_dir):
    a = ads(spark, sf_dir)
    return P.key_overlap(a.where("split = 'train'"), a.where("split = 'test'"), "user_id")


@query("key_overlap_titles", "J8",
       oracle=sql("""SELECT
  (SELECT count(*) FROM (SELECT DISTINCT title FROM ads WHERE split = 'train' EXCEPT
                         SELECT DISTINCT title FROM ads WHERE split = 'test')) AS only_left,
  (SELECT count(*) FROM (SELECT DISTINCT title FROM ads WHERE split = 'test' EXCEPT
                         SELECT DISTINCT title FROM ads WHERE split = 'train')) AS only_right,
  (SELECT count(*) FROM (SELECT DISTINCT title FROM ads WHERE split = 'train' INTERSECT
                         SELECT DISTINCT title FROM ads WHERE split = 'test')) AS both"""))
def q_overlap_titles(spark, sf_dir):
    a = ads(spark, sf_dir)
    return P.key_overlap(a.where("split = 'train'"), a.where("split = 'test'"), "title")


@query("first_last_rows", "L1",
       oracle="""(SELECT o_orderkey, o_totalprice, 'head' AS part FROM orders ORDER BY o_orderkey LIMIT 5)
UNION ALL (SELECT o_orderkey, o_totalprice, 'tail' AS part FROM orders ORDER BY o_orderkey DESC LIMIT 5)""")
def q_first_last(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return P.first_last(o, ["o_orderkey"], 5)


@query("sorted_union", "L2 U1",
       oracle=sql("""SELECT item_id, split FROM ads WHERE split IN ('train', 'test') ORDER BY item_id"""))
def q_sorted_union(spark, sf_dir):
    a = ads(spark, sf_dir).select("item_id", "split")
    return a.where("split = 'test'").unionByName(a.where("split = 'train'")).orderBy("item_id")


@query("top_titles", "L3 A20",
       oracle=sql("SELECT title, count(*) AS n FROM ads GROUP BY title ORDER BY n DESC, title LIMIT 20"))
def q_top(spark, sf_dir):
    return P.top_values(ads(spark, sf_dir), "title", 20)


@query("distinct_set", "U4",
       oracle=sql("SELECT DISTINCT category_name FROM ads"))
def q_distinct(spark, sf_dir):
    return P.distinct_values(ads(spark, sf_dir), "category_name")


@query("value_positions", "W4",
       oracle="""SELECT o_totalprice, o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1
  AS position FROM orders""")
def q_positions(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return P.value_positions(o, "o_totalprice", ["o_orderkey"])


# -- positional splits ------------------------------------------------------------

@query("last_n_split", "X4",
       oracle="""SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) > (SELECT count(*) FROM orders) - 500
  AS is_valid FROM orders""")
def q_last_n(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    return X.last_n_split(o, ["o_orderkey"], 500)


@query("time_split", "X5 P12",
       oracle=sql("""SELECT item_id, CASE WHEN activation_date <= DATE '1998-06-30' THEN 'train' ELSE 'test' END
  AS part FROM ads"""))
def q_time_split(spark, sf_dir):
    return X.time_split(ads(spark, sf_dir).select("item_id", "activation_date"), "activation_date",
                        "1998-06-30").select("item_id", "part")


@query("contiguous_folds", "X6",
       oracle="""WITH n AS (SELECT count(*) AS n FROM orders),
p AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM orders)
SELECT o_orderkey, CAST(CASE WHEN pos < (n % 10) * (n // 10 + 1) THEN pos // (n // 10 + 1)
  ELSE (n % 10) + (pos - (n % 10) * (n // 10 + 1)) // (n // 10) END AS INTEGER) AS fold FROM p, n""")
def q_folds(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    return X.contiguous_folds(o, ["o_orderkey"], 10)


@query("systematic_sample", "X7",
       oracle="""WITH p AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos
  FROM orders)
SELECT o_orderkey, o_totalprice FROM p
WHERE pos % greatest((SELECT count(*) FROM orders) // 100, 1) = 0""")
def q_systematic(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return X.systematic_sample(o, ["o_orderkey"], 100)


@query("seed_draw", "X8",
       oracle=f"""SELECT seed FROM (SELECT DISTINCT o_orderkey AS seed FROM orders)
ORDER BY {X.hash_sql('seed', 'seeds')}, seed LIMIT 100""")
def q_seeds(spark, sf_dir):
    return X.draw_seeds(table(spark, sf_dir, "orders"), "o_orderkey", 100, "seeds")


@query("stacked_cut", "X9",
       oracle=sql("SELECT item_id, price FROM ads WHERE split = 'test'"))
def q_cut(spark, sf_dir):
    return X.stacked_cut(ads(spark, sf_dir).select("item_id", "price", "split"), "split", "test") \
        .drop("split")
