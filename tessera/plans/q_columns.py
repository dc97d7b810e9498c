"""Queries: column work (P1-P17), time features (D1-D4), label codes (M1),
literal dimension tables (S13, J2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import frame as Fr
from ..operators import groups as G
from .registry import ads, query, r6, r6sql, sql, table

_ADS_COLS = ("item_id, user_id, region, city, parent_category_name, category_name, param_1, "
             "param_2, param_3, title, description, price, item_seq_number, activation_date, "
             "user_type, image_top_1, deal_probability, split")

# A literal region table (name, English label), leading spaces
# kept as a CSV reader keeps them.
REGION_LABELS = [
    ("AFRICA", " Africa"),
    ("AMERICA", " America"),
    ("ASIA", " Asia"),
    ("EUROPE", " Europe"),
    ("MIDDLE EAST", " Middle East"),
]


@query("drop_columns", "P1",
       oracle=sql("""SELECT item_id, user_id, region, city, parent_category_name, category_name,
  param_1, param_2, param_3, price, item_seq_number, activation_date, user_type, image_top_1,
  deal_probability, split FROM ads"""))
def q_drop(spark, sf_dir):
    return Fr.drop_columns(ads(spark, sf_dir, text=True), ["title", "description", "image", "not_there"])


@query("keep_columns", "P2",
       oracle=sql("SELECT item_id, region, price FROM ads"))
def q_keep(spark, sf_dir):
    return Fr.keep_columns(ads(spark, sf_dir), ["price", "item_id", "region", "not_there"])


def _translated(spark, sf_dir):
    a = ads(spark, sf_dir, text=True)
    # stand-in translation: a marked copy of the text
    return a.withColumns({en: F.concat(F.lit("en:"), src) for src, en in Fr.TRANSLATED.items()})


@query("language_columns", "P3 P4",
       oracle=sql("""SELECT item_id, 'en:' || param_1 AS param_1, 'en:' || param_2 AS param_2,
  'en:' || param_3 AS param_3, 'en:' || title AS title, 'en:' || description AS description FROM ads"""))
def q_language(spark, sf_dir):
    t = _translated(spark, sf_dir)
    english = Fr.keep_columns(t, ["item_id", *Fr.TRANSLATED.values()])
    return Fr.rename_back(english)


@query("source_language_columns", "P3",
       oracle=sql("SELECT param_1, param_2, param_3, title, description FROM ads"))
def q_language_src(spark, sf_dir):
    return Fr.keep_language(_translated(spark, sf_dir), "russian")


@query("cast_types", "P5",
       oracle=sql("""SELECT item_id, CAST(item_seq_number AS VARCHAR) AS item_seq_number,
  CAST(CAST(activation_date AS VARCHAR) AS DATE) AS activation_date,
  CAST(image_top_1 AS VARCHAR) AS image_top_1 FROM ads"""))
def q_cast(spark, sf_dir):
    a = ads(spark, sf_dir).select("item_id", "item_seq_number",
                                  F.col("activation_date").cast("string").alias("activation_date"),
                                  "image_top_1")
    return Fr.cast_columns(a, {"item_seq_number": "string", "activation_date": "date",
                               "image_top_1": "string"})


@query("cast_by_feature_name", "P5",
       oracle=sql("""SELECT item_id, CAST(image_top_1 AS BIGINT) AS img1_count, CAST(image_top_1 AS BIGINT) AS img1_cumcount,
  CAST(image_top_1 AS DOUBLE) AS img1_mean, CAST(image_top_1 AS DOUBLE) AS img1_var,
  CAST(image_top_1 AS VARCHAR) AS img1 FROM ads"""))
def q_cast_by_name(spark, sf_dir):
    text = F.col("image_top_1").cast("string")
    names = ("img1_count", "img1_cumcount", "img1_mean", "img1_var", "img1")
    return Fr.cast_by_name(ads(spark, sf_dir).select("item_id", *[text.alias(n) for n in names]))


@query("sentinel_nulls", "P6",
       oracle=sql("""SELECT item_id, CASE WHEN param_1 = '0' THEN NULL ELSE param_1 END AS param_1,
  CASE WHEN image_top_1 = 0 THEN NULL ELSE image_top_1 END AS image_top_1 FROM ads"""))
def q_sentinel(spark, sf_dir):
    a = ads(spark, sf_dir)
    return a.select("item_id", C.sentinel_to_null("param_1").alias("param_1"),
                    C.sentinel_to_null("image_top_1", numeric=True).alias("image_top_1"))


@query("fill_constants", "P7",
       oracle=sql("""SELECT item_id, coalesce(param_1, 'n/a') AS param_1, coalesce(user_type, 'NA') AS user_type,
  coalesce(description, 'unknowntitle') AS description, coalesce(price, -999.0) AS price,
  coalesce(image_top_1, -999) AS image_top_1 FROM ads"""))
def q_fill(spark, sf_dir):
    a = ads(spark, sf_dir, text=True).select("item_id", "param_1", "user_type", "description", "price", "image_top_1")
    return Fr.fill_constants(a, {"param_1": "n/a", "user_type": "NA", "description": "unknowntitle",
                                 "price": -999.0, "image_top_1": -999})


@query("fill_mean", "P8",
       oracle=sql(f"""SELECT item_id, {r6sql('coalesce(price, (SELECT avg(price) FROM ads)) / 1000.0')}
  AS price_k FROM ads"""))
def q_fill_mean(spark, sf_dir):
    filled = Fr.fill_mean(ads(spark, sf_dir).select("item_id", "price"), "price")
    return filled.select("item_id", r6(F.col("price") / 1000.0).alias("price_k"))


@query("text_concat", "P9 P6",
       oracle=sql("""SELECT item_id,
  concat_ws(' ', coalesce(CASE WHEN param_1 = '0' THEN NULL ELSE param_1 END, 'nan'),
            coalesce(param_2, 'nan'), coalesce(param_3, 'nan')) AS text_feat,
  region || '_' || city AS region_city,
  param_2 || '_' || param_3 AS p2_p3 FROM ads"""))
def q_concat(spark, sf_dir):
    a = Fr.sentinels_to_null(ads(spark, sf_dir), ["param_1"])
    return a.select("item_id", C.join_text("param_1", "param_2", "param_3").alias("text_feat"),
                    C.pair_key("region", "city").alias("region_city"),
                    C.pair_key("param_2", "param_3").alias("p2_p3"))


@query("log_price", "P10",
       oracle=sql(f"""SELECT item_id, {r6sql('ln(price + 0.001)')} AS log_price,
  {r6sql('ln(1 + price)')} AS log1p_price FROM ads"""))
def q_log(spark, sf_dir):
    a = ads(spark, sf_dir)
    return a.select("item_id", r6(C.log_plus("price")).alias("log_price"),
                    r6(C.log1p("price")).alias("log1p_price"))


@query("clip_unit", "P11",
       oracle=sql(f"""SELECT item_id, {r6sql('CASE WHEN deal_probability IS NULL THEN NULL ELSE '
                                           'greatest(0.0, least(1.0, deal_probability * 1.5 - 0.25)) END')}
  AS clipped FROM ads"""))
def q_clip(spark, sf_dir):
    a = ads(spark, sf_dir)
    return a.select("item_id", r6(C.clip(F.col("deal_probability") * 1.5 - 0.25)).alias("clipped"))


@query("date_cutoff", "P12",
       oracle=sql("SELECT item_id, activation_date FROM ads WHERE activation_date <= DATE '1998-06-30'"))
def q_date_cut(spark, sf_dir):
    return Fr.date_filter(ads(spark, sf_dir).select("item_id", "activation_date"),
                          "activation_date", "1998-06-30")


@query("name_filter", "P13",
       oracle="""SELECT p_partkey, p_name FROM part
WHERE NOT contains(p_name, 'red') AND NOT contains(p_name, 'bolt')""")
def q_name_filter(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return Fr.exclude_names(p, "p_name", ["red", "bolt"])


@query("attach_features", "P14 D4",
       oracle=sql(f"""SELECT a.item_id, a.price, CAST(weekofyear(a.activation_date) AS INTEGER) AS week,
  CAST(isodow(a.activation_date) - 1 AS INTEGER) AS weekday, CAST(day(a.activation_date) AS INTEGER) AS day,
  {r6sql('g.v')} AS reg_mean_dp
FROM ads a LEFT JOIN (SELECT region, avg(deal_probability) AS v FROM ads GROUP BY region) g
  ON a.region = g.region"""))
def q_attach(spark, sf_dir):
    a = ads(spark, sf_dir)
    base = a.select("item_id", "price")
    feats = [Fr.time_features(a),
             G.group_feature(a, ["region"], "deal_probability", "mean"),
             a.select("item_id", F.lit(0.0).alias("price"))]  # already present: skipped
    out = Fr.attach_features(base, feats)
    return out.withColumn("reg_mean_dp", r6("reg_mean_dp"))


@query("split_label", "P15 U1",
       oracle=sql("""SELECT item_id, price, 'train' AS split, deal_probability AS label FROM ads WHERE split = 'train'
UNION ALL SELECT item_id, price, 'test' AS split, NULL AS label FROM ads WHERE split = 'test'"""))
def q_split_label(spark, sf_dir):
    a = ads(spark, sf_dir).select("item_id", "price", "deal_probability", "split")
    train = a.where("split = 'train'").drop("split")
    test = a.where("split = 'test'").drop("split", "deal_probability")
    stacked, labels = Fr.split_label(train, test, "deal_probability")
    return stacked.join(labels.withColumnRenamed("deal_probability", "label"), "item_id", "left")


@query("file_name_parts", "P16",
       oracle=r"""SELECT page_id, string_split(url, '/')[-1] AS base,
  lower(regexp_extract(string_split(url, '/')[-1], '^(.*?)(\.[^.]*)?$', 1)) AS stem,
  lower(regexp_extract(string_split(url, '/')[-1], '\.([^./]*)$', 1)) AS ext FROM pages""")
def q_file_parts(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", C.file_base("url").alias("base"), C.file_stem("url").alias("stem"),
                    C.file_ext("url").alias("ext"))


@query("run_stamp", "P17",
       oracle="SELECT event_id, strftime(ts, '%Y%m%d%H') AS stamp FROM events")
def q_stamp(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", C.run_stamp("ts").alias("stamp"))


@query("time_features", "D1 D2 D3 D4",
       oracle=sql("""SELECT item_id, CAST(weekofyear(activation_date) AS INTEGER) AS week,
  CAST(isodow(activation_date) - 1 AS INTEGER) AS weekday, CAST(day(activation_date) AS INTEGER) AS day
FROM ads"""))
def q_time(spark, sf_dir):
    return Fr.time_features(ads(spark, sf_dir))


def _label_sql() -> str:
    parts, joins = [], []
    for i, c in enumerate(Fr.CATEGORICAL):
        name = f"{G.short(c)}_encoded"
        joins.append(f"LEFT JOIN (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS BIGINT) AS code "
                     f"FROM (SELECT DISTINCT {c} AS v FROM ads WHERE {c} IS NOT NULL)) e{i} ON a.{c} = e{i}.v")
        parts.append(f"e{i}.code AS {name}")
    return sql(f"SELECT a.item_id, {', '.join(parts)} FROM ads a\n" + "\n".join(joins))


@query("label_encode", "M1", oracle=_label_sql())
def q_label(spark, sf_dir):
    names = {c: f"{G.short(c)}_encoded" for c in Fr.CATEGORICAL}
    return Fr.label_encode(ads(spark, sf_dir), Fr.CATEGORICAL, names=names)


def _region_values_sql() -> str:
    rows = ", ".join(f"('{a}', '{b}')" for a, b in REGION_LABELS)
    return f"SELECT * FROM (VALUES {rows}) AS t(region, region_en)"


@query("dimension_lookup", "S13 J2",
       oracle=sql("""SELECT a.item_id, a.region, d.region_en FROM ads a LEFT JOIN dim d ON a.region = d.region""",
                  ("dim", _region_values_sql())))
def q_dim(spark, sf_dir):
    dim = spark.createDataFrame(REGION_LABELS, "region string, region_en string")
    return Fr.dimension_lookup(ads(spark, sf_dir).select("item_id", "region"), dim, "region")
