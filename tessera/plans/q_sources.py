"""Queries: sources and sinks (S1-S12, S14, S16-S18). Each writes data
derived from the supplied tables to a fresh folder under the shared
checkpoint folder and reads it back; the oracle is the data itself."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import groups as G
from ..operators import text as TX
from ..sources import io, one_file
from ..session import scratch_path, spread
from .fixtures import with_description
from .q_text import _grams_sql, _with
from .registry import ads, query, r6, r6sql, sql, table

ADS_CSV_SCHEMA = ("item_id long, title string, description string, price double, "
                  "activation_date string, user_type string")
#: Ads in a compressed file.
ADS_PER_FILE = 20_000


def _ads_csv(spark, sf_dir):
    """The ads with their texts, which repeat, as compressed CSV: a file is one task's
    to read, so a file holds so many ads at most."""
    path = scratch_path(spark, "ads-csv")
    a = with_description(spark, sf_dir, spread(ads(spark, sf_dir)))
    a = a.select("item_id", "title", "description", "price",
                 F.col("activation_date").cast("string").alias("activation_date"), "user_type")
    io.write_csv(a, path, compression="gzip", max_records=ADS_PER_FILE)
    return path


@query("csv_roundtrip", "S1 S2 S12",
       oracle=sql("SELECT item_id, description, price, activation_date FROM ads"))
def q_csv(spark, sf_dir):
    path = _ads_csv(spark, sf_dir)
    return io.read_csv(spark, path, ADS_CSV_SCHEMA,
                       columns=["item_id", "description", "price", "activation_date"],
                       dates=["activation_date"])


@query("csv_one_file", "S1 S2",
       oracle=sql("SELECT item_id, title, md5(description) AS description_md5, price, user_type FROM ads"))
def q_csv_one_file(spark, sf_dir):
    """One large file with line breaks in its texts, written and read in byte ranges."""
    path = scratch_path(spark, "ads-csv")
    a = with_description(spark, sf_dir, ads(spark, sf_dir), together=True)
    one_file.write_one_csv(a.select("item_id", "title", "description", "price", "user_type"), path)
    df = io.read_csv(spark, path, "item_id long, title string, description string, price double, user_type string")
    return df.select("item_id", "title", F.md5("description").alias("description_md5"), "price", "user_type")


@query("row_limited_read", "S3",
       oracle=sql("SELECT item_id, title FROM ads ORDER BY item_id LIMIT 100"))
def q_first_rows(spark, sf_dir):
    path = _ads_csv(spark, sf_dir)
    df = io.read_csv(spark, path, ADS_CSV_SCHEMA, columns=["item_id", "title"])
    return io.first_rows(df, ["item_id"], 100)


@query("table_roundtrip", "S4 S5 S9",
       oracle=sql("SELECT item_id, user_id, price, activation_date, deal_probability FROM ads"))
def q_table(spark, sf_dir):
    a = ads(spark, sf_dir).select("item_id", "user_id", "price", "activation_date", "deal_probability")
    base = scratch_path(spark, "table")
    path = io.save_file(a, base, ".feather")
    return io.load_file(spark, path, ".feather")


@query("format_dispatch_csv", "S9 S11",
       oracle="SELECT c_custkey, c_name, c_acctbal FROM customer")
def q_dispatch(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    base = scratch_path(spark, "dispatch")
    src = io.save_file(c, base + "/customer")  # default: csv
    out = io.convert(spark, {"customer": src}, base + "/converted",
                     schema="c_custkey long, c_name string, c_acctbal double")
    return io.load_table(spark, out["customer"])


FEATURES = [G.feature(["region"], "deal_probability", "mean"),
            G.feature(["user_type"], "price", "count")]


@query("feature_store", "S6 S7 P14",
       oracle=sql(f"""SELECT a.item_id, {r6sql('g0.v')} AS reg_mean_dp, g1.v AS uty_count_pr
FROM ads a
LEFT JOIN (SELECT region, avg(deal_probability) AS v FROM ads GROUP BY region) g0 ON a.region = g0.region
LEFT JOIN (SELECT user_type, count(price) AS v FROM ads WHERE user_type IS NOT NULL GROUP BY user_type) g1
  ON a.user_type = g1.user_type"""))
def q_store(spark, sf_dir):
    a = ads(spark, sf_dir)
    store = scratch_path(spark, "store")
    feats = G.group_features(a, FEATURES)
    io.store_add(feats, store)
    io.store_add(feats, store)  # second run: every column is skipped
    out, _missing = io.store_read(spark, store, ["reg_mean_dp", "uty_count_pr", "not_stored"],
                                  a.select("item_id"))
    return out.withColumn("reg_mean_dp", r6("reg_mean_dp"))


@query("matrix_store", "S8",
       oracle=_with(_grams_sql("documents", "doc_id", "text", stop=False, ngram_max=1, min_len=2))
       + """SELECT tf.doc_id, tf.term, CAST(tf.tf AS DOUBLE) AS weight, d.lang AS language FROM tf
JOIN documents d ON d.doc_id = tf.doc_id""")
def q_matrix_store(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    m = TX.count_matrix(d, "doc_id", TX.analyzed_terms(F.col("text"), min_token_len=2))
    m = m.join(d.select("doc_id", F.col("lang").alias("language")), "doc_id")
    path = scratch_path(spark, "matrix")
    io.store_matrix(m, path)
    io.store_matrix(m, path)  # present: kept
    return spark.read.parquet(path).select("doc_id", "term", "weight", "language")


@query("paired_read", "S10 U1",
       oracle=sql("""SELECT item_id, deal_probability, 'train' AS split FROM ads WHERE split = 'train'
UNION ALL SELECT item_id, NULL AS deal_probability, 'test' AS split FROM ads WHERE split = 'test'"""))
def q_pair(spark, sf_dir):
    a = ads(spark, sf_dir)
    base = scratch_path(spark, "pair")
    io.save_table(a.where("split = 'train'").select("item_id", "deal_probability"), base + "/train")
    io.save_table(a.where("split = 'test'").select("item_id"), base + "/test")
    return io.read_pair(spark, base + "/train", base + "/test")


@query("gzip_csv_sink", "S12 M4",
       oracle=sql(f"""SELECT item_id, {r6sql('deal_probability')} AS deal_probability FROM ads
WHERE split = 'test'"""))
def q_gzip(spark, sf_dir):
    a = ads(spark, sf_dir).where("split = 'test'")
    path = scratch_path(spark, "submission")
    io.write_csv(a.select("item_id", "deal_probability"), path, compression="gzip")
    back = io.read_csv(spark, path, "item_id long, deal_probability double")
    return back.select("item_id", r6("deal_probability").alias("deal_probability"))


@query("ratings_text_scan", "S14",
       oracle="""SELECT vec_id AS image_id, 10 AS n_bins,
  list_sum(list_transform(embedding[1:10], lambda x: floor(abs(CAST(x AS DOUBLE)) * 100) + 1)) AS total,
  floor(abs(CAST(embedding[1] AS DOUBLE)) * 100) + 1 AS first_bin FROM embeddings""")
def q_ratings_text(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    counts = F.transform(F.slice("embedding", 1, 10),
                         lambda x: (F.floor(F.abs(x.cast("double")) * 100) + 1).cast("string"))
    line = F.concat_ws("  ", F.col("vec_id").cast("string"), F.col("vec_id").cast("string"),
                       F.array_join(counts, " "), F.lit("0 1 2"))
    path = scratch_path(spark, "ratings")
    e.select(line.alias("value")).write.text(path)
    r = io.read_whitespace_records(spark, path)
    return r.select("image_id", F.size("scores").alias("n_bins"),
                    F.aggregate("scores", F.lit(0.0), lambda a, x: a + x).alias("total"),
                    F.element_at("scores", 1).alias("first_bin"))


@query("fixed_length_records", "S16",
       oracle=f"""SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n,
  {r6sql('list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE)))')} AS total FROM embeddings""")
def q_fixed(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    path = scratch_path(spark, "records")
    e.select("vec_id", "embedding").write.parquet(path)
    back = io.read_fixed_length(spark, path, "embedding", 64)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return back.select("vec_id", F.size("embedding").alias("n"), r6(total).alias("total"))


@query("skip_if_done", "S17",
       oracle=sql(f"""SELECT a.item_id, {r6sql('g.v')} AS reg_mean_dp FROM ads a
LEFT JOIN (SELECT region, avg(deal_probability) AS v FROM ads GROUP BY region) g ON a.region = g.region"""))
def q_skip(spark, sf_dir):
    a = ads(spark, sf_dir)
    path = scratch_path(spark, "cache")
    fp = io.input_fingerprint(spark, [f"{sf_dir}/{t}.parquet" for t in (
        "orders", "lineitem", "customer", "nation", "region", "documents", "part")],
                              "reg_mean_dp")

    def build():
        return G.group_features(a, [FEATURES[0]])

    io.materialize_once(spark, path, build, fp)
    again = io.materialize_once(spark, path, build, fp)  # reused, not rebuilt
    return again.withColumn("reg_mean_dp", r6("reg_mean_dp"))


@query("unique_values", "S18 A19",
       oracle=sql("SELECT DISTINCT title FROM ads"))
def q_unique(spark, sf_dir):
    path = scratch_path(spark, "unique")
    _col, uniq = io.extract_unique(ads(spark, sf_dir), "title", path)
    return spark.read.parquet(uniq)
