"""Hand-built fixtures for the reference's rules (null keys, n-1 variance,
keep-first, floored days, text null rules, wrapping, score moments)."""

import math

from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import distributions as R
from tessera.operators import groups as G
from tessera.operators import history as H
from tessera.operators.ordinal import running_index, with_position


def test_group_frequency(spark):
    df = spark.createDataFrame([(k, f"port {k % 3}" if k != 5 else "port", 10 * k) for k in range(8)],
                               "item_id long, port string, cargo int")
    out = G.group_features(df, [G.feature(["port"], None, "freq")])
    got = {r.item_id: r.port_freq for r in out.collect()}
    assert got == {0: 3, 3: 3, 6: 3, 1: 3, 4: 3, 7: 3, 2: 1, 5: 1}


def test_null_keys_and_sample_variance(spark):
    rows = [(1, "a", 1.0), (2, "a", 2.0), (3, None, 3.0), (4, "b", None), (5, None, 5.0)]
    df = spark.createDataFrame(rows, "item_id long, k string, v double")
    feats = [G.feature(["k"], "v", s) for s in ("mean", "var", "count", "nunique", "cumcount")]
    out = {r.item_id: r for r in G.group_features(df, feats).collect()}
    assert out[1].k_mean_v == 1.5 and out[1].k_var_v == 0.5
    assert out[4].k_mean_v is None and out[4].k_count_v == 0 and out[4].k_nunique_v == 0
    assert out[4].k_var_v is None  # one row -> null (n - 1)
    for i in (3, 5):
        assert out[i].k_mean_v is None and out[i].k_cumcount_v is None
    assert [out[i].k_cumcount_v for i in (1, 2, 4)] == [0, 1, 0]


def test_keep_first_follows_source_order(spark):
    a = spark.createDataFrame([(1, 10), (2, 20)], "item_id long, user_id long")
    b = spark.createDataFrame([(1, 99), (3, 30)], "item_id long, user_id long")
    u = H.union_all([a, b])
    got = {r.item_id: r.user_id for r in H.keep_first(u, ["item_id"], [H.SOURCE_RANK], ["user_id"]).collect()}
    assert got == {1: 10, 2: 20, 3: 30}


def test_days_are_floored(spark):
    df = spark.createDataFrame([("2017-01-01 12:00:00", "2017-01-03 00:00:00"),
                                ("2017-01-01 12:00:00", "2017-01-01 00:00:00")], "a string, b string")
    got = [r[0] for r in df.select(H.days_between(F.to_timestamp("a"), F.to_timestamp("b"))).collect()]
    assert got == [1, -1]


def test_text_null_rules(spark):
    df = spark.createDataFrame([(None,), ("",)], "t string")
    r = df.select(T.n_chars(T.prepared("t")).alias("c"), T.n_words(T.prepared("t")).alias("w"),
                  T.unique_ratio(F.col("t")).alias("u")).collect()
    assert (r[0].c, r[0].w) == (3, 1)  # missing text prints as 'nan'
    assert r[1].w == 0 and r[1].u is None


def test_wrap_pieces(spark):
    df = spark.createDataFrame([("aa bb  cc\ndd eeeeeeeeeeee",)], "t string")
    got = df.select(T.wrap_pieces("t", 6)).first()[0]
    assert got == ["aa bb", "cc dd", "eeeeeeeeeeee"]


def test_wrap_properties_on_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    p = d.select("doc_id", "text", T.wrap_pieces("text", 200).alias("p"))
    for r in p.collect():
        words = r.text.split()
        assert " ".join(r.p).split() == words  # every word kept, in order
        assert all(len(x) <= 200 or " " not in x for x in r.p)


def test_score_moments(spark):
    df = spark.createDataFrame([([0.0, 0.0, 0.0, 1.0] + [0.0] * 6,), ([0.5] + [0.0] * 8 + [0.5],)],
                               "s array<double>")
    r = df.select(R.mean_score("s").alias("m"), R.std_score("s").alias("sd")).collect()
    assert (r[0].m, r[0].sd) == (4.0, 0.0)
    assert r[1].m == 5.5 and math.isclose(r[1].sd, 4.5)


def test_positions_are_dense_and_ordered(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("v"), "id")
    got = with_position(df, ["v", "id"], "pos", num_partitions=7).orderBy("pos").collect()
    assert [r.pos for r in got] == list(range(1000))
    assert [r.v for r in got] == sorted(r.v for r in got)


def test_running_index_on_hot_key(spark):
    # one key holds most rows: still split over many range partitions
    df = spark.range(0, 3000).select("id", F.when(F.col("id") % 10 == 0, F.col("id") % 3)
                                     .otherwise(F.lit(99)).alias("k"))
    out = running_index(df, ["k"], ["id"], "ix", num_partitions=8).collect()
    by_key = {}
    for r in sorted(out, key=lambda r: r.id):
        by_key.setdefault(r.k, []).append(r.ix)
    for ixs in by_key.values():
        assert ixs == list(range(len(ixs)))


def test_checkpoint_dir_comes_from_the_session(spark):
    from tessera.session import ensure_checkpoint_dir
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    # Spark adds a unique sub-folder under the configured shared folder
    assert configured.rstrip("/").split("/")[-1] in ensure_checkpoint_dir(spark)


def test_spread_only_when_needed(spark):
    from tessera.session import spread
    one = spark.range(0, 100).coalesce(1)
    assert spread(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(0, 100).repartition(spark.sparkContext.defaultParallelism * 2)
    assert spread(many).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism * 2


def test_label_codes_sort_numbers_numerically(spark):
    from tessera.operators.frame import label_encode
    df = spark.createDataFrame([(1, 10, "b"), (2, 9, "a"), (3, None, "b"), (4, 100, None)],
                               "item_id long, n int, s string")
    got = {r.item_id: (r.n_encoded, r.s_encoded) for r in label_encode(df, ["n", "s"]).collect()}
    assert got == {1: (1, 1), 2: (0, 0), 3: (None, 1), 4: (2, None)}
