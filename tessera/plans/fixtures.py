"""Views with the reference's input shape, derived from the supplied tables.

The reference works on classified-ad tables (ads, activity periods). The test
data is a TPC-H-like schema, so these views re-shape it: an order is an ad, a
customer is its user, nation/region are city/region, a document is the ad
description and a part name is its title. Nulls are injected on purpose,
because the supplied tables have none and the reference's null rules must be
exercised. Every view covers whole tables; nothing is sampled or capped.

The same views exist as DuckDB SQL (``ADS_SQL``, ``PERIODS_SQL``) for oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordinal import running_index

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _row_count(df: DataFrame) -> int:
    # one number to the driver; used to map order keys onto the document ids
    return df.count()


def ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, with the columns of the reference's ads table but the
    description (``with_description``) plus ``split`` (train / active / test)."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    li = table(spark, sf_dir, "lineitem")
    n_parts = _row_count(p)

    ret = li.groupBy("l_orderkey").agg(
        F.avg(F.when(F.col("l_returnflag") == "R", F.lit(1.0)).otherwise(F.lit(0.0)))
        .alias("ret"))
    key = F.col("o_orderkey")
    base = (
        o.join(c, c.c_custkey == o.o_custkey)
        .join(n, n.n_nationkey == c.c_nationkey)
        .join(r, r.r_regionkey == n.n_regionkey)
        .join(p, p.p_partkey == key % F.lit(n_parts), "left")
        .join(ret, ret.l_orderkey == key, "left")
    )
    shaped = base.select(
        key.alias("item_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("city"),
        F.col("o_orderpriority").alias("parent_category_name"),
        F.concat(F.col("o_orderpriority"), F.lit("/"), F.col("o_orderstatus")).alias("category_name"),
        F.when(key % 13 == 0, F.lit(None).cast("string"))
        .when(key % 13 == 1, F.lit("0"))
        .otherwise(F.concat(F.lit("kind "), F.col("o_orderstatus"))).alias("param_1"),
        F.when(key % 3 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("param_2"),
        F.when(key % 2 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")).alias("param_3"),
        F.col("p_name").alias("title"),
        F.when(key % 17 == 0, F.lit(None).cast("double")).otherwise(F.col("o_totalprice")).alias("price"),
        F.col("o_orderdate"),
        F.col("o_orderdate").cast("date").alias("activation_date"),
        F.when(F.col("c_custkey") % 29 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("c_mktsegment")).alias("user_type"),
        F.when(key % 19 == 0, F.lit(None).cast("int")).otherwise((key % 3000).cast("int")).alias("image_top_1"),
        F.when(key % 4 != 0, F.lit(None).cast("double"))  # only train rows have a target
        .otherwise(F.coalesce(F.col("ret"), F.lit(0.0))).alias("deal_probability"),
        F.when(key % 4 == 0, F.lit("train")).when(key % 4 == 3, F.lit("test"))
        .otherwise(F.lit("active")).alias("split"),
    )
    # item_seq_number: 1-based rank of the ad among its user's ads by date,
    # computed on a narrow projection and joined back by key
    seq = running_index(o.select(key.alias("item_id"), F.col("o_custkey").alias("user_id"),
                                 "o_orderdate"),
                        ["user_id"], ["o_orderdate", "item_id"], "item_seq_number")
    seq = shaped.join(seq.select("item_id", "item_seq_number"), "item_id")
    return seq.select(
        "item_id", "user_id", "region", "city", "parent_category_name", "category_name",
        "param_1", "param_2", "param_3", "title", "price",
        (F.col("item_seq_number") + 1).cast("int").alias("item_seq_number"),
        "activation_date", "user_type", "image_top_1", "deal_probability", "split",
    )


def with_description(spark: SparkSession, sf_dir: str, narrow: DataFrame, digest: bool = False,
                     together: bool = False) -> DataFrame:
    """The ads with their text, joined where a query reads it (a text belongs to many
    ads; the stored view does not repeat it). ``digest``: with the MD5 of the text in its
    place, taken once for each document. ``together``: a text's ads come side by side."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("text") if digest else "text")
    if together:
        d = d.hint("merge")
    key = F.col("item_id")
    text = F.when(key % 23 == 0, F.lit(None).cast("string")).otherwise(F.col("text")).alias("description")
    at = narrow.columns.index("title") + 1
    return (narrow.join(d, d.doc_id == key % F.lit(_row_count(d)), "left")
            .select(*narrow.columns[:at], text, *narrow.columns[at:]))


def periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity periods: one row per line item. Items whose key is a multiple of
    101 are moved out of the ad key range so they have no owner."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    k = F.col("l_orderkey")
    return li.join(o, o.o_orderkey == k).select(
        F.when(k % 101 == 0, k + 100000000).otherwise(k).alias("item_id"),
        F.col("o_orderdate").cast("date").alias("date_from"),
        F.col("l_shipdate").cast("date").alias("date_to"),
        F.when(F.col("l_linenumber") <= 3, F.lit("train")).otherwise(F.lit("test")).alias("source"),
    )


def samples(ads_df: DataFrame) -> list[DataFrame]:
    """The four ad tables of the reference in its concat order: train,
    train_active, test, test_active (test_active overlaps train_active)."""
    return [
        ads_df.where(F.col("split") == "train"),
        ads_df.where(F.col("split") == "active"),
        ads_df.where(F.col("split") == "test"),
        ads_df.where((F.col("split") == "active") & (F.col("item_id") % 4 == 2)),
    ]


def period_tables(periods_df: DataFrame) -> list[DataFrame]:
    return [periods_df.where(F.col("source") == "train"),
            periods_df.where(F.col("source") == "test")]


# ---------------------------------------------------------------------------
# DuckDB forms of the same views (oracles only)

ADS_SQL = """
SELECT o.o_orderkey AS item_id, o.o_custkey AS user_id,
  r.r_name AS region, n.n_name AS city,
  o.o_orderpriority AS parent_category_name,
  concat(o.o_orderpriority, '/', o.o_orderstatus) AS category_name,
  CASE WHEN o.o_orderkey % 13 = 0 THEN NULL WHEN o.o_orderkey % 13 = 1 THEN '0'
       ELSE concat('kind ', o.o_orderstatus) END AS param_1,
  CASE WHEN o.o_orderkey % 3 = 0 THEN NULL ELSE c.c_mktsegment END AS param_2,
  CASE WHEN o.o_orderkey % 2 = 0 THEN NULL ELSE o.o_orderpriority END AS param_3,
  p.p_name AS title,
  CASE WHEN o.o_orderkey % 23 = 0 THEN NULL ELSE d.text END AS description,
  CASE WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE o.o_totalprice END AS price,
  CAST(row_number() OVER (PARTITION BY o.o_custkey
       ORDER BY o.o_orderdate, o.o_orderkey) AS INT) AS item_seq_number,
  CAST(o.o_orderdate AS DATE) AS activation_date,
  CASE WHEN c.c_custkey % 29 = 0 THEN NULL ELSE c.c_mktsegment END AS user_type,
  CASE WHEN o.o_orderkey % 19 = 0 THEN NULL
       ELSE CAST(o.o_orderkey % 3000 AS INT) END AS image_top_1,
  CASE WHEN o.o_orderkey % 4 <> 0 THEN NULL ELSE coalesce(l.ret, CAST(0 AS DOUBLE)) END
       AS deal_probability,
  CASE o.o_orderkey % 4 WHEN 0 THEN 'train' WHEN 3 THEN 'test' ELSE 'active' END
       AS split
FROM orders o
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey
JOIN region r ON r.r_regionkey = n.n_regionkey
LEFT JOIN documents d ON d.doc_id = o.o_orderkey % (SELECT count(*) FROM documents)
LEFT JOIN part p ON p.p_partkey = o.o_orderkey % (SELECT count(*) FROM part)
LEFT JOIN (SELECT l_orderkey,
             avg(CASE WHEN l_returnflag = 'R' THEN CAST(1 AS DOUBLE)
                      ELSE CAST(0 AS DOUBLE) END) AS ret
           FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey
"""

PERIODS_SQL = """
SELECT CASE WHEN l_orderkey % 101 = 0 THEN l_orderkey + 100000000
            ELSE l_orderkey END AS item_id,
  CAST(o_orderdate AS DATE) AS date_from, CAST(l_shipdate AS DATE) AS date_to,
  CASE WHEN l_linenumber <= 3 THEN 'train' ELSE 'test' END AS source
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
"""

SAMPLES_SQL = """
SELECT item_id, user_id, 0 AS src FROM ads WHERE split = 'train'
UNION ALL SELECT item_id, user_id, 1 AS src FROM ads WHERE split = 'active'
UNION ALL SELECT item_id, user_id, 2 AS src FROM ads WHERE split = 'test'
UNION ALL SELECT item_id, user_id, 3 AS src FROM ads WHERE split = 'active' AND item_id % 4 = 2
"""


def with_views(body: str, *extra: tuple[str, str]) -> str:
    """Prefix an oracle query with the fixture views as CTEs."""
    ctes = [("ads", ADS_SQL), ("periods", PERIODS_SQL), ("samples", SAMPLES_SQL), *extra]
    head = ",\n".join(f"{name} AS ({sql})" for name, sql in ctes)
    return f"WITH {head}\n{body}"
