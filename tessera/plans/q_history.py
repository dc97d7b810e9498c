"""Queries: user history (A13-A18), unions (U1, U2), joins J3-J5, D5."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import history as H
from . import fixtures
from .registry import ads, periods, query, r6, r6sql, sql


def _history(spark, sf_dir):
    a = ads(spark, sf_dir)
    return H.user_history(fixtures.samples(a), fixtures.period_tables(periods(spark, sf_dir)))


USER_HISTORY_SQL = """
dedup AS (SELECT item_id, user_id FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY src, user_id) AS rn
    FROM samples) WHERE rn = 1),
per_item AS (SELECT item_id, CAST(sum(date_diff('day', date_from, date_to)) AS BIGINT) AS days_up_sum,
    count(date_diff('day', date_from, date_to)) AS times_put_up FROM periods GROUP BY item_id),
per_user AS (SELECT d.user_id, avg(p.days_up_sum) AS avg_days_up_user,
    avg(p.times_put_up) AS avg_times_up_user
    FROM per_item p LEFT JOIN dedup d ON p.item_id = d.item_id
    WHERE d.user_id IS NOT NULL GROUP BY d.user_id),
n_items AS (SELECT user_id, count(item_id) AS n_user_items FROM dedup GROUP BY user_id),
history AS (SELECT u.user_id, u.avg_days_up_user, u.avg_times_up_user, n.n_user_items
    FROM per_user u LEFT JOIN n_items n ON u.user_id = n.user_id)
"""


def _with_history(body: str) -> str:
    full = sql("SELECT 1")  # views
    head = full[: full.rfind("SELECT 1")].rstrip()
    return f"{head},{USER_HISTORY_SQL}{body}"


@query("user_history", "A18 U2 A13 A14 A15 J3 A16 A17 J5",
       oracle=_with_history(f"""SELECT user_id, {r6sql('avg_days_up_user')} AS avg_days_up_user,
  {r6sql('avg_times_up_user')} AS avg_times_up_user, n_user_items FROM history"""))
def q_user_history(spark, sf_dir):
    h = _history(spark, sf_dir)
    return h.select("user_id", r6("avg_days_up_user").alias("avg_days_up_user"),
                    r6("avg_times_up_user").alias("avg_times_up_user"), "n_user_items")


@query("ads_with_user_history", "J5 A25",
       oracle=_with_history(f"""SELECT a.split,
  count(*) AS n_rows,
  {r6sql("100.0 * avg(CASE WHEN h.avg_days_up_user IS NULL OR h.avg_times_up_user IS NULL"
          " OR h.n_user_items IS NULL THEN 1.0 ELSE 0.0 END)")} AS pct_missing
FROM ads a LEFT JOIN history h ON a.user_id = h.user_id GROUP BY a.split"""))
def q_ads_with_history(spark, sf_dir):
    from ..operators import profile as P
    a = ads(spark, sf_dir)
    joined = H.attach_user_features(a, _history(spark, sf_dir))
    share = P.any_null_share(joined, ["avg_days_up_user", "avg_times_up_user", "n_user_items"],
                             by=["split"], name="pct_missing", with_count="n_rows")
    return share.withColumn("pct_missing", r6("pct_missing"))


@query("dedup_keep_first", "A13 U2",
       oracle=sql("""SELECT item_id, user_id, src AS source_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY src, user_id) AS rn FROM samples)
WHERE rn = 1"""))
def q_dedup(spark, sf_dir):
    a = ads(spark, sf_dir)
    u = H.union_all([t.select("item_id", "user_id") for t in fixtures.samples(a)])
    return H.keep_first(u, ["item_id"], [H.SOURCE_RANK], ["user_id", H.SOURCE_RANK]).select(
        "item_id", "user_id", "source_rank")


@query("period_days", "A14 D5 U2",
       oracle=sql("""SELECT item_id, date_from, date_to, source,
  CAST(date_diff('day', date_from, date_to) AS INTEGER) AS days_up,
  CAST(floor((epoch_us(CAST(date_to AS TIMESTAMP) - INTERVAL 12 HOUR)
    - epoch_us(CAST(date_from AS TIMESTAMP))) / 86400000000.0) AS BIGINT) AS days_up_half
FROM periods"""))
def q_period_days(spark, sf_dir):
    p = periods(spark, sf_dir)
    # days_up_half: timestamps half a day before date_to, floored
    return H.period_days(p).withColumn(
        "days_up_half",
        H.days_between(F.col("date_from").cast("timestamp"),
                       F.col("date_to").cast("timestamp") - F.expr("INTERVAL 12 HOURS")))


@query("item_period_stats", "A15 J4",
       oracle=sql("""SELECT item_id, CAST(sum(date_diff('day', date_from, date_to)) AS BIGINT) AS days_up_sum,
  count(*) AS times_put_up FROM periods GROUP BY item_id"""))
def q_item_stats(spark, sf_dir):
    return H.item_period_stats(H.period_days(periods(spark, sf_dir)))


@query("period_owner", "J3",
       oracle=_with_history("""SELECT p.item_id, p.days_up_sum, p.times_put_up, d.user_id
FROM per_item p LEFT JOIN dedup d ON p.item_id = d.item_id"""))
def q_owner(spark, sf_dir):
    a = ads(spark, sf_dir)
    u = H.union_all([t.select("item_id", "user_id") for t in fixtures.samples(a)])
    owners = H.keep_first(u, ["item_id"], [H.SOURCE_RANK], ["user_id"])
    return H.attach_owner(H.item_period_stats(H.period_days(periods(spark, sf_dir))), owners)


@query("union_unequal", "U1 P15 X9",
       oracle=sql("""SELECT item_id, split, deal_probability FROM ads WHERE split = 'train'
UNION ALL SELECT item_id, split, NULL AS deal_probability FROM ads WHERE split = 'test'"""))
def q_union_unequal(spark, sf_dir):
    a = ads(spark, sf_dir)
    train = a.where("split = 'train'").select("item_id", "split", "deal_probability")
    test = a.where("split = 'test'").select("item_id", "split")
    return H.union_all([train, test], rank_col=None)
