"""Queries: group-statistic features (A1-A12, J1, W1) and hash splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import groups as G
from ..operators import splits as X
from .registry import ads, query, r6, r6sql, sql

SEED = 1988  # fixed value: the split seed of the reference


def _scale(f: G.Feature) -> float:
    """Report price statistics in thousands (variance in units of 1e9) so that
    six decimals compare the engines at about ten significant digits."""
    if f.value == "price" and f.stat in ("mean", "std"):
        return 1e3
    if f.value == "price" and f.stat == "var":
        return 1e9
    return 1.0


def _present(df, feats, row_key="item_id"):
    cols = [row_key]
    for f in feats:
        c = F.col(f.name)
        if f.stat in ("mean", "var", "std"):
            c = r6(c / F.lit(_scale(f)))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _feature_sql(feats, base="ads", row_key="item_id") -> str:
    """DuckDB: one aggregate subquery per feature, left-joined to the rows."""
    sel = [f"b.{row_key}"]
    joins = []
    for i, f in enumerate(feats):
        keys = list(f.keys)
        notnull = " AND ".join(f"{k} IS NOT NULL" for k in keys)
        if f.stat == "cumcount":
            sel.append(f"CASE WHEN {' AND '.join(f'b.{k} IS NOT NULL' for k in keys)} THEN "
                       f"row_number() OVER (PARTITION BY {', '.join(f'b.{k}' for k in keys)} "
                       f"ORDER BY b.{row_key}) - 1 END AS {f.name}")
            continue
        agg = {
            "freq": "count(*)", "count": f"count({f.value})", "mean": f"avg({f.value})",
            "var": f"var_samp({f.value})", "std": f"stddev_samp({f.value})",
            "nunique": f"count(DISTINCT {f.value})",
        }[f.stat]
        joins.append(
            f"LEFT JOIN (SELECT {', '.join(keys)}, {agg} AS v FROM {base} WHERE {notnull} "
            f"GROUP BY {', '.join(keys)}) g{i} ON "
            + " AND ".join(f"b.{k} = g{i}.{k}" for k in keys))
        v = f"g{i}.v"
        if f.stat in ("mean", "var", "std"):
            v = r6sql(f"{v} / {_scale(f)}")
        sel.append(f"{v} AS {f.name}")
    return f"SELECT {', '.join(sel)} FROM {base} b\n" + "\n".join(joins)


def _register(name, ids, feats, masked=False):
    base = "masked" if masked else "ads"
    body = _feature_sql(feats, base=base)
    extra = ()
    if masked:
        extra = (("masked", f"""SELECT * REPLACE (CASE WHEN {X.hash_sql('item_id', SEED)}
          < '{X.threshold_hex(0.1)}' AND split = 'train' THEN NULL ELSE deal_probability END
          AS deal_probability) FROM ads"""),)

    @query(name, ids, oracle=sql(body, *extra))
    def run(spark, sf_dir):
        a = ads(spark, sf_dir)
        if masked:
            hold = X.in_fraction("item_id", SEED, 0.1) & (F.col("split") == "train")
            a = G.mask_target(a, "deal_probability", hold)
        return _present(G.group_features(a, feats), feats)

    run.__name__ = f"q_{name}"
    return run


_register("group_freq", "A1 J1", [G.feature(ks, None, "freq") for ks in G.FREQ_SETS]
          + [G.feature(["region", "city"], None, "freq")])
_register("group_count", "A2 J1", [G.feature(["user_id"], "price", "count"),
                                   G.feature(["city"], "param_2", "count")])
_register("group_mean", "A3 J1", [G.feature(["region", "parent_category_name"], "deal_probability", "mean"),
                                  G.feature(["user_type"], "price", "mean")])
_register("group_var", "A4 J1", [G.feature(["city", "user_type"], "deal_probability", "var"),
                                 G.feature(["parent_category_name"], "price", "var")])
_register("group_std", "A5 J1", [G.feature(["city", "user_type"], "deal_probability", "std"),
                                 G.feature(["region"], "price", "std")])
_register("group_nunique", "A6 J1", [G.feature(ks[:-1], ks[-1], "nunique") for ks in G.NUNIQUE_SETS]
          + [G.feature(["user_id"], "category_name", "nunique")])
_register("group_cumcount", "A7 W1", [G.feature(["user_id"], "item_id", "cumcount"),
                                      G.feature(["user_type", "region"], "item_id", "cumcount")])
_register("target_mean_family", "A8 J1", G.family(G.MEAN_KEY_SETS, "deal_probability", "mean"))
_register("price_mean_family", "A9 J1", G.family(G.MEAN_KEY_SETS, "price", "mean"))
_register("target_var_family", "A10 J1", G.family(G.VAR_KEY_SETS, "deal_probability", "var"))
_register("price_var_family", "A11 J1", G.family(G.VAR_KEY_SETS, "price", "var"))
_register("leak_safe_target_stats", "A12 X1",
          G.family(G.MEAN_KEY_SETS, "deal_probability", "mean")
          + G.family(G.VAR_KEY_SETS, "deal_probability", "var"), masked=True)


@query("hash_split", "X1",
       oracle=sql(f"""SELECT item_id, split,
  {X.hash_sql('item_id', SEED)} < '{X.threshold_hex(0.1)}' AS is_holdout FROM ads"""))
def q_hash_split(spark, sf_dir):
    return X.hash_split(ads(spark, sf_dir).select("item_id", "split"), "item_id", SEED, 0.1)


@query("nested_split", "X2",
       oracle=sql(f"""SELECT item_id, CASE
  WHEN {X.hash_sql('item_id', SEED)} < '{X.threshold_hex(0.2)}' THEN 'local_test'
  WHEN {X.hash_sql('item_id', SEED + 1)} < '{X.threshold_hex(0.1)}' THEN 'valid'
  ELSE 'train' END AS part FROM ads"""))
def q_nested_split(spark, sf_dir):
    return X.nested_split(ads(spark, sf_dir).select("item_id"), "item_id", (SEED, SEED + 1), (0.2, 0.1))


@query("hash_sample", "X3",
       oracle=sql(f"""SELECT item_id, user_id, price FROM ads
WHERE {X.hash_sql('item_id', SEED)} < '{X.threshold_hex(0.01)}'"""))
def q_hash_sample(spark, sf_dir):
    return X.hash_sample(ads(spark, sf_dir).select("item_id", "user_id", "price"), "item_id", SEED, 0.01)
