"""Group-statistic features joined back to every row.

A feature is (key columns, value column, statistic). All key sets without an
entity key (a user) share ONE aggregation of the rows, by the union of their keys;
the single key sets are derived from that smaller table, and the rows are joined
once with the result. Key sets with an entity key share another one. Partial
aggregation combines a hot key map-side before the shuffle; rows with a null key
get a null feature, as in pandas. AQE turns the joins into broadcasts when the
aggregates are small at run time (their measured size is the bound) and splits a
hot key's partition of the row side otherwise.
Windows over the key are avoided: an unbounded frame holds a whole group.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .ordinal import running_index

# The short column names used inside feature names.
SHORT_NAMES = {
    "item_id": "iid",
    "user_id": "uid",
    "region": "reg",
    "city": "cty",
    "parent_category_name": "pcn",
    "category_name": "cn",
    "param_1": "p1",
    "param_2": "p2",
    "param_3": "p3",
    "title": "tit",
    "description": "des",
    "price": "pr",
    "item_seq_number": "isn",
    "activation_date": "ad",
    "user_type": "uty",
    "image": "img",
    "image_top_1": "img1",
    "date_from": "dfr",
    "date_to": "dto",
    "deal_probability": "dp",
}

# Key sets of the target-mean and price-mean feature families
# (value column appended per family), in the reference's order.
MEAN_KEY_SETS = [
    ["user_id"],
    ["user_id", "parent_category_name"],
    ["user_id", "parent_category_name", "category_name"],
    ["user_id", "category_name"],
    ["user_type"],
    ["user_type", "parent_category_name"],
    ["user_type", "parent_category_name", "category_name"],
    ["user_type", "category_name"],
    ["region"],
    ["region", "parent_category_name"],
    ["region", "parent_category_name", "category_name"],
    ["region", "user_type"],
    ["region", "user_type", "parent_category_name"],
    ["region", "user_type", "parent_category_name", "category_name"],
    ["city"],
    ["city", "parent_category_name"],
    ["city", "parent_category_name", "category_name"],
    ["city", "user_type"],
    ["city", "user_type", "parent_category_name"],
    ["city", "user_type", "parent_category_name", "category_name"],
    ["parent_category_name"],
    ["parent_category_name", "category_name"],
    ["category_name"],
]
# The variance families use the same key sets without the user_id ones.
VAR_KEY_SETS = [ks for ks in MEAN_KEY_SETS if "user_id" not in ks]

# Key lists declared for the count / nunique / freq statistics.
COUNT_SETS = [["user_id"]]
NUNIQUE_SETS = [["city", "category_name"]]
FREQ_SETS = [["user_id"]]

STATISTICS = ("freq", "count", "mean", "var", "std", "nunique", "cumcount")


def short(col: str) -> str:
    return SHORT_NAMES.get(col, col)


def feature_name(keys: Sequence[str], value: str | None, stat: str) -> str:
    """``<keys>_<stat>_<value>``, or ``<keys>_freq``, with short names."""
    head = "_".join(short(k) for k in keys)
    if stat == "freq":
        return f"{head}_freq"
    return f"{head}_{stat}_{short(value)}"


@dataclass(frozen=True)
class Feature:
    keys: tuple[str, ...]
    value: str | None
    stat: str

    @property
    def name(self) -> str:
        return feature_name(self.keys, self.value, self.stat)



def feature(keys: Sequence[str], value: str | None, stat: str) -> Feature:
    if stat not in STATISTICS:
        raise ValueError(f"unknown statistic {stat}")
    if stat != "freq" and value is None:
        raise ValueError(f"{stat} needs a value column")
    return Feature(tuple(keys), value, stat)


def family(key_sets: Iterable[Sequence[str]], value: str, stat: str) -> list[Feature]:
    return [feature(ks, value, stat) for ks in key_sets]


def _agg(f: Feature) -> Column:
    v = F.col(f.value) if f.value else None
    if f.stat == "freq":
        return F.count(F.lit(1)).alias(f.name)
    if f.stat == "count":
        return F.count(v).alias(f.name)
    if f.stat == "mean":
        return F.avg(v).alias(f.name)
    if f.stat == "var":
        return F.var_samp(v).alias(f.name)
    if f.stat == "std":
        return F.stddev_samp(v).alias(f.name)
    if f.stat == "nunique":
        return F.count_distinct(v).alias(f.name)
    raise ValueError(f.stat)


def _all_keys(keys: Sequence[str]) -> Column:
    """No key is null."""
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).isNotNull()
    return out


def key_set_aggregates(df: DataFrame, features: Sequence[Feature]) -> "OrderedDict[tuple, DataFrame]":
    """One aggregate table per distinct key set, holding all its features.
    Null keys are dropped (pandas ``groupby`` drops them too)."""
    by_keys: OrderedDict[tuple, list[Feature]] = OrderedDict()
    for f in features:
        if f.stat == "cumcount":
            continue
        by_keys.setdefault(f.keys, []).append(f)
    out: OrderedDict[tuple, DataFrame] = OrderedDict()
    for keys, fs in by_keys.items():
        out[keys] = df.where(_all_keys(keys)).groupBy(*keys).agg(*[_agg(f) for f in fs])
    return out


# Statistics that follow from the counts, means and squared deviations of parts.
MERGEABLE = ("freq", "count", "mean", "var", "std")
# Key columns with about as many values as there are users: key sets with one of
# them are aggregated together, and all others together.
ENTITY_KEYS = frozenset({"user_id", "item_id"})


def _merged(f: Feature) -> Column:
    """The feature of a group from its parts (see ``shared_aggregates``)."""
    if f.stat == "freq":
        return F.sum("__rows").alias(f.name)
    n, m, q = (F.col(f"__{x}_{f.value}") for x in "nmq")
    count = F.sum(n)
    if f.stat == "count":
        return count.alias(f.name)
    mean = F.sum(n * m) / F.when(count > 0, count)
    if f.stat == "mean":
        return mean.alias(f.name)
    # squared deviations of all parts around the common mean
    total = F.sum(q) + F.sum(n * m * m) - count * mean * mean
    var = F.when(count > 1, F.greatest(total, F.lit(0.0)) / (count - 1))
    return (F.sqrt(var) if f.stat == "std" else var).alias(f.name)


def shared_aggregates(df: DataFrame, features: Sequence[Feature]) -> tuple[DataFrame, list[str]]:
    """All ``features`` of several key sets as one table over the union of their
    keys. The rows are aggregated once, by the union (counts, means and squared
    deviations, combined map-side); each key set is derived from that smaller
    table and joined back to it, so the rows need one join for all key sets."""
    union = list(dict.fromkeys(k for f in features for k in f.keys))
    values = list(dict.fromkeys(f.value for f in features if f.value))
    parts = [F.count(F.lit(1)).alias("__rows")]
    for v in values:
        parts += [F.count(v).alias(f"__n_{v}"), F.coalesce(F.avg(v), F.lit(0.0)).alias(f"__m_{v}"),
                  F.coalesce(F.var_pop(v) * F.count(v), F.lit(0.0)).alias(f"__q_{v}")]
    fine = materialize(df.groupBy(*union).agg(*parts))
    by_keys: OrderedDict[tuple, list[Feature]] = OrderedDict()
    for f in features:
        by_keys.setdefault(f.keys, []).append(f)
    out = fine.select(*union)
    for keys, fs in by_keys.items():
        derived = fine.where(_all_keys(keys)).groupBy(*keys).agg(*[_merged(f) for f in fs])
        out = out.join(derived, list(keys), "left")
    return out, union


def _join_null_safe(rows: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on keys of which nulls are equal."""
    right = table.withColumnsRenamed({k: f"__k_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    return rows.join(right, on, "left").drop(*[f"__k_{k}" for k in keys])


def group_features(df: DataFrame, features: Sequence[Feature], row_key: str = "item_id",
                   order: Sequence[str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """``row_key`` (+ ``keep`` columns) and one column per feature, one row per
    input row. ``order`` is the row order used by ``cumcount`` (default: the
    row key)."""
    needed = {row_key, *keep}
    for f in features:
        needed.update(f.keys)
        if f.value:
            needed.add(f.value)
    base = df.select(*[c for c in df.columns if c in needed])
    out, alone = base, []
    for entity in (True, False):
        group = [f for f in features if f.stat in MERGEABLE and bool(ENTITY_KEYS & set(f.keys)) == entity]
        if len({f.keys for f in group}) > 1:
            out = _join_null_safe(out, *shared_aggregates(base, group))
        else:
            alone += group
    alone += [f for f in features if f.stat not in MERGEABLE]
    for keys, agg in key_set_aggregates(base, alone).items():
        out = out.join(agg, list(keys), "left")
    for f in features:
        if f.stat == "cumcount":
            idx = running_index(base.select(row_key, *f.keys, *(order or [])), f.keys,
                                [*(order or []), row_key], f.name)
            out = out.join(idx.select(row_key, f.name), row_key, "left")
    return out.select(row_key, *keep, *[f.name for f in features])


def group_feature(df: DataFrame, keys: Sequence[str], value: str | None, stat: str,
                  row_key: str = "item_id") -> DataFrame:
    """A single feature: ``row_key`` and the feature column."""
    return group_features(df, [feature(keys, value, stat)], row_key)


def mask_target(df: DataFrame, target: str, in_holdout: Column) -> DataFrame:
    """Null the target on hold-out rows before target statistics are computed,
    so a hold-out row never sees its own target through a group feature."""
    return df.withColumn(target, F.when(in_holdout, F.lit(None).cast("double"))
                         .otherwise(F.col(target)))
