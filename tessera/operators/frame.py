"""Column-set and row-shape operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C

# Text columns and the names of their translated copies.
TRANSLATED = {
    "param_1": "param_1_en",
    "param_2": "param_2_en",
    "param_3": "param_3_en",
    "title": "title_en",
    "description": "description_en",
}

# The columns that get label codes.
CATEGORICAL = ["user_id", "region", "city", "parent_category_name",
               "category_name", "user_type", "image_top_1"]


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop the named columns; absent names are ignored."""
    return df.drop(*cols)


def keep_columns(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Keep only the listed columns that exist, in table order."""
    wanted = set(keep)
    return df.select(*[c for c in df.columns if c in wanted])


def keep_language(df: DataFrame, language: str, mapping: Mapping[str, str] = TRANSLATED) -> DataFrame:
    """Keep the source-language columns (``'russian'``: the keys of the
    map) or the translated ones (any other language: the values)."""
    keep = list(mapping.keys()) if language == "russian" else list(mapping.values())
    return keep_columns(df, keep)


def rename_back(df: DataFrame, mapping: Mapping[str, str] = TRANSLATED) -> DataFrame:
    """Rename translated columns back to their source names."""
    inverted = {v: k for k, v in mapping.items()}
    return df.withColumnsRenamed({c: inverted[c] for c in df.columns if c in inverted})


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """P5: cast listed columns (``'date'`` / ``'timestamp'`` parse text
    leniently: unparseable text becomes null)."""
    out = {}
    for c, t in types.items():
        if c not in df.columns:
            continue
        if t == "timestamp":
            out[c] = F.try_to_timestamp(F.col(c).cast("string"))
        elif t == "date":
            out[c] = F.to_date(F.try_to_timestamp(F.col(c).cast("string")))
        else:
            out[c] = F.col(c).cast(t)
    return df.withColumns(out)


# Spark types of the statistics, in the order in which a feature
# name is searched for them (a name with "count" in it is a count).
STATISTIC_TYPES = {"count": "long", "nunique": "long", "cumcount": "long",
                   "var": "double", "std": "double", "mean": "double"}


def type_of_feature(name: str) -> str | None:
    """P5: the type that a feature's name implies (None: none)."""
    return next((t for word, t in STATISTIC_TYPES.items() if word in name), None)


def cast_by_name(df: DataFrame) -> DataFrame:
    """P5: every column whose name implies a type is cast to it."""
    return cast_columns(df, {c: t for c in df.columns if (t := type_of_feature(c))})


def fill_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace nulls per column with a constant."""
    return df.fillna(dict(values))


def fill_mean(df: DataFrame, column: str) -> DataFrame:
    """Replace nulls with the column mean (one aggregate, one number)."""
    mean = df.agg(F.avg(column)).first()[0]
    if mean is None:
        return df
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(float(mean))))


def sentinels_to_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P6 on whole columns."""
    return df.withColumns({c: C.sentinel_to_null(c) for c in cols if c in df.columns})


def date_filter(df: DataFrame, column: str, cutoff: str, upto: bool = True) -> DataFrame:
    """Rows up to (or after) a cut-off date."""
    limit = F.lit(cutoff).cast("date")
    return df.where(F.col(column) <= limit if upto else F.col(column) > limit)


def exclude_names(df: DataFrame, column: str, fragments: Sequence[str]) -> DataFrame:
    """Keep rows whose name contains none of the fragments."""
    cond = F.lit(True)
    for frag in fragments:
        cond = cond & ~F.col(column).contains(frag)
    return df.where(cond)


def time_features(df: DataFrame, column: str = "activation_date", row_key: str = "item_id") -> DataFrame:
    """ISO week, weekday (Monday = 0) and day of month."""
    return df.select(row_key, C.iso_week(column).alias("week"),
                     C.weekday_monday0(column).alias("weekday"),
                     C.day_of_month(column).alias("day"))


def attach_features(df: DataFrame, features: Sequence[DataFrame], key: str = "item_id") -> DataFrame:
    """Left-join feature tables on the row key; a feature column whose
    name is already present is skipped (the reference's rule)."""
    out = df
    for f in features:
        new = [c for c in f.columns if c != key and c not in out.columns]
        if new:
            out = out.join(f.select(key, *new), key, "left")
    return out


def split_label(train: DataFrame, test: DataFrame, target: str, key: str = "item_id"):
    """(stacked features with a ``split`` column, label table)."""
    labels = train.select(key, target)
    stacked = (train.drop(target).withColumn("split", F.lit("train"))
               .unionByName(test.drop(target).withColumn("split", F.lit("test")),
                            allowMissingColumns=True))
    return stacked, labels


def dimension_lookup(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Left join of a literal dimension table. The table is a literal
    (its rows are in the code), so its size is known and it is broadcast."""
    return df.join(F.broadcast(dim), key, "left")


def label_encode(df: DataFrame, columns: Sequence[str], row_key: str = "item_id",
                 names: Mapping[str, str] | None = None) -> DataFrame:
    """M1: ``row_key`` plus one code column per categorical column: the
    distinct non-null values of each column numbered 0.. in sorted order
    (numbers numerically, text by code point). All columns are numbered in
    ONE distributed ranking (key = column name), then each code table is
    joined back on its value."""
    from pyspark.sql.types import NumericType

    from .ordinal import running_index

    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)}
    out = df.select(row_key, *columns)
    vals = None
    for c in columns:
        part = out.where(F.col(c).isNotNull()).select(
            F.lit(c).alias("__col"),
            (F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")).alias("__num"),
            F.col(c).cast("string").alias("__v")).distinct()
        vals = part if vals is None else vals.unionByName(part)
    # one table of codes for all columns, cut from its lineage once: each
    # column's join-back reads it instead of recomputing the ranking
    from ..session import materialize
    codes = materialize(running_index(vals, ["__col"], ["__num", "__v"], "__code"))
    for c in columns:
        name = (names or {}).get(c, f"{c}_encoded")
        table = codes.where(F.col("__col") == c).select(F.col("__v").alias("__key"),
                                                        F.col("__code").alias(name))
        out = out.join(table, F.col(c).cast("string") == F.col("__key"), "left").drop("__key")
    return out.select(row_key, *[(names or {}).get(c, f"{c}_encoded") for c in columns])
