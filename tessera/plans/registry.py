"""Registry of named queries (Spark) and their DuckDB oracle SQL.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the supplied tables or
views derived from them. Oracle SQL is registered next to the query; queries
that SQL cannot express (model fitting, iterative or randomised ones) have none
and are checked by row counts and tests instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path
from . import fixtures

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
IDS: dict[str, str] = {}


def query(name: str, ids: str, oracle: str | None = None):
    """Register ``fn`` under ``name``; ``ids`` lists the SURVEY operator ids."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        IDS[name] = ids
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


_VIEW_CACHE: dict[tuple[str, str, str], DataFrame] = {}


def _cached(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """Build a derived view once per session and table folder, written as a
    Parquet table under the shared checkpoint folder: later queries read it
    with column pruning (a wide text column is not read by queries that do
    not use it) and lineage is cut."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _VIEW_CACHE:
        path = scratch_path(spark, f"view-{name}")
        build(spark, sf_dir).write.mode("overwrite").parquet(path)
        _VIEW_CACHE[key] = spark.read.parquet(path)
    return _VIEW_CACHE[key]


def ads(spark: SparkSession, sf_dir: str, text: bool = False) -> DataFrame:
    """The ads view, built once per session and table folder (a written table);
    ``text``: with the description, joined when it is read."""
    narrow = _cached(spark, sf_dir, "ads", fixtures.ads)
    return fixtures.with_description(spark, sf_dir, narrow) if text else narrow


def periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.periods(spark, sf_dir)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return fixtures.table(spark, sf_dir, name)


def sql(body: str, *extra: tuple[str, str]) -> str:
    return fixtures.with_views(body, *extra)


# Check queries report doubles rounded to 6 decimals with plain double
# arithmetic (the engines' ``round`` functions differ on halves). Sums taken in
# a different order differ in the last bits, which would flip exact halves
# (a mean over 128 rows often ends in 5 at the 7th decimal), so halves are
# nudged up by 1e-9 before flooring: both engines land on the same side.
_NUDGE = 0.5 + 1e-3


def r6(c):
    from pyspark.sql import functions as F
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c * F.lit(1e6) + F.lit(_NUDGE)) / F.lit(1e6)


def r6sql(expr: str) -> str:
    one_m = "CAST(1000000 AS DOUBLE)"
    return f"(floor(({expr}) * {one_m} + CAST({_NUDGE!r} AS DOUBLE)) / {one_m})"
