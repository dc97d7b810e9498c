"""Scalar column expressions: null markers, fills, logs, clipping, dates,
file-name parts, run stamps (P6-P11, P16, P17, D1-D5). All built-in, so they
stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sentinel_to_null(c: str | Column, numeric: bool = False) -> Column:
    """The value '0' (or 0 for numbers) marks a missing value."""
    x = _c(c)
    return F.when(x == F.lit(0 if numeric else "0"), F.lit(None)).otherwise(x)


def log_plus(c: str | Column, offset: float = 0.001) -> Column:
    """P10: ``ln(x + offset)``; null and non-positive results stay null."""
    return F.log(_c(c) + F.lit(offset))


def log1p(c: str | Column) -> Column:
    return F.log1p(_c(c))


def clip(c: str | Column, lo: float = 0.0, hi: float = 1.0) -> Column:
    """Bound to [lo, hi]; a null stays null (``greatest`` / ``least``
    skip nulls, so they are guarded)."""
    x = _c(c)
    return F.when(x.isNull(), F.lit(None)).otherwise(F.greatest(F.lit(lo), F.least(F.lit(hi), x)))


def join_text(*cols: str | Column, sep: str = " ", null_as: str = "nan") -> Column:
    """Join values with ``sep``, writing a null as ``null_as`` (how the
    reference prints a missing value when it joins text columns)."""
    return F.concat_ws(sep, *[F.coalesce(_c(c).cast("string"), F.lit(null_as)) for c in cols])


def pair_key(a: str | Column, b: str | Column, sep: str = "_") -> Column:
    """``a_b``; null when either part is null."""
    return F.concat(_c(a), F.lit(sep), _c(b))


def iso_week(c: str | Column) -> Column:
    """ISO week number."""
    return F.weekofyear(_c(c))


def weekday_monday0(c: str | Column) -> Column:
    """Day of week with Monday = 0."""
    return F.weekday(_c(c))


def day_of_month(c: str | Column) -> Column:
    """D3."""
    return F.dayofmonth(_c(c))


def run_stamp(ts: str | Column) -> Column:
    """``YYYYMMDDHH`` text of a timestamp."""
    return F.date_format(_c(ts), "yyyyMMddHH")


def file_base(path: str | Column) -> Column:
    """Last path element."""
    return F.element_at(F.split(_c(path), "/"), -1)


def file_stem(path: str | Column) -> Column:
    """Last path element without its extension, lower case."""
    return F.lower(F.regexp_extract(file_base(path), r"^(.*?)(\.[^.]*)?$", 1))


def file_ext(path: str | Column) -> Column:
    return F.lower(F.regexp_extract(file_base(path), r"\.([^./]*)$", 1))
