"""Row-level failing conditions.

Every function here returns a boolean Catalyst ``Column`` that is ``True``
when a row *fails* and is never ``NULL`` (a ``NULL`` condition would make
``when(cond, ...)`` silently pass and ``count_if`` silently skip).  All of
them are plain built-in expressions, so they stay inside whole-stage codegen
and work unchanged on streaming DataFrames.

Null model: a value check that sees ``NULL`` does not fail; only the
completeness checks (:func:`is_null`, :func:`is_missing`) report nulls.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    """A column by name (resolved by Spark, case-insensitively) or as given."""
    if isinstance(c, Column):
        return c
    return F.col(quote(c))


def quote(name: str) -> str:
    """Back-quote a plain column name so dots, dashes and spaces survive."""
    if name.startswith("`") or "." not in name and "-" not in name and " " not in name:
        return name
    return "`" + name.replace("`", "``") + "`"


def value(v) -> Column:
    """A limit given as Column, number, string, date or datetime."""
    if isinstance(v, Column):
        return v
    if isinstance(v, _dt.datetime):
        # parquet timestamps are read as timestamp_ntz; the literal is built
        # from text so neither the Python nor the session time zone shifts it
        if v.tzinfo is not None:
            v = v.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        return F.lit(v.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(v)


def never_null(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def data_type(df: DataFrame, c: ColumnLike) -> T.DataType:
    """Type of a column, resolved through the DataFrame (never by string match)."""
    return df.select(col(c)).schema.fields[0].dataType


# --------------------------------------------------------------- row checks

def is_null(c: ColumnLike) -> Column:
    """ROW-7: fail when the value is NULL."""
    return col(c).isNull()


def is_missing(c: ColumnLike, dtype: T.DataType, trim_strings: bool = False) -> Column:
    """ROW-8: fail when NULL, an empty string, or a float/double NaN.

    Dispatched on the column type: ``isnan`` on a string raises under ANSI,
    and ``= ''`` on a number would cast.
    """
    x = col(c)
    cond = x.isNull()
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        s = F.trim(x) if trim_strings else x
        cond = cond | (s == F.lit(""))
    elif isinstance(dtype, (T.FloatType, T.DoubleType)):
        cond = cond | F.isnan(x)
    return never_null(cond)


def regex_mismatch(c: ColumnLike, pattern: str) -> Column:
    """ROW-1: fail when a non-null value does not match ``pattern``.

    Find semantics (``rlike``); anchors are written by the user.
    """
    x = col(c)
    return never_null(x.isNotNull() & ~x.rlike(pattern))


def not_in_list(c: ColumnLike, allowed: Sequence) -> Column:
    """ROW-2: fail when a non-null value is not one of ``allowed``."""
    if any(a is None for a in allowed):
        raise ValueError("allowed values must not contain None")
    x = col(c)
    return never_null(x.isNotNull() & ~x.isin(list(allowed)))


def greater_than(c: ColumnLike, limit) -> Column:
    """ROW-3 / ROW-4: fail when value > limit (equal passes); nulls pass."""
    return never_null(col(c) > value(limit))


def less_than(c: ColumnLike, limit) -> Column:
    """Mirror of :func:`greater_than`: fail when value < limit."""
    return never_null(col(c) < value(limit))


def outside(c: ColumnLike, lo=None, hi=None, inclusive: bool = True) -> Column:
    """Fail when value is outside [lo, hi] (open end when a bound is None)."""
    x = col(c)
    cond = F.lit(False)
    if lo is not None:
        cond = cond | ((x < value(lo)) if inclusive else (x <= value(lo)))
    if hi is not None:
        cond = cond | ((x > value(hi)) if inclusive else (x >= value(hi)))
    return never_null(cond)


def pair_not_greater(a: ColumnLike, b: ColumnLike, or_equal: bool = False) -> Column:
    """ROW-5: fail when both are non-null and NOT (a > b) (``>=`` with or_equal)."""
    x, y = col(a), col(b)
    ok = (x >= y) if or_equal else (x > y)
    return never_null(x.isNotNull() & y.isNotNull() & ~ok)


def pair_not_equal(a: ColumnLike, b: ColumnLike) -> Column:
    """ROW-6: fail when a and b differ null-safely (one side null fails,
    both null passes)."""
    return ~col(a).eqNullSafe(col(b))


def older_than(c: ColumnLike, max_age_minutes: int, as_of) -> Column:
    """ROW-9: fail when value < as_of - max_age_minutes; nulls pass."""
    limit = value(as_of) - F.make_dt_interval(mins=F.lit(int(max_age_minutes)))
    return never_null(col(c) < limit)


def sql(condition: str) -> Column:
    """A failing condition written as SQL text (e.g. an in-check filter)."""
    return never_null(F.expr(condition))


# ----------------------------------------------------------------- helpers

def safe_divide(a: ColumnLike, b: ColumnLike) -> Column:
    """Division that gives NULL on a zero divisor instead of raising (ANSI)."""
    return F.try_divide(col(a), col(b))


def minutes_between(newer: Column, older: Column) -> Column:
    """Minutes from ``older`` to ``newer`` as double (fraction kept); works on
    timestamp_ntz and timestamp without a zone shift."""
    return F.timestamp_diff("MICROSECOND", older, newer) / F.lit(60_000_000.0)


def all_not_null(cols: Iterable[ColumnLike]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & col(c).isNotNull()
    return cond
