"""Dataset aggregates used as row conditions (DST-5 / DST-6).

An aggregate over the whole frame is computed once as a *scalar subquery*:
Spark runs the partial/final aggregate as its own small job, and the one
value is then used like a literal inside the row projection. There is no
join and no ``Window.partitionBy()`` (which would pull all rows into one
task); identical subqueries are reused by AQE. With group columns the
aggregate is one row per group (partial + final hash aggregate) and is
joined back on the group keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowguard.functions.predicates import col
from rowguard.operators import keys as K

AGGREGATES = {
    "count": lambda c: F.count(c),
    "count_rows": lambda c: F.count(F.lit(1)),
    "sum": F.sum,
    "avg": F.avg,
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "stddev": F.stddev_samp,
    "count_distinct": lambda c: F.count_distinct(c),
    "approx_count_distinct": lambda c: F.approx_count_distinct(c),
}


def expression(e) -> Column:
    """A column by its exact name, or a Column (``F.expr(text)`` for SQL text)."""
    return e if isinstance(e, Column) else col(e)


def aggregate(aggr_type: str, e) -> Column:
    try:
        fn = AGGREGATES[aggr_type]
    except KeyError:
        raise ValueError(f"unknown aggregate {aggr_type!r}; one of {sorted(AGGREGATES)}") from None
    return fn(expression(e))


def scalar_aggregate(df: DataFrame, aggr_type: str, e) -> Column:
    """The aggregate of ``e`` over all of ``df`` as a scalar-subquery Column."""
    return df.select(aggregate(aggr_type, e).alias("v")).scalar()


def mark_group_violations(
    df: DataFrame, source: DataFrame, aggr_type: str, e, group_by: Sequence[str],
    violated, flag: str, hot_key_rows: int = K.HOT_KEY_ROWS,
) -> DataFrame:
    """Add boolean ``flag`` = the row's group aggregate violates the limit
    (``violated``: Column -> Column) and ``{flag}_v`` = that aggregate.

    One row per group (partial + final aggregate), only violating groups
    are joined back, hot groups split (see ``keys.mark_keys``); NULL groups
    match NULL groups.
    """
    names = [f"{flag}_g{i}" for i in range(len(group_by))]
    count_name, value = f"{flag}_n", f"{flag}_v"
    per_group = source.groupBy(*[col(g).alias(k) for g, k in zip(group_by, names)]).agg(
        aggregate(aggr_type, e).alias(value), F.count(F.lit(1)).alias(count_name))
    bad = per_group.where(F.coalesce(violated(F.col(value)), F.lit(False)))
    return K.mark_keys(df, group_by, bad, names, count_name, flag, null_safe=True,
                       hot_key_rows=hot_key_rows, extra=[value])
