"""Failed-row samples (APP-8, DST-19, LIM-1/2, PRJ-8).

For every check that defines failing rows, take at most ``limit`` of them
in a fixed order, prefixed by a ``failed_check`` column, and union the
checks into one DataFrame. Checks whose failing rows are a row condition are sampled together from
one scan with a per-check ``row_number`` limit (partial ``WindowGroupLimit``
before the shuffle); the others each take an ordered ``limit`` (planned as
``TakeOrderedAndProject``: a top-n per task, then a merge of n rows per
task). Either way a check that fails on every row stays cheap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowguard.functions.predicates import col, quote
from rowguard.operators.metrics import MetricCheck

FAILED_CHECK = "failed_check"


#: columns beside the order keys up to which rows are ranked whole, in one pass
NARROW_COLUMNS = 4


def _ordered_head(rows: DataFrame, order_by: Sequence[str] | None, limit: int | None) -> DataFrame:
    if limit is None:
        return rows
    keys = list(order_by) if order_by else rows.columns
    return rows.orderBy(*[col(k).asc_nulls_first() for k in keys]).limit(int(limit))


def failed_rows(df: DataFrame, check: MetricCheck) -> DataFrame | None:
    """All failing rows of one check (its failed-rows SQL query when given)."""
    if check.failed_rows_query:
        return df.sparkSession.sql(check.failed_rows_query)
    return check.measure.failing_rows(df)


def _has_plan(df: DataFrame, check: MetricCheck) -> bool:
    """Whether the check's failing rows can be asked for (analysis, no job)."""
    try:
        cond = None if check.failed_rows_query else check.measure.row_condition(df)
        rows = failed_rows(df, check) if cond is None else df.select(cond)
        return rows is None or bool(rows.columns)
    except AnalysisException:
        return False


def _fused_samples(df: DataFrame, fused: list[tuple[str, F.Column, int]],
                   order_by: Sequence[str] | None) -> DataFrame:
    """Samples of all limited row-condition checks from ONE scan: each row
    carries the names of the checks it fails, exploded to (check, row)
    pairs; the first n per check come from ``row_number`` over the check
    name with a literal cap, which Spark plans as a partial
    ``WindowGroupLimit`` before the shuffle (at most n rows per check leave
    each task, so the window partition of a check stays small). With order keys
    a first narrow pass ranks these alone, so wide rows are neither sorted nor
    moved if there are many columns; the second pass fetches the rows that hold one of the kept keys and
    ranks them alike."""
    empty = F.array().cast(T.ArrayType(T.StringType(), False))
    names = F.concat(*[F.when(c, F.array(F.lit(n))).otherwise(empty) for n, c, _ in fused])
    keys = [k for k in (order_by or []) if k in df.columns] or df.columns
    w = Window.partitionBy(FAILED_CHECK).orderBy(*[col(k).asc_nulls_first() for k in keys])
    cap = max(n for _, _, n in fused)
    if len(df.columns) - len(keys) > NARROW_COLUMNS:
        # late: rank the order keys alone, then fetch the wide rows that have them
        heads = (df.select(F.explode(names).alias(FAILED_CHECK), *[F.col(quote(k)) for k in keys])
                 .withColumn("__rg_rn", F.row_number().over(w)).where(F.col("__rg_rn") <= F.lit(cap)))
        heads = heads.select(*[F.col(quote(k)).alias(f"__rg_k{i}") for i, k in enumerate(keys)]).distinct()
        same = [col(k).eqNullSafe(F.col(f"__rg_k{i}")) for i, k in enumerate(keys)]
        df = df.join(F.broadcast(heads), same, "left_semi")  # at most n rows a check
    exploded = df.select(F.explode(names).alias(FAILED_CHECK), *[F.col(quote(c)) for c in df.columns])
    out = exploded.withColumn("__rg_rn", F.row_number().over(w)).where(F.col("__rg_rn") <= F.lit(cap))
    if any(n != cap for _, _, n in fused):
        per_check = F.create_map(*[x for name, _, n in fused for x in (F.lit(name), F.lit(n))])
        out = out.where(F.col("__rg_rn") <= per_check[F.col(FAILED_CHECK)])
    return out.drop("__rg_rn")


def samples(
    df: DataFrame,
    checks: Sequence[MetricCheck],
    limit: int | None = 3,
    order_by: Sequence[str] | None = None,
) -> DataFrame | None:
    """Samples of all checks: ``failed_check`` + the checked frame's columns.

    ``limit`` is the scan-wide default, a check's ``samples_limit`` wins. The
    default does not apply to a failed-rows SQL query, which says itself how
    many rows it wants; only the check's own ``samples_limit`` cuts it.
    Checks whose failing rows are a row condition share one scan; the
    others (duplicate groups, reference keys) each take an ordered limit of
    their own failing rows. Verdicts are not looked at: a check that passes
    within its tolerance still shows the rows that failed it. A check that
    names an unknown column or has a wrong query shows none. Returns ``None``
    when no check defines failing rows.
    """
    parts, fused = [], []
    for check in checks:
        if not _has_plan(df, check):
            continue  # its result row says why
        n = check.samples_limit
        if n is None and not check.failed_rows_query:
            n = limit  # a query without a limit of the check's own runs as written
        if not check.failed_rows_query and n is not None:
            cond = check.measure.row_condition(df)
            if cond is not None:
                fused.append((check.name, cond, n))
                continue
        rows = failed_rows(df, check)
        if rows is None:
            continue
        keys = [k for k in (order_by or []) if k in rows.columns] or None
        head = _ordered_head(rows, keys, n)
        parts.append(head.select(F.lit(check.name).alias(FAILED_CHECK), *[F.col(quote(c)) for c in head.columns]))
    if fused:
        parts.insert(0, _fused_samples(df, fused, order_by))
    if not parts:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def slug(name_col) -> F.Column:
    """SNK-4 file naming: lower-case, trimmed, spaces to underscores."""
    return F.regexp_replace(F.trim(F.lower(name_col)), " ", "_")
