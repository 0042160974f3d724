"""APP-2: a suite of expectations on one (pre-joined) frame.

Each ``expect_*`` builder returns a :class:`MetricCheck` whose ``fail``
threshold encodes the expectation's success rule; ``validate`` evaluates
the suite with the fused metrics engine and adds ``success``.
``suite_statistics`` and ``failed_expectations`` give the report
(VRD-7 / VRD-8) as DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowguard import checks as C
from rowguard.operators import metrics as M


def _mostly(mostly: float) -> M.Threshold:
    return M.when("<", float(mostly), on="pass_ratio")


def _name(name, kind, *cols):
    return name or f"{kind}({', '.join(str(c) for c in cols)})"


def expect_values_match_regex(column, regex, mostly=1.0, name=None) -> M.MetricCheck:
    """Non-null values match ``regex``; share of matching non-null values >= mostly."""
    return M.MetricCheck(_name(name, "values_match_regex", column),
                         M.FailingRows(C.RegexMatch(column, regex), metric_name="unexpected_count"),
                         fail=_mostly(mostly))


def expect_values_in_set(column, values, mostly=1.0, name=None) -> M.MetricCheck:
    return M.MetricCheck(_name(name, "values_in_set", column),
                         M.FailingRows(C.InList(column, values), metric_name="unexpected_count"),
                         fail=_mostly(mostly))


def expect_distinct_values_in_set(column, values, name=None) -> M.MetricCheck:
    """DST-7: every distinct non-null value is in ``values`` (nulls ignored)."""
    return M.MetricCheck(_name(name, "distinct_values_in_set", column),
                         M.DistinctInSet(column, tuple(values)), fail=M.when(">", 0))


def expect_pair_a_greater_than_b(column_a, column_b, or_equal=False, mostly=1.0, name=None) -> M.MetricCheck:
    """ROW-5 as expectation: a > b (>= with or_equal) where both non-null."""
    return M.MetricCheck(_name(name, "pair_a_greater_than_b", column_a, column_b),
                         M.FailingRows(C.PairGreater(column_a, column_b, or_equal), metric_name="unexpected_count"),
                         fail=_mostly(mostly))


def expect_pair_equal(column_a, column_b, mostly=1.0, name=None) -> M.MetricCheck:
    """ROW-6 as expectation: a <=> b over all rows."""
    return M.MetricCheck(_name(name, "pair_equal", column_a, column_b),
                         M.FailingRows(C.PairEqual(column_a, column_b), nulls_considered=True,
                                       metric_name="unexpected_count"),
                         fail=_mostly(mostly))


def expect_not_null(column, mostly=1.0, name=None) -> M.MetricCheck:
    return M.MetricCheck(_name(name, "not_null", column),
                         M.FailingRows(C.NotNull(column), nulls_considered=True, metric_name="unexpected_count"),
                         fail=_mostly(mostly))


def _between(min_value, max_value):
    out = []
    if min_value is not None:
        out.append(M.when("<", min_value))
    if max_value is not None:
        out.append(M.when(">", max_value))
    return out or None


def expect_min_between(column, min_value=None, max_value=None, name=None) -> M.MetricCheck:
    """DST-9: inclusive; an absent bound is open; a text bound is compared
    after Spark's implicit cast to the column type."""
    return M.MetricCheck(_name(name, "min_between", column), M.Aggregate(column, "min"),
                         fail=_between(min_value, max_value) or M.when("null"))


def expect_max_between(column, min_value=None, max_value=None, name=None) -> M.MetricCheck:
    return M.MetricCheck(_name(name, "max_between", column), M.Aggregate(column, "max"),
                         fail=_between(min_value, max_value) or M.when("null"))


def expect_mean_between(column, min_value=None, max_value=None, name=None) -> M.MetricCheck:
    """DST-8: inclusive; a NULL mean (no rows) fails."""
    return M.MetricCheck(_name(name, "mean_between", column), M.Aggregate(column, "avg"),
                         fail=_between(min_value, max_value) or M.when("null"))


def expect_quantiles_between(column, quantiles, value_ranges, method="approx", name=None) -> M.MetricCheck:
    """DST-10: each quantile within its inclusive range (``None`` = open).

    ``method='approx'`` (default) is ``percentile_approx``: bounded memory
    per task at any scale. ``'disc'`` / ``'cont'`` are exact, but Spark's
    exact percentiles keep every distinct value in the aggregation state and
    merge it in one task: use them for low-cardinality columns and checks."""
    return M.MetricCheck(_name(name, "quantiles_between", column),
                         M.Quantiles(column, tuple(quantiles), tuple(tuple(r) for r in value_ranges), method))


def expect_compound_unique(columns, mostly=1.0, name=None) -> M.MetricCheck:
    """DST-2: share of rows outside duplicate groups (over rows with a
    complete key) >= mostly."""
    return M.MetricCheck(_name(name, "compound_unique", *columns),
                         M.Duplicates(tuple(columns), percent=False), fail=_mostly(mostly))


def validate(df: DataFrame, expectations: Sequence[M.MetricCheck]) -> DataFrame:
    """Results with ``success`` = outcome is pass, and ``unexpected_pct``
    = failed over considered rows (0 when none)."""
    res = M.evaluate(df, expectations)
    return res.select(
        "*",
        (F.col("outcome") == "pass").alias("success"),
        F.coalesce(F.try_divide(F.col("failed_rows") * F.lit(100.0), F.col("considered_rows")), F.lit(0.0))
        .alias("unexpected_pct"),
    )


def suite_statistics(results: DataFrame) -> DataFrame:
    """VRD-7: evaluated, successful, success percent, overall success."""
    return results.agg(
        F.count(F.lit(1)).alias("evaluated"),
        F.count_if(F.col("success")).alias("successful"),
        F.coalesce(F.try_divide(F.count_if(F.col("success")) * F.lit(100.0), F.count(F.lit(1))), F.lit(100.0))
        .alias("success_percent"),
        (F.count_if(~F.col("success")) == 0).alias("success"),
    )


def failed_expectations(results: DataFrame) -> DataFrame:
    """VRD-8: failed expectations with their metric and unexpected percent."""
    return results.where(~F.col("success")).select("check", "metric", "unexpected_pct")
