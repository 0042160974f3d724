"""APP-3: a declarative scan over named views, with warn/fail verdicts and
failed-row samples (DST-11..19, VRD-1/2/9, SRC-7).

Checks are :class:`MetricCheck` values built with the helpers below (one
per metric family of the requirement set). ``scan`` registers the given
frames as temp views (so user SQL can name them plainly), evaluates all
checks of the dataset with one fused aggregation plus one job per
group-by/join/SQL metric, and builds samples.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowguard import checks as C
from rowguard.operators import metrics as M
from rowguard.operators.samples import samples as _samples


@dataclass
class ScanResult:
    results: DataFrame
    samples: DataFrame | None

    def outcomes(self) -> DataFrame:
        return M.outcome_counts(self.results)


def register_views(frames: Mapping[str, DataFrame]) -> None:
    """SRC-7: make frames visible to SQL checks under their names."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def scan(
    frames: Mapping[str, DataFrame],
    dataset: str,
    checks: Sequence[M.MetricCheck],
    samples_limit: int | None = 3,
    sample_order: Sequence[str] | None = None,
    sample_sink: Callable[[DataFrame], None] | None = None,
    isolate_errors: bool = True,
) -> ScanResult:
    """Evaluate ``checks`` on ``frames[dataset]``; ``sample_sink`` (UDX-3)
    receives the samples DataFrame, e.g. ``writers.write_samples``.
    With ``isolate_errors`` (default) the metrics run now and run-time failures
    of single checks become ``error`` rows (VRD-9); without it the results are
    lazy and such a failure ends their query. Plan-time failures are isolated
    either way."""
    register_views(frames)
    df = frames[dataset]
    results = M.evaluate_isolated(df, checks) if isolate_errors else M.evaluate(df, checks)
    samples = _samples(df, checks, samples_limit, sample_order)
    if sample_sink is not None and samples is not None:
        sample_sink(samples)
    return ScanResult(results, samples)


# ------------------------------------------------------- check builders

def _fail_warn(fail, warn):
    return dict(fail=fail, warn=warn)


def invalid_count(name, column, regex=None, values=None, fail=M.when("!=", 0), warn=None, **kw) -> M.MetricCheck:
    """DST-13: rows whose non-null value breaks a regex or a value list."""
    if (regex is None) == (values is None):
        raise ValueError("give exactly one of regex / values")
    check = C.RegexMatch(column, regex) if regex is not None else C.InList(column, values)
    return M.MetricCheck(name, M.FailingRows(check, metric_name="invalid_count"), **_fail_warn(fail, warn), **kw)


def missing_count(name, column, fail=M.when("!=", 0), warn=None, **kw) -> M.MetricCheck:
    """DST-11: NULL, empty string or NaN values."""
    return M.MetricCheck(name, M.FailingRows(C.NotNullNotEmpty(column), nulls_considered=True,
                                             metric_name="missing_count"), **_fail_warn(fail, warn), **kw)


def missing_percent(name, column, fail=None, warn=None, **kw) -> M.MetricCheck:
    """DST-12: percent of missing values over all rows (0 on no rows)."""
    return M.MetricCheck(name, M.FailingRows(C.NotNullNotEmpty(column), percent=True, nulls_considered=True,
                                             metric_name="missing_percent"), **_fail_warn(fail, warn), **kw)


def row_count(name, where=None, fail=None, warn=None, **kw) -> M.MetricCheck:
    """DST-14: number of rows (matching an in-check filter)."""
    return M.MetricCheck(name, M.RowCount(where), **_fail_warn(fail, warn), **kw)


def reference(name, columns, ref, ref_columns, fail=M.when("!=", 0), warn=None, **kw) -> M.MetricCheck:
    """DST-15: values must exist in a reference table (null keys skipped)."""
    return M.MetricCheck(name, M.Reference(tuple(columns), ref, tuple(ref_columns)), **_fail_warn(fail, warn), **kw)


def freshness(name, column, as_of, max_age_minutes, warn=None, **kw) -> M.MetricCheck:
    """DST-16: newest value must be younger than ``max_age_minutes``."""
    return M.MetricCheck(name, M.Freshness(column, as_of), fail=M.when(">=", max_age_minutes), warn=warn, **kw)


def expression_metric(name, expression, fail=None, warn=None, metric_name="expression", **kw) -> M.MetricCheck:
    """DST-17 / UDX-1: a user aggregate expression in SQL text."""
    return M.MetricCheck(name, M.Aggregate(expression, metric_name=metric_name), **_fail_warn(fail, warn), **kw)


def sql_metric(name, query, fail=None, warn=None, failed_rows_query=None, **kw) -> M.MetricCheck:
    """DST-18/19 / UDX-2: a whole SQL query giving one number, with an
    optional failed-rows query for samples."""
    return M.MetricCheck(name, M.SqlMetric(query), failed_rows_query=failed_rows_query,
                         **_fail_warn(fail, warn), **kw)


def duplicate_percent(name, columns, fail=None, warn=None, **kw) -> M.MetricCheck:
    """DST-3: percent of rows in duplicate groups of a compound key."""
    return M.MetricCheck(name, M.Duplicates(tuple(columns)), **_fail_warn(fail, warn), **kw)


def quantile(name, column, q, method="approx", fail=None, warn=None, accuracy=10000, **kw) -> M.MetricCheck:
    """AGG-5: one (approximate by default) quantile as metric."""
    return M.MetricCheck(name, M.Quantiles(column, (q,), method=method, accuracy=accuracy),
                         **_fail_warn(fail, warn), **kw)


def scan_outcomes(results: DataFrame) -> DataFrame:
    """VRD-9: checks per outcome, one row."""
    return M.outcome_counts(results)


def checks_with_outcome(results: DataFrame, outcome: str) -> DataFrame:
    return results.where(F.col("outcome") == outcome)
