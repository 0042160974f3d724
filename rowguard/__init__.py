"""rowguard: declarative data-quality checks on Spark DataFrames.

Row checks are Catalyst expressions, dataset checks are joins against
pre-aggregated key sets or scalar subqueries, metrics are fused into one
aggregation per frame; results, splits, samples and verdicts are DataFrames.
"""

from rowguard.checks import (
    AggregateBound,
    Check,
    ForeignKey,
    Fresh,
    InList,
    InRange,
    NotGreaterThan,
    NotLessThan,
    NotNull,
    NotNullNotEmpty,
    PairEqual,
    PairGreater,
    RegexMatch,
    Rule,
    Satisfies,
    Unique,
    in_dimension,
    suite,
)
from rowguard.operators.metrics import MetricCheck, Threshold, evaluate, evaluate_many, when
from rowguard.plans.annotate import annotate, apply_checks
from rowguard.plans.expectations import suite_statistics, validate
from rowguard.plans.results import check_results, issue_counts, issues, overall, split, summary
from rowguard.plans.run import CheckRun, run_checks
from rowguard.plans.scan import scan

__all__ = [
    "AggregateBound", "Check", "ForeignKey", "Fresh", "InList", "InRange",
    "NotGreaterThan", "NotLessThan", "NotNull", "NotNullNotEmpty", "PairEqual",
    "PairGreater", "RegexMatch", "Rule", "Satisfies", "Unique", "in_dimension",
    "suite", "annotate", "apply_checks", "check_results", "issues", "overall",
    "split", "summary", "MetricCheck", "Threshold", "evaluate", "evaluate_many", "when",
    "suite_statistics", "validate", "issue_counts", "scan", "CheckRun", "run_checks",
]
