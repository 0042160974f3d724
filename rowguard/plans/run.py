"""One evaluation of a rule list for everything that is made of it (APP-1, AGG-11, VRD-6).

The annotated frame is written once, split by validity. The counts that summary
and verdicts need are observed by that very write, so they cost no pass of their
own, and no later filter of the written rows can change a percentage.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowguard.checks import Rule, suite
from rowguard.plans import results as R
from rowguard.plans.annotate import apply_checks
from rowguard.sources.writers import STATUS, save_partitioned_split


@dataclass
class CheckRun:
    """Where the rows are, and what was observed while they were written.

    ``metrics``: ``input_row_count``, ``valid_row_count``, ``error_row_count``,
    ``warning_row_count`` and ``failed_i`` of the i-th rule.
    """

    valid: DataFrame
    quarantine: DataFrame
    metrics: dict[str, int]
    rules: Sequence[Rule]

    def results(self, thresholds: DataFrame | None = None) -> DataFrame:
        return R.observed_results(self.valid.sparkSession, self.metrics, self.rules, thresholds)

    def summary(self) -> DataFrame:
        return R.observed_summary(self.valid.sparkSession, self.metrics)

    def overall(self, thresholds: DataFrame | None = None) -> DataFrame:
        return R.overall(self.results(thresholds))


def run_checks(df: DataFrame, rules: Sequence[Rule], path: str, messages: str = "static", mode: str = "errorifexists") -> CheckRun:
    """Apply the rules in one job: write ``path`` (a folder that all executors
    share) and take summary and verdicts from what that write observed.

    The counts are those of the write's own tasks, each taken once; the write
    follows the annotation without a shuffle between them.
    """
    rules = suite(rules)
    annotated, obs = apply_checks(df, rules, messages=messages, per_rule=True)
    save_partitioned_split(annotated, path, mode)
    back = df.sparkSession.read.schema(annotated.withColumn(STATUS, F.lit("")).schema).parquet(path)
    sides = [R.part(back.where(F.col(STATUS) == name).drop(STATUS), name) for name in ("valid", "quarantine")]
    return CheckRun(*sides, dict(obs.get), rules)
