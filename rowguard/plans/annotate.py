"""APP-1: apply a rule list to a DataFrame in one projection.

``apply_checks`` returns the input columns plus two issue arrays,
``_errors`` and ``_warnings``, each ``array<struct<name, function, columns,
message>>`` and never NULL (empty for a clean row). Row checks compile to one
``select``; dataset checks first add helper columns through left joins
against pre-aggregated key sets or through scalar subqueries (see
``rowguard.operators``), so the plan is: scan -> [joins] -> one Project.

Nothing runs until an action; the returned ``Observation`` is filled by the
first action on the annotated frame (a write, a count, ``format("noop")``).
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowguard.checks import Rule, Unique, label, suite
from rowguard.functions.predicates import quote
from rowguard.operators import keys as K

ERRORS = "_errors"
WARNINGS = "_warnings"

ISSUE = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("function", T.StringType(), False),
    T.StructField("columns", T.ArrayType(T.StringType(), False), False),
    T.StructField("message", T.StringType(), True),
])
ISSUES = T.ArrayType(ISSUE, False)

_counter = itertools.count()


MESSAGES = ("static", "values")


ISSUES_DDL = "array<struct<name:string,function:string,columns:array<string>,message:string>>"


def _issue(rule: Rule, cond: Column, tag: str, messages: str, empty: Column) -> Column:
    """A one-element issue array when ``cond`` holds, else ``empty``.

    With ``messages='static'`` the struct is a constant per rule (folded by
    Catalyst); ``'values'`` formats the failing row's values into the
    message, which costs string conversions on every failing row.
    """
    check = rule.check
    msg = check.message(tag) if messages == "values" else F.lit(check.describe())
    cols = check.input_columns()
    issue = F.struct(
        F.lit(rule.name).alias("name"),
        F.lit(check.function).alias("function"),
        (F.array(*[F.lit(c) for c in cols]) if cols else F.array().cast("array<string>")).alias("columns"),
        msg.cast("string").alias("message"),
    )
    return F.when(cond, F.array(issue)).otherwise(empty)


def _issue_array(items: list[Column], empty: Column) -> Column:
    # concat of per-rule one-or-zero element arrays: plain codegen'd
    # expressions (no lambda functions), and a clean row gets an empty
    # array, never NULL (size(NULL) is NULL and would make both the valid
    # and the quarantine filter drop the row). One cast per array column
    # fixes the element type and nullability.
    if not items:
        return empty
    return (items[0] if len(items) == 1 else F.concat(*items)).cast(ISSUES_DDL)


def annotate(df: DataFrame, rules: Sequence[Rule], messages: str = "static") -> DataFrame:
    """The annotated frame (input columns + ``_errors`` + ``_warnings``).

    ``messages``: ``'static'`` (default; rule text, the row's values are in
    the row itself) or ``'values'`` (the failing values in the text).
    """
    return _annotate(df, rules, messages)


def _annotate(df: DataFrame, rules: Sequence[Rule], messages: str, obs: Observation | None = None) -> DataFrame:
    """``annotate``; ``obs`` gets the counts of rows and of each rule's failures."""
    if messages not in MESSAGES:
        raise ValueError(f"messages must be one of {MESSAGES}")
    rules = suite(rules)
    run = next(_counter)
    tags = [f"__rg{run}_{i}" for i in range(len(rules))]
    work, uniques = df, [r.check for r in rules if type(r.check) is Unique]
    # several uniqueness rules count their keys in one scan and shuffle
    sets = list(dict.fromkeys((u.columns, u.nulls_distinct) for u in uniques))
    shared = K.duplicate_hashes_of(df, sets) if len(sets) > 1 else None
    for rule, tag in zip(rules, tags):
        u = rule.check
        if shared is not None and type(u) is Unique:
            work = K.mark_duplicates_of(work, u.columns, shared, sets.index((u.columns, u.nulls_distinct)), tag, u.hot_key_rows)
        else:
            work = u.prepare(work, df, tag)
    empty = F.array().cast(ISSUES_DDL)
    errors, warnings = [], []
    flags = []
    for i, (rule, tag) in enumerate(zip(rules, tags)):
        cond = rule.check.condition(work, df, tag)
        flags.append(cond.alias(f"__rg{run}_c{i}"))
        if obs is not None:  # the same condition fills the issue and is counted
            cond = F.col(f"__rg{run}_c{i}")
        (errors if rule.criticality == "error" else warnings).append(_issue(rule, cond, tag, messages, empty))
    # a frame annotated before keeps its issues; new ones are appended
    have = {c.lower() for c in df.columns}
    keep = [F.col(quote(c)) for c in df.columns if c not in (ERRORS, WARNINGS)]
    if ERRORS in have:
        errors = [F.col(ERRORS).cast(ISSUES_DDL)] + errors
    if WARNINGS in have:
        warnings = [F.col(WARNINGS).cast(ISSUES_DDL)] + warnings
    issues = [_issue_array(errors, empty).alias(ERRORS), _issue_array(warnings, empty).alias(WARNINGS)]
    if obs is None:
        return work.select(*keep, *issues)
    names = [f"__rg{run}_c{i}" for i in range(len(rules))]
    counted = work.select("*", *flags).select(*keep, *issues, *names)
    return counted.observe(obs, *summary_columns(), *[
        F.count_if(F.col(n)).alias(f"failed_{i}") for i, n in enumerate(names)]).drop(*names)


def apply_checks(
    df: DataFrame, rules: Sequence[Rule], name: str = "dq_metrics", messages: str = "static", per_rule: bool = False,
) -> tuple[DataFrame, Observation]:
    """APP-1 + AGG-11: annotated frame with an attached ``Observation`` of
    ``input_row_count``, ``valid_row_count``, ``error_row_count``,
    ``warning_row_count`` (filled by the first action; no extra count job).

    ``per_rule`` also counts ``failed_i``, the rows that fail the i-th rule, from
    the rules' conditions; ``results.observed_results`` makes verdicts of them.
    """
    obs = Observation(name)
    if per_rule:
        return _annotate(df, rules, messages, obs), obs
    return annotate(df, rules, messages).observe(obs, *summary_columns()), obs


def has_errors() -> Column:
    return F.size(F.col(ERRORS)) > 0


def has_warnings() -> Column:
    return F.size(F.col(WARNINGS)) > 0


def is_valid() -> Column:
    """FLT-2 (corrected): no error AND no warning."""
    return ~has_errors() & ~has_warnings()


def summary_columns() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("input_row_count"),
        F.count_if(is_valid()).alias("valid_row_count"),
        F.count_if(has_errors()).alias("error_row_count"),
        F.count_if(has_warnings()).alias("warning_row_count"),
    ]


def issue_names(array: str = ERRORS) -> Column:
    """The names of the issues in an array, in rule order (a struct-field
    extraction over the array, no lambda)."""
    return F.col(array).getField("name")


__all__ = ["ERRORS", "WARNINGS", "ISSUE", "annotate", "apply_checks", "has_errors",
           "has_warnings", "is_valid", "summary_columns", "issue_names", "label"]
