"""Declarative checks and rules.

A :class:`Check` describes *what* fails; a :class:`Rule` names it, gives it a
criticality (``error`` or ``warn``), a quality dimension and a verdict
threshold. Checks never touch data when built; they compile to Catalyst
expressions (row checks) or to a join / scalar subquery plus an expression
(dataset checks) when a rule list is applied.

Any function ``df -> Column`` (a failing condition) is a check too, through
:class:`Satisfies`, so user checks need no registry.
"""

from __future__ import annotations

import dataclasses
import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from typing import ClassVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowguard.functions import predicates as P
from rowguard.operators import aggregates as A
from rowguard.operators import keys as K

CRITICALITIES = ("error", "warn")
#: parameters that change how a check runs, not what it checks
_EXECUTION_KNOBS = ("hot_key_rows", "aggregate_keys")


def label(c) -> str:
    """Readable name of a column argument for issue structs and messages."""
    if isinstance(c, str):
        return c
    s = str(c)
    if s.startswith("Column<'") and s.endswith("'>"):
        return s[len("Column<'"):-2]
    return s


def _text(c) -> Column:
    return F.coalesce(P.col(c).cast("string"), F.lit("null"))


class Check:
    """Base class: a failing condition with metadata."""

    function: ClassVar[str] = "custom"
    #: True when the check needs the whole dataset (joins, aggregates).
    dataset_level: ClassVar[bool] = False

    def input_columns(self) -> tuple[str, ...]:
        return ()

    def prepare(self, work: DataFrame, source: DataFrame, tag: str) -> DataFrame:
        """Add helper columns (named from ``tag``) to ``work``; rows unchanged."""
        return work

    def condition(self, work: DataFrame, source: DataFrame, tag: str) -> Column:
        raise NotImplementedError

    def message(self, tag: str) -> Column:
        """Message naming the failing row's values (computed per failing row)."""
        return F.lit(self.describe())

    def describe(self) -> str:
        """Constant message: the check and its parameters (no row values)."""
        params = []
        for f in dataclasses.fields(self):
            if f.name in _EXECUTION_KNOBS:
                continue
            v = getattr(self, f.name)
            if isinstance(v, (str, int, float, bool, tuple)):
                params.append(f"{f.name}={v!r}")
            elif isinstance(v, Column):
                params.append(f"{f.name}={label(v)}")
        return f"{self.function} failed: {', '.join(params)}"

    def helper_columns(self, tag: str) -> tuple[str, ...]:
        return ()


# ------------------------------------------------------------- row checks

@dataclass(frozen=True, eq=False)
class RegexMatch(Check):
    """ROW-1: non-null values must match ``regex`` (find semantics)."""

    column: str
    regex: str
    function: ClassVar[str] = "regex_match"

    def input_columns(self):
        return (label(self.column),)

    def condition(self, work, source, tag):
        return P.regex_mismatch(self.column, self.regex)

    def message(self, tag):
        return F.concat(F.lit("Value '"), _text(self.column),
                        F.lit(f"' in column '{label(self.column)}' does not match pattern '{self.regex}'"))


@dataclass(frozen=True, eq=False)
class InList(Check):
    """ROW-2: non-null values must be one of ``allowed``."""

    column: str
    allowed: tuple
    function: ClassVar[str] = "is_in_list"

    def __post_init__(self):
        object.__setattr__(self, "allowed", tuple(self.allowed))
        if any(a is None for a in self.allowed):
            raise ValueError("allowed values must not contain None")

    def input_columns(self):
        return (label(self.column),)

    def condition(self, work, source, tag):
        return P.not_in_list(self.column, self.allowed)

    def message(self, tag):
        return F.concat(F.lit("Value '"), _text(self.column),
                        F.lit(f"' in column '{label(self.column)}' is not in the allowed list"))


@dataclass(frozen=True, eq=False)
class NotGreaterThan(Check):
    """ROW-3 / ROW-4: value must not exceed ``limit`` (number, date, string,
    or a Column such as another column); equal passes, nulls pass."""

    column: str
    limit: object
    function: ClassVar[str] = "is_not_greater_than"

    def input_columns(self):
        cols = (label(self.column),)
        return cols + ((label(self.limit),) if isinstance(self.limit, Column) else ())

    def condition(self, work, source, tag):
        return P.greater_than(self.column, self.limit)

    def message(self, tag):
        return F.concat(F.lit("Value '"), _text(self.column),
                        F.lit(f"' in column '{label(self.column)}' is greater than limit: "),
                        F.coalesce(P.value(self.limit).cast("string"), F.lit("null")))


@dataclass(frozen=True, eq=False)
class NotLessThan(Check):
    """Value must not be below ``limit``; equal passes, nulls pass."""

    column: str
    limit: object
    function: ClassVar[str] = "is_not_less_than"

    def input_columns(self):
        return (label(self.column),)

    def condition(self, work, source, tag):
        return P.less_than(self.column, self.limit)

    def message(self, tag):
        return F.concat(F.lit("Value '"), _text(self.column),
                        F.lit(f"' in column '{label(self.column)}' is less than limit: "),
                        F.coalesce(P.value(self.limit).cast("string"), F.lit("null")))


@dataclass(frozen=True, eq=False)
class InRange(Check):
    """Value must lie in [min, max] (inclusive by default; a None bound is open)."""

    column: str
    min_value: object = None
    max_value: object = None
    inclusive: bool = True
    function: ClassVar[str] = "is_in_range"

    def input_columns(self):
        return (label(self.column),)

    def condition(self, work, source, tag):
        return P.outside(self.column, self.min_value, self.max_value, self.inclusive)

    def message(self, tag):
        return F.concat(F.lit("Value '"), _text(self.column),
                        F.lit(f"' in column '{label(self.column)}' is outside [{self.min_value}, {self.max_value}]"))


@dataclass(frozen=True, eq=False)
class PairGreater(Check):
    """ROW-5: ``a > b`` (``>=`` with ``or_equal``) where both are non-null."""

    column_a: str
    column_b: str
    or_equal: bool = False
    function: ClassVar[str] = "column_pair_a_greater_than_b"

    def input_columns(self):
        return (label(self.column_a), label(self.column_b))

    def condition(self, work, source, tag):
        return P.pair_not_greater(self.column_a, self.column_b, self.or_equal)

    def message(self, tag):
        op = ">=" if self.or_equal else ">"
        return F.concat(F.lit(f"'{label(self.column_a)}' {op} '{label(self.column_b)}' does not hold: "),
                        _text(self.column_a), F.lit(" vs "), _text(self.column_b))


@dataclass(frozen=True, eq=False)
class PairEqual(Check):
    """ROW-6: ``a`` equals ``b`` null-safely (one null side fails)."""

    column_a: str
    column_b: str
    function: ClassVar[str] = "column_pair_equal"

    def input_columns(self):
        return (label(self.column_a), label(self.column_b))

    def condition(self, work, source, tag):
        return P.pair_not_equal(self.column_a, self.column_b)

    def message(self, tag):
        return F.concat(F.lit(f"'{label(self.column_a)}' differs from '{label(self.column_b)}': "),
                        _text(self.column_a), F.lit(" vs "), _text(self.column_b))


@dataclass(frozen=True, eq=False)
class NotNull(Check):
    """ROW-7: value must not be NULL."""

    column: str
    function: ClassVar[str] = "is_not_null"

    def input_columns(self):
        return (label(self.column),)

    def condition(self, work, source, tag):
        return P.is_null(self.column)

    def message(self, tag):
        return F.lit(f"Column '{label(self.column)}' value is null")


@dataclass(frozen=True, eq=False)
class NotNullNotEmpty(Check):
    """ROW-8: value must not be NULL, an empty string (optionally after trim)
    or NaN."""

    column: str
    trim_strings: bool = False
    function: ClassVar[str] = "is_not_null_and_not_empty"

    def input_columns(self):
        return (label(self.column),)

    def condition(self, work, source, tag):
        return P.is_missing(self.column, P.data_type(work, self.column), self.trim_strings)

    def message(self, tag):
        return F.lit(f"Column '{label(self.column)}' value is null or empty")


@dataclass(frozen=True, eq=False)
class Fresh(Check):
    """ROW-9: value must not be older than ``as_of - max_age_minutes``.

    ``as_of`` is an argument (default: the session's current timestamp) so
    results are reproducible.
    """

    column: str
    max_age_minutes: int
    as_of: object = None
    function: ClassVar[str] = "is_data_fresh"

    def input_columns(self):
        return (label(self.column),)

    def _as_of(self):
        return F.current_timestamp() if self.as_of is None else self.as_of

    def condition(self, work, source, tag):
        return P.older_than(self.column, self.max_age_minutes, self._as_of())

    def message(self, tag):
        return F.concat(F.lit("Value '"), _text(self.column),
                        F.lit(f"' in column '{label(self.column)}' is older than {self.max_age_minutes} minutes"))


@dataclass(frozen=True, eq=False)
class Satisfies(Check):
    """UDX-4 / FLT-3: a user failing condition: SQL text, a Column, or a
    function ``DataFrame -> Column``. ``True`` means the row fails."""

    condition_: object
    columns: tuple = ()
    function_name: str = "sql_expression"
    msg: str = ""
    function: ClassVar[str] = "sql_expression"

    def input_columns(self):
        return tuple(self.columns)

    def condition(self, work, source, tag):
        c = self.condition_
        if callable(c) and not isinstance(c, Column):
            c = c(work)
        if isinstance(c, str):
            c = F.expr(c)
        return P.never_null(c)

    def message(self, tag):
        return F.lit(self.msg or f"condition {label(self.condition_)} holds")


# --------------------------------------------------------- dataset checks

def _resolve(ref, spark: SparkSession) -> DataFrame:
    return spark.table(ref) if isinstance(ref, str) else ref


@dataclass(frozen=True, eq=False)
class Unique(Check):
    """DST-1: every row of a key group with more than one row fails.

    Keys with a null part are distinct (never duplicates) unless
    ``nulls_distinct=False``.
    """

    columns: tuple
    nulls_distinct: bool = True
    hot_key_rows: int = K.HOT_KEY_ROWS
    function: ClassVar[str] = "is_unique"
    dataset_level: ClassVar[bool] = True

    def __post_init__(self):
        object.__setattr__(self, "columns", tuple(self.columns))

    def input_columns(self):
        return tuple(self.columns)

    def prepare(self, work, source, tag):
        return K.mark_duplicates(work, self.columns, tag, self.nulls_distinct, source=source,
                                 hot_key_rows=self.hot_key_rows)

    def helper_columns(self, tag):
        return (tag, f"{tag}_size")

    def condition(self, work, source, tag):
        return F.col(tag)

    def message(self, tag):
        return F.concat(F.lit(f"Key ({', '.join(self.columns)}) is not unique: "),
                        F.col(f"{tag}_size").cast("string"), F.lit(" rows share it"))


@dataclass(frozen=True, eq=False)
class ForeignKey(Check):
    """DST-4: a fully non-null key must exist in the reference (a DataFrame
    or a catalog table name); null keys are skipped."""

    columns: tuple
    ref: object = field(repr=False)
    ref_columns: tuple
    hot_key_rows: int = K.HOT_KEY_ROWS
    #: False: join every row against the distinct reference keys (Spark chooses
    #: the join by their size); True: find unmatched keys first, join only those
    aggregate_keys: bool = False
    #: index one integral key as bitmaps of 32,768 neighbouring values each
    bitmap: bool = False
    function: ClassVar[str] = "foreign_key"
    dataset_level: ClassVar[bool] = True

    def __post_init__(self):
        object.__setattr__(self, "columns", tuple(self.columns))
        object.__setattr__(self, "ref_columns", tuple(self.ref_columns))

    def input_columns(self):
        return tuple(self.columns)

    def prepare(self, work, source, tag):
        ref = _resolve(self.ref, work.sparkSession)
        if self.bitmap:
            if len(self.columns) != 1 or len(self.ref_columns) != 1:
                raise ValueError("a bitmap index is of one column")
            return K.mark_unmatched_bitmap(work, self.columns[0], ref, self.ref_columns[0], tag)
        if not self.aggregate_keys:
            return K.mark_unmatched_direct(work, self.columns, ref, self.ref_columns, tag)
        return K.mark_unmatched(work, self.columns, ref, self.ref_columns, tag, source=source,
                                hot_key_rows=self.hot_key_rows)

    def helper_columns(self, tag):
        return (tag,)

    def condition(self, work, source, tag):
        return F.col(tag)

    def message(self, tag):
        ref = self.ref if isinstance(self.ref, str) else "reference"
        return F.concat(F.lit("Value '"), F.concat_ws(",", *[_text(c) for c in self.columns]),
                        F.lit(f"' of ({', '.join(self.columns)}) not found in {ref} ({', '.join(self.ref_columns)})"))


@dataclass(frozen=True, eq=False)
class AggregateBound(Check):
    """DST-5 / DST-6: an aggregate of ``column`` (a name, SQL text or Column)
    must not be below (``side='min'``) / above (``side='max'``) ``limit``.

    When violated every row (of the group, with ``group_by``) fails.
    """

    column: object
    aggr_type: str
    limit: object
    side: str = "min"
    group_by: tuple = ()
    hot_key_rows: int = K.HOT_KEY_ROWS
    function: ClassVar[str] = "is_aggr_bound"
    dataset_level: ClassVar[bool] = True

    def __post_init__(self):
        if self.side not in ("min", "max"):
            raise ValueError("side must be 'min' or 'max'")
        A.aggregate(self.aggr_type, F.lit(1))  # validates the name
        object.__setattr__(self, "group_by", tuple(self.group_by))

    def input_columns(self):
        return (label(self.column),) + tuple(self.group_by)

    def _violated(self, v: Column) -> Column:
        lim = P.value(self.limit)
        return (v < lim) if self.side == "min" else (v > lim)

    def prepare(self, work, source, tag):
        if not self.group_by:
            return work
        return A.mark_group_violations(work, source, self.aggr_type, self.column, self.group_by,
                                       self._violated, tag, hot_key_rows=self.hot_key_rows)

    def helper_columns(self, tag):
        return (tag, f"{tag}_v") if self.group_by else ()

    def condition(self, work, source, tag):
        if self.group_by:
            return F.col(tag)
        return P.never_null(self._violated(A.scalar_aggregate(source, self.aggr_type, self.column)))

    def message(self, tag):
        word = "less" if self.side == "min" else "greater"
        return F.lit(f"{self.aggr_type} of {label(self.column)} is {word} than limit {label(self.limit)}")


# -------------------------------------------------------------------- rule

@dataclass(frozen=True, eq=False)
class Rule:
    """A named check with criticality, dimension and a verdict threshold.

    The rule passes when the share of failing rows (percent of input rows)
    is ``<= max_failed_pct`` (``<`` with ``strict``). Default 0: no failing
    row allowed. Without a name (``None``) it is called after its columns and
    function, e.g. ``l_tax_is_not_greater_than``.
    """

    name: str | None
    check: Check
    criticality: str = "error"
    dimension: str = ""
    max_failed_pct: float = 0.0
    strict: bool = False

    def __post_init__(self):
        if self.criticality not in CRITICALITIES:
            raise ValueError(f"criticality must be one of {CRITICALITIES}")
        if self.name is None:
            words = [*map(str, self.check.input_columns()), self.check.function]
            object.__setattr__(self, "name", re.sub(r"\W+", "_", "_".join(words)).strip("_").lower())
        if not self.name:
            raise ValueError("a rule's name may not be empty")


def suite(*groups: Iterable[Rule] | Rule) -> list[Rule]:
    """APP-4: concatenate rule groups (e.g. one per quality dimension) and
    check that names are unique."""
    out: list[Rule] = []
    for g in groups:
        out.extend([g] if isinstance(g, Rule) else list(g))
    names = [r.name for r in out]
    dup = sorted({n for n in names if names.count(n) > 1})
    if dup:
        raise ValueError(f"rule names must be unique: {dup}")
    return out


def in_dimension(dimension: str, rules: Sequence[Rule]) -> list[Rule]:
    """Give every rule of a group the same quality dimension."""
    from dataclasses import replace
    return [replace(r, dimension=dimension) for r in rules]

