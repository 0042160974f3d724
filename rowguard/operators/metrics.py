"""Dataset metrics with verdicts (DST-2..19, VRD-1/2/4), fused.

A :class:`MetricCheck` pairs a :class:`Measure` (how a number is computed)
with ``fail`` / ``warn`` :class:`Threshold` s (when that number is bad).

``evaluate`` compiles every *fusable* measure of a frame into ONE
``df.agg(...)`` (one scan, partial aggregation, a one-row result) and turns
that row into one result row per check with ``inline``. Measures that need
their own shape produce one-row frames: one for all duplicate checks, one for
all value sets, one a reference check (a join) or SQL metric. All parts are
unioned, never joined; only exact quantiles collect their few bounds.

Result schema (one row per check)::

    check, dimension, metric, value double, observed string,
    row_count bigint, considered_rows bigint, failed_rows bigint,
    failed_pct double, outcome string ('pass'|'warn'|'fail'|'error'), details string
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException, ParseException, PySparkException, PythonException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowguard.checks import Check
from rowguard.functions import predicates as P
from rowguard.operators import aggregates as A
from rowguard.operators import keys as K
from rowguard.operators.quantiles import exact_quantiles, exact_quantiles_of

RESULT_SCHEMA = T.StructType([
    T.StructField("check", T.StringType(), False),
    T.StructField("dimension", T.StringType(), False),
    T.StructField("metric", T.StringType(), False),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("observed", T.StringType(), True),
    T.StructField("row_count", T.LongType(), True),
    T.StructField("considered_rows", T.LongType(), True),
    T.StructField("failed_rows", T.LongType(), True),
    T.StructField("failed_pct", T.DoubleType(), True),
    T.StructField("outcome", T.StringType(), False),
    T.StructField("details", T.StringType(), True),
])

OUTCOMES = ("pass", "warn", "fail", "error")
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


# ------------------------------------------------------------- thresholds

@dataclass(frozen=True)
class Threshold:
    """A *bad* condition on one measure of a result row.

    ``op`` in ``< <= > >= = != between not_between null``; ``between`` is
    inclusive, ``null`` is hit by a NULL value (``a`` ignored). ``on`` picks the measure: ``value`` (default),
    ``failed_rows``, ``failed_pct`` or ``pass_ratio``
    (``(considered - failed) / considered``, 1 when nothing is considered).
    """

    op: str
    a: float | int | str
    b: float | int | str | None = None
    on: str = "value"

    def __post_init__(self):
        if self.op not in ("<", "<=", ">", ">=", "=", "!=", "between", "not_between", "null"):
            raise ValueError(f"unknown comparison {self.op!r}")
        if self.op in ("between", "not_between") and self.b is None:
            raise ValueError("between needs two bounds")

    def hit(self, x: Column) -> Column:
        a, b = F.lit(self.a), F.lit(self.b)
        return {
            "<": lambda: x < a, "<=": lambda: x <= a, ">": lambda: x > a, ">=": lambda: x >= a,
            "=": lambda: x == a, "!=": lambda: x != a,
            "between": lambda: (x >= a) & (x <= b),
            "not_between": lambda: (x < a) | (x > b),
            "null": lambda: x.isNull(),
        }[self.op]()


def when(op: str, a=None, b=None, on: str = "value") -> Threshold:
    """Shorthand: ``when('>', 5)`` is bad when value > 5."""
    return Threshold(op, a, b, on)


# --------------------------------------------------------------- measures

class Measure:
    """How one metric is computed. Fusable measures contribute aggregate
    columns to the shared aggregation; others build their own one-row frame."""

    metric = "metric"
    fusable = True

    def aggregates(self, df: DataFrame, p: str) -> list[Column]:
        return []

    def outputs(self, p: str, df: DataFrame | None = None) -> dict[str, Column]:
        """value / row_count / considered / failed / details over the agg row
        (``df`` is the checked frame, for scalar subqueries)."""
        raise NotImplementedError

    def frame(self, df: DataFrame, p: str) -> DataFrame:
        """For non-fusable measures: a one-row frame with the columns of ``outputs``."""
        raise NotImplementedError

    @classmethod
    def frame_of(cls, df: DataFrame, group: Sequence[tuple["Measure", str]]) -> DataFrame | None:
        """One such frame for several measures of this class, if they can share their work."""
        return None

    def row_condition(self, df: DataFrame) -> Column | None:
        """The failing condition when failing rows are a plain row filter."""
        return None

    def failing_rows(self, df: DataFrame) -> DataFrame | None:
        cond = self.row_condition(df)
        return None if cond is None else df.where(cond)

    def extra_fail(self, p: str) -> Column | None:
        return None


def _rows(p):
    return F.col(f"{p}_rows")


@dataclass(frozen=True, eq=False)
class RowCount(Measure):
    """DST-14: number of rows, optionally of rows matching ``where`` (SQL or Column)."""

    where: object = None
    metric = "row_count"

    def _cond(self):
        return P.sql(self.where) if isinstance(self.where, str) else P.never_null(self.where)

    def aggregates(self, df, p):
        c = F.count(F.lit(1)) if self.where is None else F.count_if(self._cond())
        return [F.count(F.lit(1)).alias(f"{p}_rows"), c.alias(f"{p}_n")]

    def outputs(self, p, df=None):
        n = F.col(f"{p}_n")
        return dict(value=n, row_count=_rows(p), considered=_rows(p), failed=n if self.where is not None else F.lit(None))

    def row_condition(self, df):
        return None if self.where is None else self._cond()


@dataclass(frozen=True, eq=False)
class FailingRows(Measure):
    """Rows failing a row-level :class:`Check` (DST-11/12/13 and the
    expectation forms). ``value`` is the failing count, or its percent of
    all rows with ``percent=True``. ``considered`` rows are those whose
    inputs are non-null, unless ``nulls_considered`` (completeness checks)."""

    check: Check
    percent: bool = False
    nulls_considered: bool = False
    metric_name: str = ""

    @property
    def metric(self):
        return self.metric_name or (self.check.function + ("_percent" if self.percent else "_count"))

    def aggregates(self, df, p):
        if self.check.dataset_level:
            raise ValueError("FailingRows takes row-level checks; use the dataset measures")
        cond = self.check.condition(df, df, p)
        considered = F.count(F.lit(1)) if self.nulls_considered else F.count_if(P.all_not_null(self.check.input_columns()))
        return [
            F.count(F.lit(1)).alias(f"{p}_rows"),
            F.count_if(cond).alias(f"{p}_failed"),
            considered.alias(f"{p}_considered"),
        ]

    def outputs(self, p, df=None):
        failed = F.col(f"{p}_failed")
        value = F.coalesce(F.try_divide(failed * F.lit(100.0), _rows(p)), F.lit(0.0)) if self.percent else failed
        return dict(value=value, row_count=_rows(p), considered=F.col(f"{p}_considered"), failed=failed)

    def row_condition(self, df):
        return self.check.condition(df, df, "__rg_s")


@dataclass(frozen=True, eq=False)
class Aggregate(Measure):
    """DST-8/9/17, AGG-4/7/8: an aggregate. ``expr`` is SQL aggregate text
    (``"AVG(a / (b / 60))"``) or, with ``aggr_type``, a column/expression to
    aggregate with ``count|sum|avg|min|max|...``."""

    expr: object
    aggr_type: str | None = None
    metric_name: str = ""

    @property
    def metric(self):
        return self.metric_name or (self.aggr_type or "expression")

    def _agg(self):
        if self.aggr_type is None:
            return F.expr(self.expr) if isinstance(self.expr, str) else self.expr
        return A.aggregate(self.aggr_type, self.expr)

    def aggregates(self, df, p):
        return [F.count(F.lit(1)).alias(f"{p}_rows"), self._agg().alias(f"{p}_v")]

    def outputs(self, p, df=None):
        return dict(value=F.col(f"{p}_v"), row_count=_rows(p), considered=_rows(p), failed=F.lit(None))


@dataclass(frozen=True, eq=False)
class Quantiles(Measure):
    """DST-10 / AGG-5 / AGG-6: quantiles of a column, each against an
    inclusive range ``(lo, hi)`` (``None`` = open end). ``method``:
    ``disc`` (exact, a value of the column), ``cont`` (exact, interpolated)
    or ``approx`` (``percentile_approx`` with ``accuracy``: one pass, fused
    with the other checks; exact ones take a few narrow passes, which all exact
    quantiles of a frame share)."""

    column: str
    quantiles: tuple
    ranges: tuple = ()
    method: str = "approx"
    accuracy: int = 10000

    def __post_init__(self):
        object.__setattr__(self, "quantiles", tuple(float(q) for q in self.quantiles))
        object.__setattr__(self, "ranges", tuple(tuple(r) for r in self.ranges))
        if self.ranges and len(self.ranges) != len(self.quantiles):
            raise ValueError("one range per quantile")
        if self.method not in ("disc", "cont", "approx"):
            raise ValueError("method is disc, cont or approx")

    @property
    def metric(self):
        return f"quantile_{self.method}"

    @property
    def fusable(self):
        # exact quantiles are found by bounded refinement (operators.quantiles),
        # not by Spark's exact percentile whose state holds every distinct value
        return self.method == "approx"

    def aggregates(self, df, p):
        out = [F.count(F.lit(1)).alias(f"{p}_rows")]
        out += [F.percentile_approx(P.col(self.column), q, self.accuracy).cast("double").alias(f"{p}_q{i}")
                for i, q in enumerate(self.quantiles)]
        return out

    def frame(self, df, p, known=None):
        """``known``: (rows, values) if they were found together with other checks'."""
        rows, values = known or exact_quantiles(df, self.column, self.quantiles, self.method)
        kind = T.DoubleType() if self.method == "cont" else df.select(P.col(self.column)).schema[0].dataType
        schema = T.StructType([T.StructField(f"{p}_rows", T.LongType())] + [
            T.StructField(f"{p}_q{i}", kind) for i in range(len(values))])
        return df.sparkSession.createDataFrame([(rows, *values)], schema)

    def outputs(self, p, df=None):
        qs = [F.col(f"{p}_q{i}") for i in range(len(self.quantiles))]
        details = F.concat_ws(", ", *[
            F.concat(F.lit(f"q{q}="), F.coalesce(c.cast("string"), F.lit("null"))) for q, c in zip(self.quantiles, qs)
        ])
        # a date or time has no number; it stands in the details
        return dict(value=qs[0].try_cast("double"), row_count=_rows(p), considered=_rows(p), failed=F.lit(None), details=details)

    def extra_fail(self, p):
        if not self.ranges:
            return None
        bad = F.lit(False)
        for i, (lo, hi) in enumerate(self.ranges):
            q = F.col(f"{p}_q{i}")
            cond = q.isNull()
            if lo is not None:
                cond = cond | (q < F.lit(lo))
            if hi is not None:
                cond = cond | (q > F.lit(hi))
            bad = bad | cond
        return bad


@dataclass(frozen=True, eq=False)
class Freshness(Measure):
    """DST-16: minutes from the newest value of ``column`` to ``as_of``
    (looks at the newest row only; see ``Fresh`` for the per-row form)."""

    column: str
    as_of: object
    metric = "freshness_minutes"

    def aggregates(self, df, p):
        return [F.count(F.lit(1)).alias(f"{p}_rows"), F.max(P.col(self.column)).alias(f"{p}_max")]

    def outputs(self, p, df=None):
        newest = F.col(f"{p}_max")
        minutes = P.minutes_between(P.value(self.as_of), newest)
        return dict(value=minutes, row_count=_rows(p), considered=_rows(p), failed=F.lit(None),
                    details=F.concat(F.lit("newest="), F.coalesce(newest.cast("string"), F.lit("null"))))


@dataclass(frozen=True, eq=False)
class DistinctInSet(Measure):
    """DST-7 / AGG-10: distinct non-null values must lie in ``values``.

    ``value`` = number of distinct unexpected values; ``failed_rows`` =
    rows holding one. ``unexpected(df)`` gives the values themselves, all of
    them, one row each: a frame, as their number is not bounded.
    """

    column: str
    values: tuple
    fusable = False
    metric = "distinct_values_not_in_set"

    def __post_init__(self):
        object.__setattr__(self, "values", tuple(self.values))

    def _bad(self):
        return P.not_in_list(self.column, self.values)

    @classmethod
    def frame_of(cls, df, group):
        """All sets of a frame from one scan and one shuffle: every row gives an
        entry a check, whose value stays only where it is unexpected, and entries
        are counted in two levels, first by value and then by check."""
        slots = {m._kind(df).simpleString(): m._kind(df) for m, _ in group}
        entries = []
        for i, (m, _) in enumerate(group):
            bad, own = m._bad(), m._kind(df).simpleString()
            values = [F.when(bad, P.col(m.column) if t == own else F.lit(None)).cast(kind).alias(f"v{k}") for k, (t, kind) in enumerate(slots.items())]
            entries.append(F.struct(F.lit(i).alias("c"), P.col(m.column).isNotNull().alias("known"), bad.alias("bad"), *values))
        counted = df.select(F.inline(F.array(*entries))).groupBy("c", "known", "bad", *[f"v{k}" for k in range(len(slots))]).agg(F.count(F.lit(1)).alias("n"))
        out = []
        for i, (_, p) in enumerate(group):
            own = F.col("c") == i
            total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("bigint")
            out += [total(own).alias(f"{p}_rows"), total(own & F.col("known")).alias(f"{p}_considered"),
                    total(own & F.col("bad")).alias(f"{p}_failed"), F.count_if(own & F.col("bad")).alias(f"{p}_distinct")]
        return counted.agg(*out)

    def frame(self, df, p):
        return self.frame_of(df, [(self, p)])

    def _kind(self, df):
        return df.select(P.col(self.column)).schema[0].dataType

    def outputs(self, p, df=None):
        return dict(value=F.col(f"{p}_distinct"), row_count=_rows(p), considered=F.col(f"{p}_considered"),
                    failed=F.col(f"{p}_failed"))

    def unexpected(self, df: DataFrame) -> DataFrame:
        """(value, row_count) of every unexpected value."""
        return (df.where(self._bad()).groupBy(P.col(self.column).alias("value"))
                .agg(F.count(F.lit(1)).alias("row_count")))

    def row_condition(self, df):
        return self._bad()


@dataclass(frozen=True, eq=False)
class Duplicates(Measure):
    """DST-2 / DST-3 / AGG-12: duplicates of a compound key.

    ``value`` is the percent of rows that sit in duplicate groups (or the
    count with ``percent=False``); details carry groups and excess rows.
    """

    columns: tuple
    percent: bool = True
    nulls_distinct: bool = True
    fusable = False

    def __post_init__(self):
        object.__setattr__(self, "columns", tuple(self.columns))

    @property
    def metric(self):
        return "duplicate_percent" if self.percent else "duplicate_rows"

    @classmethod
    def frame_of(cls, df, group):
        sets = list(dict.fromkeys((m.columns, m.nulls_distinct) for m, _ in group))
        s, out = K.duplicate_stats_of(df, sets), []
        for m, p in group:
            i = sets.index((m.columns, m.nulls_distinct))
            rows, failed = F.col(f"row_count_{i}"), F.col(f"duplicate_rows_{i}")
            value = F.coalesce(F.try_divide(failed * F.lit(100.0), rows), F.lit(0.0)) if m.percent else failed
            out += [
                value.alias(f"{p}_value"), rows.alias(f"{p}_rows"), F.col(f"considered_rows_{i}").alias(f"{p}_considered"), failed.alias(f"{p}_failed"),
                F.concat(F.lit("duplicate_groups="), F.col(f"duplicate_groups_{i}").cast("string"),
                         F.lit(", excess_rows="), F.col(f"excess_rows_{i}").cast("string")).alias(f"{p}_details")]
        return s.select(*out)

    def frame(self, df, p):
        return self.frame_of(df, [(self, p)])

    def outputs(self, p, df=None):
        return dict(value=F.col(f"{p}_value"), row_count=_rows(p), considered=F.col(f"{p}_considered"),
                    failed=F.col(f"{p}_failed"), details=F.col(f"{p}_details"))

    def failing_rows(self, df):
        flagged = K.mark_duplicates(df, self.columns, "__rg_dup", self.nulls_distinct)
        return flagged.where(F.col("__rg_dup")).drop("__rg_dup", "__rg_dup_size")


@dataclass(frozen=True, eq=False)
class Reference(Measure):
    """DST-15 / JON-3/4/6: keys that must exist in a reference frame or
    catalog table. ``value`` = unmatched rows with a fully non-null key
    (null keys skipped); ``details`` also gives the share of matched rows
    over *all* rows (null keys counted as unmatched, as a SQL
    ``COUNT(ref)/COUNT(*)`` ratio does)."""

    columns: tuple
    ref: object = field(repr=False)
    ref_columns: tuple
    fusable = False
    metric = "reference_unmatched"

    def __post_init__(self):
        object.__setattr__(self, "columns", tuple(self.columns))
        object.__setattr__(self, "ref_columns", tuple(self.ref_columns))

    def _ref(self, df):
        return df.sparkSession.table(self.ref) if isinstance(self.ref, str) else self.ref

    def frame(self, df, p):
        s = K.unmatched_stats(df, self.columns, self._ref(df), self.ref_columns)
        ratio = F.coalesce(F.try_divide(F.col("matched_rows") * F.lit(100.0), F.col("row_count")), F.lit(0.0))
        return s.select(
            F.col("unmatched_rows").alias(f"{p}_value"), F.col("row_count").alias(f"{p}_rows"),
            F.col("considered_rows").alias(f"{p}_considered"), F.col("unmatched_rows").alias(f"{p}_failed"),
            F.concat(F.lit("matched_pct_of_all_rows="), ratio.cast("string")).alias(f"{p}_details"),
        )

    def outputs(self, p, df=None):
        return dict(value=F.col(f"{p}_value"), row_count=_rows(p), considered=F.col(f"{p}_considered"),
                    failed=F.col(f"{p}_failed"), details=F.col(f"{p}_details"))

    def failing_rows(self, df):
        return K.unmatched_rows(df, self.columns, self._ref(df), self.ref_columns)


@dataclass(frozen=True, eq=False)
class SqlMetric(Measure):
    """DST-18: a whole SQL query over named views returning exactly one row
    and one numeric column (e.g. a join ratio)."""

    query: str
    fusable = False
    metric = "sql_query"

    def frame(self, df, p):
        q = df.sparkSession.sql(self.query)
        if len(q.columns) != 1:
            raise ValueError("a SQL metric query must return exactly one column")
        if not isinstance(q.schema.fields[0].dataType, _NUMERIC):
            raise ValueError(f"a SQL metric must be numeric, got {q.schema.fields[0].dataType.simpleString()}")
        # exactly one row: the aggregate below errors on more, gives NULL on none
        one = q.toDF("v").agg(F.count(F.lit(1)).alias("n"), F.first(F.col("v")).alias("v"))
        return one.select(
            F.when(F.col("n") <= 1, F.col("v")).otherwise(F.raise_error(F.lit("SQL metric returned more than one row")))
            .alias(f"{p}_value"),
            F.lit(None).cast("bigint").alias(f"{p}_rows"),
        )

    def outputs(self, p, df=None):
        return dict(value=F.col(f"{p}_value"), row_count=_rows(p), considered=F.lit(None), failed=F.lit(None))


# ----------------------------------------------------------------- checks

@dataclass(frozen=True, eq=False)
class MetricCheck:
    """A named metric with verdict thresholds and optional failed-row query.

    ``fail`` / ``warn``: a Threshold or a list of them (any hit counts).
    Fail wins over warn over pass; a metric that cannot be computed
    (NULL value under a threshold) fails.
    """

    name: str
    measure: Measure
    fail: object = None
    warn: object = None
    dimension: str = ""
    failed_rows_query: str | None = None
    samples_limit: int | None = None

    def thresholds(self, which):
        t = getattr(self, which)
        if t is None:
            return []
        return list(t) if isinstance(t, (list, tuple)) else [t]


def _measure_col(on, out):
    value, considered, failed, rows = out["value"], out["considered"], out["failed"], out["row_count"]
    if on == "value":
        return value
    if on == "failed_rows":
        return failed
    if on == "failed_pct":
        return F.coalesce(F.try_divide(failed * F.lit(100.0), rows), F.lit(0.0))
    if on == "pass_ratio":
        return F.coalesce(F.try_divide((considered - failed).cast("double"), considered), F.lit(1.0))
    raise ValueError(f"unknown measure {on!r}")


def _any_hit(check: MetricCheck, which: str, out, p) -> Column | None:
    conds = [F.coalesce(t.hit(_measure_col(t.on, out)), F.lit(True)) for t in check.thresholds(which)]
    if which == "fail":
        extra = check.measure.extra_fail(p)
        if extra is not None:
            conds.append(F.coalesce(extra, F.lit(True)))
    if not conds:
        return None
    c = conds[0]
    for x in conds[1:]:
        c = c | x
    return c


def _numeric_flags(source: DataFrame, outs: list[dict]) -> list[bool]:
    """Whether each value is numeric - one analysis for all values."""
    schema = source.select(*[o["value"].alias(f"__rg_v{i}") for i, o in enumerate(outs)]).schema
    return [isinstance(f.dataType, _NUMERIC) or isinstance(f.dataType, T.NullType) for f in schema.fields]


def _structs(checks: list[tuple[MetricCheck, str]], source: DataFrame, df: DataFrame) -> list[Column]:
    outs = [c.measure.outputs(p, df) for c, p in checks]
    flags = _numeric_flags(source, outs)
    return [_result_struct(c, p, o, n) for (c, p), o, n in zip(checks, outs, flags)]


def _result_struct(check: MetricCheck, p: str, out: dict, numeric: bool) -> Column:
    fail = _any_hit(check, "fail", out, p)
    warn = _any_hit(check, "warn", out, p)
    outcome = F.lit("pass")
    if fail is not None and warn is not None:
        outcome = F.when(fail, "fail").when(warn, "warn").otherwise("pass")
    elif fail is not None:
        outcome = F.when(fail, "fail").otherwise("pass")
    elif warn is not None:
        outcome = F.when(warn, "warn").otherwise("pass")
    value = out["value"]
    failed = out["failed"]
    rows = out["row_count"]
    return F.struct(
        F.lit(check.name).alias("check"),
        F.lit(check.dimension).alias("dimension"),
        F.lit(check.measure.metric).alias("metric"),
        (value.cast("double") if numeric else F.lit(None).cast("double")).alias("value"),
        value.cast("string").alias("observed"),
        rows.cast("bigint").alias("row_count"),
        out["considered"].cast("bigint").alias("considered_rows"),
        failed.cast("bigint").alias("failed_rows"),
        F.try_divide(failed.cast("double") * F.lit(100.0), rows).alias("failed_pct"),
        outcome.alias("outcome"),
        out.get("details", F.lit(None)).cast("string").alias("details"),
    )


def _error_frame(spark, check: MetricCheck, err: Exception) -> DataFrame:
    msg = str(err) or type(err).__name__
    return spark.createDataFrame(
        [(check.name, check.dimension, check.measure.metric, None, None, None, None, None, None, "error", msg)],
        RESULT_SCHEMA,
    )


def _alone(df: DataFrame, check: MetricCheck, p: str, known=None) -> DataFrame:
    """The result row of one check from its own aggregation or frame (analysed, not run)."""
    if check.measure.fusable:
        one = df.agg(*check.measure.aggregates(df, p))
    else:
        one = check.measure.frame(df, p, known) if known else check.measure.frame(df, p)
    return one.select(F.inline(F.array(*_structs([(check, p)], one, df))))


def shared_quantiles(df: DataFrame, checks: Sequence[MetricCheck]) -> dict[str, tuple[int, list]]:
    """(rows, values) by check name for all exact quantiles, found in shared rounds.

    Nothing if they cannot be found together (a wrong column, an expression that
    fails): then every check finds its own, and only the wrong one is in error.
    """
    exact = [c for c in checks if isinstance(c.measure, Quantiles) and not c.measure.fusable]
    if len(exact) < 2:
        return {}
    try:
        rows, values = exact_quantiles_of(df, [(c.measure.column, c.measure.quantiles, c.measure.method) for c in exact])
    except (PySparkException, ValueError) as err:
        if not is_data_error(err):
            raise
        return {}
    return {c.name: (rows, v) for c, v in zip(exact, values)}


def evaluate(df: DataFrame, checks: Sequence[MetricCheck], known: dict[str, tuple[int, list]] | None = None) -> DataFrame:
    """Evaluate metric checks on one frame; one result row per check.

    All fusable measures share one aggregation job over ``df``; duplicate checks
    share one scan and shuffle of key hashes, value sets one of unexpected values,
    exact quantiles their rounds (``known``: already found). A check whose plan
    cannot be built (bad SQL, unknown column) yields an ``error`` row and the
    others stay fused (VRD-9).
    """
    names = [c.name for c in checks]
    if len(set(names)) != len(names):
        raise ValueError("metric check names must be unique")
    spark = df.sparkSession
    known = shared_quantiles(df, checks) if known is None else known
    parts: list[DataFrame] = []
    fused = [(c, f"m{i}") for i, c in enumerate(checks) if c.measure.fusable]
    own = [(c, f"m{i}") for i, c in enumerate(checks) if not c.measure.fusable]
    for kind in dict.fromkeys(type(c.measure) for c, _ in own):
        group = [(c, p) for c, p in own if type(c.measure) is kind]
        together = _together(df, kind, group) if len(group) > 1 else None
        parts.extend([together] if together is not None else [_analysed(df, c, p, known.get(c.name)) for c, p in group])
    if fused:
        try:
            one = df.agg(*[a for c, p in fused for a in c.measure.aggregates(df, p)])
            structs = _structs(fused, one, df)
        except (PySparkException, ValueError):
            # analysis alone, no job: the checks that have a plan stay together
            errors = {c.name: e for c, p in fused if (e := _analysed(df, c, p, only_error=True)) is not None}
            parts.extend(errors.values())
            fused = [(c, p) for c, p in fused if c.name not in errors]
            one = df.agg(*[a for c, p in fused for a in c.measure.aggregates(df, p)]) if fused else None
            structs = _structs(fused, one, df) if fused else []
        if fused:
            parts.insert(0, one.select(F.inline(F.array(*structs))))
    if not parts:
        return spark.createDataFrame([], RESULT_SCHEMA)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _together(df: DataFrame, kind: type[Measure], group: list[tuple[MetricCheck, str]]) -> DataFrame | None:
    """The result rows of checks whose measures share a frame; None if they do not, or one has no plan."""
    try:
        one = kind.frame_of(df, [(c.measure, p) for c, p in group])
        return None if one is None else one.select(F.inline(F.array(*_structs(group, one, df))))
    except (PySparkException, ValueError) as err:
        if not is_data_error(err):
            raise
        return None


def _analysed(df: DataFrame, check: MetricCheck, p: str, known=None, only_error: bool = False) -> DataFrame | None:
    """A check's own frame, or its ``error`` row if it has no plan."""
    try:
        alone = _alone(df, check, p, known)
        alone.schema  # noqa: B018 - analysis, where the session is remote
        return None if only_error else alone
    except (PySparkException, ValueError) as err:
        if not is_data_error(err):
            raise
        return _error_frame(df.sparkSession, check, err)


#: SQLSTATE classes of what a query or its data is to blame for: dynamic and data
#: exceptions, cardinality, unsupported features, syntax and access, routines, raised errors
DATA_STATES = ("07", "0A", "21", "22", "2F", "38", "39", "42", "P0")


def is_data_error(err: Exception) -> bool:
    """Whether a check, not the cluster, is to blame: a lost executor is no check's result."""
    if isinstance(err, (AnalysisException, ParseException, PythonException)):
        return True
    if isinstance(err, PySparkException):
        return (err.getSqlState() or "").startswith(DATA_STATES)
    return isinstance(err, ValueError)


def evaluate_isolated(df: DataFrame, checks: Sequence[MetricCheck]) -> DataFrame:
    """Like :func:`evaluate`, but a check that fails *at run time* (e.g. an
    ANSI division by zero in a user expression) becomes an ``error`` row
    while the others are still reported (VRD-9).

    Runs now: all checks in one evaluation; if that fails through a check's own
    fault, the checks are halved until the failing ones are alone, so one failing
    check of n costs at most 2 log2(n) + 1 evaluations. Any other failure (lost
    executors, full disks) is raised. The result, one row per check, is a small
    local frame.
    """
    spark = df.sparkSession
    known = shared_quantiles(df, checks)

    def run(group: list[MetricCheck], failing: bool = False) -> list:
        """Result rows; ``failing``: the group is known to fail as a whole."""
        if not failing or len(group) == 1:
            try:
                return evaluate(df, group, known).collect()
            except PySparkException as err:
                if not is_data_error(err):
                    raise
                if len(group) == 1:
                    return _error_frame(spark, group[0], err).collect()
        half = len(group) // 2
        first = run(group[:half])
        # a first half without a failing check leaves it to the second
        second = run(group[half:], failing=not any(r.outcome == "error" for r in first))
        return first + second

    return spark.createDataFrame(run(list(checks)) if checks else [], RESULT_SCHEMA)


def evaluate_many(frames: dict[str, DataFrame], checks: Sequence[MetricCheck]) -> DataFrame:
    """EXT-4: the same checks on several datasets; results carry a
    ``dataset`` column (one fused aggregation per dataset, unioned)."""
    out = None
    for name, df in frames.items():
        part = evaluate(df, checks).select(F.lit(name).alias("dataset"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def outcome_counts(results: DataFrame) -> DataFrame:
    """VRD-9: one row with the number of checks per outcome."""
    return results.agg(
        F.count(F.lit(1)).alias("checks"),
        *[F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES],
    )
