"""Exact quantiles with bounded memory (AGG-6 / DST-10 at scale).

Spark's exact ``percentile`` keeps every distinct value of the column in the
aggregation buffer and merges them in one task. Here the value at a rank is
selected by range: each round is one aggregation that counts rows by bin, with
the smallest and largest value of each bin, and the bin that holds the rank is
the next round's range. All ranks, all columns and all checks of a frame share
the rounds.

* Round 1 bins by sign and power of two of the value.
* Every further round cuts the range that is left into ``accuracy`` equal bins;
  a range with fewer possible values than that is binned by value.

Bins need only be monotone in the value, and casts to double, subtraction and
division are, so a bin may be computed in doubles while counts, bounds and answers
keep the column's type. A round divides the range by ``accuracy``, so the number
of rounds depends on the type's width alone: with 4096 bins at most 7 for 64-bit
integers, dates, times and doubles and 13 for decimals of 38 digits, whatever the
rows hold. Ends of bins and values that many rows share are answered at once. A
task holds one bin table a range, and the driver gets at most that many rows.

Semantics equal Spark's: ``disc`` is the value at 1-based rank
``max(1, ceil(n * q))``, for any ordered type listed here; ``cont`` interpolates
at 0-based position ``(n - 1) * q`` and needs numbers.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowguard.functions.predicates import col

#: bins of one range in one round
ACCURACY = 4096
#: whole numbers that order dates, times and truth values alike, and the way back
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
_KEYS = {
    T.DateType: (lambda v: F.unix_date(v).cast("bigint"), "date_from_unix_date(CAST({} AS INT))"),
    T.TimestampType: (F.unix_micros, "timestamp_micros({})"),
    T.TimestampNTZType: (lambda v: F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), v), f"timestampadd(MICROSECOND, {{}}L, {_EPOCH})"),
    T.BooleanType: (lambda v: v.cast("int").cast("bigint"), "CAST({} AS BOOLEAN)"),
}
#: beyond all powers of two that a double has
_INF = 4000


@dataclass(eq=False)
class _Range:
    """Values from ``lo`` to ``hi`` (None: all), with ``below`` rows before them."""

    lo: object
    hi: object
    below: int


@dataclass(eq=False)
class _Target:
    """One column's key, and the ranks still sought, each with its range."""

    key: Column
    kind: T.DataType
    back: str | None
    n: int = 0
    sought: dict[int, _Range] = field(default_factory=dict)
    found: dict[int, object] = field(default_factory=dict)

    def ranges(self) -> list[_Range]:
        return list({(id(r)): r for r in self.sought.values()}.values())

    def literal(self, x) -> Column:
        return F.lit(x).cast(self.kind)


def _positions(n: int, q: float, method: str) -> tuple[int, int, float]:
    """0-based (lower, upper) positions and the interpolation point."""
    if method == "disc":
        k = max(1, math.ceil(n * q)) - 1
        return k, k, float(k)
    h = (n - 1) * q
    return math.floor(h), math.ceil(h), h


def _target(df: DataFrame, column: str, method: str) -> _Target:
    kind = df.select(col(column)).schema[0].dataType
    if method not in ("disc", "cont"):
        raise ValueError("method is disc or cont")
    if method == "cont" and not isinstance(kind, T.NumericType):
        raise ValueError("cont interpolates numbers")
    if type(kind) in _KEYS:
        to_key, back = _KEYS[type(kind)]
        return _Target(to_key(col(column)), T.LongType(), back)
    if isinstance(kind, T.DecimalType):
        return _Target(col(column), kind, None)
    if isinstance(kind, T.IntegralType):
        return _Target(col(column).cast("bigint"), T.LongType(), None)
    if isinstance(kind, T.FractionalType):
        return _Target(col(column).cast("double"), T.DoubleType(), None)
    raise ValueError(f"no quantiles of {kind.simpleString()}")


def _power(key: Column) -> Column:
    """Round 1: sign and power of two, ascending with the value."""
    x = key.cast("double")
    size = F.lit(2000) + F.floor(F.log2(F.abs(x)))
    inf = float("inf")
    return (F.when(x.isNull(), None).when(F.isnan(x), _INF + 1).when(x == inf, _INF).when(x == -inf, -_INF)
            .when(x == 0, 0).when(x > 0, size).otherwise(-size)).cast("bigint")


def _few(t: _Target, r: _Range, bins: int) -> bool:
    """Whether a range of whole units has no more than ``bins`` of them."""
    if isinstance(t.kind, T.DecimalType):
        return (r.hi - r.lo).scaleb(t.kind.scale) < bins
    return isinstance(t.kind, T.LongType) and r.hi - r.lo < bins


def _bin(t: _Target, key: Column, r: _Range, bins: int) -> Column:
    """A further round: equal parts of the range, ascending with the value."""
    if _few(t, r, bins):
        # decimals are told apart by their own value, see _rounds
        return F.lit(0).cast("bigint") if isinstance(t.kind, T.DecimalType) else key - F.lit(r.lo)
    width = float(r.hi - r.lo) / bins or 5e-324  # the smallest double
    return F.floor((key - t.literal(r.lo)).cast("double") / F.lit(width)).cast("bigint")


def _round(keyed: DataFrame, targets: list[_Target], first: bool, bins: int) -> list[list[Row]]:
    """Rows (t range, b bin, n, lo, hi) of each target: one aggregation for all."""
    slots = {t.kind.simpleString(): t.kind for t in targets}
    at = {k: f"s{i}" for i, k in enumerate(slots)}
    entries = []
    for i, t in enumerate(targets):
        key = F.col(f"k{i}")
        if first:
            of, b, own = F.lit(0), _power(key), F.lit(None)
        else:
            of, b, own = F.lit(None), F.lit(None), F.lit(None)
            for j, r in enumerate(t.ranges()):
                inside = (key >= t.literal(r.lo)) & (key <= t.literal(r.hi))
                by_value = isinstance(t.kind, T.DecimalType) and _few(t, r, bins)
                of, b = F.when(inside, F.lit(j)).otherwise(of), F.when(inside, _bin(t, key, r, bins)).otherwise(b)
                own = F.when(inside, key.cast("string")).otherwise(own) if by_value else own
        values = [(key if at[t.kind.simpleString()] == s else F.lit(None).cast(kind)).alias(s) for kind, s in zip(slots.values(), at.values())]
        entries.append(F.struct(F.lit(i).alias("c"), of.cast("int").alias("t"), b.cast("bigint").alias("b"), own.cast("string").alias("own"), *values))
    rows = keyed.select(F.inline(F.array(*entries))).where("t IS NOT NULL").groupBy("c", "t", "b", "own").agg(
        F.count(F.lit(1)).alias("n"), *[f(s).alias(f"{s}_{f.__name__}") for s in at.values() for f in (F.min, F.max)]).collect()
    out: list[list[Row]] = [[] for _ in targets]
    for r in rows:
        s = at[targets[r.c].kind.simpleString()]
        out[r.c].append(Row(t=r.t, b=r.b, n=r.n, lo=r[f"{s}_min"], hi=r[f"{s}_max"], own=r.own))
    return out


def _narrow(t: _Target, r: _Range, ranks: list[int], found: list[Row]) -> None:
    """Answer ranks of a range or move them to the bins that hold them."""
    below = r.below
    found = sorted(found, key=lambda x: x.lo if x.own is not None else x.b)
    ranks = sorted(ranks)
    for x in found:
        held = [p for p in ranks if below <= p < below + x.n]
        smaller = _Range(x.lo, x.hi, below)
        for p in held:
            single = x.lo == x.hi or x.lo != x.lo  # NaN
            if single or p == below:
                t.found[p] = x.lo
            elif p == below + x.n - 1:
                t.found[p] = x.hi
            else:
                t.sought[p] = smaller
                continue
            del t.sought[p]
        below += x.n


def exact_quantiles_of(
    df: DataFrame, wanted: Sequence[tuple[str, Sequence[float], str]], accuracy: int = ACCURACY,
) -> tuple[int, list[list]]:
    """(rows, exact values of each (column, quantiles, method)); NULLs ignored.

    Columns that are asked for several times are read once.
    """
    if accuracy < 2:
        raise ValueError("a round needs two bins at least")
    names = list(dict.fromkeys(c for c, _, _ in wanted))
    if not names:
        return df.count(), []
    for c, _, method in wanted:
        _target(df, c, method)
    targets = [_target(df, c, "disc") for c in names]
    keyed = df.select(*[t.key.alias(f"k{i}") for i, t in enumerate(targets)])  # the pruned columns
    first = _round(keyed, targets, True, accuracy)
    rows = sum(x.n for x in first[0])
    asked = []
    for t, found in zip(targets, first):
        found = [x for x in found if x.b is not None]
        t.n = sum(x.n for x in found)
        of = [(q, method) for c, qs, method in wanted if targets[names.index(c)] is t for q in qs]
        whole = _Range(None, None, 0)
        t.sought = {p: whole for q, method in of if t.n for p in _positions(t.n, float(q), method)[:2]}
        _narrow(t, whole, list(t.sought), found)
    while any(t.sought for t in targets):
        left = [t for t in targets if t.sought]
        frame = keyed.select(*[F.col(f"k{j}").alias(f"k{i}") for i, j in enumerate(j for j, t in enumerate(targets) if t.sought)])
        for t, found in zip(left, _round(frame, left, False, accuracy)):
            for j, r in enumerate(t.ranges()):
                _narrow(t, r, [p for p, own in t.sought.items() if own is r], [x for x in found if x.t == j])
    for c, qs, method in wanted:
        t = targets[names.index(c)]
        asked.append([_value(t, float(q), method) for q in qs])
    return rows, _typed(df, [targets[names.index(c)] for c, _, _ in wanted], asked)


def _value(t: _Target, q: float, method: str):
    if not t.n:
        return None
    lo, hi, h = _positions(t.n, q, method)
    lower, higher = t.found[lo], t.found[hi]
    if method == "disc":
        return lower
    if lower == higher:
        return float(lower)
    if isinstance(lower, float):
        return (hi - h) * lower + (h - lo) * higher
    share = Fraction(h) - lo
    return float((1 - share) * Fraction(lower) + share * Fraction(higher))


def _typed(df: DataFrame, targets: list[_Target], values: list[list]) -> list[list]:
    """Keys of dates, times and truth values as such again."""
    back = [(i, j, t.back.format(x)) for i, (t, own) in enumerate(zip(targets, values)) if t.back for j, x in enumerate(own) if x is not None]
    if back:
        row = df.sparkSession.range(1).select(*[F.expr(e).alias(f"q{k}") for k, (_, _, e) in enumerate(back)]).first()
        for (i, j, _), x in zip(back, row):
            values[i][j] = x
    return values


def exact_quantiles(
    df: DataFrame, column: str, quantiles: Sequence[float], method: str = "disc", accuracy: int = ACCURACY,
) -> tuple[int, list]:
    """(rows, exact quantile values) of one column; NULLs ignored."""
    rows, values = exact_quantiles_of(df, [(column, quantiles, method)], accuracy)
    return rows, values[0]
