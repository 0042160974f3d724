"""Key-based dataset operators: foreign keys, duplicate groups, group marks.

Every row-marking dataset check follows one skew-safe pattern:

1. aggregate the checked frame by key (partial + final hash aggregate: a
   hot key costs one row per map task in the shuffle, not all its rows);
2. keep only the *flagged* keys (duplicated, unmatched, violating), each
   with its row count;
3. left-join the frame to the flagged keys. Keys with more than
   ``hot_key_rows`` rows are split: their frame rows are dealt to buckets
   ``[0, buckets)`` by their place in their partition, which also parts equal
   rows, and the flagged key is replicated once per bucket, so no task
   receives more than about ``hot_key_rows`` rows of one key. There are at
   most ``rows / hot_key_rows`` hot keys; they and the flagged set are joined
   by Spark's size-checked strategy (broadcast when small, else sort-merge,
   with AQE skew splitting on top).

Places are stable under retry wherever partitions come back in the same order:
scans, and what narrow steps make of them. A frame that comes out of a shuffle
should be a written or checkpointed one.

A ``Window.partitionBy(keys)`` would put every row of a hot key into one
task, which cannot be split; it is not used.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowguard.functions.predicates import all_not_null, col, quote

#: rows of one key that one task may receive before the key is split
HOT_KEY_ROWS = 1_000_000


def _match(left: Sequence[str], right: Sequence[str], null_safe: bool = False) -> Column:
    pairs = [
        col(a).eqNullSafe(F.col(b)) if null_safe else (col(a) == F.col(b))
        for a, b in zip(left, right)
    ]
    return reduce(lambda x, y: x & y, pairs)


def distinct_keys(ref: DataFrame, ref_columns: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Distinct non-null reference keys renamed to ``names``.

    De-duplicating here keeps a left join from multiplying fact rows when
    the reference table repeats a key.
    """
    return (
        ref.select(*[col(c).alias(n) for c, n in zip(ref_columns, names)])
        .where(all_not_null(names))
        .distinct()
    )


def key_counts(df: DataFrame, columns: Sequence[str], names: Sequence[str], count_name: str) -> DataFrame:
    """Rows per key value (null keys form their own groups), pre-aggregated."""
    return (
        df.select(*[col(c).alias(n) for c, n in zip(columns, names)])
        .groupBy(*names)
        .agg(F.count(F.lit(1)).alias(count_name))
    )


def mark_keys(
    df: DataFrame,
    columns: Sequence[str],
    flagged: DataFrame,
    names: Sequence[str],
    count_name: str,
    flag: str,
    null_safe: bool = False,
    hot_key_rows: int = HOT_KEY_ROWS,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Add boolean ``flag`` = the row's key is in ``flagged``.

    ``flagged`` has one row per key (columns ``names``) with the number of
    ``df`` rows of that key in ``count_name``; ``extra`` columns of
    ``flagged`` are carried over (NULL for unflagged rows).
    """
    if hot_key_rows < 1:
        raise ValueError("hot_key_rows must be positive")
    n = F.col(count_name)
    buckets = F.when(n > hot_key_rows, F.ceil(n / F.lit(hot_key_rows))).otherwise(F.lit(1)).cast("int")
    hot_names = [f"{flag}_h{i}" for i in range(len(names))]
    hot = flagged.where(n > hot_key_rows).select(
        *[F.col(k).alias(h) for k, h in zip(names, hot_names)], buckets.alias(f"{flag}_hb"))
    salt_l, salt_r, marker, place = f"{flag}_sl", f"{flag}_sr", f"{flag}_m", f"{flag}_at"
    keep = [F.col(quote(c)) for c in df.columns]
    # no function of the row's content: equal rows, which uniqueness is about, are parted too
    df = df.withColumn(place, F.monotonically_increasing_id())
    dealt = F.pmod(F.col(place), F.col(f"{flag}_hb")).cast("int")
    salt = F.when(F.col(f"{flag}_hb").isNull(), F.lit(0)).otherwise(dealt)
    # few keys, but their size is Spark's to check
    left = df.join(hot, _match(columns, hot_names, null_safe), "left").select(*keep, salt.alias(salt_l))
    right = flagged.select(
        *names, *extra, F.explode(F.sequence(F.lit(0), buckets - 1)).alias(salt_r), F.lit(True).alias(marker))
    cond = _match(columns, names, null_safe) & (F.col(salt_l) == F.col(salt_r))
    return left.join(right, cond, "left").select(
        *keep, F.col(marker).isNotNull().alias(flag), *[F.col(e) for e in extra])


def unmatched_keys(
    df: DataFrame, columns: Sequence[str], ref: DataFrame, ref_columns: Sequence[str],
    names: Sequence[str], count_name: str,
) -> DataFrame:
    """Fully non-null keys of ``df`` absent from ``ref``, with their row
    counts: distinct keys joined with distinct keys (no fact-row shuffle)."""
    counts = key_counts(df, columns, names, count_name).where(all_not_null(names))
    ref_names = [f"{n}_r" for n in names]
    return counts.join(distinct_keys(ref, ref_columns, ref_names), _match(names, ref_names), "left_anti")


def mark_unmatched(
    df: DataFrame,
    columns: Sequence[str],
    ref: DataFrame,
    ref_columns: Sequence[str],
    flag: str,
    source: DataFrame | None = None,
    hot_key_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """DST-4 / JON-6: add boolean ``flag`` = key fully non-null and absent in ``ref``.

    Rows with a null key part are skipped (flag false): only the
    completeness checks report nulls. Keys are counted on ``source``
    (default ``df``, which must hold the same rows).
    """
    if len(columns) != len(ref_columns) or not columns:
        raise ValueError("columns and ref_columns must be non-empty and of equal length")
    names = [f"{flag}_k{i}" for i in range(len(columns))]
    count_name = f"{flag}_n"
    bad = unmatched_keys(source if source is not None else df, columns, ref, ref_columns, names, count_name)
    return mark_keys(df, columns, bad, names, count_name, flag, hot_key_rows=hot_key_rows)


def mark_unmatched_direct(
    df: DataFrame, columns: Sequence[str], ref: DataFrame, ref_columns: Sequence[str], flag: str,
) -> DataFrame:
    """:func:`mark_unmatched` as one left join of every row against the
    distinct reference keys, with no aggregation of ``df``. Spark chooses the
    join by the keys' size: a small reference is broadcast (no shuffle of
    ``df``), a large one is sort-merge joined, with skewed keys split by
    adaptive execution. Streams use it as a stream-static join."""
    names = [f"{flag}_k{i}" for i in range(len(columns))]
    marker = f"{flag}_m"
    keys = distinct_keys(ref, ref_columns, names).withColumn(marker, F.lit(True))
    joined = df.join(keys, _match(columns, names), "left")
    return joined.withColumn(flag, all_not_null(columns) & F.col(marker).isNull()).drop(*names, marker)


#: keys of one bucket of a bitmap index, as Spark's bitmap functions deal them
BITMAP_KEYS = 32_768
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NARROW = (*_INTEGRAL, T.FloatType, T.DoubleType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def bitmap_index(ref: DataFrame, ref_column: str, bucket: str = "bucket", bits: str = "bits") -> DataFrame:
    """Exact index of integral keys: a row of 4 KB for every 32,768 neighbouring
    values that the reference uses, whatever number of rows holds them. Bitmaps
    of parts merge, so a hot bucket is one entry a task in the shuffle."""
    key = col(ref_column).cast("bigint")
    return (ref.where(col(ref_column).isNotNull()).groupBy(F.bitmap_bucket_number(key).alias(bucket))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias(bits)))


def bitmap_holds(key: Column, bits: Column) -> Column:
    """Whether the bitmap of a key's bucket (null: no bucket) holds the key."""
    at = F.bitmap_bit_position(key)
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, at.bitwiseAND(F.lit(7)).cast("int")) == 1, F.lit(False))


def mark_unmatched_bitmap(df: DataFrame, column: str, ref: DataFrame, ref_column: str, flag: str) -> DataFrame:
    """:func:`mark_unmatched_direct` for one integral column against a bitmap index.

    The joined side holds a row for every 32,768 values of the key range instead
    of one for every key: for dense keys (order numbers, ids from a sequence) an
    eighth of a byte a key, so far larger references stay below Spark's broadcast
    size. Spark chooses the join by that size; sparse keys are better served by
    the plain form.
    """
    for frame, name in ((df, column), (ref, ref_column)):
        if not isinstance(frame.select(col(name)).schema[0].dataType, _INTEGRAL):
            raise ValueError(f"a bitmap index needs integral keys, {name} is not")
    bucket, bits = f"{flag}_b", f"{flag}_bits"
    key = col(column).cast("bigint")
    joined = df.join(bitmap_index(ref, ref_column, bucket, bits), F.bitmap_bucket_number(key) == F.col(bucket), "left")
    return joined.withColumn(flag, col(column).isNotNull() & ~bitmap_holds(key, F.col(bits))).drop(bucket, bits)


def duplicate_keys(
    df: DataFrame, columns: Sequence[str], names: Sequence[str], count_name: str,
    nulls_distinct: bool = True,
) -> DataFrame:
    """Keys that occur more than once, with their group size.

    With ``nulls_distinct`` (default) a key with any null part is never a
    duplicate.
    """
    counts = key_counts(df, columns, names, count_name)
    if nulls_distinct:
        counts = counts.where(all_not_null(names))
    return counts.where(F.col(count_name) > 1)


def mark_duplicates(
    df: DataFrame, columns: Sequence[str], flag: str, nulls_distinct: bool = True,
    source: DataFrame | None = None, hot_key_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """DST-1 / WIN-1: add boolean ``flag`` = row belongs to a key group of
    size > 1, and ``{flag}_size`` = that group size."""
    if not columns:
        raise ValueError("at least one key column is required")
    names = [f"{flag}_k{i}" for i in range(len(columns))]
    count_name = f"{flag}_size"
    dups = duplicate_keys(source if source is not None else df, columns, names, count_name, nulls_distinct)
    return mark_keys(df, columns, dups, names, count_name, flag, null_safe=not nulls_distinct,
                     hot_key_rows=hot_key_rows, extra=[count_name])


def duplicate_stats(
    df: DataFrame, columns: Sequence[str], nulls_distinct: bool = True
) -> DataFrame:
    """DST-2 / DST-3 / AGG-12: one row with duplicate statistics of a key set.

    ``row_count`` all rows; ``considered_rows`` rows whose key is fully
    non-null (all rows when ``nulls_distinct`` is false);
    ``duplicate_groups`` keys seen more than once; ``duplicate_rows`` rows
    in such groups; ``excess_rows`` rows beyond the first of each group.
    The group-by is pre-aggregated map-side, so a hot key is cheap.
    """
    names = [f"__rg_k{i}" for i in range(len(columns))]
    complete = all_not_null(names) if nulls_distinct else F.lit(True)
    groups = key_counts(df, columns, names, "n").withColumn("complete", complete)
    dup = F.col("complete") & (F.col("n") > 1)
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("complete"), F.col("n"))), F.lit(0)).cast("bigint").alias("considered_rows"),
        F.count_if(dup).cast("bigint").alias("duplicate_groups"),
        F.coalesce(F.sum(F.when(dup, F.col("n"))), F.lit(0)).cast("bigint").alias("duplicate_rows"),
        F.coalesce(F.sum(F.when(dup, F.col("n") - 1)), F.lit(0)).cast("bigint").alias("excess_rows"),
    )


def _hashed(columns: Sequence[str]) -> list[Column]:
    """128 bits that stand for a key: two hashes of its parts and of which are null."""
    parts = [x for c in columns for x in (col(c), col(c).isNull())]
    return [F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(len(columns)), *parts[::-1]).alias("h2")]


def _tagged_groups(df: DataFrame, key_sets: Sequence[tuple[Sequence[str], bool]]) -> DataFrame:
    """(s, h1, h2, complete, n): rows of every key of every set, by key hash.

    A third hash, whose extremes are kept a group, confirms that a group is of one
    key: a group of two fails the query (chance below 1e-20 at 1e13 keys) rather
    than give a wrong count. Equal keys always meet.
    """
    entries = []
    for i, (columns, nulls_distinct) in enumerate(key_sets):
        if not columns:
            raise ValueError("at least one key column is required")
        complete = all_not_null(columns) if nulls_distinct else F.lit(True)
        parts = [x for c in columns for x in (col(c), col(c).isNull())]
        entries.append(F.struct(F.lit(i).alias("s"), *_hashed(columns), F.hash(F.lit(7), *parts).alias("h3"), complete.alias("complete")))
    one_key = F.when(F.min("h3") == F.max("h3"), F.count(F.lit(1))).otherwise(
        F.raise_error(F.lit("two keys share a 128-bit hash")).cast("bigint"))
    return df.select(F.inline(F.array(*entries))).groupBy("s", "h1", "h2", "complete").agg(one_key.alias("n"))


def duplicate_hashes_of(df: DataFrame, key_sets: Sequence[tuple[Sequence[str], bool]]) -> DataFrame:
    """(s, h1, h2, n) of the keys that occur more than once, all sets from one scan and shuffle."""
    groups = _tagged_groups(df, key_sets)
    return groups.where(F.col("complete") & (F.col("n") > 1)).select("s", "h1", "h2", "n")


def mark_duplicates_of(
    df: DataFrame, columns: Sequence[str], flagged: DataFrame, number: int, flag: str, hot_key_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """:func:`mark_duplicates` from the shared ``duplicate_hashes_of``, by the set's number."""
    names, own, size = [f"{flag}_k0", f"{flag}_k1"], [f"{flag}_o0", f"{flag}_o1"], f"{flag}_size"
    # the set is told by an expression of the counted rows: a filter on its number alone
    # would move below the shuffle, and every set would have one of its own
    mine = flagged.where(F.when(F.col("n") > 1, F.col("s")) == number).select(
        F.col("h1").alias(names[0]), F.col("h2").alias(names[1]), F.col("n").alias(size))
    keyed = df.select("*", *[h.alias(o) for h, o in zip(_hashed(columns), own)])
    return mark_keys(keyed, own, mine, names, size, flag, hot_key_rows=hot_key_rows, extra=[size]).drop(*own)


def duplicate_stats_of(df: DataFrame, key_sets: Sequence[tuple[Sequence[str], bool]]) -> DataFrame:
    """:func:`duplicate_stats` of several key sets of one frame: one row, the
    i-th set's columns ending in ``_i``.

    Every row gives one tagged entry a set: its number and a fixed-width hash of
    the key, so all sets share one scan and one shuffle, which moves no texts. A
    single set of columns that are no wider than a hash is counted by its own keys.
    """
    kinds = [df.select(col(c)).schema[0].dataType for columns, _ in key_sets for c in columns]
    if len(key_sets) == 1 and len(kinds) <= 2 and all(isinstance(k, _NARROW) for k in kinds):
        columns, nulls_distinct = key_sets[0]
        one = duplicate_stats(df, columns, nulls_distinct)
        return one.select(*[F.col(c).alias(f"{c}_0") for c in one.columns])
    groups = _tagged_groups(df, key_sets)
    out = []
    for i in range(len(key_sets)):
        own = F.col("s") == i
        dup = own & F.col("complete") & (F.col("n") > 1)
        total = lambda cond, x: F.coalesce(F.sum(F.when(cond, x)), F.lit(0)).cast("bigint")
        out += [
            total(own, F.col("n")).alias(f"row_count_{i}"), total(own & F.col("complete"), F.col("n")).alias(f"considered_rows_{i}"),
            F.count_if(dup).cast("bigint").alias(f"duplicate_groups_{i}"), total(dup, F.col("n")).alias(f"duplicate_rows_{i}"),
            total(dup, F.col("n") - 1).alias(f"excess_rows_{i}")]
    return groups.agg(*out)


def unmatched_stats(
    df: DataFrame, columns: Sequence[str], ref: DataFrame, ref_columns: Sequence[str],
) -> DataFrame:
    """DST-15 / JON-3: one row ``row_count``, ``considered_rows`` (non-null
    keys), ``matched_rows``, ``unmatched_rows`` (null keys skipped) and
    ``unmatched_or_null_rows`` (null keys counted as unmatched).

    The frame is first reduced to distinct keys with row counts, and distinct
    keys are joined with distinct reference keys: a hot key is one row, and no
    fact row is shuffled.
    """
    names = [f"__rg_u{i}" for i in range(len(columns))]
    ref_names = [f"__rg_r{i}" for i in range(len(columns))]
    keys = distinct_keys(ref, ref_columns, ref_names).withColumn("__rg_hit", F.lit(True))
    j = key_counts(df, columns, names, "n").join(keys, _match(names, ref_names), "left")
    nonnull = all_not_null(names)
    hit = F.col("__rg_hit").isNotNull()

    def total(cond):
        return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("bigint")

    return j.agg(
        total(F.lit(True)).alias("row_count"),
        total(nonnull).alias("considered_rows"),
        total(nonnull & hit).alias("matched_rows"),
        total(nonnull & ~hit).alias("unmatched_rows"),
        total(~nonnull | ~hit).alias("unmatched_or_null_rows"),
    )


def unmatched_rows(
    df: DataFrame, columns: Sequence[str], ref: DataFrame, ref_columns: Sequence[str],
) -> DataFrame:
    """JON-4: rows of ``df`` whose fully non-null key is absent in ``ref``
    (rows with a null key part are not returned)."""
    flagged = mark_unmatched_direct(df, columns, ref, ref_columns, "__rg_unm")
    return flagged.where(F.col("__rg_unm")).drop("__rg_unm")
