"""Sources (SRC-1..9): everything is a DataFrame reader with the partitioning
and schema options exposed, so reads parallelise and prune at scale."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowguard.functions.predicates import all_not_null, col


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Columnar scan; filters and column pruning reach the file reader."""
    return spark.read.parquet(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int | None = None,
) -> DataFrame:
    """SRC-1: a database table. Give ``partition_column`` with bounds and
    ``num_partitions`` so the read runs as parallel range queries instead
    of one task on one connection. Credentials come from ``properties``
    (never hard-coded)."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        r = (r.option("partitionColumn", partition_column).option("lowerBound", str(lower_bound))
             .option("upperBound", str(upper_bound)).option("numPartitions", str(num_partitions)))
    if fetch_size is not None:
        r = r.option("fetchsize", str(fetch_size))
    return r.load()


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    header: bool = True,
    drop_malformed: bool = False,
    corrupt_column: str | None = None,
) -> DataFrame:
    """SRC-3 / SRC-4: delimited text with a header.

    Prefer an explicit ``schema`` (inference is an extra full pass).
    ``drop_malformed`` skips lines that do not fit the schema (the inferred one,
    if none is given), judged as whole lines whatever columns a query needs; with
    ``corrupt_column`` they are kept with their raw text in that column
    (PERMISSIVE mode) so they can be quarantined instead of lost.
    """
    r = spark.read.option("header", header)
    if schema is None:
        inferred = r.option("inferSchema", True).csv(path)
        if not drop_malformed:
            return inferred
        schema, r = inferred.schema, spark.read.option("header", header)
    # Malformed lines are found through a corrupt-record column. Spark's CSV
    # reader parses only the columns a query needs, so a line would count as
    # malformed or not depending on later projections; the filter below
    # references every field (to_json of the whole row cannot be folded
    # away), so each line is judged against the full schema.
    bad = corrupt_column or "_rg_corrupt_record"
    st = spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema
    full = T.StructType(list(st.fields) + [T.StructField(bad, T.StringType(), True)])
    df = r.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", bad).csv(path)
    whole_row = F.length(F.to_json(F.struct(*[col(f.name) for f in st.fields]))) >= 0
    if drop_malformed:
        return df.where(F.col(bad).isNull() & whole_row).drop(bad)
    if corrupt_column:
        return df.where(whole_row)
    return df.drop(bad)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """SRC-5: a catalog table or view."""
    return spark.table(name)


def literal_frame(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """SRC-6: a small in-memory table with an explicit schema (e.g. thresholds)."""
    return spark.createDataFrame(list(rows), schema)


class Catalog:
    """SRC-2: one accessor for many named sources instead of one method per
    table: ``Catalog({"flights": lambda s: ...})["flights"]``. Loaders are
    called lazily, once per name."""

    def __init__(self, spark: SparkSession, loaders: Mapping[str, Callable[[SparkSession], DataFrame]]):
        self._spark = spark
        self._loaders = dict(loaders)
        self._frames: dict[str, DataFrame] = {}

    def names(self) -> list[str]:
        return sorted(self._loaders)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._loaders[name](self._spark)
        return self._frames[name]

    def register(self, *names: str) -> None:
        """Register sources as temp views under their names (SRC-7)."""
        for n in names or self.names():
            self[n].createOrReplaceTempView(n)

    @classmethod
    def parquet_dir(cls, spark: SparkSession, root: str, names: Sequence[str]) -> Catalog:
        return cls(spark, {n: (lambda s, n=n: read_parquet(s, f"{root}/{n}.parquet")) for n in names})

    @classmethod
    def jdbc(
        cls, spark: SparkSession, url: str, tables: Sequence[str], properties: Mapping[str, str],
        partitioning: Mapping[str, Mapping[str, object]] | None = None,
    ) -> Catalog:
        """``partitioning``: by table, the partition options of :func:`read_jdbc`
        (``partition_column``, bounds, ``num_partitions``, ``fetch_size``); a table
        without them is read over one connection."""
        unknown = set(partitioning or ()) - set(tables)
        if unknown:
            raise ValueError(f"partitioning of unknown tables: {sorted(unknown)}")
        return cls(spark, {t: (lambda s, t=t: read_jdbc(s, url, t, properties, **(partitioning or {}).get(t, {}))) for t in tables})


def one_per_key(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """A dimension before a left join: one row a key, so that a key that repeats does
    not multiply fact rows (JON-1). Of several rows the one with the smallest
    ``columns`` is taken; rows without a key are left out. A repeated key is one row
    a task in the shuffle, and the join on the same keys needs no other one."""
    named = [col(c).alias(c) for c in (*keys, *columns)]
    picked = df.select(*named).where(all_not_null(keys)).groupBy(*keys).agg(F.min(F.struct(*columns)).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in columns])


def distinct_keys(df: DataFrame, columns: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """Distinct, fully non-null key values (optionally renamed) - the form a
    reference table takes before a left join (JON-1/2)."""
    names = list(names or columns)
    return (df.select(*[col(c).alias(n) for c, n in zip(columns, names)])
            .where(all_not_null(names)).distinct())


def reference_key_set(
    sources: Sequence[tuple[DataFrame, str]], prefix: str = "", name: str = "key", trim: bool = True
) -> DataFrame:
    """SRC-8 / SET-1 / SCA-1: the union of id columns from several frames,
    each prefixed (e.g. ``'N' + id``), trimmed and de-duplicated
    (partial + final aggregation; no single-task step)."""
    parts = []
    for df, c in sources:
        v = col(c).cast("string")
        if trim:
            v = F.trim(v)
        parts.append(df.select(F.concat(F.lit(prefix), v).alias(name)))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.where(F.col(name).isNotNull()).distinct()
