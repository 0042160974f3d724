"""Mergeable metric states per partition, and key counts over streams."""

import math

import pytest
from pyspark.sql import functions as F

from rowguard.plans import states as St
from rowguard.streaming import state as Ss


def test_merged_states_equal_direct_metrics(spark, scratch):
    df = spark.range(0, 20_000).selectExpr("id % 5 AS day", "CAST(id * 37 % 1009 AS DOUBLE) AS x", "IF(id % 3 = 0, NULL, id) AS y",
                                           "IF(id = 7, DOUBLE('NaN'), 1.5D) AS z")
    path = f"{scratch}/states"
    assert St.update(df.where("day < 3"), F.col("day"), ["x", "y", "z"], path) == 3
    assert St.update(df, F.col("day"), ["x", "y", "z"], path) == 2
    assert St.update(df, F.col("day"), ["x", "y", "z"], path) == 0
    states = spark.read.parquet(path)
    assert states.count() == 15
    m = {r.column: r for r in St.merged(states, (0.1, 0.5, 0.99)).collect()}
    x = df.agg(F.count("*").alias("n"), F.avg("x").alias("a"), F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    assert (m["x"].row_count, m["x"].null_count, m["x"].min, m["x"].max) == (x.n, 0, x.lo, x.hi) and m["x"].mean == pytest.approx(x.a)
    assert m["y"].null_count == df.where("y IS NULL").count() and m["z"].null_count == 1 and m["z"].mean == 1.5
    assert abs(m["x"].approx_distinct - 1009) <= 50 and m["z"].approx_distinct == 1
    ordered = [r.x for r in df.orderBy("x").collect()]
    for i, q in enumerate((0.1, 0.5, 0.99)):
        value = m["x"][f"q{i}"]
        below, upto = sum(v < value for v in ordered), sum(v <= value for v in ordered)
        assert below - 0.01 * len(ordered) <= math.ceil(q * len(ordered)) <= upto + 0.01 * len(ordered)
    by_day = St.merged(states, by=["part"]).where("column = 'x'").collect()
    assert len(by_day) == 5 and sum(r.row_count for r in by_day) == x.n


def test_states_of_empty_and_null_columns(spark, scratch):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3.0)], "p int, x double")
    St.update(df, F.col("p"), ["x"], f"{scratch}/s")
    got = {r.part: r for r in St.merged(spark.read.parquet(f"{scratch}/s"), (0.5,), by=["part"]).collect()}
    assert (got[1].mean, got[1].q0, got[1].approx_distinct) == (None, None, 0) and got[2].q0 == 3.0
    with pytest.raises(ValueError, match="numbers"):
        St.build(spark.createDataFrame([("a",)], "x string"), F.lit(1), ["x"])


SCHEMA = "k string, g int, x double"
ROWS = [("a", 1, 1.0), ("a", 1, 2.0), ("b", 2, None), (None, 2, 50.0), (None, 1, -3.0), ("c", 1, 4.0), ("b", 2, 9.0), ("d", 3, None)]


def run(spark, scratch, keys, sums=()):
    for i in range(4):
        spark.createDataFrame(ROWS[2 * i:2 * i + 2], SCHEMA).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in")
    q = Ss.state_stream(stream, keys, f"{scratch}/state", f"{scratch}/ckpt", sums, available_now=True)
    q.awaitTermination()
    return f"{scratch}/state"


def test_uniqueness_over_a_stream_equals_batch(spark, scratch):
    from rowguard.operators import keys as K
    path = run(spark, scratch, ["k"])
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert spark.read.parquet(path).select(Ss.BATCH).distinct().count() == 4
    for nulls_distinct in (True, False):
        assert Ss.duplicate_rows(spark, path, nulls_distinct).first().asDict() == K.duplicate_stats(df, ["k"], nulls_distinct).first().asDict()
    # a batch that is replayed replaces itself
    before = sorted(Ss.key_state(spark, path).collect(), key=str)
    first = spark.createDataFrame(ROWS[:2], SCHEMA)
    files = {r.batch_id: r.n for r in spark.read.parquet(path).groupBy(Ss.BATCH).agg(F.sum("n").alias("n")).collect()}
    replay = next(b for b in files if spark.read.parquet(f"{path}/{Ss.BATCH}={b}").where("k0 = 'a'").count())
    Ss.reduce_batch(first, ["k"]).write.mode("overwrite").parquet(f"{path}/{Ss.BATCH}={replay}")
    assert sorted(Ss.key_state(spark, path).collect(), key=str) == before
    Ss.compact(spark, path, f"{scratch}/compact")
    assert sorted(Ss.key_state(spark, f"{scratch}/compact").collect(), key=str) == before


def test_aggregate_bounds_over_a_stream_equal_batch(spark, scratch):
    path = run(spark, scratch, ["g"], ["x"])
    got = {(r.k0, r.kind): (r.value, r.ok) for r in Ss.aggregate_bounds(spark, path, [
        (0, "sum", 10, "max"), (0, "avg", 0, "min"), (0, "min", 0, "min"), (0, "max", 9, "max"), (0, "count", 1, "min")]).collect()}
    assert got[(2, "sum")] == (59.0, False) and got[(1, "sum")] == (4.0, True) and got[(1, "avg")] == (1.0, True)
    assert got[(1, "min")] == (-3.0, False) and got[(2, "max")] == (50.0, False) and got[(3, "sum")] == (None, True) and got[(3, "count")] == (1.0, True)


def test_state_without_keys_is_the_whole_frame(spark, scratch):
    path = run(spark, scratch, [], ["x"])
    row = Ss.key_state(spark, path).first()
    assert (row.n, row.n_0, row.sum_0, row.min_0, row.max_0) == (8, 6, 63.0, -3.0, 50.0)
