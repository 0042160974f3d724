"""DST-1/4/5/6 row-marking checks: null keys, composite keys, groups."""

from pyspark.sql import functions as F

import rowguard as rg

FACT = "k1 bigint, k2 string, v double, g string"
ROWS = [
    (1, "a", 10.0, "x"), (1, "a", 20.0, "x"), (2, "b", 30.0, "x"),
    (None, "a", 40.0, "y"), (None, "a", 50.0, "y"), (3, None, 60.0, "y"), (3, None, 70.0, "y"),
]


def flagged(ann, arr="_errors"):
    return sorted(r.v for r in ann.where(F.size(arr) > 0).select("v").collect())


def test_unique_null_keys_are_distinct(spark):
    df = spark.createDataFrame(ROWS, FACT)
    ann = rg.annotate(df, [rg.Rule("u", rg.Unique(["k1", "k2"]))])
    assert flagged(ann) == [10.0, 20.0]


def test_unique_nulls_equal(spark):
    df = spark.createDataFrame(ROWS, FACT)
    ann = rg.annotate(df, [rg.Rule("u", rg.Unique(["k1", "k2"], nulls_distinct=False))])
    assert flagged(ann) == [10.0, 20.0, 40.0, 50.0, 60.0, 70.0]


def test_unique_marks_whole_hot_group(spark):
    hot = [(1, "h", float(i), "x") for i in range(300)] + [(2, "c", 1000.0, "x")]
    df = spark.createDataFrame(hot, FACT).repartition(8)
    ann = rg.annotate(df, [rg.Rule("u", rg.Unique(["k1", "k2"]))])
    assert ann.where(F.size("_errors") > 0).count() == 300
    assert ann.count() == 301


def test_foreign_key_null_keys_skipped_and_composite(spark):
    df = spark.createDataFrame(ROWS, FACT)
    ref = spark.createDataFrame([(1, "a"), (1, "a"), (3, "z")], "r1 bigint, r2 string")
    ann = rg.annotate(df, [rg.Rule("fk", rg.ForeignKey(["k1", "k2"], ref, ["r1", "r2"]))])
    # (2,'b') unmatched; null-part keys skipped; duplicate ref keys do not multiply rows
    assert flagged(ann) == [30.0]
    assert ann.count() == len(ROWS)


def test_foreign_key_by_table_name(spark):
    df = spark.createDataFrame(ROWS, FACT)
    spark.createDataFrame([(1,), (2,)], "code bigint").createOrReplaceTempView("rg_codes")
    ann = rg.annotate(df, [rg.Rule("fk", rg.ForeignKey(["k1"], "rg_codes", ["code"]))])
    assert flagged(ann) == [60.0, 70.0]


def test_aggregate_bound_marks_all_rows(spark):
    df = spark.createDataFrame(ROWS, FACT)
    rules = [rg.Rule("lo", rg.AggregateBound("v", "avg", 41, "min")),
             rg.Rule("hi", rg.AggregateBound("v", "avg", 39, "max"), criticality="warn"),
             rg.Rule("ok", rg.AggregateBound("v", "max", 70, "max"))]
    ann = rg.annotate(df, rules)
    assert flagged(ann) == [10.0, 20.0, 30.0, 40.0, 50.0, 60.0, 70.0]
    assert len(flagged(ann, "_warnings")) == 7
    names = {r.n for r in ann.select(F.explode(F.col("_errors.name")).alias("n")).collect()}
    assert names == {"lo"}


def test_aggregate_bound_by_group(spark):
    df = spark.createDataFrame(ROWS, FACT)
    rule = rg.Rule("g", rg.AggregateBound("v", "sum", 100, "max", group_by=("g",)))
    # group x sums 60, group y sums 220
    assert flagged(rg.annotate(df, [rule])) == [40.0, 50.0, 60.0, 70.0]


def test_aggregate_bound_sql_expression(spark):
    df = spark.createDataFrame(ROWS, FACT)
    rule = rg.Rule("e", rg.AggregateBound(F.expr("v / 10"), "max", 6, "max"))
    assert len(flagged(rg.annotate(df, [rule]))) == 7


def test_a_string_is_a_column_name_never_sql(spark):
    df = spark.createDataFrame([(1, 5, 1), (2, 5, 1)], "`dep-delay` int, dep int, delay int")
    rule = rg.Rule("m", rg.AggregateBound("dep-delay", "min", 1, "min"))
    assert rg.annotate(df, [rule]).where("size(_errors) > 0").count() == 0


def test_messages_name_all_parameters():
    assert "'v10'" in rg.InList("s", [f"v{i}" for i in range(11)]).describe()


def test_hot_keys_are_salted_with_same_result(spark):
    """A key holding most rows is split into buckets; marks are unchanged."""
    hot = [(1, "h", float(i), "x") for i in range(300)] + [(2, "c", 1000.0, "y"), (2, "c", 1001.0, "y")]
    df = spark.createDataFrame(hot, FACT).repartition(8)
    ref = spark.createDataFrame([(2,)], "r bigint")
    for h in (10, 1_000_000):
        rules = [rg.Rule("u", rg.Unique(["k1", "k2"], hot_key_rows=h)),
                 rg.Rule("fk", rg.ForeignKey(["k1"], ref, ["r"], hot_key_rows=h, aggregate_keys=True), criticality="warn"),
                 rg.Rule("fk_small", rg.ForeignKey(["k1"], ref, ["r"]), criticality="warn"),
                 rg.Rule("g", rg.AggregateBound("v", "count", 5, "max", group_by=("g",), hot_key_rows=h))]
        ann = rg.annotate(df, rules)
        assert ann.count() == 302
        res = {r.name: r.failed_rows for r in rg.check_results(ann, rules).collect()}
        assert res == {"u": 302, "fk": 300, "fk_small": 300, "g": 300}, h
    plan = ann._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode(sequence(0" in plan


def test_hot_keys_are_dealt_by_place_and_any_column_type_works(spark):
    from rowguard.operators import keys as K
    df = spark.range(0, 1000, 1, 4).selectExpr("7 AS k", "'same' AS s", "map('a', 1) AS m", "named_struct('x', array(1)) AS st", "parse_json('{\"a\": 1}') AS v")
    dups = K.duplicate_keys(df, ["k"], ["key"], "n")
    plan = {}
    kept = K.F.pmod
    K.F.pmod = lambda place, buckets: plan.setdefault("deal", kept(place, buckets))
    try:
        marked = K.mark_keys(df, ["k"], dups, ["key"], "n", "dup", hot_key_rows=10)
        buckets = df.withColumn("dup_at", F.monotonically_increasing_id()).withColumn("dup_hb", F.lit(100)).select(plan["deal"].alias("b"))
    finally:
        K.F.pmod = kept
    assert marked.where("dup").count() == 1000 and marked.columns == [*df.columns, "dup"]
    per = [r["count"] for r in buckets.groupBy("b").count().collect()]
    assert len(per) == 100 and max(per) <= 20
    rules = [rg.Rule("u", rg.Unique(["k"])), rg.Rule("g", rg.AggregateBound("k", "count", 10, "max", group_by=("s",))),
             rg.Rule("f", rg.ForeignKey(["k"], spark.range(3), ["id"], aggregate_keys=True))]
    assert {r.name: r.failed_rows for r in rg.check_results(rg.annotate(df, rules), rules).collect()} == {"u": 1000, "g": 1000, "f": 1000}


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_key_sets_share_one_scan_and_equal_their_own_statistics(spark):
    from rowguard.operators import keys as K
    df = spark.createDataFrame(ROWS + [(1, "a", None, None), (None, None, 1.0, "x"), (None, None, 1.0, "x")], FACT)
    sets = [(["k1"], True), (["k1", "k2"], True), (["k1", "k2"], False), (["k2", "k1"], False), (["g"], True), (["v", "g"], False)]
    got = K.duplicate_stats_of(df, sets)
    row = got.first().asDict()
    for i, (columns, nulls_distinct) in enumerate(sets):
        want = K.duplicate_stats(df, columns, nulls_distinct).first().asDict()
        assert {k: row[f"{k}_{i}"] for k in want} == want, columns
    empty = K.duplicate_stats_of(df.limit(0), sets).first().asDict()
    assert set(empty.values()) == {0}
    assert plan_of(K.duplicate_stats_of(spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet"), [(["l_orderkey"], True), (["l_partkey"], True)])).count("Relation") == 1


def test_duplicate_checks_of_a_frame_are_one_frame(spark):
    from rowguard.operators import metrics as M
    from rowguard.plans import scan as S
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    checks = [S.duplicate_percent("texts", ["text"]), S.duplicate_percent("ids", ["doc_id"]), S.duplicate_percent("both", ["doc_id", "text"])]
    out = M.evaluate(df, checks)
    assert plan_of(out).count("Relation") == 1
    alone = [r for c in checks for r in M.evaluate(df, [c]).collect()]
    assert sorted(out.collect()) == sorted(alone)
    wrong = M.evaluate(df, [*checks, S.duplicate_percent("nowhere", ["no_such"])]).collect()
    assert {r.check: r.outcome for r in wrong} == {"texts": "pass", "ids": "pass", "both": "pass", "nowhere": "error"}


def test_value_sets_of_a_frame_share_one_scan(spark):
    from rowguard.operators import metrics as M
    from rowguard.plans import expectations as E
    df = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (2, None, 3.0), (9, "zz", 3.0), (9, "b", float("nan"))], "k int, s string, x double")
    checks = [E.expect_distinct_values_in_set("k", [1, 2], name="k"), E.expect_distinct_values_in_set("s", ["a"], name="s"),
              E.expect_distinct_values_in_set("x", [1.0], name="x"), E.expect_distinct_values_in_set("s", ["a", "b", "zz"], name="all")]
    got = {r.check: (r.value, r.failed_rows, r.considered_rows, r.row_count, r.success) for r in E.validate(df, checks).collect()}
    assert got == {"k": (1.0, 2, 5, 5, False), "s": (2.0, 3, 4, 5, False), "x": (2.0, 3, 4, 5, False), "all": (0.0, 0, 4, 5, True)}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert plan_of(M.evaluate(docs, [E.expect_distinct_values_in_set("lang", ["en"], name="a"), E.expect_distinct_values_in_set("source", ["x"], name="b")])).count("Relation") == 1


def test_bitmap_index_equals_the_plain_foreign_key(spark):
    import pytest
    keys = [0, 1, -1, 32767, 32768, 32769, -32767, -32768, -32769, 65536, 7, 8, 9, 2**62, -2**63, 2**63 - 1, None]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").withColumn("i", F.col("k") % 100)
    ref = spark.createDataFrame([(k,) for k in keys[::2] * 3 + [None]], "r bigint")
    plain = [rg.Rule("f", rg.ForeignKey(["k"], ref, ["r"]))]
    packed = [rg.Rule("f", rg.ForeignKey(["k"], ref, ["r"], bitmap=True))]
    rows = lambda rules: sorted(rg.annotate(df, rules).where("size(_errors) > 0").select("k").collect())
    assert rows(packed) == rows(plain) and 0 < len(rows(plain)) < len(keys)
    assert rows([rg.Rule("f", rg.ForeignKey(["k"], ref.limit(0), ["r"], bitmap=True))]) == sorted(df.where("k IS NOT NULL").select("k").collect())
    from rowguard.operators import keys as K
    assert K.bitmap_index(spark.range(100_000), "id").count() == 5  # ids 1..32768 are the second bucket
    with pytest.raises(ValueError, match="integral"):
        rg.annotate(df, [rg.Rule("f", rg.ForeignKey(["k"], spark.createDataFrame([("a",)], "r string"), ["r"], bitmap=True))])


def test_uniqueness_rules_share_their_scan_and_shuffle(spark, scratch):
    df = spark.createDataFrame(ROWS + [(1, "a", None, None), (None, None, 1.0, "x"), (None, None, 1.0, "x")], FACT)
    sets = [(("k1",), True), (("k1", "k2"), True), (("k1", "k2"), False), (("g",), True), (("k1",), True)]
    rules = [rg.Rule(f"u{i}", rg.Unique(c, nulls_distinct=n)) for i, (c, n) in enumerate(sets)]
    together = rg.annotate(df, rules)
    assert together.columns == [*df.columns, "_errors", "_warnings"]
    names = lambda a: sorted((tuple(r)[:-2], [e.name for e in r._errors]) for r in a.collect())
    got = names(together.na.fill(-1.0, ["v"]).na.fill(-1, ["k1"]).na.fill("-", ["k2", "g"]))
    for i, rule in enumerate(rules):
        alone = names(rg.annotate(df, [rule]).na.fill(-1.0, ["v"]).na.fill(-1, ["k1"]).na.fill("-", ["k2", "g"]))
        assert [bool(e) for _, e in alone] == [rule.name in e for _, e in got], rule.name
    hot = [rg.Rule(f"h{i}", rg.Unique(c, nulls_distinct=n, hot_key_rows=1)) for i, (c, n) in enumerate(sets)]
    assert {r.name: r.failed_rows for r in rg.check_results(rg.annotate(df, hot), hot).collect()} == {
        f"h{i}": r.failed_rows for i, r in enumerate(sorted(rg.check_results(together, rules).collect(), key=lambda r: r.pos))}
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    many = [rg.Rule("a", rg.Unique(["l_orderkey", "l_linenumber"])), rg.Rule("b", rg.Unique(["l_partkey", "l_suppkey"])), rg.Rule("c", rg.Unique(["l_shipdate"]))]
    out = rg.annotate(li, many)
    out.write.format("noop").mode("overwrite").save()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = rg.annotate(li, many)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Generate inline") == 1 and "ReusedExchange" in plan and plan.count("FileScan") == 2
