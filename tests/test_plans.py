"""Plan shape: no single-partition window, fused scans,
pushdown and pruning reach the parquet reader."""

import datetime as dt

import rowguard as rg
from rowguard.operators import metrics as M
from rowguard.plans import scan as S

SF = "/root/testdata/sf0.001"


def plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_annotate_has_no_window_and_no_single_partition(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    sup = spark.read.parquet(f"{SF}/supplier.parquet")
    rules = [rg.Rule("u", rg.Unique(["l_orderkey", "l_linenumber"])),
             rg.Rule("fk", rg.ForeignKey(["l_suppkey"], sup, ["s_suppkey"])),
             rg.Rule("avg", rg.AggregateBound("l_quantity", "avg", 10, "min"))]
    p = plan(rg.annotate(li, rules))
    main = p.split("Subquery")[0]
    assert "Window" not in p
    assert "SinglePartition" not in main          # only the one-row subquery gathers
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_fused_metrics_scan_once(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    checks = [S.missing_count("a", "l_shipdate"), S.invalid_count("b", "l_returnflag", values=["A", "N"]),
              S.row_count("c", where="l_quantity > 45"), S.expression_metric("d", "AVG(l_tax)"),
              S.freshness("e", "l_shipdate", dt.datetime(2002, 1, 1), 10)]
    p = plan(M.evaluate(li, checks))
    assert p.count("FileScan parquet") == 1


def test_filter_and_columns_pushed_to_scan(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    rules = [rg.Rule("q", rg.NotGreaterThan("l_quantity", 45))]
    out = rg.annotate(li, rules).where("l_returnflag = 'R'").select("l_orderkey", "_errors")
    p = plan(out)
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string>" in p


def test_samples_are_bounded_per_task(spark):
    from rowguard.operators.samples import samples
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    sup = spark.read.parquet(f"{SF}/supplier.parquet")
    checks = [S.row_count("all", where="true"), S.missing_count("m", "l_shipdate"),
              S.reference("r", ["l_suppkey"], sup, ["s_suppkey"])]
    p = plan(samples(li, checks, limit=3, order_by=["l_orderkey"]))
    # row-condition checks: one scan, partial group limit before the shuffle
    assert "WindowGroupLimit" in p and "Partial" in p
    # other checks: ordered top-n
    assert "TakeOrderedAndProject" in p
