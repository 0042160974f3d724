"""SURVEY 5.2 identities on the sf0.001 tables: the row-marking form and the
metric form of the same check agree; split is a partition of the input."""

import datetime as dt

from pyspark.sql import functions as F

import rowguard as rg
from rowguard.operators import metrics as M
from rowguard.plans import scan as S

SF = "/root/testdata/sf0.001"


def test_marks_equal_metrics(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    sup = spark.read.parquet(f"{SF}/supplier.parquet").where("s_acctbal > 0")
    rules = [rg.Rule("fk", rg.ForeignKey(["l_suppkey"], sup, ["s_suppkey"])),
             rg.Rule("dup", rg.Unique(["l_orderkey", "l_linenumber"])),
             rg.Rule("qty", rg.NotGreaterThan("l_quantity", 45)),
             rg.Rule("fresh", rg.Fresh("l_shipdate", 6 * 365 * 24 * 60, as_of=dt.datetime(2001, 12, 31)))]
    marks = {r.name: r.failed_rows for r in rg.check_results(rg.annotate(li, rules), rules).collect()}
    metrics = {r.check: r.failed_rows for r in M.evaluate(li, [
        S.reference("fk", ["l_suppkey"], sup, ["s_suppkey"]),
        S.duplicate_percent("dup", ["l_orderkey", "l_linenumber"]),
        S.row_count("qty", where="l_quantity > 45"),
        S.row_count("fresh", where=F.col("l_shipdate") < F.lit("1996-01-02").cast("timestamp_ntz")),
    ]).collect()}
    assert marks == metrics
    assert sum(marks.values()) > 0


def test_split_partitions_input(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet").withColumn("rid", F.monotonically_increasing_id())
    rules = [rg.Rule("qty", rg.NotGreaterThan("l_quantity", 45)),
             rg.Rule("tax", rg.NotGreaterThan("l_tax", F.col("l_discount")), criticality="warn")]
    ann = rg.annotate(li, rules)
    valid, bad = rg.split(ann)
    keys = ["rid"]
    assert valid.count() + bad.count() == li.count()
    assert valid.select(*keys).intersect(bad.select(*keys)).count() == 0
    s = rg.summary(ann).first()
    assert s.valid_row_count == valid.count()
