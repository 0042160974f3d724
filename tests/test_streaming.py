"""EXT-1: row checks and split on a file stream equal the batch result."""

import pytest
from pyspark.sql import functions as F

import rowguard as rg
from rowguard.plans.scan import missing_count, row_count
from rowguard.streaming import annotate_stream, metrics_stream, quarantine_stream

SF = "/root/testdata/sf0.001"


def rules(spark):
    sup = spark.read.parquet(f"{SF}/supplier.parquet").where("s_acctbal > 0")
    return [rg.Rule("q", rg.NotGreaterThan("l_quantity", 45)),
            rg.Rule("fk", rg.ForeignKey(["l_suppkey"], sup, ["s_suppkey"])),
            rg.Rule("tax", rg.NotGreaterThan("l_tax", F.col("l_discount")), criticality="warn")]


def test_quarantine_stream_matches_batch(spark, scratch):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    src = f"{scratch}/src"
    li.repartition(3).write.parquet(src)
    stream = spark.readStream.schema(li.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = quarantine_stream(stream, rules(spark), f"{scratch}/valid", f"{scratch}/bad", f"{scratch}/ckpt",
                          available_now=True)
    q.awaitTermination(120)
    valid, bad = rg.split(rg.annotate(li, rules(spark)))
    assert spark.read.parquet(f"{scratch}/valid").count() == valid.count()
    assert spark.read.parquet(f"{scratch}/bad").count() == bad.count()


def test_metrics_stream_per_batch(spark, scratch):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    src = f"{scratch}/src"
    li.repartition(2).write.parquet(src)
    stream = spark.readStream.schema(li.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = metrics_stream(stream, [row_count("rows"), missing_count("m", "l_shipdate")], f"{scratch}/res",
                       f"{scratch}/ckpt", available_now=True)
    q.awaitTermination(120)
    res = spark.read.parquet(f"{scratch}/res")
    total = res.where("check = 'rows'").agg(F.sum("value")).first()[0]
    assert total == li.count()
    assert res.select("batch_id").distinct().count() >= 1


def test_whole_dataset_checks_rejected_on_streams(spark, scratch):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    stream = spark.readStream.schema(li.schema).parquet(f"{SF}/lineitem.parquet")
    with pytest.raises(ValueError):
        annotate_stream(stream, [rg.Rule("u", rg.Unique(["l_orderkey"]))])
