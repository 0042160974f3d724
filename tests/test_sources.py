"""Sources and sinks (SRC-1..9, SNK-1..3)."""

import pytest
from pyspark.sql import functions as F

import rowguard as rg
from rowguard.sources import readers as R
from rowguard.sources import writers as W
from rowguard.functions import STATE_CODES, TAIL_NUMBER_PATTERN, ELEVEN_YEARS_MINUTES

CSV = "N-NUMBER,NAME,YEAR\n123AB, one ,2001\n  77 ,two,2002\nbroken line with,too,many,fields\n9Z,three,notanumber\n"


def write_csv(folder):
    path = f"{folder}/master.txt"
    with open(path, "w") as f:
        f.write(CSV)
    return path


def test_csv_modes(spark, scratch):
    path = write_csv(scratch)
    schema = "`N-NUMBER` string, NAME string, YEAR int"
    assert R.read_csv(spark, path, schema).count() == 4                       # permissive keeps all
    assert R.read_csv(spark, path, schema, drop_malformed=True).count() == 2  # bad lines skipped
    kept = R.read_csv(spark, path, schema, corrupt_column="_bad")
    assert kept.where(F.col("_bad").isNotNull()).count() == 2
    inferred = R.read_csv(spark, path)
    assert "N-NUMBER" in inferred.columns


def test_reference_key_set_union_distinct_trim(spark, scratch):
    path = write_csv(scratch)
    master = R.read_csv(spark, path, "`N-NUMBER` string, NAME string, YEAR int", drop_malformed=True)
    dereg = spark.createDataFrame([("77",), ("5",)], "`N-NUMBER` string")
    keys = R.reference_key_set([(master, "N-NUMBER"), (dereg, "N-NUMBER")], prefix="N", name="FaaTailNum")
    assert sorted(r.FaaTailNum for r in keys.collect()) == ["N123AB", "N5", "N77"]


def test_literal_frame_catalog_and_views(spark):
    t = R.literal_frame(spark, [("Flight duplicates", 10)], "name string, pass_threshold_percentage int")
    assert t.schema["pass_threshold_percentage"].dataType.typeName() == "integer"
    cat = R.Catalog(spark, {"airline_id": lambda s: s.createDataFrame([(19805,)], "Code bigint")})
    cat.register("airline_id")
    assert spark.table("airline_id").count() == 1 and cat.names() == ["airline_id"]
    assert R.read_table(spark, "airline_id").first().Code == 19805


def test_jdbc_options_validated(spark):
    with pytest.raises(ValueError):
        R.read_jdbc(spark, "jdbc:none://x", "t", {}, partition_column="id")


def test_save_split_and_tables(spark, scratch):
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    ann = rg.annotate(df, [rg.Rule("big", rg.NotGreaterThan("v", 10))])
    W.save_split(ann, f"{scratch}/valid", f"{scratch}/quarantine", as_tables=False)
    assert spark.read.parquet(f"{scratch}/valid").count() == 6
    assert spark.read.parquet(f"{scratch}/quarantine").count() == 4


def test_fixed_values():
    assert len(STATE_CODES) == 57 and len(set(STATE_CODES)) == 57
    assert ELEVEN_YEARS_MINUTES == 5_781_600
    import re
    assert re.match(TAIL_NUMBER_PATTERN, "N123AB") and not re.match(TAIL_NUMBER_PATTERN, "N4YBAA")


def test_save_table_ignore_and_overwrite(spark):
    name = "rg_test_table_modes"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    W.save_table(spark.range(3), name, mode="ignore")
    W.save_table(spark.range(10), name, mode="ignore")        # exists: left as is
    assert spark.table(name).count() == 3
    W.save_table(spark.range(5), name, mode="overwrite")
    assert spark.table(name).count() == 5
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_save_split_as_tables(spark):
    ann = rg.annotate(spark.range(10), [rg.Rule("big", rg.NotGreaterThan("id", 6))])
    for t in ("rg_valid_t", "rg_bad_t"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    W.save_split(ann, "rg_valid_t", "rg_bad_t")
    assert spark.table("rg_valid_t").count() == 7 and spark.table("rg_bad_t").count() == 3
    for t in ("rg_valid_t", "rg_bad_t"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_catalog_parquet_dir(spark):
    cat = R.Catalog.parquet_dir(spark, "/root/testdata/sf0.001", ["nation", "region"])
    assert cat["nation"].count() == 25 and cat["region"].count() == 5


def test_partitioned_split_one_pass(spark, scratch):
    ann = rg.annotate(spark.range(10), [rg.Rule("big", rg.NotGreaterThan("id", 6)),
                                        rg.Rule("odd", rg.Satisfies("id % 2 = 1"), criticality="warn")])
    W.save_partitioned_split(ann, f"{scratch}/split")
    valid, bad = W.read_split(spark, f"{scratch}/split")
    assert sorted(r.id for r in valid.collect()) == [0, 2, 4, 6]
    assert bad.count() == 6 and "_dq_status" not in valid.columns


def test_a_dimension_that_repeats_a_key_does_not_multiply_facts(spark):
    dim = spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (None, "z"), (2, "c")], "k int, v string")
    one = R.one_per_key(dim, ["k"], ["v"])
    assert sorted(one.collect(), key=str) == [(1, "a"), (2, None)]
    facts = spark.createDataFrame([(1,), (1,), (3,), (None,)], "k int")
    assert facts.join(one, "k", "left").count() == 4
    two = R.one_per_key(dim.selectExpr("k", "v AS w", "1 AS x"), ["k", "x"], ["w"])
    assert two.columns == ["k", "x", "w"] and two.count() == 2


def test_malformed_lines_are_skipped_alike_for_every_projection(spark, scratch):
    lines = ["a,b,c", "1,2,3", "4,5,x,y,z", "6,7", "8,9,10"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{scratch}/csv")
    df = R.read_csv(spark, f"{scratch}/csv", drop_malformed=True)
    whole = [r.a for r in df.collect()]
    assert sorted(r.a for r in df.select("a").collect()) == sorted(whole) and df.count() == len(whole) and {1, 8} <= set(whole) and 4 not in whole


def test_named_tables_take_partition_options(spark, monkeypatch):
    import pytest
    seen = {}
    monkeypatch.setattr(R, "read_jdbc", lambda s, url, t, properties, **options: seen.update({t: options}) or s.range(1))
    options = {"partition_column": "id", "lower_bound": 0, "upper_bound": 100, "num_partitions": 4}
    cat = R.Catalog.jdbc(spark, "jdbc:x", ["a", "b"], {}, {"a": options})
    cat["a"], cat["b"]
    assert seen == {"a": options, "b": {}}
    with pytest.raises(ValueError, match="unknown"):
        R.Catalog.jdbc(spark, "jdbc:x", ["a"], {}, {"c": options})
