import pytest
from pyspark.sql import functions as F

from helpers import multiset
from tidemark.contract import ContractError
from tidemark.operators.merge import merge_incremental


def frame(spark, rows, ddl="k string, v int, hour int"):
    return spark.createDataFrame(rows, ddl)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_update_insert_keep(spark):
    target = frame(spark, [("a", 1, 5), ("b", 2, 5), ("c", 3, 1)])
    updates = frame(spark, [("b", 20, 6), ("d", 40, 6)])
    assert rows(merge_incremental(target, updates, "k")) == [("a", 1, 5), ("b", 20, 6), ("c", 3, 1), ("d", 40, 6)]


def test_rows_outside_the_filter_cannot_match(spark):
    target = frame(spark, [("a", 1, 1), ("b", 2, 9), ("n", 3, None)])
    updates = frame(spark, [("a", 10, 9), ("b", 20, 9), ("n", 30, 9)])
    got = rows(merge_incremental(target, updates, "k", F.col("hour") >= 5))
    assert got == sorted([("a", 1, 1), ("a", 10, 9), ("b", 20, 9), ("n", 3, None), ("n", 30, 9)], key=repr)


def test_null_keys_never_match(spark):
    target = frame(spark, [(None, 1, 5)])
    updates = frame(spark, [(None, 2, 5)])
    assert rows(merge_incremental(target, updates, "k")) == [(None, 1, 5), (None, 2, 5)]


def test_repeated_update_keys_fail_only_when_they_match(spark):
    updates = frame(spark, [("a", 10, 5), ("a", 11, 5)])
    assert rows(merge_incremental(frame(spark, [("b", 1, 5)]), updates, "k")) == [("a", 10, 5), ("a", 11, 5), ("b", 1, 5)]
    with pytest.raises(Exception, match="several update rows match one target row, k = a"):
        merge_incremental(frame(spark, [("a", 1, 5)]), updates, "k").collect()


def test_new_columns_are_appended(spark):
    target = frame(spark, [("a", 1, 5), ("b", 2, 1)])
    updates = frame(spark, [("a", "x", 10, 5)], "k string, note string, v int, hour int")
    got = merge_incremental(target, updates, "k", F.col("hour") >= 5)
    assert got.columns == ["k", "v", "hour", "note"]
    assert rows(got) == [("a", 10, 5, "x"), ("b", 2, 1, None)]


def test_columns_missing_from_updates_become_null(spark):
    target = frame(spark, [("a", 1, 5), ("b", 2, 5)])
    updates = frame(spark, [("a", 5)], "k string, hour int")
    assert rows(merge_incremental(target, updates, "k")) == [("a", None, 5), ("b", 2, 5)]


def test_changed_type_is_refused(spark):
    with pytest.raises(ContractError):
        merge_incremental(frame(spark, []), frame(spark, [], "k string, v string, hour int"), "k")


def test_hot_target_key(spark):
    target = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").cast("int").alias("v"),
        F.lit(5).alias("hour"),
    )
    updates = frame(spark, [("hot", -1, 5)])
    merged = merge_incremental(target, updates, "k")
    assert merged.count() == 3000
    assert multiset(merged.where("k = 'hot'"), ["v"]) == ["(-1,)"] * 1000
