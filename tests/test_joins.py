"""Skew-proof shapes give the rows of the plain shapes, also when keys are hot."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from huntspark.plans.joins import expand_left_join, hot_keys, lookup_join, split_hot_join
from huntspark.plans.lineage_cut import cut, shared_folder
from huntspark.plans.numbering import first_per_key, number_within


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows have one key, some have none."""
    many = spark.range(3000).selectExpr(
        "id", "case when id % 3 = 0 then 'hot' when id % 10 = 1 then null else 'k'||(id % 100) end as k"
    )
    few = spark.createDataFrame([("hot", 1), ("hot", 2), ("k5", 3), ("zzz", 4), (None, 5)], "fk string, n int")
    return many, few


def test_hot_keys_are_found_and_bounded(spark, skewed):
    many, _ = skewed
    found = hot_keys(many, ["k"], hot_rows=500)
    assert found == [spark.sql("select xxhash64('hot') h").first().h]
    assert hot_keys(many, ["k"], hot_rows=10_000) == []


@pytest.mark.parametrize("hot_rows", [100, 10_000_000])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_split_hot_join_equals_join(skewed, hot_rows, how):
    many, few = skewed
    got = split_hot_join(many, few, [("k", "fk")], how, hot_rows=hot_rows, salts=8)
    assert rows(got) == rows(many.join(few, many.k == few.fk, how))


def test_split_hot_join_spreads_the_hot_key(skewed):
    many, few = skewed
    plan = split_hot_join(many, few, [("k", "fk")], hot_rows=100, salts=8)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "__many_part" in text and "__few_part" in text


def test_known_bound_skips_the_search(skewed):
    many, few = skewed
    text = split_hot_join(many, few, [("k", "fk")], at_most=10)._jdf.queryExecution().optimizedPlan().toString()
    assert "__many_part" not in text


def test_identical_hot_rows_are_kept(spark):
    many = spark.createDataFrame([("a",)] * 50, "k string")
    few = spark.createDataFrame([("a", 1)], "fk string, n int")
    assert split_hot_join(many, few, [("k", "fk")], hot_rows=10).count() == 50


@pytest.mark.parametrize("hot_rows", [100, 10_000_000])
def test_expand_left_join_equals_left_join(skewed, hot_rows):
    many, few = skewed
    got = expand_left_join(few, many, [("fk", "k")], hot_rows=hot_rows, salts=8)
    assert rows(got, "fk", "n", "id") == rows(few.join(many, few.fk == many.k, "left"), "fk", "n", "id")


def test_lookup_join_keeps_rows_without_key(skewed):
    many, few = skewed
    assert rows(lookup_join(many, few, [("k", "fk")])) == rows(many.join(few, many.k == few.fk, "left"))


def test_lookup_join_two_keys(spark):
    left = spark.createDataFrame([("a", "x"), ("a", None), (None, "x"), ("b", "y")], "k string, t string")
    right = spark.createDataFrame([("a", "x", 1), ("b", "x", 2)], "rk string, rt string, n int")
    got = lookup_join(left, right, [("k", "rk"), ("t", "rt")])
    assert rows(got, "k", "t", "n") == sorted(
        [("a", "x", 1), ("a", None, None), (None, "x", None), ("b", "y", None)], key=repr
    )


def test_number_within_is_a_dense_numbering(spark):
    df = spark.range(2000).selectExpr("if(id % 3 > 0, 'big', 't'||(id % 30)) as g", "'r'||id as id")
    got = [r.asDict() for r in number_within(df, "g", "id", "n", digits=2).collect()]
    groups = {}
    for r in got:
        groups.setdefault(r["g"], []).append(r["n"])
    assert len(got) == 2000
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in groups.values())


def test_first_per_key(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, None)], "k string, o int, v string")
    assert rows(first_per_key(df, ["k"], ["o"])) == [("a", 1, "y"), ("b", 5, None)]


def test_cut_writes_to_the_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark)
    assert named is None or named in folder
    df = cut(spark.range(10).withColumn("x", F.col("id") * 2))
    assert df.count() == 10 and "Range" not in df._jdf.queryExecution().optimizedPlan().toString()
