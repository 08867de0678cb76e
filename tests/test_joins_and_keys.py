from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.keys import with_kept_keys, with_surrogate_key
from ledgerloom.operators.quantile import exact_percentile
from ledgerloom.operators.skew import balanced_join, hot_keys, skew_join
from tests.conftest import values


def test_surrogate_keys_are_dense_and_depend_on_values_only(spark):
    names = [(f"N{i}", i % 7) for i in range(5000)]
    one = with_surrogate_key(spark.createDataFrame(names, "n string, g int").repartition(3), "Key", ["n"])
    random.Random(1).shuffle(names)
    two = with_surrogate_key(spark.createDataFrame(names, "n string, g int").repartition(11), "Key", ["n"])
    keys = sorted(r.Key for r in one.collect())
    assert keys == list(range(1, 5001))
    assert values(one, "n", "Key", "g") == values(two, "n", "Key", "g")


@pytest.fixture(scope="module")
def hot_data(spark):
    """A key with a third of all rows, many small keys, keys without partner, NULL keys."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(
        F.concat(F.lit("k"), F.col("id") % 400)
    )
    big = spark.range(60000).select(key.alias("k"), F.col("id").alias("row")).cache()
    small = spark.range(300).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v"))
    small = small.unionByName(spark.createDataFrame([("hot", -1), ("hot", -2)], "k string, v long"))
    return big, small


def test_skew_join_equals_plain_join(spark, hot_data):
    big, small = hot_data
    counts = big.groupBy("k").agg(F.count("*").alias("n"))
    hot = hot_keys(counts.where("k is not null"), ["k"], "n")
    for how in ("inner", "left"):
        joined = skew_join(big, small, ["k"], hot, ["row"], how)
        plain = big.join(small, "k", how)
        assert joined.select("k", "row", "v").exceptAll(plain.select("k", "row", "v")).count() == 0
        assert joined.count() == plain.count()


def test_skew_join_cuts_the_hot_key_into_many_tasks(spark, hot_data):
    big, small = hot_data
    counts = big.where("k is not null").groupBy("k").agg(F.count("*").alias("n"))
    hot = hot_keys(counts, ["k"], "n")
    assert hot.count() <= 1000
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew_join(big, small, ["k"], hot, ["row"])
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    # eight partitions; one of them would hold at least 40000 rows without the slices
    assert max(sizes) < 2 * sum(sizes) / 8


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_balanced_join_equals_plain_join(spark, hot_data, tmp_path, threshold):
    big, small = hot_data
    small.write.parquet(str(tmp_path / "s"))
    small = spark.read.parquet(str(tmp_path / "s"))
    counts = big.where("k is not null").groupBy("k").agg(F.count("*").alias("n"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for how in ("inner", "left"):
            joined = balanced_join(big, small, ["k"], counts, "n", ["row"], how)
            plain = big.join(small, "k", how)
            assert joined.count() == plain.count()
            assert joined.select("k", "row", "v").exceptAll(plain.select("k", "row", "v")).count() == 0
        some = balanced_join(big, small, ["k"], counts, "n", ["row"], condition=F.col("v") < 0)
        assert some.count() == 40000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_hot_key_is_cut_when_the_threshold_changes_later(spark, hot_data, tmp_path):
    big, small = hot_data
    small.write.parquet(str(tmp_path / "s"))
    counts = big.where("k is not null").groupBy("k").agg(F.count("*").alias("n"))
    joined = balanced_join(big, spark.read.parquet(str(tmp_path / "s")), ["k"], counts, "n", ["row"])
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert max(sizes) < 2 * sum(sizes) / 8


def test_skew_join_refuses_what_it_cannot_do(spark, hot_data):
    big, small = hot_data
    with pytest.raises(ValueError):
        skew_join(big, small, ["k"], big, ["row"], "full")
    with pytest.raises(ValueError):
        skew_join(big, small, ["k"], big, ["row"], "left", condition=F.lit(True))


@pytest.mark.parametrize("kind", ["uniform", "heavy_tail", "ties", "one_value", "two_rows"])
@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.99, 1.0])
def test_exact_percentile_equals_sorting(spark, kind, p):
    draw = random.Random(7)
    data = {
        "uniform": [draw.uniform(-5, 5) for _ in range(1501)],
        "heavy_tail": [draw.paretovariate(0.3) for _ in range(900)],
        "ties": [float(draw.choice([1, 1, 1, 2, 9])) for _ in range(800)],
        "one_value": [3.25] * 50,
        "two_rows": [1.0, 2.0],
    }[kind]
    frame = spark.createDataFrame([(x,) for x in data] + [(None,)], "x double")
    ordered = sorted(data)
    position = p * (len(ordered) - 1)
    low = int(position)
    high = min(low + 1, len(ordered) - 1)
    expected = ordered[low] + (ordered[high] - ordered[low]) * (position - low)
    assert exact_percentile(frame, "x", p) == pytest.approx(expected, rel=1e-12)


def test_percentile_of_nothing(spark):
    assert exact_percentile(spark.createDataFrame([(None,)], "x double"), "x", 0.5) is None


@pytest.mark.parametrize("odd", [float("inf"), float("-inf"), float("nan")])
def test_percentile_refuses_what_is_not_finite(spark, odd):
    with pytest.raises(ValueError):
        exact_percentile(spark.createDataFrame([(1.0,), (2.0,), (odd,)], "x double"), "x", 0.5)


def test_percentile_over_the_whole_range_of_doubles(spark):
    data = [-1.7e308, -5.0, 0.0, 3e-308, 1.7e308]
    assert exact_percentile(spark.createDataFrame([(x,) for x in data], "x double"), "x", 0.5) == 0.0


def test_kept_keys(spark):
    before = with_surrogate_key(spark.createDataFrame([("a",), ("b",)], "n string"), "Key", ["n"])
    after = with_kept_keys(spark.createDataFrame([("b", 1), ("c", 2), ("d", 3)], "n string, g int"), before, "Key", ["n"])
    known = dict(values(before, "n", "Key"))
    got = dict(values(after, "n", "Key"))
    assert got["b"] == known["b"] and sorted([got["c"], got["d"]]) == [3, 4]
