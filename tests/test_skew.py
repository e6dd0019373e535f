import random
from collections import Counter

import pytest
from conftest import values
from pyspark.sql import functions as F

from logweir.operators import skew


@pytest.fixture(scope="module")
def requests(spark):
    rng = random.Random(4)
    rows = []
    for i in range(3000):
        target = "t.5" if rng.random() < 0.5 else f"t.{rng.randrange(4)}"
        client = rng.choice([f"10.0.{rng.randrange(40)}.1", "nodots"])
        rows.append((i, target, client))
    df = spark.createDataFrame(rows, "seq int, target_ip string, client_ip string")
    return skew.client_prefixes(df, [f"t.{d}" for d in range(6)], keep=["seq"])


@pytest.mark.parametrize("stages", [(1,), (9,), (99,), (99, 9), (7, 5, 2)])
def test_salted_equals_plain(requests, stages):
    plain = values(skew.prefix_counts(requests))
    assert values(skew.salted_prefix_counts(requests, ["seq"], F.col("target_ip") == "t.5", stages)) == plain


def test_salted_sum_min_max(requests):
    aggs = {"s": ("sum", "seq"), "lo": ("min", "seq"), "hi": ("max", "seq"), "n": ("count", "seq")}
    got = skew.salted_agg(requests, ["target_ip"], aggs, ["seq"], F.lit(True))
    plain = requests.groupBy("target_ip").agg(
        F.sum("seq").alias("s"), F.min("seq").alias("lo"), F.max("seq").alias("hi"), F.count("seq").alias("n")
    )
    assert values(got) == values(plain)


@pytest.mark.parametrize("parts", [1, 4, 100])
def test_maps_hold_every_entry_once(requests, parts):
    counts = skew.prefix_counts(requests).withColumn("prefix", F.coalesce("prefix", F.lit("")))
    maps = skew.prefix_maps(counts, parts=parts)
    assert values(skew.merge_maps(maps)) == values(counts)
    again = maps.unionByName(maps)
    assert values(skew.merge_maps(again)) == values(counts.withColumn("n", F.col("n") * 2))
    assert parts > 1 or maps.count() == 5


def test_maps_are_as_many_as_their_entries_ask_for(requests):
    counts = skew.prefix_counts(requests).withColumn("prefix", F.coalesce("prefix", F.lit("")))
    maps = skew.prefix_maps(counts, max_entries=10)
    assert values(skew.merge_maps(maps)) == values(counts)
    entries = Counter(r.target_ip for r in counts.collect())
    assert {(r.target_ip, r.parts) for r in maps.collect()} == {(t, -(-n // 10)) for t, n in entries.items()}


def test_lists_hold_every_row_once(requests):
    lists = skew.prefix_lists(requests, "seq", parts=8).collect()
    assert {r.part for r in lists} == set(range(8))
    got = Counter((r.target_ip, p) for r in lists for p in r.prefixes)
    assert got == Counter((r.target_ip, r.prefix or "") for r in requests.collect())


def test_lists_are_as_many_as_their_rows_ask_for(requests):
    lists = skew.prefix_lists(requests, "seq", max_items=100).collect()
    got = Counter((r.target_ip, p) for r in lists for p in r.prefixes)
    assert got == Counter((r.target_ip, r.prefix or "") for r in requests.collect())
    rows = Counter(r.target_ip for r in requests.collect())
    assert {(r.target_ip, r.parts) for r in lists} == {(t, -(-n // 100)) for t, n in rows.items()}


def test_histogram_line(spark):
    maps = spark.createDataFrame([("t", {"a": 2})], "target_ip string, counts map<string,bigint>")
    assert skew.histogram_lines(maps).first().value == "(t,{a=2})"


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_join_paths_agree(spark, how):
    rng = random.Random(8)
    # One key with a third of the rows, a third of all rows without a key, and exact copies.
    left = spark.createDataFrame(
        [(i // 2, rng.choice(["hot", None, f"k{rng.randrange(50)}"])) for i in range(3000)], "seq int, k string"
    )
    right = spark.createDataFrame([("hot", "h")] + [(f"k{i}", f"v{i}") for i in range(0, 80, 2)], "k string, v string")
    join = lambda **o: values(skew.lookup_join(left, right, ["k"], how, **o))
    plain = values(left.join(right, "k", how).select(*(["seq", "k", "v"] if how in ("left", "inner") else ["seq", "k"])))
    assert join() == plain
    assert join(broadcast_bytes=0, rows_per_task=100, salt_by=["seq"]) == plain
    assert join(broadcast_bytes=0, rows_per_task=10**9) == plain


def test_hot_keys_are_split(spark):
    left = spark.range(1000).selectExpr("id", "if(id % 3 = 0, 'hot', concat('k', id)) k")
    hot = skew.hot_keys(left, ["k"], rows_per_task=100).collect()
    of_hot = left.where("k = 'hot'").select(F.xxhash64("k").alias("h")).first().h
    assert [(r._hash, r._salts) for r in hot] == [(of_hot, 4)]
    right = left.select("k").distinct().withColumn("v", F.lit(1))
    joined = skew.lookup_join(left, right, ["k"], broadcast_bytes=0, rows_per_task=100, salt_by=["id"])
    assert "_salt" in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.where("v = 1").count() == 1000


def test_salted_counts_find_their_hot_keys_by_a_sketch(requests, monkeypatch):
    found = skew.heavy_hitters(requests, ["target_ip"], 1000)
    top = requests.where("target_ip = 't.5'")
    assert found == [(top.select(F.xxhash64("target_ip").alias("h")).first().h, top.count())]
    monkeypatch.setattr(skew, "REPORTED_KEYS", 50)
    assert values(skew.salted_prefix_counts(requests, ["seq"])) == values(skew.prefix_counts(requests))
    assert skew.heavy_hitters(requests.limit(0), ["target_ip", "prefix"], 0) == []


def test_digit_placement(spark):
    keys = ["106.38.176.185", "106.38.176.117", "106.38.176.118", "106.38.176.116", "x"]
    placed = skew.place_by_digit(spark.createDataFrame([(k,) for k in keys], "k string"), "k", 4)
    got = {r.k: r.p for r in placed.select("k", F.spark_partition_id().alias("p")).collect()}
    assert got == dict(zip(keys, [1, 3, 0, 2, 0]))
