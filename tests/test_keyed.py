from conftest import values

from logweir.operators import keyed


def test_latest_row_wins_and_is_reduced_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, "q")], "id string, seq int, v string")
    latest = keyed.latest_rows(df, ["id"], ["seq"])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle
    assert values(latest) == [("a", 3, "z"), ("b", 1, "q")]


def test_sets(spark):
    pairs = "key string, member string"
    old = spark.createDataFrame([("s", "a"), ("s", "b"), ("t", "x")], pairs)
    new = spark.createDataFrame([("s", "b"), ("s", "c"), ("s", "c"), ("t", "x")], pairs)
    inserted = keyed.set_insert(old, new)
    assert values(inserted) == [("s", "a", False), ("s", "b", False), ("s", "c", True), ("t", "x", False)]
    assert values(keyed.inserted_keys(inserted)) == [("s", 1, True), ("t", 0, False)]
    assert values(keyed.members_of(new, ["s"])) == [("s", "b"), ("s", "c")]
    wanted = spark.createDataFrame([("t",), ("t",)], "key string")
    assert values(keyed.set_members(new, wanted)) == [("t", "x")]


def test_deletes(spark):
    df = spark.createDataFrame([("a", "f", 1), ("a", "g", 2), ("b", "f", 3)], "key string, field string, v int")
    assert values(keyed.delete_keys(df, spark.createDataFrame([("a",)], "key string"))) == [("b", "f", 3)]
    gone = spark.createDataFrame([("a", "g"), ("b", "zz")], "key string, field string")
    assert values(keyed.delete_fields(df, gone)) == [("a", "f", 1), ("b", "f", 3)]
    maps = spark.createDataFrame([("a", {"f": 1, "g": 2})], "key string, h map<string,int>")
    assert keyed.drop_map_fields(maps, "h", ["g"]).first().h == {"f": 1}
