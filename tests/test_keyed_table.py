"""The versioned keyed table against a dictionary, its plans, and its ledger under two writers."""

import random

import pytest
from conftest import values

from logweir.streaming.keyed_table import KeyedTable
from logweir.streaming.ledger import KEPT, Ledger

PAIRS = "k string, f string, v int"


def rows(spark, items):
    return spark.createDataFrame([(*k, v) for k, v in items], PAIRS)


def test_random_writes_equal_a_dictionary(spark, tmp_path):
    rng = random.Random(7)
    table, want = KeyedTable(spark, str(tmp_path / "t"), ["k", "f"], 4), {}
    key = lambda: (rng.choice(["a", "b", None]), f"f{rng.randrange(6)}")
    for step in range(12):
        batch = {key(): rng.randrange(1000) for _ in range(rng.randrange(1, 6))}
        kind = step % 4
        if kind in (0, 1):
            table.upsert(rows(spark, batch.items()))
            want.update(batch)
        elif kind == 2:
            table.insert_new(rows(spark, batch.items()))
            want = {**batch, **want}
        else:
            table.delete(rows(spark, batch.items()))
            want = {k: v for k, v in want.items() if k not in batch}
        if step % 5 == 4:
            assert table.compact()
            table.clean()
        assert values(table.read()) == sorted(((*k, v) for k, v in want.items()), key=repr)


def test_empty_and_unlike_tables(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k", "f"])
    assert table.read().count() == 0 and not table.compact() and table.last_write() == 0
    assert not table.delete(rows(spark, []))
    table.upsert(rows(spark, []))
    assert table.read().columns == ["k", "f", "v"] and table.read().count() == 0
    with pytest.raises(ValueError):
        table.upsert(spark.createDataFrame([("a", "b")], "k string, f string"))


def test_reading_and_inserting_do_not_shuffle_the_table(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k", "f"], 8)
    for i in range(2):
        table.upsert(rows(spark, [((f"k{j}", "x"), i) for j in range(50)]))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan(table.read()) and "Bucketed: true" in plan(table.read())
    fresh = table._unheld(rows(spark, [(("k1", "x"), 5), (("new", "x"), 5)]), table.state()[1])
    text = plan(fresh)
    first = text[:text.index("BroadcastNestedLoopJoin") if "BroadcastNestedLoopJoin" in text else None]
    held = first[first.index("FileScan parquet"):]
    assert "Exchange" not in first[first.index("Window "):first.index("FileScan parquet")] and "PushedFilters: [In(_bucket" in held
    assert [r.k for r in fresh.collect()] == ["new"]


def test_a_batch_is_applied_once_per_run(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k", "f"])
    one, two = rows(spark, [(("a", "x"), 1)]), rows(spark, [(("a", "x"), 2)])
    assert table.upsert(one, run="r", batch=0) and table.upsert(two, run="s", batch=0)
    assert not table.upsert(one, run="r", batch=0)
    assert values(table.read()) == [("a", "x", 2)]


def test_compaction_keeps_what_comes_meanwhile(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k", "f"])
    for i in range(3):
        table.upsert(rows(spark, [((f"k{i}", "x"), i)]))
    folding, written = KeyedTable(spark, table.path, ["k", "f"]), KeyedTable._written

    def slow(self, df, state):
        folder = written(self, df, state)
        if self is folding:
            table.upsert(rows(spark, [(("late", "x"), 9), (("k0", "x"), 7)]))
        return folder

    monkeypatch.setattr(KeyedTable, "_written", slow)
    assert folding.compact()
    assert len(table.state()[1]["live"]) == 2
    assert values(table.read()) == [("k0", "x", 7), ("k1", "x", 1), ("k2", "x", 2), ("late", "x", 9)]


def test_ledger_lets_one_of_two_writers_pass(spark, tmp_path):
    a, b = (Ledger(spark, str(tmp_path / "l")) for _ in range(2))
    assert a.latest() == (0, None)
    assert a.publish({"n": 1}, 0) and not b.publish({"n": 2}, 0)
    assert b.latest() == (1, {"n": 1})
    for i in range(1, 10):
        assert b.publish({"n": i}, i)
    assert a.latest() == (10, {"n": 9})
    assert len(a._numbers()) == KEPT
