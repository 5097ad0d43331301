import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from supplyloom.operators import joins


@pytest.fixture
def skewed(spark):
    rng = random.Random(3)
    rows = [(i, 1 if rng.random() < 0.4 else rng.randrange(30)) for i in range(1000)] + [(1000, None)]
    return rows, spark.createDataFrame(rows, "row long, key long").repartition(6)


def test_hot_keys(skewed):
    rows, df = skewed
    counts = Counter(k for _, k in rows if k is not None)
    floor = 200
    found = joins.hot_keys(df, "key", floor=floor)["key"].table.collect()
    assert {r[0] for r in found} == {k for k, n in counts.items() if n >= floor}
    assert joins.hot_keys(df, "key") == {"key": joins.NOT_HOT}
    # about ``floor`` rows per salt, whatever the key holds
    for k, spread in joins.hot_keys(df, "key", floor=7)["key"].table.collect():
        assert counts[k] / 7 < spread <= 4 * counts[k] / 7


def test_more_hot_keys_than_any_list(spark, monkeypatch):
    """Thousands of hot keys: all are salted, none is left out."""
    df = spark.range(12_000).selectExpr("id as row", "id % 3000 as key")
    table = spark.range(0, 3000, 2).selectExpr("id as key", "id * 10 as v")
    assert joins.hot_keys(df, "key", floor=4)["key"].table.count() == 3000
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 1 << 17)
    out = joins.lookup(df, table, "key", 1 << 10, F.col("row"), floor=4)
    assert out.count() == 6000 and out.filter("v <> key * 10").count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_salted_lookup_equals_plain_join(spark, skewed, how, monkeypatch):
    _, df = skewed
    table = spark.createDataFrame([(k, f"v{k}") for k in range(0, 30, 2)] + [(1, "hot")], "key long, v string")
    plain = sorted(map(str, df.join(table, "key", how).collect()))
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    out = joins.lookup(df, table, "key", 64, F.col("row"), how, floor=20)
    assert sorted(map(str, out.collect())) == plain
    assert "__salt" in out._jdf.queryExecution().optimizedPlan().toString()


def test_rows_without_a_key_are_spread(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    df = spark.createDataFrame([(i, None if i % 3 else i) for i in range(300)], "row long, key long")
    out = joins.lookup(df, spark.createDataFrame([(3, "a")], "key long, v string"), "key", 64, F.col("row"), "left")
    assert out.count() == 300 and out.filter("v = 'a'").count() == 1
    assert "isnull(key" in out._jdf.queryExecution().optimizedPlan().toString()


def test_lookup_broadcasts_only_below_the_bound(spark, skewed, monkeypatch):
    _, df = skewed
    table = spark.createDataFrame([(1, "a")], "key long, v string")
    small = joins.lookup(df, table, "key", 64, F.col("row"))
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 63)
    monkeypatch.setattr(joins, "HOT_FLOOR", 100)
    out = joins.lookup(df, table, "key", 64, F.col("row"))
    assert "__salt" in out._jdf.queryExecution().optimizedPlan().toString()


def test_grid_join_equals_plain_join(spark):
    rng = random.Random(4)
    left = [(i, 1 if rng.random() < 0.4 else rng.randrange(8)) for i in range(200)]
    right = [(1 if rng.random() < 0.3 else rng.randrange(8), i) for i in range(150)]
    a = spark.createDataFrame(left, "l long, key long")
    b = spark.createDataFrame(right, "key long, r long")
    plain = Counter((l, r) for l, k in left for k2, r in right if k == k2)
    def spreads(hot):
        return joins.Spreads(spark.createDataFrame(list(hot.items()), "__hot long, __spread long")) if hot else joins.NOT_HOT

    for hot_l, hot_r in (({1: 4}, {1: 2}), ({1: 8, 2: 2}, {}), ({}, {1: 2, 3: 4}), ({}, {})):
        hot_l, hot_r = spreads(hot_l), spreads(hot_r)
        out = joins.salted_many_join(a, b, "key", hot_l, hot_r, F.col("l"), F.col("r"))
        assert Counter((x.l, x.r) for x in out.collect()) == plain
