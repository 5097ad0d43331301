import random

from pyspark.sql import functions as F

from supplyloom.operators.position import running_totals, with_position


def _rows(n=5000, seed=1):
    rng = random.Random(seed)
    # one segment holds most rows
    return [(i, "hot" if rng.random() < 0.6 else f"s{rng.randrange(5)}", rng.randrange(50)) for i in range(n)]


def test_global_position_matches_sorting(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "id long, seg string, v long").repartition(7)
    got = with_position(df, [F.col("v").desc(), F.col("id")], total="n").collect()
    want = {r[0]: i for i, r in enumerate(sorted(rows, key=lambda r: (-r[2], r[0])))}
    assert {r.id: r.position for r in got} == want
    assert {r.n for r in got} == {len(rows)}


def test_position_per_segment(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "id long, seg string, v long").repartition(5)
    got = with_position(df, [F.col("v"), F.col("id")], ["seg"], name="p", total="n").collect()
    for seg in {r[1] for r in rows}:
        mine = sorted((r for r in rows if r[1] == seg), key=lambda r: (r[2], r[0]))
        assert [r.id for r in sorted((g for g in got if g.seg == seg), key=lambda g: g.p)] == [r[0] for r in mine]
        assert {g.n for g in got if g.seg == seg} == {len(mine)}


def test_running_totals(spark):
    rows = _rows(2000)
    df = spark.createDataFrame(rows, "id long, seg string, v long").repartition(5)
    for segments in ([], ["seg"]):
        got = running_totals(df, {"t": "v"}, [F.col("id")], segments).collect()
        assert len(got) == len(rows)
        sums = {}
        for r in sorted(got, key=lambda r: r.id):
            key = r.seg if segments else ""
            sums[key] = sums.get(key, 0) + r.v
            assert r.t == sums[key]


def test_empty(spark):
    df = spark.createDataFrame([], "id long, v long")
    assert with_position(df, [F.col("id")]).count() == 0
    assert running_totals(df, {"t": "v"}, [F.col("id")]).count() == 0


def test_no_single_partition_window(spark):
    df = spark.range(100).select("id")
    plan = with_position(df, [F.col("id")], total="n")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
